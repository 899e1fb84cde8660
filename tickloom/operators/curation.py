"""Instruction rows for fine-tuning and their token arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.constants import IGNORE_LABEL
from tickloom.functions.text import format_prompt, keyword_label, words

# Fixed value: the instruction used where none is configured.
DEFAULT_INSTRUCTION = "Analyze sentiment:"


def instruction_rows(
    docs: DataFrame, text: str, positive: Sequence[str], negative: Sequence[str],
    instruction: str = DEFAULT_INSTRUCTION, keep: Sequence[str] = (),
) -> DataFrame:
    """(instruction, input, output) of every document that is not blank."""
    filled = docs.filter(F.coalesce(F.col(text), F.lit("")).rlike(r"(?U)\S"))
    return filled.select(
        *keep, F.lit(instruction).alias("instruction"), F.col(text).alias("input"),
        keyword_label(text, positive, negative).alias("output"),
    )


def hashed_ids(text: Column, limit: int, vocabulary: int = 32000) -> Column:
    """Stand-in tokenizer: a stable number below `vocabulary` for each of the first `limit` words of the whole
    text; 0 is kept for the end mark."""
    return F.transform(
        F.slice(words(text), 1, limit),
        lambda w: (F.pmod(F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long"), F.lit(vocabulary - 1)) + 1).cast("int"),
    )


def masked_tokens(prompt_ids: Column, output_ids: Column, limit: int, end_id: int) -> dict[str, Column]:
    """Token arrays of prompt, output and end mark, cut at `limit`; prompt tokens carry no label."""
    prompt, output = F.slice(prompt_ids, 1, limit), F.slice(output_ids, 1, limit)
    joined = F.concat(prompt, output)
    ended = (F.size(joined) > 0) & (F.try_element_at(joined, F.lit(-1)) == end_id)
    tail = F.when(F.coalesce(ended, F.lit(False)), F.array().cast("array<int>")).otherwise(F.array(F.lit(end_id)))
    ignored = F.array_repeat(F.lit(IGNORE_LABEL), F.size(prompt))
    ids = F.slice(F.concat(joined, tail), 1, limit)
    return {
        "input_ids": ids,
        "labels": F.slice(F.concat(ignored, output, tail), 1, limit),
        "attention_mask": F.array_repeat(F.lit(1), F.size(ids)),
    }


def tokenize_and_mask(
    rows: DataFrame,
    template: str = "{instruction}\n{input}\n",
    limit: int = 512,
    end_id: int = 0,
    tokenizer: Callable[[Column, int], Column] = hashed_ids,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Token arrays of instruction rows. `tokenizer` maps a text column and the limit to an id array column: a built-in
    expression as here, or a Pandas UDF around a model's tokenizer (`pandas_tokenizer`)."""
    prompt = format_prompt(template, instruction="instruction", input="input")
    ids = rows.select(*keep, tokenizer(prompt, limit).alias("_p"), tokenizer(F.col("output"), limit).alias("_o"))
    return ids.select(*keep, *[c.alias(n) for n, c in masked_tokens(F.col("_p"), F.col("_o"), limit, end_id).items()])


def pandas_tokenizer(make: Callable[[], Callable[[str], list[int]]]) -> Callable[[Column, int], Column]:
    """Tokenizer column from a factory that is called once per Python worker task."""

    def encode(batches):
        tokenize = make()
        for texts in batches:
            yield texts.map(lambda t: tokenize(t) if t is not None else [])

    encode.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(encode, "array<int>")
    return lambda text, limit: F.slice(udf(text), 1, limit)

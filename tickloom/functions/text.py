"""Text cleaning and keyword labelling as Column expressions; every function reads the whole text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions.constants import PUNCTUATION, SPACES, STOPWORDS, WHITESPACE

WORD_CLASS = r"[\p{L}\p{N}_]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_html(text: Column | str) -> Column:
    """Delete tags; a tag does not span a line break."""
    return F.regexp_replace(_col(text), r"<[^\n]*?>", "")


def remove_urls(text: Column | str) -> Column:
    """Delete http, https and www links up to the next white space."""
    return F.regexp_replace(_col(text), rf"(?:http|www)[^{WHITESPACE}]+", "")


def lowercase(text: Column | str) -> Column:
    return F.lower(_col(text))


def remove_punctuation(text: Column | str) -> Column:
    return F.translate(_col(text), PUNCTUATION, "")


def _split(spaced: Column) -> Column:
    return F.split(spaced, " ")


def words(text: Column | str) -> Column:
    """Words between white space, without empty ones."""
    return F.filter(_split(F.translate(_col(text), SPACES, " " * len(SPACES))), lambda w: w != "")


def _join_kept(spaced: Column, stopwords: Sequence[str]) -> Column:
    """`isin` on a long literal list is a hash lookup, so the cost per word does not grow with the list."""
    return F.array_join(F.filter(_split(spaced), lambda w: (w != "") & ~w.isin(*stopwords)), " ")


def remove_stopwords(text: Column | str, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """Drop stop words and join the rest with single spaces."""
    return _join_kept(F.translate(_col(text), SPACES, " " * len(SPACES)), stopwords)


def process_text(text: Column | str, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """Full cleaning: tags, links, case, punctuation, stop words. NULL stays NULL.

    The two regexes run only on texts holding what they look for, and one character map both turns every
    white space into a blank and deletes punctuation, so that words split at a plain blank.
    """
    t = _col(text)
    plain = (
        F.when(t.contains("<"), remove_urls(remove_html(t)))
        .when(t.contains("http") | t.contains("www"), remove_urls(t))
        .otherwise(t)
    )
    spaced = F.translate(F.lower(plain), SPACES + PUNCTUATION, " " * len(SPACES))
    return _join_kept(spaced, stopwords)


def process_columns(df, columns: Sequence[str]):
    """Clean several text columns of a table in one projection, each as `<name>_processed`."""
    return df.withColumns({f"{c}_processed": process_text(c) for c in columns})


def _keyword_pattern(keyword: str) -> str:
    """Whole-word pattern for a literal keyword; an edge that is no word character needs a word beside it."""
    left = rf"(?<!{WORD_CLASS})" if re.match(r"\w", keyword[0]) else rf"(?<={WORD_CLASS})"
    right = rf"(?!{WORD_CLASS})" if re.match(r"\w", keyword[-1]) else rf"(?={WORD_CLASS})"
    literal = "".join(ch if re.match(r"\w", ch) or ord(ch) > 127 else "\\" + ch for ch in keyword)
    return left + literal + right


def keyword_hits(lowered: Column, keywords: Sequence[str]) -> Column:
    """How many of the listed keywords occur in the text. The substring test spares most rows the regex."""
    total = F.lit(0)
    for keyword in keywords:
        k = keyword.lower()
        if k:
            found = lowered.contains(k) & lowered.rlike(_keyword_pattern(k))
            total = total + F.when(found, F.lit(1)).otherwise(F.lit(0))
    return total


def keyword_label(text: Column | str, positive: Sequence[str], negative: Sequence[str]) -> Column:
    """positive, negative or neutral, by which list has more of its keywords present; no text is neutral."""
    net = F.transform(
        F.array(F.lower(_col(text))), lambda t: keyword_hits(t, positive) - keyword_hits(t, negative)
    )[0]
    names = F.array(F.lit("negative"), F.lit("neutral"), F.lit("positive"))
    return F.element_at(names, F.coalesce(F.signum(net), F.lit(0.0)).cast("int") + 2)


def nonempty(c: Column | str) -> Column:
    """NULL for the empty string."""
    return F.nullif(_col(c), F.lit(""))


def first_nonempty(*cols: Column | str) -> Column:
    """First column that holds text; '' where none does."""
    return F.coalesce(*[nonempty(c) for c in cols], F.lit(""))


def concat_text(headline: Column | str, description: Column | str) -> Column:
    """`headline. description`, either alone, or ''."""
    return F.concat_ws(". ", nonempty(headline), nonempty(description))


def format_prompt(template: str, **values: Column | str) -> Column:
    """Fill `{name}` holes of a template with columns; other braces stay as they are."""
    pieces: list[Column] = []
    names = "|".join(re.escape(n) for n in values)
    for i, piece in enumerate(re.split(rf"\{{({names})\}}", template)):
        if i % 2:
            pieces.append(_col(values[piece]))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)


def safe_title(title: Column | str, length: int = 50) -> Column:
    """Title as a file-name part: letters, digits, blanks and underscores; `article` when nothing is left."""
    kept = F.regexp_replace(_col(title), r"[^\p{L}\p{N} _]", "_")
    shown = F.translate(F.trim(F.substring(kept, 1, length)), " ", "_")
    return F.coalesce(F.nullif(shown, F.lit("")), F.lit("article"))


def sanitize_ticker(tic: Column | str) -> Column:
    """Ticker as a path part: no `^`, `/` as `_`."""
    return F.translate(_col(tic), "/^", "_")


def compact_timestamp(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyyMMdd'T'HHmmss")


def parse_timestamp(text: Column | str) -> Column:
    """Timestamp of an ISO string, NULL where it cannot be read."""
    return _col(text).try_cast("timestamp")


def article_key(source: Column | str, ts: Column | str, title: Column | str, article_id: Column | str) -> Column:
    """`{source}_{time}_{title}_{id}`: the name an article is stored under."""
    return F.concat(
        _col(source), F.lit("_"), F.coalesce(compact_timestamp(ts), F.lit("")), F.lit("_"),
        safe_title(F.coalesce(_col(title), F.lit("untitled"))), F.lit("_"), _col(article_id).cast("string"),
    )

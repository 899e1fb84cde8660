"""Registered queries of this package: thin calls of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import context_mixing, decontaminate, html_text, kneser_ney, line_dedup, lsh_forest, mixing, phrases, quotes, runs, simhash, spotsigs, token_file
from tickloom.session import scratch_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_overlaps(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op7_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return context_mixing.score(_table(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.report(_table(spark, folder, "documents")).withColumn("removed", F.array_join("removed", ","))


def op9_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.reply_order(_table(spark, folder, "conversations"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_components(simhash.fingerprints(_table(spark, folder, "documents")), radius=3)
    return found.select("doc_id", F.format_string("%016x", "f0").alias("fingerprint"), "component_id")


def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(_table(spark, folder, "pages"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents"))


def op3_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.compare_with_next(_table(spark, folder, "documents"))


def op5_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_token_file(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_file.write_token_file(_table(spark, folder, "documents"), path, byte_bpe())
    return token_file.read_token_file(spark, path, ids=False)


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))


def op12_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return lsh_forest.near_duplicates(_table(spark, folder, "documents"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which every tenth text, by the CRC-32 of its doc_id, repeats with some period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def periodic(s):
        g, n = F.floor(s["h"] / 10), F.size(s["words"])
        a = (g % n).cast("int")
        at = F.transform(F.array(F.struct(s["words"].alias("words"), n.alias("n"), a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).cast("int").alias("p"))), repeated)
        return F.when(n > 0, at[0])

    def repeated(t):
        place = lambda i: F.when(i < t["a"], i).otherwise(t["a"] + (i - t["a"]) % t["p"])
        return F.array_join(F.transform(F.sequence(F.lit(0), t["n"] - 1), lambda i: t["words"][place(i)]), " ")

    changed = F.transform(F.array(F.struct(h.alias("h"), words.alias("words"))), periodic)[0]
    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(changed, "text")).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(_with_planted_runs(_table(spark, folder, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    best = found.withColumns({"best": longest, "listed": listed})
    length, period = -F.col("best.less"), F.col("best.period")
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"), period.alias("period"),
        F.expr("-best.less * 1000 div best.period").alias("exponent_milli"), F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_main_text": op1_main_text, "op4_decontaminate": op4_decontaminate, "op7_context_mixing": op7_context_mixing, "op8_line_dedup": op8_line_dedup, "op9_quotes": op9_quotes, "op10_simhash": op10_simhash, "op2_mixing": op2_mixing, "op3_spotsigs": op3_spotsigs, "op5_kneser_ney": op5_kneser_ney, "op6_token_file": op6_token_file, "op11_phrases": op11_phrases, "op12_minhash": op12_minhash, "op13_runs": op13_runs}

ORACLE: dict[str, str] = {"op2_mixing": mixing.SQL, "op8_line_dedup": line_dedup.SQL}

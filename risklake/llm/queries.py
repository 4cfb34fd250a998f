"""One query per operator, over its whole table, in the columns of its contract."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from risklake.llm import (
    alignment, decontamination, mixing, near_dedup, oracle, passages, periodic, repetition, secrets, sharding, suffixes,
    token_counts, token_files, url_filter,
)
from risklake.llm.common import WORD, n_words, table
from risklake.operators.stage import stage, stage_path

SHARDS = 40
FILE_VOCABULARY, END_ID = "byte_bpe_50k.json", 2
COUNT_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_dedup.near_duplicates(docs, "doc_id", "text", words=2, percent=80)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return repetition.with_figures(docs, "text").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        repetition.base_failed().alias("base_failed"), repetition.kept().alias("kept"), "repeat_covered",
        (F.col("longest_repeat") > repetition.MAX_LONGEST).alias("long_repeat"),
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    folder = stage_path(spark, "token-files")
    index = token_files.write(docs, "doc_id", "text", folder, vocabulary(FILE_VOCABULARY), END_ID)
    return token_files.read_back(index, folder)


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per passage that occurs in several documents."""
    return passages.repeated_passages(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = secrets.with_secrets(docs, "text", ["doc_id"])
    base = F.filter("secrets", lambda s: s["kind"] != "random")

    def number(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"), secrets.joined(F.col("secrets")).alias("spans"),
        number("random"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontamination.with_matches(docs, "text", table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.item_id", "m.start", "m.end", "m.edits")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    counted = token_counts.with_tokens(docs, "text", vocabulary(COUNT_VOCABULARY))
    return counted.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > token_counts.LIMIT).alias("over_limit"),
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    sized = table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    sized = stage(sized, "shard-sizes")
    placed = sharding.shard(sized, "doc_id", "size", SHARDS, stage_path(spark, "slot-map"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text").withColumn("size", n_words(F.col("text")))
    mixed = mixing.mix(docs, "doc_id", "source", "size")
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    judged = url_filter.judge(pages, "url", url_filter.seed(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_probability")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return alignment.align(docs, "doc_id", "text", vocabulary(FILE_VOCABULARY), vocabulary(PIECE_VOCABULARY))


def _with_repeats(text: Column, key: Column) -> Column:
    """The words of a text, those of every tenth document (by the crc32 of its number) with a stretch that repeats to the end."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    n, h = F.size(words), F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    again = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
    repeated = F.slice(F.concat(F.slice(words, F.lit(1), a.cast("int")), again), F.lit(1), n)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(repeated, " ")).otherwise(text)


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = periodic.with_runs(docs.select("doc_id", _with_repeats(F.col("text"), F.col("doc_id")).alias("text")), "text")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_quality": op2_quality,
    "op3_token_files": op3_token_files,
    "op4_passages": op4_passages,
    "op5_secrets": op5_secrets,
    "op6_decontamination": op6_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_url_filter": op8_url_filter,
    "op9_sharding": op9_sharding,
    "op10_mixing": op10_mixing,
    "op11_alignment": op11_alignment,
    "op12_periodic": op12_periodic,
    "op13_suffixes": op13_suffixes,
}
ORACLE_SQL = oracle.ORACLE_SQL

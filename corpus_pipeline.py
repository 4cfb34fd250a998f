"""From documents to training shards, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
docs. A stage keeps a document's row as it is, whatever columns it has; columns are numbered while an operator adds its own.
An empty table gives an empty result in every stage.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from risklake.llm import decontamination, mixing, near_dedup, repetition, sharding
from risklake.llm.common import n_words, table
from risklake.operators.stage import deleting_staged, stage, stage_path

SHARDS = 40


def _numbered(docs: DataFrame) -> tuple[DataFrame, str, list]:
    """The rows under numbered names, the name that the text has there, and the columns under their own names again."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    back = [F.col(own).alias(name) for own, name in zip(names, docs.columns)]
    return docs.toDF(*names), names[docs.columns.index("text")], back


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that fail the base rules or repeat themselves too much. NULL and empty texts fail."""
    rows, text, back = _numbered(docs)
    return repetition.with_figures(rows, text).where(repetition.kept()).select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates (five words, 80 per cent): the one with the smallest doc_id.

    Rows that share a doc_id but not a text are documents of their own; of equal ones a single one stays. Rows without a doc_id are
    in no group and stay. Five words, as stages on word shingles take: a few edits in a short text thus go further than in pairs of words.
    """
    rows, text, back = _numbered(docs)
    key = f"_c{docs.columns.index('doc_id')}"
    named = rows.where(F.col(key).isNotNull()).withColumn("_vertex", F.xxhash64(key, text))
    groups = near_dedup.near_duplicates(named.select("_vertex", F.col(text).alias("_text")), "_vertex", "_text")
    members = named.select("_vertex", F.col(key).alias("_id")).distinct().join(groups, "_vertex")
    first = members.groupBy("component_id").agg(F.min(F.struct("_id", "_vertex")).alias("_first"))
    kept = stage(first.select(F.col("_first._vertex").alias("_vertex")), "kept")
    once = named.join(kept, "_vertex", "left_semi").dropDuplicates(["_vertex"])
    return once.select(*back).unionByName(rows.where(F.col(key).isNull()).select(*back))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that hold a passage of a benchmark item."""
    rows, text, back = _numbered(docs)
    searched = decontamination.with_matches(rows, text, table(spark, sf_dir, "benchmark"), "_matches")
    return searched.where(F.size("_matches") == 0).select(*back)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the words of each source come near its target.

    Rows without a doc_id are named by a hash of the row; equal ones among them are copied alike.
    """
    whole = F.sha2(F.to_json(F.struct(*_names(docs))), 256)
    named = docs.withColumn("_name", F.coalesce(F.col("doc_id").cast("string"), whole))
    sized = named.select("_name", F.col("source"), n_words(F.col("text")).alias("_words"))
    copies = mixing.mix(sized, "_name", "source", "_words").where("copies > 0")
    copies = copies.groupBy("_name").agg(F.min("copies").alias("_copies"))
    # texts are shuffled whatever the size, as they are at scale: a broadcast of the copies hides that on small tables
    rows = named.hint("merge").join(copies, "_name").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
    return rows.select(*_names(docs))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put all rows into shards of near equal bytes: the columns of docs with shard, slot and virtual_slot."""
    names = [c for c in docs.columns if c not in ("shard", "slot", "virtual_slot")]
    sized = docs.select(*names, (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("_bytes"))
    return sharding.shard(sized, "doc_id", "_bytes", SHARDS, stage_path(spark, "slot-map")).drop("_bytes")


def _names(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shards),
]
#: suffix arrays, chosen paths and draws are not SQL; the tests hold each stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        path = stage_path(spark, name.replace(" ", "-"))
        with deleting_staged(spark):  # what a stage has written for itself
            out = function(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs

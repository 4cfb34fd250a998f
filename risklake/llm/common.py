"""Helpers shared by the operators: words, exact row positions, copies of one id."""

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from risklake.operators.stage import stage

#: a word is a run of characters that are neither blanks nor the controls tab to carriage return
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def n_words(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(df: DataFrame, key: str) -> Column:
    """64-bit hash of ``key``. Rows without a key are hashed whole, so that they don't meet in one place."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return F.when(F.col(key).isNull(), whole).otherwise(F.xxhash64(F.col(key)))


def positions(df: DataFrame, order: list[Column], name: str, at: str) -> DataFrame:
    """Add ``at``, the place of each row from 0 in the order of ``order``, without a single-task sort.

    Rows are sorted in ranges and written once, so that ranges can't change between reads; a table of one row per
    range supplies the offsets.
    """
    ranges = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_in_range", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    stored = stage(ranges, name)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    # one row per range, as many as there are partitions
    return (
        stored.join(F.broadcast(offsets), "_range")
        .withColumn(at, F.col("_offset") + F.col("_in_range"))
        .drop("_range", "_in_range", "_offset")
    )


def per_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, kept for all tasks of a Python worker: tables that are costly to load or to fill."""
    kept = sys.modules.setdefault("_llm_worker", types.ModuleType("_llm_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def slices(batch: pa.RecordBatch, text: int, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text each; a longer text is alone."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy()
    edges = np.flatnonzero(np.diff(np.cumsum(lengths) // size)) + 1
    for start, stop in zip([0, *edges], [*edges, len(lengths)]):
        if stop > start:
            yield batch.slice(start, stop - start)

"""RANK() over a whole dataset without one task that sees all of it."""

from pyspark.sql import DataFrame, Window, functions as F

from risklake.operators.stage import stage


def global_rank(df: DataFrame, value: str, rank: str, buckets: int | None = None) -> DataFrame:
    """Add ``rank`` = ``RANK() OVER (ORDER BY value DESC)`` as a long; NULL values come last.

    A window without a partition key would sort everything in a single task. Here the rows are first counted per
    distinct value, which folds ties however many rows share them; the distinct values are sorted into ranges and written with
    the number of their range; each range is ranked on its own; and the rows in earlier ranges are added from a table
    of one row per range. The ranges are cut by a bounded sample of Spark's and only steer the load: any cut gives the
    same ranks. Values that many rows share are spread in the join that brings the ranks back to the rows.

    ``df`` is read several times, so pass a stored table (see ``stage``). The ranges are written at once, the rest is
    lazy.
    """
    order = F.desc_nulls_last(value)
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    dealt = counts.repartitionByRange(buckets, order) if buckets else counts.repartitionByRange(order)
    ranges = stage(dealt.withColumn("_range", F.spark_partition_id()), "ranges")

    above = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy("_range").agg(F.sum("_n").alias("_total"))
    offsets = totals.select("_range", F.coalesce(F.sum("_total").over(above), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    prior = F.coalesce(F.sum("_n").over(within), F.lit(0))
    # one row per range: the number of partitions bounds the broadcast
    ranks = (
        ranges.select(value, "_range", prior.alias("_prior"))
        .join(F.broadcast(offsets), "_range")
        .withColumn(rank, (F.col("_offset") + F.col("_prior") + 1).cast("long"))
    )
    # NULL joins NULL
    key = {
        "_value": F.coalesce(F.col(value), F.lit(0).cast(df.schema[value].dataType)),
        "_null": F.col(value).isNull(),
    }
    return df.withColumns(key).join(ranks.withColumns(key).select(*key, rank), list(key)).drop(*key)

"""Joins whose hot keys are spread over many tasks.

Adaptive execution splits the hot partitions of a join while it runs, from the sizes it has measured, and reads each side
once. It can do so if both sides come straight from a shuffle made for the join, and if nothing after the join relies on its
partitioning. ``folded`` sees to the first; the plans group by other columns after a join, or before it. ``join_spread`` is
for sessions or plans where that is not to be had: it cuts hot keys by counts.
"""

from pyspark.sql import Column, DataFrame, functions as F

#: a key is hot if it holds so many times the rows of an average shuffle partition
HOT = 2.0


def folded(df: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """``df`` grouped by ``key`` so that a join on it shuffles the groups again: rows of the other side can then be split.

    Grouping by the key alone would leave its partitioning to the join, and a partition of groups can't be copied."""
    return df.groupBy(key, F.xxhash64(key).alias("_apart")).agg(*aggregates).drop("_apart")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> DataFrame:
    """(key, slices): the keys that hold at least ``share`` of the rows, by default ``HOT`` average shuffle partitions, and
    into how many slices of half that size each is to be cut.

    Keys are counted exactly, folded on the map side first. At most 1 / share keys can hold that share each, which
    bounds the result however many keys and rows there are. Lazy: nothing runs before the result is used.
    """
    share = min(share or HOT / _partitions(df), 1.0)
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("_n")).scalar()
    slices = F.ceil(F.col("_n") / (total * F.lit(share / 2))).cast("long")
    return counts.where(F.col("_n") >= total * F.lit(share)).select(key, slices.alias("_slices"))


def _row_slice(df: DataFrame, slices: Column) -> Column:
    """Slice of a row, the same whenever a task over a stored table is repeated. Equal rows differ in their place."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), slices)


def join_spread(
    rows: DataFrame,
    lookup: DataFrame,
    keys: str | list[str],
    how: str = "inner",
    share: float | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join with the hot values of the first key cut into slices.

    ``rows`` comes from a stored table, ``lookup`` should hold few rows per key; its rows for hot values are copied to
    each slice of the value. ``how`` is inner or left. The table of hot keys is broadcast: it has at most 1 / share rows. ``hot`` is
    such a table as ``hot_keys`` gives, stored before; without it ``rows`` is read again to count its keys.
    """
    keys = [keys] if isinstance(keys, str) else keys
    hot = F.broadcast(hot_keys(rows, keys[0], share) if hot is None else hot)
    one = F.lit(1).cast("long")
    slices = F.coalesce(F.col("_slices"), one)
    sliced = rows.join(hot, keys[0], "left")
    sliced = sliced.withColumn("_slice", F.when(slices > 1, _row_slice(rows, slices)).otherwise(F.lit(0).cast("long")))
    copied = lookup.join(hot, keys[0], "left").withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), slices - one)))
    joined = sliced.drop("_slices").join(copied.drop("_slices"), [*keys, "_slice"], how).drop("_slice")
    return joined

"""Distributed rank against RANK() over one window."""

import pytest
from pyspark.sql import Window, functions as F

from risklake.operators.rank import global_rank


def expected(df, value):
    return df.withColumn("r", F.rank().over(Window.orderBy(F.desc_nulls_last(value))).cast("long"))


def same(left, right):
    columns = sorted(right.columns)
    assert sorted(map(repr, left.select(columns).collect())) == sorted(map(repr, right.select(columns).collect()))


@pytest.mark.parametrize("spread", [False, True])
@pytest.mark.parametrize("buckets", [2, 50])
@pytest.mark.parametrize(
    "value",
    [
        "cast(id % 997 as decimal(28,2)) / 7",  # ties
        "case when id % 3 = 0 then 5.0D else rand(1) end",  # a third of the rows on one value
        "case when id % 5 = 0 then null else id end",  # NULLs
        "7L",  # a single value
        "-id",
        "case when id % 4 = 0 then cast('NaN' as double) when id % 4 = 1 then cast('Infinity' as double) "
        "when id % 4 = 2 then -0.0D else id - 10000D end",
    ],
)
def test_rank(spark, tmp_path, value, buckets, spread):
    spark.range(20000).selectExpr("id", f"{value} as v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    skewed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    for key, setting in skewed.items() if spread else ():
        spark.conf.set(key, setting)
    try:
        same(global_rank(df, "v", "r", buckets), expected(df, "v"))
    finally:
        for key in skewed:
            spark.conf.unset(key)


def test_rank_over_thousands_of_ranges(spark):
    df = spark.range(20000).selectExpr("id", "(id * 7919) % 15013 as v")
    same(global_rank(df, "v", "r", 5000), expected(df, "v"))


def test_rank_of_nothing_and_of_nulls(spark):
    assert global_rank(spark.range(0).withColumnRenamed("id", "v"), "v", "r").count() == 0
    nulls = spark.range(3).selectExpr("id", "cast(null as double) as v")
    assert {row.r for row in global_rank(nulls, "v", "r").collect()} == {1}


def test_no_window_over_all_rows(spark, capsys):
    df = spark.range(1000).selectExpr("id", "id % 100 as v")
    ranked = global_rank(df, "v", "r")
    ranked.explain()
    plan = capsys.readouterr().out
    # what is gathered has been aggregated: one row per range, or counts of the rows
    lines = plan.split("\n")
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert single and all("HashAggregate" in lines[i + 1] for i in single)

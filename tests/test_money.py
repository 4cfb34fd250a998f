"""Sums that keep every digit, in any order."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from risklake.functions.money import parts, product, summed, sums, total


def frame(spark, rows, seed):
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, "k int, x double, n int").repartition(1 + seed % 5)


def books():
    draw = random.Random(7)
    yield [0.1] * 10
    yield [1e15, 1e-9, -1e15, 2e-9]
    yield [1e20, 0.5, -1e20, 1e11, 99999999999.99, 0.01]
    yield [None, None]
    yield [None, 5.25]
    yield [1e26, 123456.789, -1e26, 1e-15]
    yield [draw.randrange(10**9) / 100 for _ in range(500)]
    yield [draw.choice([1, -1]) * draw.randrange(10**17) / 10 ** draw.randrange(1, 15) for _ in range(500)]
    yield [-0.01, -1e12, 7.0, -3.3]


def plain(values, times=1):
    some = [Fraction(repr(v)) * times for v in values if v is not None]
    return float(sum(some)) if some else None


def test_sums_keep_every_digit_in_any_order(spark):
    expected = {k: plain(b) for k, b in enumerate(books())}
    rows = [(k, x, 1) for k, b in enumerate(books()) for x in b]
    for seed in range(4):
        found = frame(spark, rows, seed).groupBy("k").agg(total([F.sum(c) for c in parts(F.col("x"))]).alias("t"))
        assert {r.k: r.t for r in found.collect()} == expected


@pytest.mark.parametrize("times", [1, 3, 999_999, 10**12, 10**18])
def test_products_with_counts_keep_every_digit(spark, times):
    """By row and by sum."""
    count = F.lit(times).cast("decimal(20,0)")
    rows = [(k, x, 1) for k, b in enumerate(books()) for x in b if x is None or abs(x) * times < 1e31]
    expected = {k: plain([x for j, x, _ in rows if j == k], times) for k in {r[0] for r in rows}}
    df = frame(spark, rows, 2)
    by_row = df.groupBy("k").agg(*sums("s", product(parts(F.col("x")), count))).select("k", total(summed("s")).alias("t"))
    by_sum = df.groupBy("k").agg(*sums("s", parts(F.col("x")))).select("k", total(product(summed("s"), count)).alias("t"))
    for found in (by_row, by_sum):
        for r in found.collect():
            assert r.t == expected[r.k] or abs(expected[r.k]) < 1e-6 * times, (r, expected[r.k])


def test_junk_is_added_beside(spark):
    df = frame(spark, [(1, 1e40, 1), (1, 2.5, 1), (2, math.inf, 1), (2, 1.0, 1), (3, float("9" * 47), 1)], 1)
    found = df.groupBy("k").agg(total([F.sum(c) for c in parts(F.col("x"))]).alias("t"))
    assert {r.k: r.t for r in found.collect()} == {1: 1e40, 2: math.inf, 3: float("9" * 47)}

"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target in words. A document of a source with ``target / size of the source`` copies gets the whole
part of that number, and its fraction is a probability to be rounded. Pivotal rounding takes two fractional documents
and moves words from one to the other, in a random direction, until one of them is whole: the expected copies of each
document stay the same, and the words of the pair stay exactly what they were. What is left of a block of documents is
one fractional document; those meet in blocks again, level by level, until each source has one, which is drawn.
The words taken from a source thus miss its target by less than one document. So that this is no long one, documents
with over a hundredth of their source's words are paired first, each with all shorter ones together: it is drawn, and
the words it took too many or too few are moved from or to the common fraction of the others.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from risklake.llm.common import positions, row_key
from risklake.operators.stage import stage

WEIGHTS = (5, 2, 1)
LIMIT = 3
#: documents of a block in the first level, and residuals that meet in each later one
BLOCK_ROWS, FAN_IN = 4000, 64
#: a document with more than the source's words over this number is long; a source has fewer long ones than this
LONG = 100


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """Targets of sources: (source, source_size) to those plus ``target`` and ``copies`` (target / source_size).

    Sources in the order of their code points, NULL last, weigh ``weights`` in turn and share all words. A target
    stops at ``limit`` times the size of its source, and what is left over is shared again by weight among the others,
    until none is above. A share is ``level * weight``; the level is raised until the capped and the uncapped targets
    sum to all words. Each round is one aggregate and caps at least one more source. ``copies`` is 0 for a source
    without words.
    """
    ranked = positions(sizes, [F.col("source").asc_nulls_last()], "mix-sources", "_rank")
    each = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = stage(ranked.select("source", "source_size", each.alias("_weight")), "mix-weights")
    top = F.col("source_size") * float(limit)

    def capped(level: float) -> Column:
        return top <= F.lit(level) * F.col("_weight")

    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, most = 0.0, -1
    while total:
        full, n, rest = ranked.agg(
            F.sum(F.when(capped(level), top)), F.count(F.when(capped(level), 1)), F.sum(F.when(~capped(level), F.col("_weight")))
        ).first()
        if n == most or not rest:
            break
        level, most = (total - (full or 0.0)) / rest, n
    target = F.when(capped(level), top).otherwise(F.lit(level) * F.col("_weight"))
    copies = F.when(F.col("source_size") <= 0, 0.0).when(capped(level), float(limit)).otherwise(
        target / F.nullif(F.col("source_size"), F.lit(0))
    )
    return ranked.select("source", "source_size", target.alias("target"), copies.alias("copies"))


def pivot(size: np.ndarray, share: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Round ``share`` (each within 0 and 1) pair by pair, in the given order; returns it and the place of the
    document that is still fractional, or -1.

    The words ``size * share`` of a pair are kept. With room to move ``up`` words to the left document and ``down``
    words to the right one, the first happens with probability ``down / (up + down)``, so no expectation changes.
    """
    out = share.astype(float).tolist()
    sizes, chance = size.tolist(), draws.tolist()
    open_ = -1
    for i, q in enumerate(out):
        if q <= 0.0 or q >= 1.0:
            continue
        if open_ < 0:
            open_ = i
            continue
        a, b, p = sizes[open_], sizes[i], out[open_]
        up, down = min(a * (1 - p), b * q), min(a * p, b * (1 - q))
        if chance[i] * (up + down) < down:
            if a * (1 - p) <= b * q:
                out[open_], out[i] = 1.0, q - up / b
                open_ = i
            else:
                out[open_], out[i] = p + up / a, 0.0
        elif a * p <= b * (1 - q):
            out[open_], out[i] = 0.0, q + down / b
            open_ = i
        else:
            out[open_], out[i] = p - down / a, 1.0
        if not 0.0 < out[open_] < 1.0:  # both became whole
            out[open_] = 0.0 if out[open_] <= 0.0 else 1.0
            open_ = -1
    return np.array(out), open_


def _draws(keys: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit keys, the same on every run."""
    x = keys.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53)


def _settle_long(group: pd.DataFrame) -> pd.DataFrame:
    """Draw the long documents of a source, longest first, while the others can make up for them. ``_share`` becomes
    0 or 1, or stays a fraction; ``_rest`` is the new fraction of all documents that are still open."""
    group = group.sort_values(["_size", "_key"], ascending=[False, True], kind="stable").reset_index(drop=True)
    draws = _draws(group["_key"].to_numpy() ^ np.int64(-1))
    fraction, rest = float(group["_share"].iloc[0]), int(group["source_size"].iloc[0])
    shares = []
    for size, draw in zip(group["_size"].tolist(), draws.tolist()):
        both = {}
        for x in (0.0, 1.0):
            both[x] = (fraction * rest - size * x) / (rest - size) if rest > size else -1.0
        if not all(0.0 <= f <= 1.0 for f in both.values()):
            break
        x = float(draw < fraction)
        shares.append(x)
        fraction, rest = both[x], rest - size
    return group.assign(_share=shares + [fraction] * (len(group) - len(shares)), _rest=fraction)


def _round_group(group: pd.DataFrame) -> pd.DataFrame:
    """Round the rows of one block of a source. Rows that became whole get ``_share`` 0 or 1; the one left keeps its
    fraction, and is drawn on its own in the last block of the source."""
    group = group.sort_values(["_size", "_key"], ascending=[False, True], kind="stable").reset_index(drop=True)
    draws = _draws(group["_key"].to_numpy() + group["_level"].to_numpy())
    shares, open_ = pivot(group["_size"].to_numpy(), group["_share"].to_numpy(), draws)
    if open_ >= 0 and group["_blocks"].iloc[0] == 1:
        shares[open_] = float(draws[open_] < shares[open_])
    return group.assign(_share=shares)


def mix(docs: DataFrame, key: str, source: str, size: str, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """Copies of each document: (key, source, size, source_size, target, copies).

    NULL sources are one source, the last; NULL sizes count as 0. Documents without words get the whole part of their
    source's copies. Equal rows are rounded one by one. Pairs are made from the longest to the
    shortest document, which leaves a short one to the draw, and draws are hashes of the
    row, so that a rerun or a retried task gives the same mix; only rows equal in key, source and size can change
    places. A task rounds blocks of about ``BLOCK_ROWS`` documents, whatever share of the table a source has.
    """
    rows = docs.select(
        F.col(key).alias("_id"), F.col(source).alias("source"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("_size")
    )
    rows = stage(rows.withColumn("_key", row_key(rows, "_id")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("_size").alias("source_size"))
    counts = rows.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("long").alias("_blocks"))
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    per_source = (
        targets(sizes, weights, limit).alias("a").join(counts.alias("b"), same).select("a.*", "b._blocks")
    )
    per_source = stage(per_source, "mix-targets")
    fraction = F.when(F.col("_size") > 0, F.col("copies") - F.floor("copies")).otherwise(0.0)
    laid = (
        rows.alias("a")
        .join(per_source.alias("b"), same)
        .select(
            "_id", "a.source", "_size", "_key", "source_size", "target", F.floor("copies").alias("_whole"),
            fraction.alias("_share"), F.lit(0).cast("long").alias("_level"), "_blocks",
            F.pmod(F.xxhash64("_key", "_size"), F.col("_blocks")).alias("_block"),
        )
    )
    is_long = (F.col("_size") * LONG > F.col("source_size")) & (F.col("_share") > 0)
    settled_schema = T.StructType([*laid.schema, T.StructField("_rest", T.DoubleType())])
    settled = stage(laid.where(is_long).groupBy("source").applyInPandas(_settle_long, settled_schema), "mix-long")
    rests = settled.groupBy("source").agg(F.first("_rest").alias("_rest"))
    others = (
        laid.where(~is_long)
        .alias("a")
        .join(rests.alias("b"), same, "left")
        .select("a.*", F.when(F.col("_share") > 0, F.coalesce("_rest", "_share")).otherwise(F.col("_share")).alias("_now"))
        .drop("_share")
        .withColumnRenamed("_now", "_share")
    )
    todo = settled.drop("_rest").unionByName(others).select(*laid.columns)
    most = per_source.agg(F.max("_blocks")).first()[0] or 1
    is_open = (F.col("_share") > 0) & (F.col("_share") < 1)
    out = None
    while True:
        done = stage(todo.groupBy("source", "_block").applyInPandas(_round_group, todo.schema), "mix-level")
        whole = done.where(~is_open)
        out = whole if out is None else out.unionByName(whole)
        if most <= 1:
            break
        most = math.ceil(most / FAN_IN)
        todo = done.where(is_open).withColumns(
            {
                "_level": F.col("_level") + 1,
                "_block": F.floor(F.col("_block") / FAN_IN),
                "_blocks": F.ceil(F.col("_blocks") / FAN_IN),
            }
        )
    return out.select(
        F.col("_id").alias(key), "source", F.col("_size").alias("size"), "source_size", "target",
        (F.col("_whole") + F.col("_share")).cast("long").alias("copies"),
    )

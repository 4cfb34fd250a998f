"""Sharding by fixed virtual slots.

Records are hashed into thousands of slots, once and for all. A small map says which shard holds which slot. Sizes are
summed per slot, and the map is edited until the bytes of the shards are near equal; every edit is stored as a new
version. Moving a slot changes one line of the map, never the slot of a record.
"""

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from risklake.llm.common import row_key

SLOTS = 8192
MAP = T.StructType(
    [
        T.StructField("virtual_slot", T.LongType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("first", T.LongType()),
    ]
)


def with_slot(df: DataFrame, key: str, slots: int = SLOTS) -> DataFrame:
    """Add ``virtual_slot``, a hash of ``key``. Rows with a NULL key are spread by a hash of the whole row."""
    return df.withColumn("virtual_slot", F.pmod(row_key(df, key), F.lit(slots)))


def slot_loads(df: DataFrame, size: Column) -> DataFrame:
    """Bytes and rows of each slot in use; at most as many rows as there are slots."""
    return df.groupBy("virtual_slot").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 0: slots dealt in turn. The place in the list is the slot, the value its shard."""
    return [slot % shards for slot in range(slots)]


def rebalance(owner: list[int], loads: list[int], shards: int, rounds: int = 2000) -> list[int]:
    """Edit a map until the bytes of the shards are near equal; also for another number of shards.

    Shards above the mean give slots away, largest first, as long as they stay above it; given slots go to the
    emptiest shard. Then the fullest and the emptiest shard exchange the slots that bring them closest together, until
    that narrows nothing. Works on one number per slot, so it runs on the driver.
    """
    owner = list(owner)
    held = [0] * shards
    own: list[list[int]] = [[] for _ in range(shards)]
    given = []
    for slot, shard in enumerate(owner):
        if shard < shards:
            held[shard] += loads[slot]
            own[shard].append(slot)
        else:
            given.append(slot)
    mean = sum(loads) / shards
    for shard in range(shards):
        stay = []
        for slot in sorted(own[shard], key=lambda s: (-loads[s], s)):
            if loads[slot] and held[shard] - loads[slot] >= mean:
                held[shard] -= loads[slot]
                given.append(slot)
            else:
                stay.append(slot)
        own[shard] = stay
    heap = [(held[shard], shard) for shard in range(shards)]
    heapq.heapify(heap)
    for slot in sorted(given, key=lambda s: (-loads[s], s)):
        bytes_, shard = heapq.heappop(heap)
        own[shard].append(slot)
        held[shard] = bytes_ + loads[slot]
        heapq.heappush(heap, (held[shard], shard))
    for _ in range(rounds):
        low = min(range(shards), key=lambda s: (held[s], s))
        high = max(range(shards), key=lambda s: (held[s], -s))
        give, take = _exchange(own[high], own[low], loads, held[high] - held[low])
        if give is None:
            break
        for slot, source, target in ((give, high, low), (take, low, high)):
            if slot is not None:
                own[source].remove(slot)
                own[target].append(slot)
                held[source] -= loads[slot]
                held[target] += loads[slot]
    for shard in range(shards):
        for slot in own[shard]:
            owner[slot] = shard
    return owner


def _exchange(full: list[int], empty: list[int], loads: list[int], gap: int) -> tuple[int | None, int | None]:
    """The slot to move from the full shard, and the one to get back (or None), that leave the smallest gap."""
    ups = sorted(full, key=lambda s: (loads[s], s))
    best, found = gap, (None, None)
    downs = [(0, None), *((loads[s], s) for s in sorted(empty, key=lambda s: (loads[s], s)))]
    at = 0
    for back, slot in downs:
        while at < len(ups) and loads[ups[at]] - back < gap / 2:
            at += 1
        for give in ups[max(at - 1, 0) : at + 1]:
            left = abs(gap - 2 * (loads[give] - back))
            if left < best:
                best, found = left, (give, slot)
    return found


def store_map(spark: SparkSession, root: str, version: int, owner: list[int], rows: list[int] | None = None) -> None:
    """Write a version of the map. ``first`` is the number of rows in the slots before it in the same shard."""
    seen: dict[int, int] = {}
    lines = []
    for slot, shard in enumerate(owner):
        lines.append((slot, shard, seen.get(shard, 0)))
        seen[shard] = seen.get(shard, 0) + (rows[slot] if rows else 0)
    spark.createDataFrame(lines, MAP).coalesce(1).write.parquet(f"{root}/version={version}")


def load_map(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.schema(MAP).parquet(f"{root}/version={version}")


def place(df: DataFrame, slot_map: DataFrame, order: str) -> DataFrame:
    """Add ``shard`` and ``slot``, the gapless place of the row in its shard: by virtual slot, then by ``order``.

    The map has one row per slot, which bounds its broadcast. A slot holds 1/8192 of the rows, so no task numbers
    the rows of a whole shard.
    """
    within = Window.partitionBy("virtual_slot").orderBy(F.col(order).asc_nulls_last())
    numbered = df.withColumn("_in_slot", F.row_number().over(within) - 1)
    firsts = slot_map.withColumnRenamed("first", "_before_slot")
    return (
        numbered.join(F.broadcast(firsts), "virtual_slot")
        .withColumn("slot", F.col("_before_slot") + F.col("_in_slot"))
        .drop("_before_slot", "_in_slot")
    )


def _loads(rows: DataFrame, size: str, slots: int) -> tuple[list[int], list[int]]:
    """Bytes and rows per slot, at most one line for each on the driver."""
    bytes_, n = [0] * slots, [0] * slots
    for line in slot_loads(rows, F.coalesce(F.col(size), F.lit(0))).collect():
        bytes_[line["virtual_slot"]], n[line["virtual_slot"]] = line["bytes"], line["rows"]
    return bytes_, n


def shard(df: DataFrame, key: str, size: str, shards: int, root: str, slots: int = SLOTS) -> DataFrame:
    """Near-equal bytes: add ``virtual_slot``, ``shard`` and ``slot`` to ``df`` (they replace columns of these names).

    Stores version 0 (dealt in turn) and version 1 (edited for the bytes found) of the map below ``root``. Rows with
    a NULL ``size`` weigh nothing. An empty table gives an empty result. Equal rows are placed one by one. Reads
    ``df`` twice.
    """
    spark = df.sparkSession
    with_slots = with_slot(df.drop("virtual_slot", "shard", "slot"), key, slots)
    bytes_, rows = _loads(with_slots, size, slots)
    dealt = first_map(shards, slots)
    store_map(spark, root, 0, dealt)
    store_map(spark, root, 1, rebalance(dealt, bytes_, shards), rows)
    return place(with_slots, load_map(spark, root, 1), key)


def reshard(df: DataFrame, key: str, size: str, shards: int, root: str, version: int) -> tuple[DataFrame, DataFrame]:
    """Edit the stored map ``version`` for the bytes that ``df`` has now, and for another number of shards.

    Stores the next version, and beside it the slots that it moves; returns ``df`` with its new places, as ``shard`` does, and
    the moves (virtual_slot, source, target, bytes, rows). Slots that don't move keep their shard, so only the rows of those listed
    have to be copied.
    """
    spark = df.sparkSession
    owner = [r["shard"] for r in load_map(spark, root, version).orderBy("virtual_slot").collect()]  # a row per slot
    with_slots = with_slot(df.drop("virtual_slot", "shard", "slot"), key, len(owner))
    bytes_, rows = _loads(with_slots, size, len(owner))
    edited = rebalance(owner, bytes_, shards)
    store_map(spark, root, version + 1, edited, rows)
    moved = [(i, a, b, bytes_[i], rows[i]) for i, (a, b) in enumerate(zip(owner, edited)) if a != b]
    kinds = "virtual_slot long, source int, target int, bytes long, rows long"
    spark.createDataFrame(moved, kinds).coalesce(1).write.parquet(f"{root}/moves={version + 1}")
    moves = spark.read.schema(kinds).parquet(f"{root}/moves={version + 1}")
    return place(with_slots, load_map(spark, root, version + 1), key), moves

"""Near-duplicates by a chosen-path set similarity join.

Each tree branches documents from its root: a node chooses, by its own hash, one or two of the minwise functions, so
that 1 / threshold of them are chosen on average, and a document goes to the child of its token under each. Similar documents
share a path down the tree with a chance that hardly falls with the depth, others part at once. Nodes of up to ``EXHAUSTIVE``
documents are compared exhaustively; larger ones branch on while they hold documents that are not known to be connected.
Independent trees raise the recall to its target.

Sketches of 128 bits, which ride along, tell which documents of a node are near; a node passes on a spanning tree of
its near documents, not their pairs. Links are confirmed on the full sets. Documents that hang together by near sketches, but
not all by confirmed links, are joined on the rare tokens that linked sets must share; few of them, or such as share
these too, are compared set by set, in blocks.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from risklake.llm.components import components
from risklake.llm.shingles import mix, shingles
from risklake.operators.stage import stage

WORDS, PERCENT = 5, 80
#: minwise functions; two bits of each make the sketch
FUNCTIONS = 64
#: depth of the first nodes, documents of a node that are compared exhaustively, and depth at which branching ends
DEPTH, EXHAUSTIVE, MAX_DEPTH = 4, 2000, 10
#: documents of a block in which sets are compared, and tokens compared at a time
BLOCK, TOKENS = 256, 4096
#: pairs of a block product that cost as much as one pair of sets that meet for a shared token
DENSE = 64
#: hash buckets that tell rare tokens of a cluster from frequent ones
BUCKETS = 4096
#: share of the pairs at the threshold that is to be found
RECALL = 0.9999999
_FACTORS = mix(np.arange(1, FUNCTIONS + 1, dtype=np.uint64)) | np.uint64(1)
_ADDED = mix(np.arange(1, FUNCTIONS + 1, dtype=np.uint64) << np.uint64(20))
#: texts hashed together, in bytes
CHUNK = 3_000_000


def trees(threshold: float, recall: float = RECALL, depth: int = DEPTH + 2) -> int:
    """Trees needed: a pair at the threshold is lost in one with the chance that a branching process dies out, in which
    each common node has on average one common child.

    This takes trees for independent. They share their functions, so the chance that all of them lose a pair is larger, and grows
    with the depth: README states it for depths 4, 6 and 10."""
    more = 1.0 / threshold - 1.0  # chance of a second function
    lost = 0.0
    for _ in range(depth):
        one = 1.0 - threshold + threshold * lost
        lost = (1.0 - more) * one + more * one * one
    return math.ceil(math.log(1.0 - recall) / math.log(lost))


def bits_apart(threshold: float) -> int:
    """Most bits in which the sketches of a pair at the threshold differ: the mean, and five standard deviations."""
    far = 1.0 - threshold
    return math.ceil(FUNCTIONS * far + 5 * math.sqrt(FUNCTIONS * (1.5 * far - far * far)))


def _lots(texts: pa.StringArray) -> Iterator[pa.StringArray]:
    sizes = pc.binary_length(texts).to_numpy()
    edges = np.flatnonzero(np.diff(np.cumsum(sizes) // CHUNK)) + 1
    for start, stop in zip([0, *edges], [*edges, len(sizes)]):
        if stop > start:
            yield texts.slice(start, stop - start)


def _minima(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Smallest token of each non-empty set under each function."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    out = np.empty((len(starts), FUNCTIONS), np.uint64)
    if len(starts):
        for k in range(FUNCTIONS):
            out[:, k] = np.minimum.reduceat(hashes * _FACTORS[k] + _ADDED[k], starts)
    return out


def _sums(hashes: np.ndarray, counts: np.ndarray, salt: int) -> np.ndarray:
    out = np.zeros(len(counts), np.uint64)
    if len(hashes):
        starts = (np.cumsum(counts) - counts)[counts > 0]
        out[counts > 0] = np.add.reduceat(mix(hashes ^ np.uint64(salt)), starts)
    return out.view(np.int64)


_SIGNATURE = "id long, n long, d0 long, d1 long, s0 long, s1 long, tokens array<int>"


def _signed(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch.column(0), 0
            for texts in _lots(pc.fill_null(batch.column(1), "")):
                hashes, counts = shingles(texts, n)
                minima = mix(_minima(hashes, counts))
                some = counts > 0
                tokens = np.zeros((len(counts), FUNCTIONS), np.int32)
                tokens[some] = (minima >> np.uint64(32)).astype(np.uint32).view(np.int32)
                sketch = np.zeros((len(counts), 2), np.int64)
                shifts = np.arange(FUNCTIONS, dtype=np.uint64)
                for k in range(2):
                    bits = (minima >> np.uint64(k)) & np.uint64(1)
                    sketch[some, k] = (bits << shifts).sum(axis=1, dtype=np.uint64).view(np.int64)
                flat = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(counts) + 1, dtype=np.int32) * FUNCTIONS), pa.array(tokens.ravel())
                )
                columns = [
                    ids.slice(at, len(counts)), pa.array(counts.astype(np.int64)), pa.array(_sums(hashes, counts, 11)),
                    pa.array(_sums(hashes, counts, 0x5BD1E995)), pa.array(np.ascontiguousarray(sketch[:, 0])),
                    pa.array(np.ascontiguousarray(sketch[:, 1])), flat,
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "d0", "d1", "s0", "s1", "tokens"])
                at += len(counts)

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch.column(0), 0
            for texts in _lots(pc.fill_null(batch.column(1), "")):
                hashes, counts = shingles(texts, n)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(hashes.view(np.int64))
                )
                columns = [
                    ids.slice(at, len(counts)), pa.array(_sums(hashes, counts, 11)),
                    pa.array(_sums(hashes, counts, 0x5BD1E995)), lists,
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "d0", "d1", "tokens"])
                at += len(counts)

    return run


def _children(node: Column, tokens: Column, threshold: float) -> Column:
    """Children of a node that a document goes to."""
    first = F.pmod(F.xxhash64(node), F.lit(FUNCTIONS))
    second = F.pmod(F.xxhash64(node, F.lit(1)), F.lit(FUNCTIONS))
    two = F.pmod(F.xxhash64(node, F.lit(2)), F.lit(1 << 20)) < F.lit(int((1.0 / threshold - 1.0) * (1 << 20)))
    chosen = F.when(two & (first != second), F.array(first, second)).otherwise(F.array(first))
    return F.transform(chosen, lambda f: F.xxhash64(node, f, F.element_at(tokens, (f + 1).cast("int"))))


def _descend(nodes: Column, tokens: Column, threshold: float) -> Column:
    return F.flatten(F.transform(nodes, lambda node: _children(node, tokens, threshold)))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets are similar enough."""
    a = sets.select(F.col("id").alias("a"), F.col("tokens").alias("_ta"))
    b = sets.select(F.col("id").alias("b"), F.col("tokens").alias("_tb"))
    common = F.size(F.array_intersect("_ta", "_tb"))
    union = F.size("_ta") + F.size("_tb") - F.col("_common")
    return (
        pairs.join(a, "a").join(b, "b").withColumn("_common", common).where(100 * F.col("_common") >= percent * union).select("a", "b")
    )


def signatures(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """One row per key: size and two sums of its set, which tell equal sets, sketch and minwise tokens."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull())
    signed = rows.mapInArrow(_signed(words), _SIGNATURE)
    fields = [f.split()[0] for f in _SIGNATURE.split(", ")][1:]
    one = signed.groupBy("id").agg(F.min(F.struct(*fields)).alias("s")).select("id", "s.*")
    return stage(one, "signatures")


class _Links:
    """Links found so far, and the components they make."""

    def __init__(self, texts: DataFrame, reps: DataFrame, words: int, percent: int):
        self.texts, self.reps, self.words, self.percent = texts, reps, words, percent
        self.found: DataFrame | None = None
        self.connected: DataFrame | None = None
        self.compared: DataFrame | None = None  # digests of the clusters whose links are all found

    def load(self, ids: DataFrame) -> None:
        """Make the full sets (id, tokens) of these documents, and of no others. Texts are shuffled once."""
        wanted = self.reps.select("id", "d0", "d1").join(ids, "id", "left_semi")
        texts = self.texts.hint("merge").join(ids, "id", "left_semi")
        made = texts.mapInArrow(_sets(self.words), "id long, d0 long, d1 long, tokens array<long>")
        once = made.join(wanted, ["id", "d0", "d1"], "left_semi").dropDuplicates(["id"]).select("id", "tokens")
        self.sets = stage(once, "sets")

    def add(self, pairs: DataFrame) -> None:
        """Confirm pairs (a, b) on the full sets."""
        self.merge(stage(_confirm(pairs, self.sets, self.percent), "confirmed"))

    def add_within(self, clusters: DataFrame) -> None:
        """Look for all links between components in each cluster (id, cluster). Clusters of one block are compared whole, larger ones by
        the rare tokens that linked sets must share, or block against block where these would make more pairs than are worth it."""
        labelled = stage(self.labelled(clusters), "clusters")
        counts = labelled.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("n"), F.min("of").alias("_x"), F.max("of").alias("_y"),
            F.bit_xor(F.xxhash64("id")).alias("d0"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("d1"),
        )
        counts = counts.where("n > 2 and _x != _y").select("cluster", "n", "d0", "d1")
        if self.compared is not None:
            counts = counts.join(self.compared, ["n", "d0", "d1"], "left_anti")
        counts = stage(counts, "cluster-sizes")
        if counts.isEmpty():
            return
        new = counts.select("n", "d0", "d1")
        self.compared = new if self.compared is None else self.compared.unionByName(new)
        open_ = stage(labelled.join(counts.select("cluster", "n"), "cluster"), "open")
        large = open_.where(F.col("n") > BLOCK)
        if large.isEmpty():
            self.merge(stage(self.by_blocks(open_), "linked"))
            return
        prefixes = stage(self.prefixes(large), "prefixes")
        groups = prefixes.groupBy("cluster", "node").agg(F.count(F.lit(1)).alias("g"), F.min("of").alias("_x"), F.max("of").alias("_y"))
        groups = stage(groups.where("g > 1 and _x != _y").select("cluster", "node", "g"), "prefix-groups")
        made = groups.groupBy("cluster").agg(F.sum(F.col("g").cast("double") * (F.col("g") - 1)).alias("_made"))
        sizes = counts.select("cluster", F.col("n").cast("double").alias("n"))
        dense = stage(made.join(sizes, "cluster").where(DENSE * F.col("_made") >= F.col("n") * (F.col("n") - 1)).select("cluster"), "dense")
        whole = open_.where(F.col("n") <= BLOCK).unionByName(large.join(dense, "cluster", "left_semi"))
        sparse = groups.join(dense, "cluster", "left_anti").select("node", F.col("g").alias("n"))
        pairs = stage(_sharing(prefixes.drop("cluster").join(sparse, "node"), self.percent).distinct(), "candidates")
        self.merge(stage(self.by_blocks(whole).unionByName(_confirm(pairs, self.sets, self.percent)).distinct(), "linked"))

    def by_blocks(self, open_: DataFrame) -> DataFrame:
        """Links between components of each cluster (id, of, cluster, n), from block against block."""
        blocks = F.ceil(F.col("n") / BLOCK)
        rows = open_.withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")))
        rows = rows.join(self.sets, "id")
        rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        rows = rows.select(
            F.xxhash64("cluster", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("block"), "id", "of",
            (F.col("_own") <= F.col("_other")).alias("left"), (F.col("_own") >= F.col("_other")).alias("right"), "tokens",
        )
        dealt = rows.repartition("block").sortWithinPartitions("block", "id")
        return dealt.mapInArrow(_compared(self.percent), "a long, b long").distinct()

    def prefixes(self, large: DataFrame) -> DataFrame:
        """(cluster, node, id, of, size, place): each set's first tokens, rare ones first, as far as a linked set must share one of them.
        ``node`` stands for the token. Tokens are ordered by how often those of the same hash bucket occur in the cluster, then by
        themselves: one order for all sets, from one small row a cluster. Parts of a cluster are counted in their tasks, and tokens
        whose bucket all belongs to one component, which no new link can share, are left out before rows are made of tokens."""
        part = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / (2 * BLOCK)))
        rows = large.select("id", "of", "cluster", part.alias("part")).join(self.sets, "id")
        rows = stage(rows.repartition("cluster", "part").sortWithinPartitions("cluster", "part"), "cluster-sets")
        counted = rows.select("cluster", "part", "of", "tokens").mapInArrow(_by_buckets, _BUCKET_COUNTS)
        held = counted.groupBy("cluster", "bucket").agg(F.sum("held").alias("held"))
        levels = _per_bucket(held, F.floor(4 * F.log2("held")).cast("tinyint"), F.lit(0).cast("tinyint"))
        size = F.size("tokens").cast("long")
        least = F.floor((size * self.percent + 99) / 100)  # tokens shared with any linked set
        leveled = F.transform("tokens", lambda t: F.struct(F.element_at("values", _bucket(t) + 1).alias("level"), t.alias("token")))
        first = F.slice(F.array_sort(leveled), F.lit(1), (size - least + 1).cast("int"))
        ordered = rows.join(levels, "cluster").select(
            "cluster", "part", "id", "of", size.alias("size"), F.transform(first, lambda t: t["token"]).alias("tokens")
        )
        ordered = stage(ordered.repartition("cluster", "part").sortWithinPartitions("cluster", "part"), "first-tokens")
        counted = ordered.select("cluster", "part", "of", "tokens").mapInArrow(_by_buckets, _BUCKET_COUNTS)
        owned = counted.groupBy("cluster", "bucket").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        several = _per_bucket(owned, F.col("low") != F.col("high"), F.lit(False))
        placed = F.transform("tokens", lambda t, i: F.struct(t.alias("token"), i.cast("long").alias("place")))
        met = F.filter(placed, lambda t: F.element_at("values", _bucket(t["token"]) + 1))
        return ordered.join(several, "cluster").select("cluster", "id", "of", "size", F.explode(met).alias("met")).select(
            "cluster", F.xxhash64("cluster", "met.token").alias("node"), "id", "of", "size", "met.place"
        )

    def clusters(self, hanging: DataFrame, left: DataFrame) -> DataFrame:
        """(id, cluster) of the documents that hang together by the pairs ``left``, which are open. A pair stands for its near
        group, in which any two documents may be linked: so those that are connected already take part too."""
        ids = hanging.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        labelled = stage(self.labelled(ids), "labelled")
        owners = labelled.join(left.select(F.explode(F.array("a", "b")).alias("id")), "id", "left_semi").select("of").distinct()
        own = labelled.join(owners, "of", "left_semi").select(F.col("id").alias("a"), F.col("of").alias("b"))
        return components(left.unionByName(own)).select("id", F.col("component").alias("cluster"))

    def merge(self, new: DataFrame) -> None:
        if not new.isEmpty():
            self.found = new if self.found is None else self.found.unionByName(new)
            self.connected = components(self.found)

    def open(self, pairs: DataFrame) -> DataFrame:
        """The pairs that would connect something."""
        if self.connected is None:
            return pairs
        a = self.connected.select(F.col("id").alias("a"), F.col("component").alias("_ca"))
        b = self.connected.select(F.col("id").alias("b"), F.col("component").alias("_cb"))
        both = pairs.join(a, "a", "left").join(b, "b", "left")
        return both.where(F.coalesce("_ca", "a") != F.coalesce("_cb", "b")).select("a", "b")

    def labelled(self, rows: DataFrame) -> DataFrame:
        """Add ``of``, the component of ``id``."""
        if self.connected is None:
            return rows.withColumn("of", F.col("id"))
        return rows.join(self.connected, "id", "left").withColumn("of", F.coalesce("component", "id")).drop("component")


def in_blocks(members: DataFrame, most: int) -> DataFrame:
    """Nodes dealt as pairs of blocks, each pair a node of about ``most`` documents: any two documents meet in one of them, so the
    spanning trees of the pairs connect what is near in the whole node."""
    blocks = F.ceil(2 * F.col("n") / F.lit(most))
    rows = members.withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))).where("_own != _other or _blocks = 1")
    pair = F.xxhash64("node", F.least("_own", "_other"), F.greatest("_own", "_other"))
    return rows.withColumn("node", pair).select(*members.columns)


_BUCKET_COUNTS = "cluster long, bucket int, held long, low long, high long"


def _bucket(token: Column) -> Column:
    return token.bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int")


def _per_bucket(counted: DataFrame, value: Column, otherwise: Column) -> DataFrame:
    """One row per cluster of (cluster, bucket, ...): ``values``, one of each bucket."""
    known = counted.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("bucket", value))).alias("known"))
    every = F.sequence(F.lit(0), F.lit(BUCKETS - 1))
    return known.select("cluster", F.transform(every, lambda b: F.coalesce(F.element_at("known", b), otherwise)).alias("values"))


def _by_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens in each bucket of a part of a cluster, and the smallest and largest component that has some there."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cluster, part, of = (batch.column(c).to_numpy() for c in ("cluster", "part", "of"))
        lists = batch.column("tokens")
        edges = np.flatnonzero(np.r_[True, (cluster[1:] != cluster[:-1]) | (part[1:] != part[:-1]), True])
        for start, stop in zip(edges[:-1], edges[1:]):
            own = lists.slice(start, stop - start)
            owners = np.repeat(of[start:stop], pc.list_value_length(own).to_numpy())
            buckets = (own.flatten().to_numpy() & (BUCKETS - 1)).astype(np.int32)
            order = np.lexsort((owners, buckets))
            buckets, owners = buckets[order], owners[order]
            first = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
            ends = np.append(first[1:], len(buckets))
            columns = [
                pa.array(np.full(len(first), cluster[start])), pa.array(buckets[first]), pa.array((ends - first).astype(np.int64)),
                pa.array(owners[first]), pa.array(owners[ends - 1]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "bucket", "held", "low", "high"])


def _sharing(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components in the nodes of a shared token (node, id, of, size, place, n) whose sizes, and places
    of the token, allow a link. Large nodes are dealt as pairs of blocks."""
    rows = members.where(F.col("n") <= EXHAUSTIVE).unionByName(in_blocks(members.where(F.col("n") > EXHAUSTIVE), EXHAUSTIVE))
    dealt = rows.drop("n").repartition("node").sortWithinPartitions("node", "id")
    return dealt.select("node", "id", "of", "size", "place").mapInArrow(_candidates(percent), "a long, b long")


def connections(docs: DataFrame, key: str, text: str, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """(id, component) of the documents that are linked with others of different sets. Only links that connect something
    are looked for: a pair that others connect already is not confirmed."""
    threshold = percent / 100.0
    limit = bits_apart(threshold)
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull())
    known = _Links(texts, reps, words, percent)
    nodes = F.transform(F.sequence(F.lit(1), F.lit(trees(threshold))), lambda t: F.xxhash64(t))
    for _ in range(DEPTH):
        nodes = _descend(nodes, F.col("tokens"), threshold)
    rows = stage(reps.select("id", "s0", "s1", F.explode(F.array_distinct(nodes)).alias("node")), "nodes")
    for depth in range(DEPTH, MAX_DEPTH + 1):
        counts = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        members = stage(rows.join(counts, "node"), "members")
        last = depth == MAX_DEPTH
        small = members.where(F.col("n") <= EXHAUSTIVE)
        if last:
            small = small.unionByName(in_blocks(members.where(F.col("n") > EXHAUSTIVE), EXHAUSTIVE))
        dealt = small.select("node", "id", "s0", "s1").repartition("node").sortWithinPartitions("node", "id")
        near = dealt.mapInArrow(_near(limit), "a long, b long")
        large = members.where(F.col("n") > EXHAUSTIVE)
        branching = not last and not large.isEmpty()
        if branching:  # their documents are compared with the first one here
            heads = large.groupBy("node").agg(F.min(F.struct("id", "s0", "s1")).alias("head"))
            star = large.join(heads, "node").where((F.col("id") != F.col("head.id")) & (_apart_head() <= limit))
            near = near.unionByName(star.select(F.col("head.id").alias("a"), F.col("id").alias("b")))
        hanging = stage(near.distinct(), "hanging")
        near = hanging if known.connected is None else stage(known.open(hanging), "near")
        ids = near.select(F.col("a").alias("id")).union(near.select(F.col("b").alias("id"))).distinct()
        known.load(ids)
        known.add(near)
        # what hangs together by near sketches, but not by links, is compared set by set
        left = stage(known.open(near), "near-open")
        if not left.isEmpty():
            clusters = known.clusters(hanging, left)
            if near is not hanging:  # documents that were connected before have no sets yet
                known.load(clusters.select("id"))
            known.add_within(clusters)
        if not branching:
            break
        labelled = known.labelled(large.select("node", "id", "s0", "s1"))
        mixed = labelled.groupBy("node").agg(F.min("of").alias("_x"), F.max("of").alias("_y")).where("_x != _y").select("node")
        going = stage(large.select("node", "id", "s0", "s1").join(mixed, "node", "left_semi"), "going")
        if going.isEmpty():
            break
        down = going.join(reps.select("id", "tokens"), "id").select(
            "id", "s0", "s1", F.explode(_children(F.col("node"), F.col("tokens"), threshold)).alias("node")
        )
        rows = stage(down.distinct(), "nodes")
    return known.connected if known.connected is not None else docs.sparkSession.createDataFrame([], "id long, component long")


def _by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Whole groups of equal keys, several at a time, from batches sorted by the key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy()
        if held and held[-1].column(key)[-1].as_py() == values[-1]:
            held.append(batch)
            continue
        cut = int(np.flatnonzero(values != values[-1])[-1]) + 1 if values[0] != values[-1] else 0
        if held and cut == 0:
            yield pa.Table.from_batches(held)
            held = []
        elif cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int32)


def _labels(near: list[np.ndarray]) -> np.ndarray:
    """Smallest place that each place of a node reaches; ``near`` lists the places near each one."""
    label = np.arange(len(near))
    while True:
        new = np.array([min(label[i], label[to].min()) if len(to) else label[i] for i, to in enumerate(near)])
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _near(limit: int):
    """For each node a spanning tree of its documents with near sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches, "node"):
            node, ids, s0, s1 = (table.column(c).to_numpy() for c in ("node", "id", "s0", "s1"))
            s0, s1 = s0.view(np.uint64), s1.view(np.uint64)
            starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            sizes = np.diff(np.append(starts, len(node)))
            of = np.repeat(sizes, sizes)
            a, b = [], []
            for k in range(1, min(8, int(sizes.max()))):  # small nodes, all at once
                i = np.flatnonzero((node[k:] == node[:-k]) & (of[k:] <= 8))
                i = i[_bits(s0[i], s0[i + k]) + _bits(s1[i], s1[i + k]) <= limit]
                a.append(ids[i])
                b.append(ids[i + k])
            for start, n in zip(starts[sizes > 8], sizes[sizes > 8]):
                own = slice(start, start + n)
                x, y = s0[own], s1[own]
                label = _labels([np.flatnonzero(_bits(x, x[i]) + _bits(y, y[i]) <= limit) for i in range(n)])
                hung = np.flatnonzero(label != np.arange(n))
                a.append(ids[own][label[hung]])
                b.append(ids[own][hung])
            if a:
                pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in pairs.T], names=["a", "b"])

    return run


def _candidates(percent: int):
    """Pairs of a node whose sets may be linked: sizes within the bound, and tokens enough from the shared one on. The first token
    that two linked sets share passes this, so the pair is met there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches, "node"):
            node, ids, of, size, place = (table.column(c).to_numpy() for c in ("node", "id", "of", "size", "place"))
            edges = np.flatnonzero(np.r_[True, node[1:] != node[:-1], True])
            sizes = np.diff(edges)
            stops, left = np.repeat(edges[1:], sizes), size - place

            def allowed(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                short, long = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
                enough = (100 + percent) * np.minimum(left[i], left[j]) >= percent * (short + long)
                return (of[i] != of[j]) & (100 * short >= percent * long) & enough

            for k in range(1, min(8, int(sizes.max()))):  # small nodes, all at once
                i = np.flatnonzero((np.arange(len(node)) + k < stops) & (np.repeat(sizes, sizes) <= 8))
                i = i[allowed(i, i + k)]
                if len(i):
                    yield _pairs(ids[i], ids[i + k])
            a, b, held = [], [], 0
            for start, n in zip(edges[:-1][sizes > 8], sizes[sizes > 8]):
                for i in range(start, start + n - 1):
                    j = np.arange(i + 1, start + n)
                    j = j[allowed(i, j)]
                    a.append(np.repeat(ids[i], len(j)))
                    b.append(ids[j])
                    held += len(j)
                    if held > 100_000:
                        yield _pairs(np.concatenate(a), np.concatenate(b))
                        a, b, held = [], [], 0
            if held:
                yield _pairs(np.concatenate(a), np.concatenate(b))

    return run


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _compared(percent: int):
    """Links between different components, one for each pair of them, in pairs of blocks of full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches, "block"):
            table = table.combine_chunks()
            block = table.column("block").to_numpy()
            edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
            for start, stop in zip(edges[:-1], edges[1:]):
                part = table.slice(start, stop - start)
                ids, of = part.column("id").to_numpy(), part.column("of").to_numpy()
                left, right = (np.flatnonzero(part.column(c).to_numpy(zero_copy_only=False)) for c in ("left", "right"))
                lists = part.column("tokens").combine_chunks()
                sizes = np.diff(lists.offsets.to_numpy())
                common = _common(lists.flatten().to_numpy(), sizes, left, right)
                union = sizes[left][:, None] + sizes[right][None, :] - common
                linked = (100 * common >= percent * union) & (of[left][:, None] != of[right][None, :])
                i, j = np.nonzero(linked)
                if len(i):
                    i, j = left[i], right[j]
                    key = np.stack([np.minimum(of[i], of[j]), np.maximum(of[i], of[j])], 1)
                    _, once = np.unique(key, axis=0, return_index=True)
                    a, b = np.minimum(ids[i], ids[j])[once], np.maximum(ids[i], ids[j])[once]
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _common(tokens: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets: products of 0-1 matrices, some tokens at a time."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, number, count = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = count[number] > 1
    number, owner = np.cumsum(count > 1)[number[shared]] - 1, owner[shared]
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    out = np.zeros((len(left), len(right)), np.int64)
    width = int(number[-1]) + 1 if len(number) else 0
    for begin in range(0, width, TOKENS):
        some = slice(np.searchsorted(number, begin), np.searchsorted(number, begin + TOKENS))
        matrix = np.zeros((len(sizes), min(TOKENS, width - begin)), np.float32)
        matrix[owner[some], number[some] - begin] = 1
        out += (matrix[left] @ matrix[right].T).astype(np.int64)
    return out


def _apart_head() -> Column:
    return F.bit_count(F.col("s0").bitwiseXOR(F.col("head.s0"))) + F.bit_count(F.col("s1").bitwiseXOR(F.col("head.s1")))


def near_duplicates(docs: DataFrame, key: str, text: str, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per document: (key, n_shingles, component_id, kept).

    A document's set holds its distinct shingles of ``words`` words, A-Z in lower case; with fewer words the whole
    sequence is its one shingle. Documents with ``100 * |intersection| >= percent * |union|`` are linked, and
    ``component_id`` is the smallest key that a document reaches through links. ``kept`` marks the one of that key.

    NULL and empty texts have no shingle and are linked with nothing. Rows with a NULL key can't be named: they are
    returned with a NULL component, as kept. Rows that share a key are one document, with the smallest of their sets.
    Equal sets are one vertex, so copies are never paired with each other.
    """
    signed = signatures(docs, key, text, words)
    filled = signed.where("n > 0")
    fields = ["id", "s0", "s1", "tokens"]
    reps = filled.groupBy("d0", "d1", "n").agg(F.min(F.struct(*fields)).alias("r")).select("r.*", "d0", "d1", "n")
    reps = stage(reps, "sets-once")
    connected = connections(docs, key, text, reps, words, percent)
    own = reps.select("d0", "d1", "n", F.col("id").alias("_rep"))
    of_rep = own.join(connected.withColumnRenamed("id", "_rep"), "_rep", "left").select(
        "d0", "d1", "n", F.coalesce("component", "_rep").alias("_component")
    )
    joined = signed.select("id", "n", "d0", "d1").join(of_rep, ["d0", "d1", "n"], "left")
    component = F.coalesce("_component", "id")
    out = joined.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), (component == F.col("id")).alias("kept")
    )
    lost = docs.where(F.col(key).isNull()).select(
        F.lit(None).cast("long").alias(key), F.lit(0).cast("long").alias("n_shingles"),
        F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"),
    )
    return out.unionByName(lost)

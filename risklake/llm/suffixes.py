"""Long repeated substrings, to the byte, by a distributed suffix array.

A suffix matters here only as far as its first ``WINDOW`` bytes, so it is written as tokens that stand for blocks of bytes, 64-bit
fingerprints of them, and the place where it starts. Suffixes are dealt out by ranges of their leading tokens, with splitters
from a sample; each bucket sorts its own by multikey quicksort (by the first token, then only ties by the next), and neighbours that
agree in their tokens are repeats. The place is the last token, so a string that occurs everywhere is cut into ranges like others, and
the first and last suffix of each bucket are compared with those of the buckets beside it.

Sorting a suffix per byte would take many times the text, so there are two steps. A window of ``WINDOW`` bytes stands at the place of
that block of ``BLOCK`` bytes inside it whose fingerprint is smallest: equal windows have it at the same distance, and neighbouring windows
share it. The first step sorts one suffix for each such place, with two tokens, the block and the whole stretch of its windows. A
stretch that occurs twice is settled as a whole; where only the block does, an end of a repeat is near, and the windows go on to the second
step, which sorts each of them by itself.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from risklake.llm.common import slices
from risklake.llm.shingles import mix
from risklake.operators.stage import stage

#: bytes of a string that counts as repeated, and of the block by which a window is placed
WINDOW, BLOCK = 400, 336
#: windows whose fingerprints are computed together, bytes of text for each bucket, and sampled suffixes for each splitter
PIECE, BUCKET, SAMPLED = 1 << 19, 64_000_000, 16

#: kinds of suffixes: see ``placed``
NEW, REPEATED, SPARE = 0, 1, 2

_random = np.random.RandomState(31)
_BYTES = _random.randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Fingerprints:
    """Fingerprints of any stretches of some bytes."""

    def __init__(self, raw: np.ndarray, forth: np.ndarray, back: np.ndarray):
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * forth[: len(raw)], out=self.sums[1:])
        self.back = back

    def all(self, size: int) -> np.ndarray:
        """Of the blocks of ``size`` bytes at every place."""
        return mix((self.sums[size:] - self.sums[:-size]) * self.back[: len(self.sums) - size])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


class Powers:
    def __init__(self) -> None:
        n = PIECE + WINDOW
        self.forth, self.back = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)

    def over(self, raw: np.ndarray) -> Fingerprints:
        return Fingerprints(raw, self.forth, self.back)


def _smallest(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each ``n`` neighbours."""
    rows = np.append(values, np.full(-len(values) % n, np.iinfo(np.uint64).max)).reshape(-1, n)
    so_far = np.minimum.accumulate(rows, axis=1).ravel()
    to_come = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(to_come[: len(values) - n + 1], so_far[n - 1 : len(values)])


def _differs(*columns: np.ndarray) -> np.ndarray:
    """Which rows differ from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def placed(raw: np.ndarray, offsets: np.ndarray, powers: Powers) -> Iterator[tuple[np.ndarray, ...]]:
    """Suffixes of texts that lie one after the other from ``offsets``: (block, stretch, text, first window, windows, kind).

    Of equal suffixes of one text, as periodic text has them, the first is ``REPEATED``; the others are ``SPARE``, and neighbours are one.
    """
    for at in range(0, len(raw) - WINDOW + 1, PIECE):
        part = raw[at : at + PIECE + WINDOW - 1]
        n = len(part) - WINDOW + 1
        # windows inside one text
        starts = np.maximum(offsets[:-1] - at, 0)
        ends = np.clip(offsets[1:] - at - WINDOW + 1, 0, n)
        some = starts < ends
        change = np.bincount(starts[some], minlength=n + 1) - np.bincount(ends[some], minlength=n + 1)
        inside = np.cumsum(change[:n]) > 0
        if not inside.any():
            continue
        prints = powers.over(part)
        block = prints.all(BLOCK)
        order = (block & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(block), dtype=np.uint64)
        place = (_smallest(order, WINDOW - BLOCK + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        place[~inside] = -1
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.append(first[1:], n) - 1
        used = place[first] >= 0
        first, last = first[used], last[used]
        chosen = place[first]
        # the stretch, and where the block lies in it
        shape = mix(((chosen - first) << 16 | (last - first)).astype(np.uint64))
        text = np.searchsorted(offsets, at + first, "right") - 1
        one, two, start, n = block[chosen], prints.of(first, last + WINDOW) ^ shape, at + first - offsets[text], last - first + 1
        order = np.lexsort((start, two, one, text))
        new = _differs(text[order], one[order], two[order])
        kind = np.zeros(len(order), np.int32)
        kind[order] = np.where(new, np.where(np.append(new[1:], True), NEW, REPEATED), SPARE)
        spare = kind == SPARE
        begins = ~(spare & np.r_[False, spare[:-1] & (text[1:] == text[:-1]) & (start[1:] == (start + n)[:-1])])
        keep = np.flatnonzero(begins)
        n = np.add.reduceat(n, keep)
        yield one[keep], two[keep], text[keep], start[keep], n, kind[keep]


def multikey(columns: list[np.ndarray]) -> np.ndarray:
    """Order by the first column, then ties only by the next."""
    order = np.argsort(columns[0], kind="stable")
    run = None
    for depth in range(1, len(columns) + 1):
        values = columns[depth - 1][order]
        new = np.r_[True, values[1:] != values[:-1]] if run is None else new | np.r_[True, values[1:] != values[:-1]]
        if depth == len(columns):
            break
        run = np.cumsum(new)
        tied = np.flatnonzero(~(new & np.r_[new[1:], True]))
        if not len(tied):
            break
        inner = np.lexsort((columns[depth][order[tied]], run[tied]))
        order[tied] = order[tied][inner]
    return order


def _bucket(columns: list[np.ndarray], splitters: list[np.ndarray]) -> np.ndarray:
    """The number of splitters at or below each row, by all columns in turn."""
    low, high = np.zeros(len(columns[0]), np.int64), np.full(len(columns[0]), len(splitters[0]))
    while len(low) and (low < high).any():
        middle = np.minimum((low + high) // 2, len(splitters[0]) - 1)
        above, equal = np.zeros(len(low), bool), np.ones(len(low), bool)
        for column, splitter in zip(columns, splitters):
            value = splitter[middle]
            above |= equal & (column < value)
            equal &= column == value
        open_ = low < high
        high = np.where(open_ & above, middle, high)
        low = np.where(open_ & ~above, middle + 1, low)
    return low


#: a suffix: two tokens, the text by two hashes, the first window that it stands for, how many, and whether its text repeats it
SUFFIX = ["one", "two", "k1", "k2", "start", "n", "kind"]
_KINDS = [pa.int64()] * 5 + [pa.int32()] * 2
SUFFIX_TYPE = "one long, two long, k1 long, k2 long, start long, n int, kind int"


def _order(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The columns that suffixes are sorted by: the tokens, and the place."""
    one, two, k1, k2, start = columns[:5]
    return [one, two, k1, k2, start]


def _suffix_batch(columns: list[np.ndarray], splitters: list[np.ndarray] | None) -> pa.RecordBatch:
    arrays = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, kind) for c, kind in zip(columns, _KINDS)]
    if splitters is None:
        return pa.RecordBatch.from_arrays(arrays, names=SUFFIX)
    signed = [a.to_numpy() for a in arrays]
    bucket = pa.array(_bucket(_order(signed), splitters), pa.int32())
    return pa.RecordBatch.from_arrays([*arrays, bucket], names=[*SUFFIX, "bucket"])


def _bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, one after the other, and where each begins and the last ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def _places(splitters: list[np.ndarray] | None):
    """First step: the suffixes of texts (k1, k2, text). Equal texts after the second one of a task add nothing: two are repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        times: dict[tuple, int] = {}
        for batch in batches:
            wanted = []
            for name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                times[name] = times.get(name, 0) + 1
                wanted.append(times[name] <= 2)
            batch = batch.filter(pa.array(wanted))
            for part in slices(batch, 2, PIECE):
                raw, offsets = _bytes(part.column(2))
                k1, k2 = part.column(0).to_numpy(), part.column(1).to_numpy()
                for one, two, text, start, n, kind in placed(raw, offsets, powers):
                    yield _suffix_batch([one, two, k1[text], k2[text], start, n, kind], splitters)

    return run


def _windows(splitters: list[np.ndarray] | None):
    """Second step: a suffix for each open window of texts (k1, k2, text, marks)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        half = WINDOW // 2
        for batch in batches:
            for row in range(batch.num_rows):
                marks = batch.column(3)[row].values
                marks = marks.filter(marks.field("open"))
                first, n = marks.field("start").to_numpy(), marks.field("n").to_numpy()
                starts = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                raw = _bytes(batch.column(2).slice(row, 1))[0]
                piece = starts // PIECE
                for at in np.unique(piece).tolist():
                    own = starts[piece == at]
                    s = own - at * PIECE
                    prints = powers.over(raw[at * PIECE : at * PIECE + PIECE + WINDOW - 1])
                    keys = [np.full(len(s), batch.column(c)[row].as_py(), np.int64) for c in (0, 1)]
                    tokens = [prints.of(s, s + half), prints.of(s + half, s + WINDOW)]
                    yield _suffix_batch([*tokens, *keys, own, np.ones(len(s), np.int64), np.full(len(s), NEW)], splitters)

    return run


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    """All rows of a task, sorted."""
    filled = [b for b in batches if b.num_rows]
    if not filled:
        return []
    table = pa.Table.from_batches(filled)
    columns = [table[c].to_numpy() for c in SUFFIX]
    order = multikey(_order(columns))
    return [c[order] for c in columns]


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First step, in a bucket: stretches that occur twice are settled; those whose block alone does are open, with one of each
    settled stretch of that block. So are those of the first and the last block, which other buckets may hold too."""
    columns = _bucket_rows(batches)
    if not columns:
        return
    names = ["k1", "k2", "start", "n", "settled", "open"]
    spare = columns[6] == SPARE
    k1, k2, start, n = (c[spare] for c in columns[2:6])
    sure = pa.array(np.ones(len(n), bool))
    yield pa.RecordBatch.from_arrays([*map(pa.array, (k1, k2, start)), pa.array(n, pa.int32()), sure, pc.invert(sure)], names=names)
    one, two, k1, k2, start, n, kind = (c[~spare] for c in columns)
    if not len(one):
        return
    new_block, new_stretch = _differs(one), _differs(one, two)
    block, stretch = np.cumsum(new_block) - 1, np.cumsum(new_stretch) - 1
    often = np.bincount(stretch, weights=1 + (kind == REPEATED))
    single = np.bincount(block[new_stretch], weights=often == 1) > 0
    searched = (np.bincount(block[new_stretch]) > 1) & single
    searched[[0, -1]] = True
    settled = often[stretch] > 1
    open_ = new_stretch & searched[block]
    kept = np.flatnonzero((settled & _differs(one, two, k1, k2, start)) | open_)
    arrays = [pa.array(c[kept]) for c in (k1, k2, start)] + [pa.array(n[kept], pa.int32())]
    yield pa.RecordBatch.from_arrays([*arrays, pa.array(settled[kept]), pa.array(open_[kept])], names=names)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second step, in a bucket: windows that equal a neighbour; and the first and the last suffix."""
    from pyspark import TaskContext

    columns = _bucket_rows(batches)
    if not columns:
        return
    new = _differs(*columns[:2])
    repeated = ~(new & np.append(new[1:], True))
    edge = np.zeros(len(new), bool)
    edge[[0, -1]] = True
    kept = np.flatnonzero(repeated | edge)
    arrays = [pa.array(c[kept], kind) for c, kind in zip(columns, _KINDS)]
    bucket = pa.array(np.full(len(kept), TaskContext.get().partitionId()), pa.int32())
    yield pa.RecordBatch.from_arrays(
        [*arrays, bucket, pa.array(kept), pa.array(repeated[kept]), pa.array(edge[kept])],
        names=[*SUFFIX, "bucket", "place", "repeated", "edge"],
    )


def _dealt(rows: DataFrame, make: Callable, expected: float, buckets: int) -> DataFrame:
    """The suffixes that ``make`` finds in ``rows``, dealt out by ranges of about equal size. The splitters come from a sample of
    the rows with ``SAMPLED`` suffixes for each of them; a range that is too large or too small changes no result."""
    fraction = min(1.0, SAMPLED * max(buckets, 1000) / max(expected, 1.0))
    sample = rows if fraction == 1.0 else rows.sample(fraction, seed=1)
    found = sample.mapInArrow(make(None), SUFFIX_TYPE).toArrow()
    columns = _order([found[c].to_numpy() for c in SUFFIX])
    order = multikey(columns) if found.num_rows else np.zeros(0, np.int64)
    cuts = order[(np.arange(1, buckets) * len(order)) // buckets] if len(order) else order
    splitters = [np.ascontiguousarray(c[cuts]) for c in columns]
    if not len(cuts):
        splitters = [np.zeros(1, np.int64)] * len(columns)
    dealt = rows.mapInArrow(make(splitters), SUFFIX_TYPE + ", bucket int")
    return dealt.repartitionById(max(buckets, 2), F.col("bucket"))


def _spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals; those that touch are one."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
    return start[first], end[np.append(first[1:], len(end)) - 1]


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text (k1, k2, text, marks, found): spans that go, and the bytes that stay."""
    for batch in batches:
        for part in slices(batch, 2, PIECE):
            spans, kept = [], []
            for row in range(part.num_rows):
                marks = part.column(3)[row].values
                marks = marks.filter(marks.field("settled"))
                first, n = marks.field("start").to_numpy(), marks.field("n").to_numpy()
                found = part.column(4)[row].values
                single = found.to_numpy() if found is not None else np.zeros(0, np.int64)
                starts, ends = np.append(first, single), np.append(first + n - 1, single) + WINDOW
                raw = part.column(2)[row].as_buffer()
                if not len(starts):
                    spans.append([])
                    kept.append(raw.to_pybytes())
                    continue
                starts, ends = _spans(starts, ends)
                spans.append([{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist())])
                view = memoryview(raw)
                kept.append(b"".join(view[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(view)])))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [part.column(0), part.column(1), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "spans", "kept"])


def text_key(text: Column) -> list[Column]:
    """Two hashes that name a text; NULL is named like an empty one."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit(1), whole).alias("k2")]


def repeated_spans(df: DataFrame, text: str) -> DataFrame:
    """(k1, k2, spans, kept) of each different text that holds a string of ``WINDOW`` bytes that also starts elsewhere: in another row, or
    at another place of the same text. ``spans`` are the longest stretches of bytes covered by such strings, ``kept`` the bytes
    outside. Texts are named by ``text_key``; equal texts in several rows are elsewhere for each other.

    Nothing crosses rows. NULL, empty and shorter texts hold nothing. An empty table gives an empty one. A long text is fingerprinted in
    pieces; one text's spans are put together in one task. Equality is that of 128 bits of fingerprints.
    """
    spark = df.sparkSession
    texts = df.select(*text_key(F.col(text)), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, size // BUCKET)
    long = texts.where(F.octet_length("text") >= WINDOW)
    suffixes = _dealt(long, _places, 2 * size / (WINDOW - BLOCK + 2), buckets)
    kinds = "k1 long, k2 long, start long, n int, settled boolean, open boolean"
    marked = stage(suffixes.mapInArrow(_settle, kinds), "marked")
    marks = marked.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n", "settled", "open")).alias("marks"))
    once = long.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    held = stage(once.join(marks, ["k1", "k2"]), "held").select("k1", "k2", "text", "marks")
    open_ = marked.where("open").agg(F.sum("n")).first()[0] or 0
    searched = held.where(F.exists("marks", lambda m: m["open"]))
    kinds = SUFFIX_TYPE + ", bucket int, place long, repeated boolean, edge boolean"
    windows = _dealt(searched, _windows, open_, max(partitions, open_ // (BUCKET // 16)))
    ranked = stage(windows.mapInArrow(_neighbours, kinds), "ranked")
    # two rows per bucket at most: an edge equals its neighbour in the bucket beside
    across = Window.orderBy("bucket", "place")
    tokens = F.struct("one", "two")
    edges = ranked.where("edge").select(
        "k1", "k2", "start", "repeated", ((F.lag(tokens).over(across) == tokens) | (F.lead(tokens).over(across) == tokens)).alias("met")
    )
    repeats = ranked.where("repeated").select("k1", "k2", "start").unionByName(
        edges.where("met and not repeated").select("k1", "k2", "start")
    )
    found = repeats.groupBy("k1", "k2").agg(F.collect_list("start").alias("found"))
    cut = held.join(found, ["k1", "k2"], "left").mapInArrow(
        _cut, T.StructType([T.StructField(k, T.LongType()) for k in ("k1", "k2")] + [T.StructField("spans", SPAN), T.StructField("kept", T.BinaryType())])
    )
    return cut.where(F.size("spans") > 0)


def without_repeats(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: ``key``, bytes of ``text``, bytes that are covered by repeated strings, the spans they form, and the digest of the rest.

    See ``repeated_spans``. Rows with equal texts lose the same; keys may be NULL or occur twice, and other columns are not looked at.
    """
    cut = repeated_spans(df, text).select(
        "k1", "k2", F.octet_length("kept").alias("n_kept"), F.size("spans").alias("n_cut"), F.sha2("kept", 256).alias("sha")
    )
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key), *text_key(F.col(text)), F.octet_length(whole).cast("long").alias("n_bytes"), F.sha2(whole.cast("binary"), 256).alias("own")
    )
    return rows.join(stage(cut, "cut"), ["k1", "k2"], "left").select(
        key, "n_bytes", F.coalesce(F.col("n_bytes") - F.col("n_kept"), F.lit(0)).alias("n_removed"),
        F.coalesce("n_cut", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("sha", "own").alias("kept_sha256"),
    )

"""Benchmark decontamination by the q-gram lemma.

A passage of ``m`` characters that was changed by at most ``k`` edits still shares ``m + 1 - q * (k + 1)`` of its q-grams
with the copy, and they lie on at most ``k + 1`` neighbouring diagonals of text against passage. So q-grams that both
have are counted in bands of ``2 * (k + 1)`` diagonals, each band starting in the middle of the one before; bands that reach the bound
are aligned within the band, and count if the edit distance is within the budget.

Texts and passages are compared as letters and digits in lower case. Long items are cut into overlapping sections, so that a
part of an item is found too. Besides, a part of ``PART`` characters of an item, or of four fifths of a shorter one, is found
wherever it stands unchanged: its q-grams follow each other on one diagonal.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from risklake.llm.common import per_worker

#: characters of a q-gram, and edits allowed per character
Q, BUDGET = 8, 0.08
#: longest section of an item, the step between sections, and the shortest item that is searched for, in characters
SECTION, STEP, SHORTEST = 160, 80, 30
#: characters of a part that counts without edits, and the share of an item that counts if that is less
PART, SHARE = 64, 0.8
#: bytes of the items that are searched for in one pass, and characters of text looked at together
BLOCK_BYTES, CHUNK = 16 << 20, 2_000_000
MATCHES = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()), T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()), T.StructField("edits", T.IntegerType()),
        ]
    )
)
_BITS = 21
_FACTORS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def _folding() -> np.ndarray:
    """For each character of the basic plane the one it is compared as; 0 for characters that are left out."""
    out = np.zeros(1 << 16, np.uint32)
    for code in range(1, 1 << 16):
        c = chr(code)
        if c.isalnum():
            lower = c.lower()
            out[code] = ord(lower) if len(lower) == 1 else code
    return out


def fold(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Characters to compare, 0 for those left out. Characters beyond the basic plane are compared as they are."""
    return np.where(codes < 1 << 16, table[np.minimum(codes, 0xFFFF)], codes)


def _hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of the ``Q`` characters from each place on; ``Q`` is a power of two, and lengths double."""
    h, length = codes * np.uint32(0x27D4EB2F) ^ (codes >> np.uint32(3)), 1
    for factor in _FACTORS:
        h = h[:-length] * np.uint32(factor) + h[length:]
        h ^= h >> np.uint32(15)
        length *= 2
    return h


class Index:
    """The sections of the items and a table of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.table = _folding()
        self.items: list[int] = []
        parts: list[int] = []
        sections: list[np.ndarray] = []
        for item, text in items:
            codes = fold(_codes(text), self.table)
            codes = codes[codes > 0]
            if len(codes) < SHORTEST:
                continue
            last = max(len(codes) - SECTION, 0)
            for at in sorted({*range(0, last, STEP), last}):
                self.items.append(item)
                parts.append(max(min(PART, math.ceil(SHARE * len(codes))), SHORTEST))
                sections.append(codes[at : at + SECTION])
        self.sections = sections
        self.sizes = np.array([len(s) for s in sections], np.int64)
        self.parts = np.array(parts, np.int64)
        self.edits = np.floor(self.sizes * BUDGET).astype(np.int64)
        self.needed = self.sizes + 1 - Q * (self.edits + 1)
        grams = [_hashes(s) for s in sections]
        keys = np.concatenate([np.zeros(0, np.uint32), *grams])
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in grams)])
        order = np.argsort(keys, kind="stable")
        self.keys, self.first, self.count = np.unique(keys[order], return_index=True, return_counts=True)
        self.owner, self.place = owner[order], place[order]
        self.known = np.zeros(1 << _BITS, bool)
        self.known[self.keys >> np.uint32(32 - _BITS)] = True

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in the text, sections, and places in the sections of all q-grams that both have."""
        found = []
        for at in range(0, max(len(codes) - Q + 1, 0), CHUNK):
            h = _hashes(codes[at : at + CHUNK + Q - 1])
            some = np.flatnonzero(self.known[h >> np.uint32(32 - _BITS)])
            to = np.minimum(np.searchsorted(self.keys, h[some]), len(self.keys) - 1)
            same = self.keys[to] == h[some]
            found.append((some[same] + at, to[same]))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        at, key = (np.concatenate(x) for x in zip(*found))
        n = self.count[key]
        entry = np.repeat(self.first[key] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(at, n), self.owner[entry], self.place[entry]

    def verbatim(self, codes: np.ndarray, hits: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[tuple[int, int, int, int]]:
        """(section, start, end, 0) of all parts that stand in the text as they are. Sections overlap by more than a part."""
        at, section, place = hits
        order = np.lexsort((at, at - place, section))
        at, section, place = at[order], section[order], place[order]
        if not len(at):
            return []
        joined = (section[1:] == section[:-1]) & (np.diff(at) == 1) & (np.diff(place) == 1)
        starts = np.flatnonzero(np.r_[True, ~joined])
        lengths = np.diff(np.append(starts, len(at))) + Q - 1
        out = []
        for i, n in zip(starts, lengths):
            if n >= self.parts[section[i]]:
                own = self.sections[section[i]][place[i] : place[i] + n]
                if (codes[at[i] : at[i] + n] == own).all():  # not only by their hashes
                    out.append((int(section[i]), int(at[i]), int(at[i] + n), 0))
        return out

    def candidates(self, hits: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Sections and first diagonals of the bands that reach the bound of the lemma."""
        at, section, place = hits
        step = self.edits[section] + 1
        band = (at - place + (1 << 20)) // step
        key = (section << np.int64(40)) + band
        # a band holds the diagonals of two steps
        keys, counts = np.unique(key, return_counts=True)
        after = np.searchsorted(keys, keys + 1)
        follow = np.where((after < len(keys)) & (keys[np.minimum(after, len(keys) - 1)] == keys + 1), counts[np.minimum(after, len(keys) - 1)], 0)
        before = np.append(keys - 1, keys)  # bands whose only hits lie in their second half begin one step earlier
        total = np.append(counts, counts + follow)
        section = before >> np.int64(40)
        enough = total >= self.needed[section]
        keys = np.unique(before[enough])
        section = keys >> np.int64(40)
        return section, (keys & np.int64((1 << 40) - 1)) * (self.edits[section] + 1) - (1 << 20)

    def matches(self, codes: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(section, start, end, edits) of all bands whose alignment keeps to the budget."""
        return self._within(codes, self.hits(codes))

    def _within(self, codes: np.ndarray, hits: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[tuple[int, int, int, int]]:
        out = []
        section, diagonal = self.candidates(hits)
        for lot in range(0, len(section), 4096):
            s, d = section[lot : lot + 4096], diagonal[lot : lot + 4096]
            start, end, edits = self._align(codes, s, d)
            good = edits <= self.edits[s]
            out += zip(s[good].tolist(), start[good].tolist(), end[good].tolist(), edits[good].tolist())
        return out

    def _align(self, codes: np.ndarray, section: np.ndarray, diagonal: np.ndarray):
        """Smallest edit distance of each section to a part of the text whose path stays in its band, widened by the
        budget; all candidates at once, row by row of the sections."""
        margin = self.edits[section]
        width = int((2 * (margin + 1) + 2 * margin).max())
        offset = np.arange(width)
        at = diagonal - margin  # the column of row 0 is text[at + offset]
        rows, far = int(self.sizes[section].max()), np.int32(1 << 20)
        pattern = np.zeros((len(section), rows), np.uint32)
        for i, s in enumerate(section):
            pattern[i, : self.sizes[s]] = self.sections[s]
        padded = len(codes)
        cost = np.zeros((len(section), width), np.int32)
        begin = at[:, None] + offset
        cost[(begin < 0) | (begin > padded)] = far
        result = [np.full(len(section), far), np.zeros(len(section), np.int64), np.zeros(len(section), np.int64)]
        for row in range(rows + 1):
            done = np.flatnonzero(self.sizes[section] == row)
            if len(done):
                best = cost[done].argmin(axis=1)
                result[0][done] = cost[done, best]
                result[1][done] = begin[done, best]
                result[2][done] = at[done] + row + best
            if row == rows:
                break
            # column ``offset`` of row r is the place at + r + offset in the text
            to = at[:, None] + row + offset
            inside = (to >= 0) & (to < padded)
            same = inside & (codes[np.clip(to, 0, max(padded - 1, 0))] == pattern[:, row : row + 1])
            new, new_begin = np.where(inside, cost + ~same, far), begin
            drop = np.full_like(cost, far)  # a character of the section is missing in the text
            drop[:, :-1] = cost[:, 1:] + 1
            less = drop < new
            new = np.where(less, drop, new)
            new_begin = np.where(less, np.c_[begin[:, 1:], begin[:, -1:]], new_begin)
            # characters of the text that the section lacks: the cheapest column to the left, one edit a step
            lowered = new - offset
            source = np.maximum.accumulate(np.where(lowered <= np.minimum.accumulate(lowered, axis=1), offset, 0), axis=1)
            cost = np.take_along_axis(lowered, source, 1) + offset
            begin = np.take_along_axis(new_begin, source, 1)
            cost = np.minimum(cost, far).astype(np.int32)
        return result[1], result[2], result[0]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def find(index: Index, texts: list[str]) -> list[list[dict]]:
    """Matches of each text: one per item, the one with the fewest edits, then the first."""
    out: list[list[dict]] = [[] for _ in texts]
    if not index.sections or not texts:
        return out
    # NUL ends each text: it is kept, but no item has it
    raw = _codes("\0".join(t.replace("\0", " ") for t in texts) + "\0")
    codes = fold(raw, index.table)
    ends = raw == 0
    kept = np.flatnonzero((codes > 0) | ends)
    codes, borders = codes[kept], np.flatnonzero(ends)
    items: dict[tuple[int, int | None], tuple[int, int, int]] = {}
    hits = index.hits(codes)
    for matches in (index._within(codes, hits), index.verbatim(codes, hits)):
        best: dict[tuple[int, int | None], tuple[int, int, int]] = {}
        for section, start, end, edits in matches:
            text = int(np.searchsorted(borders, kept[start]))
            base = 0 if not text else int(borders[text - 1]) + 1
            if kept[max(end - 1, start)] >= borders[text]:
                continue
            entry = (edits, int(kept[start]) - base, int(kept[max(end - 1, start)]) - base + 1)
            key = (text, index.items[section])
            best[key] = min(best.get(key, entry), entry)
        items = best | items  # parts only of items of which no section is found
    for (text, item), (edits, start, end) in sorted(items.items(), key=lambda x: (x[0][0], x[0][1] is None, x[0][1] or 0)):
        out[text].append({"item_id": item, "start": start, "end": end, "edits": edits})
    return out


def _searched(items: list[tuple[int, str]], tag: str, text_at: int, kept: list[str], column: str):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = per_worker(("benchmark", tag), lambda: Index(items))
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy()
            lots = np.cumsum(sizes) // CHUNK
            edges = np.flatnonzero(np.diff(lots)) + 1
            for start, stop in zip([0, *edges], [*edges, len(sizes)]):
                part = batch.slice(start, stop - start)
                found = find(index, [t or "" for t in part.column(text_at).to_pylist()])
                columns = [*(part.column(c) for c in kept), pa.array(found, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, column])

    return run


def with_matches(df: DataFrame, text: str, items: DataFrame, column: str = "matches", keep: list[str] | None = None) -> DataFrame:
    """Add the benchmark items found in ``text`` to every row: item_id, start and end in characters, and edits.

    ``items`` has item_id and text. They are searched for in blocks of ``BLOCK_BYTES``, one pass over the texts for each, so that what a
    task holds is bounded however large the benchmark is. NULL and empty texts match nothing; items that are NULL or
    shorter than ``SHORTEST`` letters and digits are not searched for. A column named ``column`` is replaced; ``keep``
    names the columns to return besides it (all).
    """
    df = df.drop(column)
    kept = keep or df.columns
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // BLOCK_BYTES + 1
    parts = []
    for block in range(blocks):
        lot = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block) if blocks > 1 else items
        # about BLOCK_BYTES
        rows = sorted(((r["item_id"], r["text"]) for r in lot.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        last = block == blocks - 1
        own = f"{column}_{block}"
        names = [*df.columns, *parts] if not last else [*kept, *parts]
        source = df if not parts else done
        schema = T.StructType([*(source.schema[n] for n in names), T.StructField(own, MATCHES)])
        tag = str(hash(tuple(rows)))
        done = source.mapInArrow(_searched(rows, tag, source.columns.index(text), names, own), schema)
        parts.append(own)
    return done.select(*[f"`{c}`" for c in kept], F.concat(*[F.col(p) for p in parts]).alias(column))

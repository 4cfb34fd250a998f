"""Runs of repeated words: stretches with a period that holds at least four times over.

Recompression turns the words of a batch into a run-length grammar: in turn, each maximal block of one symbol becomes a symbol, and
each pair of a left and a right symbol (a random bit per symbol and round) becomes one. What is the same in two places is
parsed the same way but for a few symbols at its ends, so the longest common extension of two places climbs the grammar
while the symbols above agree, and descends at the first difference: some steps per level.

A run with period q covers four neighbouring points of the grid of step q. Grid points whose words at such distances agree are candidates;
extensions to both sides from the grammar give the exact run. The grid is harmonic: n / q points for each q, n log n in all.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from risklake.llm.common import WORD, slices
from risklake.llm.shingles import mix

#: a run has at least this many periods and words
PERIODS, SHORTEST = 4, 6
#: bytes of text looked at together, and grid points
CHUNK, POINTS = 1_000_000, 500_000

_word = re.compile(WORD)


class Grammar:
    """Levels of symbols over texts that lie one after the other, each level in one array; all levels one after the other.

    ``words`` holds numbers from 0; a negative number stands before, between and after the texts, different each time, and is never
    joined with anything. Places are those of ``words``.
    """

    def __init__(self, words: np.ndarray):
        symbols, names = words.astype(np.int64), int(words.max(initial=0)) + 1
        self.symbol, self.up, self.low, self.high, self.left, self.behind = [symbols], [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], []
        offset, level = 0, 0
        while True:
            inner = symbols >= 0
            same = np.r_[False, (symbols[1:] == symbols[:-1]) & inner[1:]]
            if level % 2 == 0:
                joined = same
            else:
                side = (mix(symbols.astype(np.uint64) + np.uint64(level << 40)) & np.uint64(1)).astype(bool)
                joined = np.r_[False, inner[:-1] & inner[1:] & ~side[:-1] & side[1:]]
            first = np.flatnonzero(~joined)
            size = np.diff(np.append(first, len(symbols)))
            parents = symbols[first].copy()
            many = size > 1
            if many.any():
                # a block is named by its symbol and size, a pair by both symbols
                other = size[many] if level % 2 == 0 else symbols[first[many] + 1]
                _, named = np.unique(parents[many] * (max(names, len(words)) + 1) + other, return_inverse=True)
                parents[many] = names + named
                names += int(named.max()) + 1
            at = np.arange(len(symbols))
            owner = np.cumsum(~joined) - 1
            block = level % 2 == 0
            self.left.append((first + size)[owner] - at if block else np.ones(len(symbols), np.int64))
            self.behind.append(at - first[owner] + 1 if block else np.ones(len(symbols), np.int64))
            done = len(first) == len(symbols) and (inner[1:] & inner[:-1]).sum() == 0 or level > 400
            if done:
                self.up.append(np.full(len(symbols), -1))
                break
            following = offset + len(symbols)
            self.up.append(following + owner)
            self.symbol.append(parents)
            self.low.append(offset + first)
            self.high.append(offset + first + size - 1)
            symbols, offset, level = parents, following, level + 1
        self.low[0] = self.high[0] = np.full(len(words), -1)
        self.symbol, self.up, self.low, self.high, self.left, self.behind = map(
            np.concatenate, (self.symbol, self.up, self.low, self.high, self.left, self.behind)
        )

    def extension(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``a`` on equal those from ``b`` on; backward, those up to ``a`` and up to ``b``. ``a`` and ``b`` differ."""
        a, b, begun = a.copy(), b.copy(), a
        edge, steps, sign = (self.low, self.left, 1) if forward else (self.high, self.behind, -1)
        out = np.zeros(len(a), np.int64)
        active = np.arange(len(a))
        while len(active):
            x, y = a[active], b[active]
            equal = self.symbol[x] == self.symbol[y]
            above_x, above_y = self.up[x], self.up[y]
            climb = equal & (above_x >= 0) & (edge[above_x] == x) & (edge[above_y] == y) & (self.symbol[above_x] == self.symbol[above_y])
            step = sign * np.minimum(steps[x], steps[y])
            down_x, down_y = edge[x], edge[y]
            ended = ~equal & (down_x < 0)
            a[active] = np.where(climb, above_x, np.where(equal, x + step, np.where(ended, x, down_x)))
            b[active] = np.where(climb, above_y, np.where(equal, y + step, np.where(ended, y, down_y)))
            gone = active[ended]
            out[gone] = sign * (a[gone] - begun[gone])
            active = active[~ended]
        return out


def _grid(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates: (text, place in the text, period), by text, period and place."""
    periods = np.where(sizes >= SHORTEST, sizes // PERIODS, 0)
    text = np.repeat(np.arange(len(sizes)), periods)
    q = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    points = (sizes[text] - 1) // q - (PERIODS - 2)
    found = []
    begin, ends = 0, np.cumsum(points)
    while begin < len(text):
        # so many (text, period) at a time that the points stay few; those of one are taken whole
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + POINTS, "right")))
        n, step = points[begin:stop], q[begin:stop]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        step = np.repeat(step, n)
        place = at * step + np.repeat(starts[text[begin:stop]], n)
        kept = np.flatnonzero(words[place] == words[place + step])
        place, step = place[kept], step[kept]
        # all words from the point to the third point after it repeat
        for part, less in ((1, 0), (2, 0), (1 / 2, 0), (3 / 2, 0), (1 / 3, 0), (1, 1), (2, 1)):
            x = (part * step).astype(np.int64) - less
            near = words[place + x] == words[place + x + step]
            place, step, kept = place[near], step[near], kept[near]
            if not len(kept):
                break
        if len(kept):
            owner = begin + np.searchsorted(np.cumsum(n), kept, "right")
            found.append((text[owner], place - starts[text[owner]], step))
        begin = stop
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(map(np.concatenate, zip(*found)))


def runs(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs as (text, start, length, period), by text, start and period. ``words`` holds the word numbers, from 0, of all texts,
    one after the other; ``ends`` where each text ends. A run is a longest stretch, within a text, with this smallest period."""
    sizes = np.diff(ends, prepend=0)
    starts = ends - sizes
    text, place, q = _grid(words, starts, sizes)
    if not len(text):
        return (np.zeros(0, np.int64),) * 4
    # the grammar is only built over texts with candidates; a sign of its own lies before and after each
    held = np.unique(text)
    own = np.searchsorted(held, text)
    size = sizes[held]
    at = np.cumsum(size + 1) - size  # the first place of each text
    flat = -1 - np.arange(int(size.sum()) + len(held) + 1)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    flat[np.repeat(at, size) + inside] = words[np.repeat(starts[held], size) + inside]
    grammar = Grammar(flat)
    rows = []

    def extended(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = at[own[which]] + place[which]
        after = grammar.extension(x, x + q[which], True)
        before = grammar.extension(x - 1, x + q[which] - 1, False)
        return place[which] - before, place[which] + q[which] + after

    # the first point of each row of neighbouring points, then those that its run does not cover
    follows = np.r_[False, (text[1:] == text[:-1]) & (q[1:] == q[:-1]) & (place[1:] == place[:-1] + q[1:])]
    first = np.flatnonzero(~follows)
    start, end = extended(first)
    rows.append((first, start, end))
    covered = end[np.cumsum(~follows) - 1]
    rest = np.flatnonzero(follows & (place + 3 * q >= covered))
    if len(rest):
        rows.append((rest, *extended(rest)))
    which, start, end = map(np.concatenate, zip(*rows))
    length = end - start
    long = length >= np.maximum(SHORTEST, PERIODS * q[which])
    which, start, length = which[long], start[long], length[long]
    text, period = text[which], q[which]
    # a multiple of a period gives the same stretch
    order = np.lexsort((period, length, start, text))
    text, start, length, period = (c[order] for c in (text, start, length, period))
    new = np.r_[True, (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])] if len(text) else np.zeros(0, bool)
    text, start, length, period = (c[new] for c in (text, start, length, period))
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
RESULT = [("runs", T.ArrayType(RUN)), ("strongest", RUN), ("collapsed", T.StringType())]


def _measure(texts: list[str | None]) -> list[pa.Array]:
    numbers: dict[str, int] = {}
    found = [_word.findall(t or "") for t in texts]
    ids = [np.fromiter([numbers.setdefault(w, len(numbers)) for w in ws], np.int64, len(ws)) for ws in found]
    ends = np.cumsum([len(ws) for ws in found])
    text, start, length, period = runs(np.concatenate(ids) if ids else np.zeros(0, np.int64), ends)
    edges = np.searchsorted(text, np.arange(len(texts) + 1))
    strongest: list[dict | None] = [None] * len(texts)
    kept = list(map(" ".join, found))
    for i in np.unique(text).tolist():
        rows = list(zip(*(c[edges[i] : edges[i + 1]].tolist() for c in (start, length, period))))
        best = rows[0]
        for row in rows[1:]:
            if row[1] * best[2] > best[1] * row[2]:
                best = row
        strongest[i] = dict(zip(RUN.names, best))
        stays = bytearray(b"\1" * len(found[i]))
        for s, n, p in rows:
            stays[s + p : s + n] = bytes(n - p)
        kept[i] = " ".join([w for w, k in zip(found[i], stays) if k])
    kind = pa.struct([(c, pa.int64()) for c in RUN.names])
    spans = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], RUN.names)
    return [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), spans), pa.array(strongest, kind), pa.array(kept, pa.string())]


def _with_runs(text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_at, CHUNK):
                yield pa.RecordBatch.from_arrays([*part.columns, *_measure(part.column(text_at).to_pylist())], names=names)

    return run


def with_runs(df: DataFrame, text: str) -> DataFrame:
    """Add ``runs`` (start, length, period; in words from 0, by start and period), ``strongest`` (the run with the most periods,
    the first of equal ones; NULL without runs) and ``collapsed``, the words joined by single blanks with only the first period of each run.

    NULL and empty texts have no runs, and '' is left of them. Rows are handled one by one, so equal rows get equal results, and
    columns of these names are replaced. An empty table gives an empty one. A text is handled in one task, whatever its length.
    """
    df = df.drop(*[c for c, _ in RESULT])
    schema = T.StructType([*df.schema, *(T.StructField(c, kind) for c, kind in RESULT)])
    return df.mapInArrow(_with_runs(df.columns.index(text), schema.names), schema)

"""Near-duplicate passages by compact windows.

A text is a sequence of grams of ``GRAM`` words, and a hash function orders them. The Cartesian tree over the hashes tells for
each gram the widest window in which it is the smallest; such a compact window stands for all subsequences inside it that contain
the gram, as they share this min-hash. Only windows of at least ``WIDTH`` grams matter, and a text has about one of them in seven words.

Two passages of 50 words that are similar to 80 per cent differ in one word or so: they hold the same words in a row on one side of it, ``WIDTH``
grams at least, and these have the same smallest gram in both. So one hash is enough for a pair to meet, and what meets has ``GRAM``
words in common already. Windows are dealt out by ranges of (gram, context, place), where the context is all that a passage around the gram can
hold. Equal contexts are the same passage, whoever holds them: they are one class, and only one of them goes on. Different contexts of a gram are
compared word by word, all with all, if they are few. Groups of many contexts, as a common line makes them, are sorted by fingerprints that just
similar windows share, very large ones some windows in each task (if passages may differ in more than a word, they are compared as pairs of
blocks). Of these groups it is returned which contexts hang together and how far each is similar to others, not a row for every pair.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from risklake.llm.common import slices
from risklake.llm.components import components
from risklake.llm.near_dedup import _by_key
from risklake.llm.shingles import mix, words
from risklake.llm.suffixes import NEW, _bucket_rows, _dealt, _differs, _powers, _suffix_batch
from risklake.operators.stage import stage

#: words of a shingle, shortest passage in words, similarity that counts in per cent
WORDS, PASSAGE, PERCENT = 5, 50, 80
#: words of a gram, and grams that similar passages have in a row (25 words)
GRAM, WIDTH = 12, 14
#: distinct contexts of a gram whose links are returned pair by pair, that are compared pair by pair, and that one task gets for all windows
SMALL, BLOCK, PART = 16, 512, 8192
#: words before and after the start of a gram that a passage around it can hold
BEFORE, AFTER = PASSAGE - GRAM, PASSAGE
#: pairs of contexts looked at together, and rows times places whose fingerprints are sorted together
TILE, TOGETHER = 2048, 1 << 14
#: bytes of text hashed together
CHUNK = 2_000_000
_BASE = 0x9E3779B97F4A7C15


def grams(word: np.ndarray, counts: np.ndarray, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the grams of all texts in their order, and the number of each text: 0 for texts shorter than a gram."""
    if not len(word):
        return np.zeros(0, np.uint64), counts * 0
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(word))
    hashes = np.zeros(len(word), np.uint64)
    for k in range(n):
        some = len(word[k:])
        hashes[:some] = (hashes[:some] ^ word[k:]) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(k + 1)
    return mix(hashes[left >= n]), np.maximum(counts - n + 1, 0)


def _smaller_before(values: np.ndarray, group: np.ndarray, strict: bool) -> np.ndarray:
    """Place of the last smaller value before each one in its group, -1 without; ``strict`` or else also an equal one."""
    n = len(values)
    before = np.arange(n) - 1
    open_ = np.arange(n)
    while len(open_):
        to = before[open_]
        inside = (to >= 0) & (group[to] == group[open_])
        before[open_[~inside]] = -1
        open_, to = open_[inside], to[inside]
        larger = values[to] >= values[open_] if strict else values[to] > values[open_]
        open_, to = open_[larger], to[larger]
        before[open_] = before[to] if len(open_) else 0
        # what is still open jumps over the values its predecessor has jumped over already
    return before


def compact_windows(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(center, first, last) of all compact windows of at least ``width`` shingles, as places among all shingles.

    Of equal hashes the first counts as the smallest. A window's center is the smallest of some ``width`` neighbours, and the
    ends of its window are centers too, so the tree is built over the centers only.
    """
    n = len(hashes)
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(len(counts)), counts)
    if n < width:
        return (np.zeros(0, np.int64),) * 3
    best, length = np.arange(n), 1
    while length * 2 <= width:
        other = best[length:]
        best = np.where(hashes[best[: len(other)]] <= hashes[other], best[: len(other)], other)
        length *= 2
    if length < width:
        other = best[width - length :]
        best = np.where(hashes[best[: len(other)]] <= hashes[other], best[: len(other)], other)
    starts = np.arange(len(best))
    inside = starts + width <= ends[text[: len(best)]]
    centers = np.unique(best[inside])
    value, group = hashes[centers], text[centers]
    before = _smaller_before(value, group, strict=False)
    after = len(centers) - 1 - _smaller_before(value[::-1], group[::-1], strict=True)[::-1]
    begin = (ends - counts)[group]
    first = np.where(before >= 0, centers[np.maximum(before, 0)] + 1, begin)
    last = np.where(after < len(centers), centers[np.minimum(after, len(centers) - 1)] - 1, ends[group] - 1)
    return centers, first, last


def _texts(part: pa.RecordBatch) -> pa.StringArray:
    return pc.fill_null(part.column(2), "")


def _centers(splitters: list[np.ndarray] | None):
    """The windows of texts (k1, k2, text) as (gram, context, text, word, shape)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, CHUNK):
                word, counts = words(_texts(part))
                if not len(word):
                    continue
                hashes, n_grams = grams(word, counts)
                text = np.repeat(np.arange(len(counts)), n_grams)
                place = np.arange(len(hashes)) - np.repeat(np.cumsum(n_grams) - n_grams, n_grams)
                # equal grams of a text are ordered at random: in their own order they would make a tree without branches
                ties = mix(place.astype(np.uint64)) & np.uint64(0xFFFF)
                center, _, _ = compact_windows(hashes & ~np.uint64(0xFFFF) | ties, n_grams, WIDTH)
                own, at = text[center], place[center]
                begin = (np.cumsum(counts) - counts)[own]
                low, high = np.maximum(at - BEFORE, 0), np.minimum(at + AFTER, counts[own])
                back = _powers(pow(_BASE, -1, 1 << 64), len(word) + 1)
                sums = np.append(np.uint64(0), np.cumsum(word * _powers(_BASE, len(word)), dtype=np.uint64))
                shape = (at - low) * 128 + (high - low)
                context = mix((sums[begin + high] - sums[begin + low]) * back[begin + low]) ^ mix(shape.astype(np.uint64))
                k1, k2 = part.column(0).to_numpy(), part.column(1).to_numpy()
                kind = np.full(len(at), NEW)
                yield _suffix_batch([hashes[center], context, k1[own], k2[own], at, shape, kind], splitters)

    return run


_MEETING = "token long, gram long, k1 long, k2 long, word long, shape int, same boolean, open boolean"


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In a bucket: windows whose context occurs again are of one class; one of each context goes on if its gram has several. What lies
    at the ends of the bucket may go on in the next one."""
    columns = _bucket_rows(batches)
    if not columns:
        return
    gram, context, k1, k2, start, shape, _ = columns
    new_gram, new_context = _differs(gram), _differs(gram, context)
    of_gram, of_context = np.cumsum(new_gram) - 1, np.cumsum(new_context) - 1
    often = np.bincount(of_context) > 1
    often[[0, -1]] = True
    several = np.bincount(of_gram[new_context]) > 1
    several[[0, -1]] = True
    same = often[of_context] & (shape % 128 >= PASSAGE)
    open_ = new_context & several[of_gram]
    kept = np.flatnonzero(same | open_)
    token = mix(gram.view(np.uint64)[kept] ^ mix(context.view(np.uint64)[kept])).view(np.int64)
    arrays = [pa.array(token), *(pa.array(c[kept]) for c in (gram, k1, k2, start)), pa.array(shape[kept], pa.int32())]
    names = [c.split()[0] for c in _MEETING.split(", ")]
    yield pa.RecordBatch.from_arrays([*arrays, pa.array(same[kept]), pa.array(open_[kept])], names=names)


_CONTEXT = "gram long, k1 long, k2 long, word long, after binary, before binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words around the open windows of texts (k1, k2, text, open), four bytes each: from the gram on, and back from it."""
    for batch in batches:
        for part in slices(batch, 2, CHUNK):
            word, counts = words(_texts(part))
            short = (word >> np.uint64(32)).astype(">u4")
            rows = []
            for row, end in enumerate(np.cumsum(counts).tolist()):
                begin = end - int(counts[row])
                k1, k2 = part.column(0)[row].as_py(), part.column(1)[row].as_py()
                for w in part.column(3)[row].as_py():
                    at = begin + w["word"]
                    if at + GRAM <= end:
                        after, before = short[at : min(at + AFTER, end)], short[max(at - BEFORE, begin) : at][::-1]
                        rows.append((w["gram"], k1, k2, w["word"], after.tobytes(), before.tobytes()))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.binary()] * 2
            names = [c.split()[0] for c in _CONTEXT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _matrix(column: pa.BinaryArray, width: int, salt: int) -> np.ndarray:
    """Rows of words; places past the end hold numbers that no other row has there."""
    sizes = pc.binary_length(column).to_numpy() // 4
    out = np.empty((len(column), width), np.int64)
    out[:] = -1 - salt - 2 * np.arange(len(column))[:, None]
    inside = np.arange(width) < sizes[:, None]
    raw = np.frombuffer(b"".join(column.to_pylist()), ">u4")
    out[inside] = raw
    return out


def _shingled(x: np.ndarray) -> np.ndarray:
    """Hashes of the shingles of rows of words."""
    size = x.shape[1] - WORDS + 1
    h = np.zeros((len(x), size), np.uint64)
    for k in range(WORDS):
        h = (h ^ x[:, k : k + size].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(k + 1)
    return h


def similar(a: np.ndarray, b: np.ndarray, passage: int, percent: int) -> tuple[np.ndarray, ...]:
    """Windows of ``passage`` words that are similar in rows of words that lie side by side: (row, first start, last start, shift).

    Shingles match their like at the same place or at one beside it, as a word that is left out or put in moves what follows.
    ``shift`` is how much later the window of ``b`` starts than that of ``a``.
    """
    return _similar(_shingled(a), _shingled(b), a >= 0, b >= 0, passage, percent)


def _similar(x: np.ndarray, y: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, passage: int, percent: int) -> tuple[np.ndarray, ...]:
    """``similar`` from the shingles of both, and where there is text."""
    n = passage - WORDS + 1
    size = x.shape[1]
    starts = size - n + 1
    free = np.ones(x.shape, bool)
    sums = {}
    for s in (0, 1, -1):
        equal = np.zeros(x.shape, bool)
        to, of = slice(max(s, 0), size + min(s, 0)), slice(max(-s, 0), size - max(s, 0))
        equal[:, of] = x[:, of] == y[:, to]
        equal &= free
        free &= ~equal
        sums[s] = np.zeros((len(x), size + 1), np.int16)
        np.cumsum(equal, axis=1, dtype=np.int16, out=sums[s][:, 1:])
    least = -(-2 * n * percent // (100 + percent))
    found = []
    rows = np.arange(len(x))
    for shift in (0, 1, -1):
        common = np.zeros((len(rows), starts), np.int16)
        for s, c in sums.items():
            # shingles that match at s and lie in both windows
            low, high = max(shift - s, 0), n + min(shift - s, 0)
            common += c[rows, high : high + starts] - c[rows, low : low + starts]
        # padding is no text
        good = (common >= least) & in_a[rows, :starts] & in_a[rows, passage - 1 : passage - 1 + starts]
        to, of = slice(max(shift, 0), starts + min(shift, 0)), slice(max(-shift, 0), starts - max(shift, 0))
        ends = slice(to.start + passage - 1, to.stop + passage - 1)
        good[:, of] &= in_b[rows, to] & in_b[rows, ends]
        good[:, : of.start] = good[:, of.stop :] = False
        some = good.any(axis=1)
        hit = good[some]
        found.append((rows[some], hit.argmax(axis=1), starts - 1 - hit[:, ::-1].argmax(axis=1), np.full(len(hit), shift)))
        rows = rows[~some]
    return tuple(map(np.concatenate, zip(*found)))


def _reach(matched: np.ndarray, inside: np.ndarray, n: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the windows ``inside`` that have ``least`` matched among their ``n`` shingles; first > last without any."""
    sums = np.concatenate([np.zeros((len(matched), 1), np.int16), np.cumsum(matched, axis=1, dtype=np.int16)], axis=1)
    good = (sums[:, n:] - sums[:, :-n] >= least) & inside
    some = good.any(axis=1)
    last = good.shape[1] - 1 - good[:, ::-1].argmax(axis=1)
    return np.where(some, good.argmax(axis=1), 1), np.where(some, last, 0)


def connect(context: np.ndarray, left: np.ndarray, right: np.ndarray, passage: int, percent: int) -> tuple[np.ndarray, ...]:
    """What comparing all ``left`` with all ``right`` rows of words around one gram gives: for each row its label, first and last start
    of a window that is similar to one of another row (first > last: none). Rows with a common label hang together by such windows.

    All pairs are gone through, some at a time. A window around the gram holds all 19 shingles on one side of those that lie in the gram, or
    more, so pairs without enough matches there are left at once. Of the others, those are compared that could connect rows or widen
    what is known of one.
    """
    n = passage - WORDS + 1
    least = -(-2 * n * percent // (100 + percent))
    x, text = _shingled(context), context >= 0
    size = x.shape[1]
    short = (x >> np.uint64(32)).astype(np.uint32)
    inside = text[:, : size - n + 1] & text[:, passage - 1 : passage + size - n]
    half = (size - n) // 2
    sides = ((half, size - n), (n, size - half))  # a window begins at ``half`` or before, or else after it
    label, first, last = np.arange(len(x)), np.full(len(x), size), np.full(len(x), -1)
    widest = inside.argmax(axis=1), inside.shape[1] - 1 - inside[:, ::-1].argmax(axis=1)

    def promising(i, j) -> np.ndarray:
        near = False
        for begin, end in sides:
            matched = short[j, begin:end] == short[i, begin:end]
            matched |= short[j, begin + 1 : end + 1] == short[i, begin:end]
            matched |= short[j, begin - 1 : end - 1] == short[i, begin:end]
            near = near | (np.add.reduce(matched, axis=-1, dtype=np.uint8) >= least - n + half)
        return near

    whole = len(left) == len(right) and bool((left == right).all())
    deep = max(1, TILE // len(right)) if len(right) else 1
    for i0 in range(0, len(left), deep):
        mine = left[i0 : i0 + deep]
        others = right[i0 + 1 :] if whole else right
        for j0 in range(0, len(others), TILE):
            theirs = others[j0 : j0 + TILE]
            full = (first == widest[0]) & (last == widest[1])
            need = ~(full[mine][:, None] & full[theirs] & (label[mine][:, None] == label[theirs]))
            if whole:
                need &= mine[:, None] < theirs
            i, j = np.nonzero(need)
            if 4 * len(i) < need.size:
                i, j = mine[i], theirs[j]
                near = promising(i, j)
                i, j = i[near], j[near]
            else:
                i, j = np.nonzero(need & promising(mine[:, None], theirs[None, :]))
                i, j = mine[i], theirs[j]
            for begin in range(0, len(i), TILE):
                _join(i[begin : begin + TILE], j[begin : begin + TILE], x, short, text, inside, label, first, last, passage, percent)
    return label, first, last


def _join(i, j, x, short, text, inside, label, first, last, passage: int, percent: int) -> None:
    """Compare rows ``i`` with rows ``j`` where that could change labels or reach, and change them."""
    n = passage - WORDS + 1
    least = -(-2 * n * percent // (100 + percent))
    a, b = short[i], short[j]
    same, later, earlier = a == b, a[:, :-1] == b[:, 1:], a[:, 1:] == b[:, :-1]
    matched = same.copy()
    matched[:, :-1] |= later
    matched[:, 1:] |= earlier
    low, high = _reach(matched, inside[i], n, least)
    matched = same
    matched[:, 1:] |= later
    matched[:, :-1] |= earlier
    low_j, high_j = _reach(matched, inside[j], n, least)
    known = (label[j] == label[i]) & (low >= first[i]) & (high <= last[i]) & (low_j >= first[j]) & (high_j <= last[j])
    open_ = (low <= high) & ~known
    i, j = i[open_], j[open_]
    row, begins, ends, shift = _similar(x[i], x[j], text[i], text[j], passage, percent)
    i, j = i[row], j[row]
    np.minimum.at(first, i, begins)
    np.maximum.at(last, i, ends)
    np.minimum.at(first, j, begins + shift)
    np.maximum.at(last, j, ends + shift)
    _unite(label, i, j)


def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give the rows ``i`` and ``j``, and what hangs together with them, a common label."""
    a, b = label[i], label[j]
    while (a != b).any():
        to = np.arange(len(label))
        np.minimum.at(to, np.maximum(a, b), np.minimum(a, b))
        while (to[to] != to).any():
            to = to[to]
        label[:] = to[label]
        a, b = label[i], label[j]


def keyed(passage: int, percent: int) -> bool:
    """Whether ``connect_keyed`` knows all ways in which passages can be similar: no more of their shingles differ than one word touches."""
    n = passage - WORDS + 1
    return n - -(-2 * n * percent // (100 + percent)) <= WORDS


class _Runs:
    """Fingerprints of any stretches of rows of words, which say what words stand at which places, and in which group."""

    def __init__(self, contexts: list[np.ndarray], group: np.ndarray):
        self.group = mix(group.astype(np.uint64))
        powers = _powers(_BASE, contexts[0].shape[1])
        self.sums = np.zeros((len(powers) + 1, len(group)), np.uint64)
        at = 0
        for part in (c[i : i + TILE] for c in contexts for i in range(0, len(c), TILE)):
            np.cumsum(mix(part.T.astype(np.uint64)) * powers[:, None], axis=0, out=self.sums[1:, at : at + len(part)])
            at += len(part)

    def plain(self, rows: np.ndarray, begin: int, end: int) -> np.ndarray:
        return self.sums[end][rows] - self.sums[begin][rows]

    def of(self, rows: np.ndarray, *stretches: tuple[int, int]) -> np.ndarray:
        out = self.group[rows]
        for begin, end in stretches:
            out += self.plain(rows, begin, end)
        return out


def _alike(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys that occur several times, key by key, and for each of them the first place of its key."""
    order = np.argsort(keys)
    new = _differs(keys[order])
    several = ~(new & np.append(new[1:], True))
    heads = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    return order[several], heads[several]


def _across(keys: np.ndarray, split: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``_alike``, of the keys that occur both before the place ``split`` and from it on."""
    at, head = _alike(keys)
    new = _differs(head)
    of = np.cumsum(new) - 1
    early = np.bincount(of, weights=at < split)
    both = ((early > 0) & (early < np.bincount(of)))[of]
    return at[both], head[both]


def _slipped(context: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of words with a word less in a run of equal words beside the gram, what lies farther out moved by one: (words, row, end, start).

    ``end`` is that of a run before the gram, 0 without, ``start`` that of one after it, or the width. Where ``WORDS`` words of the run are left,
    the row has the same shingles as before.
    """
    size = context.shape[1]
    same = context[:, 1:] == context[:, :-1]
    long = same[:, WORDS - 1 :].copy()
    for k in range(WORDS - 1):
        long &= same[:, k : size - WORDS + k]
    having = np.flatnonzero(long.any(axis=1))
    context = context[having]
    new = np.ones((len(context), size + 1), bool)
    new[:, 1:size] = context[:, 1:] != context[:, :-1]
    row, start = np.nonzero(new)
    inner = row[1:] == row[:-1]
    row, start, end = row[:-1][inner], start[:-1][inner], start[1:][inner]
    used = (end - start > WORDS) & (context[row, start] >= 0)
    row, start, end = row[used], start[used], end[used]
    place = np.arange(size)
    some = (start > 0) & (start < BEFORE)
    rows, run, cut = row[some], end[some], np.minimum(end[some], BEFORE)
    moved = np.where(place < cut[:, None], np.roll(context[rows], 1, axis=1), context[rows])
    moved[:, 0] = -1
    found = [(moved, rows, run, np.full(len(rows), size))]
    some = (end > BEFORE + GRAM) & (end < size)
    start, row = start[some], row[some]
    cut = np.maximum(start, BEFORE + GRAM)
    first, after = (np.searchsorted(row, np.arange(len(context)), side) for side in ("left", "right"))
    for words_, of, ended in ((context, np.arange(len(context)), np.zeros(len(context), np.int64)), (moved, rows, run)):
        times = (after - first)[of]
        each = np.repeat(np.arange(len(of)), times)
        at = first[of][each] + np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
        again = np.where(place >= cut[at][:, None], np.roll(words_[each], -1, axis=1), words_[each])
        again[:, -1] = -1
        found.append((again, of[each], ended[each], start[at]))
    words_, of, run_end, run_start = map(np.concatenate, zip(*found))
    return words_, having[of], run_end, run_start


def connect_keyed(context: np.ndarray, group: np.ndarray, starts: range, passage: int, percent: int) -> tuple[np.ndarray, ...]:
    """As ``connect`` of all rows of a group with each other, for windows that begin at ``starts``, by sorting rows instead of comparing pairs.

    ``passage`` words that are similar differ in ``WORDS`` shingles at most, and there are three ways for that. They agree in all but a few
    words at their ends (``ends``); in all but one word (``changed``); or one of them is the other with a word put in (``added``), one at an end
    left out. Where a word stands several times in a row, one more or less changes no shingle, so rows with one less count too (``_slipped``).
    For each window there are fingerprints that just the rows share that are alike in one of these ways. For a word inside, the side of
    the gram that holds it is halved until one place is left, and a row goes on only with rows that agree outside that half. Rows alike
    are joined with one of them, so the work grows as n log n with the rows. In texts that are nearly all runs, windows can be similar in
    further ways (runs that differ by two words, several runs and a word at once), which are not looked for here.
    """
    size = context.shape[1]
    slack = (n := passage - WORDS + 1) - -(-2 * n * percent // (100 + percent))
    text = np.ascontiguousarray(context.T >= 0)
    windows = size - passage + 1
    inside = np.zeros((windows + 2, len(context)), bool)  # from a window before the first one on
    inside[1:-1] = text[:windows] & text[passage - 1 : passage - 1 + windows]
    label, first, last = np.arange(len(context)), np.full(len(context), size), np.full(len(context), -1)
    forth, back = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    moved, of, *runs_at = _slipped(context)
    owner = np.append(np.arange(len(context)), of)
    run_end, run_start = (np.append(np.full(len(context), none), x) for none, x in zip((0, size), runs_at))
    left, right = run_end > 0, run_start < size
    kind = left + 2 * right
    runs = _Runs([context, moved], group[owner])
    del moved
    links: list[tuple[np.ndarray, np.ndarray]] = []

    def found(rows: np.ndarray, heads: np.ndarray, start: np.ndarray) -> None:
        mine = owner[rows]
        np.minimum.at(first, mine, start)
        np.maximum.at(last, mine, start)
        links.append((mine, owner[heads]))

    def alike(keys: np.ndarray, rows: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``rows`` that share a key with another one, and one of each key. ``need`` are the sides on which some must have a word less."""
        at, head = _alike(keys)
        if need and len(at):  # the same row may be there several times
            of = np.cumsum(_differs(head)) - 1
            kinds = kind[rows[at]]
            some = np.zeros(of[-1] + 1, np.int64)
            np.bitwise_or.at(some, of, kinds)
            keep = some[of] == need
            if need == 3:  # those as they are agree with one that has a word less on both sides only
                whole = np.bincount(of, weights=kinds == 3) > 0
                keep &= (kinds > 0) | whole[of]
            at, of = at[keep], of[keep]
            mine = owner[rows[at]]
            head = mine[np.maximum.accumulate(np.where(_differs(of), np.arange(len(at)), 0))]
            keep = np.bincount(of, weights=mine != head)[of] > 0
            at, of = at[keep], of[keep]
            new = _differs(of)
            head = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        return rows[at], rows[head]

    def begin(s: int, rows: np.ndarray, need: int) -> np.ndarray:
        """Where the windows of rows start that hold the words from ``s`` on, without those that are too many; -1 for none."""
        mine = owner[rows]
        earlier = s - ((need >> 1) - right[rows])
        later = s + ((need & 1) - left[rows])
        beside = np.where(inside[earlier + 1, mine], earlier, np.where(inside[later + 1, mine], later, -1))
        return np.where(inside[s + 1, mine], s, beside)

    def cut_within(rows: np.ndarray, low: int, high: int) -> np.ndarray:
        """Whether the runs that have a word less keep enough words between two places."""
        return (~left[rows] | (run_end[rows] - low >= WORDS)) & (~right[rows] | (high - run_start[rows] >= WORDS))

    def ends(low: int, high: int, rows: np.ndarray, at: np.ndarray, need: int) -> None:
        rows, _ = alike(runs.of(rows, (low + slack, high - slack)), rows, need)
        for e in range(slack + 1 if len(rows) else 0):
            some = rows[cut_within(rows, low + e, high - slack + e)]
            some, heads = alike(runs.of(some, (low + e, high - slack + e)), some, need)
            found(some, heads, at[some])

    def ends_beside(s: int) -> None:
        """Rows whose text ends with the window at ``s``, and rows whose text begins with the next window."""
        a, b = np.flatnonzero(inside[s + 1] & ~inside[s + 2]), np.flatnonzero(inside[s + 2] & ~inside[s + 1])
        rows = np.append(a, b)
        for e in range(1, slack + 1 if len(a) and len(b) else 0):
            at, head = _across(runs.of(rows, (s + e, s + e + passage - slack)), len(a))
            found(rows[at], rows[head], s + (at >= len(a)))

    def changed(low: int, high: int, p: int, q: int, rows: np.ndarray, at: np.ndarray, need: int) -> None:
        rows, _ = alike(runs.of(rows, (low, p), (q, high)), rows, need)
        if len(rows) * (q - p) > TOGETHER and q - p > 1:
            changed(low, high, p, (p + q) // 2, rows, at, need)
            changed(low, high, (p + q) // 2, q, rows, at, need)
        elif len(rows):
            keys = [runs.of(rows, (low, x), (x + 1, high)) + salt[x] for x in range(p, q)]
            some, heads = alike(np.concatenate(keys), np.tile(rows, q - p), need)
            found(some, heads, at[some])

    def fewer(s: int, before: bool, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of one word less than a window at ``s``, those of a run's word less among them, and where their own windows begin."""
        low, high = s + before, s + passage - 1 + before
        beside = s + 1 if before else s - 1
        found = [(rows, np.full(len(rows), s)), (some := np.flatnonzero(inside[beside + 1] & ~inside[s + 1]), np.full(len(some), beside))]
        for side, run in ((1, run_end - low), (2, high - run_start)):
            at = s if before == (side == 1) else beside
            some = np.flatnonzero((kind == side) & (run >= WORDS) & inside[at + 1][owner])
            found.append((some, np.full(len(some), at)))
        return tuple(map(np.concatenate, zip(*found)))

    def added(s: int, p: int, q: int, longer: np.ndarray, shorter: np.ndarray, at_s: np.ndarray, before: bool) -> None:
        def without(p: int, q: int) -> np.ndarray:
            if before:
                return runs.of(longer, (q, s + passage)) + runs.plain(longer, s, p) * forth
            return runs.of(longer, (s, p)) + runs.plain(longer, q, s + passage) * back

        outside = ((s + 1, p + 1), (q, s + passage)) if before else ((s, p), (q - 1, s + passage - 1))
        at, _ = _across(np.append(without(p, q), runs.of(shorter, *outside)), len(longer))
        if not len(at):
            return
        keep = at[at >= len(longer)] - len(longer)
        longer, shorter, at_s = longer[at[at < len(longer)]], shorter[keep], at_s[keep]
        if len(longer) * (q - p) > TOGETHER and q - p > 1:
            added(s, p, (p + q) // 2, longer, shorter, at_s, before)
            added(s, (p + q) // 2, q, longer, shorter, at_s, before)
            return
        rows = np.append(np.tile(longer, q - p), shorter)
        split = len(rows) - len(shorter)
        keys = [*(without(x, x + 1) for x in range(p, q)), runs.of(shorter, (s + before, s + passage - 1 + before))]
        at, head = _across(np.concatenate(keys), split)
        of = np.cumsum(_differs(head)) - 1
        keep = np.bincount(of, weights=owner[rows[at]] != owner[rows[head]])[of] > 0 if len(at) else of > 0
        at, head = at[keep], head[keep]
        found(rows[at], rows[head], np.append(np.full(split, s), at_s)[at])

    salt = mix(np.arange(1, size + 1, dtype=np.uint64))
    place = np.full(len(owner), -1)
    for s in starts:
        for need in range(4):
            rows = np.flatnonzero(kind & ~need == 0)
            if need and not (kind[rows] == need).any() and not (need == 3 and len(rows) > len(context)):
                continue
            low, high = s + (need & 1), s + passage - (need >> 1)
            place[rows] = begin(s, rows, need)
            rows = rows[cut_within(rows, low, high) & (place[rows] >= 0)]
            whole = runs.of(rows, (low, high))
            some, heads = alike(whole, rows, need)
            found(some, heads, place[some])
            some, heads = _alike(whole + kind[rows].astype(np.uint64))
            other = np.ones(len(rows), bool)
            other[some[some != heads]] = False
            rows = rows[other]  # one of each stretch
            ends(low, high, rows, place, need)
            if not need and s + 1 < windows:
                ends_beside(s)
            if slack < WORDS:
                continue
            for p, q in ((low + WORDS, BEFORE), (BEFORE + GRAM, high - WORDS)):
                if p < q:
                    changed(low, high, p, q, rows, place, need)
                    if not need:
                        added(s, p, q, rows, *fewer(s, q == BEFORE, rows), q == BEFORE)
        a, b = (np.concatenate(x) for x in zip(*links))
        links.clear()
        _unite(label, a, b)
    return label, first, last


_RANGE = "token long, k1 long, k2 long, from long, to long"


def _compared(passage: int, percent: int):
    """Ranges of similar passages, from groups of contexts, or what they are dealt as (block, k1, k2, word, after, before, left, right, part, parts)."""
    names = [c.split()[0] for c in _RANGE.split(", ")]
    windows = BEFORE + AFTER - passage + 1

    def batch(token: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), *map(pa.array, columns)], names=names)

    def reached(own, block, k1, k2, word, label, first, last) -> Iterator[pa.RecordBatch]:
        some = first <= last
        own, label = own[some], label[some]
        token = mix(block[own].view(np.uint64) + label.astype(np.uint64) * np.uint64(_BASE))
        begin = word[own] - BEFORE
        yield batch(token, k1[own], k2[own], begin + first[some], begin + last[some] + passage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_key(batches, "block"):
            table = table.combine_chunks()
            block, k1, k2, word = (table.column(c).to_numpy() for c in ("block", "k1", "k2", "word"))
            left, right = (table.column(c).to_numpy(zero_copy_only=False) for c in ("left", "right"))
            after, before = (table.column(c).combine_chunks() for c in ("after", "before"))
            context = np.concatenate([_matrix(before, BEFORE, 1)[:, ::-1], _matrix(after, AFTER, 2)], axis=1)
            edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
            sizes = np.diff(edges)
            of = np.repeat(sizes, sizes)
            for k in range(1, min(SMALL, int(sizes.max()))):  # small groups, all at once
                x = np.flatnonzero((block[k:] == block[:-k]) & (of[k:] <= SMALL))
                x = x[(left[x] & right[x + k]) | (right[x] & left[x + k])]
                for at in range(0, len(x), 20_000):
                    i = x[at : at + 20_000]
                    row, first, last, shift = similar(context[i], context[i + k], passage, percent)
                    i, j = i[row], i[row] + k
                    a, b = word[i] - BEFORE + first, word[j] - BEFORE + first + shift
                    length = last - first + passage
                    token = np.zeros(len(i), np.uint64)
                    for c in (k1[i], k2[i], a, k1[j], k2[j], b, length):
                        token = mix(token * np.uint64(_BASE) + c.astype(np.int64).view(np.uint64))
                    yield batch(token, k1[i], k2[i], a, a + length)
                    yield batch(token, k1[j], k2[j], b, b + length)
            part, parts = (table.column(c).to_numpy() for c in ("part", "parts"))
            large = sizes > (BLOCK if keyed(passage, percent) else table.num_rows)
            for start, n in zip(edges[:-1][(sizes > SMALL) & ~large], sizes[(sizes > SMALL) & ~large]):
                own = np.arange(start, start + n)
                compared = connect(context[own], np.flatnonzero(left[own]), np.flatnonzero(right[own]), passage, percent)
                yield from reached(own, block, k1, k2, word, *compared)
            whole = np.flatnonzero(np.repeat(large, sizes) & (parts == 1))
            if len(whole):
                compared = connect_keyed(context[whole], block[whole], range(windows), passage, percent)
                yield from reached(whole, block, k1, k2, word, *compared)
            for start, n in zip(edges[:-1][large], sizes[large]):
                if parts[start] > 1:
                    own = slice(start, start + n)
                    starts = range(part[start], windows, parts[start])
                    compared = connect_keyed(context[own], block[own], starts, passage, percent)
                    yield from reached(np.arange(start, start + n), block, k1, k2, word, *compared)

    return run


def ranges(docs: DataFrame, key: str, text: str, percent: int = PERCENT) -> DataFrame:
    """(token, k1, k2, from, to): stretches of words, ends exclusive. Those of one token are similar passages, in at least two places.
    ``k1`` is the key, ``k2`` a hash of the text."""
    rows = docs.select(F.col(key).cast("long").alias("k1"), F.xxhash64(text).alias("k2"), F.col(text).alias("text"))
    rows = rows.where(F.col("k1").isNotNull() & F.col("text").isNotNull())
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(partitions, size // 64_000_000)
    met = stage(_dealt(rows, _centers, size / 50, buckets).mapInArrow(_meet, _MEETING), "met")
    open_ = met.where("open").groupBy("k1", "k2").agg(F.collect_list(F.struct("gram", "word")).alias("open"))
    around = stage(rows.join(open_, ["k1", "k2"]).select("k1", "k2", "text", "open").mapInArrow(_contexts, _CONTEXT), "contexts")
    crowded = around.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    if keyed(PASSAGE, percent):
        n_parts = F.least(F.ceil(F.col("n") / PART), F.lit(BEFORE + AFTER - PASSAGE + 1))
        crowded = stage(crowded.where(F.col("n") > PART).select("gram", n_parts.cast("int").alias("parts")), "crowded")
        blocks = around.join(crowded, "gram", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        block, sides = F.xxhash64("gram", "part"), [F.lit(True).alias("left"), F.lit(True).alias("right")]
    else:
        crowded = crowded.where(F.col("n") > BLOCK).select("gram", F.ceil(F.col("n") / BLOCK).alias("_blocks"))
        blocks = around.join(stage(crowded, "crowded"), "gram", "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1).cast("long")))
        blocks = blocks.withColumn("_own", F.pmod(F.xxhash64("k1", "k2", "word"), "_blocks"))
        blocks = blocks.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        blocks = blocks.withColumn("part", F.lit(0)).withColumn("parts", F.lit(1))
        block = F.xxhash64("gram", F.least("_own", "_other"), F.greatest("_own", "_other"))
        sides = [(F.col("_own") <= F.col("_other")).alias("left"), (F.col("_own") >= F.col("_other")).alias("right")]
    blocks = blocks.select(block.alias("block"), "k1", "k2", "word", "after", "before", *sides, "part", "parts")
    dealt = blocks.repartition("block").sortWithinPartitions("block", "after", "before", "k1", "k2", "word")
    similar_ones = stage(dealt.mapInArrow(_compared(PASSAGE, percent), _RANGE), "similar")
    left = F.col("word") - F.floor(F.col("shape") / 128)
    equal = met.where("same").select(
        "token", "k1", "k2", left.alias("from"), (left + F.col("shape") % 128).alias("to")
    )
    place = F.struct("k1", "k2", "from")
    spread = equal.groupBy("token").agg(F.min(place).alias("_a"), F.max(place).alias("_b")).where("_a != _b").select("token")
    equal = equal.join(stage(spread, "classes"), "token")
    return stage(equal.unionByName(similar_ones), "ranges")


def repeated_passages(docs: DataFrame, key: str, text: str, percent: int = PERCENT) -> DataFrame:
    """Passages of ``PASSAGE`` words and more that occur in several documents: (key, start_word, end_word, class_id, n_links, first).

    Overlapping ranges of a document are one passage. Passages that are linked, directly or through others, form a class;
    ``class_id`` is the smallest key in it, ``n_links`` the ranges found that the passage takes part in (what hangs
    together around a gram of many contexts is one), and ``first`` marks the passages of that key. Ends are exclusive. Documents without shared passages have no row.

    NULL and empty texts, and those shorter than a passage, share nothing; neither do rows with a NULL key. Rows of one key share
    nothing among each other: repeated rows count once, and different texts of a key have rows of their own. A text is
    hashed in one task whatever its length. Other columns are not looked at, and an empty table gives an empty one.
    """
    found = ranges(docs, key, text, percent)
    before = Window.partitionBy("k1", "k2").orderBy("from", "to", "token")
    reached = F.max("to").over(before.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.distinct().withColumn("_new", F.when(reached >= F.col("from"), 0).otherwise(1))
    numbered = marked.withColumn("_passage", F.sum("_new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    numbered = stage(numbered.withColumn("vertex", F.xxhash64("k1", "k2", "_passage")).drop("_new"), "passages")
    least = stage(numbered.groupBy("token").agg(F.min("vertex").alias("b")), "least")
    links = numbered.select("token", "vertex").join(least, "token").select(F.col("vertex").alias("a"), "b").distinct()
    connected = components(links).withColumnRenamed("id", "vertex")
    own = numbered.groupBy("k1", "vertex").agg(
        F.min("from").alias("start_word"), F.max("to").alias("end_word"), F.count(F.lit(1)).alias("n_links")
    )
    classed = stage(own.join(connected, "vertex", "left").withColumn("component", F.coalesce("component", "vertex")), "classed")
    smallest = classed.groupBy("component").agg(F.min("k1").alias("class_id"), F.max("k1").alias("_last"))
    smallest = stage(smallest.where("class_id != _last").drop("_last"), "smallest")
    return classed.join(smallest, "component").select(
        F.col("k1").alias(key), "start_word", "end_word", "class_id", "n_links", (F.col("k1") == F.col("class_id")).alias("first")
    )

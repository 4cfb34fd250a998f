"""Quality rules on repeated text, from suffix arrays.

All suffixes of a text, at word starts, are sorted by doubling prefixes; suffixes that differ from all others drop out of
the next round. Neighbours in that order share the longest prefixes, so the longest-common-prefix values on both sides of
a suffix bound the deepest interval it lies in, and the larger one is the length of the maximal repeated substring that
starts there. The spans of all maximal repeats of at least ``MIN_REPEAT`` words are united: the share of words they
cover, and the longest repeat, have limits. Texts are sorted many at a time in one array.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from risklake.llm.common import WORD, slices

#: shortest repeat that counts, in words; a power of two
MIN_REPEAT = 8
#: a text fails with more than this share of its words in repeats, or with a longer repeat
MAX_COVERED, MAX_LONGEST = 0.3, 100
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: bytes of text that are sorted together
CHUNK = 2_000_000
SYMBOLS = "#*$%&|<>"

_word = re.compile(WORD)
FIGURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "repeat_covered", "longest_repeat",
]


def _refine(rank: np.ndarray, at: np.ndarray, follow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Split the buckets of ``rank`` at places ``at`` by the key ``follow``; returns the new ranks and the places that
    still share a bucket. A rank is the number of suffixes in the buckets before."""
    if not len(at):
        return rank, at
    key = rank[at].astype(np.int64) * (len(rank) + 2) + follow + 1
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    old = rank[at]
    first = np.r_[True, key[1:] != key[:-1]]
    bucket = np.r_[True, old[1:] != old[:-1]]
    place = np.arange(len(at))
    inside = place - np.maximum.accumulate(np.where(bucket, place, 0))
    starts = np.maximum.accumulate(np.where(first, place, 0))
    out = rank.copy()
    out[at] = old + inside[starts]
    alone = first & np.r_[first[1:], True]
    return out, at[~alone]


def _spread(at: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in the spans of ``length`` that start at ``at``."""
    edges = np.bincount(at, minlength=n + 1) - np.bincount(at + length, minlength=n + 1)
    return np.cumsum(edges[:n]) > 0


def repeats(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: words in repeated 3-word windows, words covered by maximal repeats of at least ``MIN_REPEAT`` words, and the
    longest repeat. ``words`` holds the word numbers of all texts, one after the other; ``ends`` where each text ends.
    Repeats lie within one text and may overlap."""
    n, texts = len(words), len(ends)
    if not n:
        return (np.zeros(texts, np.int64),) * 3
    sizes = np.diff(np.r_[0, ends])
    text = np.repeat(np.arange(texts), sizes)
    end = ends[text]
    place = np.arange(n)

    def after(rank: np.ndarray, at: np.ndarray, h: int) -> np.ndarray:
        to = at + h
        return np.where(to < end[at], rank[np.minimum(to, n - 1)], -1)

    start = np.repeat(ends - sizes, sizes)
    one, active = _refine(start.astype(np.int32), place, words.astype(np.int64))
    two, active = _refine(one, active, after(one, active, 1))
    # windows of three words
    three, shared = _refine(two, active, after(one, active, 2))
    shared = shared[shared + 3 <= end[shared]]
    in_windows = _spread(shared, 3, n)
    # longer prefixes
    levels, h, rank = [one, two], 2, two
    while len(active):
        rank, active = _refine(rank, active, after(rank, active, h))
        h *= 2
        levels.append(rank)
        if h == MIN_REPEAT:
            candidates = active
    covered, longest = np.zeros(texts, np.int64), np.zeros(texts, np.int64)
    if h > MIN_REPEAT and len(candidates):
        suffixes = candidates[np.argsort(rank[candidates], kind="stable")]
        eight = levels[MIN_REPEAT.bit_length() - 1]
        left, right = suffixes[:-1], suffixes[1:]
        common = np.where(eight[left] == eight[right], MIN_REPEAT, 0)
        pairs = np.flatnonzero(common)
        left, right = left[pairs], right[pairs]
        length = np.zeros(len(pairs), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            a, b = left + length, right + length
            inside = (a < end[left]) & (b < end[right])
            r = levels[level]
            equal = inside & (r[np.minimum(a, n - 1)] == r[np.minimum(b, n - 1)])
            length += np.where(equal, 1 << level, 0)
        common[pairs] = length
        deepest = np.maximum(np.r_[0, common], np.r_[common, 0])
        kept = deepest >= MIN_REPEAT
        covered = np.bincount(text[_spread(suffixes[kept], deepest[kept], n)], minlength=texts)
        np.maximum.at(longest, text[suffixes], deepest)
    return np.bincount(text[in_windows], minlength=texts), covered, longest


def _lines(text: str) -> int:
    seen: set[str] = set()
    copies = 0
    for line in text.split("\n"):
        if line in seen:
            copies += 1
        elif _word.search(line):
            seen.add(line)
    return copies


def _measure(texts: list[str | None]) -> list[pa.Array]:
    """Figures of some texts, in their order: a column each."""
    numbers: dict[str, int] = {}
    flat: list[np.ndarray] = []
    rows = []
    for text in texts:
        found = _word.findall(text or "")
        flat.append(np.fromiter([numbers.setdefault(w, len(numbers)) for w in found], np.int64, len(found)))
        chars = sum(map(len, found))
        rows.append((len(found), chars, sum(map((text or "").count, SYMBOLS)), _lines(text or "")))
    base = np.array(rows, np.int64).reshape(len(rows), 4)
    three, covered, longest = repeats(np.concatenate(flat) if flat else np.zeros(0, np.int64), np.cumsum(base[:, 0]))
    columns = [*base.T, three, covered, longest]
    return [pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns]


def _figures(text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_at, CHUNK):
                figures = _measure(part.column(text_at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, *figures], names=names)

    return run


def with_figures(df: DataFrame, text: str) -> DataFrame:
    """Add the ``FIGURES`` to every row; columns of these names are replaced.

    NULL and empty texts have zeros. Rows are handled one by one, so equal rows get equal figures.
    """
    df = df.drop(*FIGURES)
    schema = T.StructType([*df.schema, *(T.StructField(c, T.LongType()) for c in FIGURES)])
    return df.mapInArrow(_figures(df.columns.index(text), df.columns + FIGURES), schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def kept() -> Column:
    """Verdict over the figures: the base rules hold, and repeats cover little and stay short."""
    return (
        ~base_failed()
        & (F.col("repeat_covered") <= MAX_COVERED * F.col("n_words"))
        & (F.col("longest_repeat") <= MAX_LONGEST)
    )

"""Sets of word shingles as 64-bit hashes, many texts at a time."""

import numpy as np
import pyarrow as pa

#: fixed random numbers: one per byte, with the blanks (tab to carriage return, space) as 0, and odd factors
_random = np.random.RandomState(20240229)
_BYTES = _random.randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(4) + np.uint64(1)
_BYTES[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_BYTES[[9, 10, 11, 12, 13, 32]] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def words(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts (A-Z as a-z), and the number of words of each text.

    Words are runs of bytes other than tab to carriage return and space; the hash is a polynomial over their bytes.
    """
    buffer = texts.buffers()[2]
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    raw = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]]
    borders = offsets - offsets[0]
    values = _BYTES[raw]
    inside = values != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = borders[:-1][np.diff(borders) > 0]
    begins[edges] = inside[edges]  # a text begins a word, whatever byte lies before it
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    at = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw)))) if starts[0] == 0 else None
    if at is None:
        lengths = np.diff(np.concatenate([[0], starts, [len(raw)]]))
        at = np.arange(len(raw)) - np.repeat(np.concatenate([[0], starts]), lengths)
    hashes = np.add.reduceat(values * _powers(int(at.max()) + 1)[at], starts)
    count = np.searchsorted(starts, borders)
    return mix(hashes), np.diff(count)


def shingles(texts: pa.StringArray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``n`` words of each text, sorted, one text after the other, and their number.

    A text with fewer words has its whole sequence as its only shingle, a text without words none.
    """
    word, counts = words(texts)
    if not len(word):
        return np.zeros(0, np.uint64), counts
    text = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(word))  # words from here to the end of the text
    first = np.r_[True, text[1:] != text[:-1]]
    take = (left >= n) | first
    length = np.minimum(left, n)
    hashes = np.zeros(len(word), np.uint64)
    for k in range(n):
        more = length > k
        shifted = np.zeros(len(word), np.uint64)
        shifted[: len(word[k:])] = word[k:]
        hashes = np.where(more, (hashes ^ shifted) * _STEP + np.uint64(k + 1), hashes)
    hashes, text = mix(hashes[take]), text[take]
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(text[order].astype(np.uint16) if len(counts) < 1 << 16 else text[order], kind="stable")]
    hashes, text = hashes[order], text[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])]
    hashes, text = hashes[new], text[new]
    return hashes, np.bincount(text, minlength=len(counts))

"""Token counts by rank-synchronous merging.

Pre-tokens are held as one ragged array of symbols. In each round every sequence finds its pair of lowest rank and merges
all places of it at once; sequences without a known pair leave the array. The symbols that survive are the tokens. Each
different pre-token is merged once, in batches.
"""

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from risklake.llm.common import per_worker, slices

#: characters whose case folding, composition and classes are the same everywhere; other texts go through the library
_unusual = re.compile("[^\t\n\r\x20-\x7e\xa1-įı-ſ‐-‧]")
_LETTERS, _DIGITS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ", "0-9\xb2\xb3\xb9\xbc-\xbe"
_pieces = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_DIGITS}]|[^\s{_LETTERS}{_DIGITS}]+")
#: characters looked at together, and pre-tokens remembered by a worker
CHUNK, REMEMBERED = 1_000_000, 800_000
LIMIT = 2048


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 stands for itself, the
    other bytes follow from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Merges:
    """Merge rules as sorted arrays."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        self.width = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys)
        self.keys, self.rank, self.merged = keys[order], order.astype(np.int32), merged[order]
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int32)
        self.final = np.array([vocab[s + suffix] for s in symbols], np.int32)

    def count(self, words: list[str]) -> np.ndarray:
        """Symbols that survive in each word."""
        encoded = [w.encode() for w in words]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        raw = np.frombuffer(b"".join(encoded), np.uint8)
        symbols = self.inner[raw]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.final[raw[last]]
        sequence = np.repeat(np.arange(len(words)), sizes)
        counts = sizes.copy()
        none = np.iinfo(np.int32).max
        while len(symbols):
            key = symbols[:-1].astype(np.int64) * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (sequence[:-1] == sequence[1:])
            rank = np.append(np.where(known, self.rank[at], none), none)
            starts = np.flatnonzero(np.r_[True, sequence[1:] != sequence[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(symbols))))
            chosen = (rank == lowest) & (rank < none)
            # a run of equal pairs overlaps: every other one merges, from the left
            place = np.arange(len(symbols))
            begin = chosen & ~np.r_[False, chosen[:-1]]
            chosen &= (place - np.maximum.accumulate(np.where(begin, place, 0))) % 2 == 0
            left = np.flatnonzero(chosen)
            symbols[left] = self.merged[at[left]]
            stay = lowest < none
            stay[left + 1] = False
            np.subtract.at(counts, sequence[left], 1)
            symbols, sequence = symbols[stay], sequence[stay]
        return counts


class Counter:
    """Counts the tokens of texts as the vocabulary file defines them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.merges = Merges(model["model"]["vocab"], model["model"]["merges"], model["model"]["end_of_word_suffix"] or "")
        special = [t["content"] for t in model["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.byte_of = {s: bytes([b]) for b, s in enumerate(byte_symbols())}
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens of a text, some at a time."""
        at = 0
        while at < len(text):
            to = at + CHUNK
            if to < len(text):  # no pre-token spans a blank
                to = text.find(" ", to)
                to = len(text) if to < 0 else to
            part = text[at:to]
            at = to
            if not _unusual.search(part):
                yield _pieces.findall(part.lower())
            else:
                normal = self.library.normalizer.normalize_str(part)
                found = self.library.pre_tokenizer.pre_tokenize_str(normal)
                yield [b"".join(map(self.byte_of.__getitem__, s)).decode() for s, _ in found]

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        fresh = list(words)
        self.known.update(zip(fresh, self.merges.count(fresh).tolist()))

    def count(self, texts: list[str]) -> list[int]:
        found: list[list[str]] = []
        owner: list[int] = []
        counts = [0] * len(texts)
        held = 0

        def settle() -> None:
            for lot in (found[i : i + 64] for i in range(0, len(found), 64)):
                fresh = set().union(*lot)
                if missing := fresh.difference(self.known):
                    self.learn(missing if len(self.known) + len(missing) <= REMEMBERED else fresh)
                for i, words in zip(owner, lot):
                    counts[i] += sum(map(self.known.__getitem__, words))
                del owner[: len(lot)]
            found.clear()

        for i, text in enumerate(texts):
            segments = [text]
            if self.special and "<" in text:
                segments = self.special.split(text)
                counts[i] += len(segments) - 1
            for segment in segments:
                for words in self.pieces(segment):
                    found.append(words)
                    owner.append(i)
                    held += len(words)
                    if held > CHUNK // 4:
                        settle()
                        held = 0
        settle()
        return counts


def _counted(path: str, text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counter = per_worker(("counter", path), lambda: Counter(path))
            for part in slices(batch, text_at, 4 * CHUNK):
                counts = counter.count([t or "" for t in part.column(text_at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(counts, pa.int64())], names=names)

    return run


def with_tokens(df: DataFrame, text: str, path: str, column: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of ``text`` to every row, in place of a column of that name.

    ``path`` is a vocabulary file that every executor has. Special strings inside texts count as one token, as the
    library takes them by default. NULL and empty texts have no tokens.
    """
    df = df.drop(column)
    schema = T.StructType([*df.schema, T.StructField(column, T.LongType())])
    return df.mapInArrow(_counted(path, df.columns.index(text), [*df.columns, column]), schema)

"""Alignment of the tokens of two tokenizers, A (byte-level) and B (pieces with byte fallback).

Both cut the same bytes. The offsets where a token of A and one of B end cut a text into groups; the tokens that end a group are
linked. An array of vocabulary length, computed once, tells for each id of A the id of B with the same bytes. Links of that kind are
exact one-to-one groups nearly always, and are counted in vectors of vocabulary length, one per task. Only the other, irregular
links enter a shuffle of pairs.

Texts are taken in blocks. A block knows its irregular pairs by number, so that one row per block and different pair goes through the
shuffle, and comes back with the count of that pair in all documents.
"""

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from risklake.llm.common import per_worker, slices
from risklake.llm.token_counts import byte_symbols
from risklake.operators.stage import stage

#: bytes of text in a block, and pairs in one of its rows
BLOCK, LISTED = 4_000_000, 1000
#: units remembered by a worker and their characters, units learnt together, and units in one text for the libraries
REMEMBERED, HELD, LEARNT, JOINED = 200_000, 20_000_000, 10_000, 1000

#: Texts are cut into units where neither tokenizer continues a token: before a single blank that a non-blank follows, around a single line
#: break, before a full stop or comma after a letter or digit. A unit has lost its blank, ``_LINE`` is a line break and ``_BARE`` begins a
#: unit without a blank. Texts in which plain splitting can't tell such places from others are cut by ``_cuts``.
_LINE, _BARE = "\x01", "\x02"
_WORDLIKE = r"A-Za-z0-9\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{17f}"
_ODD = (
    r"[\x{01}\x{02}\x{0b}\x{0c}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{2581}\x{3000}]"
    rf"|[ \t\n\r][ \t\n\r]|^[ \t\n\r]|[ \t\r]\z|(?:^|[^{_WORDLIKE}])[.,]"
)
_cuts = re.compile("(?<![ ▁]) (?=\\S)")
_letters = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ſ]+")
_wordlike = re.compile("[A-Za-z0-9\xc0-\xd6\xd8-\xf6\xf8-ſ]")


def _raw(unit: str) -> str:
    """The part of the text that a unit stands for."""
    return "\n" if unit == _LINE else unit[1:] if unit[:1] == _BARE else " " + unit


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the identity map between them."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        with open(path_a, encoding="utf-8") as file:
            settings = json.load(file)
        cutting = settings["pre_tokenizer"] or {}
        if settings["normalizer"] or (cutting.get("type"), cutting.get("add_prefix_space"), cutting.get("use_regex", True)) != ("ByteLevel", False, True):
            raise ValueError(f"{path_a}: not a plain byte-level tokenizer")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of = {s: bytes([i]) for i, s in enumerate(byte_symbols())}
        self.n_a, self.n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        self.bytes_a = [b""] * self.n_a
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = b"".join(byte_of.get(c) or c.encode() for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.length_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        plain = [i for i in range(self.n_b) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        own = {self.bytes_b[i]: i for i in range(self.n_b) if self.b.is_byte(i)} | {self.bytes_b[i]: i for i in plain}
        #: id of B with the same bytes for each id of A, or -1
        self.same = np.array([own.get(t, -1) for t in self.bytes_a], np.int64)
        for i in plain:
            for left, right in zip(pieces[i], pieces[i][1:]):
                if right == "▁" != left or "\n" in (left, right) or (right in ".," and _wordlike.match(left)):
                    raise ValueError(f"{path_b}: {pieces[i]!r} spans a place where texts are cut")


class Aligner:
    """Aligns texts. Each different unit is encoded once."""

    def __init__(self, vocabularies: Vocabularies):
        self.v = vocabularies
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.written: list[str] = []
        self.held = 0
        #: per unit: tokens of A and B, groups, and whether both give its bytes
        self.figures = np.zeros((0, 4), np.int64)
        self.links, self.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _encoded(self, texts: list[str], whole: list[str]) -> tuple[list, list]:
        """Ids of A and B of texts; ``whole`` is what B is given."""
        ids_a = [e.ids for e in self.v.a.encode_batch_fast(texts, add_special_tokens=False)]
        ids_b = self.v.b.encode(whole, num_threads=1)
        # before a line break there are the blank that B adds, and the line break itself
        return ids_a, [ids[2:] if w[:1] == "\n" and t != " " + w else ids for t, w, ids in zip(texts, whole, ids_b)]

    def _learn(self, units: list[str]) -> None:
        plain = [u for u in units if _letters.fullmatch(u)]
        other = [u for u in units if not _letters.fullmatch(u)]
        lots = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        raws = [_raw(u) for u in other]
        texts = [" " + " ".join(lot) for lot in lots] + raws
        whole = [t[1:] for t in texts[: len(lots)]]
        whole += ["\n" + r if u == _LINE or u[:1] == _BARE else u for u, r in zip(other, raws)]
        ids_a, ids_b = self._encoded(texts, whole) if texts else ([], [])
        sizes = [len(u.encode()) + 1 for u in plain] + [len(r.encode()) for r in raws]
        right = np.ones(len(sizes), bool)
        for i, text in enumerate(texts):
            own = text.encode()
            if own != b"".join(map(self.v.bytes_a.__getitem__, ids_a[i])) or own != b"".join(map(self.v.bytes_b.__getitem__, ids_b[i])):
                if i < len(lots):
                    raise ValueError("letters are not encoded one by one")
                at = len(plain) + i - len(lots)
                sizes[at], right[at], ids_a[i], ids_b[i] = 0, False, [], []
        a = np.array([x for ids in ids_a for x in ids], np.int64)
        b = np.array([x for ids in ids_b for x in ids], np.int64)
        end_a, end_b, ends = np.cumsum(self.v.length_a[a]), np.cumsum(self.v.length_b[b]), np.cumsum(sizes)
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        last_a, last_b = np.searchsorted(end_a, common), np.searchsorted(end_b, common)
        names_a, names_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups, i, j = [], 0, 0
        for to_a, to_b in zip((last_a + 1).tolist(), (last_b + 1).tolist()):
            groups.append(",".join(names_a[i:to_a]) + "|" + ",".join(names_b[j:to_b]))
            i, j = to_a, to_b
        n = len(sizes)
        count = [np.bincount(np.searchsorted(ends, e), minlength=n) for e in (end_a, end_b, common)]
        edges = np.append(0, np.cumsum(count[2])).tolist()
        first = len(self.known)
        self.known.update(zip(plain + other, range(first, first + n)))
        self.written += [";".join(groups[x:y]) for x, y in zip(edges, edges[1:])]
        self.figures = np.concatenate([self.figures, np.column_stack([*count, right]).astype(np.int64)])
        self.links = np.concatenate([self.links, a[last_a] * self.v.n_b + b[last_b]])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(count[2])])
        self.held += sum(sizes)

    def _numbers(self, units: list[str]) -> np.ndarray:
        fresh = [u for u in units if u not in self.known]
        if fresh:
            if len(self.known) + len(fresh) > REMEMBERED or self.held > HELD:
                self._forget()
                fresh = units
            for at in range(0, len(fresh), LEARNT):
                self._learn(fresh[at : at + LEARNT])
        return np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))

    def _units(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of all texts, and where each text ends. Empty texts have none."""
        odd = pc.match_substring_regex(texts, _ODD)
        cut = texts
        for mark, put in (("\n", f" {_LINE} {_BARE}"), (".", f" {_BARE}."), (",", f" {_BARE},")):
            cut = pc.replace_substring(cut, mark, put)
        lists = pc.split_pattern(cut, " ")
        if pc.any(odd).as_py():
            parted = []
            for text, is_odd in zip(texts.to_pylist(), odd.to_pylist()):
                if not is_odd:
                    parted.append(None)
                    continue
                first, *rest = _cuts.split(" " + text)
                units = [first[1:], *rest] if first else rest
                parted.append([f"{_BARE} {u}" if u[0] in (_LINE, _BARE) else u for u in units])
            lists = pc.if_else(odd, pa.array(parted, lists.type), lists)
        lists = pc.if_else(pc.equal(texts, ""), pa.scalar([], lists.type), lists)
        offsets = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        return self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()], (offsets - offsets[0])[1:]

    def align(self, texts: pa.StringArray) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Per text (n_a, n_b, n_groups, n_links) and the digest of its groups; and the links of all texts, one after the other,
        as id of A times the size of B plus id of B."""
        numbers, ends = self._units(texts)
        n = len(ends)
        owner = np.repeat(np.arange(n), np.diff(ends, prepend=0))
        figures = self.figures[numbers]
        wrong = np.bincount(owner[figures[:, 3] == 0], minlength=n) > 0
        used = (figures[:, 2] > 0) & ~wrong[owner]
        numbers, owner, figures = numbers[used], owner[used], figures[used]
        edges = np.searchsorted(owner, np.arange(n + 1))
        sums = np.vstack([np.zeros((1, 4), np.int64), np.cumsum(figures, axis=0)])
        out = sums[edges[1:]] - sums[edges[:-1]]
        out[:, 3] = out[:, 2]  # tokens are not empty: one of each ends at an offset
        listed, written = numbers.tolist(), self.written.__getitem__
        digests = [
            hashlib.sha256(";".join(map(written, listed[x:y])).encode()).hexdigest() if y > x else ""
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist())
        ]
        size = self.starts[numbers + 1] - self.starts[numbers]
        to = np.cumsum(size)
        places = np.repeat(self.starts[numbers] - (to - size), size) + np.arange(int(to[-1]) if len(to) else 0)
        return out, digests, self.links[places]


FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
RESULT = [*FIGURES, "n_best", "count_sum"]


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, kind))


def _blocks(path_a: str, path_b: str):
    """Rows of documents; rows of the irregular pairs of their block, which documents name by their place; and at the end the
    regular links of the task, as ids of A with their counts, for block -1."""

    def listed(block: int, values: np.ndarray, counts: np.ndarray, like: pa.RecordBatch) -> pa.RecordBatch:
        size = np.diff(np.append(np.arange(0, len(values), LISTED), len(values)))
        columns = {c: pa.nulls(len(size), like.schema.field(c).type) for c in like.schema.names}
        columns["block"] = pa.array(np.full(len(size), block))
        columns |= {"pairs": _lists(values, size, pa.int64()), "often": _lists(counts, size, pa.int32())}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, docs, vector, aligner = TaskContext.get().partitionId() << 32, None, None, None
        for batch in batches:
            v = per_worker(("vocabularies", path_a, path_b), lambda: Vocabularies(path_a, path_b))
            if aligner is None:
                aligner, vector = Aligner(v), np.zeros(v.n_a, np.int64)
            for part in slices(batch, 1, BLOCK):
                figures, digests, links = aligner.align(pc.fill_null(part.column(1), ""))
                regular = v.same[links // v.n_b] == links % v.n_b
                owner = np.repeat(np.arange(len(figures)), figures[:, 3])
                pairs, at, often = np.unique(links[~regular], return_inverse=True, return_counts=True)
                a = links[regular] // v.n_b
                vector += np.bincount(a, minlength=v.n_a)
                n, own = len(figures), np.bincount(owner[regular], minlength=len(figures))
                columns = {
                    "block": pa.array(np.full(n, block)),
                    "key": part.column(0),
                    **{c: pa.array(figures[:, i]) for i, c in enumerate(FIGURES)},
                    "digest": pa.array(digests, pa.string()),
                    "regular": _lists(a, own, pa.int32()),
                    "irregular": _lists(at, figures[:, 3] - own, pa.int32()),
                    "pairs": pa.nulls(n, pa.list_(pa.int64())),
                    "often": pa.nulls(n, pa.list_(pa.int32())),
                }
                docs = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                yield docs
                yield listed(block, pairs, often, docs)
                block += 1
        if docs is not None:
            some = np.flatnonzero(vector)
            yield listed(-1, some, vector[some], docs)

    return run


def _settled(regular: np.ndarray, same: np.ndarray, best: np.ndarray, names: list[str]):
    """Rows of the documents of a block, from the counts of regular links, and of the block's own pairs."""

    def run(docs: pa.Table, counted: pa.Table) -> pa.Table:
        pair, count = counted["pair"].to_numpy(), counted["count"].to_numpy()
        order = np.argsort(pair)
        pair, count = pair[order], count[order]
        docs = docs.combine_chunks()
        sums = [np.zeros(docs.num_rows, np.int64) for _ in range(2)]
        for name, tops, counts in (("regular", regular == best[same], regular), ("irregular", count == best[pair % len(best)], count)):
            lists = docs[name].chunk(0)
            at = lists.flatten().to_numpy()
            edges = lists.offsets.to_numpy()
            edges = edges - edges[0]
            for into, values in zip(sums, (tops, counts)):
                total = np.append(0, np.cumsum(values[at], dtype=np.int64))
                into += total[edges[1:]] - total[edges[:-1]]
        columns = [docs["key"], *(docs[f] for f in FIGURES), *map(pa.array, sums), docs["digest"]]
        return pa.Table.from_arrays(columns, names=names)

    return run


def align(df: DataFrame, key: str, text: str, path_a: str, path_b: str) -> DataFrame:
    """Per row: ``key``, tokens of A and B, groups, links, how many links are the most frequent one of their id of B, the sum
    of the counts of all links, and ``groups_sha256`` over the groups as ``a1,a2|b1;a3|b2``.

    A encodes a blank and the text, B the text, to which it adds the blank; strings of special tokens are plain text. The count
    of a pair of ids is the number of links of it in all rows; ties for the highest are all highest. NULL and empty
    texts, and those whose bytes either tokenizer does not give back, have no tokens: zeros and ''. Rows are handled one by one: equal
    rows all count, keys may be NULL or occur twice. Other columns are not looked at. An empty table gives an empty one. A text is aligned in one
    task whatever its length, in memory of some dozen times its size. The files are such that every executor has them.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    v = Vocabularies(path_a, path_b)
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [T.StructField("block", T.LongType()), rows.schema["key"]]
        + [T.StructField(c, T.LongType()) for c in FIGURES]
        + [T.StructField("digest", T.StringType()), T.StructField("regular", ints), T.StructField("irregular", ints)]
        + [T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("often", ints)]
    )
    blocks = stage(rows.mapInArrow(_blocks(path_a, path_b), schema), "aligned")
    docs = blocks.where("digest is not null").drop("pairs", "often")
    listed = blocks.where("digest is null").select("block", F.explode(F.arrays_zip("pairs", "often")).alias("p")).select(
        "block", F.col("p.pairs").alias("pair"), F.col("p.often").alias("n")
    )
    # a row per id of A, at most
    regular = np.zeros(v.n_a, np.int64)
    for a, n in listed.where("block < 0").groupBy("pair").agg(F.sum("n")).collect():
        regular[a] = n
    pairs = listed.where("block >= 0")
    counted = stage(pairs.groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    # a row per id of B, at most
    best = np.zeros(v.n_b, np.int64)
    known = v.same >= 0
    np.maximum.at(best, v.same[known], regular[known])
    for b, n in counted.groupBy((F.col("pair") % v.n_b).alias("b")).agg(F.max("count")).collect():
        best[b] = max(best[b], n)
    found = pairs.drop("n").join(counted, "pair").select(F.col("block").alias("of"), "pair", "count")
    names = [key, *RESULT, "groups_sha256"]
    out = T.StructType(
        [T.StructField(key, rows.schema["key"].dataType)]
        + [T.StructField(c, T.LongType()) for c in RESULT]
        + [T.StructField("groups_sha256", T.StringType())]
    )
    both = docs.groupBy("block").cogroup(found.groupBy("of"))
    return both.applyInArrow(_settled(regular, v.same, best, names), out)

"""Token ids in Arrow files of equal-length sequences.

The ids of all documents, in the order of their keys, form one stream. A file holds a part of it as rows of exactly
``LENGTH`` ids (fixed-size lists), with a mask of the places that are filled; all batches but the last have the same
number of rows. Any id is thus found by its place alone: files are mapped, and a row or a run of ids is read without
parsing or copying what lies before. An index beside the files tells where each document starts.
"""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from risklake.llm.common import per_worker

#: ids of a sequence, and sequences of a batch
LENGTH, BATCH_ROWS = 2048, 128
INDEX = "file string, doc_id long, place long, n_tokens long"

#: Texts are cut where no pre-token continues: before each blank that a non-blank follows, around a single line break, and
#: before a full stop or comma after a letter or digit. Texts in which plain splitting can't tell such places from others are
#: cut by a pattern at the blanks only.
_LINE, _BARE = "\x01", "\x02"
_ODD = (
    r"[\x{01}\x{02}\x{0b}\x{0c}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    r"|[ \t\n\r][ \t\n\r]|(?:^|[^A-Za-z0-9\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{17f}])[.,]"
)
_cuts = re.compile(r" (?=\S)")
_letters = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ſ]+")
#: units given to the library in one text, units remembered by a worker, and bytes of text encoded together
JOINED, REMEMBERED, CHUNK = 1000, 800_000, 8_000_000


class Encoder:
    """Encodes texts with a byte-level vocabulary file of the tokenizers library.

    A blank before a word belongs to its pre-token, and pre-tokens don't influence each other. So texts are cut before
    such blanks, and each different unit is given to the library once; its ids are kept in one ragged array.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kind = id_type(self.library.get_vocab_size())
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, self.kind)
        self.starts = np.zeros(1, np.int64)

    def _learn(self, units: list[str]) -> None:
        """Encode units. Those of letters are one pre-token each, so many go into one text."""
        plain = [u for u in units if _letters.fullmatch(u)]
        other = [u for u in units if not _letters.fullmatch(u)]
        ids, sizes = [], []
        for at in range(0, len(plain), JOINED):
            lot = plain[at : at + JOINED]
            encoded = self.library.encode(" " + " ".join(lot), add_special_tokens=False)
            ids.append(np.array(encoded.ids, self.kind))
            sizes.append(np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(lot)))
        texts = ["\n" if u == _LINE else u[1:] if u[:1] == _BARE else " " + u for u in other]
        for encoded in self.library.encode_batch_fast(texts, add_special_tokens=False):
            ids.append(np.array(encoded.ids, self.kind))
            sizes.append([len(ids[-1])])
        first = len(self.known)
        self.known.update(zip(plain + other, range(first, first + len(units))))
        self.ids = np.concatenate([self.ids, *ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))])

    def _numbers(self, units: list[str]) -> np.ndarray:
        fresh = [u for u in units if u not in self.known]
        if fresh:
            if len(self.known) + len(fresh) > REMEMBERED:
                self._forget()
                fresh = units
            self._learn(fresh)
        return np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of ids of each."""
        odd = pc.match_substring_regex(texts, _ODD)
        cut = texts
        for mark, put in (("\n", f" {_LINE} {_BARE}"), (".", f" {_BARE}."), (",", f" {_BARE},")):
            cut = pc.replace_substring(cut, mark, put)
        lists = pc.split_pattern(cut, " ")
        if pc.any(odd).as_py():
            # a text that has a mark itself is left whole: the first unit of a text is encoded as it is
            cut = [
                None if not o else [t] if _LINE in t or _BARE in t else _cuts.split(t)
                for t, o in zip(texts.to_pylist(), odd.to_pylist())
            ]
            lists = pc.if_else(odd, pa.array(cut, lists.type), lists)
        offsets = lists.offsets.to_numpy()
        offsets, units = offsets - offsets[0], lists.flatten()
        coded = units.dictionary_encode()
        numbers = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        first = offsets[:-1]
        begun = [np.array(e.ids, self.kind) for e in self.library.encode_batch_fast(units.take(pa.array(first)).to_pylist(), add_special_tokens=False)]
        # ragged gather: the first unit of a text has no blank before it, its ids are laid over what was gathered
        sizes = np.diff(self.starts)[numbers]
        begin_of = self.starts[numbers]
        extra = np.concatenate([np.zeros(0, self.kind), *begun])
        sizes[first] = [len(x) for x in begun]
        source = np.concatenate([self.ids, extra])
        begin_of[first] = len(self.ids) + np.cumsum(sizes[first]) - sizes[first]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = source[np.repeat(begin_of - (ends - sizes), sizes) + np.arange(total)]
        ends = np.append(0, ends)
        return ids, ends[offsets[1:]] - ends[offsets[:-1]]


def id_type(vocabulary: int) -> np.dtype:
    """The smaller of two unsigned types that holds every id."""
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


class Writer:
    """Appends ids to one file."""

    def __init__(self, sink, kind: np.dtype):
        self.kind, self.buffer, self.place = kind, bytearray(), 0
        self.step = LENGTH * BATCH_ROWS * kind.itemsize
        self.schema = pa.schema(
            [("ids", pa.list_(pa.from_numpy_dtype(kind), LENGTH)), ("mask", pa.list_(pa.bool_(), LENGTH))]
        )
        self.file = pa.ipc.new_file(sink, self.schema)

    def append(self, ids: bytes) -> int:
        """Returns the place of the first id."""
        place = self.place
        self.buffer += ids
        self.place += len(ids) // self.kind.itemsize
        at = 0
        while len(self.buffer) - at >= self.step:
            self._write(np.frombuffer(bytes(self.buffer[at : at + self.step]), self.kind), LENGTH * BATCH_ROWS)
            at += self.step
        if at:
            del self.buffer[:at]
        return place

    def _write(self, ids: np.ndarray, filled: int) -> None:
        mask = np.arange(len(ids)) < filled
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids), LENGTH),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), LENGTH),
        ]
        self.file.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if self.buffer:
            ids = np.frombuffer(bytes(self.buffer), self.kind)
            self._write(np.pad(ids, (0, -len(ids) % LENGTH)), len(ids))
        self.file.close()


class Reader:
    """Random access to the ids of one file, without copies: views of the mapped file where it is local."""

    def __init__(self, path: str):
        store, at = fs.FileSystem.from_uri(path)
        self.source = pa.memory_map(at) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(at)
        self.file = pa.ipc.open_file(self.source)

    def batch(self, number: int) -> pa.RecordBatch:
        return self.file.get_batch(number)

    def sequence(self, row: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of one sequence."""
        batch, at = self.batch(row // BATCH_ROWS), row % BATCH_ROWS
        return batch["ids"].slice(at, 1).flatten().to_numpy(), batch["mask"].slice(at, 1).flatten()

    def ids(self, place: int, n: int) -> list[np.ndarray]:
        """The ``n`` ids from ``place`` on, one view for each batch they lie in."""
        out, step = [], LENGTH * BATCH_ROWS
        while n:
            number, at = divmod(place, step)
            view = self.batch(number)["ids"].flatten().to_numpy()[at : at + n]
            out.append(view)
            place, n = place + len(view), n - len(view)
        return out

    def close(self) -> None:
        self.source.close()


def uri(folder: str) -> str:
    return folder if "://" in folder else f"file://{folder}"


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``CHUNK`` bytes of text; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
    lots = np.cumsum(sizes) // CHUNK
    edges = np.flatnonzero(np.diff(lots)) + 1
    for start, stop in zip([0, *edges], [*edges, len(sizes)]):
        if stop > start:
            yield batch.slice(start, stop - start)


def _written(folder: str, vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer = None
        encoder = per_worker(("encoder", vocabulary), lambda: Encoder(vocabulary))
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}.arrow"
        for batch in batches:
            for part in _parts(batch):
                if writer is None:
                    store, root = fs.FileSystem.from_uri(folder)
                    store.create_dir(root)
                    # a retried or doubled task writes its own file; the finished one gets the name
                    own = f"{root}/.{name}.{context.taskAttemptId()}"
                    sink = store.open_output_stream(own)
                    writer = Writer(sink, encoder.kind)
                ids, sizes = encoder.encode(pc.fill_null(part.column(1), ""))
                ends = np.cumsum(sizes)
                ids = np.insert(ids, ends, end_id)
                sizes = sizes + 1
                places = writer.append(ids.tobytes()) + np.cumsum(sizes) - sizes
                columns = [pa.array([name] * len(sizes)), part.column(0), pa.array(places), pa.array(sizes)]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "doc_id", "place", "n_tokens"])
        if writer:
            writer.close()
            sink.close()
            store.move(own, f"{root}/{name}")

    return run


def write(df: DataFrame, key: str, text: str, folder: str, vocabulary: str, end_id: int) -> DataFrame:
    """Encode ``text``, append ``end_id`` to each document, write the files below ``folder`` in ascending order of
    ``key``, and store an index (file, doc_id, place, n_tokens) beside them, which is returned.

    NULL texts count as empty and hold the end id only. A NULL key comes first; rows of one key are ordered by text,
    and all of them are written. An empty table gives an empty index and no file. ``folder`` must be one that all
    executors share, ``vocabulary`` a file that all of them have.
    """
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    parts = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(*order)
    index = parts.mapInArrow(_written(uri(folder) + "/files", vocabulary, end_id), "file string, doc_id long, place long, n_tokens long")
    index.write.parquet(f"{folder}/index")
    return df.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held = None, None
        for batch in batches:
            sums = []
            for file, place, n in zip(*(batch.column(c).to_pylist() for c in ("file", "place", "n_tokens"))):
                if file != held:
                    if reader:
                        reader.close()
                    reader, held = Reader(f"{folder}/{file}"), file
                crc = 0
                for view in reader.ids(place, n):
                    crc = zlib.crc32(view.astype("<u4"), crc)
                sums.append(crc)
            names = [*batch.schema.names, "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], names=names)
        if reader:
            reader.close()

    return run


def read_back(index: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: (doc_id, start, n_tokens, ids_crc32).

    ``start`` counts the ids of all documents before it. Each task opens the files of its documents; one row per file
    holds their sizes, which bounds the window and the broadcast.
    """
    sizes = index.groupBy("file").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    found = index.mapInArrow(_read(uri(folder) + "/files"), INDEX + ", ids_crc32 long")
    return found.join(F.broadcast(starts), "file").select(
        "doc_id", (F.col("_first") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )

"""Aligned tokens, periodic runs and long repeats, against plain versions."""

import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from risklake.llm import alignment, periodic, queries, suffixes
from tests.llm import brute

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
SCHEMA = "key string, text string, bucket int, block long, n_a string, runs int, k1 string, n_bytes int, start int"


def frame(spark, texts):
    """Texts in a table with further columns of clashing names; keys are NULL or occur twice."""
    rows = [(None if i % 5 == 0 else f"k{i % 7}", t, 1, 2, "a", 3, "k", 4, 5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def both():
    public = pytest.importorskip("public_tokenizers")
    paths = [str(public.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return paths, alignment.Vocabularies(*paths)


PARTS = ["a", "bc", " ", "  ", "\n", "\n\n", ".", ",", "é", "▁", "\x01", "\x02", "\t", "\xa0", "'s", "12", "<|endoftext|>", "<s>",
         "<0x0A>", "日本", "\x00", "😀", "The", "ing", "-", "_", "²", "\r\n", "​", "\x85", "\x1c", " .", "! "]


def test_units_join_to_what_the_libraries_give(both):
    draw = random.Random(5)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randrange(12))) for _ in range(4000)]
    figures, digests, links = alignment.Aligner(both[1]).align(pa.array(texts, pa.string()))
    plain = brute.alignment(texts, both[1].a, both[1].b, both[1].bytes_a, both[1].bytes_b)
    assert [(*f, d) for f, d in zip(figures.tolist(), digests)] == [(*p[:4], p[6]) for p in plain]
    assert len(links) == sum(p[3] for p in plain)


def test_alignment_counts_all_rows(spark, both, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 200)  # several blocks in a task
    paths, v = both
    draw = random.Random(6)
    words = ["tokens", "end", "together", "indivisible", "a,", "b.", "Straße", "xq", "\n"]
    texts = [" ".join(draw.choices(words, k=draw.randrange(30))) for _ in range(60)]
    texts += [None, "", "x▁y", texts[0], texts[0], "long " * 20_000]
    got = alignment.align(frame(spark, texts), "key", "text", *paths)
    assert got.columns == ["key", *alignment.RESULT, "groups_sha256"]
    plain = brute.alignment(texts, v.a, v.b, v.bytes_a, v.bytes_b)
    keys = [r["key"] for r in frame(spark, texts).select("key").collect()]
    assert sorted(tuple(r)[1:] for r in got.collect()) == sorted(plain) and len(keys) == got.count()
    assert alignment.align(frame(spark, texts).where("false"), "key", "text", *paths).count() == 0


def test_other_tokenizers_are_refused(both, tmp_path):
    public = pytest.importorskip("public_tokenizers")
    with pytest.raises(ValueError):
        alignment.Vocabularies(str(public.path("word_bpe_49k.json")), both[0][1])


@tables
def test_alignment_of_documents(spark, both):
    v = both[1]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    plain = brute.alignment([r["text"] for r in docs], v.a, v.b, v.bytes_a, v.bytes_b)
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op11_alignment"](spark, SF).collect()}
    assert got == {r["doc_id"]: p for r, p in zip(docs, plain)}


def test_runs_equal_brute_force():
    draw = random.Random(1)
    texts = []
    for _ in range(1500):
        w = [draw.randrange(draw.choice([1, 2, 2, 3, 5])) for _ in range(draw.randrange(60))]
        if draw.random() < 0.5:
            block = [draw.randrange(4) for _ in range(draw.randrange(1, 9))]
            w[len(w) // 3 : len(w) // 3] = block * draw.randrange(2, 40)
        texts.append(w)
    found = periodic.runs(np.array([x for w in texts for x in w]), np.cumsum([len(w) for w in texts]))
    rows = [[] for _ in texts]
    for i, *run in zip(*(c.tolist() for c in found)):
        rows[i].append(tuple(run))
    assert rows == [brute.runs(w) for w in texts]


def test_extensions_equal_word_by_word_comparison():
    draw = np.random.RandomState(3)
    w = np.concatenate([[-1], draw.randint(0, 2, 300), [-2], np.tile([0, 1, 1], 50), [-3], np.zeros(70, int), [-4]])
    grammar = periodic.Grammar(w)
    a, b = draw.randint(1, len(w) - 1, (2, 3000))
    a, b = a[(a != b) & (w[a] >= 0) & (w[b] >= 0)], b[(a != b) & (w[a] >= 0) & (w[b] >= 0)]

    def plain(i, j, step):
        n = 0
        while w[i] == w[j]:
            i, j, n = i + step, j + step, n + 1
        return n

    assert grammar.extension(a, b, True).tolist() == [plain(i, j, 1) for i, j in zip(a, b)]
    assert grammar.extension(a, b, False).tolist() == [plain(i, j, -1) for i, j in zip(a, b)]


def test_runs_of_odd_rows(spark):
    texts = [None, "", " \n ", "a " * 50_000, "x y z " * 4, "x y z " * 4, "one two three", "b b b b b", "c c c c c c"]
    got = periodic.with_runs(frame(spark, texts), "text")
    assert got.columns == [c for c in SCHEMA.replace(" string", "").replace(" int", "").replace(" long", "").split(", ") if c != "runs"] + [
        "runs", "strongest", "collapsed"]
    seen = {(r["text"], tuple(map(tuple, r["runs"])), r["strongest"] and tuple(r["strongest"]), r["collapsed"]) for r in got.collect()}
    assert seen == {
        (None, (), None, ""), ("", (), None, ""), (" \n ", (), None, ""), (texts[3], ((0, 50_000, 1),), (0, 50_000, 1), "a"),
        (texts[4], ((0, 12, 3),), (0, 12, 3), "x y z"), ("one two three", (), None, "one two three"),
        ("b b b b b", (), None, "b b b b b"), ("c c c c c c", ((0, 6, 1),), (0, 6, 1), "c"),
    }
    assert got.count() == len(texts) and periodic.with_runs(frame(spark, texts).where("false"), "text").count() == 0


@tables
def test_runs_of_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    some = 0
    for r in queries.QUERIES["op12_periodic"](spark, SF).collect():
        w = brute.with_repeats(brute.words(docs[r["doc_id"]]), r["doc_id"])
        found = brute.runs(w)
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        figures = (len(found), *(best or [None] * 3), best and 1000 * best[1] // best[2])
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, brute.collapsed(w, found))]
        assert tuple(r) == (r["doc_id"], *figures, *digests)
        some += bool(found)
    assert some > 10


def check_repeats(spark, texts):
    got = suffixes.repeated_spans(frame(spark, texts), "text").select("spans", "kept")
    plain = brute.repeated_bytes(texts)
    by_text = {texts[i] or "": p for i, p in enumerate(plain)}
    want = sorted((spans, kept) for kept, spans in by_text.values() if spans)
    assert sorted(([tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in got.collect()) == want
    rows = suffixes.without_repeats(frame(spark, texts), "key", "text").collect()
    assert sorted(tuple(r)[1:] for r in rows) == sorted(
        (len((t or "").encode()), len((t or "").encode()) - len(k), len(s), hashlib.sha256(k).hexdigest())
        for t, (k, s) in zip(texts, plain)
    )


def test_repeats_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 1500)  # texts are cut into pieces
    draw = random.Random(8)

    def prose(n):
        return "".join(draw.choice("abcdefghé ") for _ in range(n))

    common, passage, template = prose(400), prose(700), prose(2500)
    texts = [prose(draw.randrange(900)) for _ in range(30)]
    texts += [prose(draw.randrange(200)) + common + prose(draw.randrange(200)) for _ in range(25)]
    texts += [prose(50) + passage[draw.randrange(200) : draw.randrange(500, 700)] + prose(50) for _ in range(25)]
    for _ in range(12):  # near copies: some edits each
        t = list(template)
        for _ in range(draw.randrange(4)):
            t[draw.randrange(len(t))] = "X"
        texts.append("".join(t))
    texts += [passage + passage[:450] + "y" + passage[100:], "ab" * 700, "ab" * 650, "c" * 399, "c" * 400, "d" * 401, "e" * 6000]
    texts += [None, "", "", texts[3], texts[3], passage, passage, common + common]
    check_repeats(spark, texts)


def test_repeats_of_one_string_in_many_rows(spark, monkeypatch):
    """A string that all rows hold is cut over the buckets."""
    draw = random.Random(9)
    line = "".join(draw.choice("abcdef") for _ in range(430))
    texts = [f"{draw.random()}" * 3 + line + f"{draw.random()}" for _ in range(300)]
    check_repeats(spark, texts)


def test_nothing_repeats(spark):
    check_repeats(spark, ["short", None, "", "x" * 399])
    assert suffixes.without_repeats(frame(spark, ["a"]).where("false"), "key", "text").count() == 0


@tables
def test_repeats_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    plain = brute.repeated_bytes([r["text"] for r in docs])
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op13_suffixes"](spark, SF).collect()}
    for r, (kept, spans) in zip(docs, plain):
        n = len(r["text"].encode())
        assert got[r["doc_id"]] == (n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    assert any(spans for _, spans in plain) and len(got) == len(docs)


def test_multikey_order():
    draw = np.random.RandomState(2)
    columns = [draw.randint(0, 3, 500) for _ in range(4)]
    order = suffixes.multikey(columns)
    rows = list(zip(*columns))
    assert [rows[i] for i in order] == sorted(rows)
    cuts = [c[order[100::100]] for c in columns]
    splitters = list(zip(*cuts))
    assert suffixes._bucket(columns, cuts).tolist() == [sum(s <= r for s in splitters) for r in rows]

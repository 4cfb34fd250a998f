"""Near-duplicates, passages and components against all-pairs comparison."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from risklake.llm import near_dedup, passages
from risklake.llm.components import components
from risklake.llm.shingles import words as word_hashes
from tests.llm import brute


def words(rng, n, vocabulary=5000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def changed(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
    return text


def corpus(seed=4):
    """Texts with groups of copies, chains of near copies, and pairs around the threshold."""
    rng = random.Random(seed)
    texts = [None, "", " \n", "one", "ONE", "one two", "One  Two", "two one", "a b c d", "A b c d e"]
    for _ in range(40):
        base = words(rng, rng.randint(20, 120))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            base = changed(rng, base, rng.randint(0, 8))
            texts.append(" ".join(base).upper() if rng.random() < 0.3 else "\t".join(base))
    exact = " ".join(words(rng, 60))
    texts += [exact] * 30 + [exact.upper()] * 5
    center = words(rng, 100)
    texts += [" ".join(changed(rng, center, rng.randint(1, 9))) for _ in range(60)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("n", [2, 5])
def test_groups_equal_all_pairs(spark, n):
    texts = corpus()
    df = spark.createDataFrame([(7 * i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, id string, n long")
    expected = brute.near_groups({7 * i: t for i, t in enumerate(texts)}, n)
    rows = {r["doc_id"]: r for r in near_dedup.near_duplicates(df, "doc_id", "text", n, 80).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        row = rows[7 * i]
        assert row["n_shingles"] == len(brute.shingle_set(t, n))
        assert (row["component_id"], row["kept"]) == (expected[7 * i], expected[7 * i] == 7 * i), t


@pytest.mark.parametrize("exhaustive, deepest", [(3, 5), (3, near_dedup.DEPTH)])
def test_large_nodes_branch_and_the_last_are_compared_in_blocks(spark, monkeypatch, exhaustive, deepest):
    monkeypatch.setattr(near_dedup, "EXHAUSTIVE", exhaustive)
    monkeypatch.setattr(near_dedup, "MAX_DEPTH", deepest)
    texts = dict(enumerate(corpus(9)))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df, "doc_id", "text", 2).collect()}
    assert found == brute.near_groups(texts, 2)


def test_keys_that_are_null_or_repeated(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (2, "a b c d e f"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in near_dedup.near_duplicates(df, "doc_id", "text").collect()]
    assert sorted(found, key=str) == sorted(
        [(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (None, 0, None, True), (None, 0, None, True)], key=str
    )
    assert near_dedup.near_duplicates(df.limit(0), "doc_id", "text").count() == 0


def test_fewer_words_than_a_shingle_in_a_batch():
    from risklake.llm.shingles import shingles

    for texts in (["a"], ["a b", ""], ["a", "b"]):
        hashes, counts = shingles(pa.array(texts), 5)
        assert counts.tolist() == [int(bool(t)) for t in texts] and len(hashes) == counts.sum()
        assert passages.grams(*word_hashes(pa.array(texts)))[1].tolist() == [0] * len(texts)


def test_one_very_long_text(spark):
    rng = random.Random(1)
    long = words(rng, 200_000, 10**6)
    rows = [(1, " ".join(long)), (2, " ".join(changed(rng, long, 100))), (3, "short one")]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {1: 1, 2: 1, 3: 3}


def test_trees_reach_the_target():
    """Chance that a pair at the threshold shares no path, over random agreement of the minwise functions."""
    rng = np.random.default_rng(2)
    trees, lost = near_dedup.trees(0.8), 0.0
    for _ in range(400):
        agree = rng.random(near_dedup.FUNCTIONS) < 0.8
        share = agree.mean()
        dead = 0.0
        for _ in range(near_dedup.DEPTH):
            one = 1 - share + share * dead
            dead = 0.75 * one + 0.25 * one * one
        lost += dead**trees / 400
    assert lost < 1e-4
    assert near_dedup.bits_apart(0.8) >= 64 * 0.2 + 5 * math.sqrt(64 * 0.26)


def test_components_of_chains_stars_and_copies(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(5, 7), (5, 7), (9, 9), (8, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r["id"]: r["component"] for r in components(df).collect()}
    expected = {i: 100 for i in range(100, 161)} | {i: 5 for i in range(200, 400)} | {5: 5, 7: 5, 8: 3, 3: 3}
    assert found == expected
    assert components(df.limit(0)).count() == 0


def test_compact_windows_equal_the_recursive_tree():
    rng = np.random.default_rng(1)
    for _ in range(200):
        counts = rng.integers(0, 30, size=4)
        width = int(rng.integers(1, 9))
        hashes = rng.integers(0, int(rng.choice([5, 1000])), size=counts.sum()).astype(np.uint64)
        expected = []

        def split(low, high):
            if high - low + 1 >= width:
                center = low + int(np.argmin(hashes[low : high + 1]))
                expected.append((center, low, high))
                split(low, center - 1)
                split(center + 1, high)

        begin = 0
        for n in counts:
            split(begin, begin + n - 1)
            begin += n
        assert sorted(zip(*(x.tolist() for x in passages.compact_windows(hashes, counts, width)))) == sorted(expected)


def test_similar_windows_equal_sets():
    """Windows beside each other and moved by a word, against sets of shingles."""
    rng = np.random.default_rng(5)
    width, words_ = 20, 60
    for case in range(60):
        x = rng.choice(10**6, words_, replace=False)
        y = x.copy()
        at = int(rng.integers(5, 55))
        if case % 3 == 0:
            y[at] = 10**7
        elif case % 3 == 1:
            y = np.insert(y, at, 10**7)[:words_]
        else:
            y = np.append(np.delete(y, at), 10**7)

        def sets(w):
            return [frozenset(tuple(w[k : k + 5]) for k in range(i, i + width - 4)) for i in range(len(w) - width + 1)]

        a, b = sets(x), sets(y)
        expected = {
            i for i in range(len(a)) for d in (0, 1, -1)
            if 0 <= i + d < len(b) and 100 * len(a[i] & b[i + d]) >= 80 * len(a[i] | b[i + d])
        }
        row, first, last, _ = passages.similar(x[None], y[None], width, 80)
        assert bool(len(row)) == bool(expected)
        assert not expected or (first[0] in expected and last[0] in expected)


def planted(seed):
    """Documents with passages in several of them, and which hold which."""
    rng = random.Random(seed)
    shared = [words(rng, n, 10**6) for n in (51, 60, 90, 200, 75)]
    texts, holds = [], defaultdict(set)
    for i in range(120):
        text = words(rng, rng.randint(0, 150), 10**6)
        for k, passage in enumerate(shared):
            if rng.random() < 0.15:
                part = changed(rng, passage, 1) if k == 4 and rng.random() < 0.5 else passage
                text += part + words(rng, rng.randint(0, 30), 10**6)
                holds[k].add(i)
        texts.append(" ".join(text))
    whole = " ".join(words(rng, 70, 10**6))
    for _ in range(15):
        holds["copy"].add(len(texts))
        texts.append(whole)
    return texts, holds


def test_planted_passages_are_found_and_clean_documents_are_not(spark):
    texts, holds = planted(3)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[-1]), (1000, None), (1001, ""), (1002, "few words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = passages.repeated_passages(df, "doc_id", "text").collect()
    classes = defaultdict(set)
    for r in found:
        classes[r["doc_id"]].add(r["class_id"])
        assert r["end_word"] - r["start_word"] >= passages.PASSAGE
    assert set(classes) == set().union(*(s for s in holds.values() if len(s) > 1))
    for own in holds.values():
        assert len(own) < 2 or set.intersection(*(classes[i] for i in own))
    assert passages.repeated_passages(df.limit(0), "doc_id", "text").count() == 0


def test_passages_with_an_edit_and_repeated_lines(spark):
    rng = random.Random(6)
    base = words(rng, 100, 10**6)
    other = base[:50] + ["inserted"] + base[50:]
    line = " ".join(words(rng, 60, 10**6))
    rows = [
        (1, " ".join(words(rng, 40, 10**6) + base)), (2, " ".join(other + words(rng, 40, 10**6))),
        (3, "\n".join([line] * 20)), (4, " ".join(words(rng, 30, 10**6)) + "\n" + line), (5, "spam " * 3000), (6, "spam " * 2000),
        (7, " ".join(base[:40])),
    ]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    classes = defaultdict(set)
    for r in found.collect():
        classes[r["doc_id"]].add(r["class_id"])
    assert classes == {1: {1}, 2: {1}, 3: {3}, 4: {3}, 5: {5}, 6: {5}}


def test_a_passage_around_a_line_that_many_documents_hold(spark):
    rng = random.Random(11)
    line = words(rng, 42, 10**6)
    passage = words(rng, 4, 10**6) + line + words(rng, 4, 10**6)
    texts = {i: words(rng, 30, 10**6) + line + words(rng, 30, 10**6) for i in range(60)}
    for i in (5, 50):
        texts[i] = words(rng, 20, 10**6) + passage + words(rng, 20, 10**6)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string").repartition(1)
    found = passages.repeated_passages(df, "doc_id", "text").collect()
    assert {(r["doc_id"], r["class_id"]) for r in found} == {(5, 5), (50, 5)}
    assert all(15 <= r["start_word"] <= 20 and 70 <= r["end_word"] <= 75 for r in found)


def test_edited_passages_around_a_line_that_many_documents_hold(spark):
    """Ten pairs, each with a word changed, around a line of forty words in forty other documents."""
    rng = random.Random(12)
    line = words(rng, 40, 10**6)
    texts = {i: words(rng, 30, 10**6) + line + words(rng, 30, 10**6) for i in range(100, 140)}
    for pair in range(10):
        passage = words(rng, 30, 10**6) + line + words(rng, 30, 10**6)
        texts[2 * pair] = words(rng, 20, 10**6) + passage
        texts[2 * pair + 1] = changed(rng, passage, 1) + words(rng, 20, 10**6)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = {(r["doc_id"], r["class_id"]) for r in passages.repeated_passages(df, "doc_id", "text").collect()}
    assert found == {(i, i - i % 2) for i in range(20)}


def test_near_copies_of_a_text_that_many_hold(spark):
    """Sixty copies with an edit in about 45 words: whoever shares fifty words with one edit with another is of the class."""
    rng = random.Random(13)
    base = words(rng, 180, 10**6)
    rows = [(i, " ".join(changed(rng, base, 4))) for i in range(60)]
    rows += [(60 + i, " ".join(words(rng, 200, 10**6))) for i in range(20)]
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    assert {r["class_id"] for r in found} == {0} and len({r["doc_id"] for r in found}) >= 58
    assert {r["doc_id"] for r in found} <= set(range(60))


def lines_with_pairs(rng):
    """Sixty documents around one line of thirty words, and twelve pairs among them that go on alike after a changed word."""
    line = words(rng, 30, 10**6)
    texts = {i: words(rng, 40, 10**6) + line + words(rng, 40, 10**6) for i in range(100, 160)}
    for pair in range(12):
        after = words(rng, 20, 10**6)
        for i in (2 * pair, 2 * pair + 1):
            texts[i] = words(rng, 40, 10**6) + line + words(rng, 1, 10**6) + after + words(rng, 20, 10**6)
    return texts


@pytest.mark.parametrize("block", [1024, 20])
def test_links_of_farther_members_of_a_large_group(spark, monkeypatch, block):
    """The words next to the line differ in each pair, so no order puts the pair side by side; also block by block."""
    monkeypatch.setattr(passages, "BLOCK", block)
    texts = lines_with_pairs(random.Random(17))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = {(r["doc_id"], r["class_id"]) for r in passages.repeated_passages(df, "doc_id", "text").collect()}
    assert found == {(i, i - i % 2) for i in range(24)}


def test_comparing_a_group_gives_what_all_its_pairs_give():
    """Labels and reach of contexts around a gram, with changed, missing and added words, and ends of texts."""
    rng = random.Random(18)
    gram = words(rng, passages.GRAM, 10**6)
    rows, base = [], [words(rng, passages.BEFORE, 10**6) + gram + words(rng, 38, 10**6) for _ in range(6)]
    for k in range(90):
        text = list(base[k % 6])
        for _ in range(rng.randrange(4)):
            at = rng.choice([*range(38), *range(50, 88)])
            text[at] = rng.randrange(10**6)
        if k % 5 == 0:
            at = rng.randrange(50, 86)
            text = text[:at] + ([] if k % 2 else words(rng, 1, 10**6)) + text[at + (k % 2) :]
        rows.append([int(w[1:]) if isinstance(w, str) else w for w in (text + words(rng, 2, 10**6))[:88]])
    context = np.array(rows, np.int64)
    context[1, 70:], context[7, :20] = -3 - 2 * np.arange(18), -1000 - 2 * np.arange(20)
    for left, right in ((np.arange(90), np.arange(90)), (np.arange(40), np.arange(40, 90))):
        label, first, last = passages.connect(context, left, right, 50, 80)
        pairs = [(i, j) for i in left for j in right if i < j]
        x, y = map(np.array, zip(*pairs))
        row, low, high, shift = passages.similar(context[x], context[y], 50, 80)
        reach, linked = defaultdict(list), set()
        for r, f, t, s in zip(row, low, high, shift):
            reach[x[r]] += [f, t]
            reach[y[r]] += [f + s, t + s]
            linked.add((x[r], y[r]))
        expected = np.arange(90)
        for _ in range(90):
            for i, j in linked:
                expected[[i, j]] = min(expected[i], expected[j])
        assert label.tolist() == expected.tolist() and len(linked) > 50
        got = {i: (first[i], last[i]) for i in range(90) if first[i] <= last[i]}
        assert got == {i: (min(v), max(v)) for i, v in reach.items()}


def contexts_around(rng, n, runs=False):
    """Words around one gram, of a few kinds: with words changed, missing and added, and texts that begin or end in them. ``runs``: one word
    stands there seven to nine times in a row on each side."""
    gram = words(rng, passages.GRAM, 10**6)
    base = [words(rng, 46, 10**6) + gram + words(rng, 46, 10**6) for _ in range(n // 12)]
    rows = []
    for k in range(n):
        sides = [(text := rng.choice(base))[:46][::-1], text[58:]]  # from the gram outward
        for side in sides:
            if runs:
                side[10:17] = side[10:11] * rng.randrange(7, 10)
            if rng.random() < (0.7 if not runs or side is sides[k % 2] else 0):
                at, edit = rng.choice([*range(10), *range(20, 38)]), rng.randrange(3)
                side[at : at + (edit < 2)] = words(rng, 1, 10**6) if edit else []
        text = sides[0][37::-1] + gram + sides[1][:38]
        row = [int(w[1:]) for w in text]
        if k % 9 == 0:
            row[: rng.randrange(38)] = []
            row = [-k - 1] * (88 - len(row)) + row
        elif k % 9 == 1:
            row = row[: rng.randrange(50, 88)]
            row += [-k - 1] * (88 - len(row))
        rows.append(row)
    rows = np.array(rows, np.int64)
    assert rows.shape[1] == 88 and (rows[:, 38:50] == rows[0, 38:50]).all()
    return np.unique(rows, axis=0)


def all_pairs(context, percent=80):
    """Label, first and last start of ``connect``, from ``similar`` of all pairs, whichever comes first in a pair."""
    n = len(context)
    label, first, last = np.arange(n), np.full(n, context.shape[1]), np.full(n, -1)
    i, j = np.triu_indices(n, 1)
    i, j = np.append(i, j), np.append(j, i)
    row, low, high, shift = passages.similar(context[i], context[j], 50, percent)
    for of, add in ((i[row], 0), (j[row], shift)):
        np.minimum.at(first, of, low + add)
        np.maximum.at(last, of, high + add)
    for _ in range(n):
        np.minimum.at(label, i[row], label[j[row]])
    return label, first, last


@pytest.mark.parametrize("runs", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_sorting_a_group_gives_what_all_its_pairs_give(seed, runs):
    rng = random.Random(seed)
    groups = [contexts_around(rng, n, runs) for n in (150, 40, 110)]
    group = np.repeat([7, -3, 10**15], [len(g) for g in groups])
    context = np.concatenate(groups)
    context = np.where(context < 0, -1 - np.arange(len(context))[:, None], context)
    parts = [passages.connect_keyed(context, group, range(k, 39, 3), 50, 80) for k in range(3)]
    label, first, last = passages.connect_keyed(context, group, range(39), 50, 80)
    assert (first == np.min([p[1] for p in parts], axis=0)).all() and (last == np.max([p[2] for p in parts], axis=0)).all()
    at = 0
    for g in groups:
        own = slice(at, at := at + len(g))
        expected, low, high = all_pairs(g)
        mine, begin, end = label[own] - own.start, first[own], last[own]
        assert len(set(expected)) > 2 and (low <= high).sum() > len(g) // 3
        if runs:  # one shingle of 46 more may differ where a window cuts a run, and a reach may be a word shorter
            wider, lowest, highest = all_pairs(g, 76)
            assert (mine[expected] == mine).all() and (wider[mine] == wider).all()
            assert (lowest <= begin).all() and (end <= highest).all()
            assert (begin <= low + 1).all() and (high - 1 <= end).all() and ((begin > end) <= (low > high)).all()
        else:
            assert mine.tolist() == expected.tolist() and begin.tolist() == low.tolist() and end.tolist() == high.tolist()


def test_large_groups_are_not_compared_pair_by_pair(monkeypatch):
    """Pairs are gone through in groups up to ``BLOCK`` only; what is found in a larger one is what all its pairs give."""
    monkeypatch.setattr(passages, "BLOCK", 60)
    compare = passages.connect

    def connect(context, *rest):
        assert len(context) <= 60
        return compare(context, *rest)

    monkeypatch.setattr(passages, "connect", connect)
    rng = random.Random(21)
    groups = [contexts_around(rng, n) for n in (300, 50, 200)]
    rows = []
    for k, g in enumerate(groups):
        for i, x in enumerate(g):
            before, after = (w[w >= 0].astype(">u4").tobytes() for w in (x[37::-1], x[38:]))
            rows.append({"block": k, "k1": i, "k2": k, "word": 100, "after": after, "before": before, "left": True, "right": True,
                         "part": 0, "parts": 1})
    found = pa.Table.from_batches(list(passages._compared(50, 80)(iter(pa.Table.from_pylist(rows).to_batches())))).to_pylist()
    for k, g in enumerate(groups):
        if len(g) <= 60:
            continue
        label, first, last = all_pairs(g)
        assert {(r["k1"], r["from"], r["to"]) for r in found if r["k2"] == k} == {
            (i, 62 + a, 112 + b) for i, (a, b) in enumerate(zip(first.tolist(), last.tolist())) if a <= b
        }
        members = defaultdict(set)
        for r in found:
            if r["k2"] == k:
                members[r["token"]].add(r["k1"])
        assert {frozenset(m) for m in members.values()} == {frozenset(np.flatnonzero(label == x)) for x in label[first <= last]}


@pytest.mark.parametrize("part", [8192, 30])
def test_a_line_that_very_many_documents_hold_is_dealt_in_parts(spark, monkeypatch, part):
    monkeypatch.setattr(passages, "BLOCK", 20)
    monkeypatch.setattr(passages, "PART", part)
    texts = lines_with_pairs(random.Random(23))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = {(r["doc_id"], r["class_id"]) for r in passages.repeated_passages(df, "doc_id", "text").collect()}
    assert found == {(i, i - i % 2) for i in range(24)}


def test_passages_of_odd_rows(spark):
    """Repeated rows, several texts of a key, further columns, and very long texts."""
    rng = random.Random(14)
    shared = " ".join(words(rng, 60, 10**6))
    long = " ".join(words(rng, 150_000, 10**6))
    rows = [(1, shared), (1, shared), (2, "x " + shared), (2, " ".join(words(rng, 80, 10**6))), (3, long + " " + shared), (4, long),
            (5, " ".join([shared, "y", shared])), (6, None), (None, shared), (7, " ".join(words(rng, 49, 10**6))), (8, shared[:100])]
    df = spark.createDataFrame([(*r, 1, "a") for r in rows], "k long, text string, word int, token string")
    found = passages.repeated_passages(df, "k", "text").collect()
    assert {(r["k"], r["class_id"]) for r in found} == {(1, 1), (2, 1), (3, 1), (3, 3), (4, 3), (5, 1)} or {
        (r["k"], r["class_id"]) for r in found
    } == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 1)}  # the ranges of document 3 touch or not
    assert len([r for r in found if r["k"] == 1]) == 1


def test_passages_against_all_pairs(spark):
    """Documents of the small table with a passage of fifty words that is similar to one in another, by all pairs of windows."""
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    holders, grams_of = defaultdict(set), {}
    for r in texts:
        w = [x.translate(brute.LOWER) for x in brute.words(r["text"])]
        grams_of[r["doc_id"]] = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        for g in grams_of[r["doc_id"]]:
            holders[g].add(r["doc_id"])
    linked = set()
    pairs = {(i, j) for ids in holders.values() for i in ids for j in ids if i < j}
    for i, j in pairs:
        x, y = grams_of[i], grams_of[j]
        places = defaultdict(list)
        for k, g in enumerate(y):
            places[g].append(k)
        shifts = Counter(k - q for q, g in enumerate(x) for k in places.get(g, ()))
        for shift, n in shifts.items():
            if n + shifts[shift - 1] + shifts[shift + 1] < 41:
                continue
            for p in range(len(x) - 45):
                if 0 <= p + shift <= len(y) - 46:
                    a, b = set(x[p : p + 46]), set(y[p + shift : p + shift + 46])
                    if 100 * len(a & b) >= 80 * len(a | b):
                        linked |= {i, j}
                        break
    found = {r["doc_id"] for r in passages.repeated_passages(spark.createDataFrame(texts), "doc_id", "text").collect()}
    assert len(linked) > 10 and len(linked & found) >= 0.98 * len(linked) and len(found - linked) <= 0.02 * len(linked)


def test_documents_connected_before_take_part_in_open_clusters(spark):
    known = near_dedup._Links(None, None, 5, 80)
    known.connected = spark.createDataFrame([(1, 1), (2, 1)], "id long, component long")
    hanging = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")  # the star of a node that holds the chain 1 - 2 - 3
    clusters = known.clusters(hanging, known.open(hanging)).collect()
    assert {(r["id"], r["cluster"]) for r in clusters} == {(1, 1), (2, 1), (3, 1)}


def test_large_nodes_of_the_last_depth_are_dealt_in_blocks(spark):
    rows = [(9, i, 100) for i in range(100)]
    dealt = near_dedup.in_blocks(spark.createDataFrame(rows, "node long, id long, n long"), 40).collect()
    nodes = defaultdict(set)
    for r in dealt:
        nodes[r["node"]].add(r["id"])
    assert max(map(len, nodes.values())) <= 60
    met = {(i, j) for ids in nodes.values() for i in ids for j in ids if i < j}
    assert len(met) == 100 * 99 // 2


def _links_of(spark, sets: dict, percent=80):
    """Links found by the comparison inside one cluster that holds all sets."""
    known = near_dedup._Links(None, None, 5, percent)
    known.sets = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id long, tokens array<long>")
    known.add_within(spark.createDataFrame([(i, 0) for i in sets], "id long, cluster long"))
    return known


@pytest.mark.parametrize("dense, exhaustive", [(0, 2000), (0, 4), (10**9, 2000), (64, 2000)])
def test_links_inside_a_cluster_equal_all_pairs(spark, monkeypatch, dense, exhaustive):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "DENSE", dense)
    monkeypatch.setattr(near_dedup, "EXHAUSTIVE", exhaustive)
    rng = random.Random(dense + exhaustive)
    sets = {}
    for _ in range(25):  # families of all sizes of sets, with members on both sides of the threshold
        base = rng.sample(range(400), rng.choice([1, 2, 5, 9, 10, 11, 30, 60]))
        for _ in range(rng.randint(1, 8)):
            own = set(base)
            for token in rng.sample(base, rng.randint(0, 1 + len(base) // 5)):
                own.discard(token)
                own.add(rng.choice([token, rng.randrange(400), rng.randrange(10**6, 10**7)]))
            sets[len(sets)] = own
    root = brute.near_groups({i: " ".join(f"{t}" for t in sorted(s)) for i, s in sets.items()}, 1)
    known = _links_of(spark, sets)
    found = {r["id"]: r["component"] for r in known.connected.collect()}
    assert {i: found.get(i, i) for i in sets} == root
    for r in known.found.collect():
        a, b = sets[r["a"]], sets[r["b"]]
        assert 100 * len(a & b) >= 80 * len(a | b)


def test_pages_of_one_template_make_few_candidates(spark):
    pages = 3000
    hashed = near_dedup.mix(np.arange(75 + 25 * pages, dtype=np.uint64)).view(np.int64).tolist()  # tokens are mixed hashes
    template, own = hashed[:75], hashed[75:]
    sets = {i: {*template, *own[25 * i : 25 * i + 25]} for i in range(pages)}  # alike by 0.6
    sets[pages] = sets[77] - {template[5], own[25 * 77]}
    known = _links_of(spark, sets)
    assert [tuple(r) for r in known.found.collect()] == [(77, pages)]
    rows = spark.createDataFrame([(i, i, 0, len(sets)) for i in sets], "id long, of long, cluster long, n long")
    prefixes = known.prefixes(rows)
    groups = prefixes.groupBy("node").count().where("count > 1").withColumnRenamed("count", "n")
    assert near_dedup._sharing(prefixes.drop("cluster").join(groups, "node"), 80).count() <= 2 * pages

"""The registered queries and the pipeline on the smallest tables, against plain versions."""

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from checks.compare import rows, run_sql, types
from risklake.llm import queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    ours = queries.QUERIES[name](spark, SF).toArrow()
    theirs = run_sql(SF, queries.ORACLE_SQL[name])
    assert types(ours) == types(theirs) and rows(ours) == rows(theirs) and ours.num_rows == 200


def test_quality_equals_brute_force(spark, docs):
    for r in run(spark, "op2_quality"):
        n, chars, symbols, lines, three, covered, longest = brute.repetition(docs[r["doc_id"]]["text"])
        assert tuple(r[1:6]) == (n, chars, symbols, lines, three)
        failed = n < 50 or 100 * three > 50 * n
        assert (r["base_failed"], r["kept"]) == (failed, not failed and covered <= 0.3 * n and longest <= 100)


def test_tokens_equal_the_library(spark, docs):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    byte_level, word_level = (Tokenizer.from_file(str(public.path(f))) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    files = {r["doc_id"]: r for r in run(spark, "op3_token_files")}
    counts = {r["doc_id"]: r for r in run(spark, "op7_token_counts")}
    start = 0
    for i in sorted(docs):
        text = docs[i]["text"]
        ids = [*byte_level.encode(text, add_special_tokens=False).ids, 2]
        assert tuple(files[i])[1:] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        n = len(word_level.encode(text, add_special_tokens=False).ids)
        assert tuple(counts[i])[1:] == (len(text.encode()), n, n > 2048)


def test_passages_hold_every_exact_one(spark, docs):
    classes = defaultdict(set)
    for r in run(spark, "op4_passages"):
        classes[r["doc_id"]].add(r["class_id"])
    groups = defaultdict(set)
    for i, r in docs.items():
        w = brute.words(r["text"].translate(brute.LOWER))
        for k in range(len(w) - 49):
            groups[tuple(w[k : k + 50])].add(i)
    shared = [g for g in groups.values() if len(g) > 1]
    assert shared and all(set.intersection(*(classes[i] for i in g)) for g in shared)


def test_secrets_equal_brute_force(spark, docs):
    for r in run(spark, "op5_secrets"):
        base = brute.base_spans(docs[r["doc_id"]]["text"])
        kinds = Counter(s.split(":")[0] for s in base.split(",") if s)
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert set(base.split(",")) <= set(r["spans"].split(","))


def test_leaks_are_found_and_nothing_else(spark, docs):
    items = {r["item_id"]: brute.fold(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    held = {(i, k) for i, r in docs.items() for k, item in items.items() if item in brute.fold(r["text"])}
    assert held and {(r["doc_id"], r["item_id"]) for r in run(spark, "op6_decontamination")} == held


def test_urls_have_a_verdict(spark):
    found = run(spark, "op8_url_filter")
    assert len(found) == 50 and {r["verdict"] for r in found} <= {"allow", "block"}
    bad = [r for r in found if r["rule"] is None and any(w in r["host"] for w in ("casino", "pills", "bets", "adult", "spam", "ads-"))]
    assert all(r["verdict"] == "block" for r in bad)


def test_shards(spark, docs):
    found = run(spark, "op9_sharding")
    held, places = Counter(), defaultdict(list)
    for r in found:
        text = docs[r["doc_id"]]["text"].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 16, zlib.crc32(text), "bytes", None)
        held[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert len(found) == 200 and set(held) == set(range(40))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_mix(spark, docs):
    found = run(spark, "op10_mixing")
    sizes, taken = Counter(), Counter()
    for r in found:
        assert r["size"] == len(brute.words(docs[r["doc_id"]]["text"])) and r["taken"] <= 3 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    expected = brute.targets(sizes)
    assert all(r["target"] == pytest.approx(expected[r["source"]]) and r["source_size"] == sizes[r["source"]] for r in found)
    assert sum(abs(taken[s] - expected[s]) for s in sizes) < 0.1 * sum(sizes.values())
    assert sorted(map(tuple, run(spark, "op10_mixing"))) == sorted(map(tuple, found))


def test_pipeline_stage_by_stage(spark, docs):
    """Each stage on its own input, with a column that has the name of a figure."""
    kept = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "'x' as n_words", "1 as shard")
    columns, seen = kept.columns, {}
    for name, function in corpus_pipeline.STAGES:
        before = kept.collect()
        kept = corpus_pipeline.stage(function(spark, kept, SF), "test")
        seen[name] = before, kept.collect()
        if name != "sharding":
            assert kept.columns == columns
    before, after = seen["quality rules"]
    passed = set()
    for r in before:
        n, _, _, _, three, covered, longest = brute.repetition(r["text"])
        if n >= 50 and 100 * three <= 50 * n and covered <= 0.3 * n and longest <= 100:
            passed.add(r["doc_id"])
    assert {r["doc_id"] for r in after} == passed
    before, after = seen["near-duplicates"]
    groups = brute.near_groups({r["doc_id"]: r["text"] for r in before}, 5)
    assert sorted(r["doc_id"] for r in after) == sorted(set(groups.values()))
    before, after = seen["benchmark decontamination"]
    items = [brute.fold(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r["doc_id"] for r in before if not any(item in brute.fold(r["text"]) for item in items)]
    assert sorted(r["doc_id"] for r in after) == sorted(clean)
    before, after = seen["mixing"]
    copies = Counter(r["doc_id"] for r in after)
    assert set(copies) <= {r["doc_id"] for r in before} and max(copies.values()) <= 3
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    words = sum(len(brute.words(r["text"])) for r in before)
    assert abs(sum(len(brute.words(r["text"])) for r in after) - words) < 0.05 * words
    before, after = seen["sharding"]
    assert Counter(r["doc_id"] for r in after) == copies and {r["shard"] for r in after} <= set(range(40))


def test_pipeline_with_nulls_ties_and_nothing(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows_ = [(1, text, "a"), (1, text, "a"), (None, text, None), (None, text, None), (2, None, "b"), (3, "", "b"), (4, text, "b")]
    df = spark.createDataFrame(rows_, "doc_id long, text string, source string")
    for start in (df, df.limit(0)):
        kept = start
        for _, function in corpus_pipeline.STAGES:
            kept = corpus_pipeline.stage(function(spark, kept, SF), "test")
        ids = {r["doc_id"] for r in kept.collect()}
        assert ids <= {1, None}


def test_documents_that_share_an_id_are_not_lost(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 80)) for _ in range(3)]
    rows_ = [(7, texts[0], "a"), (7, texts[1], "b"), (7, texts[1], "b"), (5, texts[1] + " more", "c"), (9, texts[2], "d"), (None, texts[2], "e")]
    df = spark.createDataFrame(rows_, "doc_id long, text string, first string")
    kept = dict(corpus_pipeline.STAGES)["near-duplicates"](spark, df, SF)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows_[0], rows_[3], rows_[4], rows_[5]], key=repr)
    placed = dict(corpus_pipeline.STAGES)["sharding"](spark, df, SF).collect()
    assert sorted(r["first"] for r in placed) == list("abbcde")


def test_secrets_keep_columns_of_any_name(spark):
    from risklake.llm import secrets

    df = spark.createDataFrame([(1, 2, "password = abcdefghijklmnop " * 3000), (3, 4, None)], "_text int, _base int, t string")
    found = secrets.with_secrets(df, "t", ["_text", "_base"]).collect()
    assert [(r["_text"], r["_base"], len(r["secrets"])) for r in sorted(found)] == [(1, 2, 3000), (3, 4, 0)]


def test_mixing_shuffles_small_tables_as_large_ones(spark):
    """A join that is a broadcast on small tables only made the shuffle grow by steps."""
    mixed = dict(corpus_pipeline.STAGES)["mixing"](spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan.split("SortMergeJoin")[0]

"""Sharding, mixing and the url filter."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from risklake.llm import mixing, sharding, url_filter
from risklake.llm.common import positions
from tests.llm import brute


def sized(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, size long, source string, shard string, first string")


def test_shards_are_near_equal_and_places_gapless(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, int(rng.paretovariate(1.5) * 100), "s", "x", "y") for i in range(3000)]
    rows += [(None, 50, "s", "x", "y")] * 40 + [(5, 60, "s", "x", "y")] * 3 + [(9999, None, None, None, None)]
    placed = sharding.shard(sized(spark, rows), "doc_id", "size", 7, str(tmp_path / "map")).collect()
    assert len(placed) == len(rows)
    held, places = Counter(), {}
    for r in placed:
        held[r["shard"]] += r["size"] or 0
        places.setdefault(r["shard"], []).append(r["slot"])
    assert set(held) == set(range(7)) and max(held.values()) - min(held.values()) < 0.01 * sum(held.values()) / 7
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    slots = {r["doc_id"]: r["virtual_slot"] for r in placed if r["doc_id"] is not None}
    by_map = {r["virtual_slot"]: r["shard"] for r in sharding.load_map(spark, str(tmp_path / "map"), 1).collect()}
    assert len(by_map) == sharding.SLOTS and all(by_map[r["virtual_slot"]] == r["shard"] for r in placed)
    again = sharding.with_slot(sized(spark, rows), "doc_id").collect()
    assert all(slots[r["doc_id"]] == r["virtual_slot"] for r in again if r["doc_id"] is not None)


def test_shards_of_an_empty_table(spark, tmp_path):
    assert sharding.shard(sized(spark, []), "doc_id", "size", 7, str(tmp_path / "map")).count() == 0


def test_a_stored_map_is_edited_for_another_shard(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, int(rng.paretovariate(1.5) * 100), "s", "x", "y") for i in range(4000)]
    root = str(tmp_path / "map")
    before = {r["doc_id"]: r["shard"] for r in sharding.shard(sized(spark, rows), "doc_id", "size", 40, root).collect()}
    placed, moves = sharding.reshard(sized(spark, rows), "doc_id", "size", 41, root, 1)
    placed, moves = placed.collect(), {r["virtual_slot"]: r for r in moves.collect()}
    held, places = Counter(), {}
    for r in placed:
        held[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append(r["slot"])
        assert r["shard"] == (moves[r["virtual_slot"]]["target"] if r["virtual_slot"] in moves else before[r["doc_id"]])
    assert set(held) == set(range(41)) and all(sorted(p) == list(range(len(p))) for p in places.values())
    share = sum(r["bytes"] for r in moves.values()) / sum(held.values())
    assert 0.8 / 41 < share < 2 / 41 and max(held.values()) - min(held.values()) < 0.05 * sum(held.values()) / 41
    assert [r["shard"] for r in sharding.load_map(spark, root, 1).orderBy("virtual_slot").collect()] != [
        r["shard"] for r in sharding.load_map(spark, root, 2).orderBy("virtual_slot").collect()
    ]


def test_columns_of_the_user_stay(spark, tmp_path):
    df = sized(spark, [(1, 5, "s", "x", "y")]).withColumns({"first": F.lit("mine"), "_n": F.lit(7)})
    row = sharding.shard(df, "doc_id", "size", 2, str(tmp_path / "map")).first()
    assert (row["first"], row["_n"]) == ("mine", 7)


def test_rebalancing_moves_little():
    rng = random.Random(2)
    loads = [rng.randrange(1000) for _ in range(2000)]
    first = sharding.rebalance(sharding.first_map(10, 2000), loads, 10)
    assert sharding.rebalance(first, loads, 10) == first
    more = sharding.rebalance(first, loads, 11)
    held = Counter()
    for slot, shard in enumerate(more):
        held[shard] += loads[slot]
    assert set(held) == set(range(11)) and max(held.values()) - min(held.values()) < 50
    assert sum(a != b for a, b in zip(first, more)) < 2000 * 2 / 11
    fewer = sharding.rebalance(more, loads, 9)
    assert set(fewer) == set(range(9))
    assert sharding.rebalance([0, 0, 0], [5, 0, 0], 2) in ([0, 0, 0], [0, 1, 1], [0, 0, 1], [0, 1, 0])


def mixture(spark, rows):
    df = sized(spark, rows)
    return [r.asDict() for r in mixing.mix(df, "doc_id", "source", "size").collect()]


@pytest.mark.parametrize("block", [mixing.BLOCK_ROWS, 20])
def test_mix_comes_near_its_targets(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rng = random.Random(3)
    sources = ["a", "b", "B", "é", None, "tiny", "z"]
    rows = [(i, min(int(rng.paretovariate(1.2) * 20), 400), rng.choice(sources[:5] + ["z"] * 4), "", "") for i in range(1500)]
    rows += [(2000 + i, 10, "tiny", "", "") for i in range(5)] + [(3000, None, "a", "", ""), (3001, 0, "a", "", ""), (None, 12, "a", "", "")]
    found = mixture(spark, rows)
    assert len(found) == len(rows)
    sizes, taken, target, longest = Counter(), Counter(), {}, Counter()
    for r in found:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
        assert 0 <= r["copies"] <= mixing.LIMIT
    expected = brute.targets(sizes)
    for source in sizes:
        assert target[source] == pytest.approx(expected[source])
        assert all(r["source_size"] == sizes[source] for r in found if r["source"] == source)
        assert abs(taken[source] - target[source]) <= longest[source]
        assert source == "tiny" or abs(taken[source] - target[source]) <= 0.02 * target[source] + 30
    assert taken["tiny"] == 3 * sizes["tiny"]
    assert sorted(map(str, mixture(spark, rows))) == sorted(map(str, found))


def test_mix_of_nothing(spark):
    assert mixture(spark, []) == []
    assert [r["copies"] for r in mixture(spark, [(1, 0, "a", "", ""), (2, None, None, "", "")])] == [0, 0]


def test_mix_with_one_document_each(spark):
    found = mixture(spark, [(1, 100, "a", "", ""), (2, 100, "b", "", "")])
    assert {r["source"]: r["target"] for r in found} == pytest.approx({"a": 200 * 5 / 7, "b": 200 * 2 / 7})


def test_pivot_keeps_words_and_expectations():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 50, 30)
    share = rng.random(30)
    hits = np.zeros(30)
    for _ in range(3000):
        out, open_ = mixing.pivot(size, share, rng.random(30))
        assert np.dot(size, out) == pytest.approx(np.dot(size, share))
        assert all(x in (0.0, 1.0) for i, x in enumerate(out) if i != open_)
        hits += out
    assert np.abs(hits / 3000 - share).max() < 0.04


def test_positions_follow_the_order(spark):
    values = [5, None, 3, 3, 8, 1, None]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(4)
    rows = sorted(tuple(r) for r in positions(df, [F.col("v").asc_nulls_last()], "t", "at").select("at", "v").collect())
    assert rows == list(enumerate([1, 3, 3, 5, 8, None, None]))


URLS = {
    "https://a.net/x": ("a.net", "/x", "net/", "block"),
    "https://WWW.Example.NET/en/1?q#f": ("www.example.net", "/en/1", "example.net/en/", "allow"),
    "http://example.net/en": ("example.net", "/en", "net/", "block"),
    "http://notexample.com/de/": ("notexample.com", "/de/", None, None),
    "http://m.example.com/de/5": ("m.example.com", "/de/5", "example.com/de/", "block"),
    "ftp://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"),
    "http://x.org/FR/": ("x.org", "/FR/", None, None),
    "http://x.net?a=/b": ("x.net", "", None, None),
    "http://x.net#://y.org/fr/": ("x.net", "", None, None),
    "a://b://c.net/d": ("b:", "//c.net/d", None, None),
    "no scheme": ("", "", None, None),
    "": ("", "", None, None),
    None: ("", "", None, None),
    "://": ("", "", None, None),
    "http://é.net/ü": ("é.net", "/ü", "net/", "block"),
    "http://a\nb.net/c\nd": ("a\nb.net", "/c\nd", "net/", "block"),
}


def test_rules_and_parts_of_urls(spark):
    df = spark.createDataFrame([(u, "x", "y") for u in [*URLS, "http://x.net/" + "a" * 200_000]], "url string, host string, rule string")
    rows = url_filter.judge(df, "url", url_filter.seed(spark)).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        if r["url"] in URLS:
            host, path, rule, verdict = URLS[r["url"]]
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule), r["url"]
            assert verdict in (None, r["verdict"])
        assert r["verdict"] in ("allow", "block")
    assert url_filter.judge(df.limit(0), "url", url_filter.seed(spark)).count() == 0


def test_held_out_accuracy(spark):
    """Hosts that the model has not seen: names put together in other ways."""
    bad = ["mega-casino-win", "freebets24", "buy-cheap-pills", "adultcams-x", "trackads", "spamlinks", "lucky-poker", "freewarez"]
    good = ["daily-news", "citylibrary", "gardenblog", "thtion", "weatherstation", "erther", "schoolmuseum", "onthen", "nature-wiki"]
    rows = [(f"https://{s}{name}.{end}/{lang}/{n}", name in bad)
            for name in bad + good for s in ("", "www.", "m.") for end in ("example.com", "test") for lang, n in (("en", 5), ("es", 77))]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    judged = url_filter.judge(df, "url", url_filter.seed(spark), rules=()).collect()
    assert np.mean([(r["verdict"] == "block") == r["bad"] for r in judged]) >= 0.95


def test_a_labelled_table_of_ones_own(spark):
    labelled = spark.createDataFrame([(f"http://{k}{i}.x/{k}", float(k == "zz")) for k in ("zz", "yy") for i in range(40)], "url string, label double")
    df = spark.createDataFrame([("http://zz9.x/zz",), ("http://yy9.x/yy",)], "url string")
    assert [r["verdict"] for r in url_filter.judge(df, "url", labelled, rules=()).collect()] == ["block", "allow"]
    only = labelled.where("label = 0")
    assert [r["verdict"] for r in url_filter.judge(df, "url", only, rules=()).collect()] == ["allow", "allow"]

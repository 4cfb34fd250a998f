"""Folded views against plain joins on books with copies, orphans, NULLs and keys that hold a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

import naive
from risklake.operators import skew
from risklake.plans import gold

SCHEMAS = {
    "c": "cliente_id string, nome string, score_credito long, faixa_risco string, estado string",
    "l": "emprestimo_id string, cliente_id string, valor_emprestado double, taxa_juros double, status string",
    "p": "emprestimo_id string, dias_atraso double",
    "v": "evento_id string, cliente_id string, severidade long",
}


def make_book(seed: int, hot: bool) -> dict[str, list]:
    """Rows of a random book. With ``hot``, one client and one loan hold a third of the rows of each table."""
    r = random.Random(seed)

    def key(n: int):
        return "1" if hot and r.random() < 0.34 else str(r.randrange(n))

    def some(value):
        return None if r.random() < 0.1 else value

    bands = ["BAIXO", "MEDIO", "ALTO"]
    profiles = []
    for _ in range(60):
        k = key(40)
        profiles.append((k, r.choice(["Ana", "Bia", "Caio"]), 500 + 100 * r.randrange(3), r.choice(bands),
                         some(r.choice(["SP", "RJ"]))))
    return {
        "c": profiles + [r.choice(profiles) for _ in range(20)],
        "l": [
            (some(key(90)), some(key(45)), some(r.randrange(100, 900) / 4), some(r.randrange(8, 80) / 10),
             r.choice(["ATIVO", "QUITADO", "INADIMPLENTE"]))
            for _ in range(150)
        ],
        "p": [(some(key(95)), some(float(r.randrange(-3, 90)))) for _ in range(300)],
        "v": [(some(str(i)), some(key(45)), r.randrange(5)) for i in range(60)],
    }


def load(spark, book):
    frames = {}
    for name, schema in SCHEMAS.items():
        frames[name] = spark.createDataFrame(book[name], schema)
        frames[name].createOrReplaceTempView(name)
    return frames


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert dict(left.dtypes) == dict(right.dtypes)
    assert sorted(map(repr, left.select(columns).collect())) == sorted(map(repr, right.select(columns).collect()))


@pytest.fixture(params=[(1, False), (2, True), (3, True)], ids=["even", "hot", "hot2"])
def book(request, spark):
    return load(spark, make_book(*request.param))


@pytest.fixture(params=[False, True], ids=["plain", "spread"])
def spreading(request, spark):
    """With spreading on, adaptive execution splits partitions of joins that are hardly larger than others."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100",
    }
    for key, value in changed.items() if request.param else ():
        spark.conf.set(key, value)
    yield request.param
    for key in changed:
        spark.conf.unset(key)


def test_por_estado(spark, book, spreading):
    same(gold.inadimplencia_por_estado(book["l"], book["c"]), naive.por_estado(spark))


def test_ranking(spark, book, spreading):
    same(gold.ranking_risco_clientes(book["c"], book["l"], book["v"]), naive.ranking(spark))


def test_por_score(spark, book, spreading):
    same(gold.risco_por_score(book["c"], book["l"]), naive.por_score(spark))


def test_alerta(spark, book, spreading):
    same(gold.alerta_risco_iminente(book["c"], book["l"], book["p"]), naive.alerta(spark))


def test_hot_keys_are_counted(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in skew.hot_keys(df, "k", share=0.1).collect()] == [(7, 7)]  # a third, in slices of a twentieth
    assert [tuple(r) for r in skew.hot_keys(df, "k").collect()] == [(7, 3)]
    assert skew.hot_keys(df.where("k < 0"), "k").collect() == []


def test_thousands_of_hot_keys_are_all_split(spark):
    df = spark.range(300_000).select((F.col("id") % 3000).alias("k"))
    hot = skew.hot_keys(df, "k", share=1 / 4000).collect()
    assert len(hot) == 3000 and all(r["_slices"] > 1 for r in hot)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("copies", [False, True])
def test_join_spread_equals_join_and_spreads(spark, tmp_path, how, copies):
    """Also rows that are equal in all columns."""
    rows = spark.range(2000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    rows = rows.withColumn("id", F.lit(1)) if copies else rows
    rows.write.parquet(str(tmp_path / "rows"))
    left = spark.read.parquet(str(tmp_path / "rows"))
    # a lookup grouped by the join key is the case adaptive execution does not split
    right = spark.range(0, 2000, 7).groupBy(F.col("id").alias("k")).agg(F.sum(F.col("id") * 2).alias("w"))
    same(skew.join_spread(left, right, "k", how, share=0.01), left.join(right, "k", how))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = skew.join_spread(left, right, "k", how, share=0.01)
        tasks = spread.where("k = 7").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert tasks == 8


def test_defaults_below_a_cent_stay_in_the_ranking(spark):
    rows = {
        "c": [("1", "Ana", 500, "ALTO", "SP")],
        "l": [("a", "1", 0.0000004, 2.0, "INADIMPLENTE"), ("b", "1", 10.0, 2.0, "ATIVO")],
        "v": [],
    }
    frames = {name: spark.createDataFrame(rows[name], SCHEMAS[name]) for name in rows}
    assert gold.ranking_risco_clientes(frames["c"], frames["l"], frames["v"]).count() == 1


def test_junk_amounts_do_not_stop_the_views(spark):
    book = make_book(4, False)
    junk = [1e20, float("inf"), 123456789012345678.0, -1e18]
    book["l"] = [(*row[:2], junk[i % 4] if i % 40 == 0 else row[2], *row[3:]) for i, row in enumerate(book["l"])]
    tables = load(spark, book)
    states = gold.inadimplencia_por_estado(tables["l"], tables["c"])
    plain = spark.sql("""select estado, sum(if(status = 'INADIMPLENTE', valor_emprestado, 0D)) as v
                         from l join c using (cliente_id) group by estado""")
    expected = {row.estado: row.v for row in plain.collect()}
    got = {row.estado: row.valor_em_risco for row in states.collect()}
    assert got.keys() == expected.keys()
    for state, value in expected.items():
        assert got[state] == pytest.approx(value, rel=1e-12), state
    dated = tables["l"].withColumn("data_concessao", F.lit("2024-01-01").cast("date"))
    assert gold.evolucao_inadimplencia(dated).count() == 1
    assert gold.risco_por_score(tables["c"], tables["l"]).count() == 3
    assert gold.ranking_risco_clientes(tables["c"], tables["l"], tables["v"]).where("ranking_exposicao = 1").count()
    junk_score = tables["c"].withColumn("score_credito", F.lit("-9223372036854775808").cast("long"))
    assert gold.alerta_risco_iminente(junk_score, tables["l"], tables["p"]).count() > 0

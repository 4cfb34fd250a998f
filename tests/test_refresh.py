"""The whole refresh on the golden files: raw, cleaned, views, audit, and refreshing again."""

import os
import datetime as dt
import threading

import pytest

from golden import write_files
from risklake.plans import gold, silver
from risklake.plans.refresh import export_views, refresh, reopen


@pytest.fixture(scope="module")
def book(spark, tmp_path_factory):
    source = write_files(tmp_path_factory.mktemp("raw"))
    return refresh(spark, source, str(tmp_path_factory.mktemp("lake")), version="v1")


def rows(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]


def by_key(df, key, *columns):
    return {row[0]: tuple(row)[1:] for row in df.select(key, *columns).collect()}


def test_bronze_is_text_with_ingest_time(book):
    raw = book.tables["bronze_clientes"]
    assert [f.dataType.simpleString() for f in raw.schema] == ["string"] * 8 + ["timestamp"]
    assert raw.columns[-1] == "_ingestao"
    assert raw.where("score_credito is null").count() == 1
    assert "_ingestao" not in book.tables["silver_clientes"].columns


def test_silver_clientes(book):
    got = by_key(
        book.tables["silver_clientes"],
        "cliente_id", "nome", "cpf", "data_nascimento", "score_credito", "renda_mensal", "estado", "faixa_risco",
        "faixa_renda",
    )
    assert got == {
        "1": ("Ana Souza", "123456789-01", dt.date(1990, 5, 10), 780, 12000.5, "SP", "BAIXO", "ALTA"),
        "2": ("Bruno Lima", "222333444-55", dt.date(1985, 1, 20), 600, 5000.0, "RJ", "MEDIO", "MEDIA"),
        "3": ("Caio", "333444555-66", None, 498, None, "MG", "MUITO_ALTO", "MUITO_BAIXA"),
        "4": ("Duda", "444555666-77", dt.date(2000, 2, 29), 500, 1999.0, "SP", "ALTO", "MUITO_BAIXA"),
        "8": ("Hugo", "888999000-11", dt.date(1995, 6, 6), 0, 2500.0, "BA", "MUITO_ALTO", "BAIXA"),
    }


def test_silver_emprestimos(book):
    got = by_key(book.tables["silver_emprestimos"], "emprestimo_id", "valor_total", "custo_credito")
    assert got == {
        "10": (10800.0, 800.0), "11": (6000.0, 1000.0), "12": (9600.0, 1600.0), "13": (2400.0, 400.0),
        "14": (1200.0, 200.0), "16": (4800.0, 800.0), "17": (840.0, 140.0),
    }


def test_silver_pagamentos(book):
    got = by_key(book.tables["silver_pagamentos"], "pagamento_id", "dias_atraso", "diferenca_valor", "status")
    assert {key: value[0] for key, value in got.items()} == {
        "100": -2.0, "101": 45.0, "102": None, "103": 70.0, "104": 10.0, "105": 5.0,
    }
    assert [got[key][1] for key in ("100", "101", "102", "103", "105")] == [0.0, 18.0, None, 4.0, 10.0]
    assert got["104"][1] == 71.4 - 70
    assert got["100"][2] == "PAGO"


def test_silver_eventos(book):
    got = by_key(book.tables["silver_eventos_risco"], "evento_id", "tipo_evento", "severidade")
    assert got == {
        "1000": ("ATRASO_30", 1), "1001": ("CALOTE", 4), "1002": ("ATRASO_60", 0), "1003": ("ATRASO_90", 3),
    }


def test_gold_por_estado(book):
    assert rows(book.views["gold_inadimplencia_por_estado"]) == [
        ("SP", 3, 2, 66.67, 9000.0),
        ("RJ", 2, 1, 50.0, 8000.0),
        ("MG", 1, 0, 0.0, 0.0),
    ]


def test_gold_evolucao(book):
    assert rows(book.views["gold_evolucao_inadimplencia"]) == [
        ("2024-01", 2, 1, 50.0, 5000.0, None, None, None),
        ("2024-02", 1, 1, 100.0, 8000.0, 1, 0, 0.0),
        ("2024-03", 2, 0, 0.0, 0.0, 1, -1, -100.0),
        ("2024-05", 2, 1, 50.0, 4000.0, 0, 1, None),
    ]


RANKED = [
    "cliente_id", "total_emprestimos", "valor_total_emprestado", "valor_inadimplente", "total_eventos_risco",
    "maior_severidade", "ranking_exposicao", "pct_inadimplente",
]


def test_gold_ranking(book):
    assert rows(book.views["gold_ranking_risco_clientes"], *RANKED) == [
        ("1", 4, 30000.0, 10000.0, 4, 4, 1, 33.33),
        ("2", 2, 10000.0, 8000.0, 2, 0, 2, 80.0),
        ("4", 1, 4000.0, 4000.0, 0, None, 3, 100.0),
    ]


def test_ranking_without_fan_out(book):
    tables = [book.tables[f"silver_{name}"] for name in ("clientes", "emprestimos", "eventos_risco")]
    assert rows(gold.ranking_risco_clientes(*tables, fan_out=False), *RANKED) == [
        ("2", 2, 10000.0, 8000.0, 1, 0, 1, 80.0),
        ("1", 2, 15000.0, 5000.0, 2, 4, 2, 33.33),
        ("4", 1, 4000.0, 4000.0, 0, None, 3, 100.0),
    ]


def test_gold_por_score(book):
    assert rows(book.views["gold_risco_por_score"]) == [
        ("BAIXO", 780.0, 1, 2, 1, 1.35, 7500.0, 50.0),
        ("MEDIO", 600.0, 1, 2, 1, 2.75, 5000.0, 50.0),
        ("ALTO", 500.0, 1, 1, 1, 5.5, 4000.0, 100.0),
        ("MUITO_ALTO", 498.0, 1, 1, 0, 7.0, 1000.0, 0.0),
    ]


def test_gold_alerta(book):
    columns = "cliente_id qtd_atrasos maior_atraso media_atraso exposicao_total score_risco_composto".split()
    assert rows(book.views["gold_alerta_risco_iminente"], *columns) == [
        ("3", 1, 70.0, 70.0, 1000.0, 57.6),
        ("1", 2, 45.0, 25.0, 10000.0, 38.5),
    ]


def test_previews(book):
    states = gold.preview_estados(book.views["gold_inadimplencia_por_estado"], 2)
    assert rows(states, "estado") == [("SP",), ("RJ",)]
    bands = gold.preview_score(book.views["gold_risco_por_score"])
    assert bands.columns == [
        "faixa_risco", "score_medio", "total_emprestimos", "inadimplentes", "taxa_inadimplencia_pct",
    ]


def test_audit(book):
    assert dict(rows(book.audit)) == {
        "bronze_clientes": 8, "bronze_emprestimos": 9, "bronze_pagamentos": 7, "bronze_eventos_risco": 5,
        "silver_clientes": 5, "silver_emprestimos": 7, "silver_pagamentos": 6, "silver_eventos_risco": 4,
    }


def test_names_are_registered(spark, book):
    assert spark.table("gold_risco_por_score").count() == 4
    assert spark.sql("select count(*) from silver_pagamentos").first()[0] == 6


def test_refreshing_again_gives_the_same(spark, tmp_path, book):
    (tmp_path / "raw").mkdir()
    source = write_files(tmp_path / "raw")
    for version in ("v2", "v2"):  # the second run replaces the first
        again = refresh(spark, source, str(tmp_path / "lake"), version=version)
    for name, df in {**book.tables, **book.views}.items():
        other = {**again.tables, **again.views}[name]
        assert sorted(map(repr, rows(df.drop("_ingestao")))) == sorted(map(repr, rows(other.drop("_ingestao")))), name


def test_a_written_version_reopens(spark, book):
    again = reopen(spark, book.path)
    for name, df in {**book.tables, **book.views}.items():
        other = {**again.tables, **again.views}[name]
        assert df.columns == other.columns
        assert sorted(map(repr, rows(df))) == sorted(map(repr, rows(other))), name
    assert sorted(rows(again.audit)) == sorted(rows(book.audit))


def test_failed_refresh_leaves_names_alone(spark, tmp_path, book):
    source = write_files(tmp_path)
    (tmp_path / "pagamentos.csv").write_text("pagamento_id;outra\n1;2\n")
    before = spark.table("silver_clientes").inputFiles()
    with pytest.raises(Exception, match="no column emprestimo_id"):
        refresh(spark, source, str(tmp_path / "lake"), version="broken")
    assert spark.table("silver_clientes").inputFiles() == before


def test_views_are_exported(spark, book):
    stored = export_views(book)
    assert set(stored) == set(book.views)
    for name, df in stored.items():
        assert sorted(map(repr, rows(df))) == sorted(map(repr, rows(book.views[name]))), name


def test_defining_views_runs_nothing(spark, book):
    silver = [book.tables[f"silver_{name}"] for name in ("clientes", "emprestimos", "pagamentos")]
    context = spark.sparkContext
    context.setJobGroup("views", "views")
    gold.views(*silver, book.views["gold_ranking_risco_clientes"])
    assert not context.statusTracker().getJobIdsForGroup("views")
    book.views["gold_inadimplencia_por_estado"].count()
    assert context.statusTracker().getJobIdsForGroup("views")
    context.setLocalProperty("spark.jobGroup.id", None)


def test_reopening_writes_nothing(spark, book):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = sorted(os.listdir(folder)) if os.path.isdir(folder) else []
    reopen(spark, book.path).views["gold_ranking_risco_clientes"].count()
    assert (sorted(os.listdir(folder)) if os.path.isdir(folder) else []) == before


def test_ranking_does_not_wait_for_payments(spark, tmp_path, monkeypatch):
    """It does not read them, and they take longest: what they leave idle is used."""
    ranked, clean, rank = threading.Event(), silver.TABLES["pagamentos"], gold.ranking_risco_clientes

    def ranking(*tables):
        ranked.set()
        return rank(*tables)

    def payments(bronze):
        assert ranked.wait(60)
        return clean(bronze)

    monkeypatch.setitem(silver.TABLES, "pagamentos", payments)
    monkeypatch.setattr(gold, "ranking_risco_clientes", ranking)
    (tmp_path / "raw").mkdir()
    result = refresh(spark, write_files(tmp_path / "raw"), str(tmp_path / "lake"))
    assert result.tables["silver_pagamentos"].count() == 6


def test_files_are_cut_into_more_tasks_than_cores(spark, tmp_path, monkeypatch):
    """Else the last few tasks of a load run alone."""
    seen, setting, clean = [], "spark.sql.files.minPartitionNum", silver.TABLES["pagamentos"]
    monkeypatch.setitem(silver.TABLES, "pagamentos", lambda df: seen.append(spark.conf.get(setting)) or clean(df))
    before = spark.conf.get(setting, None)
    (tmp_path / "raw").mkdir()
    refresh(spark, write_files(tmp_path / "raw"), str(tmp_path / "lake"))
    assert [int(n) for n in seen] == [4 * spark.sparkContext.defaultParallelism]
    assert spark.conf.get(setting, None) == before

"""The plans that large books depend on: cleaning without shuffles, pruned scans, no products, split hot keys."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from golden import write_files
from risklake.plans import gold, loanbook, silver
from risklake.plans.refresh import refresh


@pytest.fixture(scope="module")
def book(spark, tmp_path_factory):
    source = write_files(tmp_path_factory.mktemp("raw"))
    return refresh(spark, source, str(tmp_path_factory.mktemp("lake")))


@pytest.fixture
def settings(spark):
    changed = []

    def change(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            changed.append((key, spark.conf.get(key)))
            spark.conf.set(key, value)

    yield change
    for key, value in reversed(changed):
        spark.conf.set(key, value)


def plan(df, mode="formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_cleaning_does_not_shuffle(book):
    from risklake.plans.silver import TABLES

    for entity, clean in TABLES.items():
        text = plan(clean(book.tables[f"bronze_{entity}"]))
        assert "Exchange" not in text, entity
        assert "PushedFilters: [IsNotNull" in text, entity


def test_views_have_no_products_and_only_small_single_partitions(book, settings):
    settings(autoBroadcastJoinThreshold="-1")
    for name, df in book.views.items():
        text = plan(df, "simple")
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
        assert "Expand" not in text, name
        # what is gathered has been aggregated: counts of rows, or one row per month
        lines = text.split("\n")
        single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
        assert all("Aggregate" in " ".join(lines[i + 1 : i + 3]) for i in single), name


def test_late_payments_are_filtered_at_the_scan(book):
    tables = [book.tables[f"silver_{name}"] for name in ("clientes", "emprestimos", "pagamentos")]
    text = plan(gold.alerta_risco_iminente(*tables))
    assert "GreaterThan(dias_atraso,0.0)" in text
    assert "ReadSchema: struct<emprestimo_id:string,dias_atraso:double>" in text


def test_views_read_few_columns(book):
    text = plan(gold.evolucao_inadimplencia(book.tables["silver_emprestimos"]))
    assert "ReadSchema: struct<valor_emprestado:double,data_concessao:date,status:string>" in text


def test_counting_stored_rows_reads_no_column(book):
    assert plan(book.audit).count("ReadSchema: struct<>") == 8


def test_folded_sides_join_without_another_shuffle(book, settings):
    settings(autoBroadcastJoinThreshold="-1")
    tables = [book.tables[f"silver_{name}"] for name in ("clientes", "emprestimos", "eventos_risco")]
    text = plan(gold.exposicao(*tables, fan_out=True), "simple")
    # loans and events together, clients, and both sides of the join for it
    assert text.count("Exchange hashpartitioning") == 4
    assert text.count("ENSURE_REQUIREMENTS") == 4 and text.count("Scan parquet") == 3


def test_views_read_their_tables_once(book, settings):
    settings(autoBroadcastJoinThreshold="-1")
    clientes, emprestimos, pagamentos, eventos = (book.tables[f"silver_{n}"] for n in ("clientes", "emprestimos", "pagamentos", "eventos_risco"))
    for df, scans in (
        (gold.inadimplencia_por_estado(emprestimos, clientes), 2),
        (gold.exposicao(clientes, emprestimos, eventos, fan_out=False), 3),
        (gold.alerta_risco_iminente(clientes, emprestimos, pagamentos), 3),
        (gold.risco_por_score(clientes, emprestimos), 4),  # averages over loans per client, distinct loans per band
        (loanbook.politica_preco(emprestimos, clientes), 2),
        (loanbook.perda_esperada(emprestimos, clientes), 2),
    ):
        assert plan(df, "simple").count("FileScan parquet") == scans


def test_parsing_stays_in_generated_code(book):
    """Every projection of the cleaning belongs to a whole stage."""
    from risklake.plans.silver import TABLES

    for entity, clean in TABLES.items():
        text = plan(clean(book.tables[f"bronze_{entity}"]).where("true"), "codegen")
        assert "Found 1 WholeStageCodegen subtrees" in text and "Project" in text, entity
        assert all(line.lstrip("+-: ").startswith("*") for line in plan(clean(book.tables[f"bronze_{entity}"]), "simple").split("\n") if "Project" in line)


def test_cleaning_is_compiled_in_any_session(book):
    """HotSpot interprets methods of more than 8000 bytes, unless the session keeps Spark from making them."""
    for entity, clean in silver.TABLES.items():
        stages = clean(book.tables[f"bronze_{entity}"])._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
        assert sizes and max(sizes) < 8000, entity


def test_each_day_is_parsed_once(book):
    """A day that its month lacks costs an exception in each cast."""
    optimized = silver.pagamentos(book.tables["bronze_pagamentos"])._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count(", 1, 10) as date)") == 2  # due and paid
    assert "length(" not in optimized.replace("octet_length(", "")  # bytes need no count of characters


def test_preview_is_a_top_k(book):
    text = plan(gold.preview_estados(book.views["gold_inadimplencia_por_estado"]), "simple")
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_a_client_with_a_third_of_the_loans_is_split(spark, settings):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        adaptive__advisoryPartitionSizeInBytes="10k",
        shuffle__partitions="32",
    )
    client = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    loans = spark.range(0, 60000, 1, 16).select(
        F.col("id").alias("emprestimo_id"),
        client.alias("cliente_id"),
        (F.col("id") % 1000 + 0.25).alias("valor_emprestado"),
        F.when(F.col("id") % 2 == 0, "INADIMPLENTE").otherwise("ATIVO").alias("status"),
    )
    clients = spark.range(5000).select(
        F.col("id").alias("cliente_id"), F.concat(F.lit("E"), F.col("id") % 7).alias("estado")
    )
    states = gold.inadimplencia_por_estado(loans, clients)
    assert sum(row.total_emprestimos for row in states.collect()) == 60000
    assert "SortMergeJoin(skew=true)" in plan(states, "simple")


def test_lookups_grouped_by_the_key_are_copied_for_split_rows(spark, settings):
    """Also those of the alert: loans by client, late payments by loan, hot in both."""
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        adaptive__advisoryPartitionSizeInBytes="10k",
        shuffle__partitions="32",
    )
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    loans = spark.range(0, 60000, 1, 16).select(
        hot.alias("emprestimo_id"), F.col("id").alias("cliente_id"), F.lit(1.5).alias("valor_emprestado"), F.lit("ATIVO").alias("status")
    )
    late = spark.range(0, 5000, 1, 8).select(F.col("id").alias("emprestimo_id"), F.lit(3.0).alias("dias_atraso"))
    clients = spark.range(60000).select(
        F.col("id").alias("cliente_id"), F.lit("n").alias("nome"), F.lit(500).cast("long").alias("score_credito"),
        F.lit("ALTO").alias("faixa_risco"), F.lit("SP").alias("estado"),
    )
    alert = gold.alerta_risco_iminente(clients, loans, late)
    assert len(alert.collect()) == 60000
    assert "SortMergeJoin(skew=true)" in plan(alert, "simple")

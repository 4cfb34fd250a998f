"""One query per dataset or operator. Dates are shown as ISO text, counts as longs."""

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks import tables as t
from risklake.functions import bands, money, parse, text
from risklake.operators.rank import global_rank
from risklake.operators.skew import join_spread
from risklake.operators.stage import stage_path
from risklake.plans import gold, loanbook, silver
from risklake.plans.refresh import count_rows, refresh
from risklake.sources.delimited import read_raw, write_all_raw
from risklake.sources.schemas import SOURCES

AS_OF = "2000-01-01"


def _plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text and integers as longs."""
    shown = {}
    for field in df.schema:
        if isinstance(field.dataType, T.DateType):
            shown[field.name] = F.col(field.name).cast("string")
        elif isinstance(field.dataType, T.IntegerType):
            shown[field.name] = F.col(field.name).cast("long")
    return df.withColumns(shown)


def _por_estado(spark: SparkSession, sf: str) -> DataFrame:
    return gold.inadimplencia_por_estado(t.emprestimos(spark, sf), t.clientes(spark, sf))


def _por_score(spark: SparkSession, sf: str) -> DataFrame:
    return gold.risco_por_score(t.clientes(spark, sf), t.emprestimos(spark, sf))


def _ranking(spark: SparkSession, sf: str, fan_out: bool) -> DataFrame:
    return gold.ranking_risco_clientes(
        t.clientes(spark, sf), t.emprestimos(spark, sf), t.eventos(spark, sf), fan_out=fan_out
    )


def _alerta(spark: SparkSession, sf: str) -> DataFrame:
    return gold.alerta_risco_iminente(t.clientes(spark, sf), t.emprestimos(spark, sf), t.pagamentos(spark, sf))


def _inteiro_real(spark: SparkSession, sf: str) -> DataFrame:
    order = F.col("o_orderkey").cast("string")
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    dirty = {
        "inteiro_virgula": F.concat(order, F.lit(",50")),
        "branco": F.concat(F.lit(" \t"), amount),
        "sinal": F.concat(F.lit("-"), amount, F.lit("abc")),
        "expoente": F.concat(amount, F.lit("e2")),
        "milhar": F.concat(order, F.lit("."), order, F.lit(",00")),
        "lixo": F.concat(F.lit("R$ "), amount),
        "longo": F.concat(F.lit("99999999999999999999"), order),
        "palavra": F.col("o_orderstatus"),
    }
    columns = [F.col("o_orderkey").alias("chave")]
    for name, value in dirty.items():
        columns.append(parse.to_integer(value).alias(f"{name}_inteiro"))
        columns.append(parse.to_real(value).alias(f"{name}_real"))
    return t.table(spark, sf, "orders").select(*columns)


def _data(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    iso = day.cast("string")
    dirty = {
        "iso": iso,
        "espaco_antes": F.concat(F.lit(" "), iso),
        "espaco_depois": F.concat(iso, F.lit("  ")),
        "relogio": F.concat(iso, F.lit(" 10:30")),
        "zulu": F.concat(iso, F.lit("T23:59:59.999Z")),
        "fuso": F.concat(iso, F.lit(" 23:30:00-03:00")),
        "fuso_leste": F.concat(iso, F.lit("T01:30:00 +02:00")),
        "barra": F.date_format(day, "dd/MM/yyyy"),
        "curta": F.regexp_replace(iso, "-0", "-"),
        "mes_treze": F.regexp_replace(iso, "-[0-9]{2}-", "-13-"),
        "dia_31": F.concat(F.substring(iso, 1, 8), F.lit("31")),
        "hora_24": F.concat(iso, F.lit(" 24:00")),
        "prioridade": F.col("o_orderpriority"),
    }
    texts = t.table(spark, sf, "orders").select(F.col("o_orderkey").alias("chave"), *[v.alias(f"t_{name}") for name, v in dirty.items()])
    found = parse.with_millis(texts, {f"m_{name}": F.col(f"t_{name}") for name in dirty})
    julian = {name: parse.millis_to_julian(F.col(f"m_{name}")) for name in dirty}
    moments = {
        "dias_fuso": julian["fuso"] - julian["iso"],
        "dias_relogio": julian["relogio"] - julian["zulu"],
        "dias_barra": julian["barra"] - julian["iso"],
        "dias_31": julian["dia_31"] - julian["iso"],
        "dias_24": julian["hora_24"] - julian["iso"],
    }
    return found.select(
        "chave",
        *[parse.calendar_day(F.col(f"t_{name}"), F.col(f"m_{name}")).alias(name) for name in dirty],
        *[value.alias(name) for name, value in moments.items()],
    )


def _limpeza(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.table(spark, sf, "orders")
    return orders.select(
        F.col("o_orderkey").alias("chave"),
        text.code(F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" "))).alias("codigo"),
        text.code(F.concat(F.lit(" são "), F.lower("o_orderstatus"), F.lit("\t"))).alias("acento"),
        text.document_number(F.concat(F.lit("123."), "o_orderkey", F.lit(".789-01"))).alias("documento"),
    )


def _na(spark: SparkSession, sf: str) -> DataFrame:
    word = (
        F.when(F.col("event_type") == "click", F.lit("NA"))
        .when(F.col("event_type") == "view", F.lit(" NA "))
        .when(F.col("event_type") == "error", F.lit("null"))
        .when(F.col("value") > 20, F.lit(""))
        .otherwise(F.lit("-"))
    )
    return t.table(spark, sf, "events").select(
        F.col("event_id").alias("chave"),
        text.na_to_null(word).alias("texto"),
        text.na_to_null(F.col("event_type")).alias("tipo"),
    )


def _severidade(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("value") >= 1, t._choose(F.col("event_type"), t.EVENT_TYPES, F.upper("event_type")))
    written = F.when(F.col("value") > 20, F.lower(kind)).otherwise(kind)
    return t.table(spark, sf, "events").select(
        F.col("event_id").alias("chave"), written.alias("tipo"), bands.severity(written).alias("severidade")
    )


def _faixas(spark: SparkSession, sf: str) -> DataFrame:
    return (
        t.clientes(spark, sf)
        .withColumn("score", F.when(F.col("estado") != "BRAZIL", F.col("score_credito")))
        .select(
            "cliente_id",
            "score",
            bands.score_band(F.col("score")).alias("faixa_risco"),
            "renda_mensal",
            bands.income_band(F.col("renda_mensal")).alias("faixa_renda"),
        )
    )


def _status_bruto(spark: SparkSession, sf: str) -> DataFrame:
    return silver.emprestimos(t.raw_emprestimos(spark, sf)).groupBy("status").agg(F.count(F.lit(1)).alias("linhas"))


def _auditoria(spark: SparkSession, sf: str) -> DataFrame:
    raw = {
        "bronze_clientes": t.raw_clientes(spark, sf),
        "bronze_emprestimos": t.raw_emprestimos(spark, sf),
        "bronze_pagamentos": t.raw_pagamentos(spark, sf),
        "bronze_eventos_risco": t.raw_eventos(spark, sf),
    }
    clean = {f"silver_{name}": silver.TABLES[name](raw[f"bronze_{name}"]) for name in silver.TABLES}
    return count_rows({**raw, **clean})


def _csv(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of the four sources, written and read again; quotes and separators in them, line breaks in one."""
    out, sources, dirty = None, {}, {}
    for name, rows in _raw_tables().items():
        source = replace(SOURCES[name], multiline=name == "clientes")
        mark = '\n"' if source.multiline else '"; '
        path = stage_path(spark, "csv")
        dirty[path] = rows(spark, sf).withColumn(source.columns[-1], F.concat(F.lit(' "'), source.columns[-1], F.lit(mark)))
        sources[name] = path, source
    write_all_raw(dirty)
    for name, (path, source) in sources.items():
        first = source.columns[0]
        parts = [F.coalesce(F.col(c), F.lit("<nulo>")) for c in source.columns]
        read = read_raw(spark, path, source).select(
            F.lit(name).alias("tabela"), F.col(first).alias("chave"), F.concat_ws("|", *parts).alias("linha")
        )
        out = read if out is None else out.unionByName(read)
    return out


def _raw_tables() -> dict:
    """The largest first, as they are written in this order."""
    return {
        "pagamentos": t.raw_pagamentos,
        "emprestimos": t.raw_emprestimos,
        "eventos_risco": t.raw_eventos,
        "clientes": t.raw_clientes,
    }


def _carga(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files written from the tables, all layers refreshed from them, the rows of all views and tables read."""
    source = stage_path(spark, "raw")
    write_all_raw({f"{source}/{SOURCES[name].file}": rows(spark, sf) for name, rows in _raw_tables().items()})
    result = refresh(spark, source, stage_path(spark, "lake"))
    out = None
    for name, df in result.views.items():
        # the views as text: doubles in whole hundredths, which both engines print alike
        shown = [
            F.coalesce(
                (F.round(F.col(f.name) * 100).cast("decimal(38,0)") if isinstance(f.dataType, T.DoubleType) else F.col(f.name)).cast("string"),
                F.lit("<nulo>"),
            )
            for f in df.schema
        ]
        rows = df.select(F.lit(name).alias("tabela"), F.concat_ws("|", *shown).alias("linha"))
        out = rows if out is None else out.unionByName(rows)
    for name, df in result.tables.items():
        timed = F.count("_ingestao") if "_ingestao" in df.columns else F.lit(0)
        shown = F.concat_ws("|", F.count(F.lit(1)).cast("string"), timed.cast("string"))
        out = out.unionByName(df.agg(shown.alias("linha")).select(F.lit(name).alias("tabela"), "linha"))
    return out


def _rank(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("emprestimo_id"),
        F.col("l_linenumber").alias("parcela_num"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
        .when((F.col("l_returnflag") == "A") | (F.col("l_linestatus") == "F"), F.col("l_extendedprice"))
        .alias("valor"),
    )
    return global_rank(rows, "valor", "posicao")


def _chave_quente(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the loans on one client, in a join that splits every key with a thousandth of the rows."""
    loans = t.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("emprestimo_id"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("o_custkey")).alias("cliente_id"),
    )
    counts = t.table(spark, sf, "customer").groupBy(F.col("c_custkey").alias("cliente_id")).agg(F.max("c_acctbal").alias("saldo"))
    return join_spread(loans, counts, "cliente_id", "left", share=0.001)


def _soma(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of cents, of amounts past 1e15 with either sign, and of some down to 1e-9."""
    order, cents = F.col("o_orderkey"), F.round(F.col("o_totalprice") * 100)
    amount = t._choose(order % 4, {0: cents / 100, 1: cents + 1e15, 2: -cents - 1e15}, cents / 1e9)
    rows = t.table(spark, sf, "orders").select(F.col("o_custkey").alias("cliente_id"), amount.alias("valor"))
    return rows.groupBy("cliente_id").agg(money.total([F.sum(c) for c in money.parts(F.col("valor"))]).alias("total"))


def _score_limitado(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.floor(F.col("c_acctbal") / 10)
    score = F.when(F.col("c_mktsegment") != "BUILDING", raw)
    return t.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("cliente_id"), loanbook.score_limitado(score).alias("score_credito")
    )


def _politica(spark: SparkSession, sf: str) -> DataFrame:
    # a fiftieth of the order total falls in and out of the amount bands
    loans = t.emprestimos(spark, sf).withColumn("valor_emprestado", F.col("valor_emprestado") / 50)
    return loanbook.politica_preco(loans, t.clientes(spark, sf))


def _cotacao(spark: SparkSession, sf: str) -> DataFrame:
    # stored instalments of 12-instalment loans are a cent off
    loans = t.emprestimos(spark, sf)
    off = F.when(F.col("num_parcelas") == 12, F.col("valor_parcela") + 0.01).otherwise(F.col("valor_parcela"))
    return loanbook.cotacao_parcela(loans.withColumn("valor_parcela", off)).drop("valor_parcela")


def _perda(spark: SparkSession, sf: str) -> DataFrame:
    return loanbook.perda_esperada(t.emprestimos(spark, sf), t.clientes(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_clientes": lambda s, d: silver.clientes(t.raw_clientes(s, d)),
    "silver_emprestimos": lambda s, d: silver.emprestimos(t.raw_emprestimos(s, d)),
    "silver_pagamentos": lambda s, d: silver.pagamentos(t.raw_pagamentos(s, d)),
    "silver_eventos_risco": lambda s, d: silver.eventos_risco(t.raw_eventos(s, d)),
    "gold_inadimplencia_por_estado": _por_estado,
    "gold_evolucao_inadimplencia": lambda s, d: gold.evolucao_inadimplencia(t.emprestimos(s, d)),
    "gold_ranking_risco_clientes": lambda s, d: _ranking(s, d, fan_out=True),
    "gold_risco_por_score": _por_score,
    "gold_alerta_risco_iminente": _alerta,
    "preview_top5_estados": lambda s, d: gold.preview_estados(_por_estado(s, d)),
    "preview_risco_por_score": lambda s, d: gold.preview_score(_por_score(s, d)),
    "parse_inteiro_real": _inteiro_real,
    "parse_data": _data,
    "limpeza_texto": _limpeza,
    "na_tokens": _na,
    "lookup_severidade": _severidade,
    "faixas_score_renda": _faixas,
    "filtro_status_bruto": _status_bruto,
    "auditoria_contagens": _auditoria,
    "csv_ida_e_volta": _csv,
    "carga_completa": _carga,
    "rank_global_distribuido": _rank,
    "soma_exata": _soma,
    "juncao_chave_quente": _chave_quente,
    "score_limitado": _score_limitado,
    "politica_preco": _politica,
    "cotacao_parcela": _cotacao,
    "probabilidades_risco": lambda s, d: loanbook.probabilidades_risco(t.clientes(s, d)),
    "perda_esperada": _perda,
    "cronograma_parcelas": lambda s, d: loanbook.cronograma_parcelas(t.emprestimos(s, d), AS_OF),
    "multa_atraso": lambda s, d: loanbook.multa_atraso(t.pagamentos(s, d)),
    "ranking_exposicao_corrigido": lambda s, d: _ranking(s, d, fan_out=False),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda s, d, query=query: _plain(query(s, d))) for name, query in QUERIES.items()}

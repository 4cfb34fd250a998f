"""The driver's tables as inputs: cleaned-table contract, and dirty raw text for the cleaning rules."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from risklake.functions.bands import income_band, score_band, severity
from risklake.plans.loanbook import valor_cotado


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(key: Column, values: dict, rest) -> Column:
    chain = F
    for name, value in values.items():
        chain = chain.when(key == name, value)
    return chain.otherwise(rest)


# ---- cleaned tables ----


def clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    score = F.lit(300).cast("long") + F.floor((F.col("c_acctbal") + 1000) / 20)
    income = F.when(F.col("c_custkey") % 50 != 0, F.col("c_acctbal") * 1.5)
    return (
        table(spark, sf_dir, "customer")
        .join(nation, "c_nationkey")
        .select(
            F.col("c_custkey").alias("cliente_id"),
            F.trim("c_name").alias("nome"),
            score.alias("score_credito"),
            income.alias("renda_mensal"),
            F.col("n_name").alias("estado"),
            score_band(score).alias("faixa_risco"),
            income_band(income).alias("faixa_renda"),
        )
    )


def emprestimos(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .select(
            order.alias("emprestimo_id"),
            F.col("o_custkey").alias("cliente_id"),
            F.col("o_totalprice").alias("valor_emprestado"),
            _choose(order % 6, {0: 6, 1: 12, 2: 18, 3: 24, 4: 36}, 48).cast("long").alias("num_parcelas"),
            ((order % 7300 + 800).cast("double") / 1000).alias("taxa_juros"),
            F.col("o_orderdate").cast("date").alias("data_concessao"),
            _choose(F.col("o_orderstatus"), {"P": "INADIMPLENTE", "O": "ATIVO"}, "QUITADO").alias("status"),
        )
        .withColumn(
            "valor_parcela", valor_cotado(F.col("valor_emprestado"), F.col("num_parcelas"), F.col("taxa_juros"))
        )
    )


def pagamentos(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = ~((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"))
    days = (F.col("l_partkey") % 94 - 3).cast("int")
    due = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("emprestimo_id"),
        F.col("l_linenumber").alias("parcela_num"),
        due.alias("data_vencimento"),
        F.when(paid, F.date_add(due, days)).alias("data_pagamento"),
        F.col("l_extendedprice").alias("valor_devido"),
        F.when(paid, days.cast("double")).alias("dias_atraso"),
    )


EVENT_TYPES = {"click": "ATRASO_30", "view": "ATRASO_60", "error": "ATRASO_90", "purchase": "CALOTE"}


def eventos(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = _choose(F.col("event_type"), EVENT_TYPES, F.upper("event_type"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("evento_id"),
        F.col("user_id").alias("cliente_id"),
        kind.alias("tipo_evento"),
        F.col("ts").cast("date").alias("data_evento"),
        F.col("value").alias("valor_em_risco"),
        severity(kind).alias("severidade"),
    )


# ---- raw text: dirt that depends on other columns of the row ----


def _text(amount: str) -> Column:
    """Amount with two decimals and a point."""
    return F.col(amount).cast("decimal(18,2)").cast("string")


def _digits(start: int, length: int) -> Column:
    return F.substring(F.lpad(F.col("c_custkey").cast("string"), 11, "0"), start, length)


def raw_clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    segment, region = F.col("c_mktsegment"), F.col("c_nationkey")
    score = (F.lit(300) + F.floor((F.col("c_acctbal") + 1000) / 20)).cast("string")
    born = F.date_add(F.lit("1950-01-01").cast("date"), F.floor(F.col("c_acctbal") + 1000).cast("int"))
    dot = F.lit(".")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, "c_nationkey")
        .select(
            F.when(region != 3, F.col("c_custkey").cast("string")).alias("cliente_id"),
            F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("nome"),
            F.when(
                region != 4,
                F.concat(_digits(1, 3), dot, _digits(4, 3), dot, _digits(7, 3), F.lit("-"), _digits(10, 2)),
            ).alias("cpf"),
            _choose(
                region,
                {
                    5: F.date_format(born, "dd/MM/yyyy"),
                    6: F.concat(born.cast("string"), F.lit(" 23:30:00-03:00")),
                    7: F.concat(F.lit(" "), born.cast("string")),
                    8: F.concat(born.cast("string"), F.lit("T10:15")),
                },
                born.cast("string"),
            ).alias("data_nascimento"),
            F.when(
                region != 9,
                _choose(
                    segment,
                    {
                        "FURNITURE": F.concat(F.lit(" "), score),
                        "MACHINERY": F.concat(score, F.lit(",5")),
                        "BUILDING": F.concat(F.lit("nota "), score),
                    },
                    score,
                ),
            ).alias("score_credito"),
            F.when(
                region != 10,
                _choose(
                    segment,
                    {
                        "FURNITURE": F.replace(_text("c_acctbal"), dot, F.lit(",")),
                        "MACHINERY": F.concat(F.lit("R$ "), _text("c_acctbal")),
                    },
                    _text("c_acctbal"),
                ),
            ).alias("renda_mensal"),
            F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("estado"),
            born.cast("string").alias("data_cadastro"),
        )
    )


def raw_emprestimos(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    status = _choose(F.col("o_orderstatus"), {"P": "INADIMPLENTE", "O": "ATIVO"}, "QUITADO")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("emprestimo_id"),
        F.when(priority != "1-URGENT", F.col("o_custkey").cast("string")).alias("cliente_id"),
        _text("o_totalprice").alias("valor_emprestado"),
        F.when(priority == "2-HIGH", F.replace(_text("o_totalprice"), F.lit("."), F.lit(",")))
        .otherwise(_text("o_totalprice"))
        .alias("valor_parcela"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".9 x")).alias("num_parcelas"),
        F.concat(F.substring(priority, 1, 1), F.lit(".25%")).alias("taxa_juros"),
        F.col("o_orderdate").cast("string").alias("data_concessao"),
        F.when(priority == "5-LOW", F.concat(F.lit(" "), F.lower(status), F.lit(" ")))
        .otherwise(status)
        .alias("status"),
    )


def raw_pagamentos(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    due = F.col("l_shipdate").cast("date")
    paid = F.date_add(due, (F.col("l_partkey") % 94 - 3).cast("int")).cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_tax") != 0.08, F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")).alias(
            "pagamento_id"
        ),
        F.col("l_orderkey").cast("string").alias("emprestimo_id"),
        F.col("l_linenumber").cast("string").alias("parcela_num"),
        due.cast("string").alias("data_vencimento"),
        F.when((line == "O") & (flag == "N"), F.lit(None))
        .when((line == "F") & (flag == "N"), F.lit("em aberto"))
        .when(F.col("l_linenumber") == 6, F.concat(F.substring(paid, 1, 8), F.lit("31")))
        .when(F.col("l_linenumber") == 5, F.concat(paid, F.lit(" 24:00")))
        .when(flag == "R", F.concat(paid, F.lit(" 12:00")))
        .otherwise(paid)
        .alias("data_pagamento"),
        _text("l_extendedprice").alias("valor_devido"),
        F.when(flag == "A", F.concat(_text("l_extendedprice"), F.lit(" BRL")))
        .otherwise(_text("l_discount"))
        .alias("valor_pago"),
        F.when(flag == "N", F.lit(" pendente ")).otherwise(F.lit("Pago")).alias("status"),
    )


def raw_eventos(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = _choose(F.col("event_type"), EVENT_TYPES, "OUTRO")
    dirty = F.concat(F.lit(" "), F.lower(kind), F.lit(" "))
    return table(spark, sf_dir, "events").select(
        F.when(F.col("value") >= 1, F.col("event_id").cast("string")).alias("evento_id"),
        F.col("user_id").cast("string").alias("cliente_id"),
        F.col("event_id").cast("string").alias("emprestimo_id"),
        F.when(F.col("value") > 20, dirty).otherwise(kind).alias("tipo_evento"),
        F.substring(F.col("ts").cast("string"), 1, 16).alias("data_evento"),
        _text("value").alias("valor_em_risco"),
    )

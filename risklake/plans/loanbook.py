"""Loan-book rules as operators on cleaned tables: pricing policy, quotes, expected loss, schedules, fees."""

from pyspark.sql import Column, DataFrame, functions as F

from risklake.functions.money import parts, product, total

# Score range; lowest score, rate range and amount range of each price band; floor of each probability, and
# the points below 700 that make it 1; days between instalments; late fee.
SCORE_RANGE = (300, 850)
PRICE_BANDS = [(750, (0.8, 1.5), (5000.0, 50000.0)), (600, (1.5, 3.5), (1000.0, 20000.0))]
PRICE_REST = ((3.5, 8.0), (500.0, 8000.0))
SCORE_PIVOT = 700
DEFAULT_FLOOR, DEFAULT_SCALE = 0.02, 1000
LATE_FLOOR, LATE_SCALE = 0.05, 800
INSTALMENT_DAYS = 30
LATE_FEE_PERCENT = 2


def score_limitado(score: Column) -> Column:
    """Score held within the valid range; NULL stays NULL, which greatest and least alone would skip."""
    low, high = SCORE_RANGE
    return F.when(score.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), score)).cast("long"))


def _points_below(score: Column) -> Column:
    """Points below the pivot; a decimal, as the score of a junk text may be the smallest long."""
    return F.lit(SCORE_PIVOT) - score.cast("decimal(19,0)")


def prob_inadimplencia(score: Column) -> Column:
    chance = _points_below(score).cast("double") / float(DEFAULT_SCALE)
    return F.when(score.isNotNull(), F.greatest(F.lit(DEFAULT_FLOOR), chance))


def prob_atraso(score: Column) -> Column:
    chance = _points_below(score).cast("double") / float(LATE_SCALE)
    return F.when(score.isNotNull(), F.greatest(F.lit(LATE_FLOOR), chance))


def probabilidades_risco(clientes: DataFrame) -> DataFrame:
    score = F.col("score_credito")
    return clientes.select(
        "cliente_id",
        "score_credito",
        "faixa_risco",
        prob_inadimplencia(score).alias("prob_inadimplencia"),
        prob_atraso(score).alias("prob_atraso"),
    )


def _with_score(emprestimos: DataFrame, clientes: DataFrame, *columns: str) -> DataFrame:
    """Loans with columns of their client; copies of a client count once."""
    profiles = clientes.select("cliente_id", *columns).distinct()
    return emprestimos.join(profiles, "cliente_id")


def politica_preco(emprestimos: DataFrame, clientes: DataFrame) -> DataFrame:
    """Loans with flags for a rate or an amount outside the price band of the client's score."""

    def outside(value: Column, position: int) -> Column:
        chain = F
        for low, *ranges in PRICE_BANDS:
            chain = chain.when(F.col("score_credito") >= low, ~value.between(*ranges[position]))
        return chain.otherwise(~value.between(*PRICE_REST[position]))

    loans = emprestimos.select("emprestimo_id", "cliente_id", "taxa_juros", "valor_emprestado")
    return _with_score(loans, clientes, "score_credito").select(
        "emprestimo_id",
        "cliente_id",
        "score_credito",
        "taxa_juros",
        "valor_emprestado",
        outside(F.col("taxa_juros"), 0).alias("taxa_fora"),
        outside(F.col("valor_emprestado"), 1).alias("valor_fora"),
    )


def _to_cents(amount: Column) -> Column:
    """Rounded half up to cents, for amounts of any size. Digits beyond the ninth decimal are noise of the doubles, and
    would turn a half cent down."""
    return F.round(F.round(amount, 9), 2)


def valor_cotado(valor: Column, parcelas: Column, taxa: Column) -> Column:
    """Instalment of ``valor`` over ``parcelas`` at ``taxa`` percent, in cents; NULL for a zero count."""
    return _to_cents(valor / F.nullif(parcelas.cast("double"), F.lit(0.0)) * (taxa / 100.0 + 1.0))


def cotacao_parcela(emprestimos: DataFrame) -> DataFrame:
    """Quoted instalment of each loan and whether the stored one agrees to the cent."""
    quote = valor_cotado(F.col("valor_emprestado"), F.col("num_parcelas"), F.col("taxa_juros"))
    return emprestimos.select("emprestimo_id", "valor_parcela", quote.alias("parcela_cotada")).withColumn(
        "confere", F.abs(F.col("valor_parcela") - F.col("parcela_cotada")) < 0.005
    )


def perda_esperada(emprestimos: DataFrame, clientes: DataFrame) -> DataFrame:
    """Expected loss by score band: amount times default probability, summed exactly."""
    amount = F.col("valor_emprestado")
    # the probability as whole thousandths keeps the sum exact
    floor = F.lit(int(DEFAULT_FLOOR * DEFAULT_SCALE)).cast("decimal(20,0)")
    weight = F.when(F.col("score_credito").isNotNull(), F.greatest(floor, _points_below(F.col("score_credito"))))
    loss = total([F.sum(c) for c in product(parts(amount), weight)])
    return (
        _with_score(
            emprestimos.select("emprestimo_id", "cliente_id", "valor_emprestado"),
            clientes,
            "score_credito",
            "faixa_risco",
        )
        .groupBy("faixa_risco")
        .agg(
            F.count(F.lit(1)).alias("total_emprestimos"),
            total([F.sum(c) for c in parts(amount)]).alias("valor_total"),
            (loss / float(DEFAULT_SCALE)).alias("perda_esperada"),
        )
    )


def cronograma_parcelas(emprestimos: DataFrame, as_of: str) -> DataFrame:
    """One row per instalment that is due by ``as_of`` (an ISO date).

    The count is cut to the due ones before the rows are made, so a wild instalment count costs nothing.
    """
    elapsed = F.datediff(F.lit(as_of).cast("date"), F.col("data_concessao"))
    due = F.least(F.col("num_parcelas"), F.floor(elapsed / float(INSTALMENT_DAYS)))
    return (
        emprestimos.where("num_parcelas is not null and data_concessao is not null")  # least skips NULL
        .select("emprestimo_id", "cliente_id", "data_concessao", "valor_parcela", due.alias("_due"))
        # sequence counts down when its end is below its start; and a junk count may be the smallest long
        .withColumn("_due", F.when(F.col("_due") >= 1, F.col("_due")).cast("int"))
        .where(F.col("_due").isNotNull())
        .withColumn("parcela_num", F.explode(F.sequence(F.lit(1), F.col("_due"))))
        .select(
            "emprestimo_id",
            "cliente_id",
            "parcela_num",
            F.date_add("data_concessao", F.col("parcela_num") * INSTALMENT_DAYS).alias("data_vencimento"),
            F.col("valor_parcela").alias("valor_devido"),
        )
    )


def multa_atraso(pagamentos: DataFrame) -> DataFrame:
    """Settlement of paid instalments: a late one owes the fee on top. Unpaid ones have no status and no amount."""
    late = F.col("data_pagamento") > F.col("data_vencimento")
    owed = F.col("valor_devido")
    with_fee = _to_cents(owed * (1 + LATE_FEE_PERCENT / 100))
    return pagamentos.select(
        "emprestimo_id",
        "parcela_num",
        "data_vencimento",
        "data_pagamento",
        "valor_devido",
        F.when(late, "ATRASADO").when(~late, "PAGO").alias("status_apurado"),
        F.when(late, with_fee).when(~late, owed).alias("valor_apurado"),
    )

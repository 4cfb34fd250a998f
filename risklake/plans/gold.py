"""Risk views over the cleaned tables.

Cleaned tables are not deduplicated, and a view counts a row once for each row it joins to. Before a join at least one
side is folded to one row per key that carries how many rows it stands for, so copies and hot keys shrink in the
map-side combine before a shuffle, and no join emits all pairs of a key. The rows of hot clients and loans are spread in
the joins they reach.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from risklake.functions.bands import ACTIVE, DEFAULTED, delay_points
from risklake.functions.money import PARTS, count_of, multiplied, parts, percent, product, summed, sums, total
from risklake.operators.rank import global_rank
from risklake.operators.skew import folded
from risklake.operators.stage import stage

PROFILE = ["cliente_id", "nome", "score_credito", "faixa_risco", "estado"]


def _folded(df: DataFrame, *keys: str) -> DataFrame:
    """One row per distinct ``keys`` with the number of rows it stands for.

    The number is a decimal, as it gets multiplied: a hot key of one table times a hot key of another passes a long.
    """
    return df.groupBy(*keys).agg(_rows().alias("copias"))


def _rows() -> Column:
    return F.count(F.lit(1)).cast("decimal(20,0)")


def _defaulted() -> Column:
    return F.col("status") == DEFAULTED


def _if_defaulted(amount: Column) -> Column:
    """Amount of a defaulted loan, 0 of another."""
    return F.when(_defaulted(), amount).otherwise(F.lit(0.0))


def inadimplencia_por_estado(emprestimos: DataFrame, clientes: DataFrame) -> DataFrame:
    """Default rate and amount at risk by state of the client."""
    # flags are smaller to shuffle than statuses
    loans = emprestimos.select(
        "emprestimo_id",
        "cliente_id",
        _defaulted().alias("inadimplente"),
        _if_defaulted(F.col("valor_emprestado")).alias("risco"),
    )
    risk, copies = F.col("risco"), F.col("copias")
    # one row per state and loan makes the distinct counts plain counts: no Expand, no hot state
    per_loan = (
        loans.join(_folded(clientes, "cliente_id", "estado"), "cliente_id")
        .groupBy("estado", "emprestimo_id")
        .agg(
            F.max("inadimplente").alias("inadimplente"),
            *sums("valor", product(parts(risk), copies)),
        )
    )
    return (
        per_loan.groupBy("estado")
        .agg(
            F.count("emprestimo_id").alias("total_emprestimos"),
            F.count(F.when(F.col("inadimplente"), F.col("emprestimo_id"))).alias("inadimplentes"),
            total([F.sum(c) for c in summed("valor")]).alias("valor"),
        )
        .select(
            "estado",
            "total_emprestimos",
            "inadimplentes",
            percent(F.col("inadimplentes"), F.col("total_emprestimos")).alias("taxa_inadimplencia_pct"),
            F.round("valor", 2).alias("valor_em_risco"),
        )
        .orderBy(F.desc_nulls_last("taxa_inadimplencia_pct"), "estado")
    )


def evolucao_inadimplencia(emprestimos: DataFrame) -> DataFrame:
    """Monthly defaults with the change from the previous month that has loans."""
    risk = _if_defaulted(F.col("valor_emprestado"))
    # loans are grouped by the first day of the month, and only the groups are formatted
    monthly = (
        emprestimos.groupBy(F.trunc("data_concessao", "month").alias("inicio"))
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.sum(F.when(_defaulted(), 1).otherwise(0)).alias("inadimplentes"),
            total([F.sum(c) for c in parts(risk)]).alias("valor_inadimplente"),
        )
        .withColumn("mes", F.date_format("inicio", "yyyy-MM"))
    )
    # one row per calendar month reaches the unpartitioned window, at most 12 for each of 10000 years
    previous = F.lag("inadimplentes").over(Window.orderBy(F.asc_nulls_first("mes")))
    change = F.col("inadimplentes") - F.col("inadimplentes_mes_anterior")
    return (
        monthly.withColumn("inadimplentes_mes_anterior", previous)
        .select(
            "mes",
            "total",
            "inadimplentes",
            percent(F.col("inadimplentes"), F.col("total")).alias("taxa_pct"),
            "valor_inadimplente",
            "inadimplentes_mes_anterior",
            change.alias("variacao_absoluta"),
            percent(change, F.col("inadimplentes_mes_anterior")).alias("variacao_pct"),
        )
        .orderBy(F.asc_nulls_first("mes"))
    )


def exposicao(
    clientes: DataFrame, emprestimos: DataFrame, eventos: DataFrame, fan_out: bool
) -> DataFrame:
    """Loans and risk events per client with a defaulted amount above zero.

    With ``fan_out`` the totals are those of joining clients to loans and to events on the client alone: each loan
    counts once per event of its client and each event once per loan. That product is never built: both sides are
    folded per client and multiplied by the size of the other. Without it every loan and event counts once.
    """
    amount, risk, loan = F.col("valor_emprestado"), F.col("risco"), F.col("emprestimo")
    loans = emprestimos.select(
        "cliente_id", F.lit(True).alias("emprestimo"), "emprestimo_id", amount, _if_defaulted(amount).alias("risco")
    )
    # loans and events of a client are folded together: one shuffle, and one table to join
    both = loans.unionByName(eventos.select("cliente_id", "evento_id", "severidade"), allowMissingColumns=True)
    per_client = folded(
        both,
        "cliente_id",
        F.count(loan).cast("decimal(20,0)").alias("linhas_emprestimo"),
        F.count("emprestimo_id").alias("emprestimos"),
        *sums("emprestado", parts(amount)),
        *sums("inadimplente", parts(risk)),
        F.sum(risk).alias("_positivo"),  # in doubles, which hold what the decimals round away
        F.count(F.when(loan.isNull(), 1)).cast("decimal(20,0)").alias("linhas_evento"),
        F.count("evento_id").alias("eventos"),
        F.max("severidade").alias("maior_severidade"),
    ).where(F.col("_positivo") > 0)
    joined = _folded(clientes, *PROFILE).join(per_client, "cliente_id")

    one = F.lit(1).cast("decimal(20,0)")
    per_loan = F.col("copias") * F.greatest(F.col("linhas_evento"), one) if fan_out else one
    per_event = F.col("copias") * F.col("linhas_emprestimo") if fan_out else one
    joined = multiplied(multiplied(joined, "emprestado", per_loan), "inadimplente", per_loan)
    return joined.select(
        *PROFILE,
        count_of(F.col("emprestimos") * per_loan).alias("total_emprestimos"),
        total(summed("emprestado")).alias("valor_total_emprestado"),
        total(summed("inadimplente")).alias("valor_inadimplente"),
        count_of(F.col("eventos") * per_event).alias("total_eventos_risco"),
        "maior_severidade",
    )


def ranking_risco_clientes(
    clientes: DataFrame, emprestimos: DataFrame, eventos: DataFrame, fan_out: bool = True
) -> DataFrame:
    """Clients ranked by defaulted amount. The ranked rows are staged once, as the rank reads them several times."""
    rows = stage(exposicao(clientes, emprestimos, eventos, fan_out), "exposicao")
    share = percent(F.col("valor_inadimplente"), F.col("valor_total_emprestado"))
    return (
        global_rank(rows, "valor_inadimplente", "ranking_exposicao")
        .withColumn("pct_inadimplente", share)
        .orderBy("ranking_exposicao", *PROFILE)  # all of it, so that the rows of one client can be split
    )


def risco_por_score(clientes: DataFrame, emprestimos: DataFrame) -> DataFrame:
    """Profile of each score band; averages are over loans, so a client weighs by its loans.

    Averages and clients are counted on loans folded per client; distinct loans are counted per band and loan. Both
    go into one aggregate per band, without the row copies of several distinct counts in one.
    """
    rate, amount = F.col("taxa_juros"), F.col("valor_emprestado")
    loans = folded(
        emprestimos,
        "cliente_id",
        _rows().alias("linhas"),
        F.count(rate).alias("taxas"),
        *sums("taxa", parts(rate)),
        F.count(amount).alias("valores"),
        *sums("valor", parts(amount)),
    )
    score = F.col("score_credito").cast("decimal(20,0)")
    # one row per client and band, so that nothing is grouped by the client after the join
    bands = clientes.groupBy("cliente_id", "faixa_risco").agg(
        _rows().alias("copias"),
        F.count(score).cast("decimal(20,0)").alias("com_escore"),
        F.sum(score).alias("escore"),
    )
    rows, copies = F.col("linhas"), F.col("copias")
    weighed = [c.alias(name + part) for name in ("taxa", "valor") for c, part in zip(product(summed(name), copies), PARTS)]
    per_client = bands.join(loans, "cliente_id").select(
        "faixa_risco",
        "cliente_id",
        (F.col("com_escore") * rows).alias("escores"),
        (F.col("escore") * rows).alias("escore"),
        *[(F.col(name) * copies).alias(name) for name in ("taxas", "valores")],
        *weighed,
    )
    flags = emprestimos.select("emprestimo_id", "cliente_id", _defaulted().alias("inadimplente"))
    per_loan = (
        flags.join(clientes.select("cliente_id", "faixa_risco").distinct(), "cliente_id")
        .groupBy("faixa_risco", "emprestimo_id")
        .agg(F.max("inadimplente").alias("inadimplente"))
    )

    def mean(name: str, count: str) -> Column:
        return total([F.sum(c) for c in summed(name)]) / F.sum(count).cast("double")

    return (
        per_client.unionByName(per_loan, allowMissingColumns=True)
        .groupBy("faixa_risco")
        .agg(
            F.round(F.sum("escore").cast("double") / F.sum("escores").cast("double"), 0).alias("score_medio"),
            F.count("cliente_id").alias("total_clientes"),
            F.count("emprestimo_id").alias("total_emprestimos"),
            F.count(F.when(F.col("inadimplente"), F.col("emprestimo_id"))).alias("inadimplentes"),
            F.round(mean("taxa", "taxas"), 2).alias("taxa_juros_media"),
            F.round(mean("valor", "valores"), 2).alias("ticket_medio"),
        )
        .withColumn("taxa_inadimplencia_pct", percent(F.col("inadimplentes"), F.col("total_emprestimos")))
        .orderBy(F.desc_nulls_last("score_medio"), "faixa_risco")
    )


def alerta_risco_iminente(
    clientes: DataFrame, emprestimos: DataFrame, pagamentos: DataFrame
) -> DataFrame:
    """Clients with active loans who paid late on any loan, with a composite score (not clamped to 100)."""
    # clients without a late payment drop out, and the largest delay of the others is a late one: early and unpaid
    # instalments can be left out at the scan
    late = folded(
        pagamentos.where(F.col("dias_atraso") > 0),
        "emprestimo_id",
        F.count(F.lit(1)).alias("atrasos"),
        F.max("dias_atraso").alias("maior"),
        F.sum(F.col("dias_atraso").cast("decimal(26,15)")).alias("dias"),  # days between two years of four digits
    )
    active = F.col("status") == ACTIVE
    loans = emprestimos.select(
        "emprestimo_id", "cliente_id", active.alias("ativo"), F.when(active, F.col("valor_emprestado")).alias("exposto")
    )
    exposed = F.col("exposto")
    # all of it is additive, so the copies of a loan need no fold of their own
    history = folded(
        loans.join(late, "emprestimo_id", "left"),
        "cliente_id",
        F.sum(F.col("atrasos").cast("decimal(20,0)")).alias("atrasos"),
        F.max("maior").alias("maior_atraso"),
        F.sum("dias").alias("dias"),
        F.count(F.when(F.col("ativo"), 1)).alias("ativos"),
        *sums("exposto", parts(exposed)),
    ).where((F.col("atrasos") > 0) & (F.col("ativos") > 0))
    joined = _folded(clientes, *PROFILE).join(history, "cliente_id")
    joined = multiplied(joined, "exposto", F.col("copias"))
    # in doubles: the score of a junk text may be the smallest long
    composite = (
        count_of(F.col("atrasos")).cast("double") * 10.0
        + delay_points(F.col("maior_atraso"))
        + (F.lit(850.0) - F.col("score_credito").cast("double")) / 20.0
    )
    return joined.select(
        *PROFILE,
        count_of(F.col("atrasos")).alias("qtd_atrasos"),
        "maior_atraso",
        F.round(F.col("dias").cast("double") / F.col("atrasos").cast("double"), 1).alias("media_atraso"),
        total(summed("exposto")).alias("exposicao_total"),
        F.round(composite, 1).alias("score_risco_composto"),
    ).orderBy(F.desc_nulls_last("score_risco_composto"), *PROFILE)


def preview_estados(por_estado: DataFrame, rows: int = 5) -> DataFrame:
    """The states with the highest default rate."""
    return por_estado.orderBy(F.desc_nulls_last("taxa_inadimplencia_pct"), "estado").limit(rows)


def preview_score(por_score: DataFrame) -> DataFrame:
    return por_score.select(
        "faixa_risco", "score_medio", "total_emprestimos", "inadimplentes", "taxa_inadimplencia_pct"
    )


def views(clientes: DataFrame, emprestimos: DataFrame, pagamentos: DataFrame, ranking: DataFrame) -> dict:
    """The five views by name. Nothing runs here; the ranking is read from where it was stored."""
    return {
        "gold_inadimplencia_por_estado": inadimplencia_por_estado(emprestimos, clientes),
        "gold_evolucao_inadimplencia": evolucao_inadimplencia(emprestimos),
        "gold_ranking_risco_clientes": ranking.orderBy("ranking_exposicao", *PROFILE),
        "gold_risco_por_score": risco_por_score(clientes, emprestimos),
        "gold_alerta_risco_iminente": alerta_risco_iminente(clientes, emprestimos, pagamentos),
    }

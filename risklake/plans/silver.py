"""Cleaned, typed tables from raw text.

Each function reads the raw column in its filter and in its derived columns; a cleaned column of the same name never
feeds another rule. So a loan whose raw status is not exactly a known one is dropped, not repaired, and the severity of
an event comes from its raw type. Ids stay text. Nothing is deduplicated. Every plan is a scan, a filter and a
projection: no shuffle.
"""

from pyspark.sql import Column, DataFrame, functions as F

from risklake.functions.bands import LOAN_STATUSES, income_band, score_band, severity
from risklake.functions.parse import millis_to_julian, to_integer, to_real, with_millis
from risklake.functions.text import code, document_number


def _complete(bronze: DataFrame, *columns: str) -> DataFrame:
    """Rows with a value in all ``columns``. Unlike dropna, this reaches the scan."""
    return bronze.where(" and ".join(f"{name} is not null" for name in columns))


def _dated(bronze: DataFrame, moments: dict[str, str]) -> DataFrame:
    """``bronze`` with the milliseconds of each raw column, by name, and the calendar day of it, for ``_day``."""
    return with_millis(bronze, {m: F.col(raw) for m, raw in moments.items()}, {m: f"_dia_{raw}" for m, raw in moments.items()})


def _day(raw: str) -> Column:
    return F.col(f"_dia_{raw}").alias(raw)


def clientes(bronze: DataFrame) -> DataFrame:
    known = _complete(bronze, "cliente_id", "score_credito", "cpf")
    dated = _dated(known, {"_nasce": "data_nascimento", "_cadastro": "data_cadastro"})
    parsed = dated.select(
        "cliente_id",
        F.trim("nome").alias("nome"),
        document_number(F.col("cpf")).alias("cpf"),
        _day("data_nascimento"),
        to_integer(F.col("score_credito")).alias("score_credito"),
        to_real(F.col("renda_mensal")).alias("renda_mensal"),
        code(F.col("estado")).alias("estado"),
        _day("data_cadastro"),
    )
    return parsed.withColumns(
        {
            "faixa_risco": score_band(F.col("score_credito")),
            "faixa_renda": income_band(F.col("renda_mensal")),
        }
    )


def emprestimos(bronze: DataFrame) -> DataFrame:
    known = _complete(bronze, "emprestimo_id", "cliente_id").where(F.col("status").isin(LOAN_STATUSES))
    parsed = _dated(known, {"_concede": "data_concessao"}).select(
        "emprestimo_id",
        "cliente_id",
        to_real(F.col("valor_emprestado")).alias("valor_emprestado"),
        to_real(F.col("valor_parcela")).alias("valor_parcela"),
        to_integer(F.col("num_parcelas")).alias("num_parcelas"),
        to_real(F.col("taxa_juros")).alias("taxa_juros"),
        _day("data_concessao"),
        code(F.col("status")).alias("status"),
    )
    total = F.col("valor_parcela") * F.col("num_parcelas")
    return parsed.withColumns({"valor_total": total, "custo_credito": total - F.col("valor_emprestado")})


def pagamentos(bronze: DataFrame) -> DataFrame:
    paid, due = F.col("_pago"), F.col("_vence")
    dated = _dated(_complete(bronze, "pagamento_id"), {"_pago": "data_pagamento", "_vence": "data_vencimento"})
    parsed = dated.select(
        "pagamento_id",
        "emprestimo_id",
        "parcela_num",
        _day("data_vencimento"),
        _day("data_pagamento"),
        to_real(F.col("valor_devido")).alias("valor_devido"),
        to_real(F.col("valor_pago")).alias("valor_pago"),
        code(F.col("status")).alias("status"),
        (millis_to_julian(paid) - millis_to_julian(due)).alias("dias_atraso"),
    )
    return parsed.withColumn("diferenca_valor", F.col("valor_pago") - F.col("valor_devido"))


def eventos_risco(bronze: DataFrame) -> DataFrame:
    return _dated(_complete(bronze, "evento_id"), {"_ocorre": "data_evento"}).select(
        "evento_id",
        "cliente_id",
        "emprestimo_id",
        code(F.col("tipo_evento")).alias("tipo_evento"),
        _day("data_evento"),
        to_real(F.col("valor_em_risco")).alias("valor_em_risco"),
        severity(F.col("tipo_evento")).alias("severidade"),
    )


TABLES = {
    "clientes": clientes,
    "emprestimos": emprestimos,
    "pagamentos": pagamentos,
    "eventos_risco": eventos_risco,
}

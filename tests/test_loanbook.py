"""Loan-book operators against row-by-row calculation in Python."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from risklake.plans import loanbook

CENT = Decimal("0.01")
AS_OF = dt.date(2024, 6, 30)
LOAN = (
    "emprestimo_id string, cliente_id string, valor_emprestado double, num_parcelas long, taxa_juros double, "
    "data_concessao date, status string, valor_parcela double"
)


def half_up(value: Decimal) -> float:
    return float(value.quantize(CENT, ROUND_HALF_UP))


def dec(value) -> Decimal:
    return Decimal(str(value))


def make_loans(n=300):
    r = random.Random(5)
    loans = []
    for i in range(n):
        loans.append((
            str(i), str(r.randrange(60)), r.randrange(50000, 5000000) / 100, r.choice([6, 12, 18, 24, 36, 48]),
            r.randrange(80, 800) / 100, dt.date(2023, 1, 1) + dt.timedelta(days=r.randrange(700)),
            r.choice(["ATIVO", "QUITADO", "INADIMPLENTE"]), r.randrange(1000, 90000) / 100,
        ))
    return loans


LOANS = make_loans()


@pytest.fixture(scope="module")
def loans(spark):
    return spark.createDataFrame(LOANS, LOAN)


@pytest.fixture(scope="module")
def clients(spark):
    r = random.Random(6)
    rows = [(str(i), r.randrange(300, 851), r.choice(["BAIXO", "ALTO"])) for i in range(50)]
    rows += rows[:10]  # copies count once
    return spark.createDataFrame(rows, "cliente_id string, score_credito long, faixa_risco string")


def scores(clients):
    return {row.cliente_id: (row.score_credito, row.faixa_risco) for row in clients.collect()}


def test_score_limitado(spark):
    df = spark.createDataFrame([(0, 200), (1, 300), (2, 700), (3, 850), (4, 9000), (5, None)], "i int, s long")
    got = [r[0] for r in df.orderBy("i").select(loanbook.score_limitado(F.col("s"))).collect()]
    assert got == [300, 300, 700, 850, 850, None]


def test_probabilities(spark):
    rows = [(0, 300), (1, 690), (2, 850), (3, None), (4, -(2**63))]
    df = spark.createDataFrame(rows, "i int, s long")
    default, late = loanbook.prob_inadimplencia(F.col("s")), loanbook.prob_atraso(F.col("s"))
    got = [tuple(r) for r in df.orderBy("i").select(default, late).collect()]
    assert got[:4] == [(0.4, 0.5), (0.02, 0.05), (0.02, 0.05), (None, None)]
    assert got[4][0] == pytest.approx(9.223372036854776e15)


def test_politica_preco(loans, clients):
    score = scores(clients)
    expected = {}
    for loan in LOANS:
        if loan[1] in score:
            s = score[loan[1]][0]
            if s >= 750:
                rates, amounts = (0.8, 1.5), (5000, 50000)
            elif s >= 600:
                rates, amounts = (1.5, 3.5), (1000, 20000)
            else:
                rates, amounts = (3.5, 8.0), (500, 8000)
            expected[loan[0]] = (
                not rates[0] <= loan[4] <= rates[1], not amounts[0] <= loan[2] <= amounts[1],
            )
    rows = loanbook.politica_preco(loans, clients).collect()
    assert len(rows) == len(expected)
    assert {row.emprestimo_id: (row.taxa_fora, row.valor_fora) for row in rows} == expected


def test_cotacao_parcela(loans):
    got = {row.emprestimo_id: (row.parcela_cotada, row.confere) for row in loanbook.cotacao_parcela(loans).collect()}
    for loan in LOANS:
        quote = half_up(dec(loan[2]) * (100 + dec(loan[4])) / (100 * loan[3]))
        assert got[loan[0]] == (quote, quote == loan[7]), loan


def test_cotacao_without_instalments(spark):
    df = spark.createDataFrame([(100.0, 0, 1.0), (None, 6, 1.0)], "v double, n long, t double")
    assert [r[0] for r in df.select(loanbook.valor_cotado(F.col("v"), F.col("n"), F.col("t"))).collect()] == [None] * 2


def test_perda_esperada(loans, clients):
    score = scores(clients)
    expected = {}
    for loan in LOANS:
        if loan[1] in score:
            s, band = score[loan[1]]
            count, amount, loss = expected.get(band, (0, Decimal(0), Decimal(0)))
            p = max(Decimal("0.02"), Decimal(700 - s) / 1000)
            expected[band] = (count + 1, amount + dec(loan[2]), loss + dec(loan[2]) * p)
    got = {row[0]: tuple(row)[1:] for row in loanbook.perda_esperada(loans, clients).collect()}
    assert got.keys() == expected.keys()
    for band, (count, amount, loss) in expected.items():
        assert got[band] == (count, float(amount), pytest.approx(float(loss), rel=1e-15))


def test_cronograma(loans):
    expected = set()
    for loan in LOANS:
        for k in range(1, loan[3] + 1):
            due = loan[5] + dt.timedelta(days=30 * k)
            if due <= AS_OF:
                expected.add((loan[0], loan[1], k, due, loan[7]))
    rows = loanbook.cronograma_parcelas(loans, AS_OF.isoformat()).collect()
    assert len(rows) == len(expected)
    assert {tuple(row) for row in rows} == expected


def test_cronograma_of_the_whole_life_has_every_instalment(loans):
    whole = loanbook.cronograma_parcelas(loans, "2100-01-01").count()
    assert whole == sum(loan[3] for loan in LOANS)


def test_cronograma_of_odd_counts(spark):
    day = dt.date(2024, 1, 1)
    rows = [("a", "1", 1.0, n, 1.0, day, "ATIVO", 1.0) for n in (0, -3, None, 2**62)]
    rows.append(("b", "1", 1.0, 6, 1.0, None, "ATIVO", 1.0))
    df = spark.createDataFrame(rows, LOAN)
    assert loanbook.cronograma_parcelas(df, "2024-04-01").count() == 3  # of the endless one


def test_multa_atraso(spark):
    r = random.Random(7)
    day = dt.date(2024, 1, 1)
    paid = [None, day, day + dt.timedelta(1), day - dt.timedelta(1)]
    rows = [(str(i), 1, day, r.choice(paid), r.randrange(1, 99999) / 100) for i in range(400)]
    df = spark.createDataFrame(
        rows,
        "emprestimo_id string, parcela_num int, data_vencimento date, data_pagamento date, valor_devido double",
    )
    for row in loanbook.multa_atraso(df).collect():
        if row.data_pagamento is None:
            expected = (None, None)
        elif row.data_pagamento > row.data_vencimento:
            expected = ("ATRASADO", half_up(dec(row.valor_devido) * Decimal("1.02")))
        else:
            expected = ("PAGO", row.valor_devido)
        assert (row.status_apurado, row.valor_apurado) == expected


def test_junk_amounts(spark):
    """Amounts of any size go by one rule, and none is lost or fails."""
    day = dt.date(2024, 1, 1)
    amounts = [1e20, float("inf"), -50.0, 250.0, None]
    rows = [(str(i), "1", v, 10, 2.0, day, "INADIMPLENTE", 1.0) for i, v in enumerate(amounts)]
    rows += [("n", "1", 100.0, 2**62, 2.0, day, "INADIMPLENTE", 1.0), ("t", "1", 100.0, 10, 1e18, day, "ATIVO", 1.0)]
    df = spark.createDataFrame(rows, LOAN)
    quotes = {row.emprestimo_id: row.parcela_cotada for row in loanbook.cotacao_parcela(df).collect()}
    assert (quotes["1"], quotes["2"], quotes["3"], quotes["4"]) == (float("inf"), -5.1, 25.5, None)
    assert quotes["0"] == pytest.approx(1.02e19) and quotes["n"] == 0.0 and quotes["t"] == pytest.approx(1e17)
    clients = spark.createDataFrame([("1", 300, "ALTO")], "cliente_id string, score_credito long, faixa_risco string")
    finite = df.where("emprestimo_id in ('0', '3')")
    row = loanbook.perda_esperada(finite, clients).first()
    assert (row.total_emprestimos, row.valor_total) == (2, 1e20 + 250)
    assert row.perda_esperada == pytest.approx(4e19)
    late = day + dt.timedelta(5)
    paid = spark.createDataFrame(
        [("1", 1, day, late, 1e20)],
        "emprestimo_id string, parcela_num int, data_vencimento date, data_pagamento date, valor_devido double",
    )
    assert loanbook.multa_atraso(paid).first().valor_apurado == pytest.approx(1.02e20)


def test_quotes_keep_all_decimals_of_the_rate(spark):
    rows = [(10000.0, 1, 0.125, 10012.5), (10000.0, 10, 1.255, 1012.55), (100.0, 1, 0.005, 100.01), (200.0, 1, 0.0025, 200.01)]
    df = spark.createDataFrame(rows, "v double, n long, t double, expected double")
    for row in df.select(loanbook.valor_cotado(F.col("v"), F.col("n"), F.col("t")).alias("q"), "expected").collect():
        assert row.q == row.expected


def test_schedule_survives_junk_counts(spark):
    day = dt.date(1999, 11, 1)
    rows = [("a", "1", 1.0, -(2**63), 2.0, day, "ATIVO", 1.0), ("b", "1", 1.0, 2**63 - 1, 2.0, day, "ATIVO", 1.0)]
    got = loanbook.cronograma_parcelas(spark.createDataFrame(rows, LOAN), "2000-01-01").collect()
    assert [(r.emprestimo_id, r.parcela_num) for r in got] == [("b", 1), ("b", 2)]

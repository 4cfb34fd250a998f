"""The driver contract on the smallest tables: every query against its SQL."""

import os

import pytest

import __spark_entry__ as contract
from checks.compare import rows, run_sql, types
from checks.oracle import oracle_sql
from checks.queries import queries

SF = "/root/testdata/sf0.001"
NAMES = sorted(queries())

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(NAMES)
    assert set(NAMES) <= set(contract.queries()) and set(NAMES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    ours = contract.queries()[name](spark, SF).toArrow()
    theirs = run_sql(SF, contract.oracle_sql()[name])
    assert types(ours) == types(theirs)
    assert rows(ours) == rows(theirs)
    assert ours.num_rows > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "estado", "total_emprestimos", "inadimplentes", "taxa_inadimplencia_pct", "valor_em_risco",
    ]
    assert df.count() == 5

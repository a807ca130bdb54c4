"""Every registered query against its SQL counterpart."""

import pytest
from compare import conectar, diferencia

import __spark_entry__ as entrada
from retalia.plans.oracle import ORACLE_SQL
from retalia.plans.queries import QUERIES

CARPETA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return conectar(CARPETA)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert QUERIES.items() <= entrada.queries().items() and ORACLE_SQL.items() <= entrada.oracle_sql().items()


@pytest.mark.parametrize("nombre", sorted(QUERIES))
def test_query(spark, con, nombre):
    df = QUERIES[nombre](spark, CARPETA)
    assert diferencia(df, con, ORACLE_SQL[nombre]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for malo in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert malo not in plan


def test_entry(spark):
    df = entrada.entry(spark)
    assert df.columns[:4] == ["ambito", "producto_id", "posicion", "puntaje_final"]
    assert df.count() > 0

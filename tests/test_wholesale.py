import dataclasses
import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_sales import linea, retail

from retalia import Params
from retalia.operators import skew
from retalia.operators.wholesale import dim_clientes_mayoristas

P = Params(as_of=dt.date(2024, 7, 15))


@pytest.mark.parametrize("n", [1, 10, 99_999, 100_001, 1_000_000])
def test_percentiles_at_every_size(spark, n):
    """Groups of 3/5 and 2/5 of the rows, one of them with many ties, and NULLs."""
    df = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 5 < 3, "GLOBAL").otherwise("R1").alias("g"),
        F.when(F.col("id") % 11 == 7, None)
        .when(F.col("id") % 5 < 3, F.pow(F.pmod(F.hash("id"), F.lit(100_003)), F.lit(3.0)))
        .otherwise(F.when(F.col("id") % 7 == 0, 2.5).otherwise(F.col("id") % 3))
        .cast("double")
        .alias("v"),
    )
    qs = {"q1": 0.25, "q3": 0.75, "tope": 1.0}
    hay = {r.g: (r.q1, r.q3, r.tope) for r in skew.percentiles_exactos(df, ["g"], "v", qs).collect()}
    exacto = df.groupBy("g").agg(F.percentile("v", [0.25, 0.75, 1.0]).alias("p")).collect()
    assert hay.keys() == {r.g for r in exacto if r.p}
    for r in exacto:
        if r.p:
            assert hay[r.g] == pytest.approx(r.p, rel=1e-12)


@pytest.mark.parametrize("semilla", range(2))
def test_percentiles_with_null_groups(spark, semilla):
    azar = random.Random(semilla)
    filas = [
        (azar.choice(["a", "a", "b", None]), azar.choice([None, float(azar.randrange(40)), azar.gauss(0, 1e6)]))
        for _ in range(4000)
    ]
    filas += [("chico", 1.0), ("chico", 2.0), ("nulo", None)]
    df = spark.createDataFrame(filas, "g string, v double").repartition(5)
    hay = {r.g: (r.q1, r.q3) for r in skew.percentiles_exactos(df, ["g"], "v", {"q1": 0.25, "q3": 0.75}).collect()}
    grupos = defaultdict(list)
    for g, v in filas:
        if v is not None:
            grupos[g].append(v)
    assert hay.keys() == grupos.keys()
    for g, vs in grupos.items():
        assert hay[g] == pytest.approx(tuple(np.quantile(vs, [0.25, 0.75])), rel=1e-12)
    todos = [v for _, v in filas if v is not None]
    (total,) = skew.percentiles_exactos(df, [], "v", {"m": 0.5}).collect()
    assert total.m == pytest.approx(np.median(todos), rel=1e-12)


def test_few_statistics_leave_the_rows_where_they_are(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        filas = spark.range(0, 5000, 1, 8).selectExpr("id AS x", "CAST(id % 3 AS string) AS g")
        stats = filas.groupBy("g").agg(F.max("x").alias("mx"))
        unidas = skew.adjuntar_por_grupo(filas, stats, ["g"], "x")
        plan = unidas._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        monkeypatch.setattr(skew, "FILAS_DIFUNDIBLES", 0)
        saladas = skew.adjuntar_por_grupo(filas, stats, ["g"], "x")
        assert "SortMergeJoin" in saladas._jdf.queryExecution().executedPlan().toString()
        assert sorted(saladas.collect()) == sorted(unidas.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_group_statistics_reach_every_row(spark):
    filas = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "g string, x int")
    stats = filas.groupBy("g").agg(F.max("x").alias("mx"))
    hay = {(r.g, r.x): r.mx for r in skew.adjuntar_por_grupo(filas, stats, ["g"], "x").collect()}
    assert hay == {("a", 1): 2, ("a", 2): 2, (None, 3): 3, ("b", 4): 4}


METRICAS = (
    "ambito string, cliente_id_limpio string, tickets_unicos bigint, dias_con_compra bigint, "
    "upt double, pct_tickets_grandes double, ventas_totales double"
)


def _niveles(spark, filas):
    df = spark.createDataFrame([("GLOBAL", c, 1, 1, u, p, v) for c, u, p, v in filas], METRICAS)
    return {r.cliente_id_limpio: r for r in dim_clientes_mayoristas(df, P).collect()}


def test_levels_and_floor_of_the_share(spark):
    hay = _niveles(
        spark,
        [("a", 9.0, 0.5, 9.0), ("b", 9.0, 0.1, 9.0), ("c", 1.0, 0.1, 9.0), ("d", 1.0, 0.1, 1.0), ("e", 1.0, 0.39, 1.0)],
    )
    assert {c: r.nivel_mayorista for c, r in hay.items()} == {
        "a": "Alto", "b": "Medio", "c": "Potencial", "d": "Minorista", "e": "Minorista",
    }
    assert hay["a"].umbral_pct == 0.4 and hay["a"].puntaje == 3
    alta = _niveles(spark, [(c, 1.0, p, 1.0) for c, p in zip("abcd", (0.5, 0.6, 0.7, 0.9), strict=True)])
    assert alta["a"].umbral_pct == pytest.approx(0.75)
    assert {c for c, r in alta.items() if r.c2_pct_grandes_alto} == {"d"}


def test_returns_count_for_sales_only(spark):
    v = [
        linea(cliente="1", factura="1", u=4.0, gs=10.0),
        linea(cliente="1", factura="2", u=-1.0, gs=-2.5, fecha=dt.date(2024, 6, 4)),
        linea(cliente="2", factura="3", u=-1.0, gs=-5.0),
        linea(cliente="3", factura="4", u=2.0, gs=1.0, pdv="4"),
    ]
    hay = {(r.ambito, r.cliente_id_limpio): r for r in retail(spark, v).int_mayoristas_metricas_cliente.collect()}
    assert hay.keys() == {("GLOBAL", "1"), ("GLOBAL", "3"), ("SL", "1")}
    uno = hay["GLOBAL", "1"]
    assert (uno.tickets_unicos, uno.dias_con_compra, uno.upt, uno.ventas_totales) == (1, 2, 4.0, 7.5)


def _a_mano(v, corte):
    ambitos = {"3": "SL", "5": "R1", "6": "R2"}
    lineas = defaultdict(list)
    for f in v:
        lineas["GLOBAL", f[0]].append(f)
        if f[2] in ambitos:
            lineas[ambitos[f[2]], f[0]].append(f)
    salida = {}
    for clave, fs in lineas.items():
        tickets = defaultdict(float)
        for f in fs:
            tickets[f[7]] += f[5]
        buenos = [u for u in tickets.values() if u > 0]
        if buenos:
            salida[clave] = (
                len(buenos), len({f[3] for f in fs}), sum(buenos) / len(buenos),
                sum(u > corte for u in buenos) / len(buenos), sum(f[4] for f in fs),
            )
    return salida


@pytest.mark.parametrize("semilla", [5, 6])
def test_against_brute_force(spark, semilla):
    azar = random.Random(semilla)
    v = [
        linea(
            cliente="777" if azar.random() < 0.4 else str(azar.randrange(40)),
            pdv=azar.choice("3456"),
            fecha=dt.date(2023, 7, 1) + dt.timedelta(days=azar.randrange(366)),
            gs=float(azar.randrange(-5, 60)),
            u=float(azar.choice([-1, 1, 2, 3, 30])),
            factura=str(azar.randrange(300)),
        )
        for _ in range(1200)
    ]
    r = retail(spark, v)
    (corte,) = r.int_mayoristas_umbral_ticket_grande.collect()
    tickets = defaultdict(float)
    for f in v:
        tickets[f[7]] += f[5]
    q1, q3 = np.quantile([u for u in tickets.values() if u > 0], [0.25, 0.75])
    assert (corte.q1, corte.q3) == pytest.approx((q1, q3))
    assert corte.umbral_ticket_grande == pytest.approx(q3 + 1.5 * (q3 - q1))
    hay = {
        (x.ambito, x.cliente_id_limpio): (
            x.tickets_unicos, x.dias_con_compra, x.upt, x.pct_tickets_grandes, x.ventas_totales,
        )
        for x in r.int_mayoristas_metricas_cliente.collect()
    }
    esperado = _a_mano(v, corte.umbral_ticket_grande)
    assert hay.keys() == esperado.keys()
    for k, x in esperado.items():
        assert hay[k] == pytest.approx(x), k


def test_no_sales_no_rows(spark):
    r = retail(spark, [], params=dataclasses.replace(P))
    assert r.int_mayoristas_umbral_ticket_grande.count() == 0
    assert r.dim_clientes_mayoristas.count() == 0

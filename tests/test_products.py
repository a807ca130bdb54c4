import dataclasses
import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from test_sales import linea, retail

from retalia import Params

P = Params(as_of=dt.date(2024, 7, 15), top300_umbral_ventas_gs=0)
INICIO = dt.date(2023, 7, 1)


def _ranking(spark, v, params=P):
    p = [(x, 3, None, None) for x in sorted({f[1] for f in v})]
    return retail(spark, v, p, params=params).top300_ranking.collect()


def test_ticket_size_buckets(spark):
    unidades = [0, 1, 2, 2.5, 3, 5, 6, -1, 0.5]
    v = [linea(u=float(u), factura=str(i)) for i, u in enumerate(unidades)]
    v += [linea(u=0.4, factura="x"), linea(u=0.6, factura="x")]  # one ticket of 1
    for fila in _ranking(spark, v):
        assert (fila.tickets_1_2, fila.tickets_3_5, fila.tickets_6_mas) == (3, 2, 1)
        assert fila.tickets_por_producto == 10
        assert [fila[f"norm_{x}"] for x in ("ventas", "tickets", "unidades_dia", "unidades_ticket")] == [100.0] * 4
        assert fila.puntaje_final == 100.0 and fila.posicion == 1


def test_ties_go_by_sales_then_id(spark):
    v = [linea(producto=p, factura=p) for p in ("b", "a", "c")]
    filas = {(r.ambito, r.posicion): r.producto_id for r in _ranking(spark, v)}
    assert filas == {(a, i + 1): p for a in ("GLOBAL", "3") for i, p in enumerate("abc")}


def test_threshold_comes_after_summing(spark):
    params = dataclasses.replace(P, top300_umbral_ventas_gs=15)
    v = [linea(gs=10.0, pdv="3"), linea(gs=10.0, pdv="5"), linea(producto="b", gs=15.0)]
    assert [(r.ambito, r.producto_id) for r in _ranking(spark, v, params)] == [("GLOBAL", "P")]


def test_positions_are_cut_at_the_limit(spark):
    params = dataclasses.replace(P, top300_posiciones=7)
    v = [linea(producto=f"p{i:02}", gs=float(100 + i), factura=str(i)) for i in range(20)]
    for ambito in ("GLOBAL", "3"):
        filas = [r for r in _ranking(spark, v, params) if r.ambito == ambito]
        assert sorted(r.posicion for r in filas) == list(range(1, 8))
        assert {r.producto_id for r in filas} == {f"p{i}" for i in range(13, 20)}


def test_sales_without_point_of_sale(spark):
    filas = _ranking(spark, [linea(pdv=None, u=1.0)])
    assert {r.ambito: r.tickets_1_2 for r in filas} == {"GLOBAL": 1, None: 0}


def _a_mano(v, params):
    grupos = defaultdict(list)
    for f in v:
        grupos["GLOBAL", f[1]].append(f)
        grupos[f[2], f[1]].append(f)
    medidas = {}
    for clave, fs in grupos.items():
        tickets = defaultdict(float)
        for f in fs:
            tickets[f[6], f[7]] += f[5]
        u, gs, dias = sum(f[5] for f in fs), sum(f[4] for f in fs), len({f[3] for f in fs})
        if gs > params.top300_umbral_ventas_gs:
            t = list(tickets.values())
            medidas[clave] = (
                [gs, len(t), u / dias, u / len(t)],
                dias,
                [sum(1 <= x <= 2 for x in t), sum(3 <= x <= 5 for x in t), sum(x >= 6 for x in t)],
            )
    salida = {}
    for ambito in {a for a, _ in medidas}:
        propios = {p: x for (a, p), x in medidas.items() if a == ambito}
        puntajes = []
        for p, (xs, dias, tramos) in propios.items():
            norma = []
            for i, x in enumerate(xs):
                todos = [y[0][i] for y in propios.values()]
                tope = math.log(1 + max(todos) - min(todos))
                norma.append(100.0 if tope == 0 else round(100 * math.log(1 + x - min(todos)) / tope, 8))
            score = round(sum(n * w for n, w in zip(norma, (0.4, 0.3, 0.2, 0.1), strict=True)), 10)
            puntajes.append((-score, -xs[0], p, dias, tramos))
        for posicion, (s, _, p, dias, tramos) in enumerate(sorted(puntajes), 1):
            salida[ambito, p] = (posicion, -s, dias, *tramos)
    return salida


@pytest.mark.parametrize("semilla", [3, 4])
def test_against_brute_force(spark, semilla):
    azar = random.Random(semilla)
    v = []
    for _ in range(1500):
        producto = "caliente" if azar.random() < 0.4 else f"p{azar.randrange(25)}"
        fecha = INICIO + dt.timedelta(days=azar.randrange(366))
        v.append(
            linea(
                producto=producto, pdv=azar.choice("3456"), fecha=fecha, gs=float(azar.randrange(-5, 60)),
                u=float(azar.randrange(-1, 5)), factura=str(azar.randrange(400)),
            )
        )
    hay = {
        (r.ambito, r.producto_id): (
            r.posicion, r.puntaje_final, r.dias_con_ventas, r.tickets_1_2, r.tickets_3_5, r.tickets_6_mas,
        )
        for r in _ranking(spark, v)
    }
    esperado = _a_mano(v, P)
    assert hay.keys() == esperado.keys()
    for k, x in esperado.items():
        assert hay[k] == pytest.approx(x, abs=1e-7), k


def test_longer_windows_count_every_day(spark):
    from retalia.operators.products import medidas_por_producto

    params = dataclasses.replace(P, ventana_meses_12m=17)
    dias = [dt.date(2023, 2, 1) + dt.timedelta(days=i) for i in range(0, 514, 3)]
    r = retail(spark, [linea(fecha=d) for d in dias], params=params)
    filas = medidas_por_producto(r.int_ventas_elegibles, params).collect()
    assert {x.dias_con_ventas for x in filas} == {sum(d < dt.date(2024, 7, 1) for d in dias)}


def test_best_rows_are_cut_before_the_shuffle(spark):
    plan = retail(spark, [linea()], params=P).top300_ranking._jdf.queryExecution().executedPlan().toString()
    antes, despues = plan.split("Exchange hashpartitioning(ambito", 1)
    assert "WindowGroupLimit" in antes and "WindowGroupLimit" in despues


def test_measures_read_the_fact_once(spark, tmp_path):
    from retalia.operators.products import medidas_por_producto
    from retalia.sources import schemas

    retail(spark, [linea()]).ventas.write.parquet(str(tmp_path / "v"))
    r = retail(spark, [linea()])
    r.ventas = schemas.leer_parquet(spark, str(tmp_path / "v"), schemas.VENTAS)
    medidas = medidas_por_producto(r.int_ventas_elegibles, P)
    medidas.collect()
    plan = medidas._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    # The lines are shuffled once, on product and ticket, without scope; the scopes come later.
    assert final.count("ReusedExchange") == 1
    assert final.count("REPARTITION_BY_COL") - final.count("ReusedExchange") == 1
    lineas = next(x for x in final.splitlines() if "Exchange hashpartitioning" in x and "REPARTITION_BY_COL" in x)
    assert "ambito" not in lineas
    assert "Expand" not in final and "Generate" not in final

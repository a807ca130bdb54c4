import datetime as dt
import random

import pytest

from retalia import Params
from retalia.operators import migration as m

P = Params(as_of=dt.date(2024, 7, 15))
PIVOTE = "cliente_id_limpio string, anio int, mes int, SL double, R1 double, R2 double, nombre string"


def _pivote(spark, filas):
    """filas: (customer, month number from 1, SL, R1, R2)."""
    return spark.createDataFrame(
        [(c, 2022 + (n - 1) // 12, (n - 1) % 12 + 1, float(a), float(b), float(d), c) for c, n, a, b, d in filas],
        PIVOTE,
    )


def _tipos(spark, filas):
    df = m.dim_cliente_tipo_migracion(_pivote(spark, filas))
    return {
        (r.cliente_id_limpio, (r.anio - 2022) * 12 + r.mes): r.tipo_cliente for r in df.collect()
    }


# Purchases by month (SL, R1, R2) and the label of the last one.
CASOS_V1 = [
    ([(1, 0, 0)], "Cliente SL"),
    ([(0, 1, 0)], "Cliente R1"),
    ([(0, 0, 1)], "Cliente R2"),
    ([(1, 1, 0)], "Cliente Dual SL y R1"),
    ([(1, 0, 1)], "Cliente Dual SL y R2"),
    ([(0, 1, 1)], "Cliente Dual R1 y R2"),
    ([(1, 1, 1)], "Cliente SL, R1 y R2"),
    ([(1, 0, 0), (0, 1, 0)], "Migro de SL a R1"),
    ([(1, 0, 0), (0, 0, 1)], "Migro de SL a R2"),
    ([(1, 0, 0), (0, 1, 1)], "Migro de SL a R1 y R2"),
    ([(0, 1, 0), (1, 0, 0)], "Migro de R1 a SL"),
    ([(0, 1, 0), (0, 0, 1)], "Migro de R1 a R2"),
    ([(0, 1, 0), (1, 0, 1)], "Migro de R1 a SL y R2"),
    ([(0, 0, 1), (1, 0, 0)], "Migro de R2 a SL"),
    ([(0, 0, 1), (0, 1, 0)], "Migro de R2 a R1"),
    ([(0, 0, 1), (1, 1, 0)], "Migro de R2 a SL y R1"),
    ([(1, 0, 0), (1, 1, 0)], "Cliente Dual SL y R1"),
    ([(1, 0, 0), (0, 1, 0), (0, 1, 0)], "Cliente Dual SL y R1"),
    ([(1, 0, 0), (2, 0, 0)], "Cliente SL"),
    ([(-1, 0, 0)], None),
    ([(1, 0, 0), (0, -1, 0)], "Cliente SL"),
    ([(1, 0, 0), (0, -1, 1)], "Cliente SL"),
    ([(1, 0, 0), (-1, 0, 0)], None),
    ([(1, 1, 0), (-1, -3, 0)], "Cliente R1"),
    ([(1, 1, 0), (0, 0, -2)], "Cliente SL, R1 y R2"),
]


def test_states(spark):
    filas = [
        (f"c{i}", n, *compra) for i, (meses, _) in enumerate(CASOS_V1) for n, compra in enumerate(meses, 1)
    ]
    tipos = _tipos(spark, filas)
    for i, (meses, esperado) in enumerate(CASOS_V1):
        assert tipos[f"c{i}", len(meses)] == esperado, (i, meses)
    assert {t for t in tipos.values() if t} == set(m.TIPOS_CLIENTE)


def test_all_zero_months_are_no_months(spark):
    assert _tipos(spark, [("a", 1, 0, 0, 0), ("a", 2, 1, 0, 0), ("a", 3, 0, 0, 0)]) == {
        ("a", 2): "Cliente SL"
    }


def _eventos(spark, compras):
    """compras: (customer, month number, branch)."""
    por_mes = {}
    for c, n, s in compras:
        por_mes.setdefault((c, n), dict.fromkeys(m.SUCURSALES, 0.0))[s] += 10 * n
    filas = [(c, n, v["SL"], v["R1"], v["R2"]) for (c, n), v in por_mes.items()]
    base = m.int_canibalizacion_migracion_base(_pivote(spark, filas), P)
    evolutivo = m.fct_canibalizacion_evolutivo_cliente(base)
    return sorted(
        (
            r.cliente_id_limpio,
            (r.anio - 2022) * 12 + r.mes,
            r.local_origen,
            r.local_destino,
            r.tipo_cliente,
            r.monto_total,
        )
        for r in m.dim_cliente_migracion_eventos(evolutivo, P).collect()
    )


def test_events(spark):
    compras = [
        ("unico", 3, "R1"), ("unico", 5, "R1"),
        ("empate", 3, "SL"), ("empate", 3, "R1"), ("empate", 4, "SL"),
        ("tres", 3, "SL"), ("tres", 6, "R1"),
        ("cuatro", 3, "SL"), ("cuatro", 7, "R1"),
        # back in the origin between two jumps: the second one is no migration
        ("vuelve", 1, "SL"), ("vuelve", 6, "R1"), ("vuelve", 9, "SL"), ("vuelve", 10, "R2"),
        ("ocasional", 4, "SL"),
    ]
    assert _eventos(spark, compras) == [
        ("cuatro", 7, "SL", "R1", "Recurrente - Migracion", 70.0),
        ("empate", 3, "R1", "SL", "Nuevo - Dual", 30.0),
        ("tres", 6, "SL", "R1", "Recurrente - Dual", 60.0),
        ("unico", 3, "R1", "R1", "Nuevo - Unico", 30.0),
        ("vuelve", 6, "SL", "R1", "Recurrente - Migracion", 60.0),
        ("vuelve", 10, "SL", "R2", "Recurrente - Dual", 100.0),
    ]


def test_window_ends_with_the_data(spark):
    # months 1..30: the window of 24 keeps 7..30
    compras = [("viejo", 6, "SL"), ("viejo", 8, "SL"), ("justo", 7, "SL"), ("justo", 30, "R1")]
    assert [(c, n) for c, n, *_ in _eventos(spark, compras)] == [("justo", 30)]


def _eventos_a_mano(compras):
    ultimo = max(n for _, n, _ in compras)
    compras = {x for x in compras if x[1] > ultimo - 24}
    salida = []
    for c in {c for c, _, _ in compras}:
        propias = [(n, s) for x, n, s in compras if x == c]
        if len({n for n, _ in propias}) < 2:
            continue
        primeras = sorted((min(n for n, s in propias if s == suc), suc) for suc in {s for _, s in propias})
        (n0, origen), resto = primeras[0], primeras[1:]
        if not resto:
            salida.append((c, n0, origen, origen, "Nuevo - Unico", 10.0 * n0))
        for n, s in resto:
            antes = [k for k, suc in propias if suc == origen and k < n]
            forma = "Migracion" if antes and n - max(antes) > 3 else "Dual"
            salida.append((c, n, origen, s, f"{'Nuevo' if n == n0 else 'Recurrente'} - {forma}", 10.0 * n))
    return sorted(salida)


@pytest.mark.parametrize("semilla", [1, 2])
def test_events_against_brute_force(spark, semilla):
    azar = random.Random(semilla)
    compras = sorted(
        {
            (f"c{azar.randrange(60)}", azar.randrange(1, 31), azar.choice(m.SUCURSALES))
            for _ in range(400)
        }
    )
    assert _eventos(spark, compras) == _eventos_a_mano(compras)


def test_events_shuffle_by_customer_once(spark, tmp_path):
    """Windows after the base reuse its partitioning: one exchange, no join."""
    _pivote(spark, [("a", 1, 1, 0, 0), ("a", 2, 0, 1, 0)]).write.parquet(str(tmp_path / "p"))
    base = m.int_canibalizacion_migracion_base(spark.read.parquet(str(tmp_path / "p")), P)
    eventos = m.dim_cliente_migracion_eventos(m.fct_canibalizacion_evolutivo_cliente(base), P)
    plan = eventos._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(cliente_id_limpio") == 1
    assert "Join" not in plan


def test_summary(spark):
    eventos = spark.createDataFrame(
        [("a", "Nuevo - Dual", "SL", "R1", 2024, 1, 5.0), ("b", "Nuevo - Dual", "SL", "R1", 2024, 1, 2.5)],
        "cliente_id_limpio string, tipo_cliente string, local_origen string, local_destino string, "
        "anio int, mes int, monto_total double",
    )
    (fila,) = m.fct_canibalizacion_migracion_resumen(eventos).collect()
    assert (fila.cantidad_clientes, fila.monto_total) == (2, 7.5)

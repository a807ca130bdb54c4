import datetime as dt

import pytest
from test_sales import linea, retail

from retalia import Params
from retalia.operators import publish, sales

P = Params(as_of=dt.date(2024, 7, 15))
T1, T2, T3 = (dt.datetime(2024, m, 1, 6) for m in (5, 6, 7))


def _filas(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_by_key(spark):
    previo = spark.createDataFrame([("a", 1), ("b", 2), (None, 9)], "k string, x int")
    nuevo = spark.createDataFrame([("b", 3), ("c", 4)], "k string, x int")
    assert _filas(publish.incremental_upsert(previo, nuevo, ["k"])) == [("a", 1), ("b", 3), ("c", 4), (None, 9)]
    assert publish.incremental_upsert(None, nuevo, ["k"]) is nuevo


def _ventas_36m(spark, v, params=P, previo=None):
    r = retail(spark, v, params=params)
    return publish.refrescar_ventas_36m(previo, r.int_ventas_elegibles, params)


def test_refresh_equals_full_build(spark):
    """Look-back from 31 May: May is rebuilt whole although the run starts mid-month."""
    viejas = [
        linea(fecha=dt.date(2021, 6, 5), gs=1.0),  # leaves the window between the runs
        linea(fecha=dt.date(2023, 1, 5), gs=2.0),
        linea(fecha=dt.date(2024, 5, 2), gs=4.0),  # same key as the late line below
        linea(fecha=dt.date(2024, 5, 3), gs=8.0, cliente="200"),  # cancelled later
    ]
    antes = Params(as_of=dt.date(2024, 6, 15))
    previo = spark.createDataFrame(_ventas_36m(spark, viejas, antes).collect(), _ventas_36m(spark, viejas, antes).schema)
    assert previo.count() == 4
    hoy = viejas[:3] + [linea(fecha=dt.date(2024, 5, 31), gs=16.0), linea(fecha=dt.date(2024, 6, 20), gs=32.0)]
    refrescadas = _filas(_ventas_36m(spark, hoy, previo=previo))
    assert refrescadas == _filas(_ventas_36m(spark, hoy))
    assert refrescadas == [
        ("100", "P", "3", 2023, 1, 2.0),
        ("100", "P", "3", 2024, 5, 20.0),
        ("100", "P", "3", 2024, 6, 32.0),
    ]


def test_refresh_leaves_older_months_alone(spark):
    """A late line before the look-back waits for the next full build."""
    previo = _ventas_36m(spark, [linea(fecha=dt.date(2024, 4, 30), gs=1.0)])
    hoy = [linea(fecha=dt.date(2024, 4, 30), gs=1.0), linea(fecha=dt.date(2024, 4, 29), gs=5.0)]
    assert [f[-1] for f in _filas(_ventas_36m(spark, hoy, previo=previo))] == [1.0]


def _historia(df, clave="k"):
    return sorted(
        (r[clave], r.v, r.dbt_valid_from, r.dbt_valid_to) for r in df.collect()
    )


def _hoy(spark, *filas):
    return spark.createDataFrame(filas, "k string, v string")


@pytest.mark.parametrize("cerrar", [False, True])
def test_history(spark, cerrar):
    def foto(actual, historia, ahora):
        return publish.snapshot_scd2(actual, historia, "k", ["v"], ahora, cerrar_desaparecidos=cerrar)

    h1 = foto(_hoy(spark, ("a", "1"), ("b", "1"), ("c", None), ("d", "1")), None, T1)
    h2 = foto(_hoy(spark, ("a", "1"), ("b", "2"), ("c", None), ("e", "1")), h1, T2)
    fin = T2 if cerrar else None
    assert _historia(h2.where("k <> 'b'")) == [
        ("a", "1", T1, None), ("c", None, T1, None), ("d", "1", T1, fin), ("e", "1", T2, None),
    ]
    assert _historia(h2.where("k = 'b'")) == [("b", "1", T1, T2), ("b", "2", T2, None)]

    # equal input adds nothing
    igual = foto(_hoy(spark, ("a", "1"), ("b", "2"), ("c", None), ("e", "1")), h2, T3)
    assert _filas(igual) == _filas(h2)

    # a key that comes back opens a version when its last one was closed
    h3 = foto(_hoy(spark, ("a", "1"), ("b", "2"), ("c", "x"), ("d", "1"), ("e", "1")), h2, T3)
    vueltas = [("d", "1", T1, T2), ("d", "1", T3, None)] if cerrar else [("d", "1", T1, None)]
    assert _historia(h3.where("k = 'd'")) == vueltas
    assert h3.where("k = 'c'").count() == 2
    assert h3.select("dbt_scd_id").distinct().count() == h3.count()


def test_table_is_swapped_not_overwritten(spark, tmp_path):
    carpeta = str(tmp_path)
    uno = publish.publicar_tabla(_hoy(spark, ("a", "1")), "prueba_tabla", carpeta)
    dos = publish.publicar_tabla(
        uno.unionByName(_hoy(spark, ("b", "2"))), "prueba_tabla", carpeta, particion=["v"]
    )
    assert _filas(dos.select("k")) == [("a",), ("b",)]
    assert _filas(uno.select("k")) == [("a",)]
    assert _filas(spark.table("prueba_tabla").select("k")) == [("a",), ("b",)]
    assert len(list((tmp_path / "prueba_tabla").iterdir())) == 2
    spark.sql("DROP VIEW prueba_tabla")


def test_months_are_rebalanced_before_writing(spark):
    df = spark.range(10).selectExpr("id % 3 AS periodo", "id").hint("rebalance", "periodo")
    assert "REBALANCE_PARTITIONS_BY_COL" in df._jdf.queryExecution().executedPlan().toString()


def test_view(spark):
    publish.publicar_vista(_hoy(spark, ("a", "1")), "prueba_vista")
    assert spark.table("prueba_vista").count() == 1


def test_months_of_the_window(spark):
    v = [linea(fecha=d) for d in (dt.date(2021, 6, 30), dt.date(2021, 7, 1), dt.date(2024, 6, 30), dt.date(2024, 7, 1))]
    r = retail(spark, v)
    hay = {(x.anio, x.mes) for x in sales.fct_ventas_36m(r.int_ventas_elegibles, P).collect()}
    assert hay == {(2021, 7), (2024, 6)}


def test_months_are_replaced_in_place(spark, tmp_path):
    """Only months of the look-back are written; one that became empty disappears."""
    carpeta, nombre = str(tmp_path), "prueba_meses"

    def correr(v, as_of, **k):
        params = Params(as_of=as_of)
        r = retail(spark, v, params=params)
        return publish.publicar_ventas_36m(r.int_ventas_elegibles, params, nombre, carpeta, **k)

    def paths():
        return {int(p): r for p, r in publish.partes_publicadas(spark, nombre)}

    lejos, abril, mayo = (dt.date(2021, 6, 5), dt.date(2024, 4, 30), dt.date(2024, 5, 2))
    antes = [linea(fecha=d, gs=1.0) for d in (lejos, abril, mayo)]
    assert correr(antes, dt.date(2024, 6, 15)).count() == 3
    previos = paths()
    assert set(previos) == {202106, 202404, 202405}

    junio = dt.date(2024, 6, 20)
    hoy = [linea(fecha=lejos), linea(fecha=abril, gs=9.0), linea(fecha=junio, gs=2.0)]
    tabla = correr(hoy, dt.date(2024, 7, 15))
    assert _filas(tabla) == [("100", "P", "3", 2024, 4, 1.0), ("100", "P", "3", 2024, 6, 2.0)]
    assert set(paths()) == {202404, 202406} and paths()[202404] == previos[202404]

    completa = correr(hoy, dt.date(2024, 7, 15), completa=True)
    assert [f[-1] for f in _filas(completa)] == [9.0, 2.0]
    assert correr([], dt.date(2024, 7, 15), completa=True).count() == 0
    spark.sql(f"DROP VIEW {nombre}")


def test_only_new_and_changed_ids_are_written(spark, tmp_path):
    def correr(*filas, **k):
        df = spark.createDataFrame(filas, "cliente_id string, cliente_id_limpio string")
        tabla = publish.publicar_mapeo(df, "prueba_mapeo", str(tmp_path), **k)
        return _filas(tabla), [spark.read.parquet(r).count() for _, r in publish.partes_publicadas(spark, "prueba_mapeo")]

    assert correr(("a", "1"), ("b", "2"), ("c", None)) == ([("a", "1"), ("b", "2"), ("c", None)], [3])
    # b changes, d is new, the rest is as it was
    todas = [("a", "1"), ("b", "3"), ("c", None), ("d", "4")]
    assert correr(("a", "1"), ("b", "3"), ("c", None), ("d", "4")) == (todas, [3, 2])
    assert correr(("a", "1")) == (todas, [3, 2, 0])
    assert correr(("b", "2")) == ([("a", "1"), ("b", "2"), ("c", None), ("d", "4")], [3, 2, 0, 1])
    assert correr(("a", "9"), completa=True) == ([("a", "9")], [1])
    spark.sql("DROP VIEW prueba_mapeo")


def test_closed_versions_are_not_rewritten(spark, tmp_path):
    def foto(actual, historia, ahora):
        return publish.snapshot_scd2(actual, historia, "k", ["v"], ahora, cerrar_desaparecidos=True)

    esperada = None
    rutas = []
    for ahora, filas in ((T1, [("a", "1"), ("b", "1")]), (T2, [("a", "2"), ("b", "1")]), (T3, [("a", "2")])):
        hoy = _hoy(spark, *filas)
        esperada = foto(hoy, esperada, ahora)
        tabla = publish.publicar_historia(foto, hoy, "prueba_historia", str(tmp_path), ahora)
        assert _filas(tabla) == _filas(esperada)
        cerradas = [r for p, r in publish.partes_publicadas(spark, "prueba_historia") if p == "cerradas"]
        assert cerradas[: len(rutas)] == rutas and len(cerradas) == len(rutas) + 1
        rutas = cerradas
    assert [spark.read.parquet(r).count() for r in rutas] == [0, 1, 1]
    spark.sql("DROP VIEW prueba_historia")


def test_shared_lines_give_the_same_marts(spark):
    v = [
        linea(cliente=str(c), producto=p, pdv=x, factura=f"{c}{p}{n}", fecha=dt.date(2024, n, 1), gs=float(n))
        for c in (1, 2) for p in "ab" for x in "35" for n in (1, 3, 6)
    ]
    r = retail(spark, v, [("a", 3, None, None), ("b", 3, None, None)], params=Params(as_of=P.as_of, top300_umbral_ventas_gs=0))
    fijo = r.fijar_elegibles()
    for nombre in ("top300_ranking", "dim_clientes_mayoristas", "dim_cliente_migracion_eventos"):
        filas = _filas(getattr(fijo, nombre))
        assert filas and filas == _filas(getattr(r, nombre))

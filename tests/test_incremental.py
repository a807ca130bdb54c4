"""Corrections of any age, merged parts, histories read as of a date, balances and measures carried forward."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_sales import linea, retail

from retalia import Params
from retalia.operators import historia, mensual, migration, products, publish, sales, skew

P = Params(as_of=dt.date(2024, 7, 15))


def _filas(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# -- corrections -------------------------------------------------------------------


def test_fingerprint_ignores_order_and_counts_repeats(spark):
    lineas = [(f"c{i % 5}", "p", "3", 2024, 1 + i % 2, float(i)) for i in range(40)] + [(None, None, None, 2024, 3, None)]
    esquema = "cliente_id_limpio string, producto_id string, pdv_id string, anio int, mes int, total_ventas double"

    def huellas(filas, partes):
        return dict(publish.huellas_por_mes(spark.createDataFrame(filas, esquema).repartition(partes)).collect())

    base = huellas(lineas, 1)
    assert set(base) == {202401, 202402, 202403}
    assert huellas(lineas[::-1], 7) == base
    otra = huellas([*lineas, lineas[0]], 3)
    assert otra[202401] != base[202401] and otra[202402] == base[202402]
    # a line that comes three times, and one that comes once with two others, differ
    assert huellas([lineas[0]] * 2 + [lineas[2]], 1) != huellas([lineas[0]] + [lineas[2]] * 2, 1)


def test_exactly_the_corrected_months_are_written(spark, tmp_path):
    nombre = "prueba_correcciones"

    def correr(v, as_of=P.as_of):
        params = Params(as_of=as_of)
        r = retail(spark, v, params=params)
        tabla = publish.publicar_correcciones(r.int_ventas_elegibles, params, nombre, str(tmp_path))
        assert _filas(tabla) == _filas(sales.fct_ventas_36m(r.int_ventas_elegibles, params))
        return {int(p): ruta for p, ruta in publish.partes_publicadas(spark, nombre)}

    meses = [dt.date(2021, 7, 3), dt.date(2022, 12, 31), dt.date(2023, 9, 1), dt.date(2024, 5, 5), dt.date(2024, 6, 30)]
    v = [linea(fecha=d, gs=float(g), factura=str(g)) for d in meses for g in range(3)]
    uno = correr(v)
    assert set(uno) == {202107, 202212, 202309, 202405, 202406}
    assert correr(v[::-1]) == uno  # nothing differs, nothing is written
    otra = [x for x in v if x[3] != meses[2]] + [linea(fecha=meses[2], gs=7.0), linea(fecha=dt.date(2023, 1, 1))]
    dos = correr(otra)
    assert set(dos) == set(uno) | {202301}
    assert {m for m in dos if dos[m] != uno.get(m)} == {202309, 202301}
    tres = correr([x for x in otra if x[3] != meses[1]])  # a month that lost all lines
    assert set(tres) == set(dos) - {202212} and all(tres[m] == dos[m] for m in tres)
    cuatro = correr([x for x in otra if x[3] != meses[1]], dt.date(2024, 8, 1))  # the window moves on
    assert set(cuatro) == set(tres) - {202107}
    assert correr([]) == {}
    spark.sql(f"DROP VIEW {nombre}")


def test_a_month_without_fingerprint_counts_as_different(spark, tmp_path):
    v = [linea(fecha=dt.date(2024, 5, 5)), linea(fecha=dt.date(2024, 6, 5))]
    r = retail(spark, v)
    publish.publicar_ventas_36m(r.int_ventas_elegibles, P, "prueba_sin_huella", str(tmp_path))
    antes = publish.partes_publicadas(spark, "prueba_sin_huella")
    publish.publicar_correcciones(r.int_ventas_elegibles, P, "prueba_sin_huella", str(tmp_path))
    despues = publish.partes_publicadas(spark, "prueba_sin_huella")
    assert not set(antes) & set(despues) and len(despues) == 2
    spark.sql("DROP VIEW prueba_sin_huella")


# -- merged parts ------------------------------------------------------------------


def test_parts_stay_few_and_rows_are_seldom_rewritten():
    azar = random.Random(2)
    for filas_nuevas in (lambda: 10, lambda: azar.randrange(1000), lambda: 0, lambda: azar.choice([0, 5, 10**6])):
        partes, escritas, nuevas = [10**6], 0, 0
        for _ in range(2000):
            partes.append(filas_nuevas())
            nuevas += partes[-1]
            juntas = publish.a_fusionar(partes)
            if juntas:
                partes[-juntas:] = [sum(partes[-juntas:])]
                escritas += partes[-1]
            assert len(partes) <= publish.PARTES
        assert escritas <= 12 * (nuevas + 10**6)


def test_fifty_runs_of_a_keyed_table(spark, tmp_path):
    azar, todas = random.Random(1), {}
    for k in range(50):
        lote = {f"id{azar.randrange(40)}": azar.choice(["a", "b", None]) for _ in range(azar.randrange(1, 6))}
        todas |= lote
        df = spark.createDataFrame(list(lote.items()), "cliente_id string, cliente_id_limpio string").coalesce(1)
        tabla = publish.publicar_mapeo(df, "prueba_cincuenta", str(tmp_path))
        assert len(publish.partes_publicadas(spark, "prueba_cincuenta")) <= publish.PARTES
    assert _filas(tabla) == sorted(todas.items(), key=str)
    spark.sql("DROP VIEW prueba_cincuenta")


def test_many_runs_of_a_history(spark, tmp_path):
    def foto(actual, pasada, ahora):
        return publish.snapshot_scd2(actual, pasada, "k", ["v"], ahora, cerrar_desaparecidos=True)

    azar, esperada = random.Random(5), None
    for k in range(14):
        filas = [(x, str(azar.randrange(2))) for x in "abcdef" if azar.random() < 0.8]
        hoy, ahora = spark.createDataFrame(filas, "k string, v string").coalesce(1), dt.datetime(2024, 1, 1 + k)
        esperada = foto(hoy, esperada, ahora)
        esperada = spark.createDataFrame(esperada.collect(), esperada.schema).coalesce(1)
        tabla = publish.publicar_historia(foto, hoy, "prueba_muchas", str(tmp_path), ahora)
    assert _filas(tabla) == _filas(esperada)
    assert len(publish.partes_publicadas(spark, "prueba_muchas")) <= publish.PARTES + 1
    spark.sql("DROP VIEW prueba_muchas")


# -- reading a history -------------------------------------------------------------


@pytest.fixture(params=["broadcast", "salted"])
def lista(request, monkeypatch):
    if request.param == "salted":
        monkeypatch.setattr(skew, "FILAS_DIFUNDIBLES", 0)


def test_label_valid_at_a_date(spark, lista):
    """A third of the facts are of one customer, whose label changes often."""
    azar = random.Random(3)
    cero = dt.datetime(2023, 1, 1)
    versiones = []
    for k in ["fijo", "caliente", *(f"c{i}" for i in range(20)), None]:
        desde = cero + dt.timedelta(days=azar.randrange(60))
        for n in range(40 if k == "caliente" else azar.randrange(1, 4)):
            hasta = desde + dt.timedelta(days=azar.randrange(1, 5 if k == "caliente" else 90), hours=azar.randrange(24))
            versiones.append((k, f"{k}{n}", n, desde, hasta))
            desde = hasta + dt.timedelta(days=azar.choice([0, 0, 9]))  # sometimes a gap
        if azar.random() < 0.6:
            versiones.append((k, f"{k}-abierta", 99, desde, None))
    hechos = [
        (i, azar.choice(["caliente"] * 7 + [f"c{j}" for j in range(13)] + ["fijo", "nadie", None]), cero + dt.timedelta(hours=azar.randrange(9000)))
        for i in range(900)
    ]
    hechos += [(1000, "fijo", None), (1001, "caliente", versiones[3][3]), (1001, "caliente", versiones[3][3])]

    def valida(k, t):
        for c, v, n, a, b in versiones:
            if c == k and k is not None and t is not None and a <= t and (b is None or t < b):
                return v, n
        return None, None

    pasada = spark.createDataFrame(versiones, "k string, v string, n int, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
    df = spark.createDataFrame(hechos, "i int, k string, t timestamp_ntz").repartition(5)
    got = historia.en_fecha(df, pasada, ["k"], "t", ["v", "n"])
    assert got.columns == ["i", "k", "t", "v", "n"]
    assert _filas(got) == sorted([(*h, *valida(h[1], h[2])) for h in hechos], key=str)
    assert _filas(historia.en_fecha(df.limit(0), pasada, ["k"], "t", ["v"])) == []
    assert {r.v for r in historia.en_fecha(df, pasada.limit(0), ["k"], "t", ["v"]).collect()} == {None}


@pytest.mark.parametrize("inclusive", [False, True])
def test_last_row_before_another(spark, inclusive):
    azar = random.Random(8)
    dia = lambda: dt.date(2023, 11, 1) + dt.timedelta(days=azar.randrange(150))
    clave = lambda: azar.choice(["caliente"] * 6 + ["a", "b", "c", None])
    serie = [(clave(), dia(), azar.randrange(5), azar.choice(["x", "y", None])) for _ in range(600)] + [("a", None, 1, "z")]
    hechos = [(clave(), dia(), i) for i in range(400)] + [("a", None, 999), ("nadie", dia(), 998), ("b", dt.date(2020, 1, 1), 997)]
    s = spark.createDataFrame(serie, "k string, d date, n int, w string").repartition(3)
    h = spark.createDataFrame(hechos, "k string, t date, i int").repartition(3)
    got = historia.ultimo_antes(h, s, ["k"], "t", "d", ["n", "w"], inclusive)
    assert got.columns == ["k", "t", "i", "d", "n", "w"]

    # the counterpart: for each fact the first row of a sorted subquery
    hh, ss = h.alias("h"), s.alias("s")
    antes = F.col("s.d") <= F.col("h.t").outer() if inclusive else F.col("s.d") < F.col("h.t").outer()
    sub = ss.where(F.col("s.k").eqNullSafe(F.col("h.k").outer()) & antes)
    sub = sub.select(F.max(F.struct("s.d", "s.n", "s.w")).alias("m"))
    want = hh.lateralJoin(sub, how="left").select("h.k", "h.t", "h.i", "m.d", "m.n", "m.w")
    assert _filas(got) == _filas(want)
    assert _filas(historia.ultimo_antes(h, s.limit(0), ["k"], "t", "d", ["n"], inclusive)) == sorted([(*x, None, None) for x in hechos], key=str)


# -- balances carried forward ------------------------------------------------------

PIVOTE = "cliente_id_limpio string, anio int, mes int, SL double, R1 double, R2 double, nombre string"


def test_states_carried_forward_equal_a_full_build(spark):
    azar = random.Random(11)
    clientes = [f"c{i}" for i in range(60)] + [None]
    periodos = [202101, 202102, 202105, 202201, 202301, 202305, 202306]
    monto = lambda: azar.choice([0.0, 0.0, 10.0, -10.0, 2.5])
    viejo = {(c, p): (monto(), monto(), monto()) for c in clientes for p in periodos[:-1] if azar.random() < 0.5}
    nuevo = {k: v for k, v in viejo.items() if k[1] > 202101}  # the first month leaves the window
    quietos = set(clientes[:25])
    for c in clientes:
        if c not in quietos and azar.random() < 0.7:
            nuevo[c, 202306] = (monto(), monto(), monto())
        if c not in quietos and azar.random() < 0.3:
            nuevo.pop((c, 202305), None)  # a month that was cancelled
        elif c not in quietos and azar.random() < 0.3:
            nuevo[c, 202305] = (monto(), monto(), monto())

    def pivote(datos):
        return spark.createDataFrame([(c, p // 100, p % 100, *m, None) for (c, p), m in datos.items()], PIVOTE)

    previos = migration.dim_cliente_tipo_migracion(pivote(viejo))
    estados, tocados = migration.tipo_migracion_incremental(previos, pivote(nuevo), 202102, 202305)
    assert _filas(estados) == _filas(migration.dim_cliente_tipo_migracion(pivote(nuevo)))
    no_cero = lambda d, c, p: d.get((c, p)) if any(d.get((c, p), ())) else None
    distintos = {c for c in clientes if any(no_cero(viejo, c, p) != no_cero(nuevo, c, p) for p in periodos)}
    assert {r[0] for r in tocados.collect()} == distintos and len(distintos) < len(clientes)


# -- stored months -----------------------------------------------------------------


def _ventas_con_cruces():
    """Tickets over months and branches, returns that net to nothing, a null branch, a hot product."""
    azar, v = random.Random(6), []
    for n in range(500):
        ticket = str(azar.randrange(120))
        fecha = dt.date(2023, 7, 1) + dt.timedelta(days=azar.randrange(366))
        producto = azar.choice(["P", "P", "Q", "R"])
        v.append(linea(cliente="1", producto=producto, pdv=azar.choice(["3", "4", "5", None]), fecha=fecha, gs=float(n), u=azar.choice([1.0, 2.0, 3.0, -1.0]), factura=ticket))
    return v


def test_measures_from_stored_months(spark, tmp_path):
    productos = [(p, 3, None, None) for p in "PQR"]
    v = _ventas_con_cruces()
    antes = [x for x in v if x[3] < dt.date(2024, 5, 20) and x[7] != "7"]
    for k, (filas, as_of) in enumerate([(antes, dt.date(2024, 6, 15)), (v, dt.date(2024, 7, 15)), (v, dt.date(2024, 7, 20))]):
        if k:  # lines outside the look-back are not looked at: those of another product stay unseen
            filas = filas + [linea(producto="Q", fecha=dt.date(2023, 9, 9), gs=1e9)]
        params = Params(as_of=as_of)
        r = retail(spark, filas, productos, params=params)
        tablas = mensual.publicar_parciales(r.int_ventas_elegibles, params, "prueba_parciales", str(tmp_path))
        if not k:
            rutas = dict(publish.partes_publicadas(spark, "prueba_parciales_tickets"))
    ahora = dict(publish.partes_publicadas(spark, "prueba_parciales_tickets"))
    assert {m for m in ahora if ahora[m] != rutas.get(m)} == {"202405", "202406"}
    # what was known of each month when it was read last
    vistas = [x for x in antes if x[3] < dt.date(2024, 5, 1)] + [x for x in v if x[3] >= dt.date(2024, 5, 1)]
    r = retail(spark, vistas, productos, params=P)
    want = _filas(products.medidas_por_producto(r.int_ventas_elegibles, P))
    assert len(want) > 10 and _filas(mensual.medidas_de_meses(*tablas)) == want
    assert tablas[2].count() > 50  # tickets do cross months
    for t in ("productos", "tickets", "cruces"):
        spark.sql(f"DROP VIEW prueba_parciales_{t}")


def test_no_sales_no_measures(spark, tmp_path):
    r = retail(spark, [])
    tablas = mensual.publicar_parciales(r.int_ventas_elegibles, P, "prueba_vacia", str(tmp_path))
    assert mensual.medidas_de_meses(*tablas).collect() == []

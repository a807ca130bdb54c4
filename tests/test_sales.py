import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from retalia import Params
from retalia.operators import customers, sales, skew, staging
from retalia.plans.retail import Retail
from retalia.sources import schemas, seeds
from retalia.sources.workspace import asentar

P = Params(as_of=dt.date(2024, 7, 15))
D = dt.date(2024, 6, 3)


def productos(spark, filas):
    """filas: (id, company, category 1, category 2)."""
    return spark.createDataFrame(
        [(p, e, a, b, None, None, None, p, None, None) for p, e, a, b in filas], schemas.PRODUCTOS
    )


def ventas(spark, filas):
    return spark.createDataFrame(filas, schemas.VENTAS)


def linea(cliente="100", producto="P", pdv="3", fecha=D, gs=10.0, u=1.0, timbrado="1", factura="1"):
    return (cliente, producto, pdv, fecha, gs, u, timbrado, factura)


def clientes(spark, filas):
    """filas: (id, document, name)."""
    return spark.createDataFrame([(i, d, n, "09", None) for i, d, n in filas], schemas.CLIENTES)


def retail(spark, v, p=None, c=None, **k):
    return Retail(
        ventas(spark, v),
        clientes(spark, c or []),
        productos(spark, p or [("P", 3, None, None)]),
        seeds.sucursales(spark),
        seeds.productos_excluidos(spark),
        k.pop("params", P),
        **k,
    )


def test_product_rules(spark):
    catalogo = [
        ("bien", 3, "ALMACEN", "Fideos"),
        ("sin", 3, None, None),
        ("otra", 1, "ALMACEN", "Fideos"),
        ("nula", None, "ALMACEN", None),
        ("b1", 3, "ALMACEN", "BÓLSA chica"),
        ("b2", 3, "ALMACEN", "mini bolsas"),
        ("e1", 3, "Egresos", None),
        ("s1", 3, "SERVICIO", None),
        ("c1", 3, "bolsa", None),  # only category 2 is looked at for bags
        ("442", 3, "ALMACEN", None),
    ]
    r = retail(spark, [linea(producto=p) for p, *_ in catalogo] + [linea(producto="x")], catalogo)
    assert {x.producto_id for x in r.int_ventas_elegibles.collect()} == {"bien", "sin", "c1"}


def test_customer_rules_with_and_without_stored_mapping(spark):
    v = [
        linea(cliente="44444401-7"),
        linea(cliente="SIN NOMBRE"),
        linea(cliente="555-1"),
        linea(cliente="555"),
        linea(cliente="huerfano 9"),
        linea(cliente="77  "),
        linea(cliente=None),
        linea(cliente="8" * 60),
    ]
    c = [("555-1", None, "a"), ("77", None, "b"), ("SIN NOMBRE", None, "c")]
    r = retail(spark, v, c=c)
    esperado = [("555", "555"), ("555-1", "555"), ("77", "77"), ("huerfano 9", "9")]

    def pares(df):
        return sorted((x.cliente_id, x.cliente_id_limpio) for x in df.collect())

    assert pares(r.int_ventas_elegibles) == esperado
    guardado = retail(spark, v, c=c, mapeo=r.int_clientes_mapeo_limpio)
    assert pares(guardado.int_ventas_elegibles) == esperado
    parcial = retail(spark, v, c=c, mapeo=r.int_clientes_mapeo_limpio.where("cliente_id <> '555'"))
    assert pares(parcial.int_ventas_elegibles) == [e for e in esperado if e[0] != "555"]


def test_ticket_id_of_missing_parts(spark):
    v = [linea(timbrado=None, factura="7"), linea(timbrado="1" * 60, factura=None), linea(timbrado=None, factura=None)]
    assert {x.ticket_id for x in retail(spark, v).int_ventas_elegibles.collect()} == {"_7", "1" * 50 + "_", "_"}


def test_closed_month_window(spark):
    dias = [dt.date(2023, 6, 30), dt.date(2023, 7, 1), dt.date(2024, 6, 30), dt.date(2024, 7, 1)]
    r = retail(spark, [linea(fecha=d) for d in dias])
    assert {x.fecha_venta for x in r.int_ventas_12m.collect()} == set(dias[1:3])


def test_date_window_reaches_the_scan(spark, tmp_path):
    ventas(spark, [linea()]).write.parquet(str(tmp_path / "v"))
    leidas = schemas.leer_parquet(spark, str(tmp_path / "v"), schemas.VENTAS)
    r = Retail(
        leidas, clientes(spark, []), productos(spark, []), seeds.sucursales(spark), seeds.productos_excluidos(spark), P
    )
    plan = r.int_ventas_12m.select("venta_gs")._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan parquet" in x and "fecha_venta" in x)
    assert "GreaterThanOrEqual(fecha_venta,2023-07-01)" in scan
    assert "timbrado" not in scan and "unidades" not in scan


def test_mapping(spark):
    c = [("555-1", None, "a"), ("555-1", "1", "b"), ("SIN NOMBRE", None, "c")]
    v = [linea(cliente="555"), linea(cliente="999", fecha=dt.date(2020, 1, 1)), linea(cliente="SIN NOMBRE")]
    r = retail(spark, v, c=c)
    assert sorted(map(tuple, r.int_clientes_mapeo_limpio.collect())) == [
        ("555", "555"), ("555-1", "555"), ("999", "999"),
    ]
    reciente = customers.int_clientes_mapeo_limpio(
        r.int_clientes_normalizados, r.stg_ventas, desde=P.inicio_lookback
    )
    assert sorted(x.cliente_id for x in reciente.collect()) == ["555", "555-1"]
    assert {x.cliente_id for x in customers.ids_huerfanos(r.stg_ventas, r.int_clientes_normalizados).collect()} == {
        "555", "999",
    }


def test_clean_customers(spark):
    r = retail(spark, [], c=[("555-1", None, "ana  paz"), ("555", "CI 1", "zoe"), ("X", "2", "y")])
    (fila,) = r.int_clientes_limpio.collect()
    assert (fila.cliente_id_limpio, fila.nombre, fila.ci_ruc, fila.celular) == ("555", "ZOE", "", "09")


def test_staging_cuts_text_and_blanks(spark):
    s = staging.stg_clientes(clientes(spark, [("9 ", None, "n" * 300), (None, None, None)]))
    (fila,) = s.collect()
    assert fila.cliente_id == "9" and len(fila.nombre) == 255
    m = spark.createDataFrame([("a" * 60, "1" * 60)], schemas.CLIENTES_MAPEO)
    assert [len(x) for x in staging.stg_clientes_mapeo(m).first()] == [50, 50]


def test_staged_categories_ignore_case_and_accents(spark):
    s = staging.stg_productos(productos(spark, [("P", 3, "Servición", "Bólsa")]))
    assert s.where((F.col("categoria_1") == "SERVICION") & (F.col("categoria_2") == "bolsa")).count() == 1


def test_monthly_sales_and_pivot_agree_on_lines_and_table(spark):
    v = [
        linea(gs=0.1), linea(gs=0.2, producto="Q"), linea(pdv="5", gs=5.0), linea(pdv="4", gs=9.0),
        linea(gs=-3.0, fecha=dt.date(2024, 5, 1)),
    ]
    p = [("P", 3, None, None), ("Q", 3, None, None)]
    directo = retail(spark, v, p, c=[("100", None, "ana")])
    tabla = retail(spark, v, p, c=[("100", None, "ana")], ventas_36m=directo.fct_ventas_36m)
    esperado = [("100", 2024, 5, -3.0, 0.0, 0.0, "ANA"), ("100", 2024, 6, 0.3, 5.0, 0.0, "ANA")]
    for r in (directo, tabla):
        assert sorted(map(tuple, r.fct_ventas_36m_pivotado.collect())) == esperado
    assert directo.fct_ventas_36m.count() == 5


@pytest.mark.parametrize("con_mapeo", [False, True])
def test_hot_product_and_customer_are_split(spark, monkeypatch, con_mapeo):
    """Most lines on one product and customer: lists beyond the broadcast limit are met
    on key and salt, the products and a stored mapping alike."""
    monkeypatch.setattr(skew, "FILAS_DIFUNDIBLES", 100)
    n = 60_000
    caliente = F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 500)
    filas = spark.range(0, n, 1, 16).select(
        (F.lit(1000) + caliente).cast("string").alias("cliente_id"),
        F.concat(F.lit("P"), caliente).alias("producto_id"),
        F.lit("3").alias("pdv_id"),
        F.lit(D).alias("fecha_venta"),
        F.lit(1.0).alias("venta_gs"),
        F.lit(1.0).alias("unidades"),
        F.col("id").cast("string").alias("timbrado"),
        F.col("id").cast("string").alias("factura_nro"),
    )
    catalogo = productos(spark, [(f"P{i}", 3, None, None) for i in range(500)])
    r = Retail(
        filas, clientes(spark, []), catalogo, seeds.sucursales(spark), seeds.productos_excluidos(spark), P
    )
    if con_mapeo:
        guardado = asentar(r.int_clientes_mapeo_limpio, "mapeo")
        r = Retail(filas, r.clientes, catalogo, r.sucursales, r.productos_excluidos, P, mapeo=guardado)
    ajustes = {
        "spark.sql.autoBroadcastJoinThreshold": "2000",  # the exclusion list fits, nothing else
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    previos = {k: spark.conf.get(k, None) for k in ajustes}
    try:
        for k, x in ajustes.items():
            spark.conf.set(k, x)
        df = sales.int_ventas_elegibles(
            r.stg_ventas, r.stg_productos, r.productos_excluidos, P, r.mapeo
        ).groupBy("producto_id").agg(F.count(F.lit(1)).alias("n"), F.max("ticket_id"), F.max("cliente_id"))
        assert sum(x.n for x in df.collect()) == n
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"Exchange hashpartitioning\(producto_id#\d+, _sal#", plan)
        assert not con_mapeo or re.search(r"Exchange hashpartitioning\(cliente_id#\d+, _sal#", plan)
    finally:
        for k, x in previos.items():
            spark.conf.unset(k) if x is None else spark.conf.set(k, x)

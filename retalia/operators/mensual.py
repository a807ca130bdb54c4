"""Product measures of the last twelve months from stored months.

A month is stored as three tables, each partitioned by month:

* ``productos``: sums, tickets, ticket sizes and days of each (scope, product) of the month;
* ``tickets``: units of each (point of sale, product, ticket) of the month;
* ``cruces``: tickets of the month that also stand in another month of the window.

Sums add up, and so do days, since no day is in two months.  Tickets would be counted once
for each of their months: for the few that cross a month the measures are corrected from
``tickets``.  So a run reads the lines of the months it stores and no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retalia.functions.numbers import exacto, razon
from retalia.functions.periods import periodo
from retalia.operators.products import MEDIDAS, TRAMOS
from retalia.operators.publish import partes_publicadas, publicar_meses
from retalia.operators.sales import en_meses
from retalia.operators.skew import join_repartido
from retalia.params import Params

_MES = ["anio", "mes"]


def _tramos(u) -> list:
    """How many of the tickets of ``u`` units fall into each size."""
    return [
        F.count_if(u.between(1, 2)).alias(TRAMOS[0]),
        F.count_if(u.between(3, 5)).alias(TRAMOS[1]),
        F.count_if(u >= 6).alias(TRAMOS[2]),
    ]


def _ambitos(por_pdv: DataFrame, claves: list[str], sumas: list) -> DataFrame:
    """Rows of points of sale, and their sums as the scope ``GLOBAL``; ``claves`` without the scope."""
    return por_pdv.unionByName(por_pdv.groupBy(*claves).agg(*sumas).withColumn("ambito", F.lit("GLOBAL")))


def tickets_de_mes(elegibles: DataFrame) -> DataFrame:
    """Units, amounts and days of each (month, point of sale, product, ticket)."""
    lineas = elegibles.select(
        F.year("fecha_venta").alias("anio"),
        F.month("fecha_venta").alias("mes"),
        F.col("pdv_id").cast("string").alias("ambito"),
        "producto_id",
        "ticket_id",
        exacto("unidades").alias("unidades"),
        exacto("venta_gs").alias("venta_gs"),
        F.call_function("shiftleft", F.lit(1), F.dayofmonth("fecha_venta") - 1).alias("dias"),
    ).repartition("producto_id", "ticket_id")
    return lineas.groupBy(*_MES, "ambito", "producto_id", "ticket_id").agg(
        F.sum("unidades").alias("unidades"), F.sum("venta_gs").alias("venta_gs"), F.bit_or("dias").alias("dias")
    )


def productos_de_mes(tickets: DataFrame) -> DataFrame:
    """Measures of each (month, scope, product); ``tickets`` is :func:`tickets_de_mes`."""
    sumas = [F.sum("unidades").alias("unidades"), F.sum("venta_gs").alias("venta_gs"), F.bit_or("dias").alias("dias")]
    todos = _ambitos(tickets, [*_MES, "producto_id", "ticket_id"], sumas)
    return (
        todos.groupBy(*_MES, "ambito", "producto_id")
        .agg(F.count("ticket_id").alias("tickets"), *sumas, *_tramos(F.col("unidades")))
        .withColumn("dias", F.bit_count("dias").cast("long"))
    )


def cruces_de_mes(propios: DataFrame, otros: DataFrame) -> DataFrame:
    """Tickets of the months of ``propios`` that also stand in another month, there or in ``otros``."""
    de_mes = propios.select(*_MES, "ticket_id").distinct()
    dentro = de_mes.groupBy("ticket_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("ticket_id")
    fuera = otros.select("ticket_id").distinct()
    return de_mes.join(dentro.unionByName(fuera).distinct(), "ticket_id", "left_semi").select(*_MES, "ticket_id")


def medidas_de_meses(productos: DataFrame, tickets: DataFrame, cruces: DataFrame) -> DataFrame:
    """Measures of (scope, product) over the stored months; equal to ``products.medidas_por_producto``."""
    u = F.col("unidades")
    unidades = [F.sum("unidades").alias("unidades")]
    cruzados = join_repartido(
        tickets.select(*_MES, "ambito", "producto_id", "ticket_id", "unidades"),
        cruces.select("ticket_id").distinct(),
        "ticket_id",
        ["producto_id"],
        "left_semi",
    )
    por_mes = _ambitos(cruzados, [*_MES, "producto_id", "ticket_id"], unidades)
    contados = [F.count("ticket_id").alias("tickets"), *_tramos(u)]
    una_vez = por_mes.groupBy("ambito", "producto_id", "ticket_id").agg(*unidades)
    una_vez = una_vez.groupBy("ambito", "producto_id").agg(*contados)
    de_mas = por_mes.groupBy("ambito", "producto_id").agg(*contados)
    cuentas = ["tickets", *TRAMOS]
    exactas = ["unidades", "venta_gs"]
    partes = productos.select("ambito", "producto_id", *cuentas, *exactas, "dias")
    for correccion, signo in ((una_vez, 1), (de_mas, -1)):
        ceros = {c: F.lit(0).cast(productos.schema[c].dataType) for c in (*exactas, "dias")}
        con_signo = {c: F.col(c) * signo for c in cuentas}
        partes = partes.unionByName(correccion.withColumns(ceros).withColumns(con_signo))
    sumadas = partes.groupBy("ambito", "producto_id").agg(*[F.sum(c).alias(c) for c in (*cuentas, *exactas, "dias")])
    return sumadas.select(
        "ambito",
        "producto_id",
        F.col("tickets").alias("tickets_por_producto"),
        u.cast("double").alias("unidades_totales"),
        F.col("venta_gs").cast("double").alias("ventas"),
        F.col("dias").alias("dias_con_ventas"),
        razon(u.cast("double"), F.col("tickets")).alias("unidades_por_ticket"),
        razon(u.cast("double"), F.col("dias")).alias("unidades_por_dia"),
        *TRAMOS,
    ).select(*MEDIDAS)


def publicar_parciales(elegibles: DataFrame, params: Params, nombre: str, carpeta: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One run: store the months of the window that are not stored yet and those of the look-back.

    Returns ``productos``, ``tickets`` and ``cruces`` of the whole window.
    """
    spark = elegibles.sparkSession
    inicio, corte = params.inicio_ventana(params.ventana_meses_12m), params.corte
    ventana = [inicio.year * 12 + inicio.month - 1 + k for k in range(params.ventana_meses_12m)]
    ventana = [n // 12 * 100 + n % 12 + 1 for n in ventana]
    tablas = {t: f"{nombre}_{t}" for t in ("productos", "tickets", "cruces")}
    estan = {int(p) for p, _ in partes_publicadas(spark, tablas["tickets"])}
    desde = params.inicio_lookback_mes
    # A month without sales has no part: once there is a first run, only later months can be missing.
    meses = {m for m in ventana if m >= desde.year * 100 + desde.month or m > max(estan, default=0)}

    def publicar(df: DataFrame, tabla: str) -> DataFrame:
        return publicar_meses(df, tablas[tabla], carpeta, inicio, corte, meses)

    tickets = publicar(tickets_de_mes(en_meses(elegibles, meses)), "tickets")
    mes = periodo(F.col("anio"), F.col("mes"))
    propios, otros = tickets.where(mes.isin(*meses)), tickets.where(~mes.isin(*meses))
    productos = publicar(productos_de_mes(propios), "productos")
    cruces = publicar(cruces_de_mes(propios, otros), "cruces")
    return productos, tickets, cruces

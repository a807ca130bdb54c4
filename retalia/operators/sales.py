"""The one definition of a valid sale, and its closed-month windows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retalia.functions import ids
from retalia.functions.numbers import exacto
from retalia.functions.text import contiene
from retalia.operators.skew import SALES_DE_CLAVE, join_repartido, medida, sin_difundir
from retalia.params import Params


def productos_validos(productos: DataFrame, excluidos: DataFrame, params: Params) -> DataFrame:
    """Ids of the products that count: company, categories, exclusion list.

    All product rules are settled here, on the catalogue, so that the fact meets one
    narrow list of ids.
    """
    valido = F.col("id_empresa") == params.id_empresa
    for texto in params.categoria_2_excluida:
        valido &= ~contiene(F.col("categoria_2"), texto)
    for texto in params.categoria_1_excluida:
        valido &= ~contiene(F.col("categoria_1"), texto)
    return productos.where(valido).select("producto_id").join(excluidos, "producto_id", "left_anti")


def _ticket_id() -> Column:
    def parte(nombre: str) -> Column:
        return F.coalesce(F.substring(nombre, 1, 50), F.lit(""))

    return F.concat(parte("timbrado"), F.lit("_"), parte("factura_nro"))


def int_ventas_elegibles(
    ventas: DataFrame,
    productos: DataFrame,
    excluidos: DataFrame,
    params: Params,
    mapeo: DataFrame | None = None,
) -> DataFrame:
    """Sale lines that count for analysis.

    ``mapeo`` is a stored customer mapping (as an incremental run keeps it); lines of
    ids it does not hold are dropped.  Without it the mapping is that of a full
    refresh, which holds every id ever sold to: then the clean id is computed on the
    line, and the fact is not shuffled by customer at all.

    The product is only asked for existence (its id is unique), hence a semi join.
    """
    if mapeo is None:
        limpio = F.substring(ids.cliente_id_limpio_o_vacio(F.col("cliente_id")), 1, params.largo_mapeo)
        con_cliente = (
            ventas.where(F.length("cliente_id") <= params.largo_mapeo)
            .withColumn("cliente_id_limpio", limpio)
            .where(~F.col("cliente_id_limpio").isin("", params.cliente_prueba))
        )
    else:
        # A placeholder customer may hold a third of the lines: met by size, or salted.
        con_cliente = join_repartido(
            ventas,
            mapeo.select("cliente_id", "cliente_id_limpio"),
            "cliente_id",
            ["producto_id", "fecha_venta", "factura_nro"],
            escribir=False,
        ).where(F.coalesce("cliente_id_limpio", F.lit("")) != params.cliente_prueba)
    validos = productos_validos(productos, excluidos, params)
    return join_repartido(
        con_cliente, validos, "producto_id", ["cliente_id", "fecha_venta", "factura_nro"], "left_semi"
    ).select(
        "cliente_id",
        "cliente_id_limpio",
        "producto_id",
        "pdv_id",
        "fecha_venta",
        "venta_gs",
        "unidades",
        _ticket_id().alias("ticket_id"),
    )


def lineas_descartadas(
    ventas: DataFrame,
    productos: DataFrame,
    excluidos: DataFrame,
    params: Params,
    mapeo: DataFrame | None = None,
) -> DataFrame:
    """Lines that :func:`int_ventas_elegibles` drops, by the first rule that drops them, in one pass.

    Rules in order: no id, id wider than the mapping, id that a stored mapping does not
    hold, no clean id, test customer, product that does not count; ``elegible`` is the rest.
    """
    con_producto = _marcadas(
        ventas.select("cliente_id", "producto_id"),
        productos_validos(productos, excluidos, params),
        "producto_id",
        "_valido",
        "cliente_id",
    )
    if mapeo is None:
        limpio = F.substring(ids.cliente_id_limpio_o_vacio(F.col("cliente_id")), 1, params.largo_mapeo)
        marcadas = con_producto.withColumns({"_limpio": limpio, "_mapeado": F.lit(True)})
    else:
        conocidos = mapeo.select("cliente_id", F.coalesce("cliente_id_limpio", F.lit(" ")).alias("_limpio"))
        marcadas = _marcadas(con_producto, conocidos, "cliente_id", "_mapeado", "producto_id")
    regla = (
        F.when(F.col("cliente_id").isNull(), "sin_id")
        .when((F.length("cliente_id") > params.largo_mapeo) & F.lit(mapeo is None), "id_largo")
        .when(F.col("_mapeado").isNull(), "sin_mapeo")
        .when((F.col("_limpio") == "") & F.lit(mapeo is None), "sin_id_limpio")
        .when(F.col("_limpio") == params.cliente_prueba, "cliente_prueba")
        .when(F.col("_valido").isNull(), "producto_excluido")
        .otherwise("elegible")
    )
    return marcadas.groupBy(regla.alias("regla")).agg(F.count(F.lit(1)).alias("lineas"))


def _marcadas(filas: DataFrame, lista: DataFrame, clave: str, marca: str, repartir_por: str) -> DataFrame:
    """All rows, with the columns of the list and ``marca`` where it holds their key.

    A list of few counted rows is broadcast and the rows stay where they are; a bigger one
    is met on key and salt.
    """
    lista = lista.withColumnRenamed(clave, "_clave").withColumn(marca, F.lit(True))
    lista, cabe = medida(lista, "lista-marcas")
    if cabe:
        return filas.join(F.broadcast(lista), F.col(clave) == F.col("_clave"), "left").drop("_clave")
    lista = lista.withColumn("_sal_lista", F.explode(F.sequence(F.lit(0), F.lit(SALES_DE_CLAVE - 1))))
    filas = filas.withColumn("_sal", F.pmod(F.hash(repartir_por), F.lit(SALES_DE_CLAVE)))
    igual = (F.col(clave) == F.col("_clave")) & (F.col("_sal") == F.col("_sal_lista"))
    return filas.join(sin_difundir(lista), igual, "left").drop("_clave", "_sal", "_sal_lista")


def en_ventana(ventas: DataFrame, inicio: dt.date, fin: dt.date) -> DataFrame:
    """``[inicio, fin)`` as literals, so that the filter reaches the scan."""
    return ventas.where((F.col("fecha_venta") >= F.lit(inicio)) & (F.col("fecha_venta") < F.lit(fin)))


def en_meses(ventas: DataFrame, meses: Collection[int]) -> DataFrame:
    """Lines of some months (``YYYYMM``), as ranges of days that reach the scan."""
    rangos: list[list[int]] = []
    for n in sorted(m // 100 * 12 + m % 100 - 1 for m in meses):
        if rangos and rangos[-1][1] == n:
            rangos[-1][1] += 1
        else:
            rangos.append([n, n + 1])
    dia = F.col("fecha_venta")
    dentro = F.lit(False)
    for a, b in rangos:
        dentro |= (dia >= F.lit(dt.date(a // 12, a % 12 + 1, 1))) & (dia < F.lit(dt.date(b // 12, b % 12 + 1, 1)))
    return ventas.where(dentro)


def int_ventas_12m(elegibles: DataFrame, params: Params) -> DataFrame:
    return en_ventana(elegibles, params.inicio_ventana(params.ventana_meses_12m), params.corte)


def lineas_36m(elegibles: DataFrame, params: Params, desde: dt.date | None = None) -> DataFrame:
    """Lines of the long window under the columns of :func:`fct_ventas_36m`.

    ``desde`` (a first of month) restricts them to the later months.
    """
    inicio = params.inicio_ventana(params.meses_ventana_canibalizacion)
    if desde is not None:
        inicio = max(inicio, desde)
    return en_ventana(elegibles, inicio, params.corte).select(
        "cliente_id_limpio",
        "producto_id",
        "pdv_id",
        F.year("fecha_venta").alias("anio"),
        F.month("fecha_venta").alias("mes"),
        F.col("venta_gs").alias("total_ventas"),
    )


def fct_ventas_36m(elegibles: DataFrame, params: Params, desde: dt.date | None = None) -> DataFrame:
    """Monthly sales by customer, product and point of sale over the long window."""
    return (
        lineas_36m(elegibles, params, desde)
        .groupBy("cliente_id_limpio", "producto_id", "pdv_id", "anio", "mes")
        .agg(F.sum(exacto("total_ventas")).cast("double").alias("total_ventas"))
    )

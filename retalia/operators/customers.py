"""Customer identity: raw id to clean id, and one row per clean id."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retalia.functions import ids


def int_clientes_normalizados(clientes: DataFrame) -> DataFrame:
    """Cleaned id, document and name of every raw customer (narrow)."""
    return clientes.select(
        "cliente_id",
        ids.cliente_id_clean(F.col("cliente_id")).alias("cliente_id_clean"),
        ids.cliente_id_limpio(F.col("cliente_id")).alias("cliente_id_limpio"),
        ids.limpiar_id(F.coalesce(F.col("ci_ruc"), F.lit(""))).alias("ci_ruc_clean"),
        ids.nombre_limpio(F.col("nombre")).alias("nombre_limpio"),
        "celular",
        "mail",
    )


def ids_huerfanos(ventas: DataFrame, normalizados: DataFrame) -> DataFrame:
    """Distinct ids that were sold to but are no registered customer."""
    return ventas.select("cliente_id").distinct().join(
        normalizados.select("cliente_id"), "cliente_id", "left_anti"
    )


def int_clientes_mapeo_limpio(
    normalizados: DataFrame, ventas: DataFrame, desde: dt.date | None = None
) -> DataFrame:
    """Raw id to clean id, for registered customers and for ids known from sales only.

    The clean id is a function of the raw id alone, so an id that comes from both
    sides carries the same value twice and the minimum per id is the mapping: one
    grouping on the raw id, combined before the shuffle, stands in for distinct, anti
    join, union and grouping.  Sale ids are cleaned once per id, after that grouping.

    ``desde`` limits the sales that are looked at (incremental run).  Ids without
    digits are left out.
    """
    if desde is not None:
        ventas = ventas.where(F.col("fecha_venta") >= F.lit(desde))
    vistos = normalizados.select("cliente_id", "cliente_id_limpio").unionByName(
        ventas.select("cliente_id"), allowMissingColumns=True
    )
    return (
        vistos.groupBy("cliente_id")
        .agg(F.min("cliente_id_limpio").alias("registrado"))
        .select(
            "cliente_id",
            F.coalesce("registrado", ids.cliente_id_limpio(F.col("cliente_id"))).alias("cliente_id_limpio"),
        )
        .where(F.col("cliente_id_limpio").isNotNull())
    )


def int_clientes_limpio(normalizados: DataFrame) -> DataFrame:
    """One row per clean id."""
    return (
        normalizados.where(F.col("cliente_id_limpio").isNotNull())
        .groupBy("cliente_id_limpio")
        .agg(
            F.max("nombre_limpio").alias("nombre"),
            F.min("ci_ruc_clean").alias("ci_ruc"),
            F.max("celular").alias("celular"),
            F.max("mail").alias("mail"),
        )
    )

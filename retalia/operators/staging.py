"""Typed one-to-one views of the source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retalia.functions.text import sin_caso_ni_acento


def _texto(nombre: str, largo: int) -> Column:
    """Text of at most ``largo`` characters; a plain cast would not cut it."""
    return F.substring(F.col(nombre).cast("string"), 1, largo).alias(nombre)


def _id(nombre: str, largo: int) -> Column:
    """An id used as join key; trailing blanks never tell two ids apart."""
    return F.rtrim(F.substring(F.col(nombre).cast("string"), 1, largo)).alias(nombre)


def stg_ventas(ventas: DataFrame) -> DataFrame:
    """Sale lines with a customer."""
    return ventas.where(F.col("cliente_id").isNotNull()).select(
        _id("cliente_id", 255),
        _id("producto_id", 100),
        _id("pdv_id", 255),
        "fecha_venta",
        "venta_gs",
        "unidades",
        "timbrado",
        "factura_nro",
    )


def stg_clientes(clientes: DataFrame) -> DataFrame:
    return clientes.where(F.col("cliente_id").isNotNull()).select(
        _id("cliente_id", 255),
        _texto("ci_ruc", 255),
        _texto("nombre", 255),
        _texto("celular", 50),
        _texto("mail", 255),
    )


def stg_productos(productos: DataFrame) -> DataFrame:
    """Products; both leading categories compare without case and accents."""
    return productos.select(
        _id("producto_id", 100),
        "id_empresa",
        sin_caso_ni_acento(F.col("categoria_1")).alias("categoria_1"),
        sin_caso_ni_acento(F.col("categoria_2")).alias("categoria_2"),
        "categoria_3",
        "categoria_4",
        "categoria_5",
        F.col("nonbre").alias("nombre"),
        "marca",
        "unidad_medida",
    )


def stg_clientes_mapeo(mapeo: DataFrame) -> DataFrame:
    return mapeo.select(_texto("cliente_id", 50), _texto("cliente_id_limpio", 50))


def stg_clientes_limpio(limpio: DataFrame) -> DataFrame:
    return limpio.select("cliente_id_limpio", "nombre")

"""Declared schemas of the source tables and the contracts of the staging layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_TIPOS = {
    "string": T.StringType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
}


def _tabla(columnas: str) -> T.StructType:
    """Schema from "name type, ..." (usable before a session exists)."""
    pares = (c.split() for c in columnas.split(", "))
    return T.StructType([T.StructField(nombre, _TIPOS[tipo]) for nombre, tipo in pares])


# Column names and types of the source tables.
VENTAS = _tabla(
    "cliente_id string, producto_id string, pdv_id string, fecha_venta date, "
    "venta_gs double, unidades double, timbrado string, factura_nro string"
)
CLIENTES = _tabla("cliente_id string, ci_ruc string, nombre string, celular string, mail string")
PRODUCTOS = _tabla(
    "producto_id string, id_empresa bigint, categoria_1 string, categoria_2 string, "
    "categoria_3 string, categoria_4 string, categoria_5 string, nonbre string, "
    "marca string, unidad_medida string"
)
CLIENTES_MAPEO = _tabla("cliente_id string, cliente_id_limpio string")
SUCURSALES = _tabla("pdv_id string, sucursal_codigo string, sucursal_nombre string")
PRODUCTOS_EXCLUIDOS = _tabla("producto_id string")

# Contracts of the staging layer.
STG_VENTAS = VENTAS
STG_PRODUCTOS = T.StructType(
    [T.StructField("nombre" if f.name == "nonbre" else f.name, f.dataType) for f in PRODUCTOS]
)


def leer_parquet(spark: SparkSession, ruta: str, esquema: T.StructType) -> DataFrame:
    """Read a source table under its declared schema (no inference)."""
    return spark.read.schema(esquema).parquet(ruta)


def leer_csv(spark: SparkSession, ruta: str, esquema: T.StructType) -> DataFrame:
    """Read a reference-data CSV under its declared schema (no inference)."""
    return spark.read.schema(esquema).option("header", True).csv(ruta)

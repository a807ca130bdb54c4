"""Derives the retail source tables from a star schema of orders.

``lineitem``/``orders`` give the sales fact, ``customer`` the customers, ``part`` the
products.  Ids are written in the untidy ways that the cleaning rules are made for:
two keys share one document number, with and without check digit, with stray symbols
and letters, and some hold a name only.  Every row of every table is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns read from each table, with their types: nothing is inferred from files.
_LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_returnflag string"
)
_ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"
_CUSTOMER = "c_custkey bigint, c_name string"
_PART = "p_partkey bigint, p_name string, p_brand string, p_type string"


def _documento(clave: str) -> str:
    return f"cast(100000 + {clave} - {clave} % 2 AS string)"


def _id_crudo(clave: str) -> str:
    doc = _documento(clave)
    return f"""
        CASE WHEN {clave} % 97 = 0 THEN 'SIN NOMBRE'
             ELSE CASE {clave} % 8
                  WHEN 0 THEN concat({doc}, '-', {clave} % 10)
                  WHEN 1 THEN concat('|', {doc})
                  WHEN 2 THEN concat({doc}, ',', {clave} % 10)
                  WHEN 3 THEN concat('CI ', {doc})
                  WHEN 4 THEN concat({doc}, '*7')
                  ELSE {doc} END
        END"""


def _producto_id(clave: str) -> str:
    return f"concat({clave}, IF({clave} % 50 = 0, '-G', ''))"


def ventas(spark: SparkSession, carpeta: str) -> DataFrame:
    lineas = spark.read.schema(_LINEITEM).parquet(f"{carpeta}/lineitem.parquet")
    pedidos = spark.read.schema(_ORDERS).parquet(f"{carpeta}/orders.parquet")
    signo = "IF(l_returnflag = 'R' AND l_linenumber = 7, -1D, 1D)"
    return lineas.join(pedidos, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        f"{_id_crudo('o_custkey')} AS cliente_id",
        f"{_producto_id('l_partkey')} AS producto_id",
        """CASE WHEN l_suppkey % 10 < 1 THEN '4'
                WHEN o_custkey % 3 = 0 THEN '3'
                WHEN (o_custkey + o_orderkey) % 5 < 3 THEN '5'
                ELSE '6' END AS pdv_id""",
        "cast(o_orderdate AS date) AS fecha_venta",
        f"{signo} * l_extendedprice * (1 - l_discount) AS venta_gs",
        f"{signo} * l_quantity AS unidades",
        "IF(l_orderkey % 101 = 0, NULL, cast(10000000 + l_orderkey % 7 AS string)) AS timbrado",
        "cast(l_orderkey AS string) AS factura_nro",
    )


def ventas_texto(spark: SparkSession, carpeta: str) -> DataFrame:
    """The sales as a text export delivers them: some dates, amounts and units in no known form, some ids missing."""
    n = "cast(factura_nro AS bigint)"
    return ventas(spark, carpeta).selectExpr(
        f"IF({n} % 103 = 0, NULL, cliente_id) AS cliente_id",
        f"IF({n} % 211 = 0, NULL, producto_id) AS producto_id",
        "pdv_id",
        f"IF({n} % 89 = 0, date_format(fecha_venta, 'dd/MM/yyyy'), cast(fecha_venta AS string)) AS fecha_venta",
        f"IF({n} % 97 = 0, concat(cast(cast(unidades AS int) AS string), ',50'), cast(venta_gs AS string)) AS venta_gs",
        f"CASE WHEN {n} % 101 = 0 THEN 'n/a' WHEN {n} % 107 = 0 THEN '' ELSE cast(unidades AS string) END AS unidades",
        "timbrado",
        "factura_nro",
    )


def clientes(spark: SparkSession, carpeta: str) -> DataFrame:
    """Customers; one in eleven is registered under another id than it buys with."""
    return spark.read.schema(_CUSTOMER).parquet(f"{carpeta}/customer.parquet").selectExpr(
        f"""CASE WHEN c_custkey % 97 <> 0 AND c_custkey % 11 = 0 THEN cast(900000 + c_custkey AS string)
                 ELSE {_id_crudo('c_custkey')} END AS cliente_id""",
        f"IF(c_custkey % 5 = 0, NULL, {_documento('c_custkey')}) AS ci_ruc",
        "c_name AS nombre",
        "concat('09', c_custkey) AS celular",
        "concat('c', c_custkey, '@x.py') AS mail",
    )


def productos(spark: SparkSession, carpeta: str) -> DataFrame:
    return spark.read.schema(_PART).parquet(f"{carpeta}/part.parquet").selectExpr(
        f"{_producto_id('p_partkey')} AS producto_id",
        "cast(IF(p_partkey % 20 = 1, 1, 3) AS bigint) AS id_empresa",
        """CASE WHEN p_partkey % 37 = 0 THEN 'EGRESOS'
                WHEN p_partkey % 41 = 0 THEN 'Servicios'
                ELSE p_type END AS categoria_1""",
        """CASE WHEN p_partkey % 43 = 0 THEN 'BÓLSA reutilizable'
                WHEN p_partkey % 11 <> 0 THEN p_name END AS categoria_2""",
        "cast(NULL AS string) AS categoria_3",
        "cast(NULL AS string) AS categoria_4",
        "cast(NULL AS string) AS categoria_5",
        "p_name AS nonbre",
        "p_brand AS marca",
        "cast(NULL AS string) AS unidad_medida",
    )


def clientes_mapeo_previo(spark: SparkSession, carpeta: str) -> DataFrame:
    """An older customer mapping to compare with.

    It splits on the hyphen only, keeps stray symbols and falls back on the raw id,
    and knows registered customers only.
    """
    letras = F.translate(F.upper("cliente_id"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ ", "")
    previo = F.coalesce(F.nullif(F.substring_index(letras, "-", 1), F.lit("")), F.col("cliente_id"))
    return clientes(spark, carpeta).groupBy("cliente_id").agg(F.min(previo).alias("cliente_id_limpio"))

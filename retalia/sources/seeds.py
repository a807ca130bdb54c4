"""Reference data shipped with the package.

They are VALUES relations, so that Catalyst knows their exact size and broadcasts
them by its own size rule; other values come from ``schemas.leer_csv``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Branch of each point of sale.
SUCURSALES = [
    ("3", "SL", "San Lorenzo"),
    ("5", "R1", "Ruta 1"),
    ("6", "R2", "Ruta 2"),
]

# Test and placeholder products left out of every analysis.
PRODUCTOS_EXCLUIDOS = [
    "442",
    "999994",
    "31852",
    "999992",
    "90311",
    "999998",
    "901762",
    "9809999",
    "51457",
    "77190",
    "8925",
    "91988",
    "999995",
]


def sucursales(spark: SparkSession) -> DataFrame:
    filas = ", ".join(f"('{p}', '{c}', '{n}')" for p, c, n in SUCURSALES)
    return spark.sql(f"SELECT * FROM VALUES {filas} AS t(pdv_id, sucursal_codigo, sucursal_nombre)")


def productos_excluidos(spark: SparkSession) -> DataFrame:
    filas = ", ".join(f"('{p}')" for p in PRODUCTOS_EXCLUIDOS)
    return spark.sql(f"SELECT * FROM VALUES {filas} AS t(producto_id)")

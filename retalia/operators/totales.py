"""Sums of several scopes in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retalia.functions.numbers import exacto

# Which of (point of sale, product) is summed over, as the bits of ``grouping_id``.
NIVELES = {0: "pdv_producto", 1: "pdv", 2: "producto", 3: "total"}


def ventas_por_nivel(elegibles: DataFrame) -> DataFrame:
    """Sales by point of sale and product, by either of them, and in total.

    ``nivel`` tells a sum over all points of sale from the lines that have none.  Lines are
    combined to (point of sale, product) before they are repeated for the grouping sets, so
    the fact is read and shuffled once, whatever the number of sets.  Without lines there is
    no row, not even the total.
    """
    base = elegibles.groupBy("pdv_id", "producto_id").agg(
        F.count(F.lit(1)).alias("lineas"),
        F.sum(exacto("unidades")).alias("unidades"),
        F.sum(exacto("venta_gs")).alias("venta_gs"),
    )
    pdv, producto = F.col("pdv_id"), F.col("producto_id")
    sumas = base.groupingSets([[pdv, producto], [pdv], [producto], []], pdv, producto).agg(
        F.grouping_id().alias("_nivel"),
        F.sum("lineas").alias("lineas"),
        F.sum("unidades").cast("double").alias("unidades"),
        F.sum("venta_gs").cast("double").alias("venta_gs"),
    )
    nombre = F.element_at(F.create_map(*[F.lit(x) for par in NIVELES.items() for x in par]), F.col("_nivel").cast("int"))
    return sumas.select(nombre.alias("nivel"), "pdv_id", "producto_id", "lineas", "unidades", "venta_gs")

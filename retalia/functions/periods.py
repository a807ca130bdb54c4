"""Month arithmetic on dates and on ``YYYYMM`` integers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIAS_POR_MASCARA = 62  # two months of 31 days in one long
_MESES_POR_MASCARA = 2


def fecha_corte_mes_cerrado(col: Column) -> Column:
    """First day of the month: exclusive end of a closed-month window."""
    return F.trunc(col, "MM")


def periodo(anio: Column, mes: Column) -> Column:
    return (anio * 100 + mes).cast("int")


def mes_absoluto(p: Column) -> Column:
    """Months since year 0 of a ``YYYYMM`` integer."""
    return (F.floor(p / 100) * 12 + p % 100).cast("int")


def meses_entre_periodos(reciente: Column, antiguo: Column) -> Column:
    """Months from ``antiguo`` to ``reciente``, both ``YYYYMM``."""
    return mes_absoluto(reciente) - mes_absoluto(antiguo)


# -- distinct days of a bounded window as bit masks ---------------------------------
#
# "How many different days" is needed next to sums and ticket counts, per product and
# per customer.  COUNT(DISTINCT) would expand every row once more and shuffle it; a
# calendar window of n months has at most 31n days, so the set of days of a group fits
# in n/2 longs, which partial aggregation ORs together like any other sum.


def marca_dia(fecha: Column, inicio: dt.date) -> list[Column]:
    """Columns ``_mascara`` (which long) and ``_bit`` (the bit in it) of a day."""
    mes = F.year(fecha) * 12 + F.month(fecha) - (inicio.year * 12 + inicio.month)
    posicion = (mes % _MESES_POR_MASCARA) * (_DIAS_POR_MASCARA // 2) + F.dayofmonth(fecha) - 1
    return [
        F.floor(mes / _MESES_POR_MASCARA).cast("int").alias("_mascara"),
        F.call_function("shiftleft", F.lit(1).cast("long"), posicion).alias("_bit"),
    ]


def n_mascaras(meses: int) -> int:
    return -(-meses // _MESES_POR_MASCARA)


def mascaras_dias(meses: int) -> list[Column]:
    """Aggregates ``dias_0 .. dias_k`` over :func:`marca_dia`: the set of days seen."""
    return [
        F.bit_or(F.when(F.col("_mascara") == k, F.col("_bit")).otherwise(F.lit(0).cast("long"))).alias(
            f"dias_{k}"
        )
        for k in range(n_mascaras(meses))
    ]


def unir_mascaras(meses: int) -> list[Column]:
    """Aggregates that merge masks already built."""
    return [F.bit_or(f"dias_{k}").alias(f"dias_{k}") for k in range(n_mascaras(meses))]


def contar_dias(meses: int) -> Column:
    """Number of days in the masks of a row."""
    total = F.bit_count(F.col("dias_0"))
    for k in range(1, n_mascaras(meses)):
        total = total + F.bit_count(F.col(f"dias_{k}"))
    return total.cast("long")

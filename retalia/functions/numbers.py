"""Order-independent sums and score normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts are doubles at the source.  A double sum depends on the order in which the
# shuffle delivers rows, and the result decides comparisons with a percentile that is
# itself a data point.  Four decimals are summed exactly instead.
EXACTO = "decimal(18,4)"

# Logarithms differ in their last bits between machines.  Norms are cut to 8 decimals of
# a 0..100 scale; a sum of norms times two-decimal weights then has 10 exact decimals,
# so scores and their ties come out the same everywhere.
DECIMALES_NORMA = 8
DECIMALES_PUNTAJE = 10


def exacto(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(EXACTO)


def log_desde_minimo(valor: Column, minimo: Column) -> Column:
    """ln(1 + x - min): 0 for the smallest value of the scope."""
    return F.log(F.lit(1.0) + valor - minimo)


def normalizar_desde_log(log: Column, minimo: Column, maximo: Column) -> Column:
    """Min-max of logarithms to 0..100; a scope without spread gets 100."""
    escala = (log - minimo) * F.lit(100.0) / F.nullif(maximo - minimo, F.lit(0.0))
    return F.when(maximo == minimo, F.lit(100.0)).otherwise(F.round(escala, DECIMALES_NORMA))


def razon(numerador: Column, denominador: Column) -> Column:
    """Double ratio, 0 when there is nothing to divide by."""
    return F.when(denominador == 0, F.lit(0.0)).otherwise(
        numerador.cast("double") / F.nullif(denominador.cast("double"), F.lit(0.0))
    )

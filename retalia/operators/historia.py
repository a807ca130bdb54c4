"""Reading a history as of a date, and the last row of one table before each row of another.

Both meet rows by key *and* calendar month, so that a customer with a third of all rows is
spread over its months instead of one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retalia.operators.skew import SALES_DE_CLAVE, medida, sin_difundir


def _mes(momento: Column) -> Column:
    return (F.year(momento) * 12 + F.month(momento)).cast("int")


def en_fecha(
    hechos: DataFrame, historia: DataFrame, claves: list[str], momento: str, columnas: list[str]
) -> DataFrame:
    """Rows of ``hechos`` with ``columnas`` of the version of their key that was valid at ``momento``.

    ``historia`` has versions from ``dbt_valid_from`` (inclusive) to ``dbt_valid_to``
    (exclusive, NULL while open).  A row without such a version, without key or without a
    moment gets NULLs; every row is kept once, since the versions of a key do not overlap.

    An interval join: each version of a key that a fact has is repeated for the months it
    covers, as far as there are facts, and met on key and month; only then the moments are compared.  Few versions are
    broadcast, more are met on a salt too.
    """
    limites = hechos.agg(F.struct(F.min(_mes(F.col(momento))).alias("a"), F.max(_mes(F.col(momento))).alias("b")))
    limites = limites.scalar()  # one row, run once
    desde = F.greatest(_mes(F.col("dbt_valid_from")), limites.getField("a"))
    hasta = F.least(F.coalesce(_mes(F.col("dbt_valid_to")), limites.getField("b")), limites.getField("b"))
    versiones = historia.select(
        *[F.col(c).alias(f"_k_{c}") for c in claves],
        F.col("dbt_valid_from").alias("_desde"),
        F.col("dbt_valid_to").alias("_hasta"),
        F.struct(*columnas).alias("_version"),
        desde.alias("_a"),
        hasta.alias("_b"),
    ).where(F.col("_a") <= F.col("_b"))
    pedidas = hechos.select(*[F.col(c).alias(f"_k_{c}") for c in claves]).distinct()
    versiones = versiones.join(sin_difundir(pedidas), pedidas.columns, "left_semi")
    versiones = versiones.withColumn("_mes_v", F.explode(F.sequence("_a", "_b"))).drop("_a", "_b")
    versiones, cabe = medida(versiones, "versiones-por-mes")

    filas = hechos.withColumn("_mes", _mes(F.col(momento)))
    iguales = [F.col(c) == F.col(f"_k_{c}") for c in claves] + [F.col("_mes") == F.col("_mes_v")]
    if not cabe:
        sales = F.explode(F.sequence(F.lit(0), F.lit(SALES_DE_CLAVE - 1)))
        versiones = versiones.select("*", sales.alias("_sal_v"))
        filas = filas.withColumn("_sal", F.pmod(F.hash(*hechos.columns), F.lit(SALES_DE_CLAVE)))
        iguales.append(F.col("_sal") == F.col("_sal_v"))
    t = F.col(momento)
    valida = (F.col("_desde") <= t) & (F.col("_hasta").isNull() | (t < F.col("_hasta")))
    versiones = F.broadcast(versiones) if cabe else sin_difundir(versiones)
    unidas = filas.join(versiones, reduce(lambda a, b: a & b, [*iguales, valida]), "left")
    return unidas.select(*hechos.columns, *[F.col(f"_version.{c}").alias(c) for c in columnas])


def ultimo_antes(
    hechos: DataFrame,
    serie: DataFrame,
    claves: list[str],
    momento: str,
    momento_serie: str,
    valores: list[str],
    inclusive: bool = False,
) -> DataFrame:
    """Rows of ``hechos`` with the last row of ``serie`` of their key before ``momento``.

    Adds ``momento_serie`` and ``valores``, NULL where there is none.  ``inclusive`` counts
    rows at the same moment as before it.  Of several rows of the series at one moment the
    one with the largest values counts.  Rows of the series without a moment are left out, a
    fact without a moment has no last row; NULL keys match each other.

    Union, sort, last value: inside a key and month the last value is a running window over
    both tables.  What a month inherits is the last value of the months before, a window
    over one row for each key and month.
    """
    v = F.struct(momento_serie, *valores)
    vacia = F.lit(None).cast(serie.select(v.alias("v")).schema["v"].dataType)
    despues = 0 if inclusive else 2  # where the series stands beside facts of the same moment
    de_hechos = hechos.select(
        *[F.col(c).alias(f"_k_{c}") for c in claves],
        F.struct(*hechos.columns).alias("_hecho"),
        vacia.alias("_v"),
        F.col(momento).alias("_t"),
        F.lit(1).alias("_orden"),
    )
    de_serie = serie.where(F.col(momento_serie).isNotNull()).select(
        *[F.col(c).alias(f"_k_{c}") for c in claves],
        F.lit(None).cast(de_hechos.schema["_hecho"].dataType).alias("_hecho"),
        v.alias("_v"),
        F.col(momento_serie).alias("_t"),
        F.lit(despues).alias("_orden"),
    )
    llaves = [f"_k_{c}" for c in claves]
    ambas = de_hechos.unionByName(de_serie).withColumn("_mes", _mes(F.col("_t")))

    # What each month of a key inherits.  Facts give months of their own, so that each finds its row.
    por_mes = ambas.groupBy(*llaves, "_mes").agg(F.max("_v").alias("_ultimo"))
    antes = Window.partitionBy(*llaves).orderBy("_mes").rowsBetween(Window.unboundedPreceding, -1)
    heredado = por_mes.select(
        *[F.col(k).alias(f"_h{k}") for k in llaves],
        F.col("_mes").alias("_mes_h"),
        F.last("_ultimo", ignorenulls=True).over(antes).alias("_heredado"),
    )
    en_mes = Window.partitionBy(*llaves, "_mes").orderBy("_t", "_orden", "_v")
    en_mes = en_mes.rowsBetween(Window.unboundedPreceding, 0)
    con_propio = ambas.withColumn("_propio", F.last("_v", ignorenulls=True).over(en_mes)).where("_hecho IS NOT NULL")
    iguales = [F.col(k).eqNullSafe(F.col(f"_h{k}")) for k in llaves] + [F.col("_mes").eqNullSafe(F.col("_mes_h"))]
    unidas = con_propio.join(heredado, reduce(lambda a, b: a & b, iguales), "left")
    hallado = F.when(F.col("_t").isNotNull(), F.coalesce("_propio", "_heredado"))
    return unidas.withColumn("_hallado", hallado).select(
        *[F.col(f"_hecho.{c}").alias(c) for c in hechos.columns],
        *[F.col(f"_hallado.{c}").alias(c) for c in (momento_serie, *valores)],
    )

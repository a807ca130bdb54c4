"""Joins and statistics on keys of which one may hold a third of the rows.

A scope such as ``GLOBAL``, or a best-selling product, must not end up in one task.
Windows over such a key and joins that are hashed on it alone do exactly that, so
statistics are aggregated (with partial aggregation) and brought back by a join.  The
small side of a join is written and its rows are counted: up to ``FILAS_DIFUNDIBLES``
of them are broadcast, more are met on key *and* salt.  What is not broadcast by count is
never broadcast by estimate either: Spark estimates a list from its compressed file and
does not see the copies for the salts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retalia.sources.workspace import asentar

SALES_DE_GRUPO = 64  # salts per group of statistics beyond the broadcast limit
SALES_DE_CLAVE = 16  # copies of a list of keys beyond it; AQE splits further by measured size
FILAS_DIFUNDIBLES = 200_000  # counted rows of a few short columns: some 10 MB


def medida(df: DataFrame, nombre: str, escribir: bool = True) -> tuple[DataFrame, bool]:
    """``df`` written once, and whether its counted rows are few enough to broadcast.

    A list that is written already, or made of literals, is only counted.
    """
    escrita = asentar(df, nombre) if escribir else df
    return escrita, escrita.count() <= FILAS_DIFUNDIBLES


def sin_difundir(lista: DataFrame) -> DataFrame:
    """``lista`` as a side of a join that is sorted and merged, whatever its file suggests.

    A million short ids take 5 MB in a file and, once for every salt, gigabytes on the driver.
    """
    return lista.hint("merge")


def join_repartido(
    filas: DataFrame,
    lista: DataFrame,
    clave: str,
    repartir_por: list[str],
    como: str = "inner",
    escribir: bool = True,
) -> DataFrame:
    """Join rows with a list of keys: ``inner`` or ``left_semi``.

    A list of few rows is broadcast (no shuffle of the rows).  A bigger one is repeated
    for every salt and met on key and salt: a hot key spreads over ``SALES_DE_CLAVE``
    partitions, each of which AQE may split, and a grouping by the key behind the join
    cannot take over the join's partitioning.  Without ``escribir`` the list is one that is
    cheap to read again: a stored table, or literals.
    """
    lista, cabe = medida(lista, "lista-claves", escribir)
    if cabe:
        return filas.join(F.broadcast(lista), clave, como)
    sales = F.explode(F.sequence(F.lit(0), F.lit(SALES_DE_CLAVE - 1)))
    sal = F.pmod(F.hash(*repartir_por), F.lit(SALES_DE_CLAVE))
    return (
        filas.withColumn("_sal", sal)
        .join(sin_difundir(lista.select("*", sales.alias("_sal"))), [clave, "_sal"], como)
        .drop("_sal")
    )


def adjuntar_por_grupo(
    filas: DataFrame, stats: DataFrame, grupo: list[str], repartir_por: str
) -> DataFrame:
    """Add the columns of ``stats`` (one row per group) to every row of its group.

    Group columns match null-safe.  Few statistics are broadcast, so the rows stay where
    they are.  Of many, each row is repeated for ``SALES_DE_GRUPO`` salts, and the rows
    of a group spread over them by the hash of ``repartir_por``.
    """
    if not grupo:  # an aggregate without keys has one row: a scalar subquery, run once
        unica = stats.select(F.struct(*stats.columns)).scalar()
        return filas.select("*", *[unica.getField(c).alias(c) for c in stats.columns])
    stats, cabe = medida(stats, "estadisticas")
    copias = stats.select(
        *[F.col(g).alias(f"_g_{g}") for g in grupo], *[c for c in stats.columns if c not in grupo]
    )
    if cabe:
        iguales = [filas[g].eqNullSafe(copias[f"_g_{g}"]) for g in grupo]
        unidas = filas.join(F.broadcast(copias), reduce(lambda a, b: a & b, iguales))
        return unidas.drop(*[f"_g_{g}" for g in grupo])
    copias = copias.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALES_DE_GRUPO - 1))).alias("_sal_stats"))
    saladas = filas.withColumn("_sal", F.pmod(F.hash(repartir_por), F.lit(SALES_DE_GRUPO)))
    iguales = [saladas[g].eqNullSafe(copias[f"_g_{g}"]) for g in grupo]
    condicion = reduce(lambda a, b: a & b, iguales, saladas["_sal"] == copias["_sal_stats"])
    return saladas.join(sin_difundir(copias), condicion).drop("_sal", "_sal_stats", *[f"_g_{g}" for g in grupo])


def percentiles_exactos(
    df: DataFrame, grupo: list[str], valor: str, cuantiles: dict[str, float]
) -> DataFrame:
    """Exact interpolated percentiles per group, without gathering a group; one way for all sizes.

    1. values are reduced to distinct values with counts (partial aggregation);
    2. these are range-partitioned by group and value, and written with their part;
    3. the parts' totals, a row for each group in each part, say which part of a group
       holds each wanted rank;
    4. a running count inside those parts finds the order statistics, which are
       interpolated linearly.

    NULLs are ignored; a group of NULLs only gets no row.
    """
    filas = df.select(*grupo, F.col(valor).alias("_v")).where(F.col("_v").isNotNull())
    distintos = filas.groupBy(*grupo, "_v").agg(F.count("_v").alias("_c"))
    por_rango = distintos.repartitionByRange(*grupo, "_v").withColumn("_parte", F.spark_partition_id())
    por_rango = asentar(por_rango, "percentiles-valores")

    del_grupo = Window.partitionBy(*(grupo or [F.lit(0)]))
    antes = del_grupo.orderBy("_parte").rowsBetween(Window.unboundedPreceding, -1)
    partes = (
        por_rango.groupBy(*grupo, "_parte")
        .agg(F.sum("_c").alias("_t"))
        .withColumn("_antes", F.coalesce(F.sum("_t").over(antes), F.lit(0)))
        .withColumn("_n", F.sum("_t").over(del_grupo))
    )

    def rangos(n: str) -> tuple[Column, Column]:
        posicion = F.lit(cuantiles[n]) * (F.col("_n") - 1)
        return F.floor(posicion), F.ceil(posicion)

    buscados = [r for n in cuantiles for r in rangos(n)]
    tiene = [(r >= F.col("_antes")) & (r < F.col("_antes") + F.col("_t")) for r in buscados]
    con_rango = partes.where(reduce(lambda a, b: a | b, tiene)).drop("_t")
    con_rango, cabe = medida(
        con_rango.select(*[F.col(g).alias(f"_g_{g}") for g in grupo], F.col("_parte").alias("_p"), "_antes", "_n"),
        "percentiles-partes",
    )
    iguales = [por_rango[g].eqNullSafe(con_rango[f"_g_{g}"]) for g in grupo]
    condicion = reduce(lambda a, b: a & b, iguales, por_rango["_parte"] == con_rango["_p"])
    dentro = por_rango.join(F.broadcast(con_rango) if cabe else sin_difundir(con_rango), condicion)
    hasta_aqui = Window.partitionBy(*grupo, "_parte").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    contadas = dentro.withColumn("_acum", F.col("_antes") + F.sum("_c").over(hasta_aqui))

    agregados, salida = [], []
    for n in cuantiles:
        abajo, arriba = rangos(n)
        agregados += [
            F.min(F.when(F.col("_acum") > abajo, F.col("_v"))).alias(f"_a_{n}"),
            F.min(F.when(F.col("_acum") > arriba, F.col("_v"))).alias(f"_b_{n}"),
            F.max(F.lit(cuantiles[n]) * (F.col("_n") - 1) - abajo).alias(f"_f_{n}"),
        ]
        a, b = F.col(f"_a_{n}"), F.col(f"_b_{n}")
        salida.append((a + (b - a) * F.col(f"_f_{n}")).alias(n))
    return contadas.groupBy(*grupo).agg(*agregados).select(*grupo, *salida)

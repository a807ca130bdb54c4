"""Publishing: views and tables, incremental refresh, versioned history."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Collection
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalia.functions.periods import periodo
from retalia.operators.sales import en_meses, fct_ventas_36m, lineas_36m
from retalia.params import Params
from retalia.sources.workspace import asentar


# -- view and table ----------------------------------------------------------------


def publicar_vista(df: DataFrame, nombre: str) -> DataFrame:
    """Register the lazy dataset under a name of the session."""
    df.createOrReplaceTempView(nombre)
    return df


def publicar_tabla(
    df: DataFrame, nombre: str, carpeta: str, particion: list[str] | None = None
) -> DataFrame:
    """Write to a fresh path, then point the catalogue view ``nombre`` at it.

    Readers see the old table or the new one, never a half-written one, and a dataset
    may be computed from the table it replaces.  Month-partitioned tables are
    rebalanced first: few files per month, and a big month is split over tasks.
    """
    spark = df.sparkSession
    ruta = f"{carpeta.rstrip('/')}/{nombre}/version-{uuid.uuid4().hex}"
    salida = df.hint("rebalance", *particion) if particion else df
    salida.write.mode("errorifexists").partitionBy(*(particion or [])).parquet(ruta)
    spark.sql(f"CREATE OR REPLACE VIEW `{nombre}` AS SELECT * FROM parquet.`{ruta}`")
    return spark.table(nombre)


# -- incremental -------------------------------------------------------------------


def incremental_upsert(previo: DataFrame | None, nuevo: DataFrame, claves: list[str]) -> DataFrame:
    """Rows of ``previo`` whose key is not in ``nuevo``, and all of ``nuevo``.

    Without a previous table (first run, or full refresh) the new rows are the table.
    """
    if previo is None:
        return nuevo
    quedan = previo.join(nuevo.select(*claves).distinct(), claves, "left_anti")
    return quedan.unionByName(nuevo)


def refrescar_ventas_36m(previo: DataFrame | None, elegibles: DataFrame, params: Params) -> DataFrame:
    """Monthly sales after an incremental run: equal to a full refresh.

    Months from the look-back on are rebuilt whole; older months come from ``previo``
    as far as they are still in the window.  Months are replaced as such, so a key (or
    a month) that a correction emptied does not survive, and no join is needed.
    """
    if previo is None:
        return fct_ventas_36m(elegibles, params)
    desde = params.inicio_lookback_mes
    inicio = params.inicio_ventana(params.meses_ventana_canibalizacion)
    mes = periodo(F.col("anio"), F.col("mes"))
    intactos = previo.where(
        (mes >= inicio.year * 100 + inicio.month) & (mes < desde.year * 100 + desde.month)
    )
    return intactos.unionByName(fct_ventas_36m(elegibles, params, desde=desde))


# A table published in parts is a view over folders.  Which folders belong to it stands
# in a manifest, a small Parquet table of its own; the view only names the manifest.
_PROPIEDAD = "retalia.manifiesto"
_MANIFIESTO = "orden int, parte string, ruta string, filas long, huella string"
PARTES = 8  # parts a view names at most, beyond that the smallest are merged
VECES = 2  # a part is merged along while it is at most so many times the parts behind it


class Parte(NamedTuple):
    parte: str
    ruta: str
    filas: int | None = None  # rows, where merging goes by them
    huella: str | None = None  # fingerprint of the lines it was made of


def _partes(spark: SparkSession, nombre: str) -> list[Parte]:
    if not spark.catalog.tableExists(nombre):
        return []
    propiedades = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES `{nombre}`").collect()}
    if _PROPIEDAD not in propiedades:
        return []
    filas = spark.read.schema(_MANIFIESTO).parquet(propiedades[_PROPIEDAD]).orderBy("orden").collect()  # a row for each part
    return [Parte(*r[1:]) for r in filas]


def partes_publicadas(spark: SparkSession, nombre: str) -> list[tuple[str, str]]:
    """(part, path) of a table published in parts, oldest first; empty before its first run."""
    return [(p.parte, p.ruta) for p in _partes(spark, nombre)]


def _publicar_partes(spark: SparkSession, nombre: str, carpeta: str, partes: list[Parte], consulta: str) -> DataFrame:
    """Write the manifest, then replace the view: readers see the old parts or the new ones."""
    ruta = f"{carpeta.rstrip('/')}/{nombre}/manifiesto-{uuid.uuid4().hex}"
    filas = [(i, *p) for i, p in enumerate(partes)]
    spark.createDataFrame(filas, _MANIFIESTO).coalesce(1).write.parquet(ruta)
    spark.sql(f"CREATE OR REPLACE VIEW `{nombre}` TBLPROPERTIES ('{_PROPIEDAD}' = '{ruta}') AS {consulta}")
    return spark.table(nombre)


def _contar(spark: SparkSession, ruta: str) -> int:
    return spark.read.parquet(ruta).count()  # from the file footers


def a_fusionar(filas: list[int], partes: int = PARTES, veces: int = VECES) -> int:
    """How many of the newest parts to merge into one, given their rows, oldest first.

    None up to ``partes`` parts.  Beyond it the newest ones are merged, and along with them
    every older part that is at most ``veces`` times as large as what is behind it.  So a
    view never names more than ``partes``, and a row is rewritten about once each time that
    the rows behind it have doubled, not in every run.
    """
    if len(filas) <= partes:
        return 0
    cuantas = len(filas) - partes + 1
    while cuantas < len(filas) and filas[-cuantas - 1] <= veces * sum(filas[-cuantas:]):
        cuantas += 1
    return cuantas


def _version(nombre: str, carpeta: str) -> str:
    return f"{carpeta.rstrip('/')}/{nombre}/version-{uuid.uuid4().hex}"


def _nombres(columnas: list[str]) -> str:
    return ", ".join(f"`{c}`" for c in columnas)


def publicar_meses(
    nuevos: DataFrame,
    nombre: str,
    carpeta: str,
    inicio: dt.date,
    desde: dt.date,
    meses: Collection[int] | None = None,
    huellas: dict[int, str] | None = None,
) -> DataFrame:
    """Replace months of a published table; write nothing else.

    ``nuevos`` holds all rows of the replaced months (columns ``anio`` and ``mes``): those
    from ``desde`` on, or ``meses`` (``YYYYMM``).  They go to a fresh path with one folder
    per month; the catalogue view ``nombre`` is then replaced by one over these folders and
    those of the untouched months not before ``inicio``.  A month that became empty
    disappears with its folder left unlisted.  ``huellas`` are kept with the new months.
    """
    spark = nuevos.sparkSession
    a_mes = inicio.year * 100 + inicio.month, desde.year * 100 + desde.month
    antes = {int(p.parte): p for p in _partes(spark, nombre)}
    quedan = {m: p for m, p in antes.items() if m >= a_mes[0] and (m < a_mes[1] if meses is None else m not in meses)}

    ruta = _version(nombre, carpeta)
    con_periodo = nuevos.withColumn("periodo", periodo(F.col("anio"), F.col("mes")))
    con_periodo.hint("rebalance", "periodo").write.partitionBy("periodo").parquet(ruta)
    escritos = spark.read.schema(con_periodo.schema).parquet(ruta).select("periodo").distinct()
    for r in escritos.collect():  # months only
        quedan[r.periodo] = Parte(str(r.periodo), f"{ruta}/periodo={r.periodo}", None, (huellas or {}).get(r.periodo))

    columnas = _nombres(nuevos.columns)
    partes = [quedan[m] for m in sorted(quedan)]
    vacia = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in nuevos.schema)
    consulta = " UNION ALL ".join(f"SELECT {columnas} FROM parquet.`{p.ruta}`" for p in partes)
    return _publicar_partes(spark, nombre, carpeta, partes, consulta or f"SELECT {vacia} WHERE false")


def publicar_por_clave(
    nuevo: DataFrame, nombre: str, carpeta: str, claves: list[str], completa: bool = False
) -> DataFrame:
    """Incremental run of a keyed table: only rows that are new or differ are written.

    Each run adds a part; a reader takes the row of the latest part of each key.  Beyond
    ``PARTES`` parts the newest are merged (:func:`a_fusionar`): written anew as one, with
    the latest row of each key.  The first run, and one with ``completa``, writes all of
    ``nuevo`` as the only part.
    """
    spark = nuevo.sparkSession
    partes = [] if completa else _partes(spark, nombre)
    if partes:
        actual = spark.table(nombre)
        otras = [c for c in nuevo.columns if c not in claves]
        ya = actual.select(*[F.col(c).alias(f"_{c}") for c in claves], F.struct(*otras).alias("_antes"))
        iguales = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in claves]
        igual = F.struct(*otras).eqNullSafe(F.col("_antes"))
        nuevo = nuevo.join(ya, reduce(lambda a, b: a & b, [*iguales, igual]), "left_anti")
    ruta = _version(nombre, carpeta)
    nuevo.write.parquet(ruta)
    numero = int(partes[-1].parte) + 1 if partes else 0
    partes = [*partes, Parte(f"{numero:06d}", ruta, _contar(spark, ruta))]
    juntas = a_fusionar([_contar(spark, p.ruta) if p.filas is None else p.filas for p in partes])
    if juntas:
        ruta = _version(nombre, carpeta)
        spark.sql(_ultimas(partes[-juntas:], nuevo.columns, claves)).write.parquet(ruta)
        partes = [*partes[:-juntas], Parte(partes[-1].parte, ruta, _contar(spark, ruta))]
    return _publicar_partes(spark, nombre, carpeta, partes, _ultimas(partes, nuevo.columns, claves))


def _ultimas(partes: list[Parte], columnas: list[str], claves: list[str]) -> str:
    """Of each key the row of the latest part that has it."""
    if len(partes) == 1:
        return f"SELECT {_nombres(columnas)} FROM parquet.`{partes[0].ruta}`"
    todas = " UNION ALL ".join(f"SELECT {_nombres(columnas)}, '{p.parte}' AS _parte FROM parquet.`{p.ruta}`" for p in partes)
    ultima = ", ".join(f"max_by(`{c}`, _parte) AS `{c}`" if c not in claves else f"`{c}`" for c in columnas)
    return f"SELECT {ultima} FROM ({todas}) GROUP BY {_nombres(claves)}"


def publicar_mapeo(nuevo: DataFrame, nombre: str, carpeta: str, completa: bool = False) -> DataFrame:
    """Incremental run of the customer mapping (``cliente_id`` to ``cliente_id_limpio``)."""
    return publicar_por_clave(nuevo, nombre, carpeta, ["cliente_id"], completa)


def publicar_ventas_36m(
    elegibles: DataFrame, params: Params, nombre: str, carpeta: str, completa: bool = False
) -> DataFrame:
    """Incremental run of the monthly table: only months of the look-back are written.

    The first run, and one with ``completa``, builds the whole window.
    """
    inicio = params.inicio_ventana(params.meses_ventana_canibalizacion)
    primera = completa or not partes_publicadas(elegibles.sparkSession, nombre)
    desde = inicio if primera else max(inicio, params.inicio_lookback_mes)
    return publicar_meses(
        fct_ventas_36m(elegibles, params, desde=desde), nombre, carpeta, inicio, desde
    )


def huellas_por_mes(lineas: DataFrame) -> DataFrame:
    """``periodo`` and ``huella``: the same for the same lines in any order, repeated ones counted.

    Two independent 64-bit hashes of each line are summed exactly, beside the number of
    lines: one pass with partial sums, a row for each month behind the shuffle.
    """
    columnas = sorted(lineas.columns)
    sumas = [
        F.sum(F.xxhash64(F.lit(semilla), *columnas).cast("decimal(20,0)")).cast("string") for semilla in ("a", "b")
    ]
    return lineas.groupBy(periodo(F.col("anio"), F.col("mes")).alias("periodo")).agg(
        F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sumas).alias("huella")
    )


def publicar_correcciones(elegibles: DataFrame, params: Params, nombre: str, carpeta: str) -> DataFrame:
    """Incremental run of the monthly table that finds the months whose lines differ.

    The lines of the whole window are fingerprinted by month, without shuffling them, and
    compared with the fingerprints kept in the manifest.  Exactly the months that differ are
    rebuilt and written: a correction of any age, a month that is new, one that is gone, one
    that was published without a fingerprint.  Equal to a full build.
    """
    inicio = params.inicio_ventana(params.meses_ventana_canibalizacion)
    antes = {int(p.parte): p.huella for p in _partes(elegibles.sparkSession, nombre)}
    ahora = dict(huellas_por_mes(lineas_36m(elegibles, params)).collect())  # a row for each month
    cambiados = {m for m in antes.keys() | ahora.keys() if antes.get(m) is None or antes.get(m) != ahora.get(m)}
    nuevos = fct_ventas_36m(en_meses(elegibles, cambiados), params)
    return publicar_meses(nuevos, nombre, carpeta, inicio, inicio, cambiados, ahora)


# -- history -----------------------------------------------------------------------

_VERSION = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def _version_id(clave: str, momento: Column) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(F.col(clave).cast("string"), F.lit("")), momento.cast("string")))


def snapshot_scd2(
    actual: DataFrame,
    historia: DataFrame | None,
    clave: str,
    columnas: list[str],
    ahora: dt.datetime,
    cerrar_desaparecidos: bool = False,
) -> DataFrame:
    """Versioned history of ``actual`` (the complete new history).

    A key whose ``columnas`` changed gets a new version and its open one is closed at
    ``ahora``; a key without an open version (also one that comes back) gets a version.
    A key that is gone stays open unless ``cerrar_desaparecidos``.  Closed versions are
    passed through.  Keys are unique among open versions and in ``actual``, so the join
    meets no skew.
    """
    momento = F.lit(ahora.isoformat(sep=" ")).cast("timestamp_ntz")
    datos = actual.columns
    nuevas = {
        "dbt_scd_id": _version_id(clave, momento),
        "dbt_updated_at": momento,
        "dbt_valid_from": momento,
        "dbt_valid_to": F.lit(None).cast("timestamp_ntz"),
    }
    if historia is None:
        return actual.withColumns(nuevas)

    cerradas = historia.where(F.col("dbt_valid_to").isNotNull())
    abiertas = historia.where(F.col("dbt_valid_to").isNull())
    pares = abiertas.select(
        F.struct(*datos, *_VERSION).alias("antes"), F.col(clave).alias("_clave")
    ).join(
        actual.select(F.struct(*datos).alias("hoy"), F.col(clave).alias("_clave")), "_clave", "full_outer"
    )
    cambio = F.lit(False)
    for c in columnas:
        cambio = cambio | ~F.col(f"antes.{c}").eqNullSafe(F.col(f"hoy.{c}"))
    nace = F.col("hoy").isNotNull() & (F.col("antes").isNull() | cambio)
    muere = F.col("antes").isNotNull() & (
        (F.col("hoy").isNotNull() & cambio)
        | (F.col("hoy").isNull() & F.lit(cerrar_desaparecidos))
    )

    # A pair yields its old version, its new version, or both, in one pass.
    vieja = F.when(
        F.col("antes").isNotNull(),
        F.struct(
            *[F.col(f"antes.{c}").alias(c) for c in datos],
            F.col("antes.dbt_scd_id").alias("dbt_scd_id"),
            F.col("antes.dbt_updated_at").alias("dbt_updated_at"),
            F.col("antes.dbt_valid_from").alias("dbt_valid_from"),
            F.when(muere, momento).alias("dbt_valid_to"),
        ),
    )
    nueva = F.when(
        nace,
        F.struct(
            *[F.col(f"hoy.{c}").alias(c) for c in datos],
            _version_id("_clave", momento).alias("dbt_scd_id"),
            momento.alias("dbt_updated_at"),
            momento.alias("dbt_valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
        ),
    )
    versiones = (
        pares.select(F.explode(F.array(vieja, nueva)).alias("v")).where(F.col("v").isNotNull()).select("v.*")
    )
    return cerradas.select(*datos, *_VERSION).unionByName(versiones)


def snapshot_tipo_migracion(
    tipos: DataFrame, historia: DataFrame | None, ahora: dt.datetime
) -> DataFrame:
    """History of what was reported for each customer-month.

    Months that leave the window stay open: only the source moved on.
    """
    actual = tipos.select(
        F.concat_ws(
            "-", F.coalesce("cliente_id_limpio", F.lit("")), F.col("anio").cast("string"), F.col("mes").cast("string")
        ).alias("cliente_mes_key"),
        "cliente_id_limpio",
        "anio",
        "mes",
        "tipo_cliente",
    )
    return snapshot_scd2(actual, historia, "cliente_mes_key", ["tipo_cliente"], ahora)


def snapshot_mayoristas(
    mayoristas: DataFrame, historia: DataFrame | None, ahora: dt.datetime
) -> DataFrame:
    """History of wholesale levels; a customer that no longer qualifies is closed."""
    actual = mayoristas.select(
        F.concat_ws("-", F.coalesce("ambito", F.lit("")), F.coalesce("cliente_id_limpio", F.lit(""))).alias(
            "ambito_cliente_key"
        ),
        "ambito",
        "cliente_id_limpio",
        "nivel_mayorista",
        "puntaje",
    )
    return snapshot_scd2(
        actual,
        historia,
        "ambito_cliente_key",
        ["nivel_mayorista", "puntaje"],
        ahora,
        cerrar_desaparecidos=True,
    )


def publicar_historia(
    foto: Callable[[DataFrame, DataFrame | None, dt.datetime], DataFrame],
    actual: DataFrame,
    nombre: str,
    carpeta: str,
    ahora: dt.datetime,
    completa: bool = False,
) -> DataFrame:
    """One run of a stored history; ``foto`` is :func:`snapshot_tipo_migracion` or its like.

    A run reads the open versions, appends a part with those it closes, and replaces the
    part of the open ones.  Closed versions are only written again when parts are merged
    (:func:`a_fusionar`).  Its cost follows the dataset, not the length of the history.
    """
    spark = actual.sparkSession
    partes = [] if completa else _partes(spark, nombre)
    abiertas = [p.ruta for p in partes if p.parte == "abiertas"]
    historia = foto(actual, spark.read.parquet(abiertas[0]) if abiertas else None, ahora)
    # The parts are written from one stored result: it is computed once.
    historia = asentar(historia, "historia")
    cerrada = F.col("dbt_valid_to").isNotNull()
    rutas = {"cerradas": _version(nombre, carpeta), "abiertas": _version(nombre, carpeta)}
    historia.where(cerrada).write.parquet(rutas["cerradas"])
    historia.where(~cerrada).write.parquet(rutas["abiertas"])
    cerradas = [p for p in partes if p.parte == "cerradas"]
    cerradas.append(Parte("cerradas", rutas["cerradas"], _contar(spark, rutas["cerradas"])))
    juntas = a_fusionar([_contar(spark, p.ruta) if p.filas is None else p.filas for p in cerradas])
    if juntas:
        ruta = _version(nombre, carpeta)
        spark.read.schema(historia.schema).parquet(*[p.ruta for p in cerradas[-juntas:]]).write.parquet(ruta)
        cerradas = [*cerradas[:-juntas], Parte("cerradas", ruta, _contar(spark, ruta))]
    partes = [*cerradas, Parte("abiertas", rutas["abiertas"])]
    columnas = _nombres(historia.columns)
    consulta = " UNION ALL ".join(f"SELECT {columnas} FROM parquet.`{p.ruta}`" for p in partes)
    return _publicar_partes(spark, nombre, carpeta, partes, consulta)

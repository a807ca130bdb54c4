"""Registered queries: every operator over the source tables of one folder."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retalia.functions import ids
from retalia.functions.numbers import exacto, log_desde_minimo, normalizar_desde_log
from retalia.functions.periods import fecha_corte_mes_cerrado, meses_entre_periodos, periodo
from retalia.operators import customers, diagnostics, historia, mensual, migration, products, publish, quality, sales
from retalia.operators.skew import adjuntar_por_grupo
from retalia.operators.totales import ventas_por_nivel
from retalia.params import Params
from retalia.plans.retail import Retail
from retalia.plans.session import ajustar
from retalia.sources import lectura, schemas, seeds, star
from retalia.sources.workspace import asentar, carpeta_compartida

# Run dates and limits that suit the range of the order tables.
AS_OF = dt.date(2001, 7, 15)
AS_OF_PREVIO = dt.date(2001, 6, 15)
CONOCIDO_HASTA = dt.date(2001, 5, 16)  # sales known to the earlier run
MOMENTO = dt.datetime(2001, 7, 15, 6, 0)
MOMENTO_PREVIO = dt.datetime(2001, 6, 15, 6, 0)
UMBRAL_VENTAS = 100_000
CLIENTE_PRUEBA = "100008"
VENCIDA = dt.date(2001, 10, 15)  # two months after the last sale
CORREGIDO = dt.date(2000, 9, 1)  # month whose lines were wrong at the earlier run
CORRIDAS = [dt.date(2000, 6 + k, 1) if k < 7 else dt.date(2001, k - 6, 1) for k in range(11)]  # ends of monthly runs
FOTOS = [dt.date(2000, 7, 15), dt.date(2001, 1, 15), AS_OF]  # runs that took a snapshot, at six in the morning
MESES_CONSULTA = 7  # months from an event to the date at which its label is asked for


def params(as_of: dt.date = AS_OF) -> Params:
    return Params(as_of=as_of, top300_umbral_ventas_gs=UMBRAL_VENTAS, cliente_prueba=CLIENTE_PRUEBA)


def retail(spark: SparkSession, carpeta: str, as_of: dt.date = AS_OF, mapeo: DataFrame | None = None) -> Retail:
    ajustar(spark)
    return Retail(
        ventas=star.ventas(spark, carpeta),
        clientes=star.clientes(spark, carpeta),
        productos=star.productos(spark, carpeta),
        sucursales=seeds.sucursales(spark),
        productos_excluidos=seeds.productos_excluidos(spark),
        params=params(as_of),
        mapeo=mapeo,
    )


def _modelo(nombre: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, carpeta: getattr(retail(spark, carpeta), nombre)


def _unir(partes: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, partes)


# -- expressions -------------------------------------------------------------------


def clean_ids(spark: SparkSession, carpeta: str) -> DataFrame:
    r = retail(spark, carpeta)
    crudos = r.stg_clientes.select("cliente_id").unionByName(r.stg_ventas.select("cliente_id")).distinct()
    c = F.col("cliente_id")
    return crudos.select(
        "cliente_id",
        ids.limpiar_id(c).alias("sin_letras"),
        ids.cliente_id_clean(c).alias("cliente_id_clean"),
        ids.cliente_id_limpio(c).alias("cliente_id_limpio"),
    )


def _ventas_por_dia(spark: SparkSession, carpeta: str) -> DataFrame:
    return retail(spark, carpeta).stg_ventas.groupBy("fecha_venta").agg(F.count(F.lit(1)).alias("lineas"))


def fecha_corte(spark: SparkSession, carpeta: str) -> DataFrame:
    return _ventas_por_dia(spark, carpeta).select(
        "fecha_venta", "lineas", fecha_corte_mes_cerrado(F.col("fecha_venta")).alias("fecha_corte")
    )


def meses_hasta_corte(spark: SparkSession, carpeta: str) -> DataFrame:
    corte = params().corte
    p = periodo(F.year("fecha_venta"), F.month("fecha_venta"))
    return (
        _ventas_por_dia(spark, carpeta)
        .groupBy(p.alias("periodo"))
        .agg(F.sum("lineas").alias("lineas"))
        .withColumn(
            "meses", meses_entre_periodos(F.lit(corte.year * 100 + corte.month), F.col("periodo"))
        )
    )


def normalizar_log(spark: SparkSession, carpeta: str) -> DataFrame:
    ventas = (
        retail(spark, carpeta)
        .stg_ventas.groupBy("producto_id")
        .agg(F.sum(exacto("venta_gs")).cast("double").alias("ventas"))
    )
    extremos = ventas.agg(F.min("ventas").alias("_min"), F.max("ventas").alias("_max"))
    v, mn, mx = F.col("ventas"), F.col("_min"), F.col("_max")
    return adjuntar_por_grupo(ventas, extremos, [], "producto_id").select(
        "producto_id",
        "ventas",
        normalizar_desde_log(log_desde_minimo(v, mn), F.lit(0.0), log_desde_minimo(mx, mn)).alias("norma"),
    )


# -- staging and shared rules ------------------------------------------------------


def stg_productos(spark: SparkSession, carpeta: str) -> DataFrame:
    """With both categories back under the default collation, for exchange."""
    df = retail(spark, carpeta).stg_productos
    return df.withColumns({c: F.collate(c, "UTF8_BINARY") for c in ("categoria_1", "categoria_2")})


def ventas_elegibles_mapeo(spark: SparkSession, carpeta: str) -> DataFrame:
    """The same lines through a stored mapping."""
    mapeo = asentar(retail(spark, carpeta).int_clientes_mapeo_limpio, "clientes-mapeo")
    return retail(spark, carpeta, mapeo=mapeo).int_ventas_elegibles


# -- incremental and history -------------------------------------------------------


def upsert_mapeo(spark: SparkSession, carpeta: str) -> DataFrame:
    r = retail(spark, carpeta)
    conocidas = r.stg_ventas.where(F.col("fecha_venta") < F.lit(CONOCIDO_HASTA))
    previo = customers.int_clientes_mapeo_limpio(r.int_clientes_normalizados, conocidas)
    nuevo = customers.int_clientes_mapeo_limpio(
        r.int_clientes_normalizados, r.stg_ventas, desde=r.params.inicio_lookback
    )
    return publish.incremental_upsert(
        asentar(previo, "mapeo-previo"), asentar(nuevo, "mapeo-nuevo"), ["cliente_id"]
    )


def upsert_ventas(spark: SparkSession, carpeta: str) -> DataFrame:
    antes, hoy = retail(spark, carpeta, AS_OF_PREVIO), retail(spark, carpeta)
    conocidas = antes.int_ventas_elegibles.where(F.col("fecha_venta") < F.lit(CONOCIDO_HASTA))
    previo = asentar(sales.fct_ventas_36m(conocidas, antes.params), "ventas-36m-previo")
    return publish.refrescar_ventas_36m(previo, hoy.int_ventas_elegibles, hoy.params)


def scd2_tipo(spark: SparkSession, carpeta: str) -> DataFrame:
    antes = retail(spark, carpeta, AS_OF_PREVIO).dim_cliente_tipo_migracion
    hoy = retail(spark, carpeta).dim_cliente_tipo_migracion
    historia = asentar(publish.snapshot_tipo_migracion(antes, None, MOMENTO_PREVIO), "historia-tipo")
    return publish.snapshot_tipo_migracion(hoy, historia, MOMENTO)


def scd2_mayoristas(spark: SparkSession, carpeta: str) -> DataFrame:
    antes = retail(spark, carpeta, AS_OF_PREVIO).dim_clientes_mayoristas
    hoy = retail(spark, carpeta).dim_clientes_mayoristas
    historia = asentar(publish.snapshot_mayoristas(antes, None, MOMENTO_PREVIO), "historia-mayoristas")
    return publish.snapshot_mayoristas(hoy, historia, MOMENTO)


def _conocidas_con_error(r: Retail) -> DataFrame:
    """Eligible lines as the earlier run saw them: ten months back one branch was missing and one counted twice."""
    dia, pdv = F.col("fecha_venta"), F.col("pdv_id")
    mes = (dia >= F.lit(CORREGIDO)) & (dia < F.add_months(F.lit(CORREGIDO), 1))
    lineas = r.int_ventas_elegibles.where((dia < F.lit(CONOCIDO_HASTA)) & ~(mes & (pdv == "4")))
    return lineas.withColumn("venta_gs", F.when(mes & (pdv == "3"), 2 * F.col("venta_gs")).otherwise(F.col("venta_gs")))


def _publicar_correcciones(spark: SparkSession, carpeta: str) -> tuple[DataFrame, dict[str, str], dict[str, str]]:
    """The table after the later run, and the paths of its months before and after that run."""
    nombre = _nombre("ventas_36m")
    antes, hoy = retail(spark, carpeta, AS_OF_PREVIO), retail(spark, carpeta)
    publish.publicar_correcciones(_conocidas_con_error(antes), antes.params, nombre, _carpeta(spark))
    previas = dict(publish.partes_publicadas(spark, nombre))
    tabla = publish.publicar_correcciones(hoy.int_ventas_elegibles, hoy.params, nombre, _carpeta(spark))
    return tabla, previas, dict(publish.partes_publicadas(spark, nombre))


def publicar_correcciones(spark: SparkSession, carpeta: str) -> DataFrame:
    """Run with wrong lines ten months back, then with the right ones: equal to a full build."""
    return _publicar_correcciones(spark, carpeta)[0]


def meses_corregidos(spark: SparkSession, carpeta: str) -> DataFrame:
    """Months of the published table, and whether the later run wrote them."""
    _, previas, rutas = _publicar_correcciones(spark, carpeta)
    filas = [(int(m), ruta != previas.get(m)) for m, ruta in rutas.items()]
    return spark.createDataFrame(filas, "periodo int, refrescado boolean")


def publicar_mapeo_fusionado(spark: SparkSession, carpeta: str) -> DataFrame:
    """The mapping after a first run and ten monthly ones: more than a view may name, so parts were merged."""
    nombre, r, desde = _nombre("clientes_mapeo"), retail(spark, carpeta), None
    # All runs read these: the ids are cleaned and the sales joined once, not for each run.
    normalizados = asentar(r.int_clientes_normalizados, "clientes-normalizados")
    ventas = asentar(r.stg_ventas.select("cliente_id", "fecha_venta").distinct(), "ids-por-dia")
    for hasta in CORRIDAS:
        conocidas = ventas.where(F.col("fecha_venta") < F.lit(hasta))
        nuevo = customers.int_clientes_mapeo_limpio(normalizados, conocidas, desde=desde)
        tabla, desde = publish.publicar_mapeo(nuevo, nombre, _carpeta(spark)), hasta
    return tabla


def etiqueta_en_fecha(spark: SparkSession, carpeta: str) -> DataFrame:
    """Of each migration event, the label of its customer-month that was reported some months later."""
    pasada = None
    for as_of in FOTOS:
        tipos = retail(spark, carpeta, as_of).dim_cliente_tipo_migracion
        momento = dt.datetime.combine(as_of, dt.time(6))
        pasada = asentar(publish.snapshot_tipo_migracion(tipos, pasada, momento), "historia-tipo")
    consulta = F.add_months(F.make_date("anio", "mes", F.lit(1)), MESES_CONSULTA)
    eventos = retail(spark, carpeta).dim_cliente_migracion_eventos.select(
        "cliente_id_limpio",
        "anio",
        "mes",
        "local_destino",
        F.col("tipo_cliente").alias("tipo_evento"),
        consulta.cast("timestamp_ntz").alias("fecha_consulta"),
    )
    eventos = asentar(eventos, "eventos")
    claves = ["cliente_id_limpio", "anio", "mes"]
    return historia.en_fecha(eventos, pasada, claves, "fecha_consulta", ["tipo_cliente"])


def ultima_venta_por_id(spark: SparkSession, carpeta: str) -> DataFrame:
    """Last sale of each raw id of an event's customer before the month of the event."""
    r = retail(spark, carpeta)
    eventos = r.dim_cliente_migracion_eventos.select(
        "cliente_id_limpio", "local_destino", F.make_date("anio", "mes", F.lit(1)).alias("fecha_evento")
    )
    hechos = asentar(eventos.join(r.int_clientes_mapeo_limpio, "cliente_id_limpio"), "eventos-por-id")
    valores = ["factura_nro", "venta_gs"]
    return historia.ultimo_antes(hechos, r.stg_ventas, ["cliente_id"], "fecha_evento", "fecha_venta", valores)


def tipo_migracion_incremental(spark: SparkSession, carpeta: str) -> DataFrame:
    """States of the earlier run carried forward: only the months of the look-back are read."""
    antes, hoy = retail(spark, carpeta, AS_OF_PREVIO), retail(spark, carpeta)
    conocidas = sales.lineas_36m(
        antes.int_ventas_elegibles.where(F.col("fecha_venta") < F.lit(CONOCIDO_HASTA)), antes.params
    )
    pivotado = migration.fct_ventas_36m_pivotado(conocidas, antes.sucursales, antes.stg_clientes_limpio)
    previos = asentar(migration.dim_cliente_tipo_migracion(pivotado), "estados-antes")
    desde, p = hoy.params.inicio_lookback_mes, hoy.params
    lineas = sales.lineas_36m(hoy.int_ventas_elegibles, p, desde=desde)
    pivotado = migration.fct_ventas_36m_pivotado(lineas, hoy.sucursales, hoy.stg_clientes_limpio)
    inicio = p.inicio_ventana(p.meses_ventana_canibalizacion)
    return migration.tipo_migracion_incremental(
        previos, pivotado, inicio.year * 100 + inicio.month, desde.year * 100 + desde.month
    )[0]


def top300_meses(spark: SparkSession, carpeta: str) -> DataFrame:
    """The ranking from stored months: the later run reads the lines of the look-back only."""
    nombre = _nombre("parciales")
    antes, hoy = retail(spark, carpeta, AS_OF_PREVIO), retail(spark, carpeta)
    conocidas = antes.int_ventas_elegibles.where(F.col("fecha_venta") < F.lit(CONOCIDO_HASTA))
    mensual.publicar_parciales(conocidas, antes.params, nombre, _carpeta(spark))
    tablas = mensual.publicar_parciales(hoy.int_ventas_elegibles, hoy.params, nombre, _carpeta(spark))
    medidas = products.sobre_umbral(mensual.medidas_de_meses(*tablas), hoy.params)
    return products.top300_ranking(medidas, hoy.params)


# -- checks ------------------------------------------------------------------------


def check_not_null(spark: SparkSession, carpeta: str) -> DataFrame:
    df = retail(spark, carpeta).stg_ventas
    return quality.check_not_null(df, *df.columns)


def check_unique(spark: SparkSession, carpeta: str) -> DataFrame:
    return quality.check_unique(retail(spark, carpeta).int_clientes_normalizados, "cliente_id_limpio")


def check_accepted(spark: SparkSession, carpeta: str) -> DataFrame:
    con_sucursal = [pdv for pdv, _, _ in seeds.SUCURSALES]
    return quality.check_accepted_values(retail(spark, carpeta).stg_ventas, "pdv_id", con_sucursal)


def check_suite(spark: SparkSession, carpeta: str) -> DataFrame:
    """All declared checks of all datasets and both singular checks, from the writes of one run.

    With a limit of one raw id per customer and a run date two months after the last
    sale, both singular checks fail on the given tables.
    """
    rev, r = quality.Revision(), retail(spark, carpeta)
    mapeo = rev.escribir("int_clientes_mapeo_limpio", r.int_clientes_mapeo_limpio)
    con_mapeo = retail(spark, carpeta, mapeo=mapeo)
    elegibles = rev.escribir("int_ventas_elegibles", con_mapeo.int_ventas_elegibles)
    for nombre in ("stg_ventas", "stg_clientes", "stg_productos", "stg_clientes_mapeo", "stg_clientes_limpio"):
        rev.mirar(nombre, getattr(con_mapeo, nombre))
    for nombre in ("int_clientes_normalizados", "int_clientes_limpio"):
        rev.mirar(nombre, getattr(con_mapeo, nombre))
    # What later datasets read is written once, and they are built on what was written.
    fuentes = (r.ventas, r.clientes, r.productos, r.sucursales, r.productos_excluidos, r.params, mapeo)
    ventas_36m = rev.escribir("fct_ventas_36m", Retail(*fuentes, elegibles=elegibles).fct_ventas_36m)
    r = Retail(*fuentes, ventas_36m, elegibles)
    r._pivotado_escrito = rev.escribir("fct_ventas_36m_pivotado", r.fct_ventas_36m_pivotado)
    for nombre in (
        "int_canibalizacion_migracion_base",
        "fct_canibalizacion_evolutivo_cliente",
        "dim_cliente_migracion_eventos",
        "int_mayoristas_metricas_cliente",
    ):
        setattr(r, nombre, rev.escribir(nombre, getattr(r, nombre)))
    for nombre in ("int_ventas_12m", "dim_cliente_tipo_migracion", "fct_canibalizacion_migracion_resumen"):
        rev.mirar(nombre, getattr(r, nombre))
    for nombre in ("int_top300_kpis", "top300_ranking", "dim_clientes_mayoristas"):
        rev.mirar(nombre, getattr(r, nombre))
    rev.informar(quality.revisar_colisiones(mapeo, limite=1))
    rev.informar(quality.revisar_actualidad(r.ventas, VENCIDA))
    return spark.createDataFrame(rev.fallas, "conjunto string, prueba string, severidad string, fallas long")


def lineas_descartadas(spark: SparkSession, carpeta: str) -> DataFrame:
    r = retail(spark, carpeta)
    return sales.lineas_descartadas(r.stg_ventas, r.stg_productos, r.productos_excluidos, r.params)


REQUERIDAS = ["cliente_id", "producto_id", "fecha_venta"]


def rechazos(spark: SparkSession, carpeta: str) -> DataFrame:
    """A text export of the sales: rows by the rule and column that reject them."""
    return lectura.resumen_de_rechazos(star.ventas_texto(spark, carpeta), schemas.VENTAS, REQUERIDAS)


def ventas_aceptadas(spark: SparkSession, carpeta: str) -> DataFrame:
    """The rows of that export that are accepted, by month."""
    aceptadas, _ = lectura.separar(star.ventas_texto(spark, carpeta), schemas.VENTAS, REQUERIDAS)
    return aceptadas.groupBy(periodo(F.year("fecha_venta"), F.month("fecha_venta")).alias("periodo")).agg(
        F.count(F.lit(1)).alias("lineas"), F.sum(exacto("unidades")).cast("double").alias("unidades")
    )


def por_nivel(spark: SparkSession, carpeta: str) -> DataFrame:
    """Sums over the last twelve months; one point of sale is unknown to the earlier system."""
    ventas = retail(spark, carpeta).int_ventas_12m
    return ventas_por_nivel(ventas.withColumn("pdv_id", F.nullif("pdv_id", F.lit("4"))))


# -- tables written and read back ----------------------------------------------------


def _nombre(base: str) -> str:
    """A name of its own for each call."""
    return f"{base}_{uuid.uuid4().hex}"


def _carpeta(spark: SparkSession) -> str:
    return f"{carpeta_compartida(spark)}/retalia/publicado"


def publicar_tabla(spark: SparkSession, carpeta: str) -> DataFrame:
    """The ranking as a table partitioned by scope, read back through its view."""
    nombre = _nombre("top300_ranking")
    return publish.publicar_tabla(retail(spark, carpeta).top300_ranking, nombre, _carpeta(spark), ["ambito"])


def publicar_ventas_36m(spark: SparkSession, carpeta: str) -> DataFrame:
    """Run at the earlier date, then at the later one: equal to a full build."""
    nombre = _nombre("ventas_36m")
    antes, hoy = retail(spark, carpeta, AS_OF_PREVIO), retail(spark, carpeta)
    conocidas = antes.int_ventas_elegibles.where(F.col("fecha_venta") < F.lit(CONOCIDO_HASTA))
    publish.publicar_ventas_36m(conocidas, antes.params, nombre, _carpeta(spark))
    return publish.publicar_ventas_36m(hoy.int_ventas_elegibles, hoy.params, nombre, _carpeta(spark))


def publicar_mapeo(spark: SparkSession, carpeta: str) -> DataFrame:
    """First run on the sales known then, incremental run on the look-back, read back."""
    nombre = _nombre("clientes_mapeo")
    r = retail(spark, carpeta)
    conocidas = r.stg_ventas.where(F.col("fecha_venta") < F.lit(CONOCIDO_HASTA))
    previo = customers.int_clientes_mapeo_limpio(r.int_clientes_normalizados, conocidas)
    nuevo = customers.int_clientes_mapeo_limpio(
        r.int_clientes_normalizados, r.stg_ventas, desde=r.params.inicio_lookback
    )
    publish.publicar_mapeo(previo, nombre, _carpeta(spark))
    return publish.publicar_mapeo(nuevo, nombre, _carpeta(spark))


def _publicar_historia(base: str, modelo: str, foto: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def consulta(spark: SparkSession, carpeta: str) -> DataFrame:
        nombre = _nombre(base)
        antes = getattr(retail(spark, carpeta, AS_OF_PREVIO), modelo)
        hoy = getattr(retail(spark, carpeta), modelo)
        publish.publicar_historia(foto, antes, nombre, _carpeta(spark), MOMENTO_PREVIO)
        return publish.publicar_historia(foto, hoy, nombre, _carpeta(spark), MOMENTO)

    return consulta


def check_schema(spark: SparkSession, carpeta: str) -> DataFrame:
    """Columns of the published staging tables against a contract that wants two other types and one more.

    The rows counted beside each difference are read back from the table.
    """
    r = retail(spark, carpeta)
    salida = []
    for nombre, df, contrato in (
        ("stg_ventas", r.stg_ventas, schemas.STG_VENTAS),
        ("stg_clientes", r.stg_clientes, schemas.CLIENTES),
    ):
        vista = _nombre(nombre)
        tabla = publish.publicar_tabla(df, vista, _carpeta(spark))
        otro = T.StructType([T.StructField(f.name, T.IntegerType() if f.name in ("unidades", "mail") else f.dataType) for f in contrato])
        otro = otro.add("alta", T.DateType())
        filas = tabla.agg(F.count(F.lit(1)).alias("filas")).scalar()
        dif = quality.check_schema(tabla, otro).unionByName(quality.check_schema(tabla, contrato))
        salida.append(dif.select(F.lit(nombre).alias("tabla"), "columna", "tipo_esperado", "tipo_real", filas.alias("filas")))
    return _unir(salida)


def check_collisions(spark: SparkSession, carpeta: str) -> DataFrame:
    """A limit of one: the tables merge two ids at most."""
    return quality.check_id_collisions(retail(spark, carpeta).int_clientes_mapeo_limpio, limite=1)


def check_freshness(spark: SparkSession, carpeta: str) -> DataFrame:
    """As seen two months after the last sale: the closed month is missing."""
    return quality.check_freshness(retail(spark, carpeta).ventas, VENCIDA)


# -- analyses ----------------------------------------------------------------------


def profile_ids(spark: SparkSession, carpeta: str) -> DataFrame:
    r = retail(spark, carpeta)
    return diagnostics.profile_ids(r.clientes, r.ventas)


def profile_samples(spark: SparkSession, carpeta: str) -> DataFrame:
    r = retail(spark, carpeta)
    return _unir(
        [
            diagnostics.profile_samples(r.clientes, r.ventas, a).withColumn("anomalia", F.lit(a))
            for a in ("otro_caracter", "guion_y_asterisco", "queda_vacio")
        ]
    )


def collision_histogram(spark: SparkSession, carpeta: str) -> DataFrame:
    return diagnostics.collision_histogram(retail(spark, carpeta).int_clientes_mapeo_limpio)


def compare_mappings(spark: SparkSession, carpeta: str) -> DataFrame:
    return diagnostics.compare_mappings(
        star.clientes_mapeo_previo(spark, carpeta), retail(spark, carpeta).int_clientes_mapeo_limpio
    )


def _compare_rows(clase: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, carpeta: diagnostics.compare_mappings_rows(
        star.clientes_mapeo_previo(spark, carpeta), retail(spark, carpeta).int_clientes_mapeo_limpio, clase
    )


def orphan_ids(spark: SparkSession, carpeta: str) -> DataFrame:
    r = retail(spark, carpeta)
    return customers.ids_huerfanos(r.stg_ventas, r.int_clientes_normalizados)


def _mapeo_y_eventos(spark: SparkSession, carpeta: str) -> tuple[Retail, DataFrame, DataFrame]:
    """A run with its mapping and events, each written once: the analyses read them several times."""
    r = retail(spark, carpeta)
    return r, asentar(r.int_clientes_mapeo_limpio, "mapeo"), asentar(r.dim_cliente_migracion_eventos, "eventos")


def orphan_share(spark: SparkSession, carpeta: str) -> DataFrame:
    r = retail(spark, carpeta)
    return diagnostics.orphan_share_by_type(
        r.int_clientes_mapeo_limpio, r.int_clientes_normalizados, r.dim_cliente_migracion_eventos
    )


def multi_id_share(spark: SparkSession, carpeta: str) -> DataFrame:
    r = retail(spark, carpeta)
    return diagnostics.multi_id_share_by_type(r.int_clientes_mapeo_limpio, r.dim_cliente_migracion_eventos)


def _ventana_eventos(r: Retail) -> DataFrame:
    """Eligible lines of the months that events can fall into."""
    return r.elegibles_ventana(r.params.meses_ventana_canibalizacion)


def branches_per_raw_id(spark: SparkSession, carpeta: str) -> DataFrame:
    r, mapeo, eventos = _mapeo_y_eventos(spark, carpeta)
    return diagnostics.branches_per_raw_id(_ventana_eventos(r), r.sucursales, mapeo, eventos)


def branches_per_raw_id_sample(spark: SparkSession, carpeta: str) -> DataFrame:
    r, mapeo, eventos = _mapeo_y_eventos(spark, carpeta)
    return diagnostics.branches_per_raw_id_sample(_ventana_eventos(r), r.sucursales, mapeo, eventos)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_ventas": _modelo("stg_ventas"),
    "stg_clientes": _modelo("stg_clientes"),
    "stg_productos": stg_productos,
    "stg_clientes_mapeo": _modelo("stg_clientes_mapeo"),
    "stg_clientes_limpio": _modelo("stg_clientes_limpio"),
    "clean_ids": clean_ids,
    "fecha_corte": fecha_corte,
    "meses_entre_periodos": meses_hasta_corte,
    "normalizar_log": normalizar_log,
    "clientes_normalizados": _modelo("int_clientes_normalizados"),
    "mapeo_limpio": _modelo("int_clientes_mapeo_limpio"),
    "clientes_limpio": _modelo("int_clientes_limpio"),
    "ventas_elegibles": _modelo("int_ventas_elegibles"),
    "ventas_elegibles_mapeo": ventas_elegibles_mapeo,
    "ventas_12m": _modelo("int_ventas_12m"),
    "ventas_36m": _modelo("fct_ventas_36m"),
    "ventas_pivotado": _modelo("fct_ventas_36m_pivotado"),
    "tipo_migracion": _modelo("dim_cliente_tipo_migracion"),
    "migracion_base": _modelo("int_canibalizacion_migracion_base"),
    "evolutivo": _modelo("fct_canibalizacion_evolutivo_cliente"),
    "migracion_eventos": _modelo("dim_cliente_migracion_eventos"),
    "migracion_resumen": _modelo("fct_canibalizacion_migracion_resumen"),
    "top300_kpis": _modelo("int_top300_kpis"),
    "top300_ranking": _modelo("top300_ranking"),
    "umbral_ticket_grande": _modelo("int_mayoristas_umbral_ticket_grande"),
    "metricas_cliente": _modelo("int_mayoristas_metricas_cliente"),
    "mayoristas": _modelo("dim_clientes_mayoristas"),
    "upsert_mapeo": upsert_mapeo,
    "upsert_ventas": upsert_ventas,
    "scd2_tipo": scd2_tipo,
    "scd2_mayoristas": scd2_mayoristas,
    "publicar_tabla": publicar_tabla,
    "publicar_ventas_36m": publicar_ventas_36m,
    "publicar_mapeo": publicar_mapeo,
    "publicar_historia_tipo": _publicar_historia(
        "historia_tipo", "dim_cliente_tipo_migracion", publish.snapshot_tipo_migracion
    ),
    "publicar_historia_mayoristas": _publicar_historia(
        "historia_mayoristas", "dim_clientes_mayoristas", publish.snapshot_mayoristas
    ),
    "publicar_correcciones": publicar_correcciones,
    "meses_corregidos": meses_corregidos,
    "publicar_mapeo_fusionado": publicar_mapeo_fusionado,
    "etiqueta_en_fecha": etiqueta_en_fecha,
    "ultima_venta_por_id": ultima_venta_por_id,
    "tipo_migracion_incremental": tipo_migracion_incremental,
    "top300_meses": top300_meses,
    "lineas_descartadas": lineas_descartadas,
    "rechazos": rechazos,
    "ventas_aceptadas": ventas_aceptadas,
    "ventas_por_nivel": por_nivel,
    "check_schema": check_schema,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_accepted": check_accepted,
    "check_suite": check_suite,
    "check_collisions": check_collisions,
    "check_freshness": check_freshness,
    "profile_ids": profile_ids,
    "profile_samples": profile_samples,
    "collision_histogram": collision_histogram,
    "compare_mappings": compare_mappings,
    "compare_mappings_solo_legacy": _compare_rows("solo_legacy"),
    "compare_mappings_solo_nuevo": _compare_rows("solo_nuevo"),
    "compare_mappings_valor_distinto": _compare_rows("valor_distinto"),
    "orphan_ids": orphan_ids,
    "orphan_share": orphan_share,
    "multi_id_share": multi_id_share,
    "branches_per_raw_id": branches_per_raw_id,
    "branches_per_raw_id_sample": branches_per_raw_id_sample,
}

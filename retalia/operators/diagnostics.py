"""Ad-hoc analyses of identifiers, mappings and migration events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retalia.functions.ids import limpiar_id
from retalia.operators.migration import TIPOS_EVENTO
from retalia.operators.quality import ids_por_cliente
from retalia.operators.skew import join_repartido
from retalia.sources.workspace import asentar

# Event types that the merging analyses compare.
TIPOS_NUEVO = ["Nuevo - Dual", "Nuevo - Unico"]

# Fixed value: a symbol that the cleaning does not treat.
OTRO_CARACTER = r"[^A-Za-z0-9 \t\n\r*-]"

# Fixed value: the profile looks at ids of this width.
ANCHO_PERFIL = 255


# -- quality of the raw ids --------------------------------------------------------


def ids_clasificados(clientes: DataFrame, ventas: DataFrame) -> DataFrame:
    """Every raw id once, with the marks the profile counts."""
    ids = (
        clientes.select("cliente_id")
        .unionByName(ventas.select("cliente_id"))
        .select(F.substring("cliente_id", 1, ANCHO_PERFIL).alias("cliente_id"))
        .where(F.col("cliente_id").isNotNull())
        .distinct()
    )
    crudo = F.col("cliente_id")
    return ids.select(
        "cliente_id",
        limpiar_id(crudo).alias("cliente_id_clean"),
        crudo.contains("-").cast("int").alias("tiene_guion"),
        crudo.contains("*").cast("int").alias("tiene_asterisco"),
        crudo.rlike(OTRO_CARACTER).cast("int").alias("tiene_otro_caracter"),
    )


def profile_ids(clientes: DataFrame, ventas: DataFrame) -> DataFrame:
    """Counts of ids by kind of trouble (one row)."""
    guion, asterisco = F.col("tiene_guion") == 1, F.col("tiene_asterisco") == 1
    return ids_clasificados(clientes, ventas).agg(
        F.count(F.lit(1)).alias("total_ids"),
        F.count_if(guion).alias("con_guion"),
        F.count_if(asterisco).alias("con_asterisco"),
        F.count_if(guion & asterisco).alias("con_guion_y_asterisco"),
        F.count_if(F.col("tiene_otro_caracter") == 1).alias("con_otros_caracteres"),
        F.count_if(F.col("cliente_id_clean") == "").alias("queda_vacio_tras_limpiar"),
    )


def _anomalia(nombre: str) -> Column:
    return {
        "otro_caracter": F.col("tiene_otro_caracter") == 1,
        "guion_y_asterisco": (F.col("tiene_guion") == 1) & (F.col("tiene_asterisco") == 1),
        "queda_vacio": F.col("cliente_id_clean") == "",
    }[nombre]


def profile_samples(clientes: DataFrame, ventas: DataFrame, anomalia: str, n: int = 50) -> DataFrame:
    """The first ``n`` ids (in id order) that show an anomaly."""
    return (
        ids_clasificados(clientes, ventas)
        .where(_anomalia(anomalia))
        .select("cliente_id", "cliente_id_clean")
        .orderBy("cliente_id")
        .limit(n)
    )


def collision_histogram(mapeo: DataFrame) -> DataFrame:
    """How many clean ids merge how many raw ids."""
    return (
        ids_por_cliente(mapeo)
        .groupBy("cantidad_ids_origen")
        .agg(F.count(F.lit(1)).alias("cantidad_de_clientes_con_esa_cantidad"))
        .orderBy(F.desc("cantidad_ids_origen"))
    )


# -- two mappings ------------------------------------------------------------------


def mappings_lado_a_lado(previo: DataFrame, nuevo: DataFrame) -> DataFrame:
    """Both mappings per raw id (unique on both sides)."""
    return previo.select(
        "cliente_id", F.col("cliente_id_limpio").alias("cliente_id_limpio_legacy")
    ).join(
        nuevo.select("cliente_id", F.col("cliente_id_limpio").alias("cliente_id_limpio_nuevo")),
        "cliente_id",
        "full_outer",
    )


def _diferencia(clase: str) -> Column:
    previo, nuevo = F.col("cliente_id_limpio_legacy"), F.col("cliente_id_limpio_nuevo")
    return {
        "solo_legacy": nuevo.isNull(),
        "solo_nuevo": previo.isNull(),
        "valor_distinto": previo != nuevo,
    }[clase]


def compare_mappings(previo: DataFrame, nuevo: DataFrame) -> DataFrame:
    """Counts of ids that only one mapping holds or that they map differently."""
    return mappings_lado_a_lado(previo, nuevo).agg(
        F.count(F.lit(1)).alias("total_filas_comparadas"),
        *[
            F.count_if(_diferencia(clase)).alias(f"conteo_{clase}")
            for clase in ("solo_legacy", "solo_nuevo", "valor_distinto")
        ],
    )


def compare_mappings_rows(previo: DataFrame, nuevo: DataFrame, clase: str) -> DataFrame:
    """The rows behind one of the counts: solo_legacy, solo_nuevo or valor_distinto."""
    columnas = {
        "solo_legacy": ["cliente_id_limpio_legacy"],
        "solo_nuevo": ["cliente_id_limpio_nuevo"],
        "valor_distinto": ["cliente_id_limpio_legacy", "cliente_id_limpio_nuevo"],
    }[clase]
    un_lado = {
        "solo_legacy": F.col("cliente_id_limpio_legacy").isNotNull(),
        "solo_nuevo": F.col("cliente_id_limpio_nuevo").isNotNull(),
        "valor_distinto": F.lit(True),
    }[clase]
    return (
        mappings_lado_a_lado(previo, nuevo)
        .where(_diferencia(clase) & un_lado)
        .select("cliente_id", *columnas)
    )


# -- what stands behind the events -------------------------------------------------


def clientes_solo_huerfanos(mapeo: DataFrame, normalizados: DataFrame) -> DataFrame:
    """Clean ids of which no raw id is a registered customer."""
    registrados = (
        normalizados.select("cliente_id").distinct().withColumn("_registrado", F.lit(1))
    )
    return (
        mapeo.join(registrados, "cliente_id", "left")
        .groupBy("cliente_id_limpio")
        .agg(F.count("_registrado").alias("_registrados"))
        .where(F.col("_registrados") == 0)
        .select("cliente_id_limpio")
    )


def orphan_share_by_type(mapeo: DataFrame, normalizados: DataFrame, eventos: DataFrame) -> DataFrame:
    """Share of events of wholly unregistered customers, by event type."""
    huerfanos = clientes_solo_huerfanos(mapeo, normalizados).withColumn("_huerfano", F.lit(1))
    return (
        eventos.where(F.col("tipo_cliente").isin(*TIPOS_EVENTO))
        .join(huerfanos, "cliente_id_limpio", "left")
        .groupBy("tipo_cliente")
        .agg(
            F.count(F.lit(1)).alias("total_eventos"),
            F.count("_huerfano").alias("huerfanos"),
        )
        .withColumn("pct_huerfano", F.col("huerfanos") / F.col("total_eventos"))
    )


def eventos_con_ids(mapeo: DataFrame, eventos: DataFrame) -> DataFrame:
    """Events with the number of raw ids behind their customer (1 when unknown)."""
    return eventos.join(ids_por_cliente(mapeo), "cliente_id_limpio", "left").select(
        "cliente_id_limpio",
        "tipo_cliente",
        "local_origen",
        "local_destino",
        "anio",
        "mes",
        F.coalesce("cantidad_ids_origen", F.lit(1)).alias("cliente_ids_crudos"),
    )


def multi_id_share_by_type(mapeo: DataFrame, eventos: DataFrame) -> DataFrame:
    """Share of events whose customer merges several raw ids, by event type."""
    return (
        eventos_con_ids(mapeo, eventos)
        .where(F.col("tipo_cliente").isin(*TIPOS_NUEVO))
        .groupBy("tipo_cliente")
        .agg(
            F.count(F.lit(1)).alias("total_eventos"),
            F.count_if(F.col("cliente_ids_crudos") > 1).alias("con_dedup_multi"),
        )
        .withColumn("pct_con_dedup_multi", F.col("con_dedup_multi") / F.col("total_eventos"))
    )


def candidatos_fusion(mapeo: DataFrame, eventos: DataFrame) -> DataFrame:
    """Two-branch arrivals of customers that merge several raw ids."""
    return (
        eventos_con_ids(mapeo, eventos)
        .where((F.col("tipo_cliente") == "Nuevo - Dual") & (F.col("cliente_ids_crudos") > 1))
        .select("cliente_id_limpio", "local_origen", "local_destino", "anio", "mes")
    )


def ventas_por_id_crudo(
    elegibles: DataFrame, sucursales: DataFrame, candidatos: DataFrame
) -> DataFrame:
    """Branches in which each raw id of a candidate bought in the event month.

    Only lines of candidates go on; these are reduced to distinct (raw id, branch,
    month) before they meet the events, so a busy customer is not shuffled by line.
    """
    de_candidatos = join_repartido(
        elegibles,
        candidatos.select("cliente_id_limpio").distinct(),
        "cliente_id_limpio",
        ["cliente_id", "fecha_venta", "ticket_id"],
        "left_semi",
    )
    presencia = (
        join_repartido(
            de_candidatos,
            sucursales.select("pdv_id", "sucursal_codigo"),
            "pdv_id",
            ["cliente_id", "fecha_venta"],
            escribir=False,
        )
        .select(
            F.col("cliente_id").alias("cliente_id_crudo"),
            "cliente_id_limpio",
            F.col("sucursal_codigo").alias("sucursal"),
            F.year("fecha_venta").alias("anio"),
            F.month("fecha_venta").alias("mes"),
        )
        .distinct()
    )
    return (
        presencia.join(candidatos, ["cliente_id_limpio", "anio", "mes"])
        .where(F.col("sucursal").isin(F.col("local_origen"), F.col("local_destino")))
        .select("cliente_id_crudo", "cliente_id_limpio", "sucursal")
        .distinct()
    )


def branches_per_raw_id(
    elegibles: DataFrame, sucursales: DataFrame, mapeo: DataFrame, eventos: DataFrame
) -> DataFrame:
    """Histogram of branches per raw id of the candidates."""
    candidatos = asentar(candidatos_fusion(mapeo, eventos), "candidatos")  # a list and a side of a join
    return (
        ventas_por_id_crudo(elegibles, sucursales, candidatos)
        .groupBy("cliente_id_limpio", "cliente_id_crudo")
        .agg(F.count(F.lit(1)).alias("sucursales_distintas"))
        .groupBy("sucursales_distintas")
        .agg(F.count(F.lit(1)).alias("cantidad_cliente_id_crudos"))
    )


def branches_per_raw_id_sample(
    elegibles: DataFrame, sucursales: DataFrame, mapeo: DataFrame, eventos: DataFrame, n: int = 10
) -> DataFrame:
    """The first ``n`` candidates with their raw ids, in a total order."""
    candidatos = asentar(candidatos_fusion(mapeo, eventos), "candidatos")
    return (
        candidatos.join(ventas_por_id_crudo(elegibles, sucursales, candidatos), "cliente_id_limpio")
        .select(
            "cliente_id_limpio",
            "local_origen",
            "local_destino",
            "anio",
            "mes",
            "cliente_id_crudo",
            "sucursal",
        )
        .orderBy(
            "cliente_id_limpio", "cliente_id_crudo", "sucursal", "local_origen", "local_destino", "anio", "mes"
        )
        .limit(n)
    )

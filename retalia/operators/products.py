"""Product scores and the ranking of each scope.

A scope (``ambito``) is ``GLOBAL`` or a point of sale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retalia.functions.numbers import (
    DECIMALES_PUNTAJE,
    exacto,
    log_desde_minimo,
    normalizar_desde_log,
    razon,
)
from retalia.functions.periods import contar_dias, marca_dia, mascaras_dias, unir_mascaras
from retalia.operators.skew import adjuntar_por_grupo
from retalia.operators.sales import int_ventas_12m
from retalia.params import Params
from retalia.sources.workspace import asentar

# Scored measures and the short name of each in the output.
_METRICAS = {
    "ventas": "ventas",
    "tickets_por_producto": "tickets",
    "unidades_por_dia": "unidades_dia",
    "unidades_por_ticket": "unidades_ticket",
}

_KPIS = [
    "ambito",
    "producto_id",
    "tickets_por_producto",
    "unidades_totales",
    "ventas",
    "dias_con_ventas",
    "unidades_por_ticket",
    "unidades_por_dia",
]
_NORMAS = [f"norm_{corto}" for corto in _METRICAS.values()]
TRAMOS = ["tickets_1_2", "tickets_3_5", "tickets_6_mas"]
MEDIDAS = [*_KPIS, *TRAMOS]


def medidas_por_producto(ventas_12m: DataFrame, params: Params) -> DataFrame:
    """All measures of a (scope, product), in one pass over the lines.

    Lines go through one shuffle, on (product, ticket), with a date and not with day
    masks.  Behind it they are grouped to (point of sale, product, ticket) and from
    there to (product, ticket), both on that partitioning; only then the scopes are put
    together.  Distinct tickets are a plain count, the ticket-size buckets a conditional
    count, and distinct days travel as bit masks, so nothing needs COUNT(DISTINCT) or a
    self-join.  A product that holds a third of the lines is spread over its tickets.
    """
    meses = params.ventana_meses_12m
    lineas = (
        int_ventas_12m(ventas_12m, params)
        .select(
            F.col("pdv_id").cast("string").alias("ambito"),
            "producto_id",
            "ticket_id",
            exacto("unidades").alias("unidades"),
            exacto("venta_gs").alias("venta_gs"),
            "fecha_venta",
        )
        .repartition("producto_id", "ticket_id")
    )
    sumas = [F.sum("unidades").alias("unidades"), F.sum("venta_gs").alias("venta_gs")]
    de_pdv = (
        lineas.select("*", *marca_dia(F.col("fecha_venta"), params.inicio_ventana(meses)))
        .groupBy("ambito", "producto_id", "ticket_id")
        .agg(*sumas, *mascaras_dias(meses))
    )
    global_ = de_pdv.groupBy("producto_id", "ticket_id").agg(*sumas, *unir_mascaras(meses))
    por_ticket = de_pdv.unionByName(global_.withColumn("ambito", F.lit("GLOBAL")))
    u = F.col("unidades")
    return (
        por_ticket.groupBy("ambito", "producto_id")
        .agg(
            F.count("ticket_id").alias("tickets_por_producto"),
            F.sum(u).cast("double").alias("unidades_totales"),
            F.sum("venta_gs").cast("double").alias("ventas"),
            F.count_if(u.between(1, 2)).alias("tickets_1_2"),
            F.count_if(u.between(3, 5)).alias("tickets_3_5"),
            F.count_if(u >= 6).alias("tickets_6_mas"),
            *unir_mascaras(meses),
        )
        .withColumn("dias_con_ventas", contar_dias(meses))
        .withColumn("unidades_por_ticket", razon(F.col("unidades_totales"), F.col("tickets_por_producto")))
        .withColumn("unidades_por_dia", razon(F.col("unidades_totales"), F.col("dias_con_ventas")))
        .select(*_KPIS, *TRAMOS)
    )


def medidas_sobre_umbral(ventas_12m: DataFrame, params: Params) -> DataFrame:
    """Measures above the sales threshold, written once for the scores and the ranking."""
    return sobre_umbral(medidas_por_producto(ventas_12m, params), params)


def sobre_umbral(medidas: DataFrame, params: Params) -> DataFrame:
    """The measures whose sales are above the threshold, written."""
    return asentar(
        medidas.where(F.col("ventas") > F.lit(float(params.top300_umbral_ventas_gs))), "top300-medidas"
    )


def _normalizadas(medidas: DataFrame) -> DataFrame:
    """Measures with their 0..100 scores per scope.

    ``medidas`` (:func:`medidas_sobre_umbral`) is read twice (extremes, rows).  The
    smallest logarithm of a scope is ln 1 = 0 and the largest that of its largest
    value, so one aggregate per scope is all that normalising needs.
    """
    extremos = medidas.groupBy("ambito").agg(
        *[F.min(m).alias(f"_min_{m}") for m in _METRICAS],
        *[F.max(m).alias(f"_max_{m}") for m in _METRICAS],
    )
    con_extremos = adjuntar_por_grupo(medidas, extremos, ["ambito"], "producto_id")
    return con_extremos.select(
        *_KPIS,
        *[
            normalizar_desde_log(
                log_desde_minimo(F.col(m), F.col(f"_min_{m}")),
                F.lit(0.0),
                log_desde_minimo(F.col(f"_max_{m}"), F.col(f"_min_{m}")),
            ).alias(f"norm_{corto}")
            for m, corto in _METRICAS.items()
        ],
        *TRAMOS,
    )


def int_top300_kpis(medidas: DataFrame) -> DataFrame:
    return _normalizadas(medidas).select(*_KPIS, *_NORMAS)


def top300_ranking(medidas: DataFrame, params: Params) -> DataFrame:
    """The best products of each scope with score, position and ticket-size buckets.

    ``medidas`` is :func:`medidas_sobre_umbral`.

    The window keeps at most ``top300_posiciones`` rows per scope; Spark applies that
    limit in every input partition before it shuffles by scope.
    """
    pesos = {
        "norm_ventas": params.top300_peso_ventas,
        "norm_tickets": params.top300_peso_tickets,
        "norm_unidades_dia": params.top300_peso_unidades_dia,
        "norm_unidades_ticket": params.top300_peso_unidades_ticket,
    }
    puntaje = sum((F.col(n) * F.lit(float(p)) for n, p in pesos.items()), F.lit(0.0))
    orden = Window.partitionBy("ambito").orderBy(
        F.desc("puntaje_final"), F.desc("ventas"), F.asc("producto_id")
    )
    return (
        _normalizadas(medidas)
        .withColumn("puntaje_final", F.round(puntaje, DECIMALES_PUNTAJE))
        .withColumn("posicion", F.row_number().over(orden))
        .where(F.col("posicion") <= params.top300_posiciones)
        .select(
            "ambito",
            "producto_id",
            "posicion",
            "puntaje_final",
            *_NORMAS,
            "ventas",
            "tickets_por_producto",
            "unidades_totales",
            "dias_con_ventas",
            "unidades_por_ticket",
            "unidades_por_dia",
            # a sale without point of sale belongs to no branch: its buckets stay 0
            *[F.when(F.col("ambito").isNull(), 0).otherwise(F.col(t)).alias(t) for t in TRAMOS],
        )
    )

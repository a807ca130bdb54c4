"""Wholesale customers: ticket sizes, customer metrics, level per scope.

A scope (``ambito``) is ``GLOBAL`` or a branch code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retalia.functions.numbers import exacto, razon
from retalia.functions.periods import contar_dias, marca_dia, mascaras_dias, unir_mascaras
from retalia.operators.skew import adjuntar_por_grupo, join_repartido, percentiles_exactos
from retalia.operators.sales import int_ventas_12m
from retalia.params import Params
from retalia.sources.workspace import asentar

# Levels by number of criteria met, from none to three.
NIVELES = ["Minorista", "Potencial", "Medio", "Alto"]


def tickets_por_cliente(ventas_12m: DataFrame, params: Params) -> DataFrame:
    """Lines reduced to (customer, ticket, point of sale).

    The threshold and the customer metrics both start from this table, which is
    written once instead of reading the fact for each.
    """
    meses = params.ventana_meses_12m
    return asentar(
        int_ventas_12m(ventas_12m, params)
        .select("*", *marca_dia(F.col("fecha_venta"), params.inicio_ventana(meses)))
        .groupBy("cliente_id_limpio", "ticket_id", "pdv_id")
        .agg(
            F.sum(exacto("unidades")).alias("unidades"),
            F.sum(exacto("venta_gs")).alias("venta_gs"),
            *mascaras_dias(meses),
        ),
        "mayoristas-tickets",
    )


def int_mayoristas_umbral_ticket_grande(tickets: DataFrame, params: Params) -> DataFrame:
    """Quartiles of units per ticket and the cut for a big ticket (one row).

    ``tickets`` holds ``ticket_id`` and ``unidades``: the lines or any sum of them.
    """
    por_ticket = (
        tickets.groupBy("ticket_id")
        .agg(F.sum(exacto("unidades")).cast("double").alias("unidades_ticket"))
        .where(F.col("unidades_ticket") > 0)
    )
    cuartiles = percentiles_exactos(por_ticket, [], "unidades_ticket", {"q1": 0.25, "q3": 0.75})
    return cuartiles.where(F.col("q1").isNotNull()).select(
        "q1",
        "q3",
        (F.col("q3") + F.lit(params.mayoristas_factor_iqr) * (F.col("q3") - F.col("q1"))).alias(
            "umbral_ticket_grande"
        ),
    )


def int_mayoristas_metricas_cliente(
    tickets: DataFrame, sucursales: DataFrame, umbral: DataFrame, params: Params
) -> DataFrame:
    """Ticket and sales metrics of a (scope, customer).

    ``tickets`` is :func:`tickets_por_cliente`.  Tickets without positive units count
    for sales and days only; a customer with no other ticket has no row.
    """
    meses = params.ventana_meses_12m
    # One exchange; both scopes are grouped on its partitioning.
    tickets = tickets.where(F.col("cliente_id_limpio").isNotNull()).repartition("cliente_id_limpio", "ticket_id")
    de_sucursal = join_repartido(
        tickets,
        sucursales.select("pdv_id", F.col("sucursal_codigo").alias("ambito")),
        "pdv_id",
        ["cliente_id_limpio", "ticket_id"],
        escribir=False,
    )
    sumas = [F.sum("unidades").alias("unidades"), F.sum("venta_gs").alias("venta_gs"), *unir_mascaras(meses)]
    por_ticket = (
        tickets.groupBy("cliente_id_limpio", "ticket_id")
        .agg(*sumas)
        .withColumn("ambito", F.lit("GLOBAL"))
        .unionByName(de_sucursal.groupBy("ambito", "cliente_id_limpio", "ticket_id").agg(*sumas))
    )
    u = F.col("unidades")
    corte = umbral.select("umbral_ticket_grande").scalar()  # one row, run once as a subquery
    return (
        por_ticket.groupBy("ambito", "cliente_id_limpio")
        .agg(
            F.count_if(u > 0).alias("tickets_unicos"),
            F.sum(F.when(u > 0, u)).cast("double").alias("upt_suma"),
            F.count_if((u > 0) & (u.cast("double") > corte)).alias("tickets_grandes"),
            F.sum("venta_gs").cast("double").alias("ventas_totales"),
            *unir_mascaras(meses),
        )
        .where(F.col("tickets_unicos") > 0)
        .select(
            "ambito",
            "cliente_id_limpio",
            "tickets_unicos",
            contar_dias(meses).alias("dias_con_compra"),
            razon(F.col("upt_suma"), F.col("tickets_unicos")).alias("upt"),
            razon(F.col("tickets_grandes"), F.col("tickets_unicos")).alias("pct_tickets_grandes"),
            "ventas_totales",
        )
    )


def umbrales_por_ambito(metricas: DataFrame, params: Params) -> DataFrame:
    """The three cuts of each scope (one row per scope)."""
    medidas = ["upt", "pct_tickets_grandes", "ventas_totales"]
    largas = metricas.select("ambito", *medidas).unpivot("ambito", medidas, "medida", "valor")
    q3 = percentiles_exactos(largas, ["ambito", "medida"], "valor", {"q3": params.mayoristas_percentil})
    por_ambito = q3.groupBy("ambito").agg(
        *[F.max(F.when(F.col("medida") == m, F.col("q3"))).alias(f"_q3_{m}") for m in medidas]
    )
    piso = F.lit(params.mayoristas_pct_grandes_minimo)
    q3_pct = F.col("_q3_pct_tickets_grandes")
    return por_ambito.select(
        "ambito",
        F.col("_q3_upt").alias("umbral_upt"),
        F.when(piso > q3_pct, piso).otherwise(q3_pct).alias("umbral_pct"),
        F.col("_q3_ventas_totales").alias("umbral_ventas"),
    )


def dim_clientes_mayoristas(metricas: DataFrame, params: Params) -> DataFrame:
    """One point per criterion met, and the level that goes with the points.

    ``metricas`` is read for the cuts and again for the rows: pass a stored table.
    """
    con_umbral = adjuntar_por_grupo(
        metricas, umbrales_por_ambito(metricas, params), ["ambito"], "cliente_id_limpio"
    )

    def cumple(valor: str, umbral: str):
        return F.coalesce((F.col(valor) >= F.col(umbral)).cast("int"), F.lit(0))

    puntos = F.col("c1_upt_alto") + F.col("c2_pct_grandes_alto") + F.col("c3_ventas_alto")
    return (
        con_umbral.withColumns(
            {
                "c1_upt_alto": cumple("upt", "umbral_upt"),
                "c2_pct_grandes_alto": cumple("pct_tickets_grandes", "umbral_pct"),
                "c3_ventas_alto": cumple("ventas_totales", "umbral_ventas"),
            }
        )
        .withColumn("puntaje", puntos)
        .withColumn("nivel_mayorista", F.array(*map(F.lit, NIVELES))[F.col("puntaje")])
        .select(
            "ambito",
            "cliente_id_limpio",
            "tickets_unicos",
            "dias_con_compra",
            "upt",
            "pct_tickets_grandes",
            "ventas_totales",
            "c1_upt_alto",
            "c2_pct_grandes_alto",
            "c3_ventas_alto",
            "puntaje",
            "nivel_mayorista",
            "umbral_upt",
            "umbral_pct",
            "umbral_ventas",
        )
    )

"""Movement of customers between branches: monthly states and migration events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retalia.functions.numbers import exacto
from retalia.functions.periods import mes_absoluto, meses_entre_periodos, periodo
from retalia.operators.skew import join_repartido
from retalia.params import Params
from retalia.sources.workspace import asentar

# Branch codes, in the order in which labels name them.
SUCURSALES = ["SL", "R1", "R2"]

# The labels of a customer-month.
TIPOS_CLIENTE = [
    "Cliente SL",
    "Cliente R1",
    "Cliente R2",
    "Cliente Dual SL y R1",
    "Cliente Dual SL y R2",
    "Cliente Dual R1 y R2",
    "Cliente SL, R1 y R2",
    "Migro de SL a R1",
    "Migro de SL a R2",
    "Migro de SL a R1 y R2",
    "Migro de R1 a SL",
    "Migro de R1 a R2",
    "Migro de R1 a SL y R2",
    "Migro de R2 a SL",
    "Migro de R2 a R1",
    "Migro de R2 a SL y R1",
]

# The labels of a migration event.
TIPOS_EVENTO = ["Nuevo - Unico", "Nuevo - Dual", "Recurrente - Dual", "Recurrente - Migracion"]


def fct_ventas_36m_pivotado(
    ventas_36m: DataFrame, sucursales: DataFrame, clientes_limpio: DataFrame
) -> DataFrame:
    """Customer-months with one amount column per branch (0 when it sold nothing).

    ``ventas_36m`` is the monthly table where one is kept, or else the lines of its
    window (``sales.lineas_36m``), whose exact sums are the same.
    """
    de_sucursal = join_repartido(
        ventas_36m,
        sucursales.select("pdv_id", "sucursal_codigo"),
        "pdv_id",
        ["cliente_id_limpio", "anio", "mes"],
        escribir=False,
    )
    montos = de_sucursal.groupBy("cliente_id_limpio", "anio", "mes").agg(
        *[
            F.sum(F.when(F.col("sucursal_codigo") == s, exacto("total_ventas")).otherwise(0))
            .cast("double")
            .alias(s)
            for s in SUCURSALES
        ]
    )
    return montos.join(
        clientes_limpio.select("cliente_id_limpio", "nombre"), "cliente_id_limpio", "left"
    ).select("cliente_id_limpio", "anio", "mes", *SUCURSALES, "nombre")


def _enumerar(condiciones: dict[str, Column]) -> Column:
    """The branches whose condition holds, joined by "y"."""
    return F.concat_ws(" y ", *[F.when(cond, F.lit(s)) for s, cond in condiciones.items()])


def _etiqueta_presencia(compra: dict[str, Column]) -> Column:
    """Label of the set of branches in which the customer holds a balance."""
    cuantas = sum((F.when(cond, 1).otherwise(0) for cond in compra.values()), F.lit(0))
    return (
        F.when(cuantas == 1, F.concat(F.lit("Cliente "), _enumerar(compra)))
        .when(cuantas == 2, F.concat(F.lit("Cliente Dual "), _enumerar(compra)))
        .when(cuantas == 3, F.lit("Cliente SL, R1 y R2"))
    )


def _etiqueta_salida(origen: str, saldo: dict[str, Column]) -> Column:
    """Label of a customer known in ``origen`` only, who did not buy there this month."""
    destinos = [s for s in SUCURSALES if s != origen]
    sin_deuda = (saldo[destinos[0]] >= 0) & (saldo[destinos[1]] >= 0)
    alguno = (saldo[destinos[0]] > 0) | (saldo[destinos[1]] > 0)
    nuevas = _enumerar({s: saldo[s] > 0 for s in destinos})
    return F.when(sin_deuda & alguno, F.concat(F.lit(f"Migro de {origen} a "), nuevas)).otherwise(
        F.lit(f"Cliente {origen}")
    )


def dim_cliente_tipo_migracion(pivotado: DataFrame, apertura: DataFrame | None = None) -> DataFrame:
    """State of each customer-month, from running balances and those of the month before.

    One shuffle by customer serves both windows; a customer has at most one row per
    month of the long window.  ``apertura`` holds the balances with which customers enter
    the first of these months (``cliente_id_limpio`` and ``sl_acumulado`` …); a customer
    without a row there is new.
    """
    meses = Window.partitionBy("cliente_id_limpio").orderBy("anio", "mes")
    hasta_hoy = meses.rowsBetween(Window.unboundedPreceding, 0)
    saldo = {s: F.col(f"{s.lower()}_acumulado") for s in SUCURSALES}
    previo = {s: F.col(f"_{s}_previo") for s in SUCURSALES}

    todo_cero = (F.col("SL") == 0) & (F.col("R1") == 0) & (F.col("R2") == 0)
    con_compra = pivotado.where(~todo_cero)
    inicial = {s: F.lit(None).cast("double") for s in SUCURSALES}
    if apertura is not None:
        inicial = {s: F.col(f"_{s}_inicial") for s in SUCURSALES}
        iniciales = apertura.select(
            F.col("cliente_id_limpio").alias("_cliente"),
            *[F.col(f"{s.lower()}_acumulado").alias(f"_{s}_inicial") for s in SUCURSALES],
        )
        con_compra = con_compra.join(
            iniciales, F.col("cliente_id_limpio").eqNullSafe(F.col("_cliente")), "left"
        )
    con_saldos = con_compra.withColumns(
        {
            f"{s.lower()}_acumulado": (
                F.coalesce(exacto(inicial[s]), F.lit(0)) + F.sum(exacto(s)).over(hasta_hoy)
            ).cast("double")
            for s in SUCURSALES
        }
    ).withColumns(
        {f"_{s}_previo": F.coalesce(F.lag(saldo[s]).over(meses), inicial[s]) for s in SUCURSALES}
    )

    # A first month goes by positive balances; later a branch counts unless it nets to 0.
    tipo = F.when(
        previo["SL"].isNull(), _etiqueta_presencia({s: saldo[s] > 0 for s in SUCURSALES})
    )
    for origen in SUCURSALES:
        otras = [s for s in SUCURSALES if s != origen]
        solo_origen = (
            (saldo[origen] == previo[origen]) & (previo[otras[0]] == 0) & (previo[otras[1]] == 0)
        )
        tipo = tipo.when(solo_origen, _etiqueta_salida(origen, saldo))
    tipo = tipo.otherwise(_etiqueta_presencia({s: saldo[s] != 0 for s in SUCURSALES}))

    return con_saldos.select(
        "cliente_id_limpio",
        "anio",
        "mes",
        *SUCURSALES,
        *[f"{s.lower()}_acumulado" for s in SUCURSALES],
        tipo.alias("tipo_cliente"),
    )


def tipo_migracion_incremental(
    previos: DataFrame, pivotado: DataFrame, inicio: int, desde: int
) -> tuple[DataFrame, DataFrame]:
    """States after an incremental run, equal to a full build, and the customers that were computed anew.

    ``previos``: states of the run before, a stored table.  ``pivotado``: customer-months from
    ``desde`` (``YYYYMM``) on, whole months; ``inicio``: first month of the window now.

    Balances run from the start of the window, so a customer is touched if one of its months
    from ``desde`` on differs or if a month of its left the window.  The first kind goes on
    from the balance it had before ``desde``; the second is computed from its stored monthly
    amounts.  All other rows are passed through: no line of an older month is read.
    """
    montos = ["cliente_id_limpio", "anio", "mes", *SUCURSALES]
    mes = periodo(F.col("anio"), F.col("mes"))
    nuevos = asentar(
        pivotado.where((mes >= desde) & ((F.col("SL") != 0) | (F.col("R1") != 0) | (F.col("R2") != 0))).select(*montos),
        "estados-meses",
    )
    # A customer-month that is the same before and now cancels out.
    signo = previos.where(mes >= desde).select(*montos, F.lit(1).alias("_n"))
    signo = signo.unionByName(nuevos.select(*montos, F.lit(-1).alias("_n")))
    distintos = signo.groupBy(*montos).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    salidos = previos.where(mes < inicio).select("cliente_id_limpio", F.lit(True).alias("_entero"))
    tocados = distintos.select("cliente_id_limpio", F.lit(False).alias("_entero")).unionByName(salidos)
    tocados = tocados.groupBy(F.col("cliente_id_limpio").alias("_tocado")).agg(F.max("_entero").alias("_entero"))
    tocados = asentar(tocados, "estados-tocados")

    def marcadas(filas: DataFrame) -> DataFrame:
        return filas.join(tocados, F.col("cliente_id_limpio").eqNullSafe(F.col("_tocado")), "left")

    viejos = asentar(marcadas(previos.where(mes >= inicio)), "estados-previos")
    ahora = marcadas(nuevos)
    quedan = viejos.where(F.col("_entero").isNull() | (~F.col("_entero") & (mes < desde))).select(*previos.columns)
    enteros = viejos.where(F.col("_entero") & (mes < desde)).select(*montos)
    enteros = enteros.unionByName(ahora.where(F.col("_entero")).select(*montos))
    ultimo = F.max(F.struct("anio", "mes", *[f"{s.lower()}_acumulado" for s in SUCURSALES]))
    saldos = viejos.where(~F.col("_entero") & (mes < desde)).groupBy("cliente_id_limpio").agg(ultimo.alias("u"))
    saldos = saldos.select("cliente_id_limpio", "u.*")
    seguidos = dim_cliente_tipo_migracion(ahora.where(~F.col("_entero")).select(*montos), saldos)
    estados = quedan.unionByName(dim_cliente_tipo_migracion(enteros)).unionByName(seguidos)
    return estados, tocados.select(F.col("_tocado").alias("cliente_id_limpio"))


def int_canibalizacion_migracion_base(pivotado: DataFrame, params: Params) -> DataFrame:
    """Customer-months of the event window, without one-month customers.

    The window ends with the last month in the data, not with the run date.
    ``pivotado`` is read for that month and again for the rows: pass a stored table.
    """
    con_compra = pivotado.where(
        (F.col("SL") > 0) | (F.col("R1") > 0) | (F.col("R2") > 0)
    ).withColumn("periodo", periodo(F.col("anio"), F.col("mes")))
    ultimo = con_compra.agg(F.max(mes_absoluto(F.col("periodo")))).scalar()  # one row, run once
    en_ventana = con_compra.where(
        mes_absoluto(F.col("periodo")) > ultimo - params.canibalizacion_v3_ventana_meses
    )
    cliente = Window.partitionBy("cliente_id_limpio")
    return (
        en_ventana.withColumns(
            {
                "_meses": F.count(F.lit(1)).over(cliente),
                "primer_periodo_ventana": F.min("periodo").over(cliente),
            }
        )
        .where(F.col("_meses") > 1)
        .select(
            "cliente_id_limpio",
            "nombre",
            "anio",
            "mes",
            "periodo",
            *SUCURSALES,
            "primer_periodo_ventana",
            F.when(F.col("periodo") == F.col("primer_periodo_ventana"), F.lit("Nuevo"))
            .otherwise(F.lit("Recurrente"))
            .alias("tipo_global"),
        )
    )


def fct_canibalizacion_evolutivo_cliente(base: DataFrame) -> DataFrame:
    """One row per customer, month and branch with a purchase (single scan).

    ``inline`` instead of ``unpivot`` keeps the partitioning by customer of ``base``.
    """
    por_sucursal = F.array(
        *[F.struct(F.lit(s).alias("sucursal"), F.col(s).alias("monto")) for s in SUCURSALES]
    )
    return (
        base.select("*", F.inline(por_sucursal))
        .where(F.col("monto") > 0)
        .select(
            "cliente_id_limpio",
            "nombre",
            "anio",
            "mes",
            "periodo",
            "sucursal",
            "monto",
            "tipo_global",
            "primer_periodo_ventana",
        )
    )


def dim_cliente_migracion_eventos(evolutivo: DataFrame, params: Params) -> DataFrame:
    """One event per customer and branch reached.

    The row of a customer's first month in a branch *is* the event row: it carries
    month and amount.  What the label asks of the customer's other rows (first branch,
    number of branches, last month in the first branch strictly before this one) are
    windows over the customer, at most one row per month and branch, so the as-of
    look-up needs no self-join and the whole operator shuffles by customer once.
    """
    cliente = Window.partitionBy("cliente_id_limpio")
    antes = cliente.orderBy("periodo").rangeBetween(Window.unboundedPreceding, -1)
    en_sucursal = Window.partitionBy("cliente_id_limpio", "sucursal")

    filas = (
        evolutivo.select("cliente_id_limpio", "sucursal", "periodo", "anio", "mes", "monto")
        .withColumns(
            {
                # earliest month first, ties by branch code
                "_origen": F.min(F.struct("periodo", "sucursal")).over(cliente),
                "_primero": F.min("periodo").over(en_sucursal),
            }
        )
        .withColumns(
            {
                "_total": F.count(F.when(F.col("periodo") == F.col("_primero"), 1)).over(cliente),
                "_ultimo_origen": F.max(
                    F.when(F.col("sucursal") == F.col("_origen.sucursal"), F.col("periodo"))
                ).over(antes),
            }
        )
    )
    unico = F.col("_total") == 1
    eventos = filas.where(
        (F.col("periodo") == F.col("_primero"))
        & (unico | (F.col("sucursal") != F.col("_origen.sucursal")))
    )
    llegada = F.when(F.col("periodo") == F.col("_origen.periodo"), "Nuevo").otherwise("Recurrente")
    ausencia = meses_entre_periodos(F.col("periodo"), F.col("_ultimo_origen"))
    forma = F.when(ausencia > params.canibalizacion_v3_meses_migracion, "Migracion").otherwise("Dual")
    return eventos.select(
        "cliente_id_limpio",
        F.when(unico, "Nuevo - Unico").otherwise(F.concat_ws(" - ", llegada, forma)).alias("tipo_cliente"),
        F.col("_origen.sucursal").alias("local_origen"),
        F.col("sucursal").alias("local_destino"),
        F.col("periodo").alias("periodo_evento"),
        "anio",
        "mes",
        F.col("monto").alias("monto_total"),
    )


def fct_canibalizacion_migracion_resumen(eventos: DataFrame) -> DataFrame:
    return eventos.groupBy("anio", "mes", "tipo_cliente", "local_origen", "local_destino").agg(
        F.count("cliente_id_limpio").alias("cantidad_clientes"),
        F.sum(exacto("monto_total")).cast("double").alias("monto_total"),
    )

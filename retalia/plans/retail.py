"""The whole portfolio over one set of source tables.

Datasets are built on first use and stay lazy, except those that several later steps
read: these are written once to the shared folder (see ``sources.workspace``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from retalia.operators import customers, migration, products, sales, staging, wholesale
from retalia.operators.quality import require_schema
from retalia.params import Params
from retalia.sources.schemas import STG_PRODUCTOS, STG_VENTAS
from retalia.sources.workspace import asentar


class Retail:
    """Named datasets of one run."""

    def __init__(
        self,
        ventas: DataFrame,
        clientes: DataFrame,
        productos: DataFrame,
        sucursales: DataFrame,
        productos_excluidos: DataFrame,
        params: Params,
        mapeo: DataFrame | None = None,
        ventas_36m: DataFrame | None = None,
        elegibles: DataFrame | None = None,
    ):
        """``mapeo``, ``ventas_36m`` and ``elegibles``: stored tables to build on.

        Without them, each dataset is that of a full refresh from the sources.  The
        session is left as it is; ``plans.session.ajustar`` sets what the plans count on.
        """
        self.ventas = ventas
        self.clientes = clientes
        self.productos = productos
        self.sucursales = sucursales
        self.productos_excluidos = productos_excluidos
        self.params = params
        self.mapeo = mapeo
        self.ventas_36m = ventas_36m
        self.elegibles = elegibles

    # -- staging ---------------------------------------------------------------

    @cached_property
    def stg_ventas(self) -> DataFrame:
        return require_schema(staging.stg_ventas(self.ventas), STG_VENTAS)

    @cached_property
    def stg_clientes(self) -> DataFrame:
        return staging.stg_clientes(self.clientes)

    @cached_property
    def stg_productos(self) -> DataFrame:
        return require_schema(staging.stg_productos(self.productos), STG_PRODUCTOS)

    @cached_property
    def stg_clientes_mapeo(self) -> DataFrame:
        return staging.stg_clientes_mapeo(self.int_clientes_mapeo_limpio)

    @cached_property
    def stg_clientes_limpio(self) -> DataFrame:
        return staging.stg_clientes_limpio(self.int_clientes_limpio)

    # -- shared rules ----------------------------------------------------------

    @cached_property
    def int_clientes_normalizados(self) -> DataFrame:
        return customers.int_clientes_normalizados(self.stg_clientes)

    @cached_property
    def int_clientes_mapeo_limpio(self) -> DataFrame:
        if self.mapeo is not None:
            return self.mapeo
        return customers.int_clientes_mapeo_limpio(self.int_clientes_normalizados, self.stg_ventas)

    @cached_property
    def int_clientes_limpio(self) -> DataFrame:
        return customers.int_clientes_limpio(self.int_clientes_normalizados)

    def _elegibles(self, ventas: DataFrame) -> DataFrame:
        return sales.int_ventas_elegibles(
            ventas,
            self.stg_productos,
            self.productos_excluidos,
            self.params,
            None if self.mapeo is None else staging.stg_clientes_mapeo(self.mapeo),
        )

    @cached_property
    def int_ventas_elegibles(self) -> DataFrame:
        return self._elegibles(self.stg_ventas) if self.elegibles is None else self.elegibles

    def elegibles_ventana(self, meses: int) -> DataFrame:
        """Eligible lines of the last closed months; dates are looked at before ids."""
        inicio, fin = self.params.inicio_ventana(meses), self.params.corte
        if self.elegibles is not None:
            return sales.en_ventana(self.elegibles, inicio, fin)
        return self._elegibles(sales.en_ventana(self.stg_ventas, inicio, fin))

    @cached_property
    def int_ventas_12m(self) -> DataFrame:
        return self.elegibles_ventana(self.params.ventana_meses_12m)

    @cached_property
    def _ventas_largas(self) -> DataFrame:
        return self.elegibles_ventana(self.params.meses_ventana_canibalizacion)

    def fijar_elegibles(self) -> Retail:
        """Write the eligible lines of the longest window once, for all that follows.

        Worth it when several marts are built in one run: each of them would scan and
        join the fact again.
        """
        meses = max(self.params.meses_ventana_canibalizacion, self.params.ventana_meses_12m)
        return Retail(
            self.ventas,
            self.clientes,
            self.productos,
            self.sucursales,
            self.productos_excluidos,
            self.params,
            self.mapeo,
            self.ventas_36m,
            asentar(self.elegibles_ventana(meses), "ventas-elegibles"),
        )

    # -- migration between branches --------------------------------------------

    @cached_property
    def fct_ventas_36m(self) -> DataFrame:
        if self.ventas_36m is not None:
            return self.ventas_36m
        return sales.fct_ventas_36m(self._ventas_largas, self.params)

    @cached_property
    def fct_ventas_36m_pivotado(self) -> DataFrame:
        ventas = self.ventas_36m
        if ventas is None:  # one grouping less than through the monthly table
            ventas = sales.lineas_36m(self._ventas_largas, self.params)
        return migration.fct_ventas_36m_pivotado(ventas, self.sucursales, self.stg_clientes_limpio)

    @cached_property
    def _pivotado_escrito(self) -> DataFrame:
        """The pivot, written once for the states and the events."""
        return asentar(self.fct_ventas_36m_pivotado, "ventas-36m-pivotado")

    @cached_property
    def dim_cliente_tipo_migracion(self) -> DataFrame:
        # The states read the pivot once: it is only written for them where the events read it too.
        varios = self.elegibles is not None or "_pivotado_escrito" in self.__dict__
        return migration.dim_cliente_tipo_migracion(self._pivotado_escrito if varios else self.fct_ventas_36m_pivotado)

    @cached_property
    def int_canibalizacion_migracion_base(self) -> DataFrame:
        return migration.int_canibalizacion_migracion_base(self._pivotado_escrito, self.params)

    @cached_property
    def fct_canibalizacion_evolutivo_cliente(self) -> DataFrame:
        return migration.fct_canibalizacion_evolutivo_cliente(self.int_canibalizacion_migracion_base)

    @cached_property
    def dim_cliente_migracion_eventos(self) -> DataFrame:
        return migration.dim_cliente_migracion_eventos(
            self.fct_canibalizacion_evolutivo_cliente, self.params
        )

    @cached_property
    def fct_canibalizacion_migracion_resumen(self) -> DataFrame:
        return migration.fct_canibalizacion_migracion_resumen(self.dim_cliente_migracion_eventos)

    # -- products --------------------------------------------------------------

    @cached_property
    def _medidas_por_producto(self) -> DataFrame:
        return products.medidas_sobre_umbral(self.int_ventas_12m, self.params)

    @cached_property
    def int_top300_kpis(self) -> DataFrame:
        return products.int_top300_kpis(self._medidas_por_producto)

    @cached_property
    def top300_ranking(self) -> DataFrame:
        return products.top300_ranking(self._medidas_por_producto, self.params)

    # -- wholesale customers ---------------------------------------------------

    @cached_property
    def tickets_por_cliente(self) -> DataFrame:
        return wholesale.tickets_por_cliente(self.int_ventas_12m, self.params)

    @cached_property
    def int_mayoristas_umbral_ticket_grande(self) -> DataFrame:
        return wholesale.int_mayoristas_umbral_ticket_grande(self.tickets_por_cliente, self.params)

    @cached_property
    def int_mayoristas_metricas_cliente(self) -> DataFrame:
        return wholesale.int_mayoristas_metricas_cliente(
            self.tickets_por_cliente,
            self.sucursales,
            self.int_mayoristas_umbral_ticket_grande,
            self.params,
        )

    @cached_property
    def dim_clientes_mayoristas(self) -> DataFrame:
        metricas = asentar(self.int_mayoristas_metricas_cliente, "mayoristas-metricas")
        return wholesale.dim_clientes_mayoristas(metricas, self.params)

"""All business parameters in one immutable record."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    """Parameters shared by the operators.

    ``as_of`` is the business date of the run.  Nothing in the package reads the
    clock, so a run can be repeated with the same result.
    """

    as_of: dt.date

    # Defaults of the business rules.
    id_empresa: int = 3
    cliente_prueba: str = "44444401"
    largo_mapeo: int = 50  # width of both ids in the mapping; lines of wider ids are dropped
    categoria_2_excluida: tuple[str, ...] = ("bolsa",)
    categoria_1_excluida: tuple[str, ...] = ("egre", "servi")
    meses_ventana_canibalizacion: int = 36
    dias_lookback_incremental: int = 45
    ventana_meses_12m: int = 12
    top300_peso_ventas: float = 0.40
    top300_peso_tickets: float = 0.30
    top300_peso_unidades_dia: float = 0.20
    top300_peso_unidades_ticket: float = 0.10
    top300_umbral_ventas_gs: float = 5_000_000
    top300_posiciones: int = 300
    mayoristas_pct_grandes_minimo: float = 0.40
    mayoristas_percentil: float = 0.75
    mayoristas_factor_iqr: float = 1.5
    canibalizacion_v3_ventana_meses: int = 24
    canibalizacion_v3_meses_migracion: int = 3
    max_ids_por_cliente: int = 20

    # -- closed-month windows, as literals that reach the Parquet scan ----------

    @property
    def corte(self) -> dt.date:
        """First day of the month of ``as_of``: exclusive end of every window."""
        return self.as_of.replace(day=1)

    def inicio_ventana(self, meses: int) -> dt.date:
        """First day of the month ``meses`` months before :attr:`corte`."""
        n = self.corte.year * 12 + self.corte.month - 1 - meses
        return dt.date(n // 12, n % 12 + 1, 1)

    @property
    def inicio_lookback(self) -> dt.date:
        """First day re-read by an incremental run (inclusive)."""
        return self.as_of - dt.timedelta(days=self.dias_lookback_incremental)

    @property
    def inicio_lookback_mes(self) -> dt.date:
        """The look-back moved to the start of its month.

        The monthly table is replaced month by month, so a month has to be read
        whole: a look-back that starts mid-month would overwrite it by a part.
        """
        return self.inicio_lookback.replace(day=1)

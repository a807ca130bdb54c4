"""Data checks.  A check returns the offending rows; no rows means it passed."""

from __future__ import annotations

import datetime as dt
import warnings

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retalia.operators.migration import SUCURSALES, TIPOS_CLIENTE, TIPOS_EVENTO
from retalia.operators.wholesale import NIVELES
from retalia.params import Params
from retalia.sources.workspace import asentar


class ContractError(ValueError):
    """A dataset does not have the columns or types it promises."""


class CheckError(ValueError):
    """A check whose failure stops the run has failed."""


def check_schema(df: DataFrame, contrato: T.StructType) -> DataFrame:
    """Columns that are missing, unexpected or of another type."""
    hay = {f.name: f.dataType.simpleString().split(" collate ")[0] for f in df.schema}
    debe = {f.name: f.dataType.simpleString() for f in contrato}
    filas = [
        (c, debe.get(c), hay.get(c))
        for c in [*debe, *[c for c in hay if c not in debe]]
        if debe.get(c) != hay.get(c)
    ]
    return df.sparkSession.createDataFrame(
        filas, "columna string, tipo_esperado string, tipo_real string"
    )


def require_schema(df: DataFrame, contrato: T.StructType) -> DataFrame:
    """``df`` itself, or :class:`ContractError`; looks at the schema only."""
    hay = {f.name: f.dataType.simpleString().split(" collate ")[0] for f in df.schema}
    debe = {f.name: f.dataType.simpleString() for f in contrato}
    malas = sorted(c for c in {*hay, *debe} if hay.get(c) != debe.get(c))
    if malas:
        raise ContractError(f"columns differ from the contract: {', '.join(malas)}")
    return df


def check_not_null(df: DataFrame, *columnas: str) -> DataFrame:
    """NULLs per column, all columns in one pass; only columns that have some."""
    nulos = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columnas])
    return nulos.unpivot([], list(columnas), "columna", "nulos").where(F.col("nulos") > 0)


def check_unique(df: DataFrame, columna: str) -> DataFrame:
    """Values that occur more than once (NULL is no value)."""
    return (
        df.where(F.col(columna).isNotNull())
        .groupBy(columna)
        .agg(F.count(F.lit(1)).alias("repeticiones"))
        .where(F.col("repeticiones") > 1)
    )


def check_accepted_values(df: DataFrame, columna: str, valores: list[str]) -> DataFrame:
    """Values outside the list with their frequency (NULL is no value)."""
    return (
        df.where(F.col(columna).isNotNull() & ~F.col(columna).isin(*valores))
        .groupBy(columna)
        .agg(F.count(F.lit(1)).alias("filas"))
    )


def check_id_collisions(mapeo: DataFrame, limite: int = 20) -> DataFrame:
    """Clean ids that merge more than ``limite`` raw ids."""
    return ids_por_cliente(mapeo).where(F.col("cantidad_ids_origen") > limite)


def ids_por_cliente(mapeo: DataFrame) -> DataFrame:
    """Raw ids behind each clean id."""
    return mapeo.groupBy("cliente_id_limpio").agg(
        F.countDistinct("cliente_id").alias("cantidad_ids_origen")
    )


def check_freshness(ventas: DataFrame, as_of: dt.date) -> DataFrame:
    """One row when the last closed month is not loaded to its last day (a warning)."""
    ultimo_dia = Params(as_of=as_of).corte - dt.timedelta(days=1)
    return (
        ventas.agg(F.max("fecha_venta").alias("ultima"))
        .where(F.col("ultima") < F.lit(ultimo_dia))
        .select(F.lit(1).alias("ventas_desactualizada"))
    )


# The column checks declared for each dataset.
REGLAS: dict[str, dict] = {
    "stg_ventas": {"no_nulas": ["cliente_id", "producto_id"]},
    "stg_clientes": {"no_nulas": ["cliente_id"]},
    "stg_productos": {"no_nulas": ["producto_id"], "unicas": ["producto_id"]},
    "stg_clientes_mapeo": {"no_nulas": ["cliente_id", "cliente_id_limpio"]},
    "stg_clientes_limpio": {"no_nulas": ["cliente_id_limpio"]},
    "int_clientes_normalizados": {"no_nulas": ["cliente_id"]},
    "int_clientes_mapeo_limpio": {
        "no_nulas": ["cliente_id", "cliente_id_limpio"],
        "unicas": ["cliente_id"],
    },
    "int_clientes_limpio": {"no_nulas": ["cliente_id_limpio"], "unicas": ["cliente_id_limpio"]},
    "int_ventas_elegibles": {"no_nulas": ["producto_id", "pdv_id"]},
    "int_ventas_12m": {"no_nulas": ["producto_id"]},
    "fct_ventas_36m": {
        "no_nulas": ["cliente_id_limpio", "producto_id", "pdv_id", "anio", "mes", "total_ventas"]
    },
    "fct_ventas_36m_pivotado": {"no_nulas": ["cliente_id_limpio", "anio", "mes"]},
    "dim_cliente_tipo_migracion": {
        "no_nulas": ["cliente_id_limpio", "tipo_cliente"],
        "valores": {"tipo_cliente": TIPOS_CLIENTE},
    },
    "int_canibalizacion_migracion_base": {
        "no_nulas": ["cliente_id_limpio", "tipo_global"],
        "valores": {"tipo_global": ["Nuevo", "Recurrente"]},
    },
    "fct_canibalizacion_evolutivo_cliente": {
        "no_nulas": ["cliente_id_limpio", "sucursal", "monto"],
        "valores": {"sucursal": SUCURSALES},
    },
    "dim_cliente_migracion_eventos": {
        "no_nulas": ["cliente_id_limpio", "tipo_cliente", "local_origen", "local_destino"],
        "valores": {
            "tipo_cliente": TIPOS_EVENTO,
            "local_origen": SUCURSALES,
            "local_destino": SUCURSALES,
        },
    },
    "fct_canibalizacion_migracion_resumen": {
        "no_nulas": ["anio", "mes", "tipo_cliente", "cantidad_clientes"]
    },
    "int_top300_kpis": {"no_nulas": ["ambito", "producto_id"]},
    "top300_ranking": {"no_nulas": ["ambito", "producto_id", "posicion", "puntaje_final"]},
    "int_mayoristas_metricas_cliente": {"no_nulas": ["ambito", "cliente_id_limpio"]},
    "dim_clientes_mayoristas": {
        "no_nulas": ["ambito", "cliente_id_limpio", "nivel_mayorista"],
        "valores": {"nivel_mayorista": NIVELES},
    },
}


# Severity of the two checks that are no column checks; column checks are errors.
SEVERIDAD = {"ids_por_cliente": "error", "ventas_desactualizada": "warn"}


def _contadores(nombre: str) -> dict[str, Column]:
    """Test name to the condition of a row that fails it."""
    reglas = REGLAS[nombre]
    return {
        **{f"not_null:{c}": F.col(c).isNull() for c in reglas.get("no_nulas", [])},
        **{
            f"accepted_values:{c}": F.col(c).isNotNull() & ~F.col(c).isin(*vs)
            for c, vs in reglas.get("valores", {}).items()
        },
    }


def _columnas(nombre: str) -> list[str]:
    reglas = REGLAS[nombre]
    return list(dict.fromkeys([*reglas.get("no_nulas", []), *reglas.get("valores", {}), *reglas.get("unicas", [])]))


def revisar(nombre: str, df: DataFrame) -> DataFrame:
    """Run the declared checks of a dataset: one row per check that fails.

    Only the checked columns are read.  NULL and value checks share one aggregate; a
    dataset is written for that only if a ``unique`` check reads it a second time.
    """
    unicas = REGLAS[nombre].get("unicas", [])
    df = df.select(*_columnas(nombre))
    if unicas:
        df = asentar(df, f"revision-{nombre}")
    contadores = _contadores(nombre)
    fallas = df.agg(*[F.count_if(cond).alias(n) for n, cond in contadores.items()]).unpivot(
        [], list(contadores), "prueba", "fallas"
    )
    for c in unicas:
        fallas = fallas.unionByName(
            check_unique(df, c).agg(F.count(F.lit(1)).alias("fallas")).withColumn("prueba", F.lit(f"unique:{c}"))
        )
    return _informe(fallas, nombre, "error")


class Revision:
    """Checks of a run that come from the writes of the run itself.

    A dataset's NULL and value checks are counted by ``DataFrame.observe`` while it is
    written: nothing is computed, and no dataset read, for the checks alone.
    ``fallas`` collects (dataset, test, severity, failing rows) of what failed.
    """

    def __init__(self) -> None:
        self.fallas: list[tuple[str, str, str, int]] = []

    def escribir(self, nombre: str, df: DataFrame) -> DataFrame:
        """Write a dataset that later ones are built on, checked on the way; the written table."""
        observada, vista = self._observar(nombre, df)
        escrita = asentar(observada, nombre)
        self._anotar(nombre, vista, escrita)
        return escrita

    def mirar(self, nombre: str, df: DataFrame) -> None:
        """Check a dataset that nothing is built on; its rows are computed once and not kept."""
        df = df.select(*_columnas(nombre))
        if REGLAS[nombre].get("unicas"):
            self.escribir(nombre, df)
            return
        observada, vista = self._observar(nombre, df)
        observada.write.format("noop").mode("overwrite").save()
        self._anotar(nombre, vista, None)

    def informar(self, filas: DataFrame) -> None:
        """Add rows of a report of another check."""
        self.fallas += [tuple(r) for r in filas.select("conjunto", "prueba", "severidad", "fallas").collect()]

    def exigir(self) -> None:
        """Stop on a failed check that is an error; only warn of the others."""
        for conjunto, prueba, severidad, n in self.fallas:
            if severidad != "error":
                warnings.warn(f"{conjunto}: {prueba} fails in {n} rows", stacklevel=2)
        errores = [f"{c}: {p} fails in {n} rows" for c, p, s, n in self.fallas if s == "error"]
        if errores:
            raise CheckError("; ".join(errores))

    def _observar(self, nombre: str, df: DataFrame) -> tuple[DataFrame, Observation]:
        vista = Observation()
        contadores = {f"p{i}": cond for i, cond in enumerate(_contadores(nombre).values())}
        return df.observe(vista, *[F.count_if(cond).alias(n) for n, cond in contadores.items()]), vista

    def _anotar(self, nombre: str, vista: Observation, escrita: DataFrame | None) -> None:
        contadas = vista.get
        for i, prueba in enumerate(_contadores(nombre)):
            if contadas.get(f"p{i}"):
                self.fallas.append((nombre, prueba, "error", contadas[f"p{i}"]))
        for c in REGLAS[nombre].get("unicas", []):
            repetidas = check_unique(escrita, c).count()
            if repetidas:
                self.fallas.append((nombre, f"unique:{c}", "error", repetidas))


def _informe(fallas: DataFrame, conjunto: str, severidad: str) -> DataFrame:
    return fallas.where(F.col("fallas") > 0).select(
        F.lit(conjunto).alias("conjunto"), "prueba", F.lit(severidad).alias("severidad"), "fallas"
    )


def revisar_colisiones(mapeo: DataFrame, limite: int) -> DataFrame:
    """:func:`check_id_collisions` as a row of the report."""
    fallas = check_id_collisions(mapeo, limite).agg(F.count(F.lit(1)).alias("fallas"))
    fallas = fallas.withColumn("prueba", F.lit("ids_por_cliente"))
    return _informe(fallas, "int_clientes_mapeo_limpio", SEVERIDAD["ids_por_cliente"])


def revisar_actualidad(ventas: DataFrame, as_of: dt.date) -> DataFrame:
    """:func:`check_freshness` as a row of the report."""
    fallas = check_freshness(ventas, as_of).agg(F.count(F.lit(1)).alias("fallas"))
    fallas = fallas.withColumn("prueba", F.lit("ventas_desactualizada"))
    return _informe(fallas, "ventas", SEVERIDAD["ventas_desactualizada"])

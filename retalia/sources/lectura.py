"""Typed reading of dirty text: rows that fit the declared schema, and why the others do not.

Nothing is dropped without a trace: every row is either accepted, with all of its columns
typed, or has at least one rejection (rule, column, the text that broke it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPTA = "_linea_corrupta"  # the whole line, where it has not the declared columns


def leer_csv_texto(spark: SparkSession, ruta: str, esquema: T.StructType, encabezado: bool = True) -> DataFrame:
    """A CSV with the declared columns as text, and ``CORRUPTA``: lines with too few or too many columns."""
    texto = T.StructType([T.StructField(f.name, T.StringType()) for f in esquema])
    return (
        spark.read.schema(texto.add(CORRUPTA, T.StringType()))
        .option("header", encabezado)
        .option("enforceSchema", True)
        .option("escape", '"')  # a quote inside quotes is written twice
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPTA)
        .csv(ruta)
    )


def _rechazos(df: DataFrame, esquema: T.StructType, requeridas: list[str]) -> Column:
    """Array of the rejections of a row."""

    def uno(regla: str, columna: str, valor: Column) -> Column:
        return F.struct(F.lit(regla).alias("regla"), F.lit(columna).alias("columna"), valor.cast("string").alias("valor"))

    casos = []
    entera = F.lit(True)
    if CORRUPTA in df.columns:
        entera = F.col(CORRUPTA).isNull()
        casos.append(F.when(~entera, uno("corrupta", CORRUPTA, F.col(CORRUPTA))))
    for f in esquema:
        c = F.col(f.name)
        tipo = f.dataType.simpleString()
        casos.append(F.when(entera & c.isNotNull() & c.try_cast(f.dataType).isNull(), uno(f"tipo:{tipo}", f.name, c)))
        if f.name in requeridas:
            casos.append(F.when(entera & c.isNull(), uno("requerida", f.name, c)))
    return F.filter(F.array(*casos), lambda x: x.isNotNull())


def _cumple(df: DataFrame, esquema: T.StructType, requeridas: list[str]) -> Column:
    """Whether a row has no rejection: plain conditions, without building an array for each row."""
    bien = F.col(CORRUPTA).isNull() if CORRUPTA in df.columns else F.lit(True)
    for f in esquema:
        c = F.col(f.name)
        con_tipo = c.try_cast(f.dataType).isNotNull()
        bien &= con_tipo if f.name in requeridas else c.isNull() | con_tipo
    return bien


def separar(df: DataFrame, esquema: T.StructType, requeridas: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted rows under ``esquema``, and the rejections: ``regla``, ``columna``, ``valor``, ``fila`` (JSON).

    ``df`` holds the columns of ``esquema`` as text.  A value that is there but has not its
    type breaks ``tipo:<type>``, a missing one of ``requeridas`` breaks ``requerida``, a line
    that is no row breaks ``corrupta``.  A row may break several rules; it is then rejected
    once for each.  Both outputs are narrow passes over the rows.
    """
    nombres = [f.name for f in esquema]
    con = df.withColumn("_rechazos", _rechazos(df, esquema, requeridas or []))
    aceptadas = df.where(_cumple(df, esquema, requeridas or [])).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in esquema])
    rechazadas = con.where(F.size("_rechazos") > 0).select(
        F.explode("_rechazos").alias("_r"), F.to_json(F.struct(*nombres)).alias("fila")
    )
    return aceptadas, rechazadas.select("_r.*", "fila")


def resumen_de_rechazos(df: DataFrame, esquema: T.StructType, requeridas: list[str] | None = None) -> DataFrame:
    """Rows by rule and column, in one pass; accepted rows under the rule ``aceptada``.

    A row that breaks several rules counts under each of them.
    """
    rechazos = _rechazos(df, esquema, requeridas or [])
    nada = F.array(F.struct(F.lit("aceptada").alias("regla"), F.lit(None).cast("string").alias("columna"), F.lit(None).cast("string").alias("valor")))
    marcadas = df.select(F.explode(F.when(F.size(rechazos) == 0, nada).otherwise(rechazos)).alias("r"))
    return marcadas.groupBy("r.regla", "r.columna").agg(F.count(F.lit(1)).alias("filas"))

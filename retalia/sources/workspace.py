"""Intermediate tables in the folder that the cluster shares.

A dataset that several later steps read is written once and read back: the lineage is
cut, a lost executor costs nothing that was already written, and the next steps plan
with real file sizes (so a broadcast is chosen from a measured size, never assumed).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_locales: dict[str, str] = {}


def carpeta_compartida(spark: SparkSession) -> str:
    """Folder named by the session; a temporary one only in local mode."""
    carpeta = spark.conf.get(_CONF, None)
    if carpeta:
        return carpeta.rstrip("/")
    maestro = spark.conf.get("spark.master", "")
    if not maestro.startswith("local"):
        raise RuntimeError(f"set {_CONF} to a folder that all executors share")
    if maestro not in _locales:
        _locales[maestro] = tempfile.mkdtemp(prefix="retalia-")
    return _locales[maestro]


def asentar(df: DataFrame, nombre: str) -> DataFrame:
    """Write ``df`` to a fresh path in the shared folder and read it back."""
    spark = df.sparkSession
    ruta = f"{carpeta_compartida(spark)}/retalia/{nombre}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(ruta)
    return spark.read.schema(df.schema).parquet(ruta)

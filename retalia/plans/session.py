"""Session settings the plans count on.  All are SQL settings of the session."""

from __future__ import annotations

from pyspark.sql import SparkSession

AJUSTES = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A semi join of the fact on a hot product is followed by a grouping that could
    # reuse its partitioning; splitting the hot partition is worth the extra shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Ids and names take some eight times as much in memory as in a file: what is broadcast
    # by estimate must fit the driver.
    "spark.sql.sources.fileCompressionFactor": "8.0",
}


def ajustar(spark: SparkSession) -> SparkSession:
    for clave, valor in AJUSTES.items():
        if spark.conf.get(clave, None) != valor:
            spark.conf.set(clave, valor)
    return spark

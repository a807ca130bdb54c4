"""What several operators of the subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retalia.sources.workspace import asentar as stored

__all__ = ["handing_back", "held_out", "set_aside", "stored", "table", "text_batches", "words"]

Work = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

BATCH_BYTES = 4 << 20  # of what Spark hands to Python at once; a row larger than that comes alone


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Whole texts, or arrays of them, go to Python by bytes: ten thousand rows may be a whole partition.

    A batch stands in memory several times: Spark's buffer, Arrow's table, and Python's objects.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def handing_back(work: Work) -> Work:
    """``work`` for ``mapInPandas``; its worker gives free memory back to the system at the end of each task.

    Workers are reused, and more of them wait than work: what each keeps of its largest task adds up.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
            trim(0)

    return run


def words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case; blanks are the bytes 20 and 09 to 0D (hex)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def held_out(doc_id: Column) -> Column:
    """The quarter of the rows kept away from training; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` without names that begin with an underscore, which operators use inside, and the way back."""
    names = {c: f"aside{i}{c}" for i, c in enumerate(df.columns) if c.startswith("_")}
    return df.withColumnsRenamed(names), {new: c for c, new in names.items()}

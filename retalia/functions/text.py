"""Text comparison without case and accents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CI_AI = "UNICODE_CI_AI"


def sin_caso_ni_acento(col: Column) -> Column:
    """The column under a collation in which ``BÓLSA`` equals ``bolsa``."""
    return F.collate(col, CI_AI)


def contiene(col: Column, texto: str) -> Column:
    """Substring test without case and accents; NULL counts as empty text."""
    return F.contains(
        sin_caso_ni_acento(F.coalesce(col, F.lit(""))), sin_caso_ni_acento(F.lit(texto))
    )

"""Cleaning of customer identifiers and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed from an identifier after upper-casing.
LETRAS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANCOS = " \t\n\r"

# Accented capitals of a name and their plain letters.
CON_ACENTO = "ÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÄËÏÖÜÃÕÑÇ"
SIN_ACENTO = "AEIOUAEIOUAEIOUAEIOUAONC"


def limpiar_id(col: Column) -> Column:
    """Upper-case and drop blanks, tabs, line ends and the letters A to Z."""
    return F.translate(F.upper(col), LETRAS + BLANCOS, "")


def recortar_basura_extremos(col: Column) -> Column:
    """Keep the text from its first to its last digit; ``''`` when it has none."""
    return F.regexp_extract(col, r"(?s)[0-9](?:.*[0-9])?", 0)


# What follows the document number: everything from the first hyphen on; where there is
# none, from the first asterisk on; or else a last symbol with exactly one digit behind.
_VERIFICADOR = r"(?s)-.*|\*[^-]*\z|[^0-9][0-9]\z"


def _sin_verificador(col: Column) -> Column:
    """One expression that names its input once: it is evaluated per sale line."""
    return F.regexp_replace(col, _VERIFICADOR, "")


def derivar_cliente_id_limpio(col: Column) -> Column:
    """Drop the check digit of a cleaned id; NULL when nothing is left.

    A hyphen wins over an asterisk wherever they stand.
    """
    return F.nullif(_sin_verificador(col), F.lit(""))


def cliente_id_clean(col: Column) -> Column:
    return recortar_basura_extremos(limpiar_id(col))


def cliente_id_limpio(col: Column) -> Column:
    """Raw id to clean id in one expression (a pure function of the raw id)."""
    return derivar_cliente_id_limpio(cliente_id_clean(col))


def cliente_id_limpio_o_vacio(col: Column) -> Column:
    """Like :func:`cliente_id_limpio`, with ``''`` in place of NULL for ids without digits."""
    return _sin_verificador(cliente_id_clean(col))


def nombre_limpio(col: Column) -> Column:
    """Upper-case, no accents, no bars, single blanks.

    The original is an SQL function whose body is not published; this is the
    documented behaviour, kept in one place so that it can be replaced.
    """
    plano = F.translate(F.upper(col), CON_ACENTO + "|", SIN_ACENTO)
    return F.trim(F.regexp_replace(plano, r"\s+", " "))

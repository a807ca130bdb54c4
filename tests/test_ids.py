import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retalia.functions import ids

# Raw id, cleaned id, clean customer id.
CASOS = [
    ("444443-2", "444443-2", "444443"),
    ("444443", "444443", "444443"),
    ("3891542,1", "3891542,1", "3891542"),
    ("2546408_6", "2546408_6", "2546408"),
    ("881511/9", "881511/9", "881511"),
    ("|1700599-0", "1700599-0", "1700599"),
    ("3253286|", "3253286", "3253286"),
    ("ABRAHAM", "", None),
    ("SIN NOMBRE", "", None),
    ("44444401-7", "44444401-7", "44444401"),
    ("12*34-5", "12*34-5", "12*34"),
    ("12-34*5", "12-34*5", "12"),
    ("12*34", "12*34", "12"),
    ("12,34", "12,34", "12,34"),
    ("1,2,3", "1,2,3", "1,2"),
    ("7", "7", "7"),
    (" ci 55 01 ", "5501", "5501"),
    ("55\t\r\n01", "5501", "5501"),
    ("5Ñ5-1", "5Ñ5-1", "5Ñ5"),
    ("", "", None),
    (None, None, None),
]


def test_golden(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASOS)], "i int, id string")
    filas = {
        r.i: (r.clean, r.limpio)
        for r in df.select(
            "i",
            ids.cliente_id_clean(F.col("id")).alias("clean"),
            ids.cliente_id_limpio(F.col("id")).alias("limpio"),
        ).collect()
    }
    assert filas == {i: (c[1], c[2]) for i, c in enumerate(CASOS)}


def _esperado(crudo: str) -> str | None:
    """The rules, one character at a time."""
    texto = "".join(c for c in crudo.upper() if c not in ids.LETRAS + ids.BLANCOS)
    digitos = [i for i, c in enumerate(texto) if c in "0123456789"]
    if not digitos:
        return None
    texto = texto[digitos[0] : digitos[-1] + 1]
    if "-" in texto:
        texto = texto.split("-")[0]
    elif "*" in texto:
        texto = texto.split("*")[0]
    elif len(texto) >= 2 and texto[-2] not in "0123456789":
        texto = texto[:-2]
    return texto or None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123459-*,_/|. aZñ\t\n", max_size=9), min_size=300, max_size=300))
def test_rules_on_random_ids(spark, crudos):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(crudos)], "i int, id string")
    hay = {r.i: r.l for r in df.select("i", ids.cliente_id_limpio(F.col("id")).alias("l")).collect()}
    assert hay == {i: _esperado(c) for i, c in enumerate(crudos)}


@pytest.mark.parametrize(
    ("crudo", "limpio"),
    [("  josé   núñez ", "JOSE NUNEZ"), ("A|B", "AB"), ("Ana\t\nPaz", "ANA PAZ"), (None, None)],
)
def test_name(spark, crudo, limpio):
    df = spark.createDataFrame([(crudo,)], "n string")
    assert df.select(ids.nombre_limpio(F.col("n")).alias("x")).first().x == limpio

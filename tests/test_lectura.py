import datetime as dt

from test_sales import linea, retail

from retalia.operators.totales import ventas_por_nivel
from retalia.sources import lectura, schemas


def _filas(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_rows_are_accepted_or_rejected_with_a_reason(spark, tmp_path):
    (tmp_path / "v.csv").write_text(
        "cliente_id,producto_id,pdv_id,fecha_venta,venta_gs,unidades,timbrado,factura_nro\n"
        "100,P,3,2024-06-03,10.5,1,1,1\n"
        "100,P,3,03/06/2024,10.5,uno,1,1\n"  # two rules
        ",P,3,2024-06-03,,1,1,1\n"  # an amount may be missing, the customer not
        "100,P,3\n"
        "100,P,3,2024-06-03,1,1,1,1,9,9\n"
        '"1,00","P ""x""",3,2024-06-30,1e2,2,,\n'
    )
    texto = lectura.leer_csv_texto(spark, str(tmp_path / "v.csv"), schemas.VENTAS)
    aceptadas, rechazadas = lectura.separar(texto, schemas.VENTAS, ["cliente_id"])
    assert aceptadas.schema == schemas.VENTAS
    assert _filas(aceptadas) == [
        ("1,00", 'P "x"', "3", dt.date(2024, 6, 30), 100.0, 2.0, None, None),
        ("100", "P", "3", dt.date(2024, 6, 3), 10.5, 1.0, "1", "1"),
    ]
    assert [r[:3] for r in _filas(rechazadas)] == [
        ("corrupta", "_linea_corrupta", "100,P,3"),
        ("corrupta", "_linea_corrupta", "100,P,3,2024-06-03,1,1,1,1,9,9"),
        ("requerida", "cliente_id", None),
        ("tipo:date", "fecha_venta", "03/06/2024"),
        ("tipo:double", "unidades", "uno"),
    ]
    resumen = lectura.resumen_de_rechazos(texto, schemas.VENTAS, ["cliente_id"])
    assert _filas(resumen) == [
        ("aceptada", None, 2),
        ("corrupta", "_linea_corrupta", 2),
        ("requerida", "cliente_id", 1),
        ("tipo:date", "fecha_venta", 1),
        ("tipo:double", "unidades", 1),
    ]


def test_a_null_point_of_sale_is_not_the_total(spark):
    r = retail(spark, [linea(pdv=None, gs=1.0), linea(pdv="3", gs=2.0), linea(pdv="3", gs=4.0), linea(pdv="5", gs=-7.0)])
    got = {(n, v, p): (k, g) for n, v, p, k, _, g in _filas(ventas_por_nivel(r.int_ventas_elegibles))}
    assert got == {
        ("pdv_producto", None, "P"): (1, 1.0), ("pdv_producto", "3", "P"): (2, 6.0), ("pdv_producto", "5", "P"): (1, -7.0),
        ("pdv", None, None): (1, 1.0), ("pdv", "3", None): (2, 6.0), ("pdv", "5", None): (1, -7.0),
        ("producto", None, "P"): (4, 0.0), ("total", None, None): (4, 0.0),
    }
    assert _filas(ventas_por_nivel(r.int_ventas_elegibles.limit(0))) == []

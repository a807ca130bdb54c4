import datetime as dt

import pytest
from test_sales import linea, retail, ventas

from retalia import Params
from retalia.operators import diagnostics, quality
from retalia.sources import schemas, seeds, workspace


@pytest.fixture
def df(spark):
    return spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), (None, 2, None)], "k string, n int, v string")


def test_checks(df):
    assert {tuple(r) for r in quality.check_not_null(df, "k", "n", "v").collect()} == {("k", 1), ("n", 1), ("v", 1)}
    assert quality.check_not_null(df.where("k is not null"), "k").count() == 0
    assert [tuple(r) for r in quality.check_unique(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.check_accepted_values(df, "v", ["x"]).collect()] == [("y", 1)]


def test_schema_contract(df, spark):
    s = retail(spark, [linea()]).stg_ventas
    assert quality.check_schema(s, schemas.STG_VENTAS).count() == 0
    assert quality.check_schema(retail(spark, []).stg_productos, schemas.STG_PRODUCTOS).count() == 0
    roto = s.withColumn("unidades", s.unidades.cast("int")).drop("pdv_id").withColumn("extra", s.venta_gs)
    assert {tuple(r) for r in quality.check_schema(roto, schemas.STG_VENTAS).collect()} == {
        ("unidades", "double", "int"), ("pdv_id", "string", None), ("extra", None, "double"),
    }
    with pytest.raises(quality.ContractError, match="extra, pdv_id, unidades"):
        quality.require_schema(roto, schemas.STG_VENTAS)


@pytest.mark.parametrize(("ultima", "filas"), [(dt.date(2024, 6, 30), 0), (dt.date(2024, 6, 29), 1)])
def test_freshness(spark, ultima, filas):
    v = ventas(spark, [linea(fecha=ultima), linea(fecha=dt.date(2024, 1, 1))])
    assert quality.check_freshness(v, dt.date(2024, 7, 15)).count() == filas


def test_collisions(spark):
    mapeo = spark.createDataFrame(
        [(f"r{i}", "1") for i in range(21)] + [(f"s{i}", "2") for i in range(20)], schemas.CLIENTES_MAPEO
    )
    assert [tuple(r) for r in quality.check_id_collisions(mapeo).collect()] == [("1", 21)]
    assert [tuple(r) for r in diagnostics.collision_histogram(mapeo).collect()] == [(21, 1), (20, 1)]


def test_declared_checks(spark):
    tipos = spark.createDataFrame(
        [("a", "Cliente SL"), ("a", None), (None, "Otra cosa")], "cliente_id_limpio string, tipo_cliente string"
    )
    assert {tuple(r)[1:] for r in quality.revisar("dim_cliente_tipo_migracion", tipos).collect()} == {
        ("not_null:cliente_id_limpio", "error", 1), ("not_null:tipo_cliente", "error", 1),
        ("accepted_values:tipo_cliente", "error", 1),
    }
    limpio = spark.createDataFrame([("1",), ("1",)], "cliente_id_limpio string")
    assert [tuple(r) for r in quality.revisar("int_clientes_limpio", limpio).collect()] == [
        ("int_clientes_limpio", "unique:cliente_id_limpio", "error", 1)
    ]


def test_singular_checks_carry_their_severity(spark):
    mapeo = spark.createDataFrame([("r1", "1"), ("r2", "1")], schemas.CLIENTES_MAPEO)
    assert [tuple(r) for r in quality.revisar_colisiones(mapeo, 1).collect()] == [
        ("int_clientes_mapeo_limpio", "ids_por_cliente", "error", 1)
    ]
    ventas = spark.createDataFrame([(dt.date(2024, 5, 30),)], "fecha_venta date")
    assert [tuple(r) for r in quality.revisar_actualidad(ventas, dt.date(2024, 6, 15)).collect()] == [
        ("ventas", "ventas_desactualizada", "warn", 1)
    ]
    assert quality.revisar_actualidad(ventas, dt.date(2024, 5, 15)).count() == 0


def test_seeds_and_csv(spark, tmp_path):
    assert seeds.productos_excluidos(spark).count() == 13
    (tmp_path / "s.csv").write_text("pdv_id,sucursal_codigo,sucursal_nombre\n03,SL,San Lorenzo\n")
    leido = schemas.leer_csv(spark, str(tmp_path / "s.csv"), schemas.SUCURSALES)
    assert leido.first().pdv_id == "03" and leido.schema == schemas.SUCURSALES


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    previa = spark.conf.get("spark.checkpoint.dir")
    assert workspace.carpeta_compartida(spark) == previa
    tabla = workspace.asentar(spark.range(3).toDF("x"), "prueba")
    assert tabla.count() == 3 and tabla.inputFiles()[0].startswith(f"file://{previa}/retalia/prueba-")


def test_lookback_and_windows():
    p = Params(as_of=dt.date(2024, 3, 31))
    assert p.corte == dt.date(2024, 3, 1)
    assert p.inicio_ventana(12) == dt.date(2023, 3, 1) and p.inicio_ventana(36) == dt.date(2021, 3, 1)
    assert p.inicio_lookback == dt.date(2024, 2, 15) and p.inicio_lookback_mes == dt.date(2024, 2, 1)


def test_checks_come_from_the_write(spark):
    tipos = spark.createDataFrame(
        [("a", "Cliente SL"), ("a", None), (None, "Otra cosa")], "cliente_id_limpio string, tipo_cliente string"
    )
    esperadas = {tuple(r) for r in quality.revisar("dim_cliente_tipo_migracion", tipos).collect()}
    for modo in ("escribir", "mirar"):
        rev = quality.Revision()
        escrita = getattr(rev, modo)("dim_cliente_tipo_migracion", tipos.repartition(2))
        assert set(rev.fallas) == esperadas
        if modo == "escribir":
            assert escrita.count() == 3 and escrita.inputFiles()
    rev = quality.Revision()
    rev.mirar("int_clientes_limpio", spark.createDataFrame([("1",), ("1",), (None,)], "cliente_id_limpio string"))
    rev.mirar("dim_cliente_tipo_migracion", tipos.limit(0))
    rev.escribir("dim_cliente_tipo_migracion", tipos.where("false"))
    assert set(rev.fallas) == {
        ("int_clientes_limpio", "not_null:cliente_id_limpio", "error", 1),
        ("int_clientes_limpio", "unique:cliente_id_limpio", "error", 1),
    }


def test_errors_stop_a_run_and_warnings_do_not(spark):
    rev = quality.Revision()
    rev.exigir()
    ventas = spark.createDataFrame([(dt.date(2024, 5, 30),)], "fecha_venta date")
    rev.informar(quality.revisar_actualidad(ventas, dt.date(2024, 6, 15)))
    with pytest.warns(UserWarning, match="ventas_desactualizada"):
        rev.exigir()
    rev.mirar("stg_ventas", spark.createDataFrame([(None, "p")], "cliente_id string, producto_id string"))
    with pytest.warns(UserWarning), pytest.raises(quality.CheckError, match="stg_ventas: not_null:cliente_id fails in 1 rows"):
        rev.exigir()

"""A small raw data set with planted defects through all layers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.plans import gold as G
from lakeops.plans import registry
from lakeops.plans import silver as S
from lakeops.operators.reconcile import quarantine_report
from lakeops.plans.exports import export_gold

AS_OF = dt.date(2024, 6, 1)


def make(spark, ddl, *data):
    return spark.createDataFrame(list(data), ddl)


@pytest.fixture(scope="module")
def raw(spark):
    return {
        "donaciones": make(
            spark,
            "id_donacion long, id_donante double, id_caso double, fecha_donacion string, monto string, "
            "medio_pago string, estado string, created_at string, last_modified_at string, y int, m string",
            (1, 1.0, None, "2024-01-15T00:00:00", "100.0", "Transfer", "Aprobada", None, "2024-01-15", 2024, "01"),
            (1, 1.0, None, "2024-01-15T00:00:00", "150.0", "Transfer", "Aprobada", None, "2024-01-16", 2024, "01"),
            (2, None, 1.0, "2024-02-01T00:00:00", "3000000", None, None, None, None, 2024, "02"),
            (3, 1.0, 1.0, "2024-02-02T00:00:00", "-50.0", "x", "error", None, "2024-02-02", 2024, "02"),
            (4, 2.0, 1.0, "2030-01-01T00:00:00", "10", "x", "completada", None, "2024-02-02", 2024, "02"),
            (5, 1.0, 9.0, "2024-04-01T00:00:00", "50", "Tarjeta", "en curso", None, "2024-04-01", 2024, "04"),
            (None, 1.0, 9.0, "2009-12-31T00:00:00", "50", "Tarjeta", "exitosa", None, "2024-04-01", 2024, "04"),
        ),
        "gastos": make(
            spark,
            "id_gasto long, nombre_gasto string, fecha_pago string, id_caso long, medio_pago string, "
            "monto double, estado string, id_proveedor long, created_at string, last_modified_at string",
            (1, "vet", "2024-01-20", 1, "transfer", 100.0, "Pagado", 1, "2024-01-20", "2024-01-20"),
            (2, "food", "2024-03-20", None, None, 900.0, None, 1, "2024-03-20", "2024-03-20"),
            (3, "drop", "2024-03-20", 1, None, None, None, 1, "2024-03-20", "2024-03-20"),
            (4, "drop", "2024-03-20", 1, None, 5.0, None, None, "2024-03-20", "2024-03-20"),
            (5, "open", "2024-03-20", 1, None, 5.0, "revision", 2, "2024-03-20", "2024-03-20"),
        ),
        "donantes": make(
            spark,
            "id_donante long, donante string, correo string, pais string, ciudad string, canal_origen string, "
            "created_at string, last_modified_at string",
            (1, " ana ", "ANA@X.org", " costa rica", "Cali ", "Web", "2023-06-01", "2024-01-01"),
            (2, None, None, None, None, None, "2024-01-01", "2024-01-01"),
            (3, "bad", "bad-mail", "Peru", "x", "x", "2024-01-01", "2024-01-01"),
        ),
        "casos": make(
            spark,
            "id_caso long, nombre_caso string, fecha_ingreso string, fecha_salida string, "
            "id_hogar_de_paso long, presupuesto_estimado double, last_modified_at string",
            (1, " Luna", "2024-01-01", "2024-01-11", 1, 50.0, "2024-01-01"),
            (2, "Sol", "2024-02-01", None, None, None, "2024-02-01"),
            (3, None, "2024-02-01", None, 1, None, "2024-02-01"),
            (4, "Rex", "2009-02-01", None, 1, None, "2024-02-01"),
        ),
        "proveedores": make(
            spark,
            "id_proveedor long, nombre_proveedor string, tipo_proveedor string, nit string, correo string, "
            "ciudad string, last_modified_at string",
            (1, "clinica ", "Veterinarios", "123", "A@B.c", " Bogota", "2024-01-01"),
            (2, "tienda", None, "", None, None, "2024-01-01"),
        ),
        "hogar_de_paso": make(
            spark,
            "id_hogar_de_paso long, nombre_hogar string, cupo_maximo int, tarifa_diaria double",
            (1, "casa", 1, 10.0),
            (9, "nido", 2, None),
            (10, None, -1, -1.0),
            (11, "zero", None, 1.0),
        ),
    }


@pytest.fixture(scope="module")
def tables(spark, raw, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    out = registry.run(spark, raw, root, list(registry.TABLES), registry.Settings(as_of=AS_OF, scale=2))
    return {**out, "root": root}


def by(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) for r in df.collect()}


def test_silver_donations(tables, spark):
    got = by(tables["silver.donaciones"], "id_donacion", "id_donante", "id_caso", "monto", "medio_pago", "estado", "y", "m")
    assert got == {
        1: (1, 541, 150.0, "transferencia", "completada", 2024, "01"),
        2: (541, 1, 3000000.0, "nequi", "completada", 2024, "02"),
        5: (1, 9, 50.0, "tarjeta", "pendiente", 2024, "04"),
    }
    rejected = spark.read.parquet(f"{tables['root']}/quarantine/donaciones")
    assert by(rejected, "id_donacion", "dq_errors") == {
        3: (["MONTO_NEGATIVO"],),
        4: (["FECHA_FUTURA"],),
        None: (["ID_NULO", "FECHA_ANTERIOR_A_2010"],),
    }
    assert rejected.select("rule_set").distinct().first()[0] == "silver.donaciones"


def test_silver_expenses(tables):
    got = by(tables["silver.gastos"], "id_gasto", "id_caso", "medio_pago", "estado")
    assert got == {1: (1, "transfer", "pagado"), 2: (541, "nequi", "pagado"), 5: (1, "nequi", "pendiente")}


def test_silver_masters(tables):
    assert by(tables["silver.donantes"], "id_donante", "donante", "correo", "telefono", "ciudad", "pais", "canal_origen") == {
        1: ("ANA", "ana@x.org", "nn", "cali", "Costa Rica", "web"),
        2: ("ANONIMO", "desconocido", "nn", "bogota", "Colombia", "desconocido"),
    }
    assert by(tables["silver.casos"], "id_caso", "nombre_caso", "id_hogar_de_paso", "presupuesto_estimado", "veterinaria", "diagnostico") == {
        1: ("luna", 1, 50.0, "cba", "reservado"),
        2: ("sol", 9, 3500000.0, "cba", "reservado"),
    }
    assert by(tables["silver.hogar_de_paso"], "id_hogar_de_paso", "nombre_hogar", "cupo_maximo", "tarifa_diaria") == {
        1: ("CASA", 1, 10.0), 9: ("NIDO", 2, 0.0), 11: ("ZERO", 0, 1.0),
    }


def test_dimensions(tables):
    donor = by(tables["gold.dim_donantes"], "id_donante", "es_donante_internacional", "es_donante_local", "antiguedad_donante_meses", "contacto_valido", "anio_trimestre_creacion")
    assert donor == {1: (True, False, 12.0, True, "2023-T2"), 2: (False, True, 5.0, False, "2024-T1")}
    supplier = by(tables["gold.dim_proveedores"], "id_proveedor", "categoria_proveedor", "tiene_id_valido", "ciudad_normalizada")
    assert supplier == {1: ("Servicios Veterinarios", True, "bogota"), 2: ("General", False, None)}
    home = by(tables["gold.dim_hogar_de_paso"], "id_hogar_de_paso", "numero_casos_total", "tasa_ocupacion", "rotacion_casos", "clasificacion_ocupacion", "clasificacion_rotacion")
    assert home == {
        1: (1, 0.0, 1.0, "Baja", "Alta rotación"),
        9: (1, 0.5, 0.0, "Media", "Baja rotación"),
        11: (0, 0.0, 0.0, "Baja", "Baja rotación"),
    }
    case = by(tables["gold.dim_casos"], "id_caso", "es_caso_urgente", "dias_en_sistema")
    assert case == {1: (False, 152), 2: (False, 121)}
    assert tables["gold.dim_calendario"].count() == 4018


def test_facts_and_features(tables):
    fact = by(tables["gold.fact_donaciones"], "id_donacion", "es_donacion_critica", "recencia_donacion_dias", "recencia_donaciones_dias", "anio_mes_donacion", "categoria_monto")
    assert fact == {1: (False, 138, 138, "2024-01", "Bajo"), 2: (True, 121, 121, "2024-02", "Alto")}
    assert by(tables["gold.feat_donantes"], "id_donante", "total_donado", "num_donaciones", "categoria_financiera", "donante_recurrente_ml", "velocidad_crecimiento") == {
        1: (150.0, 1, "basico", False, 12.5), 2: (None, None, "basico", False, None),
    }
    assert by(tables["gold.feat_casos"], "id_caso", "costo_total_caso", "tiempo_resolucion_dias", "categoria_costo") == {
        1: (100.0, 10, "Bajo"), 2: (None, None, "Bajo"),
    }
    assert by(tables["gold.feat_proveedores"], "id_proveedor", "total_gastado_proveedor", "importancia_proveedor") == {
        1: (1000.0, "Transaccional"), 2: (None, "Transaccional"),
    }


def test_dashboards(tables):
    don = by(tables["gold.dashboard_donaciones"], "id_donacion", "donante", "frecuencia_donaciones", "monto_total_donado", "segmento_rfm", "tamano_donacion", "anio_mes")
    assert don == {
        1: ("ANA", 1, 150.0, "basico", "pequena", "2024-01"),
        2: (None, 1, 3000000.0, "oro", "critica", "2024-02"),
    }
    gas = by(tables["gold.dashboard_gastos"], "id_gasto", "frecuencia_gastos", "monto_total_gastado", "es_caso_activo", "sobrepresupuesto", "categoria_monto", "nombre_proveedor")
    assert gas == {
        1: (2, 1000.0, False, True, "Pequeño", "CLINICA"),
        2: (2, 1000.0, True, None, "Pequeño", "CLINICA"),
    }


def test_finance_months(tables):
    fin = {
        str(r["anio_mes"]): tuple(r)[1:]
        for r in tables["gold.dashboard_financiero"]
        .select("anio_mes", "total_donado", "total_gastado", "gastos_sobrepresupuesto", "casos_activos_mes", "donantes_activos_mes", "balance_acumulado", "porcentaje_sobrepresupuesto", "runway_financiero", "rolling_3m_gastos", "estado_financiero_mes")
        .collect()
    }
    assert fin == {
        "2024-01-01": (150.0, 100.0, 100.0, 1, 1, 50.0, 1.0, 0.5, 100.0, "Superávit"),
        "2024-02-01": (3000000.0, 0.0, 0.0, 0, 1, 3000050.0, None, None, 100.0, "Superávit"),
        "2024-03-01": (0.0, 900.0, 0.0, 1, 0, 2999150.0, 0.0, 2999150.0 / 900.0, 1000.0, "Déficit"),
    }


@pytest.mark.parametrize("scale", [None, 2])
def test_finance_from_dashboards_equals_united_movements(tables, scale):
    don, gas = tables["gold.dashboard_donaciones"], tables["gold.dashboard_gastos"]
    united = G.month_totals(G.movements(don, gas), scale)
    split = G.side_totals(don, gas, scale).select(*united.columns)
    key = lambda r: str(r[0])
    assert sorted(united.collect(), key=key) == sorted(split.collect(), key=key)


def test_partition_columns_of_the_input_are_not_kept(raw):
    assert {"y", "m"}.isdisjoint(S.donations(raw["donaciones"], AS_OF).columns)


def test_month_and_mark_filters(raw):
    assert S.donations(raw["donaciones"], AS_OF, month="2024-02").count() == 2
    assert S.donations(raw["donaciones"], AS_OF, mark=dt.datetime(2024, 2, 2)).count() == 2


def test_monthly_job_checks(raw):
    df = raw["donaciones"].withColumn("monto", F.col("monto").cast("double"))
    got = G.monthly_donations(df.filter("id_donacion IN (1, 5)"), scale=2).collect()
    assert [tuple(r) for r in got] == [(2024, 1, 250.0, 2, 125.0), (2024, 4, 50.0, 1, 50.0)]
    with pytest.raises(ValueError, match="out of range: 1 rows"):
        G.monthly_donations(df)
    with pytest.raises(ValueError, match="required columns: monto"):
        G.monthly_donations(df.drop("monto"))


def test_registry_order_follows_declared_inputs():
    flat = [n for g in registry.generations(list(registry.TABLES)) for n in g]
    assert len(flat) == len(registry.TABLES)
    for name, inputs in registry.needed(list(registry.TABLES)).items():
        assert all(flat.index(i) < flat.index(name) for i in inputs if not i.startswith("raw."))
    assert "silver.donaciones" not in registry.needed(["gold.dim_hogar_de_paso"])
    assert len(registry.layer_targets("silver")) == 6


def test_a_month_without_rows_disappears(spark, raw, tmp_path):
    settings = registry.Settings(as_of=AS_OF)
    run = lambda r: registry.run(spark, r, str(tmp_path), ["gold.fact_donaciones"], settings)["gold.fact_donaciones"]
    assert run(raw).select("m").distinct().count() == 2
    fewer = {**raw, "donaciones": raw["donaciones"].filter("id_donacion = 1")}
    assert run(fewer).count() == 1


def test_no_raw_rows_keep_the_stored_table(spark, raw, tmp_path):
    settings = registry.Settings(as_of=AS_OF)
    run = lambda r: registry.run(spark, r, str(tmp_path), ["silver.gastos"], settings)["silver.gastos"]
    assert run(raw).count() == 3
    assert run({**raw, "gastos": raw["gastos"].limit(0)}).count() == 3


def test_export_of_every_gold_table(spark, tables, tmp_path):
    spark.sql(f"CREATE DATABASE exported_gold LOCATION '{tmp_path}/db'")
    gold = {n.split(".")[1]: df for n, df in tables.items() if n.startswith("gold.")}
    names = export_gold(spark, gold, str(tmp_path), "exported_gold")
    assert len(names) == 13
    for name in names:
        assert spark.table(name).count() == gold[name.split(".")[1]].count()
    assert {"y", "m", "d"} <= set(spark.table("exported_gold.fact_gastos").columns)


def test_quarantine_report(spark, tables):
    report = quarantine_report(spark, tables["root"], [*registry.RAW, "absent"])
    codes = {(r["table_name"], r["error_code"]) for r in report.collect()}
    assert ("donantes", "EMAIL_INVALIDO") in codes and ("casos", "FECHA_INGRESO_INVALIDA") in codes
    assert quarantine_report(spark, tables["root"], ["absent"]).isEmpty()


def test_empty_tables_read_back_as_empty(spark, raw, tmp_path):
    nothing = {name: df.limit(0) for name, df in raw.items()}
    out = registry.run(spark, nothing, str(tmp_path), list(registry.TABLES), registry.Settings(as_of=AS_OF))
    assert {n for n, df in out.items() if not df.isEmpty()} == {"gold.dim_calendario"}


def test_a_month_run_keeps_the_other_months(spark, raw, tmp_path):
    settings = registry.Settings(as_of=AS_OF, scale=2)
    run = lambda r, s: registry.run(spark, r, str(tmp_path), ["silver.donaciones", "gold.dashboard_financiero"], s)
    run(raw, settings)
    gone = {**raw, "donaciones": raw["donaciones"].filter("id_donacion <> 2").withColumn("monto", F.lit("999"))}
    out = run(gone, registry.Settings(as_of=AS_OF, scale=2, month="2024-02"))
    assert by(out["silver.donaciones"], "id_donacion", "monto") == {1: (150.0,), 3: (999.0,), 5: (50.0,)}
    assert {str(r["anio_mes"]) for r in out["gold.dashboard_financiero"].collect()} >= {"2024-01-01"}


def test_kept_table_keeps_its_types(spark, raw, tmp_path):
    run = lambda r: registry.run(spark, r, str(tmp_path), ["silver.gastos"], registry.Settings(as_of=AS_OF))["silver.gastos"]
    assert run(raw).schema == run({**raw, "gastos": raw["gastos"].limit(0)}).schema


def test_counts_of_a_run(spark, raw, tables):
    got = by(registry.run_counts(spark, tables["root"]), "table_name", "raw", "deduplicated", "valid", "rejected")
    assert got["silver.donaciones"] == (7, 6, 3, 3)

"""Runs over a month and over what changed, against full runs; one commit over all tables."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lakeops.plans import gold as G
from lakeops.plans import registry
from lakeops.sinks import runs, versioned
from lakeops.sources.paths import listed

SETTINGS = registry.Settings(as_of=dt.date(2024, 12, 1), scale=2)
DON = "id_donacion long, id_donante long, id_caso long, fecha_donacion string, monto double, medio_pago string, estado string, last_modified_at string"
GAS = (
    "id_gasto long, nombre_gasto string, fecha_pago string, id_caso long, medio_pago string, monto double, estado string, "
    "id_proveedor long, created_at string, last_modified_at string"
)


def frame(spark, ddl, rows):
    return spark.createDataFrame(rows, ddl)


def day(rng, month=None):
    return f"2024-{month or rng.randint(1, 8):02d}-{rng.randint(1, 28):02d}"


def base_rows():
    rng = random.Random(8)
    don = []
    for i in range(150):
        d = day(rng)
        don.append((i, rng.choice([None, *range(12)]), rng.choice([None, 1, 2, 3]), d, rng.choice([-5.0, 10.5, 99.25, 1500000.0, 40.0]), "Nequi", "exitosa" if i % 5 else "en curso", d))
    don.append((None, 1, 1, "2024-02-03", 7.0, "x", "exitosa", "2024-02-03"))
    gas = []
    for i in range(120):
        d = day(rng)
        gas.append((i, "g", d, rng.choice([None, 1, 2, 3]), "transfer", rng.choice([5.0, 70.5, 900.0]), "Pagado" if i % 4 else "revision", rng.choice([1, 2, 3, None]), d, d))
    return don, gas


def later_rows(don, gas):
    """New versions of rows that were in May, and rows that are new in May."""
    late = "2024-11-01"
    may = [r for r in don if r[3].startswith("2024-05") and r[0] is not None]
    new = [(may[0][0], *may[0][1:3], "2024-07-09", *may[0][4:7], late)]  # moved away
    new += [(may[1][0], 11, 2, may[1][3], 2000000.5, "x", "exitosa", late)]  # another donor, another amount
    new += [(may[2][0], *may[2][1:4], -1.0, *may[2][5:7], late)]  # now invalid
    new += [(900, 3, 1, "2024-05-30", 1.5, "x", "exitosa", late), (901, 77, 1, "2024-05-30", 1.5, "x", "exitosa", late)]
    elsewhere = next(r for r in don if r[3].startswith("2024-03"))
    new += [(elsewhere[0], *elsewhere[1:3], "2024-05-02", *elsewhere[4:7], late)]  # moved here
    new += [(None, 2, 1, "2024-05-03", 8.0, "x", "exitosa", late)]  # NULL keys are one group
    may = [r for r in gas if r[2].startswith("2024-05") and r[5] and r[7]]
    out = [(may[0][0], "g", "2024-01-02", *may[0][3:8], may[0][8], late), (950, "n", "2024-05-05", 2, "x", 33.0, "Pagado", 1, late, late)]
    # The newest version of a row that was valid in May has no amount: it is rejected before the ranking, so the old one stays.
    out += [(may[1][0], *may[1][1:5], None, *may[1][6:9], late)]
    return don + new, gas + out


@pytest.fixture(scope="module")
def masters(spark):
    donors = [(i, f" d{i}", f"D{i}@x.org" if i % 3 else "bad", "Peru", "Cali", "web", "2023-01-01", "2023-01-01") for i in range(12)]
    cases = [(i, f"c{i}", "2024-01-01", None if i % 2 else "2024-03-01", 1, 100.0 * i, "2024-01-01") for i in (1, 2, 3)]
    return {
        "donantes": frame(spark, "id_donante long, donante string, correo string, pais string, ciudad string, canal_origen string, created_at string, last_modified_at string", donors),
        "casos": frame(spark, "id_caso long, nombre_caso string, fecha_ingreso string, fecha_salida string, id_hogar_de_paso long, presupuesto_estimado double, last_modified_at string", cases),
        "proveedores": frame(spark, "id_proveedor long, nombre_proveedor string, tipo_proveedor string, nit string, correo string, ciudad string, last_modified_at string", [(i, f"s{i}", None, "", None, "Bogota", "2024-01-01") for i in (1, 2)]),
        "hogar_de_paso": frame(spark, "id_hogar_de_paso long, nombre_hogar string, cupo_maximo int, tarifa_diaria double", [(1, "casa", 1, 10.0), (9, "nido", 2, None)]),
    }


@pytest.fixture(scope="module")
def before(spark, masters):
    don, gas = base_rows()
    return {**masters, "donaciones": frame(spark, DON, don), "gastos": frame(spark, GAS, gas)}


@pytest.fixture(scope="module")
def after(spark, masters):
    don, gas = later_rows(*base_rows())
    return {**masters, "donaciones": frame(spark, DON, don), "gastos": frame(spark, GAS, gas)}


ALL = list(registry.TABLES)


@pytest.fixture(scope="module")
def whole(spark, after, tmp_path_factory):
    return registry.run(spark, after, str(tmp_path_factory.mktemp("whole")), ALL, SETTINGS)


def content(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def differing(got, want):
    return [n for n in want if content(got[n]) != content(want[n])]


def files(spark, root, name):
    """Version of each partition of a table in the newest run."""
    return versioned.manifest(spark, f"{root}/{name.replace('.', '/')}", runs.current(spark, root).tables[name]).where


@pytest.fixture(scope="module")
def monthly(spark, before, after, tmp_path_factory):
    """A full run, then May again over raw rows that hold newer versions."""
    root = str(tmp_path_factory.mktemp("monthly"))
    registry.run(spark, before, root, ALL, SETTINGS)
    first = {n: files(spark, root, n) for n in ALL}
    out = registry.run(spark, after, root, ALL, replace(SETTINGS, month="2024-05"))
    return root, first, out


def test_month_run_equals_a_full_run(monthly, whole):
    assert differing(monthly[2], whole) == []


def test_month_run_leaves_other_months_alone(spark, monthly):
    root, first, _ = monthly
    now = files(spark, root, "silver.donaciones")
    changed = {p[-12:] for p in now if p.startswith("rejected=false") and now[p] != first["silver.donaciones"].get(p)}
    assert changed == {"/y=2024/m=03", "/y=2024/m=05", "/y=2024/m=07"}
    assert {p for p, v in files(spark, root, "gold.fact_gastos").items() if v != first["gold.fact_gastos"][p]} == {"y=2024/m=01", "y=2024/m=05"}
    facts = files(spark, root, "gold.fact_donaciones")
    assert len([p for p, v in facts.items() if v == first["gold.fact_donaciones"].get(p)]) >= 2
    assert {p for p, v in files(spark, root, "parts.caso_mes").items() if v == first["parts.caso_mes"].get(p)} >= {"y=2024/m=02", "y=2024/m=08"}


def test_month_run_twice_changes_nothing(spark, after, monthly, whole):
    root = monthly[0]
    out = registry.run(spark, after, root, ALL, replace(SETTINGS, month="2024-05"))
    assert differing(out, whole) == []
    assert registry.read(spark, root, "gold.fact_gastos").count() == whole["gold.fact_gastos"].count()


def test_other_settings_are_not_mixed(spark, after, monthly, tmp_path):
    later = replace(SETTINGS, as_of=dt.date(2025, 1, 1))
    want = registry.run(spark, after, str(tmp_path / "w"), ["gold.fact_donaciones"], later)
    got = registry.run(spark, after, monthly[0], ["gold.fact_donaciones"], replace(later, month="2024-05"))
    ages = lambda t: {r[0]: r[1] for r in t["gold.fact_donaciones"].select("id_donacion", "recencia_donacion_dias").collect()}
    assert ages(got) == ages(want)


def test_budgets_reach_all_months_of_their_case(spark, before, masters, tmp_path):
    """A month run in which a case, a supplier and a donor change too."""
    changed = dict(before)
    changed["casos"] = masters["casos"].withColumn("presupuesto_estimado", F.col("presupuesto_estimado") / 20)
    changed["proveedores"] = masters["proveedores"].withColumn("ciudad", F.lit("Cali"))
    changed["donantes"] = masters["donantes"].filter("id_donante <> 4").withColumn("ciudad", F.when(F.col("id_donante") == 5, "Lima").otherwise(F.col("ciudad")))
    root = str(tmp_path / "a")
    registry.run(spark, before, root, ALL, SETTINGS)
    got = registry.run(spark, changed, root, ALL, replace(SETTINGS, month="2024-02"))
    want = registry.run(spark, changed, str(tmp_path / "b"), ALL, SETTINGS)
    assert differing(got, want) == []


@pytest.fixture
def failing(monkeypatch):
    """Curated tables that cannot be built."""

    def fail(*args, **options):
        raise RuntimeError("no cases today")

    table = registry.TABLES["gold.feat_casos"]
    monkeypatch.setitem(registry.TABLES, "gold.feat_casos", replace(table, build=fail, refresh=None))


def test_run_that_dies_changes_nothing_for_readers(spark, before, after, whole, tmp_path, request):
    root, names = str(tmp_path), ["gold.fact_donaciones", "gold.feat_casos"]
    old = registry.run(spark, before, root, names, SETTINGS)
    old = {n: content(df) for n, df in old.items()}
    request.getfixturevalue("failing")
    with pytest.raises(RuntimeError, match="no cases"):
        registry.run(spark, after, root, names, SETTINGS)
    assert versioned.manifest(spark, f"{root}/silver/donaciones").number == 2  # written, not published
    assert {n: content(registry.read(spark, root, n)) for n in names} == old
    assert content(registry.read(spark, root, "silver.donaciones")) != content(whole["silver.donaciones"])
    request.getfixturevalue("monkeypatch").undo()
    out = registry.run(spark, after, root, names, replace(SETTINGS, month="2024-05"))
    assert differing(out, {n: whole[n] for n in names}) == []
    assert runs.current(spark, root).number == 2


def test_first_run_that_dies_leaves_nothing_to_read(spark, before, tmp_path, failing):
    with pytest.raises(RuntimeError):
        registry.run(spark, before, str(tmp_path), ["gold.feat_casos"], SETTINGS)
    with pytest.raises(FileNotFoundError):
        registry.read(spark, str(tmp_path), "silver.casos")


def test_published_versions_do_not_expire(spark, path):
    rows = spark.range(3).withColumn("y", F.lit(2024))
    for _ in range(versioned.KEPT_VERSIONS + 4):
        versioned.commit(spark, path, rows.limit(1), {"y": F.col("y")}, base=0, pinned={2})
    kept = versioned._manifests(spark, path)
    assert kept[0] == 2 and len(kept) == versioned.KEPT_VERSIONS + 1
    assert len(listed(spark, path, "data/*")) == len(kept) and versioned.read(spark, path, 2).count() == 1


def test_increments_equal_a_full_run(spark, before, after, whole, tmp_path, monkeypatch):
    root = str(tmp_path)
    registry.run_increment(spark, before, root, ALL, SETTINGS)
    marks = runs.current(spark, root).marks
    assert marks["donaciones"].startswith("2024-08") and "hogar_de_paso" not in marks
    table = registry.TABLES["gold.dashboard_gastos"]
    fail = lambda *a: 1 / 0
    monkeypatch.setitem(registry.TABLES, table.name, replace(table, build=fail, refresh=fail))
    with pytest.raises(ZeroDivisionError):
        registry.run_increment(spark, after, root, ALL, SETTINGS)
    assert runs.current(spark, root).marks == marks
    monkeypatch.undo()
    out = registry.run_increment(spark, after, root, ALL, SETTINGS)
    assert differing(out, whole) == []
    assert runs.current(spark, root).marks["donaciones"].startswith("2024-11")
    nothing = registry.run_increment(spark, {}, root, ALL, SETTINGS)
    assert differing(nothing, whole) == []


def test_counts_come_from_the_writing_tasks(spark, before, tmp_path):
    root = str(tmp_path)
    registry.run(spark, before, root, registry.layer_targets("silver"), SETTINGS)
    got = {r["table_name"]: tuple(r)[1:] for r in registry.run_counts(spark, root).collect()}
    don = [r for r in base_rows()[0]]
    bad = len([r for r in don if r[0] is None or r[4] < 0])
    assert got["silver.donaciones"] == (len(don), len(don), len(don) - bad, bad)
    gas = [r for r in base_rows()[1] if r[7]]
    assert got["silver.gastos"] == (120, len(gas), len(gas), 0)


def test_counting_no_rows(spark, path):
    empty = spark.createDataFrame([], "id long, y int")
    versioned.commit(spark, path, empty, {"y": F.col("y")}, counts={"n": F.count(F.lit(1)), "raw": 7})
    assert versioned.manifest(spark, path).counts == {"n": 0, "raw": 7}
    versioned.commit(spark, f"{path}/flat", empty, {}, counts={"n": F.count(F.lit(1))})
    assert versioned.manifest(spark, f"{path}/flat").counts == {"n": 0}


def test_keys_of_null_and_hot_rows(spark):
    rows = spark.createDataFrame([(None, 1)] * 5 + [(1, 2), (2, 3)], "k long, v int")
    known = spark.createDataFrame([(None,), (2,)], "k long")
    assert sorted(r["v"] for r in versioned.of_keys(rows, known, ["k"]).collect()) == [1] * 5 + [3]
    assert [r["v"] for r in versioned.without_keys(rows, known, ["k"]).collect()] == [2]
    assert versioned.of_keys(rows, known.filter("k = 1"), ["k"]).count() == 0


def test_parts_merge_to_the_same_statistics(spark, before):
    from lakeops.plans import silver as S
    from lakeops.operators.quality import valid_rows

    rows = valid_rows(S.donations(before["donaciones"], SETTINGS.as_of))
    dim = spark.createDataFrame([(i, 1.0) for i in range(14)], "id_donante long, antiguedad_donante_meses double")
    want = G.feat_donors(dim, G.completed(rows), SETTINGS.as_of, 2)
    got = G.feat_donors(dim, G.donor_months(rows, 2), SETTINGS.as_of, 2)
    assert content(got) == content(want)


@pytest.mark.parametrize("first", [dt.date(2024, 4, 1), dt.date(2023, 12, 1)])
def test_changed_rules_equal_a_full_run(spark, after, tmp_path, first):
    """Rules that admit more, and rules that admit less, applied to what is stored."""
    root, start = str(tmp_path / "a"), replace(SETTINGS, first_day=dt.date(2024, 3, 1))
    registry.run(spark, after, root, ALL, start)
    new = replace(SETTINGS, first_day=first)
    got = registry.judge_again(spark, root, new)
    want = registry.run(spark, after, str(tmp_path / "b"), ALL, new)
    assert differing(got, {n: want[n] for n in got}) == [] and set(got) >= {"silver.donaciones", "gold.dashboard_financiero"}
    now = files(spark, root, "silver.donaciones")
    assert 1 in now.values() and 2 in now.values()  # months that no verdict reaches keep their files
    rejected = lambda r: content(versioned.read(spark, f"{r}/silver/donaciones", None, lambda p: p.startswith("rejected=true")))
    assert rejected(root) == rejected(str(tmp_path / "b"))


def test_changed_rules_leave_what_they_do_not_reach(spark, before, tmp_path):
    """The parts of expenses have nothing to do with the first day of donations: they are not written again."""
    root, start = str(tmp_path / "a"), replace(SETTINGS, first_day=dt.date(2024, 3, 1))
    name, new = "gold.dashboard_financiero", replace(SETTINGS, first_day=dt.date(2024, 2, 1))
    registry.run(spark, before, root, [name], start)
    got = registry.judge_again(spark, root, new, [name])
    want = registry.run(spark, before, str(tmp_path / "b"), [name], new)
    assert differing(got, want) == []
    assert set(files(spark, root, "parts.caso_mes").values()) == {1}
    again = registry.run(spark, before, root, [name], replace(SETTINGS, scale=3))  # a setting that they do depend on
    assert set(files(spark, root, "parts.caso_mes").values()) == {2} and again[name].count()


def test_parts_are_shuffled_once(spark, before):
    from lakeops.plans import silver as S

    rows = S.expenses(before["gastos"], SETTINGS.as_of)
    copy = spark.createDataFrame(rows.collect(), rows.schema)  # its own shuffle left out
    parts = G.case_months(copy, 2)
    text = parts._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "hashpartitioning(y" in text
    assert content(parts) == content(G._by_month(G.paid_expenses(copy), "id_caso", "id_gasto", "fecha_pago", 2))

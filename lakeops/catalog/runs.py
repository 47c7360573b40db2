"""Runs over a month and over what changed, and runs that die: each must read like a full run, or the last one."""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..operators.reconcile import stack
from ..plans import bindings as B
from ..plans import registry
from ..session import scratch_path
from . import query
from .layers import _ROWS_OF, DNT, DON, FINANCE, GAS, HOG, SETTINGS, _facts, _facts_sql

MONTH = "1997-03"

# In that month every fourth row moves 61 days on, and every fourth costs 1 more. The new versions are
# rows of their own, changed later than all others.
_LATER = f"""later_orders AS (SELECT * REPLACE (
    CASE WHEN strftime(o_orderdate, '%Y-%m') = '{MONTH}' AND o_orderkey % 4 = 0 THEN o_orderdate + INTERVAL 61 DAY
      ELSE o_orderdate END AS o_orderdate,
    CASE WHEN strftime(o_orderdate, '%Y-%m') = '{MONTH}' AND o_orderkey % 4 = 1 THEN o_totalprice + 1
      ELSE o_totalprice END AS o_totalprice) FROM orders),
  later_lines AS (SELECT *, l_shipdate AS changed_at FROM lineitem UNION ALL
    SELECT * REPLACE (CASE WHEN l_orderkey % 4 = 0 THEN l_shipdate + INTERVAL 61 DAY ELSE l_shipdate END AS l_shipdate,
      CASE WHEN l_orderkey % 4 = 1 THEN l_extendedprice + 1 ELSE l_extendedprice END AS l_extendedprice),
      TIMESTAMP '2003-01-01' FROM lineitem WHERE strftime(l_shipdate, '%Y-%m') = '{MONTH}' AND l_orderkey % 4 < 2)"""


def _later(sql: str) -> str:
    sql = sql.replace("FROM orders)", "FROM later_orders)").replace("FROM lineitem WHERE", "FROM later_lines WHERE")
    return f"{_LATER}, {sql.replace('l_shipdate AS last_modified_at', 'changed_at AS last_modified_at')}"


def _versions(spark, sf):
    """Raw donations and expenses of the first run, and with the new versions added."""

    def later(table, key, day, amount):
        rows = B.table(spark, sf, table).filter(f"date_format({day}, 'yyyy-MM') = '{MONTH}' AND {key} % 4 < 2")
        moved = F.when(F.col(key) % 4 == 0, F.col(day) + F.expr("INTERVAL 61 DAYS")).otherwise(F.col(day))
        dearer = F.when(F.col(key) % 4 == 1, F.col(amount) + 1).otherwise(F.col(amount))
        return rows.withColumns({day: moved, amount: dearer})

    stamp = F.expr("TIMESTAMP_NTZ '2003-01-01 00:00:00'")
    first = {"donaciones": B.donations(spark, sf), "gastos": B.expenses(spark, sf)}
    new = {
        "donaciones": B.donations(spark, sf, later("orders", "o_orderkey", "o_orderdate", "o_totalprice")),
        "gastos": B.expenses(spark, sf, later("lineitem", "l_orderkey", "l_shipdate", "l_extendedprice")),
    }
    kind = {n: first[n].schema["last_modified_at"].dataType for n in first}
    return first, {n: first[n].unionByName(new[n].withColumn("last_modified_at", stamp.cast(kind[n]))) for n in first}


@query(
    "pip_month_moves",
    f"""WITH {_later(f"{DON}, {GAS}")} SELECT 'donaciones' AS table_name, id_donacion AS id, fecha_donacion AS day, monto FROM don
        UNION ALL SELECT 'gastos', id_gasto, fecha_pago, monto FROM gas""",
)
def _(spark, sf):
    """A full run, then one month over raw rows some of which moved out of it or were corrected."""
    root = scratch_path(spark, "moves")
    before, after = _versions(spark, sf)
    names = ["silver.donaciones", "silver.gastos"]
    registry.run(spark, before, root, names, SETTINGS)
    out = registry.run(spark, after, root, names, replace(SETTINGS, month=MONTH))
    sides = [("donaciones", "id_donacion", "fecha_donacion"), ("gastos", "id_gasto", "fecha_pago")]
    return stack(
        [
            out[f"silver.{n}"].select(
                F.lit(n).alias("table_name"), F.col(key).alias("id"), F.col(day).cast("timestamp_ntz").alias("day"), "monto"
            )
            for n, key, day in sides
        ]
    )


@query("pip_incremental_gold", f"WITH {_later(FINANCE)}, {DNT}, {HOG} " + _facts_sql(_ROWS_OF, "amount"))
def _(spark, sf):
    """All tables after a full run and a run over one month, which makes again what the month changed."""
    root, raw = scratch_path(spark, "refresh"), B.raw_tables(spark, sf)
    before, after = _versions(spark, sf)
    registry.run(spark, raw | before, root, list(_ROWS_OF), SETTINGS)
    out = registry.run(spark, raw | after, root, list(_ROWS_OF), replace(SETTINGS, month=MONTH))
    return _facts(out, "amount")


@query("pip_increment_run", f"WITH {_later(FINANCE)} SELECT * FROM fin")
def _(spark, sf):
    """Monthly finance after two incremental runs: everything, then what changed since the marks."""
    root, raw = scratch_path(spark, "increment"), B.raw_tables(spark, sf)
    before, after = _versions(spark, sf)
    name = "gold.dashboard_financiero"
    registry.run_increment(spark, raw | before, root, [name], SETTINGS)
    return registry.run_increment(spark, raw | after, root, [name], SETTINGS)[name]


_SETS = ["silver.donaciones", "silver.gastos", "gold.fact_donaciones", "gold.fact_gastos"]


@query("pip_atomic_run", f"WITH {FINANCE} " + _facts_sql(_SETS, "amount"))
def _(spark, sf):
    """A run that dies after its cleaned tables are written: readers of all tables stay on the set before."""
    root = scratch_path(spark, "atomic")
    before, after = _versions(spark, sf)
    registry.run(spark, before, root, _SETS, SETTINGS)
    try:
        registry.run(spark, after, root, _SETS, replace(SETTINGS, critical=F.col("no_such_column")))
    except AnalysisException:
        return _facts({n: registry.read(spark, root, n) for n in _SETS}, "amount")
    raise AssertionError("a threshold from an unknown column was accepted")


@query("pip_judge_again", f"WITH {FINANCE} SELECT * FROM fin")
def _(spark, sf):
    """Monthly finance after a run with too strict a first day, whose rejected rows are then judged again."""
    root, name = scratch_path(spark, "judged"), "gold.dashboard_financiero"
    strict = replace(SETTINGS, first_day=SETTINGS.first_day.replace(year=1998))
    registry.run(spark, B.raw_tables(spark, sf), root, [name], strict)
    return registry.judge_again(spark, root, SETTINGS, [name])[name]


@query("src_empty_input", f"WITH {DON} SELECT id_donacion, monto FROM don")
def _(spark, sf):
    """A load that brings no rows leaves the table as it is."""
    root, name = scratch_path(spark, "empty"), "silver.donaciones"
    raw = B.donations(spark, sf)
    registry.run(spark, {"donaciones": raw}, root, [name], SETTINGS)
    return registry.run(spark, {"donaciones": raw.filter("id_donacion IS NULL")}, root, [name], SETTINGS)[name].select("id_donacion", "monto")

"""Tables with their declared inputs, and a run over any selection of them (PIP-1, PIP-2).

Every table is stored before its readers start, so no lineage is computed twice and a lost
executor costs a stage, not a pipeline. Tables of one generation are independent and are
submitted together; Spark shares the cluster among them.

Each table is a versioned one (``sinks.versioned``), and a run publishes the versions of all its tables,
with the marks it reached, in one commit (``sinks.runs``): readers see the set of the last complete run
until then. A run over one month or over what changed since the marks takes the other months, and whatever
no change reaches, from that set (``refresh``).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import conform
from ..functions.dates import partition_columns
from ..operators import quality as dq
from ..operators.filters import month_bounds, month_slice
from ..session import scratch_path
from ..sinks import runs, versioned
from ..sinks.writers import append_quarantine
from ..sources.readers import extract
from ..sources.schemas import POLICIES, SCHEMAS, Load
from ..streaming import marks
from . import gold as G
from . import refresh as N
from . import rules as R
from . import silver as S

RAW = ("donaciones", "gastos", "donantes", "casos", "proveedores", "hogar_de_paso")


@dataclass(frozen=True)
class Settings:
    """Everything a run depends on besides its input tables.

    ``month`` (yyyy-MM) limits the cleaning of dated tables to the keys that have, or had, a row in that
    month. All versions of those keys are ranked, so a row that moved to another month, or was
    corrected there, ends up where a full run would put it; months that neither lose nor gain a
    row stay. ``run_id`` names the run in the quarantine; a repeated id replaces that run's rows,
    and without one every run gets its own.
    """

    as_of: dt.date | None = None
    scale: int | None = None
    first_day: dt.date = R.FIRST_VALID_DAY
    calendar: tuple[dt.date, dt.date] = G.CALENDAR_SPAN
    critical: float = R.DONATION_CRITICAL
    size: tuple = R.DONATION_SIZE
    expense_amount: tuple = R.EXPENSE_AMOUNT
    month: str | None = None
    run_id: str | None = None


@dataclass(frozen=True)
class Table:
    """``reads`` names the columns a table takes from an input, where it does not take most of them.
    ``refresh`` makes the table again from what changed, see ``plans.refresh``. ``rules`` are those that
    reject rows of a cleaned table. A ``laid_out`` table is built from tasks that hold few of its months each.
    ``uses`` names the settings that its values depend on besides its inputs; None stands for all."""

    name: str
    layer: str
    inputs: tuple[str, ...]
    build: Callable[[SparkSession, Settings, Mapping[str, DataFrame]], DataFrame]
    partition_date: str | None = None
    partitions: tuple[str, ...] = field(default=())
    row_wise: bool = False  # a projection of its inputs: reading it again is just a scan
    reads: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    refresh: Callable[[N.Change], N.Refreshed] | None = None
    rules: Callable[[Settings], list] | None = None
    laid_out: bool = False
    uses: tuple[str, ...] | None = None


def _silver(name: str, build, partition_date=None, rules=None) -> Table:
    partitions = ("y", "m") if partition_date else ()
    return Table(f"silver.{name}", "silver", (f"raw.{name}",), build, partition_date, partitions, rules=rules)


MONTHS = ("y", "m")
_DONATION = ("id_donacion", "id_donante", "monto", "fecha_donacion", "estado")
_EXPENSE = ("id_gasto", "id_caso", "id_proveedor", "monto", "fecha_pago", "estado")


def _parts(name: str, source: str, rows, columns, laid_out=False) -> Table:
    return Table(
        f"parts.{name}",
        "parts",
        (source,),
        lambda spark, s, i: rows(i[source], s.scale),
        partitions=MONTHS,
        reads={source: columns},
        refresh=N.by_month(source, lambda c, new: rows(new, c.settings.scale), laid_out),
        laid_out=laid_out,
        uses=("scale",),
    )


def _gold(name: str, inputs, build, partitions=(), row_wise=False, reads=None, refresh=None, laid_out=False, uses=None) -> Table:
    return Table(
        f"gold.{name}", "gold", tuple(inputs), build, None, tuple(partitions), row_wise, reads or {}, refresh, laid_out=laid_out, uses=uses
    )


TABLES = {
    t.name: t
    for t in [
        _silver(
            "donaciones",
            lambda spark, s, i: S.donations(i["raw.donaciones"], s.as_of, first_day=s.first_day),
            "fecha_donacion",
            lambda s: S.donation_rules(s.as_of, s.first_day),
        ),
        _silver("gastos", lambda spark, s, i: S.expenses(i["raw.gastos"], s.as_of), "fecha_pago"),
        _silver("donantes", lambda spark, s, i: S.donors(i["raw.donantes"], s.as_of), rules=lambda s: S.donor_rules()),
        _silver(
            "casos",
            lambda spark, s, i: S.cases(i["raw.casos"], s.as_of, s.first_day),
            rules=lambda s: S.case_rules(s.as_of, s.first_day),
        ),
        _silver("proveedores", lambda spark, s, i: S.suppliers(i["raw.proveedores"])),
        _silver("hogar_de_paso", lambda spark, s, i: S.homes(i["raw.hogar_de_paso"], s.as_of)),
        _parts("donante_mes", "silver.donaciones", G.donor_months, _DONATION, laid_out=True),
        _parts("proveedor_mes", "silver.gastos", G.supplier_months, _EXPENSE),
        _parts("caso_mes", "silver.gastos", G.case_months, _EXPENSE, laid_out=True),
        _gold("dim_calendario", [], lambda spark, s, i: G.dim_calendar(spark, *s.calendar), row_wise=True),
        _gold(
            "dim_donantes",
            ["silver.donantes", "gold.dim_calendario"],
            lambda spark, s, i: G.dim_donors(
                i["silver.donantes"], i["gold.dim_calendario"], s.as_of
            ),
            MONTHS,
            row_wise=True,
        ),
        _gold(
            "dim_proveedores",
            ["silver.proveedores"],
            lambda spark, s, i: G.dim_suppliers(i["silver.proveedores"]),
            row_wise=True,
        ),
        _gold(
            "dim_casos",
            ["silver.casos"],
            lambda spark, s, i: G.dim_cases(i["silver.casos"], s.as_of),
            MONTHS,
            row_wise=True,
        ),
        _gold(
            "dim_hogar_de_paso",
            ["silver.hogar_de_paso", "silver.casos"],
            lambda spark, s, i: G.dim_homes(i["silver.hogar_de_paso"], i["silver.casos"]),
            reads={"silver.casos": ("id_caso", "id_hogar_de_paso", "fecha_salida")},
        ),
        _gold(
            "fact_donaciones",
            ["silver.donaciones", "parts.donante_mes"],
            lambda spark, s, i: G.fact_donations(
                i["silver.donaciones"], s.as_of, s.critical, G.donor_last(i["parts.donante_mes"])
            ),
            MONTHS,
            reads={"silver.donaciones": (*_DONATION, "medio_pago")},
            refresh=N.fact_donations,
        ),
        _gold(
            "fact_gastos",
            ["silver.gastos"],
            lambda spark, s, i: G.fact_expenses(i["silver.gastos"], s.as_of),
            MONTHS,
            row_wise=True,
            reads={"silver.gastos": (*_EXPENSE, "medio_pago", "nombre_gasto", "created_at")},
            refresh=N.by_month("silver.gastos", lambda c, new: G.fact_expenses(new, c.settings.as_of), row_wise=True),
            laid_out=True,  # the same months as its input
        ),
        _gold(
            "feat_donantes",
            ["gold.dim_donantes", "parts.donante_mes"],
            lambda spark, s, i: G.feat_donors(
                i["gold.dim_donantes"], i["parts.donante_mes"], s.as_of, s.scale
            ),
            refresh=N.features(
                "gold.feat_donantes", "gold.dim_donantes", "parts.donante_mes", "id_donante",
                lambda c, dim, months: G.feat_donors(dim, months, c.settings.as_of, c.settings.scale),
            ),
        ),
        _gold(
            "feat_casos",
            ["gold.dim_casos", "parts.caso_mes"],
            lambda spark, s, i: G.feat_cases(i["gold.dim_casos"], i["parts.caso_mes"], s.scale),
            refresh=N.features(
                "gold.feat_casos", "gold.dim_casos", "parts.caso_mes", "id_caso",
                lambda c, dim, months: G.feat_cases(dim, months, c.settings.scale),
            ),
        ),
        _gold(
            "feat_proveedores",
            ["silver.proveedores", "parts.proveedor_mes"],
            lambda spark, s, i: G.feat_suppliers(
                i["silver.proveedores"], i["parts.proveedor_mes"], s.scale
            ),
            refresh=N.features(
                "gold.feat_proveedores", "silver.proveedores", "parts.proveedor_mes", "id_proveedor",
                lambda c, dim, months: G.feat_suppliers(dim, months, c.settings.scale),
            ),
        ),
        _gold(
            "dashboard_donaciones",
            ["gold.fact_donaciones", "gold.dim_donantes", "parts.donante_mes"],
            lambda spark, s, i: G.dash_donations(
                i["gold.fact_donaciones"], i["gold.dim_donantes"], s.as_of, s.scale, s.size,
                G.donor_metrics(i["parts.donante_mes"], s.scale), N.by_months,
            ),
            MONTHS,
            refresh=N.dash_donations,
            laid_out=True,
        ),
        _gold(
            "dashboard_gastos",
            ["gold.fact_gastos", "gold.dim_proveedores", "silver.casos", "parts.proveedor_mes"],
            lambda spark, s, i: G.dash_expenses(
                i["gold.fact_gastos"],
                i["gold.dim_proveedores"],
                i["silver.casos"],
                s.as_of,
                s.scale,
                s.expense_amount,
                G.supplier_metrics(i["parts.proveedor_mes"], s.scale),
                N.by_months,
            ),
            MONTHS,
            reads={"silver.casos": ("id_caso", "nombre_caso", "estado", "presupuesto_estimado", "fecha_salida")},
            refresh=N.dash_expenses,
            laid_out=True,
        ),
        _gold(
            "dashboard_financiero",
            ["silver.donaciones", "silver.gastos", "silver.casos"],
            lambda spark, s, i: G.dash_finance(
                *G.finance_rows(i["silver.donaciones"], i["silver.gastos"], i["silver.casos"]),
                s.scale,
            ),
            reads={
                "silver.donaciones": _DONATION,
                "silver.gastos": _EXPENSE,
                "silver.casos": ("id_caso", "presupuesto_estimado"),
            },
            refresh=N.dash_finance,
            uses=("scale",),
        ),
    ]
}

# Tables a refresh looks at besides the inputs.
_BESIDES = {"gold.dashboard_financiero": ("parts.caso_mes",), "gold.dashboard_gastos": ("parts.caso_mes",)}


def layer_targets(layer: str) -> list[str]:
    return [t.name for t in TABLES.values() if t.layer == layer]


def needed(targets: Iterable[str], stored: bool = False) -> dict[str, set[str]]:
    """Targets and all their upstream tables, each with its direct inputs; raw excluded. With
    ``stored`` also what a later refresh looks at."""
    graph: dict[str, set[str]] = {}
    todo = list(targets)
    while todo:
        name = todo.pop()
        if name in graph or name.startswith("raw."):
            continue
        graph[name] = {*TABLES[name].inputs, *(_BESIDES.get(name, ()) if stored else ())}
        todo += graph[name]
    return graph


def generations(targets: Iterable[str], stored: bool = False) -> list[list[str]]:
    """Tables in dependency order, grouped by what can run side by side."""
    sorter = TopologicalSorter(needed(targets, stored))
    sorter.prepare()
    out = []
    while sorter.is_active():
        ready = sorter.get_ready()
        out.append(sorted(n for n in ready if n in TABLES))
        sorter.done(*ready)
    return [g for g in out if g]


def _path(root: str, table: Table) -> str:
    return f"{root}/{table.name.replace('.', '/')}"


_VALID, _REJECTED = "rejected=false", "rejected=true"


def _read(spark: SparkSession, root: str, name: str, version: int) -> DataFrame:
    """Rows of a version, of a cleaned table the valid ones."""
    table = TABLES[name]
    if table.layer != "silver":
        return versioned.read(spark, _path(root, table), version)
    return versioned.read(spark, _path(root, table), version, lambda p: p.startswith(_VALID)).drop(dq.ERRORS, "rejected")


def _of_months(rows: DataFrame, months: set[str]) -> DataFrame:
    """Rows of some partitions by month; a filter on partition columns alone, so no others are read."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(versioned.NO_VALUE))
    return rows.filter(F.concat(F.lit("y="), value("y"), F.lit("/m="), value("m")).isin(sorted(months)))


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table as of the last complete run; of a cleaned one the valid rows."""
    version = runs.current(spark, root).tables.get(name)
    if version is None:
        raise FileNotFoundError(f"no complete run has {name} below {root}")
    return _read(spark, root, name, version)


def _fingerprint(s: Settings) -> str:
    """What the values of curated tables depend on besides their inputs; a run with other settings cannot
    take rows from an older one, see ``Table.uses``."""
    values = {k: v for k, v in vars(s).items() if k not in ("month", "run_id")}
    values["as_of"] = s.as_of or dt.date.today()
    return json.dumps(values, default=str, sort_keys=True)


def _used(table: Table, fingerprint: str) -> dict:
    """The settings of a fingerprint that the table depends on."""
    return {k: v for k, v in json.loads(fingerprint).items() if table.uses is None or k in table.uses}


class _Run:
    """One stored run: the set it starts from, the versions it has written so far."""

    def __init__(self, spark: SparkSession, root: str, s: Settings) -> None:
        self.spark, self.root, self.s = spark, root, s
        self.base = runs.current(spark, root)
        self.pinned = runs.pinned(spark, root)
        self.versions = dict(self.base.tables)
        self.marks = dict(self.base.marks)
        self.made = dict(self.base.settings)
        self.run_id = s.run_id or uuid.uuid4().hex
        self.settings = _fingerprint(s)
        self.frames: dict[tuple[str, int], DataFrame] = {}

    def _version(self, name: str, version: int, months: set[str] | None) -> DataFrame:
        # Files of a version never change, so they are listed once in a run.
        if (name, version) not in self.frames:
            self.frames[name, version] = _read(self.spark, self.root, name, version)
        rows = self.frames[name, version]
        return rows if months is None else _of_months(rows, months)

    def read(self, name: str, months: set[str] | None = None) -> DataFrame:
        return self._version(name, self.versions[name], months)

    def _old(self, name: str, months: set[str] | None = None) -> DataFrame:
        return self._version(name, self.base.tables[name], months)

    def _changed(self, name: str) -> set[str]:
        path = _path(self.root, TABLES[name])
        old, new = (versioned.manifest(self.spark, path, v[name]) for v in (self.base.tables, self.versions))
        parts = versioned.changed(old, new)
        if TABLES[name].layer == "silver":
            return {p.removeprefix(f"{_VALID}/") for p in parts if p.startswith(_VALID)}
        return parts

    def _months(self, table: Table) -> dict:
        if table.partition_date:
            return partition_columns(F.col(table.partition_date), day=None)
        return {c: F.col(c) for c in table.partitions}

    def _options(self, table: Table, tagged: bool = False) -> dict:
        options = {"base": self.base.tables.get(table.name, 0), "pinned": self.pinned.get(table.name, ())}
        if table.layer == "silver":
            bad = (F.size(dq.ERRORS) > 0) if tagged else F.lit(False)
            options["counts"] = {"valid": F.count_if(~bad), "rejected": F.count_if(bad)}
        return options

    def _done(self, table: Table, version: int) -> None:
        self.versions[table.name] = version
        self.made[table.name] = self.settings

    def _put(self, table: Table, df: DataFrame, known: DataFrame | None = None, n_raw: int | None = None) -> None:
        """Store a cleaned table: as a whole, or the rows of the keys ``known`` only."""
        path, tagged = _path(self.root, table), dq.ERRORS in df.columns
        flag = (F.size(dq.ERRORS) > 0) if tagged else F.lit(False)
        parts, options = {"rejected": flag.cast("string"), **self._months(table)}, self._options(table, tagged)
        if known is None:
            options["counts"] |= {} if n_raw is None else {"raw": n_raw}
            self._done(table, versioned.commit(self.spark, path, df, parts, **options))
            if not versioned.manifest(self.spark, path, self.versions[table.name]).counts["rejected"]:
                return
            rejected = versioned.read(self.spark, path, self.versions[table.name], lambda p: p.startswith(_REJECTED)).drop(*parts)
        else:
            self._done(table, versioned.replace_keys(self.spark, path, known, df, [_key(table)], parts, **options))
            if not tagged:
                return
            rejected = df
        append_quarantine(rejected, f"{self.root}/quarantine/{table.name.split('.')[1]}", self.run_id, table.name)

    def clean(self, table: Table, raw: DataFrame | None) -> None:
        """A cleaned table from its raw rows, or the part of it that a month run may change. Without raw
        rows the stored one stays."""
        stored = table.name in self.base.tables
        if raw is None:
            if not stored:
                raise KeyError(f"neither raw nor stored rows of {table.name}")
            return
        if not (self.s.month and table.partition_date):
            n_raw = raw.count()
            if n_raw or not stored:
                self._put(table, table.build(self.spark, self.s, {table.inputs[0]: raw}), n_raw=n_raw)
            return
        name, keys = table.name.split(".")[1], [_key(table)]
        typed = conform(raw, SCHEMAS[name])
        seen = month_slice(typed, table.partition_date, self.s.month).select(*keys)
        if stored:
            first, _ = month_bounds(self.s.month)
            place = f"/y={first.year}/m={first.month:02d}"
            here = versioned.read(self.spark, _path(self.root, table), self.base.tables[table.name], lambda p: p.endswith(place))
            seen = seen.unionByName(here.select(*keys))
        known = self._scratch(seen.distinct(), f"{name}-keys")
        rows = table.build(self.spark, self.s, {table.inputs[0]: versioned.of_keys(typed, known, keys)})
        self._put(table, self._scratch(rows, f"{name}-rows"), known)

    def load(self, table: Table, source: DataFrame | None, full: bool) -> None:
        """A cleaned table from what changed since its mark; the new mark counts when the run is published.

        The rows are copied, so that all that follows sees the same ones. The first load of a table whose source
        is files does without: they are counted, and the mark is found, in front of the write, so a row that
        comes later is read again by the next load.
        """
        name = table.name.split(".")[1]
        policy, stored = POLICIES[name], table.name in self.base.tables
        if source is None:
            return self.clean(table, None)
        since = marks.parse_mark(self.marks[name]) if stored and name in self.marks else None
        rows = extract(source, policy, since, full=full)
        if stored or not source.inputFiles():
            rows = self._scratch(rows, f"{name}-raw")
        newest = marks.newest_change(rows, policy.change_column) if policy.change_column else F.lit(None)
        n_raw, until = rows.agg(F.count(F.lit(1)), newest).first()
        if stored and not n_raw:
            return
        cleaned = table.build(self.spark, self.s, {table.inputs[0]: rows})
        if full or not stored or policy.load is Load.SNAPSHOT or not policy.change_column:
            self._put(table, cleaned, n_raw=n_raw)
        else:
            flag = (F.size(dq.ERRORS) > 0) if dq.ERRORS in cleaned.columns else F.lit(False)
            parts, options = {"rejected": flag.cast("string"), **self._months(table)}, self._options(table, dq.ERRORS in cleaned.columns)
            cleaned = self._scratch(cleaned, f"{name}-rows")
            at = versioned.upsert(self.spark, _path(self.root, table), cleaned, [policy.key], [policy.change_column], parts, **options)
            self._done(table, at)
            if dq.ERRORS in cleaned.columns:
                append_quarantine(cleaned, f"{self.root}/quarantine/{name}", self.run_id, table.name, once=True)
        until = marks.from_micros(until)
        if until is not None and (since is None or until > since):
            self.marks[name] = until.isoformat()

    def judge(self, table: Table) -> None:
        """A stored cleaned table under other rules: the rows whose verdict changes move, no other is written.

        The table holds the current version of each key, rejected or not, so what is admitted again is that
        version and not an older one, and nothing is read from the raw rows.
        """
        path = _path(self.root, table)
        rows = versioned.read(self.spark, path, self.base.tables[table.name]).drop("rejected", *self._months(table))
        again = dq.tag(rows.withColumnRenamed(dq.ERRORS, "__old"), table.rules(self.s))
        moved = self._scratch(again.filter(F.col(dq.ERRORS) != F.col("__old")).drop("__old"), f"{table.name}-judged")
        if moved.isEmpty():
            self.made[table.name] = self.settings
            return
        self._put(table, moved, self._scratch(moved.select(_key(table)).distinct(), f"{table.name}-keys"))

    def _scratch(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label, f"{self.root}/scratch")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def curate(self, table: Table, inputs: Mapping[str, DataFrame]) -> None:
        """A curated table: from what changed, where the base set allows it, else from its whole inputs."""
        path, options = _path(self.root, table), self._options(table)
        looked_at = {table.name, *table.inputs, *_BESIDES.get(table.name, ())}
        same = looked_at <= set(self.base.tables) and self._comparable(table, looked_at)
        if same and all(self.versions[n] == self.base.tables[n] for n in looked_at):
            self.made[table.name] = self.settings
            return
        if same and table.refresh and not any(self._whole(n) for n in looked_at - {table.name}):
            change = N.Change(self.spark, self.s, self.read, self._old, self._changed)
            rows, months, laid_out = table.refresh(change)
            replaced = (lambda p: True) if months is None else (lambda p: p in months)
            if months is None or months:
                self._done(table, versioned.commit(self.spark, path, rows, self._months(table), replaced, laid_out=laid_out, **options))
            self.made[table.name] = self.settings
            return
        rows = table.build(self.spark, self.s, inputs)
        self._done(table, versioned.commit(self.spark, path, rows, self._months(table), laid_out=table.laid_out, **options))

    def _comparable(self, table: Table, looked_at: set[str]) -> bool:
        """The base set was made with one group of settings, and those that the table depends on are the same now.
        What other settings change in its inputs shows in their manifests."""
        before = self.base.settings[table.name]
        one = all(self.base.settings[n] == before for n in looked_at)
        return one and _used(table, before) == _used(table, self.settings) and (
            table.uses is not None or all(self.made[n] == before for n in looked_at)
        )

    def _whole(self, name: str) -> bool:
        """The table has other columns now, or all months of a dated one were written again: nothing to
        gain from a comparison."""
        table = TABLES[name]
        old, new = (versioned.manifest(self.spark, _path(self.root, table), v[name]) for v in (self.base.tables, self.versions))
        if old.columns != new.columns:
            return True
        dated = table.partition_date or table.layer == "parts"
        return bool(dated) and old.number != new.number and set(new.where.values()) == {new.number}

    def publish(self) -> None:
        runs.publish(self.spark, self.root, self.versions, self.marks, self.made)


def _key(table: Table) -> str:
    return POLICIES[table.name.split(".")[1]].key


def run_counts(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, raw, deduplicated, valid, rejected) of the cleaned tables of the last complete run,
    as counted by the tasks that wrote them. No table is read. ``raw`` is what the run was given."""
    base = runs.current(spark, root)
    rows = []
    for name in layer_targets("silver"):
        if name in base.tables:
            c = versioned.manifest(spark, _path(root, TABLES[name]), base.tables[name]).counts
            rows.append((name, c.get("raw"), c["valid"] + c["rejected"], c["valid"], c["rejected"]))
    return spark.createDataFrame(rows, "table_name string, raw bigint, deduplicated bigint, valid bigint, rejected bigint")


def _in_order(targets: list[str], build: Callable[[str], None], stored: bool = False) -> None:
    """Build every table as soon as its inputs are there; tables that wait for nothing run side by side."""
    sorter = TopologicalSorter(needed(targets, stored))
    sorter.prepare()
    running: dict[Future, str] = {}
    with ThreadPoolExecutor(max_workers=8) as pool:
        while sorter.is_active():
            for name in sorter.get_ready():
                if name in TABLES:
                    running[pool.submit(build, name)] = name
                else:
                    sorter.done(name)
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(done)
                done.result()
                sorter.done(name)


def _all(spark: SparkSession, job: _Run, targets: list[str], clean: Callable[[Table], None]) -> dict[str, DataFrame]:
    def build(name: str) -> None:
        table = TABLES[name]
        if table.layer == "silver":
            clean(table)
        else:
            job.curate(table, {n: job.read(n) for n in table.inputs})

    _in_order(targets, build, stored=True)
    job.publish()
    return {name: job.read(name) for name in targets}


def judge_again(
    spark: SparkSession, root: str, settings: Settings, targets: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """Apply changed rules (``settings``) to the stored cleaned tables: rejected rows that pass now are
    admitted, valid ones that fail are rejected, and the targets (all stored curated tables by default) follow
    in the same commit (SNK-4, DQ-17). Equal to a full run with these rules over the same raw rows.
    """
    job = _Run(spark, root, settings)
    if targets is None:
        targets = [n for n in job.base.tables if TABLES[n].layer != "silver"]
    judged = [t for t in TABLES.values() if t.rules and t.name in job.base.tables]
    return _all(spark, job, [*targets, *[t.name for t in judged]], lambda t: job.judge(t) if t in judged else job.clean(t, None))


def run_increment(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    targets: Iterable[str],
    settings: Settings = Settings(),
    full: bool = False,
) -> dict[str, DataFrame]:
    """The targets after whatever the sources changed since the last complete run.

    Rows at or after a table's mark are read once and merged by key; snapshot tables, and all tables with
    ``full``, are replaced. Curated tables follow by change. Tables and marks are published together, so a
    run that dies is repeated from the old marks over the old tables.
    """
    job = _Run(spark, root, settings)
    return _all(spark, job, list(targets), lambda t: job.load(t, sources.get(t.name.split(".")[1]), full))


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    targets: Iterable[str],
    settings: Settings = Settings(),
    store_targets: bool = True,
) -> dict[str, DataFrame]:
    """Build the targets and whatever they need below ``root``.

    A full run replaces cleaned tables as a whole, so a month that lost all its rows disappears; see
    ``Settings.month`` for a run over one month. A cleaned table without any raw row keeps what is
    stored. Readers (``read``) see all new tables at once, when the run is complete. With
    ``store_targets=False`` nothing is published: the targets come back as plans, over scratch
    copies of what several tables read.
    """
    targets = list(targets)
    if not store_targets:
        return _report(spark, raw, root, targets, settings)
    job = _Run(spark, root, settings)
    return _all(spark, job, targets, lambda t: job.clean(t, raw.get(t.name.split(".")[1])))


def _report(
    spark: SparkSession, raw: Mapping[str, DataFrame], root: str, targets: list[str], settings: Settings
) -> dict[str, DataFrame]:
    """Plans of the targets. A table that several others read is stored first: valid rows only, with the
    columns they read, and no layout by month, as it is read once or twice and thrown away."""
    graph = needed(targets)
    readers = {n: [t for t, inputs in graph.items() if n in inputs] for n in graph}
    done: dict[str, DataFrame] = {f"raw.{name}": df for name, df in raw.items()}

    def build(name: str) -> None:
        table = TABLES[name]
        df = table.build(spark, settings, done)
        if table.layer == "silver" and name not in targets:
            df = dq.valid_rows(df) if dq.ERRORS in df.columns else df
        if name not in targets and not table.row_wise and len(readers[name]) > 1:
            wanted = [TABLES[t].reads.get(name) for t in readers[name]]
            if all(wanted):
                df = df.select(*[c for c in df.columns if any(c in w for w in wanted)])
            path = scratch_path(spark, name, root)
            df.write.parquet(path)
            df = spark.read.schema(df.schema).parquet(path)
        done[name] = df

    _in_order(targets, build)
    return {name: done[name] for name in targets}

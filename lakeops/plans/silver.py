"""Cleaned layer: one function per entity, raw frame in, tagged frame out (SLV-1..6).

The result carries ``dq_errors``; ``quality.valid_rows`` and ``quality.quarantined_rows``
split it. Entities without rules come back clean.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import conform
from ..functions.dates import AsOf, as_of_instant
from ..functions.text import (
    lower_trim,
    or_default,
    pattern_category,
    title_or_default,
    upper_trim,
    word_category,
)
from ..operators import quality as dq
from ..operators.dedup import latest_by_key
from ..operators.filters import after_mark, month_slice, partition_month_slice, require
from ..sinks.writers import drop_partition_columns
from ..sources.schemas import SCHEMAS
from . import rules as R


def _audit(as_of: AsOf, source: str) -> dict[str, Column]:
    """Ingest time (one per run) and origin of a row."""
    return {"fecha_ingesta": as_of_instant(as_of), "fuente": F.lit(source)}


def _text(name: str, clean, default: str) -> Column:
    return or_default(clean(F.col(name)), default)


def donation_rules(as_of: AsOf = None, first_day: dt.date = R.FIRST_VALID_DAY) -> list[dq.Rule]:
    return [
        dq.negative("MONTO_NEGATIVO", "monto"),
        dq.in_future("FECHA_FUTURA", "fecha_donacion", as_of),
        dq.missing("ID_NULO", "id_donacion"),
        dq.before("FECHA_ANTERIOR_A_2010", "fecha_donacion", first_day),
    ]


def donor_rules() -> list[dq.Rule]:
    return [
        dq.bad_email("EMAIL_INVALIDO", "correo", R.DONOR_EMAIL),
        dq.missing("ID_NULO", "id_donante"),
    ]


def case_rules(as_of: AsOf = None, first_day: dt.date = R.FIRST_VALID_DAY) -> list[dq.Rule]:
    return [
        dq.missing("ID_CASO_NULO", "id_caso"),
        dq.outside("FECHA_INGRESO_INVALIDA", "fecha_ingreso", first_day, as_of),
        dq.still_default("NOMBRE_CASO_NULO", "nombre_caso", R.CASE_NAME),
    ]


def donations(
    raw: DataFrame,
    as_of: AsOf = None,
    mark: dt.datetime | None = None,
    month: str | None = None,
    first_day: dt.date = R.FIRST_VALID_DAY,
) -> DataFrame:
    typed = conform(raw, SCHEMAS["donaciones"])
    typed = month_slice(after_mark(typed, "last_modified_at", mark), "fecha_donacion", month)
    clean = typed.withColumns(
        {
            "id_donante": or_default(F.col("id_donante"), R.NO_DONOR),
            "id_caso": or_default(F.col("id_caso"), R.NO_CASE),
            "created_at": F.coalesce("created_at", "fecha_donacion"),
            "last_modified_at": F.coalesce("last_modified_at", "fecha_donacion"),
            "medio_pago": pattern_category(
                F.col("medio_pago"), R.DONATION_PAYMENT, when_null=R.PAYMENT_MISSING
            ),
            "estado": word_category(
                F.col("estado"), R.DONATION_STATUS, R.STATUS_OPEN, when_null=R.DONATION_DONE
            ),
        }
        | _audit(as_of, "raw_donaciones")
    )
    latest = latest_by_key(
        drop_partition_columns(clean), ["id_donacion"], ["last_modified_at"]
    )
    return dq.tag(latest, donation_rules(as_of, first_day))


def expenses(
    raw: DataFrame,
    as_of: AsOf = None,
    mark: dt.datetime | None = None,
    month: str | None = None,
) -> DataFrame:
    """Rows without amount or supplier are rejected outright; there is no quarantine."""
    typed = conform(partition_month_slice(raw, month), SCHEMAS["gastos"])
    typed = after_mark(typed, "last_modified_at", mark)
    clean = require(typed, "monto", "id_proveedor").withColumn("id_caso", or_default(F.col("id_caso"), R.NO_CASE))
    latest = latest_by_key(
        drop_partition_columns(clean),
        ["id_gasto"],
        ["last_modified_at"],
        ["created_at", "monto", "id_caso", "id_proveedor"],
    )
    # What plays no part in the ranking is cleaned after it: fewer rows, and less of them in the shuffle.
    return latest.withColumns(
        {
            "medio_pago": pattern_category(
                F.col("medio_pago"), R.EXPENSE_PAYMENT, when_null=R.PAYMENT_MISSING
            ),
            "estado": word_category(
                F.col("estado"), R.EXPENSE_STATUS, R.STATUS_OPEN, when_null=R.EXPENSE_DONE
            ),
        }
        | _audit(as_of, "raw_gastos")
    )


def donors(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    clean = conform(raw, SCHEMAS["donantes"]).withColumns(
        {
            "donante": _text("donante", upper_trim, R.DONOR_NAME),
            "correo": _text("correo", lower_trim, R.DONOR_EMAIL),
            "telefono": _text("telefono", F.trim, R.DONOR_PHONE),
            "ciudad": _text("ciudad", lower_trim, R.CITY),
            "pais": title_or_default(F.col("pais"), R.COUNTRY),
            "canal_origen": _text("canal_origen", lower_trim, R.DONOR_CHANNEL),
        }
        | _audit(as_of, "raw_donantes")
    )
    latest = latest_by_key(drop_partition_columns(clean), ["id_donante"], ["last_modified_at"])
    return dq.tag(latest, donor_rules())


def cases(raw: DataFrame, as_of: AsOf = None, first_day: dt.date = R.FIRST_VALID_DAY) -> DataFrame:
    """A snapshot table: always processed whole, whatever the mark."""
    clean = conform(raw, SCHEMAS["casos"]).withColumns(
        {
            "id_hogar_de_paso": or_default(F.col("id_hogar_de_paso"), R.NO_HOME),
            "presupuesto_estimado": or_default(F.col("presupuesto_estimado"), R.CASE_BUDGET),
            "nombre_caso": _text("nombre_caso", lower_trim, R.CASE_NAME),
            "veterinaria": _text("veterinaria", lower_trim, R.CASE_CLINIC),
            "diagnostico": _text("diagnostico", lower_trim, R.CASE_DIAGNOSIS),
            "ciudad": _text("ciudad", lower_trim, R.CITY),
            "estado": F.lit(R.CASE_STATUS),
        }
        | _audit(as_of, "raw_casos")
    )
    latest = latest_by_key(drop_partition_columns(clean), ["id_caso"], ["last_modified_at"])
    return dq.tag(latest, case_rules(as_of, first_day))


def suppliers(raw: DataFrame) -> DataFrame:
    clean = conform(raw, SCHEMAS["proveedores"]).withColumns(
        {
            "nombre_proveedor": upper_trim(F.col("nombre_proveedor")),
            "correo": lower_trim(F.col("correo")),
        }
    )
    return latest_by_key(clean, ["id_proveedor"], ["last_modified_at"])


def homes(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Not deduplicated: the source has no change time."""
    clean = conform(raw, SCHEMAS["hogar_de_paso"]).withColumns(
        {
            "fecha_ingesta": as_of_instant(as_of),
            "nombre_hogar": _text("nombre_hogar", upper_trim, R.HOME_NAME),
            "tipo_hogar": _text("tipo_hogar", F.trim, R.HOME_TYPE),
            "cupo_maximo": or_default(F.col("cupo_maximo"), 0),
            "tarifa_diaria": or_default(F.col("tarifa_diaria"), 0.0),
        }
    )
    return dq.tag(
        clean,
        [
            dq.negative("CUPO_NEGATIVO", "cupo_maximo"),
            dq.negative("TARIFA_NEGATIVA", "tarifa_diaria"),
            dq.still_default("NOMBRE_HOGAR_NULO", "nombre_hogar", R.HOME_NAME),
        ],
    )

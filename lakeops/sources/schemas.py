"""Typed registry of the entities (SRC-10) and their load policy (SRC-6)."""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

from pyspark.sql import types as T

# Entity, column and type names of the data model.
SCHEMAS = {
    "donaciones": T.StructType()
    .add("id_donacion", "long")
    .add("id_donante", "long")
    .add("id_caso", "long")
    .add("fecha_donacion", "timestamp")
    .add("monto", "double")
    .add("medio_pago", "string")
    .add("estado", "string")
    .add("comprobante", "string")
    .add("created_at", "timestamp")
    .add("last_modified_at", "timestamp"),
    "gastos": T.StructType()
    .add("id_gasto", "long")
    .add("nombre_gasto", "string")
    .add("fecha_pago", "timestamp")
    .add("id_caso", "long")
    .add("medio_pago", "string")
    .add("monto", "double")
    .add("estado", "string")
    .add("comprobante", "string")
    .add("id_proveedor", "long")
    .add("created_at", "timestamp")
    .add("last_modified_at", "timestamp"),
    "donantes": T.StructType()
    .add("id_donante", "long")
    .add("donante", "string")
    .add("tipo_id", "string")
    .add("identificacion", "string")
    .add("correo", "string")
    .add("telefono", "string")
    .add("ciudad", "string")
    .add("tipo_donante", "string")
    .add("pais", "string")
    .add("canal_origen", "string")
    .add("consentimiento", "boolean")
    .add("notas", "string")
    .add("archivos", "string")
    .add("created_at", "timestamp")
    .add("last_modified_at", "timestamp"),
    "casos": T.StructType()
    .add("id_caso", "long")
    .add("nombre_caso", "string")
    .add("estado", "string")
    .add("fecha_ingreso", "timestamp")
    .add("fecha_salida", "timestamp")
    .add("veterinaria", "string")
    .add("diagnostico", "string")
    .add("archivo", "string")
    .add("id_hogar_de_paso", "long")
    .add("presupuesto_estimado", "double")
    .add("ciudad", "string")
    .add("created_at", "timestamp")
    .add("last_modified_at", "timestamp"),
    "proveedores": T.StructType()
    .add("id_proveedor", "long")
    .add("nombre_proveedor", "string")
    .add("tipo_proveedor", "string")
    .add("nit", "string")
    .add("nombre_contacto", "string")
    .add("correo", "string")
    .add("telefono", "string")
    .add("ciudad", "string")
    .add("created_at", "timestamp")
    .add("last_modified_at", "timestamp"),
    "hogar_de_paso": T.StructType()
    .add("id_hogar_de_paso", "long")
    .add("nombre_hogar", "string")
    .add("tipo_hogar", "string")
    .add("nombre_contacto", "string")
    .add("correo", "string")
    .add("telefono", "string")
    .add("ciudad", "string")
    .add("pais", "string")
    .add("cupo_maximo", "integer")
    .add("tarifa_diaria", "double")
    .add("desempeno", "string")
    .add("ultimo_contacto", "timestamp")
    .add("notas", "string"),
}

TIMESTAMP_COLUMNS = sorted(
    {f.name for s in SCHEMAS.values() for f in s.fields if isinstance(f.dataType, T.TimestampType)}
)

# Columns a table must have.
REQUIRED_COLUMNS = {
    "donaciones": ["id_donacion", "fecha_donacion", "monto", "id_donante"],
    "gastos": ["id_gasto", "fecha_pago", "monto", "id_proveedor"],
    "donantes": ["id_donante", "donante", "correo"],
    "casos": ["id_caso", "nombre_caso", "fecha_ingreso"],
    "proveedores": ["id_proveedor", "nombre_proveedor"],
}


class Load(Enum):
    SNAPSHOT = "snapshot"
    MERGE_BY_KEY = "merge_by_key"


@dataclass(frozen=True)
class Policy:
    """How a table is loaded: its key, the column that tells changes, its business date."""

    key: str
    load: Load
    change_column: str | None = "last_modified_at"
    business_date: str | None = None


POLICIES = {
    "donaciones": Policy("id_donacion", Load.MERGE_BY_KEY, business_date="fecha_donacion"),
    "gastos": Policy("id_gasto", Load.MERGE_BY_KEY, business_date="fecha_pago"),
    "donantes": Policy("id_donante", Load.MERGE_BY_KEY),
    "casos": Policy("id_caso", Load.SNAPSHOT),
    "proveedores": Policy("id_proveedor", Load.SNAPSHOT),
    "hogar_de_paso": Policy("id_hogar_de_paso", Load.SNAPSHOT, change_column=None),
}

"""Business values of the animal-rescue data set.

Fixed values throughout: words, labels, codes, defaults and thresholds that results must
carry literally. Operators take them as arguments; nothing else in the package knows them.
"""

import datetime as dt

# Placeholder keys for a missing donor, case and foster home.
NO_DONOR = 541
NO_CASE = 541
NO_HOME = 9

FIRST_VALID_DAY = dt.date(2010, 1, 1)

# Payment method: missing, then pattern -> label. Expenses use the narrower first pattern.
PAYMENT_MISSING = "nequi"
DONATION_PAYMENT = [("%transfer%", "transferencia"), ("%tarjeta%", "tarjeta")]
EXPENSE_PAYMENT = [("%transferencia%", "transferencia"), ("%tarjeta%", "tarjeta")]

# Status words.
DONATION_STATUS = {
    "completada": ["aprobada", "confirmada", "confirmado", "exitosa", "exitoso", "completada"],
    "fallida": ["fallida", "rechazada", "cancelada", "error"],
}
EXPENSE_STATUS = {"pagado": ["pagado", "exitoso", "completado", "aprobado"]}
DONATION_DONE = "completada"
EXPENSE_DONE = "pagado"
STATUS_OPEN = "pendiente"
CASE_STATUS = "no urgente"
CASE_URGENT = "urgente"

# Defaults of missing attributes.
DONOR_NAME = "ANONIMO"
DONOR_EMAIL = "desconocido"
DONOR_PHONE = "nn"
DONOR_CHANNEL = "desconocido"
CITY = "bogota"
COUNTRY = "Colombia"
CASE_NAME = "anonimo"
CASE_CLINIC = "cba"
CASE_DIAGNOSIS = "reservado"
CASE_BUDGET = 3_500_000.0
HOME_NAME = "SIN NOMBRE"
HOME_TYPE = "temporario"

# Declared bounds for optional rules.
AMOUNT_BOUNDS = (0.0, 100_000_000.0)
RECENT_YEARS = 5

# Buckets: ordered (comparison, bound, label) and the label of everything else.
DONATION_AMOUNT = ([("<", 50_000, "Bajo"), ("<", 200_000, "Medio")], "Alto")
DONATION_SIZE = ([(">=", 500_000, "critica"), (">=", 200_000, "media")], "pequena")
DONATION_CRITICAL = 500_000
DONOR_TIER = (
    [(">", 2_000_000, "oro"), (">", 700_000, "plata"), (">", 200_000, "bronce")],
    "basico",
)
DONOR_RECURRENT = 3
EXPENSE_AMOUNT = (
    [("<", 200_000, "Pequeño"), ("between", (200_000, 400_000), "Mediano")],
    "Grande",
)
CASE_COST = (
    [(">", 1_000_000, "Critico"), (">", 500_000, "Alto"), (">", 100_000, "Medio")],
    "Bajo",
)
CASE_HIGH_COST = 1_000_000
SUPPLIER_IMPORTANCE = (
    [(">", 5_000_000, "Socio Estratégico"), (">", 1_000_000, "Proveedor Frecuente")],
    "Transaccional",
)
OCCUPANCY = ([(">", 0.85, "Alta"), ("between", (0.40, 0.85), "Media")], "Baja")
TURNOVER = (
    [(">", 0.7, "Alta rotación"), ("between", (0.3, 0.7), "Media")],
    "Baja rotación",
)
MONTH_STATE = ([(">", 0, "Superávit"), ("<", 0, "Déficit")], "Equilibrado")
SUPPLIER_CATEGORY = (
    [
        ("%veterinario%", "Servicios Veterinarios"),
        ("%insumo%", "Insumos"),
        ("%transporte%", "Logística"),
    ],
    "General",
)

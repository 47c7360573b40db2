"""Cleaned and curated tables of the whole data set, built through the table registry."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from ..functions.numbers import total
from ..operators import quality as dq
from ..operators.calendar import calendar_span, with_calendar
from ..operators.reconcile import stack
from ..plans import bindings as B
from ..plans import gold as G
from ..plans import registry
from ..plans import silver as S
from ..plans.exports import export_gold
from ..session import scratch_path
from . import query

SETTINGS = registry.Settings(
    as_of=B.AS_OF,
    scale=B.CENTS,
    first_day=B.FIRST_DAY,
    calendar=B.CALENDAR,
    critical=B.CRITICAL,
    size=B.SIZE,
    expense_amount=B.EXPENSE_AMOUNT,
)


def build(spark, sf, target):
    """One curated table; its inputs are stored below the scratch folder first."""
    out = registry.run(
        spark,
        B.raw_tables(spark, sf),
        scratch_path(spark, "layers"),
        [target],
        SETTINGS,
        store_targets=False,
    )
    return out[target]


# The same tables in SQL ------------------------------------------------------------------

_ERR = "list_filter([{}], lambda x: x IS NOT NULL)"

DON = """don_all AS (SELECT o_orderkey AS id_donacion,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey ELSE 541 END AS id_donante,
    CASE WHEN o_orderkey % 15 <> 0 THEN o_orderkey % 2000 ELSE 541 END AS id_caso,
    o_orderdate AS fecha_donacion,
    CASE WHEN o_orderkey % 101 = 0 THEN -o_totalprice ELSE o_totalprice END AS monto,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'transferencia' WHEN '2-HIGH' THEN 'transferencia'
      WHEN '3-MEDIUM' THEN 'tarjeta' WHEN '5-LOW' THEN 'efectivo' ELSE 'nequi' END AS medio_pago,
    CASE WHEN o_orderkey % 13 = 0 OR o_orderstatus = 'F' THEN 'completada'
      WHEN o_orderstatus = 'P' THEN 'fallida' ELSE 'pendiente' END AS estado,
    'c-' || o_orderkey AS comprobante, o_orderdate AS created_at,
    o_orderdate AS last_modified_at,
    list_filter([CASE WHEN o_orderkey % 101 = 0 THEN 'MONTO_NEGATIVO' END,
      CASE WHEN o_orderdate > TIMESTAMP '2002-01-01' THEN 'FECHA_FUTURA' END,
      CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'FECHA_ANTERIOR_A_2010' END],
      lambda x: x IS NOT NULL) AS codes FROM orders),
  don AS (SELECT * FROM don_all WHERE len(codes) = 0)"""

GAS = """gas AS (SELECT * FROM (SELECT l_orderkey * 10 + l_linenumber AS id_gasto,
      'gasto ' || l_returnflag AS nombre_gasto, l_shipdate AS fecha_pago,
      CASE WHEN l_partkey % 50 = 0 THEN 541 WHEN l_partkey % 33 = 0 THEN l_partkey + 1000000000
        ELSE l_partkey END AS id_caso,
      CASE l_returnflag WHEN 'A' THEN 'transferencia' WHEN 'N' THEN 'transfer' ELSE 'tarjeta' END
        AS medio_pago, l_extendedprice AS monto,
      CASE l_linestatus WHEN 'F' THEN 'pagado' ELSE 'pendiente' END AS estado,
      'g-' || l_orderkey AS comprobante, l_suppkey AS id_proveedor, l_shipdate AS created_at,
      l_shipdate AS last_modified_at
    FROM lineitem WHERE NOT (l_linenumber = 7 AND l_tax = 0) AND l_suppkey % 40 <> 0)
  QUALIFY row_number() OVER (PARTITION BY id_gasto ORDER BY last_modified_at DESC,
    created_at DESC, monto DESC, id_caso DESC, id_proveedor DESC) = 1)"""

DNT = """dnt_all AS (SELECT c_custkey AS id_donante,
    CASE WHEN c_custkey % 40 <> 0 THEN upper(c_name) ELSE 'ANONIMO' END AS donante,
    CASE c_custkey % 6 WHEN 0 THEN 'desconocido' WHEN 1 THEN 'sin correo'
      ELSE 'c' || c_custkey || '@mail.org' END AS correo,
    CASE WHEN c_custkey % 3 <> 0 THEN '57-' || c_custkey ELSE 'nn' END AS telefono,
    lower(c_mktsegment) AS ciudad,
    CASE WHEN c_nationkey IN (3, 4) THEN 'Colombia' ELSE array_to_string(list_transform(
      string_split(lower(replace(n_name, '_', ' ')), ' '), lambda x: upper(x[1]) || x[2:]), ' ')
      END AS pais,
    CASE WHEN c_acctbal > 0 THEN lower(c_mktsegment) ELSE 'desconocido' END AS canal_origen,
    CAST(DATE '1994-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS TIMESTAMP) AS created_at
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
  dnt AS (SELECT * FROM dnt_all WHERE correo <> 'sin correo')"""

CAS = """cas_all AS (SELECT p_partkey AS id_caso,
    CASE WHEN p_partkey % 70 <> 0 THEN lower(p_name) ELSE 'anonimo' END AS nombre_caso,
    'no urgente' AS estado,
    CAST(DATE '1995-06-01' + CAST(p_partkey * 7 % 1500 AS INTEGER) AS TIMESTAMP) AS fecha_ingreso,
    CASE WHEN p_size <= 25 THEN CAST(DATE '1995-06-01' + CAST(p_partkey * 7 % 1500 AS INTEGER) + p_size
      AS TIMESTAMP) END AS fecha_salida,
    CASE WHEN p_size % 3 = 0 THEN lower(p_brand) ELSE 'cba' END AS veterinaria,
    lower(p_type) AS diagnostico, 'bogota' AS ciudad,
    CASE WHEN p_size % 9 <> 0 THEN p_partkey % 25 ELSE 9 END AS id_hogar_de_paso,
    CASE WHEN p_size % 7 <> 0 THEN p_retailprice * 50 ELSE 3500000.0 END AS presupuesto_estimado
    FROM part),
  cas_tag AS (SELECT *, list_filter([
      CASE WHEN fecha_ingreso < TIMESTAMP '1996-01-01' OR fecha_ingreso > TIMESTAMP '2002-01-01'
        THEN 'FECHA_INGRESO_INVALIDA' END,
      CASE WHEN nombre_caso = 'anonimo' THEN 'NOMBRE_CASO_NULO' END],
      lambda x: x IS NOT NULL) AS codes FROM cas_all),
  cas AS (SELECT * FROM cas_tag WHERE len(codes) = 0)"""

PRV = """prv AS (SELECT s_suppkey AS id_proveedor, upper(s_name) AS nombre_proveedor,
    CASE s_suppkey % 5 WHEN 0 THEN 'Medico Veterinario' WHEN 1 THEN 'INSUMOS' WHEN 2 THEN
      'transporte urbano' WHEN 3 THEN 'otro' END AS tipo_proveedor,
    CASE s_suppkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'nit-' || s_suppkey END AS nit,
    'p' || s_suppkey || '@mail.org' AS correo, ' Bogota ' AS ciudad FROM supplier),
  dpr AS (SELECT *, lower(trim(ciudad)) AS ciudad_normalizada,
    coalesce(nit <> '', FALSE) AS tiene_id_valido,
    CASE WHEN lower(tipo_proveedor) LIKE '%veterinario%' THEN 'Servicios Veterinarios'
      WHEN lower(tipo_proveedor) LIKE '%insumo%' THEN 'Insumos'
      WHEN lower(tipo_proveedor) LIKE '%transporte%' THEN 'Logística' ELSE 'General' END
      AS categoria_proveedor FROM prv)"""

HOG = """hog_all AS (SELECT CAST(n_nationkey AS BIGINT) AS id_hogar_de_paso,
    CASE WHEN n_nationkey <> 7 THEN upper(n_name) ELSE 'SIN NOMBRE' END AS nombre_hogar,
    CASE WHEN n_nationkey % 2 = 0 THEN 'fijo' ELSE 'temporario' END AS tipo_hogar,
    CAST(CASE n_nationkey WHEN 0 THEN 0 WHEN 24 THEN -1 WHEN 5 THEN 0 ELSE 30 + 2 * n_nationkey
      END AS INTEGER) AS cupo_maximo,
    CASE n_nationkey WHEN 23 THEN -1.0 WHEN 6 THEN 0.0 ELSE n_regionkey * 1000.0 END::DOUBLE
      AS tarifa_diaria,
    CASE n_nationkey WHEN 24 THEN 'CUPO_NEGATIVO' WHEN 23 THEN 'TARIFA_NEGATIVA'
      WHEN 7 THEN 'NOMBRE_HOGAR_NULO' ELSE '' END AS dq_errors FROM nation),
  hog AS (SELECT * FROM hog_all WHERE dq_errors = '')"""

_AGE = """round((2002 - year(created_at)) * 12 + 1 - month(created_at)
  + CASE WHEN day(created_at) = 1 THEN 0 ELSE (1 - day(created_at)) / 31.0 END, 8)"""

DDN = f"""ddn AS (SELECT *, lower(pais) <> 'colombia' AS es_donante_internacional,
    lower(pais) = 'colombia' AS es_donante_local, {_AGE} AS antiguedad,
    contains(correo, '@') AS contacto_valido FROM dnt)"""

_TIER = """CASE WHEN {0} > 2000000 THEN 'oro' WHEN {0} > 700000 THEN 'plata'
  WHEN {0} > 200000 THEN 'bronce' ELSE 'basico' END"""

FDN = """fdn AS (SELECT id_donacion, id_donante, monto, fecha_donacion, medio_pago, estado,
    monto > 400000 AS es_donacion_critica, round(ln(1 + monto), 6) AS monto_log,
    CAST(DATE '2002-01-01' - CAST(fecha_donacion AS DATE) AS INTEGER) AS recencia_donacion_dias,
    CAST(DATE '2002-01-01' - CAST(max(fecha_donacion) OVER (PARTITION BY id_donante) AS DATE)
      AS INTEGER) AS recencia_donaciones_dias,
    strftime(fecha_donacion, '%Y-%m') AS anio_mes_donacion,
    CASE WHEN monto < 50000 THEN 'Bajo' WHEN monto < 200000 THEN 'Medio' ELSE 'Alto' END
      AS categoria_monto,
    CAST(year(fecha_donacion) AS INTEGER) AS y, strftime(fecha_donacion, '%m') AS m
    FROM don WHERE estado = 'completada')"""

FGS = """fgs AS (SELECT id_gasto, id_caso, id_proveedor, monto, fecha_pago, medio_pago, estado,
    nombre_gasto AS descripcion, created_at, round(ln(1 + monto), 6) AS monto_log,
    CAST(DATE '2002-01-01' - CAST(fecha_pago AS DATE) AS INTEGER) AS recencia_dias,
    CAST(year(fecha_pago) AS INTEGER) AS y, strftime(fecha_pago, '%m') AS m
    FROM gas WHERE estado = 'pagado')"""

_TOTAL = "CAST(sum(CAST(monto AS DECIMAL(18,2))) {} AS DOUBLE)"

XGS = f"""xgs AS (SELECT f.*, nombre_proveedor, categoria_proveedor,
    ciudad_normalizada AS proveedor_ciudad, tiene_id_valido, nombre_caso, c.estado AS estado_caso,
    presupuesto_estimado, fecha_salida, fecha_salida IS NULL AS es_caso_activo,
    CAST(year(fecha_pago) AS INTEGER) AS anio, CAST(month(fecha_pago) AS INTEGER) AS mes,
    strftime(fecha_pago, '%Y-%m') AS anio_mes,
    count(*) OVER w AS frecuencia_gastos, {_TOTAL.format('OVER w')} AS monto_total_gastado,
    max(monto) OVER w AS monto_maximo_gasto, min(monto) OVER w AS monto_minimo_gasto,
    CAST(DATE '2002-01-01' - CAST(fecha_pago AS DATE) AS INTEGER) AS recencia_gasto_dias,
    CASE WHEN monto < 25000 THEN 'Pequeño' WHEN monto <= 75000 THEN 'Mediano' ELSE 'Grande' END
      AS categoria_monto,
    CASE WHEN presupuesto_estimado IS NOT NULL THEN monto > presupuesto_estimado END
      AS sobrepresupuesto
    FROM fgs f LEFT JOIN dpr USING (id_proveedor) LEFT JOIN cas c USING (id_caso)
    WINDOW w AS (PARTITION BY f.id_proveedor))"""

FIN = """moves AS (SELECT CAST(date_trunc('month', fecha_donacion) AS DATE) AS anio_mes, id_donante,
      NULL AS id_proveedor, NULL AS id_caso, CAST(monto AS DECIMAL(18,2)) AS ingreso,
      CAST(0 AS DECIMAL(18,2)) AS gasto, CAST(0 AS DECIMAL(18,2)) AS sobre FROM fdn
    UNION ALL SELECT CAST(date_trunc('month', fecha_pago) AS DATE), NULL, id_proveedor, id_caso, 0,
      CAST(monto AS DECIMAL(18,2)), CASE WHEN sobrepresupuesto THEN CAST(monto AS DECIMAL(18,2))
      ELSE 0 END FROM xgs),
  months AS (SELECT anio_mes, sum(ingreso) AS i, sum(gasto) AS g, sum(sobre) AS s,
      count(DISTINCT id_caso) AS casos_activos_mes, count(DISTINCT id_donante) AS
      donantes_activos_mes, count(DISTINCT id_proveedor) AS proveedores_activos_mes
    FROM moves GROUP BY anio_mes),
  rolled AS (SELECT *, sum(i - g) OVER (ORDER BY anio_mes ROWS UNBOUNDED PRECEDING) AS acum,
      sum(i) OVER w3 AS i3, sum(g) OVER w3 AS g3 FROM months
    WINDOW w3 AS (ORDER BY anio_mes ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
  fin AS (SELECT anio_mes, CAST(i AS DOUBLE) AS total_donado, CAST(g AS DOUBLE) AS total_gastado,
      CAST(s AS DOUBLE) AS gastos_sobrepresupuesto, casos_activos_mes, donantes_activos_mes,
      proveedores_activos_mes, CAST(i AS DOUBLE) - CAST(g AS DOUBLE) AS balance_neto,
      CAST(acum AS DOUBLE) AS balance_acumulado, CAST(i3 AS DOUBLE) AS rolling_3m_ingresos,
      CAST(g3 AS DOUBLE) AS rolling_3m_gastos,
      CAST(s AS DOUBLE) / nullif(CAST(g AS DOUBLE), 0) AS porcentaje_sobrepresupuesto,
      CAST(acum AS DOUBLE) / nullif(CAST(g AS DOUBLE), 0) AS runway_financiero,
      CASE WHEN i > g THEN 'Superávit' WHEN i < g THEN 'Déficit' ELSE 'Equilibrado' END
        AS estado_financiero_mes FROM rolled)"""

FINANCE = ", ".join([DON, GAS, CAS, PRV, FDN, FGS, XGS, FIN])


# Cleaned tables --------------------------------------------------------------------------


def _errors(df, *columns):
    return df.select(*columns, F.array_join(dq.ERRORS, ",").alias("dq_errors"))


@query(
    "slv_donaciones",
    f"""WITH {DON} SELECT id_donacion, id_donante, id_caso, fecha_donacion, monto, medio_pago,
        estado, comprobante, created_at, last_modified_at, array_to_string(codes, ',') AS dq_errors
        FROM don_all""",
)
def _(spark, sf):
    df = S.donations(B.donations(spark, sf), B.AS_OF, first_day=B.FIRST_DAY)
    return _errors(
        df, "id_donacion", "id_donante", "id_caso", "fecha_donacion", "monto", "medio_pago",
        "estado", "comprobante", "created_at", "last_modified_at",
    )


@query(
    "slv_gastos",
    f"""WITH {GAS} SELECT id_gasto, nombre_gasto, fecha_pago, id_caso, medio_pago, monto, estado,
        comprobante, id_proveedor, created_at, 'raw_gastos' AS fuente FROM gas""",
)
def _(spark, sf):
    return S.expenses(B.expenses(spark, sf), B.AS_OF).select(
        "id_gasto", "nombre_gasto", "fecha_pago", "id_caso", "medio_pago", "monto", "estado",
        "comprobante", "id_proveedor", "created_at", "fuente",
    )


@query(
    "slv_donantes",
    f"""WITH {DNT} SELECT id_donante, donante, correo, telefono, ciudad, pais, canal_origen,
        created_at, CASE WHEN correo = 'sin correo' THEN 'EMAIL_INVALIDO' ELSE '' END AS dq_errors
        FROM dnt_all""",
)
def _(spark, sf):
    return _errors(
        S.donors(B.donors(spark, sf), B.AS_OF), "id_donante", "donante", "correo", "telefono",
        "ciudad", "pais", "canal_origen", "created_at",
    )


_CASE = ["id_caso", "nombre_caso", "estado", "fecha_ingreso", "fecha_salida", "veterinaria",
         "diagnostico", "ciudad", "id_hogar_de_paso", "presupuesto_estimado"]


@query(
    "slv_casos",
    f"WITH {CAS} SELECT {', '.join(_CASE)}, array_to_string(codes, ',') AS dq_errors FROM cas_tag",
)
def _(spark, sf):
    return _errors(S.cases(B.cases(spark, sf), B.AS_OF, B.FIRST_DAY), *_CASE)


@query(
    "slv_proveedores",
    f"WITH {PRV} SELECT id_proveedor, nombre_proveedor, tipo_proveedor, nit, correo, ciudad FROM prv",
)
def _(spark, sf):
    return S.suppliers(B.suppliers(spark, sf)).select(
        "id_proveedor", "nombre_proveedor", "tipo_proveedor", "nit", "correo", "ciudad"
    )


@query("slv_hogar_de_paso", f"WITH {HOG} SELECT * FROM hog_all")
def _(spark, sf):
    return _errors(
        S.homes(B.homes(spark, sf), B.AS_OF), "id_hogar_de_paso", "nombre_hogar", "tipo_hogar",
        "cupo_maximo", "tarifa_diaria",
    )


# Dimensions ------------------------------------------------------------------------------


@query(
    "gld_calendar",
    """SELECT CAST(d AS DATE) AS fecha, CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER)
         AS m, CAST(day(d) AS INTEGER) AS d, CAST(quarter(d) AS INTEGER) AS trimestre,
         CAST(CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS INTEGER) AS semestre,
         dayname(d) AS nombre_dia, monthname(d) AS nombre_mes, strftime(d, '%Y-%m') AS anio_mes,
         year(d) || '-T' || quarter(d) AS anio_trimestre,
         year(d) || '-S' || CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS anio_semestre,
         CAST(week(d) AS INTEGER) AS semana_iso, dayofweek(d) IN (0, 6) AS es_fin_de_semana
       FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders),
         (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS d)""",
)
def _(spark, sf):
    return with_calendar(calendar_span(B.table(spark, sf, "orders"), "o_orderdate"))


@query(
    "gld_dim_donor",
    f"""WITH {DNT}, {DDN} SELECT id_donante, donante, correo, ciudad, pais,
        es_donante_internacional, es_donante_local, round(antiguedad, 6) AS
        antiguedad_donante_meses, contacto_valido,
        CASE WHEN k THEN CAST(year(created_at) AS INTEGER) END AS anio_creacion,
        CASE WHEN k THEN CAST(month(created_at) AS INTEGER) END AS mes_creacion,
        CASE WHEN k THEN strftime(created_at, '%Y-%m') END AS anio_mes_creacion,
        CASE WHEN k THEN CAST(quarter(created_at) AS INTEGER) END AS trimestre_creacion,
        CASE WHEN k THEN year(created_at) || '-T' || quarter(created_at) END AS
          anio_trimestre_creacion,
        CASE WHEN k THEN CAST(CASE WHEN month(created_at) <= 6 THEN 1 ELSE 2 END AS INTEGER) END
          AS semestre_creacion,
        CASE WHEN k THEN year(created_at) || '-S' || CASE WHEN month(created_at) <= 6 THEN 1 ELSE 2
          END END AS anio_semestre_creacion,
        CASE WHEN k THEN CAST(week(created_at) AS INTEGER) END AS semana_creacion,
        CAST(year(created_at) AS INTEGER) AS y, strftime(created_at, '%m') AS m
        FROM (SELECT *, created_at >= TIMESTAMP '1994-07-01' AS k FROM ddn)""",
)
def _(spark, sf):
    df = build(spark, sf, "gold.dim_donantes")
    return df.select(
        "id_donante", "donante", "correo", "ciudad", "pais", "es_donante_internacional",
        "es_donante_local",
        F.round("antiguedad_donante_meses", 6).alias("antiguedad_donante_meses"),
        "contacto_valido", *[c for c in df.columns if c.endswith("_creacion")], "y", "m",
    )


@query(
    "gld_dim_supplier",
    f"""WITH {PRV} SELECT id_proveedor, nombre_proveedor, ciudad_normalizada, tiene_id_valido,
        categoria_proveedor FROM dpr""",
)
def _(spark, sf):
    return build(spark, sf, "gold.dim_proveedores").select(
        "id_proveedor", "nombre_proveedor", "ciudad_normalizada", "tiene_id_valido",
        "categoria_proveedor",
    )


_DIM_CASE = """es_caso_urgente, CAST(DATE '2002-01-01' - CAST(fecha_ingreso AS DATE) AS INTEGER) AS
  dias_en_sistema, CAST(year(fecha_ingreso) AS INTEGER) AS y, strftime(fecha_ingreso, '%m') AS m"""


@query(
    "gld_dim_case",
    f"""WITH {CAS} SELECT {', '.join(_CASE)}, {_DIM_CASE}
        FROM (SELECT *, estado = 'urgente' AS es_caso_urgente FROM cas)""",
)
def _(spark, sf):
    return build(spark, sf, "gold.dim_casos").select(
        *_CASE, "es_caso_urgente", "dias_en_sistema", "y", "m"
    )


@query(
    "gld_dim_home",
    f"""WITH {CAS}, {HOG}, k AS (SELECT id_hogar_de_paso, count(*) AS n, count(*) FILTER (WHERE
          fecha_salida IS NULL) AS a, count(fecha_salida) AS f FROM cas GROUP BY 1),
        j AS (SELECT hog.*, coalesce(n, 0) AS numero_casos_total, coalesce(a, 0) AS
          numero_casos_activos, coalesce(f, 0) AS numero_casos_finalizado
          FROM hog LEFT JOIN k USING (id_hogar_de_paso)),
        r AS (SELECT *, CASE WHEN cupo_maximo > 0 THEN numero_casos_activos::DOUBLE / cupo_maximo
          ELSE 0.0 END AS tasa_ocupacion, CASE WHEN numero_casos_total > 0 THEN
          numero_casos_finalizado::DOUBLE / numero_casos_total ELSE 0.0 END AS rotacion_casos FROM j)
        SELECT id_hogar_de_paso, nombre_hogar, cupo_maximo, numero_casos_total,
          numero_casos_activos, numero_casos_finalizado, tasa_ocupacion, rotacion_casos,
          CASE WHEN tasa_ocupacion > 0.85 THEN 'Alta' WHEN tasa_ocupacion BETWEEN 0.40 AND 0.85
            THEN 'Media' ELSE 'Baja' END AS clasificacion_ocupacion,
          CASE WHEN rotacion_casos > 0.7 THEN 'Alta rotación' WHEN rotacion_casos BETWEEN 0.3 AND
            0.7 THEN 'Media' ELSE 'Baja rotación' END AS clasificacion_rotacion FROM r""",
)
def _(spark, sf):
    return build(spark, sf, "gold.dim_hogar_de_paso").select(
        "id_hogar_de_paso", "nombre_hogar", "cupo_maximo", "numero_casos_total",
        "numero_casos_activos", "numero_casos_finalizado", "tasa_ocupacion", "rotacion_casos",
        "clasificacion_ocupacion", "clasificacion_rotacion",
    )


# Facts -----------------------------------------------------------------------------------


def _rounded(df, **digits):
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("gld_fact_donation", f"WITH {DON}, {FDN} SELECT * FROM fdn")
def _(spark, sf):
    return _rounded(build(spark, sf, "gold.fact_donaciones"), monto_log=6)


@query("gld_fact_expense", f"WITH {GAS}, {FGS} SELECT * FROM fgs")
def _(spark, sf):
    return _rounded(build(spark, sf, "gold.fact_gastos"), monto_log=6)


# Features --------------------------------------------------------------------------------


@query(
    "gld_feat_donor",
    f"""WITH {DON}, {DNT}, {DDN}, {FDN}, a AS (SELECT id_donante, {_TOTAL.format('')} AS t,
          count(*) AS n, min(fecha_donacion) AS d0, max(fecha_donacion) AS d1, max(monto) AS hi,
          min(monto) AS lo FROM fdn GROUP BY 1)
        SELECT id_donante, pais, t AS total_donado, n AS num_donaciones, t / n AS promedio_donacion,
          d0 AS primera_donacion, d1 AS ultima_donacion, hi AS monto_maximo, lo AS monto_minimo,
          CAST(DATE '2002-01-01' - CAST(d1 AS DATE) AS INTEGER) AS recencia_dias,
          {_TIER.format('t')} AS categoria_financiera,
          coalesce(n >= 3, FALSE) AS donante_recurrente_ml, t AS ltv,
          round(t / nullif(antiguedad, 0), 4) AS velocidad_crecimiento
        FROM ddn LEFT JOIN a USING (id_donante)""",
)
def _(spark, sf):
    df = build(spark, sf, "gold.feat_donantes").select(
        "id_donante", "pais", "total_donado", "num_donaciones", "promedio_donacion",
        "primera_donacion", "ultima_donacion", "monto_maximo", "monto_minimo", "recencia_dias",
        "categoria_financiera", "donante_recurrente_ml", "ltv", "velocidad_crecimiento",
    )
    return _rounded(df, velocidad_crecimiento=4)


@query(
    "gld_feat_case",
    f"""WITH {GAS}, {CAS}, {FGS}, a AS (SELECT id_caso, {_TOTAL.format('')} AS t, count(*) AS n,
          max(monto) AS hi FROM fgs GROUP BY 1)
        SELECT id_caso, nombre_caso, t AS costo_total_caso, n AS num_gastos_caso,
          t / n AS promedio_gasto_caso, hi AS gasto_maximo_caso,
          CAST(CAST(fecha_salida AS DATE) - CAST(fecha_ingreso AS DATE) AS INTEGER) AS
            tiempo_resolucion_dias, coalesce(t > 1000000, FALSE) AS es_caso_alto_costo,
          CASE WHEN t > 1000000 THEN 'Critico' WHEN t > 500000 THEN 'Alto' WHEN t > 100000 THEN
            'Medio' ELSE 'Bajo' END AS categoria_costo
        FROM cas LEFT JOIN a USING (id_caso)""",
)
def _(spark, sf):
    return build(spark, sf, "gold.feat_casos").select(
        "id_caso", "nombre_caso", "costo_total_caso", "num_gastos_caso", "promedio_gasto_caso",
        "gasto_maximo_caso", "tiempo_resolucion_dias", "es_caso_alto_costo", "categoria_costo",
    )


@query(
    "gld_feat_supplier",
    f"""WITH {GAS}, {PRV}, {FGS}, a AS (SELECT id_proveedor, {_TOTAL.format('')} AS t, count(*) AS n,
          max(fecha_pago) AS d FROM fgs GROUP BY 1)
        SELECT id_proveedor, nombre_proveedor, t AS total_gastado_proveedor, n AS num_transacciones,
          t / n AS promedio_transaccion, d AS ultimo_pago_proveedor,
          CASE WHEN t > 5000000 THEN 'Socio Estratégico' WHEN t > 1000000 THEN
            'Proveedor Frecuente' ELSE 'Transaccional' END AS importancia_proveedor
        FROM prv LEFT JOIN a USING (id_proveedor)""",
)
def _(spark, sf):
    return build(spark, sf, "gold.feat_proveedores").select(
        "id_proveedor", "nombre_proveedor", "total_gastado_proveedor", "num_transacciones",
        "promedio_transaccion", "ultimo_pago_proveedor", "importancia_proveedor",
    )


# Dashboards ------------------------------------------------------------------------------


@query(
    "gld_dash_donations",
    f"""WITH {DON}, {DNT}, {FDN} SELECT f.*, donante, correo, ciudad, pais, canal_origen,
        CAST(year(fecha_donacion) AS INTEGER) AS anio, CAST(month(fecha_donacion) AS INTEGER) AS mes,
        strftime(fecha_donacion, '%Y-%m') AS anio_mes, count(*) OVER w AS frecuencia_donaciones,
        {_TOTAL.format('OVER w')} AS monto_total_donado,
        {_TOTAL.format('OVER w')} / count(*) OVER w AS promedio_donacion_donante,
        max(monto) OVER w AS monto_maximo_donante, min(monto) OVER w AS monto_minimo_donante,
        recencia_donaciones_dias AS recencia_dias,
        {_TIER.format(_TOTAL.format('OVER w'))} AS segmento_rfm,
        CASE WHEN monto >= 400000 THEN 'critica' WHEN monto >= 200000 THEN 'media' ELSE 'pequena'
          END AS tamano_donacion
        FROM fdn f LEFT JOIN dnt USING (id_donante) WINDOW w AS (PARTITION BY f.id_donante)""",
)
def _(spark, sf):
    return _rounded(build(spark, sf, "gold.dashboard_donaciones"), monto_log=6)


@query("gld_dash_expenses", f"WITH {', '.join([GAS, CAS, PRV, FGS, XGS])} SELECT * FROM xgs")
def _(spark, sf):
    return _rounded(build(spark, sf, "gold.dashboard_gastos"), monto_log=6)


@query("gld_finance_monthly", f"WITH {FINANCE} SELECT * FROM fin")
def finance_monthly(spark, sf):
    return build(spark, sf, "gold.dashboard_financiero")


@query(
    "gld_balance_report",
    f"""WITH {FINANCE} SELECT anio_mes, CAST(trunc(total_donado) AS BIGINT) AS total_donado,
        CAST(trunc(total_gastado) AS BIGINT) AS total_gastado,
        CAST(trunc(balance_neto) AS BIGINT) AS balance_neto, estado_financiero_mes,
        round(runway_financiero, 2) AS runway FROM fin ORDER BY anio_mes DESC LIMIT 6""",
)
def _(spark, sf):
    return G.balance_report(finance_monthly(spark, sf))


@query(
    "gld_monthly_donations",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(month(o_orderdate) AS INTEGER) AS mes,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_donaciones,
         count(*) AS cantidad_donaciones,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS promedio_donacion
       FROM orders WHERE o_orderkey % 101 <> 0 GROUP BY 1, 2""",
)
def _(spark, sf):
    return G.monthly_donations(
        B.donations(spark, sf), min_year=1995, max_year=2001, scale=B.CENTS
    )


@query(
    "dq_null_balance",
    f"""WITH {FINANCE} SELECT 'balance_neto' AS column_name, count(*) FILTER (WHERE balance_neto IS
        NULL) AS null_count FROM fin UNION ALL SELECT 'balance_acumulado', count(*) FILTER (WHERE
        balance_acumulado IS NULL) FROM fin UNION ALL SELECT 'runway_financiero', count(*) FILTER
        (WHERE runway_financiero IS NULL) FROM fin""",
)
def _(spark, sf):
    columns = ["balance_neto", "balance_acumulado", "runway_financiero"]
    return dq.null_profile(finance_monthly(spark, sf), columns)


# All tables ------------------------------------------------------------------------------

_ROWS_OF = {
    "silver.donaciones": "don",
    "silver.gastos": "gas",
    "silver.donantes": "dnt",
    "silver.casos": "cas",
    "silver.proveedores": "prv",
    "silver.hogar_de_paso": "hog",
    "gold.dim_calendario": "(SELECT unnest(generate_series(DATE '1994-07-01', DATE '2002-12-31', "
    "INTERVAL 1 DAY)))",
    "gold.dim_donantes": "dnt",
    "gold.dim_proveedores": "prv",
    "gold.dim_casos": "cas",
    "gold.dim_hogar_de_paso": "hog",
    "gold.fact_donaciones": "fdn",
    "gold.fact_gastos": "fgs",
    "gold.feat_donantes": "dnt",
    "gold.feat_casos": "cas",
    "gold.feat_proveedores": "prv",
    "gold.dashboard_donaciones": "fdn",
    "gold.dashboard_gastos": "fgs",
    "gold.dashboard_financiero": "fin",
}


# Amount of each table that has one, for comparing values and not only row counts.
_AMOUNT_OF = {
    "silver.donaciones": "monto",
    "silver.gastos": "monto",
    "gold.fact_donaciones": "monto",
    "gold.fact_gastos": "monto",
    "gold.dashboard_donaciones": "monto",
    "gold.dashboard_gastos": "monto",
    "gold.dashboard_financiero": "balance_neto",
}


def _facts_sql(names, label):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, "
        + (
            f"CAST(sum(CAST({_AMOUNT_OF[name]} AS DECIMAL(18,2))) AS DOUBLE)"
            if name in _AMOUNT_OF
            else "CAST(NULL AS DOUBLE)"
        )
        + f" AS {label} FROM {_ROWS_OF[name]}"
        for name in names
    )


def _facts(tables, label):
    return stack(
        [
            df.agg(
                F.count(F.lit(1)).alias("row_count"),
                (
                    total(F.col(_AMOUNT_OF[name]), B.CENTS)
                    if name in _AMOUNT_OF
                    else F.lit(None).cast("double")
                ).alias(label),
            ).select(F.lit(name).alias("table_name"), "row_count", label)
            for name, df in tables.items()
        ]
    )


@query("pip_all_tables", f"WITH {FINANCE}, {DNT}, {HOG} " + _facts_sql(_ROWS_OF, "amount"))
def _(spark, sf):
    """The whole run: six cleaned and thirteen curated tables, month layout, quarantine."""
    tables = registry.run(
        spark, B.raw_tables(spark, sf), scratch_path(spark, "all"), list(_ROWS_OF), SETTINGS
    )
    return _facts(tables, "amount")


@query(
    "mrt_export_catalogue",
    f"WITH {FINANCE}, {DNT}, {HOG} " + _facts_sql([n for n in _ROWS_OF if n.startswith("gold.")], "amount"),
)
def _(spark, sf):
    """All thirteen curated tables as folders with external tables on top, read by name."""
    root = scratch_path(spark, "mart")
    gold = registry.run(
        spark, B.raw_tables(spark, sf), f"{root}/lake", registry.layer_targets("gold"), SETTINGS
    )
    database = f"export_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    names = export_gold(spark, {n.split(".")[1]: df for n, df in gold.items()}, root, database, stored=True)
    return _facts({f"gold.{n.split('.')[1]}": spark.table(n) for n in names}, "amount")


@query(
    "pip_month_rerun",
    f"""WITH {DON} SELECT id_donacion, estado, CASE WHEN strftime(fecha_donacion, '%Y-%m') =
        '1998-06' THEN monto + 1 ELSE monto END AS monto FROM don""",
)
def _(spark, sf):
    """A full run, then one month again after all amounts changed: only that month follows."""
    root, name = scratch_path(spark, "month"), "silver.donaciones"
    raw = B.donations(spark, sf)
    registry.run(spark, {"donaciones": raw}, root, [name], SETTINGS)
    changed = raw.withColumn("monto", F.col("monto") + 1)
    month = replace(SETTINGS, month="1998-06")
    out = registry.run(spark, {"donaciones": changed}, root, [name], month)
    return out[name].select("id_donacion", "estado", "monto")


@query(
    "pip_run_counts",
    f"""WITH {DON}, {GAS}, {DNT}, {CAS}, {PRV}, {HOG}, c AS (
          SELECT 'silver.donaciones' AS table_name, (SELECT count(*) FROM orders) AS raw,
                 (SELECT count(*) FROM don_all) AS deduplicated, (SELECT count(*) FROM don) AS valid
          UNION ALL SELECT 'silver.gastos', (SELECT count(*) FROM lineitem),
                 (SELECT count(*) FROM gas), (SELECT count(*) FROM gas)
          UNION ALL SELECT 'silver.donantes', (SELECT count(*) FROM customer),
                 (SELECT count(*) FROM dnt_all), (SELECT count(*) FROM dnt)
          UNION ALL SELECT 'silver.casos', (SELECT count(*) FROM part),
                 (SELECT count(*) FROM cas_all), (SELECT count(*) FROM cas)
          UNION ALL SELECT 'silver.proveedores', (SELECT count(*) FROM supplier),
                 (SELECT count(*) FROM prv), (SELECT count(*) FROM prv)
          UNION ALL SELECT 'silver.hogar_de_paso', (SELECT count(*) FROM nation),
                 (SELECT count(*) FROM hog_all), (SELECT count(*) FROM hog))
        SELECT *, deduplicated - valid AS rejected FROM c""",
)
def _(spark, sf):
    root, raw = scratch_path(spark, "counts"), B.raw_tables(spark, sf)
    registry.run(spark, raw, root, registry.layer_targets("silver"), SETTINGS)
    return registry.run_counts(spark, root)

"""Equivalent DuckDB SQL per registered query (the correctness oracle).

The domain views are re-expressed as CTEs over the driver tables; each key
adds its own SELECT.  Dates are rendered as ``yyyy-MM-dd`` text on both
sides; money is summed as DECIMAL so totals are exact on both engines.
"""

from __future__ import annotations

import re

_USERS = ["torres ana", "Luis Rojaz", "DIAZ MARTA", "Jorje Pineda", "Carla Mejía",
          "Silva Pedro", "Sofia Luna", "Diego Cano", "Ruth Vga"]
_AGENTS = ["Ana Torres", "Luis Rojas", "Marta Diaz", "Jorge Pineda", "Carla Mejia",
           "Pedro Silva", "Sofia Luna", "Diego Cano", "Ruth Vega"]


def _case(expr: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {expr} {whens} END"


def _bucket(d: str) -> str:
    return (f"CASE WHEN {d} <= 0 THEN 'AL DIA' WHEN {d} <= 30 THEN '1 A 30' WHEN {d} <= 90 THEN '31 A 90' "
            f"WHEN {d} <= 180 THEN '91 A 180' WHEN {d} <= 360 THEN '181 A 360' ELSE 'MAS DE 360' END")


M = "DECIMAL(24,3)"


def msum(c: str) -> str:
    return f"CAST(coalesce(sum(CAST({c} AS {M})), 0) AS DOUBLE)"


_DAYS = "CAST(CASE WHEN o.o_orderkey % 4 = 0 THEN 0 ELSE o.o_orderkey % 401 END AS DOUBLE)"
_PRICE2 = "CAST(o.o_totalprice AS DECIMAL(18,2))"


def _goal(f: str) -> str:
    return f"CASE WHEN o.o_orderkey % 13 = 0 THEN 0.0 ELSE CAST({_PRICE2} * {f} AS DOUBLE) END"


BASE = f"""
li AS (SELECT l_orderkey, count(*) FILTER (WHERE l_linestatus = 'F') AS nf,
              sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS paid,
              max(l_shipdate) AS ship
       FROM lineitem GROUP BY l_orderkey),
ev AS (SELECT user_id, count(*) AS nov FROM events GROUP BY user_id),
portfolio_raw AS (
  SELECT c.c_mktsegment AS "Empresa", CAST(o.o_orderkey AS VARCHAR) AS "Credito",
    CAST(o.o_custkey AS VARCHAR) AS "Cedula_Cliente", c.c_name AS "Nombre_Cliente",
    r.r_name AS "Regional_Cobro", r.r_name AS "Regional_Venta",
    CASE WHEN n.n_nationkey < 9 THEN 'CL' || CAST(n.n_nationkey + 1 AS VARCHAR) ELSE n.n_name END AS "Zona",
    CASE WHEN o.o_custkey % 2 = 0 THEN 'CL' || CAST(o.o_custkey % 9 + 1 AS VARCHAR) ELSE 'SIN APOYO' END AS "Call_Center_Apoyo",
    'Cobrador ' || CAST(o.o_custkey % 20 AS VARCHAR) AS "Cobrador",
    'Agente ' || CAST(o.o_custkey % 9 AS VARCHAR) AS "Nombre_Call_Center",
    'Vendedor ' || CAST(o.o_custkey % 15 AS VARCHAR) AS "Nombre_Vendedor",
    {_case('o.o_orderkey % 7', ['ZCN', '1AB', 'CC01', '1CE', 'CEC', 'X99'])} AS "Zona_Cobro",
    {_DAYS} AS "Dias_Atraso_Final",
    {_bucket(_DAYS)} AS "Franja_Meta",
    {_bucket(_DAYS)} AS "Franja_Cartera",
    CAST(o.o_orderkey % 12 + 1 AS DOUBLE) AS "Total_Cuotas",
    CAST(least(o.o_orderkey % 12 + 1, coalesce(li.nf, 0) + o.o_orderkey % 2) AS DOUBLE) AS "Cuotas_Pagadas",
    o.o_totalprice AS "Valor_Desembolso", CAST(o.o_orderdate AS DATE) AS "Fecha_Desembolso",
    CASE WHEN o.o_orderkey % 10 = 0 THEN 'ANTICIPADO' WHEN o.o_orderkey % 7 = 3 THEN format('{{:,.2f}}', CAST({_PRICE2} AS DOUBLE))
      WHEN o.o_orderkey % 7 = 5 THEN format('{{:,.2f}}', CAST({_PRICE2} * 100 AS DOUBLE)) ELSE CAST({_PRICE2} AS VARCHAR) END AS "Valor_Cuota_Vigente",
    CASE WHEN o.o_orderstatus <> 'F' THEN CAST(li.ship AS DATE) END AS "Fecha_Cuota_Vigente",
    CASE WHEN o.o_custkey % 7 = 3 THEN 0.0 ELSE CAST(coalesce(li.paid, 0) AS DOUBLE) END AS "Total_Recaudo",
    CASE WHEN o.o_orderkey % 10 = 0 THEN 0.0 ELSE CASE WHEN o.o_custkey % 7 = 3 THEN 0.0 ELSE CAST(coalesce(li.paid, 0) AS DOUBLE) END END AS "Total_Recaudo_Sin_Anti",
    {_goal('0.5')} AS "Meta_$", {_goal('0.4')} AS "Meta_General", {_goal('0.6')} AS "Meta_T.R_$",
    least(CASE WHEN o.o_custkey % 7 = 3 THEN 0.0 ELSE CAST(coalesce(li.paid, 0) AS DOUBLE) END, {_goal('0.5')}) AS "Recaudo_Meta",
    CASE o.o_orderstatus WHEN 'P' THEN 'MEJORA' WHEN 'F' THEN 'EMPEORA' WHEN 'O' THEN 'NORMALIZO' END AS "Rodamiento",
    CAST(ev.nov AS DOUBLE) AS "Cantidad_Novedades"
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey LEFT JOIN ev ON ev.user_id = o.o_custkey),
p1 AS (
  SELECT * REPLACE (
      coalesce(TRY_CAST(replace(regexp_replace("Valor_Cuota_Vigente", 'ANTICIPADO', '0', 'gi'), ',', '') AS DOUBLE), 0.0) AS "Valor_Cuota_Vigente",
      upper(trim(replace("Zona", ' ', ''))) AS "Zona",
      upper(trim(replace("Call_Center_Apoyo", ' ', ''))) AS "Call_Center_Apoyo",
      coalesce("Regional_Cobro", 'OTRAS ZONAS') AS "Regional_Cobro",
      coalesce("Cantidad_Novedades", 0.0) AS "Cantidad_Novedades"),
    CASE WHEN upper("Valor_Cuota_Vigente") LIKE '%ANTICIPADO%' THEN 'ANTICIPADO' ELSE 'NORMAL' END AS "Tipo_Vigencia_Temp"
  FROM portfolio_raw),
portfolio AS (
  SELECT *,
    CASE WHEN "Zona" IN ('CL1','CL2','CL3','CL4') THEN "Zona"
         WHEN "Call_Center_Apoyo" IN ('CL5','CL6','CL7','CL8','CL9') THEN "Call_Center_Apoyo"
         ELSE 'SIN CALL CENTER' END AS "CALL_CENTER_FILTRO",
    CASE WHEN "Tipo_Vigencia_Temp" = 'ANTICIPADO' THEN 'anticipado'
         WHEN "Fecha_Cuota_Vigente" IS NOT NULL THEN 'vigente' ELSE 'vencido' END AS "Estado_Vigencia",
    CASE WHEN "Tipo_Vigencia_Temp" = 'ANTICIPADO' THEN 'ANTICIPADO'
         WHEN "Total_Recaudo" > 50000 THEN 'PAGO' ELSE 'SIN PAGO' END AS "Estado_Pago"
  FROM p1),
fbase AS (
  SELECT * REPLACE (CASE WHEN "Tipo_Vigencia_Temp" = 'ANTICIPADO' THEN 'ANTICIPADO'
                         WHEN "Total_Recaudo" > 50000 THEN 'PAGO' ELSE 'SIN PAGO' END AS "Estado_Pago"),
    CASE WHEN "Cantidad_Novedades" > 0 THEN 'CON GESTIÓN' ELSE 'SIN GESTIÓN' END AS "Estado_Gestion"
  FROM portfolio),
ccp AS (
  SELECT * REPLACE (CASE WHEN "Total_Recaudo" > 50000 THEN 'PAGO' ELSE 'SIN PAGO' END AS "Estado_Pago"),
    CASE WHEN "Cantidad_Novedades" > 0 THEN 'CON GESTIÓN' ELSE 'SIN GESTIÓN' END AS "Estado_Gestion"
  FROM portfolio),
contacts AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS "Cedula_Cliente", CAST(ts AS DATE) AS "Fecha_Novedad",
    CASE WHEN user_id % 10 = 9 THEN 'Xavier Quintero' WHEN user_id % 11 = 7 THEN 'Luis Paz' ELSE {_case('user_id % 9', _USERS)} END AS "Nombre_Usuario",
    {_case('event_id % 4', ['GESTOR', 'CALL CENTER', 'ABOGADO'])} AS "Cargo_Usuario",
    CASE event_type WHEN 'purchase' THEN 'COMPROMISO DE PAGO' WHEN 'error' THEN 'AUSENCIA'
                    WHEN 'view' THEN 'NOVEDAD' ELSE 'PAGO' END AS "Tipo_Novedad",
    props AS "Novedad",
    CASE WHEN event_type = 'purchase' AND event_id % 5 <> 0 THEN CAST(ts AS DATE) END AS "Fecha_Compromiso",
    CASE WHEN user_id % 4 = 1 THEN '300' || CAST(user_id AS VARCHAR) || '.0' WHEN user_id % 4 > 1 THEN '300' || CAST(user_id AS VARCHAR) END AS "Telefono_Cliente",
    CASE WHEN user_id % 8 = 0 THEN '300' || CAST(user_id AS VARCHAR) WHEN user_id % 6 = 1 THEN '3110' || CAST(user_id % 3 AS VARCHAR) END AS "Celular_Cliente",
    value AS "Valor"
  FROM events),
calls AS (
  SELECT event_id AS seq, CAST(ts AS DATE) AS "Fecha_Llamada",
    CASE event_type WHEN 'click' THEN ' answered ' WHEN 'error' THEN NULL ELSE 'NO ANSWER' END AS "Estado_Llamada",
    CASE WHEN user_id % 11 = 10 THEN NULL ELSE ' cl' || CAST(user_id % 9 + 1 AS VARCHAR) || ' ' END AS "Call_Center",
    {_case('user_id % 9', _AGENTS)} AS "Nombre_Call",
    CASE WHEN user_id % 11 = 10 THEN 'SIN DATO' ELSE 'CL' || CAST(user_id % 9 + 1 AS VARCHAR) END AS "Call_Center_Limpio",
    user_id
  FROM events),
scalls AS (
  SELECT * REPLACE (upper(trim("Estado_Llamada")) AS "Estado_Llamada") FROM calls WHERE "Call_Center_Limpio" <> 'SIN DATO'),
messages AS (
  SELECT event_id AS seq, CAST(ts AS DATE) AS "Fecha_Mensaje", '300' || CAST(user_id AS VARCHAR) || '.0' AS "Numero_Telefono",
    CASE event_type WHEN 'view' THEN ' Text' WHEN 'click' THEN 'audio' WHEN 'error' THEN NULL ELSE 'template' END AS "Tipo_Respuesta_Agente",
    CASE WHEN user_id % 11 = 10 THEN 'SIN DATO' ELSE 'CL' || CAST(user_id % 9 + 1 AS VARCHAR) END AS "Call_Center"
  FROM events),
vmsg AS (
  SELECT *, coalesce(lower(trim("Tipo_Respuesta_Agente")) IN ('text', 'audio'), false) AS "Es_Conversacion"
  FROM messages WHERE "Call_Center" IS NOT NULL AND upper("Call_Center") <> 'SIN DATO' AND "Call_Center" <> ''),
conv AS (SELECT *, trim(regexp_replace("Numero_Telefono", '\\.0$', '')) AS "Tel_Norm" FROM vmsg WHERE "Es_Conversacion"),
phone_rows AS (SELECT trim(regexp_replace("Tel", '\\.0$', '')) AS "Tel", "Cedula_Cliente" FROM (
    SELECT "Telefono_Cliente" AS "Tel", "Cedula_Cliente" FROM contacts UNION ALL SELECT "Celular_Cliente", "Cedula_Cliente" FROM contacts)),
phones AS (SELECT DISTINCT "Tel" FROM phone_rows WHERE "Tel" IS NOT NULL AND "Tel" <> ''),
phone_clients AS (SELECT DISTINCT "Tel", "Cedula_Cliente" FROM phone_rows
                  WHERE "Cedula_Cliente" IS NOT NULL AND "Tel" IS NOT NULL AND "Tel" <> ''),
payers AS (SELECT DISTINCT "Cedula_Cliente" FROM ccp WHERE "Estado_Pago" = 'PAGO'),
applications AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS "Pagare", o.o_orderstatus AS "Estado",
    'Analista ' || CAST(o.o_custkey % 6 AS VARCHAR) AS "Analista_Asociado", r.r_name AS "Regional_Venta",
    'Vendedor ' || CAST(o.o_custkey % 15 AS VARCHAR) AS "Nombre_Vendedor", CAST(o.o_custkey AS VARCHAR) AS "Cedula_Cliente",
    o.o_totalprice AS "Valor_Total", CAST(o.o_orderdate AS DATE) AS "Fecha_Nacimiento"
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
merged AS (
  SELECT f.*, coalesce(cr."Cargo_Usuario", 'SIN ASIGNAR') AS "Cargo_Usuario_x"
  FROM fbase f LEFT JOIN (SELECT DISTINCT "Cedula_Cliente", "Cargo_Usuario" FROM contacts) cr
  ON f."Cedula_Cliente" = cr."Cedula_Cliente"),
merged2 AS (SELECT * EXCLUDE ("Cargo_Usuario_x"), "Cargo_Usuario_x" AS "Cargo_Usuario" FROM merged),
per_role AS (SELECT "Cedula_Cliente", "Cargo_Usuario", count(*) AS "Novedades_Por_Cargo" FROM contacts GROUP BY ALL),
merged3 AS (
  SELECT m.*, coalesce(pr."Novedades_Por_Cargo", 0) AS "Novedades_Por_Cargo" FROM merged2 m
  LEFT JOIN per_role pr ON m."Cedula_Cliente" = pr."Cedula_Cliente" AND m."Cargo_Usuario" = pr."Cargo_Usuario"),
detail AS (
  SELECT m.*, k.seq, k."Fecha_Novedad", coalesce(k."Nombre_Usuario", '') AS "Nombre_Usuario",
    coalesce(k."Tipo_Novedad", '') AS "Tipo_Novedad", coalesce(k."Novedad", '') AS "Novedad",
    k."Fecha_Compromiso", k."Telefono_Cliente", k."Celular_Cliente", k."Valor"
  FROM merged3 m LEFT JOIN contacts k
  ON m."Cedula_Cliente" = k."Cedula_Cliente" AND m."Cargo_Usuario" = k."Cargo_Usuario"),
attributed AS (
  SELECT seq, "Cedula_Cliente", "Nombre_Usuario", "Tipo_Novedad", "Fecha_Compromiso",
    CASE "Nombre_Usuario" WHEN 'Xavier Quintero' THEN 'SIN ASIGNAR' WHEN 'Luis Paz' THEN 'CL2'
      ELSE 'CL' || CAST(CAST("Cedula_Cliente" AS BIGINT) % 9 + 1 AS VARCHAR) END AS "Call_Center" FROM contacts),
att_c AS (
  SELECT *, "Zona" IN ('CL1','CL2','CL3','CL4','CL5','CL6','CL7','CL8','CL9') AND "Franja_Meta" = 'AL DIA' AS zp,
    "Call_Center_Apoyo" IN ('CL1','CL2','CL3','CL4','CL5','CL6','CL7','CL8','CL9') AS sp
  FROM ccp),
att AS (
  SELECT * EXCLUDE (zp, sp) REPLACE (CASE WHEN zp THEN "Zona" ELSE "Call_Center_Apoyo" END AS "CALL_CENTER_FILTRO"),
    CASE WHEN zp THEN "Cobrador" ELSE "Nombre_Call_Center" END AS "NOMBRE_AGENTE",
    CASE WHEN zp THEN "Meta_General" ELSE "Meta_$" END AS "META_UNIFICADA"
  FROM att_c WHERE zp OR (sp AND NOT zp)),
unified AS (
  SELECT "CALL_CENTER_FILTRO" AS "CALL_CENTER_ID", "NOMBRE_AGENTE", "META_UNIFICADA", "Recaudo_Meta",
    "Rodamiento", "Cedula_Cliente" FROM att),
last_contact AS (
  SELECT "Cedula_Cliente", arg_max("Tipo_Novedad", seq) AS "Tipo_Novedad", arg_max("Novedad", seq) AS "Novedad"
  FROM contacts WHERE "Cedula_Cliente" IS NOT NULL GROUP BY ALL),
mdetail AS (
  SELECT a.* EXCLUDE ("NOMBRE_AGENTE", "META_UNIFICADA"), coalesce(l."Tipo_Novedad", 'SIN NOVEDAD') AS "Tipo_Novedad",
    coalesce(l."Novedad", '') AS "Novedad"
  FROM att a LEFT JOIN last_contact l ON a."Cedula_Cliente" = l."Cedula_Cliente"),
vintages AS (
  SELECT *, CASE WHEN "Cuotas_Pagadas" = 0 THEN 'SECCION_1_SIN_PAGO' WHEN "Cuotas_Pagadas" = 1 THEN 'SECCION_2_FALLO_2DA'
                 WHEN "Cuotas_Pagadas" BETWEEN 2 AND 5 THEN 'SECCION_3_FALLO_3RA_PLUS' END AS "Grupo_Seguimiento"
  FROM portfolio WHERE "Fecha_Desembolso" >= DATE '2001-08-01' - INTERVAL 180 DAY AND "Dias_Atraso_Final" > 0),
vint AS (SELECT * FROM vintages WHERE "Grupo_Seguimiento" IS NOT NULL),
refi AS (
  SELECT *, "Total_Cuotas" - "Cuotas_Pagadas" AS "Cuotas_Restantes" FROM portfolio
  WHERE "Dias_Atraso_Final" <= 30 AND "Total_Cuotas" >= 6
    AND (("Total_Cuotas" BETWEEN 6 AND 8 AND "Total_Cuotas" - "Cuotas_Pagadas" BETWEEN 1 AND 2)
      OR ("Total_Cuotas" > 8 AND "Total_Cuotas" - "Cuotas_Pagadas" BETWEEN 1 AND 4))),
rscope AS (
  SELECT * FROM portfolio WHERE "Franja_Meta" IN ('1 A 30','31 A 90','91 A 180','181 A 360')
    AND NOT "Zona" IN ('CL1','CL2','CL3','CL4'))
"""


def d(c: str) -> str:
    """Date column rendered as text, keeping its name."""
    return f'strftime("{c}", \'%Y-%m-%d\') AS "{c}"'


DIMS9 = '"Empresa", "Regional_Cobro", "Zona", "Franja_Cartera", "CALL_CENTER_FILTRO", "Call_Center_Apoyo", "Regional_Venta", "Estado_Vigencia", "Cantidad_Novedades"'
DIMS7R = '"Empresa", "CALL_CENTER_FILTRO", "Regional_Cobro", "Zona", "Estado_Vigencia", "Franja_Cartera", "Cantidad_Novedades"'
DIMS7S = '"Empresa", "Regional_Cobro", "Zona", "Franja_Cartera", "CALL_CENTER_FILTRO", "Regional_Venta", "Estado_Vigencia"'

PORTFOLIO_DATES = ["Fecha_Desembolso", "Fecha_Cuota_Vigente"]
RR_COLS = ['Empresa', 'Credito', 'Cedula_Cliente', 'Nombre_Cliente', 'Fecha_Cuota_Vigente', 'Valor_Cuota_Vigente',
           'Regional_Cobro', 'Zona', 'Franja_Cartera', 'Dias_Atraso_Final', 'Total_Recaudo', 'Rodamiento',
           'Estado_Pago', 'Estado_Gestion', 'Cantidad_Novedades', 'Meta_$', 'CALL_CENTER_FILTRO',
           'Tipo_Vigencia_Temp', 'Estado_Vigencia']


def _rr_select(src: str) -> str:
    cols = ", ".join(d(c) if c == "Fecha_Cuota_Vigente" else f'"{c}"' for c in RR_COLS)
    return f"SELECT {cols} FROM {src}"


def _master(src: str) -> str:
    """Contents of a master table: rows, loans, clients, money, lengths of two texts."""
    loans = src != "contacts"
    types = src != "fbase"
    return ", ".join([
        "count(*) AS rows", ('count(DISTINCT "Credito")' if loans else "CAST(NULL AS BIGINT)") + " AS creditos",
        'count(DISTINCT "Cedula_Cliente") AS clientes',
        (f'CAST(sum(CAST("Total_Recaudo" AS {M})) AS DOUBLE)' if loans else "CAST(NULL AS DOUBLE)") + " AS recaudo",
        ('CAST(sum(length("Tipo_Novedad")) AS BIGINT)' if types else "CAST(NULL AS BIGINT)") + " AS tipo_largo",
        ('CAST(sum(length("Zona")) AS BIGINT)' if loans else "CAST(NULL AS BIGINT)") + " AS zona_largo"])


def _sunburst(where: str = "") -> str:
    return (f"SELECT {DIMS7S}, \"Estado_Gestion\", \"Cargo_Usuario\", count(*) AS \"Cantidad\" FROM merged2 "
            f"WHERE NOT (\"Estado_Gestion\" = 'CON GESTIÓN' AND \"Cargo_Usuario\" = 'SIN ASIGNAR') {where} GROUP BY ALL")


_TOKENS = ("list_sort(list_distinct(list_filter(string_split_regex(strip_accents(lower(\"Nombre_Usuario\")), '\\s+'), "
           "lambda t: length(t) > 1 AND NOT list_contains(['de','del','la','las','los','el','y','e','i'], t))))")

BODIES: dict[str, str] = {
    # 2.1
    "load_portfolio": f"SELECT * REPLACE ({d('Fecha_Desembolso')}, {d('Fecha_Cuota_Vigente')}) FROM portfolio",
    "load_contacts": f"SELECT * REPLACE ({d('Fecha_Novedad')}, {d('Fecha_Compromiso')}) FROM contacts",
    "load_calls": f"SELECT * EXCLUDE (user_id) REPLACE ({d('Fecha_Llamada')}) FROM calls",
    "load_messages": f"SELECT * REPLACE ({d('Fecha_Mensaje')}) FROM messages",
    "load_applications": f"SELECT * REPLACE ({d('Fecha_Nacimiento')}) FROM applications",
    "scan_sheet": f"""SELECT * REPLACE ({d('Fecha_Novedad')}, {d('Fecha_Compromiso')}) FROM contacts""",
    "write_detail": _rr_select("fbase"),
    "resolve_dataset": f"SELECT * REPLACE ({d('Fecha_Desembolso')}, {d('Fecha_Cuota_Vigente')}) FROM vint "
                       "WHERE \"Grupo_Seguimiento\" = 'SECCION_2_FALLO_2DA'",
    "scan_parquet": "SELECT \"Credito\", \"Total_Recaudo\", \"Zona\" FROM fbase WHERE \"Estado_Pago\" = 'PAGO'",
    "write_summary": f"""SELECT *, 'resultados' AS meta_modulo, 'ACME' AS meta_empresa, 'job-0001' AS job_id FROM (
        SELECT {DIMS7R}, "Franja_Meta", count("Zona") AS "Total_Cuentas", {msum('"Meta_$"')} AS "Meta_Total",
          {msum('"Recaudo_Meta"')} AS "Recaudo_Total", {msum('"Total_Recaudo_Sin_Anti"')} AS "Recaudo_Sin_Anti_Total",
          {msum('"Meta_T.R_$"')} AS "Recaudo_Meta_Total" FROM rscope GROUP BY ALL) x,
        LATERAL (SELECT CASE WHEN x."Meta_Total" > 0 THEN x."Recaudo_Total" / x."Meta_Total" ELSE 0.0 END AS "Cumplimiento_%") y""",
    "read_summary": """SELECT "Call_Center_Limpio" AS "Call_Center", count(*) AS "Total_Intentos",
        count(*) FILTER (WHERE "Estado_Llamada" = 'ANSWERED') AS "Con_Respuesta",
        count(*) FILTER (WHERE "Estado_Llamada" = 'ANSWERED') / count(*) AS "Efectividad", 'call_center' AS meta_modulo, 'job-0001' AS job_id
        FROM scalls GROUP BY ALL""",
    "export_filtered": f"""SELECT "Credito", "Cedula_Cliente", "Zona", "Total_Recaudo", "Estado_Pago", {d('Fecha_Cuota_Vigente')}
        FROM fbase WHERE "Zona" IN ('CL1','CL2','CL3')""",
    "master_tables": f"""SELECT 'detallados_cartera' AS tabla, CAST(34 AS BIGINT) AS cols, {_master('fbase')} FROM fbase
        UNION ALL SELECT 'detallados_novedades', CAST(10 AS BIGINT), {_master('contacts')} FROM contacts
        UNION ALL SELECT 'seguimientos_gestion', CAST(22 AS BIGINT), {_master('detail')} FROM detail
        UNION ALL SELECT 'seguimientos_rodamientos', CAST(19 AS BIGINT), {_master('fbase')} FROM fbase""",
    "active_manifest": """SELECT count(*) AS creditos, count(DISTINCT "Cedula_Cliente") AS clientes, 'job-0001' AS active_job_id,
        '2001-08-01T12:00:00' AS fecha_actualizacion, 'ACME' AS empresa, 'ready' AS status FROM portfolio""",
    "ingest_new_drops": """SELECT "Call_Center_Limpio" AS "Call_Center", count(*) AS "Total_Intentos",
        count(*) FILTER (WHERE "Estado_Llamada" = 'ANSWERED') AS "Con_Respuesta" FROM scalls GROUP BY ALL""",
    # 2.2
    "parse_mixed_dates": """SELECT event_id, raw, strftime(CAST(coalesce(try_strptime(substr(raw, 1, 10), '%Y-%m-%d'),
            try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_strptime(replace(substr(raw, 1, 10), '/', '-'), '%Y-%m-%d')) AS DATE), '%Y-%m-%d') AS parsed
        FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y/%m/%d')
              WHEN 2 THEN strftime(ts, '%d/%m/%Y') ELSE strftime(ts, '%Y-%m-%d') END AS raw FROM events)""",
    "trim_text": 'SELECT seq, trim("Estado_Llamada") AS "Estado_Llamada", trim("Call_Center") AS "Call_Center" FROM calls',
    "prepaid_flag": 'SELECT "Credito", "Tipo_Vigencia_Temp" FROM p1',
    "parse_amount": """SELECT "Credito", "Valor_Cuota_Vigente" AS raw,
        coalesce(TRY_CAST(replace(regexp_replace("Valor_Cuota_Vigente", 'ANTICIPADO', '0', 'gi'), ',', '') AS DOUBLE), 0.0) AS amount,
        coalesce(TRY_CAST(regexp_replace(regexp_replace("Valor_Cuota_Vigente", 'ANTICIPADO', '0', 'gi'), '^([^,]*),', '\\1') AS DOUBLE), 0.0) AS amount_parity
        FROM portfolio_raw""",
    "fill_contacts": 'SELECT "Credito", "Cantidad_Novedades" FROM portfolio',
    "normalize_zone": 'SELECT "Credito", "Zona", "Call_Center_Apoyo" FROM p1',
    "assign_call_center": 'SELECT "Credito", "CALL_CENTER_FILTRO" FROM portfolio',
    "default_region": """SELECT "Credito", coalesce(CASE WHEN "Zona_Cobro" IS NULL THEN NULL ELSE "Regional_Cobro" END, 'OTRAS ZONAS')
        AS "Regional_Cobro" FROM portfolio_raw""",
    "validity_state": """SELECT "Credito", "Estado_Vigencia", CASE WHEN "Estado_Vigencia" = 'vigente' THEN
        CASE WHEN day("Fecha_Cuota_Vigente") <= 10 THEN 'Días 1-10' WHEN day("Fecha_Cuota_Vigente") <= 20 THEN 'Días 11-20'
        ELSE 'Días 21+' END END AS "Sub_Estado_Vigencia" FROM portfolio""",
    "validity_substate": f"""SELECT "Credito", {d('Fecha_Cuota_Vigente')}, CASE WHEN "Estado_Vigencia" = 'vigente' THEN
        CASE WHEN day("Fecha_Cuota_Vigente") <= 10 THEN 'Días 1-10' WHEN day("Fecha_Cuota_Vigente") <= 20 THEN 'Días 11-20'
        ELSE 'Días 21+' END END AS "Sub_Estado_Vigencia" FROM portfolio""",
    "payment_state": """SELECT "Credito",
        CASE WHEN "Tipo_Vigencia_Temp" = 'ANTICIPADO' THEN 'ANTICIPADO' WHEN "Total_Recaudo" > 50000 THEN 'PAGO' ELSE 'SIN PAGO' END AS pago_portfolio,
        CASE WHEN "Tipo_Vigencia_Temp" = 'ANTICIPADO' THEN 'ANTICIPADO' WHEN "Total_Recaudo" > 50000 THEN 'PAGO' ELSE 'SIN PAGO' END AS pago_followups,
        CASE WHEN "Total_Recaudo" > 50000 THEN 'PAGO' ELSE 'SIN PAGO' END AS pago_callcenter,
        CASE WHEN "Total_Recaudo" > 0 THEN 'PAGO' ELSE 'SIN PAGO' END AS pago_funnel FROM portfolio""",
    "contact_state": 'SELECT "Credito", "Estado_Gestion" FROM fbase',
    "map_collection_zone": """SELECT * FROM (SELECT "Credito", "Zona_Cobro", coalesce(CASE "Zona_Cobro" WHEN 'ZCN' THEN 'CASA COBRANZA'
        WHEN '1AB' THEN 'ABOGADO' WHEN 'CC01' THEN 'CASTIGO' WHEN '1CE' THEN 'OTROS CASOS' WHEN 'CEC' THEN 'OTROS CASOS' END,
        "Regional_Cobro") AS "Eje_X_Cobro" FROM portfolio) WHERE "Eje_X_Cobro" IS NOT NULL""",
    "normalize_phone": """SELECT seq, "Numero_Telefono", trim(regexp_replace("Numero_Telefono", '\\.0$', '')) AS "Tel_Norm" FROM messages""",
    "clean_call_center": 'SELECT seq, "Call_Center_Limpio" FROM calls',
    "clean_call_state": """SELECT seq, CASE WHEN upper(trim("Estado_Llamada")) = 'ANSWERED' THEN 'CON RESPUESTA' ELSE 'SIN RESPUESTA' END
        AS "Estado_Respuesta" FROM calls""",
    "trim_column_names": 'SELECT seq, "Nombre_Call", "Call_Center" FROM calls',
    "conversation_flag": """SELECT seq, coalesce(lower(trim("Tipo_Respuesta_Agente")) IN ('text', 'audio'), false) AS "Es_Conversacion" FROM messages""",
    "name_tokens": f"""SELECT "Nombre_Usuario", array_to_string({_TOKENS}, ' ') AS tokens FROM
        (SELECT DISTINCT "Nombre_Usuario" FROM contacts UNION SELECT DISTINCT "Nombre_Call" FROM calls)""",
    "promise_state": f"""SELECT seq, {d('Fecha_Compromiso')}, CASE WHEN "Fecha_Compromiso" IS NULL THEN 'ACUERDOS SIN FECHA'
        WHEN "Fecha_Compromiso" < DATE '2024-01-15' THEN 'ACUERDOS VENCIDOS' ELSE 'ACUERDOS VIGENTES' END AS "Estado_Acuerdo"
        FROM contacts WHERE upper("Tipo_Novedad") LIKE '%COMPROMISO%'""",
    "guard_numeric": """SELECT "Credito", coalesce("Meta_$", 0.0) AS "Meta_$", coalesce("Recaudo_Meta", 0.0) AS "Recaudo_Meta",
        coalesce("Valor_Cuota_Vigente", 0.0) AS "Valor_Cuota_Vigente", CAST(0 AS DOUBLE) AS "Valor_Vencido" FROM portfolio""",
    "default_dims": """SELECT "Credito", 'SIN EMPRESA' AS "Empresa", "Call_Center_Apoyo" AS "CALL_CENTER_FILTRO", "Regional_Cobro",
        'SIN FRANJA' AS "Franja_Cartera", "Estado_Vigencia" FROM portfolio""",
    "dates_to_text": f"SELECT seq, {d('Fecha_Novedad')}, {d('Fecha_Compromiso')} FROM contacts",
    # 2.3
    "project_existing": _rr_select("fbase"),
    "results_scope": 'SELECT "Credito", "Franja_Meta", "Zona" FROM rscope',
    "refinance_candidates": 'SELECT "Credito", "Total_Cuotas", "Cuotas_Pagadas", "Cuotas_Restantes", "Dias_Atraso_Final" FROM refi',
    "vintage_early_risk": f'SELECT "Credito", {d("Fecha_Desembolso")}, "Cuotas_Pagadas", "Grupo_Seguimiento" FROM vint',
    "center_filter": "SELECT seq, \"Call_Center\" FROM attributed WHERE \"Call_Center\" = 'CL3'",
    "valid_center_messages": 'SELECT seq, "Call_Center" FROM vmsg',
    "valid_assignment": """SELECT "Credito", "Cargo_Usuario", "Estado_Gestion" FROM merged2
        WHERE NOT ("Estado_Gestion" = 'CON GESTIÓN' AND "Cargo_Usuario" = 'SIN ASIGNAR')""",
    "application_summary": 'SELECT "Nombre_Vendedor", "Estado", "Regional_Venta", "Analista_Asociado" FROM applications',
    "application_matrix": """SELECT "Nombre_Vendedor", "Estado", count(*) AS "count" FROM applications GROUP BY ALL""",
    # 2.4
    "join_client_roles": 'SELECT "Credito", "Cedula_Cliente", "Cargo_Usuario" FROM merged2',
    "join_contacts_per_role": 'SELECT "Credito", "Cargo_Usuario", "Novedades_Por_Cargo" FROM merged3',
    "join_contact_detail": f"""SELECT "Credito", "Cargo_Usuario", "Novedades_Por_Cargo", seq, "Tipo_Novedad", "Novedad",
        "Nombre_Usuario", {d('Fecha_Novedad')} FROM detail""",
    "join_latest_contact": 'SELECT "Credito", "CALL_CENTER_FILTRO", "Tipo_Novedad", "Novedad" FROM mdetail',
    "latest_contact_state": 'SELECT "Cedula_Cliente", "Tipo_Novedad", "Novedad" FROM last_contact',
    "msg_phone_match": 'SELECT seq, "Tel_Norm" FROM conv WHERE "Tel_Norm" IN (SELECT "Tel" FROM phones)',
    "msg_payer_match": """SELECT c.seq, c."Tel_Norm", pc."Cedula_Cliente" FROM conv c
        JOIN phone_clients pc ON c."Tel_Norm" = pc."Tel" JOIN payers p ON pc."Cedula_Cliente" = p."Cedula_Cliente"
        WHERE c."Tel_Norm" IN (SELECT "Tel" FROM phones)""",
    "semi_join_validity": """SELECT seq, "Cedula_Cliente" FROM contacts WHERE "Cedula_Cliente" IN
        (SELECT "Cedula_Cliente" FROM portfolio WHERE "Estado_Vigencia" = 'anticipado')""",
    "semi_join_contacts": """SELECT seq, "Cedula_Cliente" FROM contacts WHERE "Cedula_Cliente" IN
        (SELECT "Cedula_Cliente" FROM portfolio WHERE "Zona" IN ('CL1', 'CL2'))""",
    "filter_calls_by_center": """SELECT seq, "Call_Center_Limpio" FROM calls WHERE "Call_Center_Limpio" IN ('CL1', 'CL2')""",
    "fuzzy_agent_match": 'SELECT seq, "Nombre_Usuario", "Call_Center" FROM attributed',
    # 2.5
    "cube_regional": f'SELECT {DIMS9}, "Franja_Meta", count(*) AS "count", {msum(chr(34) + "Total_Recaudo" + chr(34))} AS "Total_Recaudo" FROM portfolio GROUP BY ALL',
    "cube_collection": f"""SELECT {DIMS9}, "Eje_X_Cobro", "Franja_Meta", count(*) AS "count" FROM (
        SELECT *, coalesce(CASE "Zona_Cobro" WHEN 'ZCN' THEN 'CASA COBRANZA' WHEN '1AB' THEN 'ABOGADO' WHEN 'CC01' THEN 'CASTIGO'
        WHEN '1CE' THEN 'OTROS CASOS' WHEN 'CEC' THEN 'OTROS CASOS' END, "Regional_Cobro") AS "Eje_X_Cobro" FROM portfolio)
        WHERE "Eje_X_Cobro" IS NOT NULL GROUP BY ALL""",
    "cube_disbursement": f"""SELECT {DIMS9}, CAST(year("Fecha_Desembolso") AS BIGINT) AS "Año_Desembolso", "Franja_Meta",
        CAST(round(coalesce(sum(CAST("Valor_Desembolso" AS {M})), 0), 0) AS BIGINT) AS "Valor_Desembolso"
        FROM portfolio WHERE "Fecha_Desembolso" IS NOT NULL AND year("Fecha_Desembolso") BETWEEN 1995 AND 2001 GROUP BY ALL""",
    "cube_validity": f"""SELECT {DIMS9}, "Estado_Vigencia" AS "Estado_Vigencia_Agrupado",
        CASE WHEN "Estado_Vigencia" = 'vigente' THEN CASE WHEN day("Fecha_Cuota_Vigente") <= 10 THEN 'Días 1-10'
        WHEN day("Fecha_Cuota_Vigente") <= 20 THEN 'Días 11-20' ELSE 'Días 21+' END END AS "Sub_Estado_Vigencia",
        count(*) AS "count" FROM portfolio GROUP BY ALL""",
    "results_by_zone": f"""SELECT *, CASE WHEN "Meta_Total" > 0 THEN "Recaudo_Total" / "Meta_Total" ELSE 0.0 END AS "Cumplimiento_%" FROM (
        SELECT {DIMS7R}, "Franja_Meta", count("Zona") AS "Total_Cuentas", {msum('"Meta_$"')} AS "Meta_Total",
        {msum('"Recaudo_Meta"')} AS "Recaudo_Total", {msum('"Total_Recaudo_Sin_Anti"')} AS "Recaudo_Sin_Anti_Total",
        {msum('"Meta_T.R_$"')} AS "Recaudo_Meta_Total" FROM rscope GROUP BY ALL)""",
    "results_by_collector": f"""SELECT *, CASE WHEN "Meta_Total" > 0 THEN "Recaudo_Total" / "Meta_Total" ELSE 0.0 END AS "Cumplimiento_%" FROM (
        SELECT {DIMS7R}, "Cobrador", count("Cobrador") AS "Total_Cuentas", {msum('"Meta_T.R_$"')} AS "Meta_Total",
        {msum('"Total_Recaudo_Sin_Anti"')} AS "Recaudo_Total" FROM rscope
        WHERE "Cobrador" IS NOT NULL AND "Cobrador" <> '' GROUP BY ALL)""",
    "donut_payment": f'SELECT {DIMS7S}, "Estado_Pago", "Estado_Gestion", count(*) AS "count" FROM fbase GROUP BY ALL',
    "roll_rate": f"""SELECT {DIMS7S}, "Rodamiento", "Estado_Gestion", count(*) AS "Número de Cuentas" FROM fbase
        WHERE "Rodamiento" IS NOT NULL AND "Rodamiento" <> '' GROUP BY ALL""",
    "sunburst_all": _sunburst(),
    "sunburst_paid": _sunburst("AND \"Estado_Pago\" = 'PAGO'"),
    "sunburst_unpaid": _sunburst("AND \"Estado_Pago\" = 'SIN PAGO'"),
    "contacts_per_role": 'SELECT * FROM per_role',
    "vintage_sections": """SELECT count(*) FILTER (WHERE "Grupo_Seguimiento" = 'SECCION_1_SIN_PAGO') AS s1,
        count(*) FILTER (WHERE "Grupo_Seguimiento" = 'SECCION_2_FALLO_2DA') AS s2, count(*) FILTER (WHERE "Grupo_Seguimiento" = 'SECCION_3_FALLO_3RA_PLUS') AS s3,
        count(*) AS total_cosechas FROM vint""",
    "refinance_total": "SELECT count(*) AS total_retanqueos FROM refi",
    "management_base": "SELECT * FROM unified",
    "goal_attainment": f"""SELECT "CALL_CENTER_ID" AS "CALL_CENTER", "NOMBRE_AGENTE" AS "NOMBRE", "META_$", "Recaudo_Meta",
        CAST(CAST("META_$" AS {M}) - CAST("Recaudo_Meta" AS {M}) AS DOUBLE) AS "Faltante",
        CASE WHEN "META_$" > 0 THEN "Recaudo_Meta" / "META_$" ELSE 0.0 END AS "Cumplimiento" FROM (
        SELECT "CALL_CENTER_ID", "NOMBRE_AGENTE", {msum('"META_UNIFICADA"')} AS "META_$", {msum('"Recaudo_Meta"')} AS "Recaudo_Meta"
        FROM unified GROUP BY ALL)""",
    "roll_rate_cc": 'SELECT "Rodamiento", count(*) AS "count" FROM unified GROUP BY ALL',
    "cc_meta": f'SELECT count(*) AS total_cuentas, {msum(chr(34) + "META_UNIFICADA" + chr(34))} AS total_meta FROM unified',
    "call_totals": """SELECT count(*) AS total_llamadas, count(*) FILTER (WHERE "Estado_Llamada" = 'ANSWERED') AS con_respuesta,
        count(*) - count(*) FILTER (WHERE "Estado_Llamada" = 'ANSWERED') AS sin_respuesta FROM scalls""",
    "call_chart": """SELECT 'CON RESPUESTA' AS "Tipo", count(*) FILTER (WHERE "Estado_Llamada" = 'ANSWERED') AS "Cantidad" FROM scalls
        UNION ALL SELECT 'SIN RESPUESTA', count(*) - count(*) FILTER (WHERE "Estado_Llamada" = 'ANSWERED') FROM scalls""",
    "msg_paying_clients": """SELECT count(DISTINCT pc."Cedula_Cliente") AS clientes_con_pago FROM conv c
        JOIN phone_clients pc ON c."Tel_Norm" = pc."Tel" JOIN payers p ON pc."Cedula_Cliente" = p."Cedula_Cliente"
        WHERE c."Tel_Norm" IN (SELECT "Tel" FROM phones)""",
    "call_effectiveness": """SELECT "Call_Center_Limpio" AS "Call_Center", count(*) AS "Total_Intentos",
        count(*) FILTER (WHERE "Estado_Llamada" = 'ANSWERED') AS "Con_Respuesta", count(*) FILTER (WHERE "Estado_Llamada" = 'ANSWERED') / count(*) AS "Efectividad"
        FROM scalls GROUP BY ALL""",
    "call_threshold": 'SELECT count(DISTINCT "Call_Center_Limpio") * 30 AS alerta_umbral FROM scalls',
    "calls_by_day": """SELECT strftime("Fecha_Llamada", '%Y-%m-%d') AS "Fecha",
        CASE WHEN "Estado_Llamada" = 'ANSWERED' THEN 'CON RESPUESTA' ELSE 'SIN RESPUESTA' END AS "Estado_Respuesta",
        count(*) AS "Total_Llamadas" FROM scalls WHERE "Fecha_Llamada" IS NOT NULL GROUP BY ALL""",
    "msg_effectiveness": """SELECT "Call_Center" AS name, count(*) AS entregados, count(*) FILTER (WHERE "Es_Conversacion") AS conversaciones,
        CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE "Es_Conversacion") / count(*) * 100 ELSE 0.0 END AS porcentaje FROM vmsg GROUP BY ALL""",
    "msg_funnel": """SELECT 0 AS stage, 'Mensajes Entregados' AS name, (SELECT count(*) FROM vmsg) AS value
        UNION ALL SELECT 1, 'Conversaciones', (SELECT count(*) FROM conv)
        UNION ALL SELECT 2, 'Gestión en Sistema', (SELECT count(*) FROM conv WHERE "Tel_Norm" IN (SELECT "Tel" FROM phones))
        UNION ALL SELECT 3, 'Clientes con Pago', (SELECT count(*) FROM conv c JOIN phone_clients pc ON c."Tel_Norm" = pc."Tel"
            JOIN payers p ON pc."Cedula_Cliente" = p."Cedula_Cliente" WHERE c."Tel_Norm" IN (SELECT "Tel" FROM phones))""",
    "contacts_by_center": 'SELECT "Call_Center", count(*) AS "Cantidad" FROM attributed WHERE "Call_Center" <> \'SIN ASIGNAR\' GROUP BY ALL',
    "contacts_by_center_type": """SELECT "Call_Center", "Tipo_Novedad", count(*) AS "Cantidad" FROM attributed
        WHERE "Call_Center" <> 'SIN ASIGNAR' GROUP BY ALL""",
    "promises_by_state": """SELECT "Call_Center", CASE WHEN "Fecha_Compromiso" IS NULL THEN 'ACUERDOS SIN FECHA'
        WHEN "Fecha_Compromiso" < DATE '2024-01-15' THEN 'ACUERDOS VENCIDOS' ELSE 'ACUERDOS VIGENTES' END AS "Estado_Acuerdo",
        count(*) AS "Cantidad" FROM attributed WHERE upper("Tipo_Novedad") LIKE '%COMPROMISO%' AND "Call_Center" <> 'SIN ASIGNAR'
        GROUP BY ALL""",
    "contact_kpis": """SELECT count(*) AS total, count(*) FILTER (WHERE "Call_Center" = 'SIN ASIGNAR') AS sin_asignar,
        coalesce((SELECT "Tipo_Novedad" FROM attributed GROUP BY ALL ORDER BY count(*) DESC, "Tipo_Novedad" LIMIT 1), 'N/A') AS top_tipo
        FROM attributed""",
    "facet_values": """SELECT DISTINCT facet, value FROM (
        SELECT 'empresas' AS facet, "Empresa" AS value FROM portfolio UNION ALL SELECT 'zonas', "Zona" FROM portfolio
        UNION ALL SELECT 'regionales', "Regional_Cobro" FROM portfolio UNION ALL SELECT 'call_centers', "CALL_CENTER_FILTRO" FROM portfolio
        UNION ALL SELECT 'franjas', "Franja_Cartera" FROM portfolio) WHERE value IS NOT NULL
        UNION ALL SELECT 'estados_vigencia', 'vigente' UNION ALL SELECT 'estados_vigencia', 'vencido'
        UNION ALL SELECT 'estados_vigencia', 'anticipado'""",
    "facet_values_cc": """SELECT DISTINCT facet, value FROM (
        SELECT 'empresas' AS facet, "Empresa" AS value FROM mdetail UNION ALL SELECT 'zonas', "Zona" FROM mdetail
        UNION ALL SELECT 'regionales', "Regional_Cobro" FROM mdetail UNION ALL SELECT 'call_centers', "CALL_CENTER_FILTRO" FROM mdetail
        UNION ALL SELECT 'franjas', "Franja_Meta" FROM mdetail UNION ALL SELECT 'estados_vigencia', "Estado_Vigencia" FROM mdetail)
        UNION ALL SELECT 'estados_gestion', 'CON GESTIÓN' UNION ALL SELECT 'estados_gestion', 'SIN GESTIÓN'""",
    # 2.7
    "search_text": """SELECT "Credito", seq, "Nombre_Cliente" FROM detail WHERE contains(lower("Nombre_Cliente"), 'customer#0000001')
        OR contains(lower("Cedula_Cliente"), 'customer#0000001') OR contains(lower("Credito"), 'customer#0000001')
        OR contains(lower("Cargo_Usuario"), 'customer#0000001') OR contains(lower("Novedad"), 'customer#0000001')
        OR contains(lower("Empresa"), 'customer#0000001') OR contains(lower("Nombre_Vendedor"), 'customer#0000001')
        OR contains(lower("Regional_Venta"), 'customer#0000001')""",
    "search_facets": """SELECT "Credito", "Empresa", "Regional_Cobro", "Franja_Cartera", "CALL_CENTER_FILTRO" FROM fbase
        WHERE "Empresa" IN ('BUILDING', 'MACHINERY') AND "Regional_Cobro" IN ('ASIA', 'EUROPE') AND "Regional_Venta" IN ('ASIA', 'EUROPE')
        AND "Franja_Cartera" IN ('1 A 30', 'AL DIA') AND "CALL_CENTER_FILTRO" IN ('CL1', 'CL5', 'CL7')""",
    "search_contacted": 'SELECT "Credito", "Cantidad_Novedades" FROM fbase WHERE "Cantidad_Novedades" > 0',
    "search_states": """SELECT "Credito", "Estado_Pago", "Estado_Gestion", "Rodamiento" FROM fbase WHERE "Estado_Pago" IN ('PAGO')
        AND "Estado_Gestion" IN ('CON GESTIÓN') AND "Rodamiento" IN ('MEJORA', 'NORMALIZO')""",
    "search_role": """SELECT "Credito", seq, "Cargo_Usuario" FROM detail WHERE "Cargo_Usuario" IN ('SIN ASIGNAR', 'ABOGADO')
        OR "Cargo_Usuario" IS NULL OR "Cargo_Usuario" = ''""",
    "search_vintage_section": """SELECT "Credito", "Grupo_Seguimiento" FROM vint WHERE "Grupo_Seguimiento" = 'SECCION_3_FALLO_3RA_PLUS'""",
    "search_page": """WITH f AS (SELECT * FROM detail WHERE "Zona" IN ('CL1','CL2','CL3','CL4') AND "Cargo_Usuario" IN ('GESTOR')
            AND "Cantidad_Novedades" > 0
            AND "Cedula_Cliente" IN (SELECT "Cedula_Cliente" FROM portfolio WHERE "Estado_Vigencia" IN ('vigente'))),
        n AS (SELECT count(*) AS total, (count(*) + 19) // 20 AS pages FROM f),
        pg AS (SELECT total, pages, CASE WHEN total = 0 THEN 1 ELSE greatest(1, least(3, pages)) END AS page FROM n),
        r AS (SELECT *, row_number() OVER (ORDER BY "Credito", seq) AS rn FROM f)
        SELECT "Credito", seq, "Zona", "Cargo_Usuario", "Tipo_Novedad", total AS total_registros, page AS pagina_actual,
          pages AS total_paginas FROM r, pg WHERE rn > (page - 1) * 20 AND rn <= page * 20""",
    "lookup_clients": """SELECT "Nombre_Cliente", "Cedula_Cliente", "Credito" FROM portfolio
        WHERE contains(lower("Nombre_Cliente"), 'customer#00000012') OR contains("Cedula_Cliente", 'customer#00000012')
        OR contains("Credito", 'customer#00000012') ORDER BY "Credito" LIMIT 20""",
    "related_rows": f"""SELECT "Credito", seq, "Cargo_Usuario", {d('Fecha_Novedad')} FROM detail WHERE trim("Cedula_Cliente") = '42'""",
}

# live_cc_metrics: the whole call-centre module over the filtered detail.  Each
# metric table is the body of its own key, read from the restricted views.
_SCOPE = """WHERE "Franja_Cartera" IN ('AL DIA', '1 A 30', '31 A 90') AND "CALL_CENTER_FILTRO" IN ('CL1', 'CL2', 'CL5')"""
_LIVE_VIEWS = f"""l_mdetail AS (SELECT * FROM mdetail {_SCOPE}),
    l_unified AS (SELECT "CALL_CENTER_FILTRO" AS "CALL_CENTER_ID", "NOMBRE_AGENTE", "META_UNIFICADA", "Recaudo_Meta", "Rodamiento" FROM att {_SCOPE}),
    l_contacts AS (SELECT * FROM contacts WHERE "Cedula_Cliente" IN (SELECT "Cedula_Cliente" FROM l_mdetail)),
    l_scalls AS (SELECT * FROM scalls WHERE "Call_Center_Limpio" IN ('CL1', 'CL2', 'CL5')),
    l_phone_clients AS (SELECT * FROM phone_clients WHERE "Cedula_Cliente" IN (SELECT "Cedula_Cliente" FROM l_mdetail)),
    l_phones AS (SELECT DISTINCT "Tel" FROM l_phone_clients),
    l_payers AS (SELECT DISTINCT "Cedula_Cliente" FROM l_mdetail WHERE "Total_Recaudo" > 50000),
    l_agents AS (SELECT DISTINCT "Call_Center_Limpio" FROM calls WHERE "Call_Center_Limpio" IN ('CL1', 'CL2', 'CL5')),
    l_attributed AS (SELECT a.* REPLACE (CASE WHEN "Call_Center" IN (SELECT "Call_Center_Limpio" FROM l_agents) THEN "Call_Center"
        ELSE 'SIN ASIGNAR' END AS "Call_Center") FROM attributed a WHERE "Cedula_Cliente" IN (SELECT "Cedula_Cliente" FROM l_mdetail))"""
_LIVE = [("meta", "cc_meta", ["total_cuentas", "total_meta"], None, None),
         ("cumplimiento", "goal_attainment", ["META_$", "Recaudo_Meta", "Faltante", "Cumplimiento"], "CALL_CENTER", "NOMBRE"),
         ("rodamiento", "roll_rate_cc", ["count"], "Rodamiento", None),
         ("llamadas", "call_totals", ["total_llamadas", "con_respuesta", "sin_respuesta"], None, None),
         ("efectividad", "call_effectiveness", ["Total_Intentos", "Con_Respuesta", "Efectividad"], "Call_Center", None),
         ("umbral", "call_threshold", ["alerta_umbral"], None, None),
         ("por_dia", "calls_by_day", ["Total_Llamadas"], "Fecha", "Estado_Respuesta"),
         ("mensajeria", "msg_effectiveness", ["entregados", "conversaciones", "porcentaje"], "name", None),
         ("funnel", "msg_funnel", ["value"], "name", None),
         ("kpis", "contact_kpis", ["total", "sin_asignar"], "top_tipo", None),
         ("novedades_cc", "contacts_by_center", ["Cantidad"], "Call_Center", None),
         ("novedades_tipo", "contacts_by_center_type", ["Cantidad"], "Call_Center", "Tipo_Novedad"),
         ("compromisos", "promises_by_state", ["Cantidad"], "Call_Center", "Estado_Acuerdo"),
         ("filtros", "facet_values_cc", ["n"], "facet", "value")]


def _live() -> str:
    views = "|".join(["mdetail", "unified", "contacts", "scalls", "phone_clients", "phones", "payers", "attributed"])
    parts = []
    for section, key, values, clave, detalle in _LIVE:
        body = re.sub(rf"\b(FROM|JOIN) ({views})\b", r"\1 l_\2", BODIES[key])
        if section == "filtros":
            body = f"SELECT *, 1 AS n FROM ({body})"
        text = lambda c: f'CAST("{c}" AS VARCHAR)' if c else "CAST(NULL AS VARCHAR)"
        parts += [f"SELECT '{section}' AS seccion, {text(clave)} AS clave, {text(detalle)} AS detalle, '{v}' AS metric, "
                  f'CAST("{v}" AS DOUBLE) AS value FROM ({body})' for v in values]
    return f"WITH {_LIVE_VIEWS}\n" + "\nUNION ALL ".join(parts)


BODIES["live_cc_metrics"] = _live()


def oracle_sql() -> dict[str, str]:
    out = {}
    for k, body in BODIES.items():
        b = body.strip()
        if b.upper().startswith("WITH "):
            out[k] = f"WITH {BASE},\n{b[5:]}"
        else:
            out[k] = f"WITH {BASE}\n{b}"
    return out

"""Domain constants and declared landing schemas.

The values in the FIXED VALUES block must equal the source system's so that
outputs line up (column names, labels, code maps); they are stated as text.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the source system exactly)
# ---------------------------------------------------------------------------

PORTFOLIO_COLUMNS = [
    "Empresa", "Credito", "Fecha_Desembolso", "Factura_Venta", "Fecha_Facturada",
    "Nombre_Producto", "Cantidad_Producto", "Obsequio", "Cantidad_Obsequio",
    "Cedula_Cliente", "Nombre_Cliente", "Correo", "Celular", "Direccion", "Barrio",
    "Nombre_Ciudad", "Zona", "Cobrador", "Telefono_Cobrador", "Zona_Cobro",
    "Call_Center_Apoyo", "Nombre_Call_Center", "Telefono_Call_Center", "Regional_Cobro",
    "Gestor", "Telefono_Gestor", "Jefe_ventas", "Codigo_Vendedor", "Cedula_Vendedor",
    "Nombre_Vendedor", "Vendedor_Activo", "Zona_Venta", "Lider_Zona", "Codigo_Centro_Costos",
    "Regional_Venta", "Codeudor1", "Nombre_Codeudor1", "Telefono_Codeudor1",
    "Ciudad_Codeudor1", "Codeudor2", "Nombre_Codeudor2", "Telefono_Codeudor2",
    "Ciudad_Codeudor2", "Valor_Desembolso", "Total_Cuotas", "Valor_Cuota",
    "Dias_Atraso", "Franja_Meta", "Franja_Cartera", "Saldo_Capital", "Saldo_Interes_Corriente",
    "Saldo_Avales", "Meta_Intereses", "Meta_General", "Meta_Saldo", "Meta_%", "Meta_$",
    "Meta_T.R_%", "Meta_T.R_$", "Cuotas_Pagadas", "Cuota_Vigente",
    "Fecha_Cuota_Vigente", "Valor_Cuota_Vigente", "Fecha_Cuota_Atraso",
    "Primera_Cuota_Mora", "Fecha_Ultimo_Pago_Inicial", "Rango_Ultimo_pago_Inicial",
    "Valor_Cuota_Atraso", "Valor_Vencido", "Fecha_Ultima_Novedad", "Cantidad_Novedades",
    "Fecha_Ultimo_pago", "Rango_Ultimo_pago", "Dias_Atraso_Final",
    "Franja_Meta_Final", "Franja_Cartera_Final", "Rodamiento", "Rodamiento_Cartera",
    "Recaudo_Anticipado", "Recaudo_Meta", "Total_Recaudo", "Total_Recaudo_Sin_Anti",
]

CONTACT_COLUMNS = [
    "Empresa", "Cedula_Cliente", "Nombre_Cliente", "Fecha_Novedad", "Usuario_Novedad",
    "Nombre_Usuario", "Telefono_Cliente", "Celular_Cliente", "Cargo_Usuario",
    "Celular_Corporativo", "Codigo_Novedad", "Tipo_Novedad", "Novedad", "Fecha_Compromiso", "Valor",
]

CALL_COLUMNS = [
    "Fecha_Llamada", "Extension_Llamada", "Destino_Llamada", "Estado_Llamada", "Duracion_Llamada",
    "Codigo_Llamada", "Grabacion_Llamada", "Call_Center", "Nombre_Call",
]

MESSAGE_COLUMNS = [
    "Fecha_Mensaje", "Numero_Telefono", "Nombre_Saliente", "Estado", "Estado_Mensaje",
    "Estado_Respuesta_Entrante", "Flujo_Truora", "Estado_Proceso", "Fallo_Proceso",
    "Tipo_Respuesta_Agente", "Call_Center", "Nombre_Call",
]

# legacy application column -> domain name
APPLICATION_RENAMES = {
    "ESTADO": "Estado", "ANALISTA": "Analista_Asociado", "FECHA": "Fecha", "REGIONAL": "Regional_Venta",
    "DESEMBOLSO": "Credito_Desembolsado", "CEDULA": "Cedula_Cliente", "FS1NACFEC": "Fecha_Nacimiento",
    "APELLIDOS": "Apellidos", "NOMBRES": "Nombres", "TELEFONO1": "Celular1", "MOVIL": "Celular2",
    "FS1EMAIL": "Correo", "CARGO": "Cargo", "DIRECCION": "Direccion", "CODCIUDAD": "Codigo_Ciudad",
    "CIUDAD": "Ciudad", "BARRIO": "Barrio", "VENNOMBRE": "Nombre_Vendedor", "CCONOMBRE": "Centro_Costo",
    "CUOTAS": "Total_Cuotas", "FS0NOTA": "Nota", "VALOR_TOTA": "Valor_Total", "INGRESOS": "Ingresos",
    "GASTOS": "Gastos", "PAGARE": "Pagare",
}

# collection-zone code -> label
COLLECTION_ZONE_MAP = {
    "ZCN": "CASA COBRANZA",
    "1AB": "ABOGADO",
    "CC01": "CASTIGO",
    "1CE": "OTROS CASOS",
    "CEC": "OTROS CASOS",
}

# days-late buckets in display order
BUCKET_ORDER = ["AL DIA", "1 A 30", "31 A 90", "91 A 180", "181 A 360", "MAS DE 360"]
LATE_BUCKETS = ["1 A 30", "31 A 90", "91 A 180", "181 A 360"]

NULL_TOKENS = ["NA", "N/A", "null", "nan", "NO APLICA"]

ZONE_CENTERS = ["CL1", "CL2", "CL3", "CL4"]
SUPPORT_CENTERS = ["CL5", "CL6", "CL7", "CL8", "CL9"]
ALL_CENTERS = ["CL1", "CL2", "CL3", "CL4", "CL5", "CL6", "CL7", "CL8", "CL9"]

NAME_STOP_WORDS = ["de", "del", "la", "las", "los", "el", "y", "e", "i"]

VALIDITY_STATES = ["vigente", "vencido", "anticipado"]
CONTACT_TYPES = ["COMPROMISO", "AUSENCIA", "PAGO", "NOVEDAD"]
SEARCH_TEXT_COLUMNS = ["Nombre_Cliente", "Cedula_Cliente", "Credito", "Cargo_Usuario", "Novedad",
                       "Empresa", "Nombre_Vendedor", "Regional_Venta"]

PAYMENT_THRESHOLD = 50000.0
FUZZY_ACCEPT = 0.65
FUZZY_FALLBACK = 0.60
CALL_THRESHOLD_PER_CENTER = 30
DROP_NAME_PATTERN = "Reporte_General"
DEFAULT_PAGE_SIZE = 20

CON_GESTION = "CON GESTIÓN"
SIN_GESTION = "SIN GESTIÓN"

# output projections of the four master tables
ROLL_RATE_TABLE_COLUMNS = [
    "Empresa", "Credito", "Cedula_Cliente", "Nombre_Cliente", "Celular", "Fecha_Cuota_Vigente",
    "Valor_Cuota_Vigente", "Nombre_Ciudad", "Regional_Cobro", "Zona", "Codeudor1", "Nombre_Codeudor1",
    "Telefono_Codeudor1", "Codeudor2", "Nombre_Codeudor2", "Franja_Cartera", "Telefono_Codeudor2",
    "Dias_Atraso_Final", "Total_Recaudo", "Meta_Intereses", "Meta_Saldo", "Valor_Vencido", "Rodamiento",
    "Rodamiento_Cartera", "Estado_Pago", "Estado_Gestion", "Cantidad_Novedades", "Meta_$",
    "CALL_CENTER_FILTRO", "Tipo_Vigencia_Temp", "Estado_Vigencia",
]
CONTACT_TABLE_COLUMNS = [
    "Empresa", "Credito", "Nombre_Cliente", "Cedula_Cliente", "Celular", "Nombre_Ciudad", "Zona",
    "Dias_Atraso_Final", "Total_Recaudo", "Valor_Vencido", "Estado_Pago", "Estado_Gestion",
    "Cantidad_Novedades", "Regional_Cobro", "Cargo_Usuario", "Nombre_Usuario", "Novedades_Por_Cargo",
    "Codeudor1", "Nombre_Codeudor1", "Telefono_Codeudor1", "Codeudor2", "Nombre_Codeudor2",
    "Telefono_Codeudor2", "Fecha_Cuota_Vigente", "Valor_Cuota_Vigente", "Meta_$", "Novedad",
    "Tipo_Novedad", "CALL_CENTER_FILTRO", "Tipo_Vigencia_Temp", "Estado_Vigencia",
]
PORTFOLIO_MASTER_COLUMNS = PORTFOLIO_COLUMNS + [
    "Tipo_Vigencia_Temp", "CALL_CENTER_FILTRO", "Estado_Pago", "Estado_Gestion", "Estado_Vigencia"]
CONTACT_MASTER_COLUMNS = CONTACT_COLUMNS

# logical origin -> stored dataset folder
ORIGIN_FOLDERS = {
    "seguimientos_gestion": "seguimientos_gestion",
    "seguimientos_rodamientos": "seguimientos_rodamientos",
    "detallados_cartera": "detallados_cartera",
    "detallados_novedades": "detallados_novedades",
    "detallados_call_center": "detallados_call_center",
    "novedades": "seguimientos_gestion",
    "cartera": "seguimientos_rodamientos",
    "comercial_fnz": "comercial_fnz",
    "comercial_retanqueos": "comercial_retanqueos",
    "comercial_cosechas": "comercial_cosechas",
}
VINTAGE_SECTIONS = {
    "comercial_cosechas_s1": "SECCION_1_SIN_PAGO",
    "comercial_cosechas_s2": "SECCION_2_FALLO_2DA",
    "comercial_cosechas_s3": "SECCION_3_FALLO_3RA_PLUS",
}

# dimension presets
DIMS_PORTFOLIO = ["Empresa", "Regional_Cobro", "Zona", "Franja_Cartera", "CALL_CENTER_FILTRO",
                  "Call_Center_Apoyo", "Regional_Venta", "Estado_Vigencia", "Cantidad_Novedades"]
DIMS_RESULTS = ["Empresa", "CALL_CENTER_FILTRO", "Regional_Cobro", "Zona", "Estado_Vigencia",
                "Franja_Cartera", "Cantidad_Novedades"]
DIMS_FOLLOWUPS = ["Empresa", "Regional_Cobro", "Zona", "Franja_Cartera", "CALL_CENTER_FILTRO",
                  "Regional_Venta", "Estado_Vigencia"]

_DOUBLE_PORTFOLIO = {
    "Valor_Desembolso", "Valor_Cuota", "Valor_Cuota_Atraso", "Total_Recaudo", "Valor_Vencido",
    "Saldo_Capital", "Saldo_Interes_Corriente", "Saldo_Avales", "Meta_Intereses", "Meta_General",
    "Meta_Saldo", "Meta_$", "Meta_T.R_$", "Recaudo_Meta", "Recaudo_Anticipado",
    "Total_Recaudo_Sin_Anti", "Cantidad_Producto", "Cantidad_Obsequio", "Total_Cuotas",
    "Cuotas_Pagadas", "Dias_Atraso", "Dias_Atraso_Final", "Cantidad_Novedades",
}
PORTFOLIO_DATE_COLUMNS = ["Fecha_Desembolso", "Fecha_Ultima_Novedad", "Fecha_Facturada",
                          "Fecha_Cuota_Vigente", "Fecha_Cuota_Atraso", "Primera_Cuota_Mora",
                          "Fecha_Ultimo_Pago_Inicial", "Fecha_Ultimo_pago"]
PORTFOLIO_TEXT_COLUMNS = ["Empresa", "Regional_Venta", "Nombre_Ciudad", "Nombre_Vendedor",
                          "Franja_Meta", "Rodamiento", "Regional_Cobro", "Zona", "Cedula_Cliente",
                          "Zona_Cobro", "Zona_Venta"]
APPLICATION_SUMMARY_COLUMNS = ["Nombre_Vendedor", "Estado", "Regional_Venta", "Analista_Asociado"]
VINTAGE_GROUPS = ["SECCION_1_SIN_PAGO", "SECCION_2_FALLO_2DA", "SECCION_3_FALLO_3RA_PLUS"]

# filter values: facet name and the columns that may hold it, first one found
FACETS = [
    ("empresas", ["Empresa"]),
    ("zonas", ["Zona"]),
    ("regionales", ["Regional_Cobro", "Regional_Venta", "Regional"]),
    ("call_centers", ["CALL_CENTER_FILTRO", "CALL_CENTER", "Call_Center"]),
    ("franjas", ["Franja_Cartera", "Franja_Meta", "Franja"]),
]
FRONT_FACETS = [("empresas", "Empresa"), ("zonas", "Zona"), ("regionales", "Regional_Cobro"),
                ("call_centers", "CALL_CENTER_FILTRO"), ("franjas", "Franja_Meta"),
                ("estados_vigencia", "Estado_Vigencia")]

# search request field -> column it filters
SEARCH_FACETS = [("Empresa", "empresa"), ("Zona", "zona"), ("Regional_Cobro", "regional"), ("Regional", "regional"),
                 ("Regional_Venta", "regional"), ("Franja_Cartera", "franja"), ("Franja", "franja"),
                 ("CALL_CENTER_FILTRO", "call_center"), ("Call_Center", "call_center")]
SEARCH_STATES = [("Estado_Pago", "estado_pago"), ("Estado_Gestion", "estado_gestion"), ("Rodamiento", "rodamiento"),
                 ("Regional_Venta", "Regional_Venta"), ("Vendedor_Activo", "Vendedor_Activo"),
                 ("Nombre_Vendedor", "Nombre_Vendedor")]
LIVE_FACETS = [("Empresa", "empresa"), ("Zona", "zona"), ("Regional_Cobro", "regional"), ("Regional", "regional"),
               ("Franja_Cartera", "franja"), ("CALL_CENTER_FILTRO", "call_center"), ("Rodamiento", "rodamiento")]
# ---------------------------------------------------------------------------


def _struct(cols, doubles=(), dates=()) -> T.StructType:
    fields = []
    for c in cols:
        if c in doubles:
            t = T.DoubleType()
        elif c in dates:
            t = T.DateType()
        else:
            t = T.StringType()
        fields.append(T.StructField(c, t, True))
    return T.StructType(fields)


# Typed schemas after cleaning (landing files are read as text, then try_cast).
PORTFOLIO_SCHEMA = _struct(PORTFOLIO_COLUMNS, _DOUBLE_PORTFOLIO, PORTFOLIO_DATE_COLUMNS)
CONTACT_SCHEMA = _struct(CONTACT_COLUMNS, {"Valor"}, {"Fecha_Novedad", "Fecha_Compromiso"})
CALL_SCHEMA = _struct(CALL_COLUMNS, (), {"Fecha_Llamada"})
MESSAGE_SCHEMA = _struct(MESSAGE_COLUMNS, (), {"Fecha_Mensaje"})
APPLICATION_SCHEMA = _struct(list(APPLICATION_RENAMES), {"VALOR_TOTA"}, ())

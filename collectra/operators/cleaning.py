"""Cleaning transforms for the five landed tables (row-level, no shuffles)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collectra.functions.amounts import parse_amount, prepaid_flag
from collectra.functions.columns import q
from collectra.functions.dates import parse_mixed_dates
from collectra.functions.states import clean_center, payment_state, validity_state
from collectra.functions.text import compact_upper, strip_ws
from collectra.schemas import (APPLICATION_RENAMES, PORTFOLIO_DATE_COLUMNS, PORTFOLIO_TEXT_COLUMNS,
                               SUPPORT_CENTERS, ZONE_CENTERS)


def trim_text(df: DataFrame, cols) -> DataFrame:
    """Existing listed columns as text with surrounding whitespace removed."""
    out = {c: strip_ws(q(c)) for c in cols if c in df.columns}
    return df.withColumns(out) if out else df


def normalize_zones(df: DataFrame) -> DataFrame:
    """Zone and support-centre codes: defaults when missing, blanks removed, upper."""
    if "Zona" not in df.columns:
        df = df.withColumn("Zona", F.lit("SIN ZONA"))
    if "Call_Center_Apoyo" not in df.columns:
        df = df.withColumn("Call_Center_Apoyo", F.lit("SIN APOYO"))
    return df.withColumns({"Zona": compact_upper(q("Zona")),
                           "Call_Center_Apoyo": compact_upper(q("Call_Center_Apoyo"))})


def assign_call_center(df: DataFrame, zone_centers=ZONE_CENTERS, support_centers=SUPPORT_CENTERS) -> DataFrame:
    """``CALL_CENTER_FILTRO`` cascade: own zone centre, else support centre,
    else ``SIN CALL CENTER``."""
    return df.withColumn(
        "CALL_CENTER_FILTRO",
        F.when(q("Zona").isin(*zone_centers), q("Zona"))
        .when(q("Call_Center_Apoyo").isin(*support_centers), q("Call_Center_Apoyo"))
        .otherwise(F.lit("SIN CALL CENTER")))


def default_region(df: DataFrame) -> DataFrame:
    if "Regional_Cobro" not in df.columns:
        return df
    return df.withColumn("Regional_Cobro", F.coalesce(q("Regional_Cobro"), F.lit("OTRAS ZONAS")))


def clean_portfolio(df: DataFrame, parity: bool = False) -> DataFrame:
    """Landed portfolio -> typed, cleaned portfolio (prepaid flag, amounts,
    dates, trimmed text, contact count default, zones and centre)."""
    if "Valor_Cuota_Vigente" in df.columns:
        raw = q("Valor_Cuota_Vigente")
        df = df.withColumns({"Tipo_Vigencia_Temp": prepaid_flag(raw),
                             "Valor_Cuota_Vigente": parse_amount(raw, parity=parity)})
    else:
        df = df.withColumn("Tipo_Vigencia_Temp", F.lit("NORMAL"))
    df = parse_mixed_dates(df, PORTFOLIO_DATE_COLUMNS)
    df = trim_text(df, PORTFOLIO_TEXT_COLUMNS)
    if "Cantidad_Novedades" in df.columns:
        df = df.withColumn("Cantidad_Novedades", F.coalesce(q("Cantidad_Novedades"), F.lit(0.0)))
    df = normalize_zones(df)
    df = assign_call_center(df)
    return default_region(df)


def enrich_portfolio(df: DataFrame) -> DataFrame:
    """Add ``Estado_Vigencia`` and ``Estado_Pago`` (portfolio variant)."""
    return payment_state(validity_state(df), mode="portfolio")


def clean_contacts(df: DataFrame) -> DataFrame:
    if "Celular_Cliente" in df.columns:
        cel = q("Celular_Cliente").cast("string")
        df = df.withColumn("Celular_Cliente", F.when(cel.endswith("."), F.left(cel, F.length(cel) - 1)).otherwise(cel))
    df = parse_mixed_dates(df, ["Fecha_Novedad", "Fecha_Compromiso"])
    return trim_text(df, ["Cedula_Cliente", "Empresa", "Nombre_Usuario"])


def clean_calls(df: DataFrame) -> DataFrame:
    """Parse the call date and add the cleaned centre label used downstream."""
    df = parse_mixed_dates(df, ["Fecha_Llamada"])
    cc = q("Call_Center") if "Call_Center" in df.columns else None
    return df.withColumn("Call_Center_Limpio", clean_center(cc))


def clean_messages(df: DataFrame) -> DataFrame:
    # The source parses a column that messages do not have; we parse the message date.
    return parse_mixed_dates(df, ["Fecha_Mensaje"])


def clean_applications(df: DataFrame) -> DataFrame:
    df = df.withColumnsRenamed({k: v for k, v in APPLICATION_RENAMES.items() if k in df.columns})
    return parse_mixed_dates(df, ["Fecha_Nacimiento"])

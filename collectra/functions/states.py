"""Derived state columns (validity, payment, contact, promise, calls)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collectra.functions.columns import q
from collectra.functions.dates import dmy_date
from collectra.functions.text import strip_ws, upper_strip
from collectra.schemas import (COLLECTION_ZONE_MAP, CON_GESTION, PAYMENT_THRESHOLD, SIN_GESTION)


def validity_state(df: DataFrame, name: str = "Estado_Vigencia") -> DataFrame:
    """prepaid -> anticipado; due date present -> vigente; else vencido.
    Neither source column -> NULL; flag absent -> treated as dated."""
    if "Tipo_Vigencia_Temp" not in df.columns and "Fecha_Cuota_Vigente" not in df.columns:
        return df.withColumn(name, F.lit(None).cast("string"))
    flag = q("Tipo_Vigencia_Temp") if "Tipo_Vigencia_Temp" in df.columns else F.lit("FECHA")
    due = q("Fecha_Cuota_Vigente") if "Fecha_Cuota_Vigente" in df.columns else F.lit(None)
    return df.withColumn(
        name,
        F.when(flag == "ANTICIPADO", F.lit("anticipado"))
        .when(due.isNotNull(), F.lit("vigente"))
        .otherwise(F.lit("vencido")))


def validity_substate(state: Column, due: Column) -> Column:
    """For ``vigente``: due day 1-10 / 11-20 / 21+; otherwise NULL."""
    d = F.dayofmonth(due)
    return (F.when(state == "vigente",
                   F.when(d <= 10, F.lit("Días 1-10")).when(d <= 20, F.lit("Días 11-20"))
                   .otherwise(F.lit("Días 21+")))
            .otherwise(F.lit(None).cast("string")))


def payment_state(df: DataFrame, mode: str = "portfolio", threshold: float = PAYMENT_THRESHOLD,
                  name: str = "Estado_Pago") -> DataFrame:
    """``Estado_Pago`` in the four variants used across modules.

    portfolio: prepaid -> ANTICIPADO, collected > threshold -> PAGO, else SIN PAGO
               (either source column missing -> SIN PAGO)
    followups: as portfolio, prepaid flag defaults to NORMAL when absent
    callcenter: no prepaid branch; collected missing -> SIN DATO
    funnel:    collected > 0 (used when no state column exists)
    """
    has_flag = "Tipo_Vigencia_Temp" in df.columns
    has_total = "Total_Recaudo" in df.columns
    total = q("Total_Recaudo")
    if mode == "portfolio":
        if not (has_flag and has_total):
            return df.withColumn(name, F.lit("SIN PAGO"))
        expr = (F.when(q("Tipo_Vigencia_Temp") == "ANTICIPADO", F.lit("ANTICIPADO"))
                .when(total > threshold, F.lit("PAGO")).otherwise(F.lit("SIN PAGO")))
    elif mode == "followups":
        flag = q("Tipo_Vigencia_Temp") if has_flag else F.lit("NORMAL")
        expr = (F.when(flag == "ANTICIPADO", F.lit("ANTICIPADO"))
                .when(total > threshold, F.lit("PAGO")).otherwise(F.lit("SIN PAGO")))
    elif mode == "callcenter":
        if not has_total:
            return df.withColumn(name, F.lit("SIN DATO"))
        expr = F.when(total > threshold, F.lit("PAGO")).otherwise(F.lit("SIN PAGO"))
    elif mode == "funnel":
        expr = F.when(total > 0, F.lit("PAGO")).otherwise(F.lit("SIN PAGO"))
    else:
        raise ValueError(f"unknown payment_state mode {mode!r}")
    return df.withColumn(name, expr)


def contact_state(df: DataFrame, name: str = "Estado_Gestion") -> DataFrame:
    if "Cantidad_Novedades" not in df.columns:
        return df.withColumn(name, F.lit("SIN DATO"))
    return df.withColumn(name, F.when(q("Cantidad_Novedades") > 0, F.lit(CON_GESTION))
                         .otherwise(F.lit(SIN_GESTION)))


def collection_zone(code: Column, region: Column) -> Column:
    """Mapped collection-zone label, falling back to the collection region."""
    m = F.create_map(*[F.lit(x) for kv in COLLECTION_ZONE_MAP.items() for x in kv])
    return F.coalesce(F.try_element_at(m, code), region)


def promise_state(c: Column, as_of, is_date: bool = True) -> Column:
    """Promise due before ``as_of`` -> VENCIDOS, on/after -> VIGENTES, no or
    unreadable date -> SIN FECHA.  Text input is read as ``d-m-y``."""
    as_of = F.lit(as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)))
    d = c if is_date else dmy_date(c)
    return (F.when(d.isNull(), F.lit("ACUERDOS SIN FECHA"))
            .when(d < as_of, F.lit("ACUERDOS VENCIDOS"))
            .otherwise(F.lit("ACUERDOS VIGENTES")))


def call_state(c: Column) -> Column:
    """``ANSWERED`` (any case / blanks) -> CON RESPUESTA, all else SIN RESPUESTA."""
    return F.when(upper_strip(c) == "ANSWERED", F.lit("CON RESPUESTA")).otherwise(F.lit("SIN RESPUESTA"))


def clean_center(c: Column | None) -> Column:
    """Call-centre label: strip, upper, NULL/absent -> SIN DATO."""
    if c is None:
        return F.lit("SIN DATO")
    return F.coalesce(upper_strip(c), F.lit("SIN DATO"))


def conversation_flag(c: Column | None) -> Column:
    if c is None:
        return F.lit(False)
    return F.coalesce(F.lower(strip_ws(c)).isin("text", "audio"), F.lit(False))


def days_late_bucket(days: Column) -> Column:
    """Days late -> portfolio bucket label."""
    return (F.when(days <= 0, F.lit("AL DIA")).when(days <= 30, F.lit("1 A 30"))
            .when(days <= 90, F.lit("31 A 90")).when(days <= 180, F.lit("91 A 180"))
            .when(days <= 360, F.lit("181 A 360")).otherwise(F.lit("MAS DE 360")))

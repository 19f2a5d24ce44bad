"""Commercial module: refinance candidates, early-risk vintages, applications."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collectra.functions.columns import existing, q
from collectra.schemas import APPLICATION_SUMMARY_COLUMNS, VINTAGE_GROUPS as SECTIONS


def refinance_candidates(df: DataFrame) -> DataFrame:
    """Up to date (<= 30 days late), 6+ instalments and 1-2 left (6-8 total)
    or 1-4 left (more than 8 total)."""
    total, paid = q("Total_Cuotas"), q("Cuotas_Pagadas")
    pot = (df.where((q("Dias_Atraso_Final") <= 30) & (total >= 6))
           .withColumn("Cuotas_Restantes", total - paid))
    rest = q("Cuotas_Restantes")
    return pot.where((total.between(6, 8) & rest.between(1, 2)) | ((total > 8) & rest.between(1, 4)))


def vintage_early_risk(df: DataFrame, as_of, window_days: int = 180) -> DataFrame:
    """Loans disbursed in the last ``window_days`` that are late, by instalments paid."""
    as_of = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    cut = as_of - _dt.timedelta(days=window_days)
    paid = q("Cuotas_Pagadas")
    sec = (F.when(paid == 0, F.lit(SECTIONS[0])).when(paid == 1, F.lit(SECTIONS[1]))
           .when(paid.between(2, 5), F.lit(SECTIONS[2])).otherwise(F.lit("OK")))
    return (df.where((q("Fecha_Desembolso") >= F.lit(cut)) & (q("Dias_Atraso_Final") > 0))
            .withColumn("Grupo_Seguimiento", sec)
            .where(q("Grupo_Seguimiento") != "OK"))


def vintage_sections(vintages: DataFrame) -> DataFrame:
    """One row: loans per section (s1, s2, s3) and their total."""
    g = q("Grupo_Seguimiento")
    return vintages.agg(F.count_if(g == SECTIONS[0]).alias("s1"),
                        F.count_if(g == SECTIONS[1]).alias("s2"),
                        F.count_if(g == SECTIONS[2]).alias("s3"),
                        F.count(F.lit(1)).alias("total_cosechas"))


def refinance_total(candidates: DataFrame) -> DataFrame:
    return candidates.agg(F.count(F.lit(1)).alias("total_retanqueos"))


def application_summary(apps: DataFrame) -> DataFrame:
    return apps.select(*[q(c) for c in existing(apps, APPLICATION_SUMMARY_COLUMNS)])


def application_matrix(apps: DataFrame) -> DataFrame:
    """Seller x application-state counts in long form: every state that occurs
    is a row, whatever its name (the states are not listed beforehand)."""
    return apps.groupBy("Nombre_Vendedor", "Estado").agg(F.count(F.lit(1)).alias("count"))

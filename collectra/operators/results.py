"""Goal-attainment tables for the late-bucket portfolio."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collectra.functions.agg import guarded_ratio, money_sum
from collectra.functions.columns import ensure_columns, guard_numeric, q
from collectra.functions.states import validity_state
from collectra.schemas import DIMS_RESULTS, LATE_BUCKETS, ZONE_CENTERS

RESULT_MEASURES = ["Meta_$", "Recaudo_Meta", "Total_Recaudo_Sin_Anti", "Meta_T.R_$"]


def results_scope(df: DataFrame, buckets=LATE_BUCKETS, excluded_zones=ZONE_CENTERS) -> DataFrame:
    """Late buckets only, zones outside the own-centre list (NULL zone dropped)."""
    return df.where(q("Franja_Meta").isin(*buckets) & ~q("Zona").isin(*excluded_zones))


def default_dims(df: DataFrame) -> DataFrame:
    """Fill the dimension columns the result tables group by."""
    cc = q("Call_Center_Apoyo") if "Call_Center_Apoyo" in df.columns else F.lit("SIN CALL CENTER")
    df = ensure_columns(df, {"Empresa": "SIN EMPRESA", "CALL_CENTER_FILTRO": cc,
                             "Regional_Cobro": "OTRAS ZONAS", "Franja_Cartera": "SIN FRANJA"})
    return df if "Estado_Vigencia" in df.columns else validity_state(df)


def _prepared(df: DataFrame) -> DataFrame:
    return default_dims(guard_numeric(results_scope(df), RESULT_MEASURES))


def results_by_zone(df: DataFrame, dims=DIMS_RESULTS) -> DataFrame:
    g = (_prepared(df).groupBy(*[q(k) for k in list(dims) + ["Franja_Meta"]])
         .agg(F.count(q("Zona")).alias("Total_Cuentas"),
              money_sum(q("Meta_$")).alias("Meta_Total"),
              money_sum(q("Recaudo_Meta")).alias("Recaudo_Total"),
              money_sum(q("Total_Recaudo_Sin_Anti")).alias("Recaudo_Sin_Anti_Total"),
              money_sum(q("Meta_T.R_$")).alias("Recaudo_Meta_Total")))
    return g.withColumn("Cumplimiento_%", guarded_ratio(q("Recaudo_Total"), q("Meta_Total")))


def results_by_collector(df: DataFrame, dims=DIMS_RESULTS) -> DataFrame:
    p = _prepared(df)
    if "Cobrador" not in p.columns:
        return p.limit(0).select(*[q(k) for k in dims])
    g = (p.where(q("Cobrador").isNotNull() & (q("Cobrador") != ""))
         .groupBy(*[q(k) for k in list(dims) + ["Cobrador"]])
         .agg(F.count(q("Cobrador")).alias("Total_Cuentas"),
              money_sum(q("Meta_T.R_$")).alias("Meta_Total"),
              money_sum(q("Total_Recaudo_Sin_Anti")).alias("Recaudo_Total")))
    return g.withColumn("Cumplimiento_%", guarded_ratio(q("Recaudo_Total"), q("Meta_Total")))

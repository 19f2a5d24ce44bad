"""Contact-log KPIs after attribution to centres."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collectra.functions.columns import q
from collectra.functions.states import promise_state

UNASSIGNED = "SIN ASIGNAR"


def center_filter(att: DataFrame, center: str | None) -> DataFrame:
    return att if not center else att.where(q("Call_Center") == center)


def _valid(att: DataFrame) -> DataFrame:
    return att.where(q("Call_Center") != UNASSIGNED)


def contacts_by_center(att: DataFrame) -> DataFrame:
    return (_valid(att).groupBy("Call_Center").agg(F.count(F.lit(1)).alias("Cantidad"))
            .orderBy(F.col("Cantidad").desc(), F.col("Call_Center")))


def contacts_by_center_type(att: DataFrame, type_col: str = "Tipo_Novedad") -> DataFrame:
    return _valid(att).groupBy("Call_Center", type_col).agg(F.count(F.lit(1)).alias("Cantidad"))


def promises_by_state(att: DataFrame, as_of, date_col: str = "Fecha_Compromiso",
                      type_col: str = "Tipo_Novedad") -> DataFrame:
    """Promises (type mentions COMPROMISO) per centre and due state."""
    is_date = dict(att.dtypes).get(date_col) == "date"
    comp = att.where(F.upper(q(type_col).cast("string")).contains("COMPROMISO") & (q("Call_Center") != UNASSIGNED))
    return (comp.withColumn("Estado_Acuerdo", promise_state(q(date_col), as_of, is_date=is_date))
            .groupBy("Call_Center", "Estado_Acuerdo").agg(F.count(F.lit(1)).alias("Cantidad")))


def contact_kpis(att: DataFrame, type_col: str = "Tipo_Novedad") -> DataFrame:
    """One row: total contacts, unassigned contacts, most frequent type
    (ties -> smallest name; ``N/A`` when empty).  One grouped pass per type,
    then a tiny global merge: no join of one-row frames."""
    per_type = att.groupBy(q(type_col).alias("tipo")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(q("Call_Center") == UNASSIGNED).alias("sa"))
    return per_type.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"),
        F.coalesce(F.sum("sa"), F.lit(0)).cast("long").alias("sin_asignar"),
        F.coalesce(F.min_by("tipo", F.struct((-F.col("n")).alias("n"), "tipo")), F.lit("N/A")).alias("top_tipo"))

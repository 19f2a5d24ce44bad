"""Call KPIs over the cleaned call log (``Call_Center_Limpio`` present)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collectra.functions.columns import q
from collectra.functions.text import upper_strip
from collectra.schemas import CALL_THRESHOLD_PER_CENTER


def call_scope(calls: DataFrame) -> DataFrame:
    """Calls with a known centre; call state upper-cased and stripped."""
    df = calls.where(q("Call_Center_Limpio") != "SIN DATO")
    if "Estado_Llamada" in df.columns:
        df = df.withColumn("Estado_Llamada", upper_strip(q("Estado_Llamada")))
    else:
        df = df.withColumn("Estado_Llamada", F.lit(None).cast("string"))
    return df


def _answered():
    return F.coalesce(q("Estado_Llamada") == "ANSWERED", F.lit(False))


def call_totals(scoped: DataFrame) -> DataFrame:
    return scoped.agg(F.count(F.lit(1)).alias("total_llamadas"), F.count_if(_answered()).alias("con_respuesta")) \
        .withColumn("sin_respuesta", F.col("total_llamadas") - F.col("con_respuesta"))


def call_totals_long(scoped: DataFrame) -> DataFrame:
    """Two-row chart form (Tipo, Cantidad)."""
    return call_totals(scoped).select(F.expr(
        "stack(2, 'CON RESPUESTA', con_respuesta, 'SIN RESPUESTA', sin_respuesta) AS (Tipo, Cantidad)"))


def call_effectiveness(scoped: DataFrame) -> DataFrame:
    return (scoped.groupBy(q("Call_Center_Limpio").alias("Call_Center"))
            .agg(F.count(F.lit(1)).alias("Total_Intentos"), F.count_if(_answered()).alias("Con_Respuesta"))
            .withColumn("Efectividad", F.col("Con_Respuesta") / F.col("Total_Intentos"))
            .orderBy(F.col("Efectividad").desc(), F.col("Call_Center")))


def call_threshold(scoped: DataFrame, per_center: int = CALL_THRESHOLD_PER_CENTER) -> DataFrame:
    return scoped.agg((F.countDistinct("Call_Center_Limpio") * per_center).alias("alerta_umbral"))


def call_day(scoped: DataFrame):
    """The date of a call (a column), typed or landed as text."""
    col = next((c for c in scoped.columns if c.strip() == "Fecha_Llamada"), None)
    d = q(col)
    return d if dict(scoped.dtypes)[col] == "date" else F.coalesce(d.try_cast("date"), F.try_to_date(d.cast("string"), "yyyy-MM-dd"))


def calls_by_day(scoped: DataFrame) -> DataFrame:
    return (scoped.withColumn("Fecha", call_day(scoped)).where(F.col("Fecha").isNotNull())
            .withColumn("Estado_Respuesta", F.when(_answered(), F.lit("CON RESPUESTA")).otherwise(F.lit("SIN RESPUESTA")))
            .groupBy("Fecha", "Estado_Respuesta").agg(F.count(F.lit(1)).alias("Total_Llamadas"))
            .withColumn("Fecha", F.date_format("Fecha", "yyyy-MM-dd")))

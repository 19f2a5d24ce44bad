"""Portfolio dashboard cubes and filter facets.

All cubes are plain multi-key group-bys: Spark aggregates partially on the
map side, so a hot dimension value costs one row per map task in the shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collectra.functions.agg import money_sum
from collectra.functions.columns import existing, q
from collectra.functions.states import collection_zone, validity_state, validity_substate
from collectra.schemas import FACETS, DIMS_PORTFOLIO, VALIDITY_STATES


def _dims(df: DataFrame, dims) -> list[str]:
    return existing(df, dims)


def _with_state(df: DataFrame) -> DataFrame:
    return df if "Estado_Vigencia" in df.columns else validity_state(df)


def cube_regional(df: DataFrame, dims=DIMS_PORTFOLIO) -> DataFrame:
    df = _with_state(df)
    keys = _dims(df, dims) + ["Franja_Meta"]
    return df.groupBy(*[q(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("count"), money_sum(q("Total_Recaudo")).alias("Total_Recaudo"))


def cube_collection(df: DataFrame, dims=DIMS_PORTFOLIO) -> DataFrame:
    """Loans per mapped collection zone (falls back to the collection region).
    A portfolio without ``Zona_Cobro`` gives no rows."""
    if "Zona_Cobro" not in df.columns:
        df = df.withColumn("Zona_Cobro", F.lit(None).cast("string")).where(F.lit(False))
    df = _with_state(df)
    keys = _dims(df, dims)
    return (df.withColumn("Eje_X_Cobro", collection_zone(q("Zona_Cobro"), q("Regional_Cobro")))
            .where(q("Eje_X_Cobro").isNotNull())
            .groupBy(*[q(k) for k in keys + ["Eje_X_Cobro", "Franja_Meta"]])
            .agg(F.count(F.lit(1)).alias("count")))


def cube_disbursement(df: DataFrame, as_of, dims=DIMS_PORTFOLIO, min_year: int = 2018) -> DataFrame:
    """Disbursed amount per year in [min_year, year(as_of)], rounded to units.
    A portfolio without ``Fecha_Desembolso`` gives no rows."""
    if "Fecha_Desembolso" not in df.columns:
        df = df.withColumn("Fecha_Desembolso", F.lit(None).cast("date"))
    df = _with_state(df)
    as_of = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    keys = _dims(df, dims)
    yr = F.year(q("Fecha_Desembolso"))
    return (df.where(q("Fecha_Desembolso").isNotNull() & yr.between(min_year, as_of.year))
            .withColumn("Año_Desembolso", yr.cast("long"))
            .groupBy(*[q(k) for k in keys + ["Año_Desembolso", "Franja_Meta"]])
            .agg(F.round(F.coalesce(F.sum(q("Valor_Desembolso").cast("decimal(24,3)")), F.lit(0)), 0)
                 .cast("long").alias("Valor_Desembolso")))


def cube_validity(df: DataFrame, dims=DIMS_PORTFOLIO) -> DataFrame:
    """Loans per validity state and due-day sub-state."""
    df = _with_state(df)
    keys = _dims(df, dims)
    g = validity_state(df, "Estado_Vigencia_Agrupado")
    g = g.withColumn("Sub_Estado_Vigencia",
                     validity_substate(q("Estado_Vigencia_Agrupado"), q("Fecha_Cuota_Vigente")))
    return (g.groupBy(*[q(k) for k in keys + ["Estado_Vigencia_Agrupado", "Sub_Estado_Vigencia"]])
            .agg(F.count(F.lit(1)).alias("count")))


def facet_values(df: DataFrame, facets=FACETS, keep_nulls: bool = False,
                 fixed_states=VALIDITY_STATES) -> DataFrame:
    """Distinct filter values per facet in long form ``(facet, value)``, sorted.

    One scan: the distinct combinations come first (map-side combined), so the
    explode to one row per facet works on combinations, not on loans.  The first
    existing candidate column feeds each facet.  ``keep_nulls`` keeps NULL
    values (call-centre variant).  The fixed validity-state list is appended.
    """
    pairs, used = [], []
    for name, cands in facets:
        found = existing(df, cands)
        if found:
            used.append(found[0])
            pairs.append(F.struct(F.lit(name).alias("facet"), q(found[0]).cast("string").alias("value")))
    spark = df.sparkSession
    fixed = _fixed_facet_rows(spark, fixed_states)
    if not pairs:
        return fixed
    long = df.select(*[q(c) for c in dict.fromkeys(used)]).distinct().select(F.explode(F.array(*pairs)).alias("p")).select("p.facet", "p.value")
    if not keep_nulls:
        long = long.where(F.col("value").isNotNull())
    return long.distinct().unionByName(fixed).orderBy("facet", "value")


def _fixed_facet_rows(spark: SparkSession, states) -> DataFrame:
    return spark.createDataFrame([("estados_vigencia", s) for s in states], "facet string, value string")

"""Management base: one row per loan attributed to a centre, plus detail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collectra.functions.agg import guarded_ratio, money_sum
from collectra.functions.columns import q
from collectra.functions.states import contact_state, payment_state
from collectra.schemas import FRONT_FACETS, ALL_CENTERS, CON_GESTION, SIN_GESTION


def callcenter_enrich(portfolio: DataFrame) -> DataFrame:
    """Call-centre variants of payment and contact state (overwrite)."""
    return contact_state(payment_state(portfolio, mode="callcenter"))


def _numeric(df: DataFrame) -> DataFrame:
    out = {c: F.coalesce(q(c).try_cast("double"), F.lit(0.0))
           for c in ["Meta_General", "Meta_$", "Recaudo_Meta"] if c in df.columns}
    return df.withColumns(out) if out else df


def attributed_flags(df: DataFrame, centers=ALL_CENTERS) -> DataFrame:
    """Every loan with its branch (``_branch``: Z, A or null), and the centre, agent and goal it gives.

    Branch Z: own zone is a centre and the loan is up to date -> the zone,
    its collector and the general goal.  Branch A: otherwise, a support
    centre -> that centre, its agent and the money goal.  A NULL zone
    predicate falls in neither branch, as in the source system.
    """
    df = _numeric(df)
    zone = q("Zona").isin(*centers) & (q("Franja_Meta") == "AL DIA")
    support = q("Call_Center_Apoyo").isin(*centers)
    df = df.withColumn("_branch", F.when(zone, F.lit("Z")).when(support & ~zone, F.lit("A")))
    is_z = F.col("_branch") == "Z"
    return df.withColumns({
        "_center": F.when(is_z, q("Zona")).otherwise(q("Call_Center_Apoyo")),
        "_agent": F.when(is_z, q("Cobrador")).otherwise(q("Nombre_Call_Center")),
        "_goal": F.when(is_z, q("Meta_General")).otherwise(q("Meta_$")),
    })


def attribute_centers(df: DataFrame, centers=ALL_CENTERS) -> DataFrame:
    """Loans of either branch: a single pass over the portfolio instead of two
    filtered scans + union."""
    df = attributed_flags(df, centers).where(F.col("_branch").isNotNull())
    return df.withColumn("CALL_CENTER_FILTRO", F.col("_center")).drop("_center")


def unified_base(attributed: DataFrame) -> DataFrame:
    return attributed.select(
        q("CALL_CENTER_FILTRO").alias("CALL_CENTER_ID"), F.col("_agent").alias("NOMBRE_AGENTE"),
        F.col("_goal").alias("META_UNIFICADA"), q("Recaudo_Meta"), q("Rodamiento"), q("Cedula_Cliente"))


def contact_order(columns, order_col: str = "seq") -> list[str]:
    """Columns that tell which of a client's contacts is the last: key, date, type, note, as far as there."""
    return [c for c in [order_col, "Fecha_Novedad", "Tipo_Novedad", "Novedad"] if c in columns]


def last_contacts(contacts: DataFrame, order_col: str = "seq") -> DataFrame:
    """(Cedula_Cliente, last): the largest (key, date, type, note) per client, also of a stream."""
    order = contact_order(contacts.columns, order_col)
    return (contacts.where(q("Cedula_Cliente").isNotNull()).groupBy("Cedula_Cliente")
            .agg(F.max(F.struct(*[q(c).alias(c) for c in order])).alias("last")))


def latest_contact(contacts: DataFrame, order_col: str = "seq") -> DataFrame:
    """Last contact per client by an explicit order key (row order on landing).

    One hash aggregate, so a client holding a large share of the log sends one
    row per task, and rows that repeat a key are told apart by their values,
    never by their partition.  A log without the key goes by date, then by the
    largest values.
    """
    return of_last(last_contacts(contacts, order_col))


def of_last(last: DataFrame) -> DataFrame:
    fields = last.schema["last"].dataType.names
    return last.select("Cedula_Cliente", *[F.col(f"last.{c}").alias(c) for c in ["Tipo_Novedad", "Novedad"] if c in fields])


def with_latest(detail: DataFrame, latest: DataFrame) -> DataFrame:
    out = detail.join(latest, "Cedula_Cliente", "left")
    return out.withColumns({"Tipo_Novedad": F.coalesce(q("Tipo_Novedad"), F.lit("SIN NOVEDAD")),
                            "Novedad": F.coalesce(q("Novedad"), F.lit(""))})


def join_latest_contact(detail: DataFrame, contacts: DataFrame, order_col: str = "seq") -> DataFrame:
    return with_latest(detail, latest_contact(contacts, order_col))


def management_detail(portfolio: DataFrame, contacts: DataFrame) -> DataFrame:
    att = attribute_centers(callcenter_enrich(portfolio)).drop("_branch", "_agent", "_goal")
    return join_latest_contact(att, contacts)


def management_base(portfolio: DataFrame) -> DataFrame:
    return unified_base(attribute_centers(callcenter_enrich(portfolio)))


def goal_attainment(unified: DataFrame) -> DataFrame:
    g = (unified.groupBy("CALL_CENTER_ID", "NOMBRE_AGENTE")
         .agg(money_sum(q("META_UNIFICADA")).alias("META_$"), money_sum(q("Recaudo_Meta")).alias("Recaudo_Meta")))
    return g.select(
        F.col("CALL_CENTER_ID").alias("CALL_CENTER"), F.col("NOMBRE_AGENTE").alias("NOMBRE"),
        q("META_$"), q("Recaudo_Meta"),
        (q("META_$").cast("decimal(24,3)") - q("Recaudo_Meta").cast("decimal(24,3)")).cast("double").alias("Faltante"),
        guarded_ratio(q("Recaudo_Meta"), q("META_$")).alias("Cumplimiento"))


def roll_rate_cc(unified: DataFrame) -> DataFrame:
    return unified.groupBy("Rodamiento").agg(F.count(F.lit(1)).alias("count"))


def cc_meta(unified: DataFrame) -> DataFrame:
    return unified.agg(F.count(F.lit(1)).alias("total_cuentas"),
                       money_sum(q("META_UNIFICADA")).alias("total_meta"))


def facet_values_cc(detail: DataFrame) -> DataFrame:
    """Distinct values per facet of the call-centre detail, NULLs kept, plus
    the fixed contact-state list."""
    pairs = [F.struct(F.lit(name).alias("facet"), q(c).cast("string").alias("value"))
             for name, c in FRONT_FACETS if c in detail.columns]
    fixed = detail.sparkSession.createDataFrame(
        [("estados_gestion", CON_GESTION), ("estados_gestion", SIN_GESTION)], "facet string, value string")
    return (detail.select(F.explode(F.array(*pairs)).alias("p")).select("p.facet", "p.value").distinct()
            .unionByName(fixed))

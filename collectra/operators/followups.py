"""Follow-up module: payment/contact donuts, roll rates, role joins, detail.

Joins here are equi-joins on the client id.  The client->role side is made
distinct first (at most one row per client and role), so the fan-out is
bounded by the number of roles; joins whose right side can hold a hot client
are inner joins (AQE can split either side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collectra.functions.columns import ensure_columns, existing, q
from collectra.functions.states import contact_state, payment_state, validity_state
from collectra.operators.joins import left_join_skew_safe
from collectra.schemas import CON_GESTION, DIMS_FOLLOWUPS

UNASSIGNED = "SIN ASIGNAR"


def followup_base(portfolio: DataFrame) -> DataFrame:
    """Portfolio with follow-up payment state, contact state and validity."""
    df = contact_state(payment_state(portfolio, mode="followups"))
    return df if "Estado_Vigencia" in df.columns else validity_state(df)


def _dims(df: DataFrame, dims) -> list:
    return [q(c) for c in existing(df, dims)]


def donut_payment(base: DataFrame, dims=DIMS_FOLLOWUPS) -> DataFrame:
    return (base.groupBy(*_dims(base, dims), q("Estado_Pago"), q("Estado_Gestion"))
            .agg(F.count(F.lit(1)).alias("count")))


def roll_rate(base: DataFrame, dims=DIMS_FOLLOWUPS) -> DataFrame:
    """Loans per roll-rate label; ordered by the label."""
    return (base.where(q("Rodamiento").isNotNull() & (q("Rodamiento") != ""))
            .groupBy(*_dims(base, dims), q("Rodamiento"), q("Estado_Gestion"))
            .agg(F.count(F.lit(1)).alias("Número de Cuentas"))
            .orderBy("Rodamiento", *_dims(base, dims), "Estado_Gestion"))


def client_roles(contacts: DataFrame) -> DataFrame:
    """Distinct (client, role) pairs of the contact log."""
    return contacts.select("Cedula_Cliente", "Cargo_Usuario").distinct()


def join_client_roles(base: DataFrame, contacts: DataFrame) -> DataFrame:
    """Each loan once per role that contacted its client; none -> SIN ASIGNAR."""
    if "Cargo_Usuario" not in contacts.columns:
        return base.withColumn("Cargo_Usuario", F.lit(UNASSIGNED))
    return (base.join(client_roles(contacts), "Cedula_Cliente", "left")
            .withColumn("Cargo_Usuario", F.coalesce(q("Cargo_Usuario"), F.lit(UNASSIGNED))))


def valid_assignment(merged: DataFrame) -> DataFrame:
    """Drop loans marked as contacted but without a contacting role."""
    return merged.where(~((q("Estado_Gestion") == CON_GESTION) & (q("Cargo_Usuario") == UNASSIGNED)))


def sunburst(merged: DataFrame, payment: str | None = None, dims=DIMS_FOLLOWUPS, sort: bool = False) -> DataFrame:
    """Loans per contact state and role (valid assignments only); the main
    chart (no payment filter) is ordered by count, largest first."""
    df = merged if payment is None else merged.where(q("Estado_Pago") == payment)
    out = (valid_assignment(df)
           .groupBy(*_dims(df, dims), q("Estado_Gestion"), q("Cargo_Usuario"))
           .agg(F.count(F.lit(1)).alias("Cantidad")))
    return out.orderBy(F.col("Cantidad").desc(), *_dims(df, dims), "Estado_Gestion", "Cargo_Usuario") if sort else out


def _with_role(contacts: DataFrame) -> DataFrame:
    """A contact log without a role column gets a typed NULL one (the source
    system fails in the per-role count and loses two modules)."""
    return ensure_columns(contacts, {"Cargo_Usuario": F.lit(None).cast("string")})


def contacts_per_role(contacts: DataFrame) -> DataFrame:
    contacts = _with_role(contacts)
    return (contacts.groupBy("Cedula_Cliente", "Cargo_Usuario")
            .agg(F.count(F.lit(1)).alias("Novedades_Por_Cargo")))


def join_contacts_per_role(merged: DataFrame, contacts: DataFrame) -> DataFrame:
    """Contact count of the loan's (client, role); none -> 0."""
    return (merged.join(contacts_per_role(contacts), ["Cedula_Cliente", "Cargo_Usuario"], "left")
            .withColumn("Novedades_Por_Cargo", F.coalesce(q("Novedades_Por_Cargo"), F.lit(0).cast("long"))))


def join_contact_detail(merged: DataFrame, contacts: DataFrame) -> DataFrame:
    """Every contact of the loan's (client, role) as its own row (fan-out).

    Contact columns that collide with loan columns get the suffix ``_right``;
    NULL ``Novedad``/``Tipo_Novedad``/``Nombre_Usuario`` become ''.

    ``Novedades_Por_Cargo`` of :func:`join_contacts_per_role` is 0 exactly for the
    rows without a partner, so those pass by the join: no anti join is needed.
    """
    keys = ["Cedula_Cliente", "Cargo_Usuario"]
    contacts = _with_role(contacts)
    extra = [c for c in contacts.columns if c not in keys + ["Empresa"]]
    right = contacts.select(*keys, *[q(c).alias(c + "_right" if c in merged.columns else c) for c in extra])
    if "Novedades_Por_Cargo" in merged.columns:
        extra = [c for c in right.columns if c not in keys]
        met = merged.where(q("Novedades_Por_Cargo") > 0).join(right, keys, "inner")
        alone = merged.where(q("Novedades_Por_Cargo") == 0).withColumns(
            {c: F.lit(None).cast(right.schema[c].dataType) for c in extra})
        cols = [q(c) for c in [*merged.columns, *extra]]
        out = met.select(*cols).unionByName(alone.select(*cols))
    else:
        out = left_join_skew_safe(merged, right, keys)
    fills = {c: F.coalesce(q(c), F.lit("")) for c in ["Novedad", "Tipo_Novedad", "Nombre_Usuario"]
             if c in out.columns}
    return out.withColumns(fills) if fills else out


def followup_detail(portfolio: DataFrame, contacts: DataFrame, clients: DataFrame | None = None) -> DataFrame:
    """Loan x role x contact detail table (the follow-up master).

    Roles, counts and contacts are joined per client, on the few columns of the
    log; the wide loans meet the result in one inner join on the client (AQE can
    split either side), so they are shuffled once and never after the fan-out.

    ``clients``: one row per client of the portfolio, if they are at hand; their
    further columns (the client's number) come with the detail.
    """
    base = followup_base(portfolio)
    if clients is None:
        clients = base.select("Cedula_Cliente").where(q("Cedula_Cliente").isNotNull()).distinct()
    keys = ["Cedula_Cliente", "Cargo_Usuario"]
    log = contacts.select(*[q(c).alias(c + "_right" if c in base.columns and c not in keys else c) for c in contacts.columns if c != "Empresa"])
    rows = join_contact_detail(join_contacts_per_role(join_client_roles(clients, log), log), log)
    more = [c for c in clients.columns if c not in keys]
    extra = [c for c in rows.columns if c not in [*keys, "Novedades_Por_Cargo", *more]]
    met = base.where(q("Cedula_Cliente").isNotNull()).join(rows, "Cedula_Cliente")
    # a loan without a client has no contacts
    none = {"Cargo_Usuario": F.lit(UNASSIGNED), "Novedades_Por_Cargo": F.lit(0).cast("long")}
    alone = base.where(q("Cedula_Cliente").isNull()).withColumns(
        none | {c: F.lit(None).cast(rows.schema[c].dataType) for c in [*extra, *more]})
    cols = [q(c) for c in [*keys, *[c for c in base.columns if c not in keys], "Novedades_Por_Cargo", *extra, *more]]
    out = met.select(*cols).unionByName(alone.select(*cols))
    fills = {c: F.coalesce(q(c), F.lit("")) for c in ["Novedad", "Tipo_Novedad", "Nombre_Usuario"] if c in out.columns}
    return out.withColumns(fills) if fills else out


def detail_size(portfolio: DataFrame, contacts: DataFrame) -> int:
    """About how many rows :func:`followup_detail` has, from the loans and contacts of each
    client (a client's contacts without a role are one row)."""
    loans = portfolio.groupBy("Cedula_Cliente").agg(F.count(F.lit(1)).alias("loans"))
    log = contacts.groupBy("Cedula_Cliente").agg(F.count(F.lit(1)).alias("contacts"))
    both = loans.join(log, "Cedula_Cliente", "left").agg(F.sum(F.col("loans") * F.coalesce("contacts", F.lit(1))).alias("n"))
    return both.first().n or 0

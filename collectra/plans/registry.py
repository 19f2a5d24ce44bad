"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each query builds its plan over the whole driver tables (through the domain
views in :mod:`collectra.sources.fixtures`) and returns a lazy DataFrame.
Sink queries write to a fresh folder under the shared root and return the
data read back, so the round trip itself is what gets checked.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collectra.functions import amounts, states
from collectra.functions.columns import guard_numeric, project_existing, q, trim_column_names
from collectra.functions.dates import dates_to_text, mixed_date
from collectra.functions.text import name_tokens, normalize_phone, strip_ws
from collectra.operators import cleaning, commercial, followups, portfolio as pf, results, search
from collectra.operators.callcenter import base, calls as cl, contacts as ct, fuzzy, messaging as ms
from collectra.schemas import (CONTACT_SCHEMA, ROLL_RATE_TABLE_COLUMNS)
from collectra.session import fresh_path
from collectra.sources import fixtures as fx
from collectra.sources import indexes, landing, store
from collectra.sources.materialize import input_version, materialized, prepared, stored

AS_OF = _dt.date.fromisoformat(fx.AS_OF_PORTFOLIO)
AS_OF_PROMISES = _dt.date.fromisoformat(fx.AS_OF_PROMISES)
JOB = "job-0001"
# the fixture's disbursements span 1995-2001; the default window floor (2018)
# would leave the cube empty, so the registered query opens it at 1995
DISBURSEMENT_MIN_YEAR = 1995


class T:
    """Domain tables of one run.

    The cleaned domain tables (the "loaded sheets") are written once per
    session and input folder to the shared root and re-read by the
    downstream queries, as a batch pipeline loads its report once and runs all
    modules on it.  The follow-up charts read theirs once: they take a table
    that is written, and else its plan, pruned to their columns.  ``load_*``
    queries and the fuzzy match itself build from the raw tables so their own
    operators are what they measure.
    """

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self.version = input_version(spark, sf)

    def _m(self, name, build):
        return materialized(self.spark, name, self.sf, build, version=self.version)

    def _planned(self, name, build):
        """A table that a query reads once, for few of its columns: as written, if
        it is, else its plan, of which Spark works out those columns only."""
        return stored(self.spark, name, self.sf, build, version=self.version)

    def portfolio(self):
        return self._m("portfolio", lambda: fx.portfolio(self.spark, self.sf))

    def portfolio_raw(self):
        return self._m("portfolio_raw", lambda: fx.portfolio_raw(self.spark, self.sf))

    def contacts(self):
        return self._m("contacts", lambda: fx.contacts(self.spark, self.sf))

    def calls(self):
        return self._m("calls", lambda: fx.calls(self.spark, self.sf))

    def messages(self):
        return self._m("messages", lambda: fx.messages(self.spark, self.sf))

    def applications(self):
        return self._m("applications", lambda: fx.applications(self.spark, self.sf))

    def planned_portfolio(self):
        return self._planned("portfolio", lambda: fx.portfolio(self.spark, self.sf))

    def planned_contacts(self):
        return self._planned("contacts", lambda: fx.contacts(self.spark, self.sf))

    def followup_base(self):
        return followups.followup_base(self.portfolio())

    def planned_base(self):
        return followups.followup_base(self.planned_portfolio())

    def merged(self):
        return followups.join_client_roles(self.planned_base(), self.planned_contacts())

    def cc_portfolio(self):
        return base.callcenter_enrich(self.portfolio())

    def unified(self):
        return base.management_base(self.portfolio())

    def scoped_calls(self):
        return cl.call_scope(self.calls())

    def candidates(self):
        """The fuzzy candidates that a job keeps for live metrics."""
        return self._m("candidates", lambda: fuzzy.center_candidates(self.contacts(), self.calls()))

    def attributed(self):
        return self._m("attributed", lambda: fuzzy.fuzzy_agent_match(self.contacts(), self.calls()))

    def client_numbers(self):
        """The portfolio's clients numbered, written once."""
        return prepared(self.spark, "clients", self.sf, version=self.version,
                        make=lambda root: indexes.client_numbers(self.portfolio(), root))

    def _detail(self):
        return followups.followup_detail(self.portfolio(), self.contacts(), self.client_numbers())

    def contact_detail(self):
        """The stored follow-up detail table, with its clients' numbers."""
        return self._m("contact_detail", self._detail)

    def search_tables(self):
        """Paths of what search reads: the detail by page key with its indexes, and the client lookup.

        The detail is stored whole by page key, from the stored detail table, if it is
        written, else from its plan: a first copy would be written to be read once."""
        def make(root):
            rows = followups.detail_size(self.portfolio(), self.contacts())
            return store.search_tables(root, JOB, self._planned("contact_detail", self._detail), self.portfolio(), self.client_numbers(),
                                       parts=indexes.ranges_for(rows))
        return prepared(self.spark, "search", self.sf, version=self.version, make=make)

    def numbered_contacts(self):
        """The contact log with its clients' numbers, as stored with a job."""
        return self._m("numbered_contacts", lambda: indexes.with_client(self.contacts(), self.client_numbers()))

    def management_detail(self):
        """The stored call-centre detail that live metrics filter."""
        return self._m("management_detail", lambda: base.management_detail(self.portfolio(), self.contacts()))

    def live_detail(self):
        """What live metrics read of the call-centre detail: the stored one, or else its columns that a click can ask for, written."""
        from collectra.plans.live_metrics import click_columns
        return self._planned("management_detail", lambda: self._m(
            "live_detail", lambda: click_columns(base.management_detail(self.planned_portfolio(), self.contacts()))))

    def vintages(self):
        return commercial.vintage_early_risk(self.portfolio(), AS_OF)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _t(spark, sf) -> T:
    return T(spark, sf)


# ---------------------------------------------------------------- 2.1 sources / sinks
@query("load_portfolio")
def _(spark, sf):
    return fx.portfolio(spark, sf)


@query("load_contacts")
def _(spark, sf):
    return fx.contacts(spark, sf)


@query("load_calls")
def _(spark, sf):
    return fx.calls(spark, sf)


@query("load_messages")
def _(spark, sf):
    return fx.messages(spark, sf)


@query("load_applications")
def _(spark, sf):
    return fx.applications(spark, sf)


@query("scan_sheet")
def _(spark, sf):
    """Contacts landed as an all-text sheet (NULL as a null token), read back typed, in sheet order."""
    path = landing.land_as_text(fx.contacts_raw(spark, sf), fresh_path(spark, "landing", "contacts"), row="seq")
    return landing.scan_sheet(spark, path, CONTACT_SCHEMA, order_col="seq")


@query("write_detail")
def _(spark, sf):
    root = fresh_path(spark, "store")
    store.write_detail(_t(spark, sf).followup_base(), root, "seguimientos_rodamientos", JOB,
                       ROLL_RATE_TABLE_COLUMNS)
    return store.resolve_dataset(spark, root, "seguimientos_rodamientos", JOB)


@query("resolve_dataset")
def _(spark, sf):
    root = fresh_path(spark, "store")
    store.write_detail(_t(spark, sf).vintages(), root, "comercial_cosechas", JOB)
    return store.resolve_dataset(spark, root, "comercial_cosechas_s2", JOB)


@query("scan_parquet")
def _(spark, sf):
    """Stored detail read with a pushed-down filter and a pruned projection."""
    root = fresh_path(spark, "store")
    store.write_detail(_t(spark, sf).followup_base(), root, "seguimientos_rodamientos", JOB,
                       ROLL_RATE_TABLE_COLUMNS)
    return (store.resolve_dataset(spark, root, "cartera", JOB)
            .where(F.col("Estado_Pago") == "PAGO").select("Credito", "Total_Recaudo", "Zona"))


@query("write_summary")
def _(spark, sf):
    root = fresh_path(spark, "store")
    summary = results.results_by_zone(_t(spark, sf).portfolio())
    store.write_summary(summary, root, "resultados", JOB, empresa="ACME")
    return store.read_summary(spark, root, "resultados", JOB, schema=summary.schema).drop("meta_generado")


@query("read_summary")
def _(spark, sf):
    root = fresh_path(spark, "store")
    summary = cl.call_effectiveness(_t(spark, sf).scoped_calls())
    store.write_summary(summary, root, "call_center", JOB, empresa="ACME")
    return store.read_summary(spark, root, "call_center", JOB, schema=summary.schema).select(
        "Call_Center", "Total_Intentos", "Con_Respuesta", "Efectividad", "meta_modulo", "job_id")


@query("export_filtered")
def _(spark, sf):
    t = _t(spark, sf)
    req = search.SearchRequest(zona=["CL1", "CL2", "CL3"], columnas_visibles=[
        "Credito", "Cedula_Cliente", "Zona", "Total_Recaudo", "Estado_Pago", "Fecha_Cuota_Vigente"])
    f = search.apply_filters(t.followup_base(), req)
    path = store.export_filtered(f, fresh_path(spark, "export"), req.columnas_visibles)
    schema = dates_to_text(f.select(*req.columnas_visibles)).schema
    return spark.read.schema(schema).option("header", "true").csv(path)


@query("master_tables")
def _(spark, sf):
    t = _t(spark, sf)
    root = fresh_path(spark, "store")
    written = store.master_tables(root, JOB, t.followup_base(), t.contact_detail(), t.contacts())
    tables = {name: store.read_stored(spark, p) for name, p in sorted(written.items())}
    # contents, not only counts: loans, clients, money and texts of each table
    def total(df, c, how):
        return how(c) if c in df.columns else F.lit(None)

    parts = [df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("long").alias("cols"),
                    total(df, "Credito", F.countDistinct).cast("long").alias("creditos"),
                    F.countDistinct("Cedula_Cliente").alias("clientes"),
                    total(df, "Total_Recaudo", lambda c: F.sum(q(c).cast("decimal(24,3)"))).cast("double").alias("recaudo"),
                    total(df, "Tipo_Novedad", lambda c: F.sum(F.length(c))).cast("long").alias("tipo_largo"),
                    total(df, "Zona", lambda c: F.sum(F.length(c))).cast("long").alias("zona_largo"))
             .withColumn("tabla", F.lit(name))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("active_manifest")
def _(spark, sf):
    t = _t(spark, sf)
    root = fresh_path(spark, "store")
    stats = t.portfolio().agg(F.count(F.lit(1)).alias("creditos"),
                              F.countDistinct("Cedula_Cliente").alias("clientes"))
    store.write_manifest(spark, root, JOB, "ACME", _dt.datetime(2001, 8, 1, 12, 0, 0), stats)
    return store.read_manifest(spark, root, schema=stats.schema.add("active_job_id", "string")
                               .add("fecha_actualizacion", "string").add("empresa", "string")
                               .add("status", "string"))


@query("ingest_new_drops")
def _(spark, sf):
    from collectra.streaming.ingest import ingest_call_drops
    return ingest_call_drops(spark, sf)


@query("latest_contact_state")
def _(spark, sf):
    """The contact log landed in drops, two files to a micro-batch: last contact per client from the kept state."""
    from collectra.streaming import state
    raw = fx.contacts_raw(spark, sf)
    land = fresh_path(spark, "landing", "contact-drops")
    raw.repartition(6).write.parquet(land)
    out = state.ingest_contacts(spark, land, raw.schema, fresh_path(spark, "ingest", "state"), fresh_path(spark, "ingest", "ckpt"), files_per_batch=2)
    return base.of_last(state.stored_last(spark, out))


# ---------------------------------------------------------------- 2.2 scalar rules
@query("parse_mixed_dates")
def _(spark, sf):
    e = fx.table(spark, sf, "events")
    k = F.col("event_id") % 4
    raw = (F.when(k == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
           .when(k == 1, F.date_format("ts", "yyyy/MM/dd"))
           .when(k == 2, F.date_format("ts", "dd/MM/yyyy"))
           .otherwise(F.date_format("ts", "yyyy-MM-dd")))
    return e.select("event_id", raw.alias("raw")).withColumn("parsed", mixed_date(F.col("raw")))


@query("trim_text")
def _(spark, sf):
    c = fx.calls_raw(spark, sf)
    return c.select("seq", strip_ws(q("Estado_Llamada")).alias("Estado_Llamada"),
                    strip_ws(q("Call_Center")).alias("Call_Center"))


@query("prepaid_flag")
def _(spark, sf):
    p = _t(spark, sf).portfolio_raw()
    return p.select("Credito", amounts.prepaid_flag(q("Valor_Cuota_Vigente")).alias("Tipo_Vigencia_Temp"))


@query("parse_amount")
def _(spark, sf):
    p = _t(spark, sf).portfolio_raw()
    v = q("Valor_Cuota_Vigente")
    return p.select("Credito", v.alias("raw"), amounts.parse_amount(v).alias("amount"),
                    amounts.parse_amount(v, parity=True).alias("amount_parity"))


@query("fill_contacts")
def _(spark, sf):
    return _t(spark, sf).portfolio().select("Credito", "Cantidad_Novedades")


@query("normalize_zone")
def _(spark, sf):
    p = cleaning.normalize_zones(_t(spark, sf).portfolio_raw())
    return p.select("Credito", "Zona", "Call_Center_Apoyo")


@query("assign_call_center")
def _(spark, sf):
    p = cleaning.assign_call_center(cleaning.normalize_zones(_t(spark, sf).portfolio_raw()))
    return p.select("Credito", "CALL_CENTER_FILTRO")


@query("default_region")
def _(spark, sf):
    """Region blanked where the collection zone is missing, then defaulted."""
    p = _t(spark, sf).portfolio_raw()
    p = p.withColumn("Regional_Cobro", F.when(q("Zona_Cobro").isNull(), F.lit(None).cast("string"))
                     .otherwise(q("Regional_Cobro")))
    return cleaning.default_region(p).select("Credito", "Regional_Cobro")


@query("validity_state")
def _(spark, sf):
    p = _t(spark, sf).portfolio()
    return p.select("Credito", "Estado_Vigencia",
                    states.validity_substate(q("Estado_Vigencia"), q("Fecha_Cuota_Vigente")).alias("Sub_Estado_Vigencia"))


@query("validity_substate")
def _(spark, sf):
    p = _t(spark, sf).portfolio()
    return p.select("Credito", "Fecha_Cuota_Vigente",
                    states.validity_substate(q("Estado_Vigencia"), q("Fecha_Cuota_Vigente")).alias("Sub_Estado_Vigencia"))


@query("payment_state")
def _(spark, sf):
    p = _t(spark, sf).portfolio()
    out = p.select("Credito", "Tipo_Vigencia_Temp", "Total_Recaudo")
    for mode in ["portfolio", "followups", "callcenter", "funnel"]:
        out = states.payment_state(out, mode=mode, name=f"pago_{mode}")
    return out.drop("Tipo_Vigencia_Temp", "Total_Recaudo")


@query("contact_state")
def _(spark, sf):
    return states.contact_state(_t(spark, sf).portfolio()).select("Credito", "Estado_Gestion")


@query("map_collection_zone")
def _(spark, sf):
    p = _t(spark, sf).portfolio()
    return (p.select("Credito", "Zona_Cobro",
                     states.collection_zone(q("Zona_Cobro"), q("Regional_Cobro")).alias("Eje_X_Cobro"))
            .where(F.col("Eje_X_Cobro").isNotNull()))


@query("normalize_phone")
def _(spark, sf):
    m = _t(spark, sf).messages()
    return m.select("seq", "Numero_Telefono", normalize_phone(q("Numero_Telefono")).alias("Tel_Norm"))


@query("clean_call_center")
def _(spark, sf):
    return _t(spark, sf).calls().select("seq", "Call_Center_Limpio")


@query("clean_call_state")
def _(spark, sf):
    c = _t(spark, sf).calls()
    return c.select("seq", states.call_state(q("Estado_Llamada")).alias("Estado_Respuesta"))


@query("trim_column_names")
def _(spark, sf):
    c = fx.calls_raw(spark, sf)
    padded = c.toDF(*[f" {n} " if i % 2 else f"{n} " for i, n in enumerate(c.columns)])
    return trim_column_names(padded).select("seq", "Nombre_Call", "Call_Center")


@query("conversation_flag")
def _(spark, sf):
    return ms.with_conversation_flag(_t(spark, sf).messages()).select("seq", "Es_Conversacion")


@query("name_tokens")
def _(spark, sf):
    users = _t(spark, sf).contacts().select("Nombre_Usuario").distinct()
    agents = _t(spark, sf).calls().select(q("Nombre_Call").alias("Nombre_Usuario")).distinct()
    return (users.unionByName(agents).distinct()
            .select("Nombre_Usuario", F.array_join(F.array_sort(name_tokens(q("Nombre_Usuario"))), " ").alias("tokens")))


@query("promise_state")
def _(spark, sf):
    c = _t(spark, sf).contacts().where(F.upper("Tipo_Novedad").contains("COMPROMISO"))
    return c.select("seq", "Fecha_Compromiso",
                    states.promise_state(q("Fecha_Compromiso"), AS_OF_PROMISES).alias("Estado_Acuerdo"))


@query("guard_numeric")
def _(spark, sf):
    p = _t(spark, sf).portfolio().select("Credito", "Meta_$", "Recaudo_Meta", "Valor_Cuota_Vigente")
    return guard_numeric(p, ["Meta_$", "Recaudo_Meta", "Valor_Cuota_Vigente", "Valor_Vencido"])


@query("default_dims")
def _(spark, sf):
    p = _t(spark, sf).portfolio().drop("Empresa", "CALL_CENTER_FILTRO", "Franja_Cartera", "Estado_Vigencia")
    return results.default_dims(p).select("Credito", "Empresa", "CALL_CENTER_FILTRO", "Regional_Cobro",
                                          "Franja_Cartera", "Estado_Vigencia")


@query("dates_to_text")
def _(spark, sf):
    c = _t(spark, sf).contacts().select("seq", "Fecha_Novedad", "Fecha_Compromiso")
    return dates_to_text(c)


# ---------------------------------------------------------------- 2.3 projections / filters
@query("project_existing")
def _(spark, sf):
    return project_existing(_t(spark, sf).followup_base(), ROLL_RATE_TABLE_COLUMNS)


@query("results_scope")
def _(spark, sf):
    return results.results_scope(_t(spark, sf).portfolio()).select("Credito", "Franja_Meta", "Zona")


@query("refinance_candidates")
def _(spark, sf):
    return commercial.refinance_candidates(_t(spark, sf).portfolio()).select(
        "Credito", "Total_Cuotas", "Cuotas_Pagadas", "Cuotas_Restantes", "Dias_Atraso_Final")


@query("vintage_early_risk")
def _(spark, sf):
    return _t(spark, sf).vintages().select("Credito", "Fecha_Desembolso", "Cuotas_Pagadas", "Grupo_Seguimiento")


@query("center_filter")
def _(spark, sf):
    return ct.center_filter(_t(spark, sf).attributed(), "CL3").select("seq", "Call_Center")


@query("valid_center_messages")
def _(spark, sf):
    return ms.valid_center_messages(_t(spark, sf).messages()).select("seq", "Call_Center")


@query("valid_assignment")
def _(spark, sf):
    return followups.valid_assignment(_t(spark, sf).merged()).select("Credito", "Cargo_Usuario", "Estado_Gestion")


@query("application_summary")
def _(spark, sf):
    return commercial.application_summary(_t(spark, sf).applications())


@query("application_matrix")
def _(spark, sf):
    return commercial.application_matrix(_t(spark, sf).applications())


# ---------------------------------------------------------------- 2.4 joins
@query("join_client_roles")
def _(spark, sf):
    return _t(spark, sf).merged().select("Credito", "Cedula_Cliente", "Cargo_Usuario")


@query("join_contacts_per_role")
def _(spark, sf):
    t = _t(spark, sf)
    contacts = t.contacts()  # read twice: written first
    return followups.join_contacts_per_role(t.merged(), contacts).select(
        "Credito", "Cargo_Usuario", "Novedades_Por_Cargo")


@query("join_contact_detail")
def _(spark, sf):
    t = _t(spark, sf)
    return followups.followup_detail(t.portfolio(), t.contacts()).select(
        "Credito", "Cargo_Usuario", "Novedades_Por_Cargo", "seq", "Tipo_Novedad", "Novedad",
        "Nombre_Usuario", "Fecha_Novedad")


@query("join_latest_contact")
def _(spark, sf):
    """The last row of the landed contact sheet per client."""
    t = _t(spark, sf)
    path = landing.land_as_text(fx.contacts_raw(spark, sf), fresh_path(spark, "landing", "contacts"), row="seq")
    landed = cleaning.clean_contacts(landing.scan_sheet(spark, path, CONTACT_SCHEMA, order_col="seq"))
    return base.management_detail(t.portfolio(), landed).select(
        "Credito", "CALL_CENTER_FILTRO", "Tipo_Novedad", "Novedad")


@query("msg_phone_match")
def _(spark, sf):
    t = _t(spark, sf)
    return ms.msg_phone_match(t.messages(), t.contacts()).select("seq", "Tel_Norm")


@query("msg_payer_match")
def _(spark, sf):
    t = _t(spark, sf)
    return ms.msg_payer_match(t.messages(), t.contacts(), t.cc_portfolio()).select("seq", "Tel_Norm", "Cedula_Cliente")


@query("semi_join_validity")
def _(spark, sf):
    t = _t(spark, sf)
    bitmaps = store.read_stored(spark, t.search_tables()["busqueda_validez"])
    return indexes.keep_states(t.numbered_contacts(), bitmaps, ["anticipado"]).select("seq", "Cedula_Cliente")


@query("semi_join_contacts")
def _(spark, sf):
    t = _t(spark, sf)
    from collectra.plans.live_metrics import restrict_contacts
    scope = t.portfolio().where(q("Zona").isin("CL1", "CL2"))
    return restrict_contacts(t.contacts(), scope).select("seq", "Cedula_Cliente")


@query("filter_calls_by_center")
def _(spark, sf):
    from collectra.plans.live_metrics import restrict_calls
    return restrict_calls(_t(spark, sf).calls(), ["CL1", "CL2"]).select("seq", "Call_Center_Limpio")


@query("fuzzy_agent_match")
def _(spark, sf):
    t = _t(spark, sf)
    return fuzzy.fuzzy_agent_match(t.contacts(), t.calls()).select("seq", "Nombre_Usuario", "Call_Center")


# ---------------------------------------------------------------- 2.5 aggregations
@query("cube_regional")
def _(spark, sf):
    return pf.cube_regional(_t(spark, sf).portfolio())


@query("cube_collection")
def _(spark, sf):
    return pf.cube_collection(_t(spark, sf).portfolio())


@query("cube_disbursement")
def _(spark, sf):
    return pf.cube_disbursement(_t(spark, sf).portfolio(), AS_OF, min_year=DISBURSEMENT_MIN_YEAR)


@query("cube_validity")
def _(spark, sf):
    return pf.cube_validity(_t(spark, sf).portfolio())


@query("results_by_zone")
def _(spark, sf):
    return results.results_by_zone(_t(spark, sf).portfolio())


@query("results_by_collector")
def _(spark, sf):
    return results.results_by_collector(_t(spark, sf).portfolio())


@query("donut_payment")
def _(spark, sf):
    return followups.donut_payment(_t(spark, sf).planned_base())


@query("roll_rate")
def _(spark, sf):
    return followups.roll_rate(_t(spark, sf).planned_base())


@query("sunburst_all")
def _(spark, sf):
    return followups.sunburst(_t(spark, sf).merged(), sort=True)


@query("sunburst_paid")
def _(spark, sf):
    return followups.sunburst(_t(spark, sf).merged(), "PAGO")


@query("sunburst_unpaid")
def _(spark, sf):
    return followups.sunburst(_t(spark, sf).merged(), "SIN PAGO")


@query("contacts_per_role")
def _(spark, sf):
    return followups.contacts_per_role(_t(spark, sf).contacts())


@query("vintage_sections")
def _(spark, sf):
    return commercial.vintage_sections(_t(spark, sf).vintages())


@query("refinance_total")
def _(spark, sf):
    return commercial.refinance_total(commercial.refinance_candidates(_t(spark, sf).portfolio()))


@query("management_base")
def _(spark, sf):
    return _t(spark, sf).unified()


@query("goal_attainment")
def _(spark, sf):
    return base.goal_attainment(_t(spark, sf).unified())


@query("roll_rate_cc")
def _(spark, sf):
    return base.roll_rate_cc(_t(spark, sf).unified())


@query("cc_meta")
def _(spark, sf):
    return base.cc_meta(_t(spark, sf).unified())


@query("call_totals")
def _(spark, sf):
    return cl.call_totals(_t(spark, sf).scoped_calls())


@query("call_chart")
def _(spark, sf):
    return cl.call_totals_long(_t(spark, sf).scoped_calls())


@query("call_effectiveness")
def _(spark, sf):
    return cl.call_effectiveness(_t(spark, sf).scoped_calls())


@query("call_threshold")
def _(spark, sf):
    return cl.call_threshold(_t(spark, sf).scoped_calls())


@query("calls_by_day")
def _(spark, sf):
    return cl.calls_by_day(_t(spark, sf).scoped_calls())


@query("msg_effectiveness")
def _(spark, sf):
    return ms.msg_effectiveness(_t(spark, sf).messages())


@query("msg_funnel")
def _(spark, sf):
    t = _t(spark, sf)
    return ms.msg_funnel(t.messages(), t.contacts(), t.cc_portfolio())


@query("msg_paying_clients")
def _(spark, sf):
    t = _t(spark, sf)
    return ms.paying_client_count(t.messages(), t.contacts(), t.cc_portfolio())


@query("contacts_by_center")
def _(spark, sf):
    return ct.contacts_by_center(_t(spark, sf).attributed())


@query("contacts_by_center_type")
def _(spark, sf):
    return ct.contacts_by_center_type(_t(spark, sf).attributed())


@query("promises_by_state")
def _(spark, sf):
    return ct.promises_by_state(_t(spark, sf).attributed(), AS_OF_PROMISES)


@query("contact_kpis")
def _(spark, sf):
    return ct.contact_kpis(_t(spark, sf).attributed())


@query("facet_values")
def _(spark, sf):
    return pf.facet_values(_t(spark, sf).portfolio())


@query("facet_values_cc")
def _(spark, sf):
    t = _t(spark, sf)
    return base.facet_values_cc(base.management_detail(t.portfolio(), t.contacts()))


# ---------------------------------------------------------------- 2.7 search
def _search_req(**kw) -> search.SearchRequest:
    return search.SearchRequest(**kw)


@query("search_text")
def _(spark, sf):
    path = _t(spark, sf).search_tables()["busqueda_gestion"]
    return search.search_text_stored(spark, path, "Customer#0000001").select("Credito", "seq", "Nombre_Cliente")


@query("search_facets")
def _(spark, sf):
    d = _t(spark, sf).followup_base()
    req = _search_req(empresa=["BUILDING", "MACHINERY"], regional=["ASIA", "EUROPE"], franja=["1 A 30", "AL DIA"],
                      call_center=["CL1", "CL5", "CL7"])
    return d.where(search.facet_predicate(d, req)).select("Credito", "Empresa", "Regional_Cobro", "Franja_Cartera",
                                                          "CALL_CENTER_FILTRO")


@query("search_contacted")
def _(spark, sf):
    d = _t(spark, sf).followup_base()
    return d.where(search.contacted_predicate(d, ["Con Novedades"])).select("Credito", "Cantidad_Novedades")


@query("search_states")
def _(spark, sf):
    d = _t(spark, sf).followup_base()
    req = _search_req(estado_pago=["PAGO"], estado_gestion=["CON GESTIÓN"], rodamiento=["MEJORA", "NORMALIZO"])
    return d.where(search.state_predicate(d, req)).select("Credito", "Estado_Pago", "Estado_Gestion", "Rodamiento")


@query("search_role")
def _(spark, sf):
    d = _t(spark, sf).contact_detail()
    return d.where(search.role_predicate(d, ["SIN ASIGNAR", "ABOGADO"])).select("Credito", "seq", "Cargo_Usuario")


@query("search_vintage_section")
def _(spark, sf):
    return search.search_vintage_section(_t(spark, sf).vintages(), "comercial_cosechas_s3").select(
        "Credito", "Grupo_Seguimiento")


@query("search_page")
def _(spark, sf):
    t = _t(spark, sf)
    req = _search_req(page=3, page_size=20, zona=["CL1", "CL2", "CL3", "CL4"], cargos=["GESTOR"],
                      novedades=["Con Novedades"], vigencia=["vigente"])
    tables = t.search_tables()
    page = search.find_page_stored(spark, tables["busqueda_gestion"], req, validity=store.read_stored(spark, tables["busqueda_validez"])).with_metadata()
    return page.select("Credito", "seq", "Zona", "Cargo_Usuario", "Tipo_Novedad", "total_registros",
                       "pagina_actual", "total_paginas")


@query("lookup_clients")
def _(spark, sf):
    return search.lookup_stored(spark, _t(spark, sf).search_tables()["busqueda_clientes"], "customer#00000012", limit=20)


@query("related_rows")
def _(spark, sf):
    d = _t(spark, sf).contact_detail()
    return search.related_rows(d, "Cedula_Cliente", " 42 ").select("Credito", "seq", "Cargo_Usuario", "Fecha_Novedad")


@query("live_cc_metrics")
def _(spark, sf):
    from collectra.plans.live_metrics import live_cc_metrics
    t = _t(spark, sf)
    req = _search_req(call_center=["CL1", "CL2", "CL5"], franja=["AL DIA", "1 A 30", "31 A 90"])
    return live_cc_metrics(t.live_detail(), t.contacts(), t.calls(), t.messages(), req, AS_OF_PROMISES, candidates=t.candidates())

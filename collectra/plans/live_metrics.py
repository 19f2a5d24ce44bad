"""Live call-centre metrics: filter the stored call-centre detail, restrict the
contact log and calls to it, and recompute the whole call-centre module.

The centre filter is the detail's ``CALL_CENTER_FILTRO``, which carries the
management rule.  A filter that matches nothing gives the metrics of nothing;
``parity=True`` keeps the source system's reading, where an empty scope turns
the contact and call filters off.

A click reads each input at most twice.  The scoped detail is exploded once
into (metric table, key, detail) rows that one aggregate counts, and reduced
once to its clients with their payment flag; calls, contacts and messages are
aggregated once to their finest groups, from which their tables follow.  The
fuzzy match is not run: its scores do not depend on the filter, so the best
agents per (user, centre) are stored with the job
(:func:`collectra.operators.callcenter.fuzzy.center_candidates`) and a click
chooses among the centres in force.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collectra.functions.agg import MONEY
from collectra.functions.columns import q
from collectra.functions.states import promise_state
from collectra.operators import search
from collectra.operators.callcenter import base, calls as cl, contacts as ct, fuzzy, messaging as ms
from collectra.schemas import CALL_THRESHOLD_PER_CENTER, CON_GESTION, FRONT_FACETS, LIVE_FACETS, SIN_GESTION
from collectra.session import fresh_path
from collectra.sources.store import resolve_dataset


# what the metrics read of the detail beside the columns of its filters and facets,
# and its last contact
METRIC_COLUMNS = ["Cedula_Cliente", "Call_Center_Apoyo", "Cobrador", "Nombre_Call_Center", "Franja_Meta", "Meta_General", "Meta_$",
                  "Recaudo_Meta", "Total_Recaudo", "Cantidad_Novedades", "Estado_Vigencia", "Tipo_Novedad", "Novedad"]


def click_columns(detail: DataFrame) -> DataFrame:
    """The detail as far as a click can ask for it: every row, without the columns that no filter and no metric reads."""
    wanted = {*METRIC_COLUMNS, *(c for c, _ in LIVE_FACETS), *(c for _, c in FRONT_FACETS)}
    return detail.select(*[q(c) for c in detail.columns if c in wanted])


def _prefilter(pf: DataFrame, req: search.SearchRequest) -> DataFrame:
    """Facets, roll rate and contacted flag (row-level predicates only)."""
    preds = [q(c).isin(*v) for c, v in ((c, getattr(req, f)) for c, f in LIVE_FACETS) if v and c in pf.columns]
    return pf.where(search._and(preds) & search.contacted_predicate(pf, req.novedades))


def _with_validity(f: DataFrame, req: search.SearchRequest, portfolio: DataFrame | None) -> DataFrame | None:
    """Rows that hold the chosen validity states: of ``f``, or of the job's portfolio where ``f`` has none."""
    if not req.vigencia:
        return None
    if "Estado_Vigencia" not in f.columns:
        if portfolio is None:
            raise ValueError("a validity filter needs Estado_Vigencia in the detail, or the portfolio that holds the states")
        f = portfolio
    return f.where(q("Estado_Vigencia").isin(*req.vigencia) & q("Cedula_Cliente").isNotNull())


def filter_portfolio(pf: DataFrame, req: search.SearchRequest, portfolio: DataFrame | None = None) -> DataFrame:
    """Facets, roll rate, contacted flag and validity (clients of the
    already-filtered portfolio with the chosen states, via a semi join).

    ``portfolio``: where the states are, if the detail has no such column."""
    f = _prefilter(pf, req)
    keep = _with_validity(f, req, portfolio)
    if keep is not None:
        f = f.join(keep.select("Cedula_Cliente").distinct(), "Cedula_Cliente", "left_semi")
    return f


def scope_is_empty(scope: DataFrame) -> bool:
    """One-row probe (a limit job, not a count of the scope)."""
    return scope.limit(1).count() == 0


def portfolio_scope_is_empty(pf: DataFrame, req: search.SearchRequest, portfolio: DataFrame | None = None) -> bool:
    """Whether :func:`filter_portfolio` is empty, without its semi join where the states are in the detail.

    A pre-filtered row with a chosen validity state keeps its own client in
    the key set, so it survives the semi join: the scope is empty exactly
    when no such row exists.  The probe is a filtered scan that stops at the
    first hit instead of a job that must finish the join's shuffles.
    """
    if req.vigencia and "Estado_Vigencia" not in pf.columns:
        return scope_is_empty(filter_portfolio(pf, req, portfolio))
    f = _prefilter(pf, req)
    keep = _with_validity(f, req, portfolio)
    return scope_is_empty(f if keep is None else keep)


def restrict_contacts(contacts: DataFrame, scope: DataFrame) -> DataFrame:
    """Contacts of the scope's clients."""
    return contacts.join(scope.select("Cedula_Cliente"), "Cedula_Cliente", "left_semi")


def restrict_calls(calls: DataFrame, centers) -> DataFrame:
    """Calls of the chosen centres (all, if none is chosen).  The cleaned centre
    label is used (the raw one carries blanks / lower case)."""
    if not centers:
        return calls
    col = "Call_Center_Limpio" if "Call_Center_Limpio" in calls.columns else "Call_Center"
    return calls.where(q(col).isin(*centers))


# The metric tables are written as SQL text: a click should not spend its time
# on thousands of small calls that build expressions.

def _text(c: str | None) -> str:
    return f"CAST({c or 'NULL'} AS STRING)"


def _long(df: DataFrame, rows: list[tuple[str, str, str | None, str | None, dict[str, str]]]) -> DataFrame:
    """(seccion, clave, detalle, metric, value): for each row of ``df`` the entries whose condition holds.

    ``rows``: (condition, section, key, detail, {metric: value}).
    """
    each = [f"CASE WHEN {cond} THEN named_struct('seccion', {section}, 'clave', {_text(k)}, 'detalle', {_text(d)}, "
            f"'metric', '{m}', 'value', CAST({v} AS DOUBLE)) END"
            for cond, section, k, d, values in rows for m, v in values.items()]
    return df.selectExpr(f"inline(array_compact(array({', '.join(each)})))")


def _grouped(df: DataFrame, groups: dict[str, tuple[str, str | None, str | None]], aggs: dict[str, str]) -> DataFrame:
    """Aggregates of ``df`` in several groupings at once: (kind, k1, k2, aggregates).

    ``groups``: kind -> (rows that count, its two keys).  Rows are multiplied
    inside the task and counted there first.
    """
    each = [f"CASE WHEN {cond} THEN named_struct('kind', '{kind}', 'k1', {_text(a)}, 'k2', {_text(b)}) END" for kind, (cond, a, b) in groups.items()]
    g = df.selectExpr("*", f"explode(array_compact(array({', '.join(each)}))) AS g")
    return g.groupBy("g.kind", "g.k1", "g.k2").agg(*[F.expr(f"{v} AS {k}") for k, v in aggs.items()])


def _one(df: DataFrame) -> DataFrame:
    """``df`` and a row that counts nothing, so that totals of an empty input are there."""
    return df.selectExpr("*", "true AS real").unionByName(df.sparkSession.range(1).selectExpr("false AS real"), allowMissingColumns=True)


def _money(c: str) -> str:
    """:func:`collectra.functions.agg.money_sum` as SQL."""
    return f"CAST(coalesce(sum(CAST({c} AS {MONEY})), 0) AS DOUBLE)"


def detail_metrics(scope: DataFrame) -> DataFrame:
    """Goal, attainment, roll rate and facet values of the scoped detail, in one pass."""
    facets = {name: c for name, c in FRONT_FACETS if c in scope.columns}
    att = base.attributed_flags(base.callcenter_enrich(scope)).selectExpr(
        "_branch IS NOT NULL AS in_base", "_center AS center", "_agent AS agent", "_goal AS goal", "Recaudo_Meta AS paid", "Rodamiento AS roll",
        *[f"CAST(`{c}` AS STRING) AS f_{name}" for name, c in facets.items()])
    groups = {"meta": ("true", None, None), "cumplimiento": ("in_base", "center", "agent"), "rodamiento": ("in_base", "roll", None)}
    groups |= {f"f_{n}": ("real", f"f_{n}", None) for n in facets}
    g = _grouped(_one(att), groups, {"n": "count_if(in_base)", "goal": _money("CASE WHEN in_base THEN goal END"), "paid": _money("CASE WHEN in_base THEN paid END")})
    out = _long(g, [
        ("kind = 'meta'", "'meta'", None, None, {"total_cuentas": "n", "total_meta": "goal"}),
        ("kind = 'cumplimiento'", "'cumplimiento'", "k1", "k2",
         {"META_$": "goal", "Recaudo_Meta": "paid", "Faltante": f"CAST(goal AS {MONEY}) - CAST(paid AS {MONEY})",
          "Cumplimiento": "CASE WHEN goal > 0 THEN paid / goal ELSE 0 END"}),
        ("kind = 'rodamiento'", "'rodamiento'", "k1", None, {"count": "n"}),
        ("startswith(kind, 'f_')", "'filtros'", "substring(kind, 3)", "k1", {"n": "1"}),
    ])
    fixed = scope.sparkSession.range(1)
    return out.unionByName(_long(fixed, [("true", "'filtros'", "'estados_gestion'", f"'{s}'", {"n": "1"}) for s in (CON_GESTION, SIN_GESTION)]))


def call_metrics(scoped: DataFrame) -> DataFrame:
    """Totals, effectiveness, threshold and daily calls of the scoped calls, in one pass."""
    fine = scoped.select(q("Call_Center_Limpio").alias("center"), F.date_format(cl.call_day(scoped), "yyyy-MM-dd").alias("day"),
                         F.expr("coalesce(Estado_Llamada = 'ANSWERED', false) AS answered"))
    fine = fine.groupBy("center", "day", "answered").agg(F.expr("count(1) AS n"))
    g = _grouped(_one(fine), {"all": ("true", None, None), "center": ("real", "center", None),
                              "day": ("real AND day IS NOT NULL", "day", "CASE WHEN answered THEN 'CON RESPUESTA' ELSE 'SIN RESPUESTA' END")},
                 {"n": "coalesce(sum(n), 0)", "yes": "coalesce(sum(CASE WHEN answered THEN n END), 0)", "centers": "count(DISTINCT center)"})
    return _long(g, [
        ("kind = 'all'", "'llamadas'", None, None, {"total_llamadas": "n", "con_respuesta": "yes", "sin_respuesta": "n - yes"}),
        ("kind = 'all'", "'umbral'", None, None, {"alerta_umbral": f"centers * {CALL_THRESHOLD_PER_CENTER}"}),
        ("kind = 'center'", "'efectividad'", "k1", None, {"Total_Intentos": "n", "Con_Respuesta": "yes", "Efectividad": "CASE WHEN n > 0 THEN yes / n END"}),
        ("kind = 'day'", "'por_dia'", "k1", "k2", {"Total_Llamadas": "n"}),
    ])


def contact_metrics(att: DataFrame, promises_as_of) -> DataFrame:
    """KPIs, contacts per centre and type, promises per centre of the attributed contacts, in one pass."""
    is_date = dict(att.dtypes).get("Fecha_Compromiso") == "date"
    fine = att.select(q("Call_Center").alias("center"), q("Tipo_Novedad").alias("type"),
                      F.when(F.expr("upper(CAST(Tipo_Novedad AS STRING)) LIKE '%COMPROMISO%'"),
                             promise_state(q("Fecha_Compromiso"), promises_as_of, is_date=is_date)).alias("state"))
    fine = fine.groupBy("center", "type", "state").agg(F.expr("count(1) AS n")).selectExpr("*", "sum(n) OVER (PARTITION BY type) AS of_type")
    known = f"real AND center <> '{ct.UNASSIGNED}'"
    g = _grouped(_one(fine), {"all": ("true", None, None), "center": (known, "center", None), "type": (known, "center", "type"),
                              "promise": (f"{known} AND state IS NOT NULL", "center", "state")},
                 {"n": "coalesce(sum(n), 0)", "unknown": f"coalesce(sum(CASE WHEN center = '{ct.UNASSIGNED}' THEN n END), 0)",
                  "top": "min_by(type, CASE WHEN real THEN struct(-of_type AS c, type AS t) END)"})
    return _long(g, [
        ("kind = 'all'", "'kpis'", "coalesce(top, 'N/A')", None, {"total": "n", "sin_asignar": "unknown"}),
        ("kind = 'center'", "'novedades_cc'", "k1", None, {"Cantidad": "n"}),
        ("kind = 'type'", "'novedades_tipo'", "k1", "k2", {"Cantidad": "n"}),
        ("kind = 'promise'", "'compromisos'", "k1", "k2", {"Cantidad": "n"}),
    ])


def message_metrics(messages: DataFrame, contacts: DataFrame) -> DataFrame:
    """Effectiveness per centre, and the funnel over the restricted contacts (with their clients' ``pays``)."""
    eff = ms.msg_effectiveness(messages)
    funnel = ms.funnel_stages(messages, ms.paying_phones(contacts))
    return _long(eff, [("true", "'mensajeria'", "name", None, {c: c for c in ("entregados", "conversaciones", "porcentaje")})]) \
        .unionByName(_long(funnel, [("true", "'funnel'", "name", None, {"value": "value"})]))


def live_cc_metrics(detail: DataFrame, contacts: DataFrame, calls: DataFrame, messages: DataFrame,
                    req: search.SearchRequest, promises_as_of, parity: bool = False,
                    candidates: DataFrame | None = None, portfolio: DataFrame | None = None) -> DataFrame:
    """Every call-centre metric of the filtered detail, in long form.

    ``candidates``: the job's stored (user, centre) candidates; without them
    they are worked out from the whole contact log and calls.  ``portfolio``:
    holds the validity states if the detail has none.
    """
    spark = detail.sparkSession
    if candidates is None:
        candidates = fuzzy.center_candidates(contacts, calls)
    scope = filter_portfolio(detail, req, portfolio)
    centers = list(req.call_center)
    # one row per client of the scope, written once: contacts are restricted to
    # it by an equi-join on a unique key that also says who pays
    path = fresh_path(spark, "live")
    (base.callcenter_enrich(scope).where("Cedula_Cliente IS NOT NULL").groupBy("Cedula_Cliente")
     .agg(F.expr("max(coalesce(Estado_Pago = 'PAGO', false)) AS pays")).write.parquet(path))
    clients = spark.read.schema(f"Cedula_Cliente {dict(detail.dtypes)['Cedula_Cliente']}, pays boolean").parquet(path)
    if parity and portfolio_scope_is_empty(detail, req, portfolio):
        nov, centers = contacts.withColumn("pays", F.lit(False)), []
    else:
        nov = contacts.join(clients, "Cedula_Cliente")
    winners = fuzzy.choose_centers(candidates, restricted=centers or None)
    parts = [
        detail_metrics(scope),
        call_metrics(cl.call_scope(restrict_calls(calls, centers))),
        message_metrics(messages, nov),
        contact_metrics(fuzzy.attribute(nov, winners), promises_as_of),
    ]
    return reduce(DataFrame.unionByName, parts)


def stored_cc_metrics(spark: SparkSession, root: str, job_id: str, req: search.SearchRequest, promises_as_of,
                      parity: bool = False) -> DataFrame:
    """The metrics of a stored job, from the tables its report run has left."""
    read = lambda name: resolve_dataset(spark, root, name, job_id)
    detail = read("detallados_call_center")
    states = read("detallados_cartera") if req.vigencia and "Estado_Vigencia" not in detail.columns else None
    return live_cc_metrics(detail, read("novedades_base"), read("llamadas_base"), read("mensajes_base"),
                           req, promises_as_of, parity, candidates=read("candidatos_centro"), portfolio=states)

"""Live metrics: equal to the modules run on the restricted tables, two readings of each input, no match per click."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from collectra.operators.callcenter import base, calls as cl, contacts as ct, fuzzy, messaging as ms
from collectra.operators.search import SearchRequest
from collectra.plans import live_metrics as lm
from collectra.plans.registry import T
from collectra.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    t = T(spark, SF)
    return t.management_detail(), t.contacts(), t.calls(), t.messages(), t.candidates()


def plainly(detail, contacts, calls, messages, req):
    """Every metric table by its own operator, on the restricted inputs."""
    scope = lm.filter_portfolio(detail, req)
    nov, cal = lm.restrict_contacts(contacts, scope), lm.restrict_calls(calls, req.call_center)
    unified, scoped, att = base.management_base(scope), cl.call_scope(cal), fuzzy.fuzzy_agent_match(nov, cal)
    out = set()

    def add(section, df, values, key=None, detail=None):
        for r in df.collect():
            out.update((section, r[key] if key else None, r[detail] if detail else None, v, None if r[v] is None else round(float(r[v]), 9)) for v in values)

    add("meta", base.cc_meta(unified), ["total_cuentas", "total_meta"])
    add("cumplimiento", base.goal_attainment(unified), ["META_$", "Recaudo_Meta", "Faltante", "Cumplimiento"], "CALL_CENTER", "NOMBRE")
    add("rodamiento", base.roll_rate_cc(unified), ["count"], "Rodamiento")
    add("llamadas", cl.call_totals(scoped), ["total_llamadas", "con_respuesta", "sin_respuesta"])
    add("efectividad", cl.call_effectiveness(scoped), ["Total_Intentos", "Con_Respuesta", "Efectividad"], "Call_Center")
    add("umbral", cl.call_threshold(scoped), ["alerta_umbral"])
    add("por_dia", cl.calls_by_day(scoped), ["Total_Llamadas"], "Fecha", "Estado_Respuesta")
    add("mensajeria", ms.msg_effectiveness(messages), ["entregados", "conversaciones", "porcentaje"], "name")
    add("funnel", ms.msg_funnel(messages, nov, base.callcenter_enrich(scope)), ["value"], "name")
    add("kpis", ct.contact_kpis(att), ["total", "sin_asignar"], "top_tipo")
    add("novedades_cc", ct.contacts_by_center(att), ["Cantidad"], "Call_Center")
    add("novedades_tipo", ct.contacts_by_center_type(att), ["Cantidad"], "Call_Center", "Tipo_Novedad")
    add("compromisos", ct.promises_by_state(att, fx.AS_OF_PROMISES), ["Cantidad"], "Call_Center", "Estado_Acuerdo")
    add("filtros", base.facet_values_cc(scope).withColumn("n", F.lit(1)), ["n"], "facet", "value")
    return out


@pytest.mark.parametrize("req", [
    SearchRequest(), SearchRequest(call_center=["CL3"], vigencia=["vigente"], novedades=["Con Novedades"]),
    SearchRequest(zona=["ZZZ"], call_center=["CL1"]), SearchRequest(call_center=["NO HAY"])], ids=["all", "some", "nothing", "no such centre"])
def test_equal_to_the_modules(tables, req):
    detail, contacts, calls, messages, candidates = tables
    got = [tuple(r)[:4] + (None if r.value is None else round(r.value, 9),) for r in
           lm.live_cc_metrics(detail, contacts, calls, messages, req, fx.AS_OF_PROMISES, candidates=candidates).collect()]
    assert len(got) == len(set(got)) and set(got) == plainly(detail, contacts, calls, messages, req)


def test_a_click_reads_each_input_twice_at_most_and_matches_no_names(spark, tables):
    detail, contacts, calls, messages, candidates = tables
    df = lm.live_cc_metrics(detail, contacts, calls, messages, SearchRequest(call_center=["CL1"], franja=["AL DIA"]), fx.AS_OF_PROMISES, candidates=candidates)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    files = {name: t.inputFiles()[0].split("/")[-2] for name, t in zip(["detail", "contacts", "calls", "messages", "candidates"], tables)}
    scans = re.findall(r"Relation \[([^\]]*)\]", plan)
    assert len(set(files.values())) == 5
    # relations are told apart by a column that only they have
    of = {"detail": "Nombre_Call_Center", "contacts": "Tipo_Novedad", "calls": "Estado_Llamada", "messages": "Numero_Telefono", "candidates": "best_score"}
    seen = {name: sum(c + "#" in s for s in scans) for name, c in of.items()}
    seen["contacts"] -= sum("Nombre_Call_Center#" in s and "Tipo_Novedad#" in s for s in scans)
    assert seen["detail"] == 1 and max(seen.values()) <= 2 and min(seen.values()) >= 1  # and once for its clients, before
    assert "token_ratio" not in plan


def test_validity_states_come_from_the_portfolio_or_the_request_is_refused(spark, tables):
    detail, contacts, calls, messages, candidates = tables
    bare, req = detail.drop("Estado_Vigencia"), SearchRequest(vigencia=["vigente"], call_center=["CL1"])
    with pytest.raises(ValueError, match="Estado_Vigencia"):
        lm.live_cc_metrics(bare, contacts, calls, messages, req, fx.AS_OF_PROMISES, candidates=candidates)
    with pytest.raises(ValueError, match="Estado_Vigencia"):
        lm.portfolio_scope_is_empty(bare, req)
    pf = T(spark, SF).portfolio()
    states = {r.Cedula_Cliente for r in pf.where("Estado_Vigencia = 'vigente'").collect()}
    got = lm.filter_portfolio(bare, req, pf)
    want = [r.Credito for r in bare.where("CALL_CENTER_FILTRO = 'CL1'").collect() if r.Cedula_Cliente in states]
    assert sorted(r.Credito for r in got.collect()) == sorted(want) and want
    assert not lm.portfolio_scope_is_empty(bare, req, pf)


def test_choice_among_stored_candidates_is_the_match_on_those_centres(spark):
    names = ["ana maria lopez", "ana lopes", "jose perez", "josé peres gil", "maria lopez", "luz"]
    agents = spark.createDataFrame([(n, f"CL{1 + i % 3}") for i, n in enumerate(names)] + [("ana lopez", "CL3")], "Nombre_Call string, Call_Center string")
    users = spark.createDataFrame([(n,) for n in ["ana maria lopez", "lopez maria", "jose peres", "luz", "zz yy"]], "Nombre_Usuario string")
    kept = fuzzy.center_candidates(users, agents)
    for centers in itertools.chain.from_iterable(itertools.combinations(["CL1", "CL2", "CL3"], k) for k in (1, 2, 3)):
        want = {tuple(r) for r in fuzzy.fuzzy_agent_match(users, agents.where(F.col("Call_Center").isin(*centers))).collect()}
        assert {tuple(r) for r in fuzzy.attribute(users, fuzzy.choose_centers(kept, list(centers))).collect()} == want


def test_a_token_in_a_third_of_the_names(spark, monkeypatch):
    """The hot token is dealt out by a salt; Python sees distinct token pairs only."""
    monkeypatch.setattr(fuzzy, "HOT_USERS", 20)
    users = [f"maria u{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}kq" if i % 3 == 0 else f"x{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}wz" for i in range(300)]
    agents = [("maria ubakq", "CL1"), ("maria", "CL2"), ("maria zzzzzz yyyyyy", "CL3")]
    got = {r.u_name: r.Call_Center for r in fuzzy.user_centers(
        spark.createDataFrame([(u,) for u in set(users)], "u_name string"),
        fuzzy.agent_reference(spark.createDataFrame(agents, "Nombre_Call string, Call_Center string"))).collect()}
    from difflib import SequenceMatcher
    def score(agent, user):
        toks = agent.split()
        return sum(max(SequenceMatcher(None, a, u).ratio() for u in user.split()) for a in toks) / len(toks)
    for u in set(users):
        ok = sorted((a, c) for a, c in agents if score(a, u) >= fuzzy.FUZZY_ACCEPT)
        best = min((-score(a, u), a, c) for a, c in agents)
        want = ok[0][1] if ok else best[2] if -best[0] >= fuzzy.FUZZY_FALLBACK else None
        assert got.get(u) == want, u


def test_bound_is_never_below_the_score(spark):
    import random
    from difflib import SequenceMatcher
    rng = random.Random(3)
    words = ["".join(rng.choice("aeimnorst") for _ in range(rng.randint(2, 9))) for _ in range(80)]
    pairs = [([rng.choice(words) for _ in range(rng.randint(1, 4))], [rng.choice(words) for _ in range(rng.randint(1, 4))]) for _ in range(150)]
    df = spark.createDataFrame(pairs, "a array<string>, u array<string>")
    el = lambda c: F.transform(c, fuzzy._elements)
    for r in df.select("a", "u", fuzzy.score_bound(el("a"), el("u")).alias("b")).collect():
        assert r.b >= sum(max(SequenceMatcher(None, x, y).ratio() for y in r.u) for x in r.a) / len(r.a) - 1e-9


def test_latest_contact_of_a_repeated_key(spark):
    """Rows that repeat a key: the largest date, type and note, however the rows are dealt."""
    rows = [("c", 7, "2024-01-02", "A", "x"), ("c", 7, "2024-01-02", "B", None), ("c", 7, "2024-01-01", "Z", "z"), ("c", 6, "2025-01-01", "Y", "y"), (None, 9, None, "N", "n")]
    df = spark.createDataFrame(rows, "Cedula_Cliente string, seq long, Fecha_Novedad string, Tipo_Novedad string, Novedad string")
    for n in (1, 2, 3, 5):
        assert [tuple(r) for r in base.latest_contact(df.repartition(n)).collect()] == [("c", "B", None)]

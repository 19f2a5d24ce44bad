"""Joins (fan-out, roles, skew-safe) and search (page, literal term)."""

from pyspark.sql import functions as F

from collectra.operators import followups, search
from collectra.operators.joins import left_join_skew_safe


def test_skew_safe_left_join_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "k long, l string")
    right = spark.createDataFrame([(1, "x")] * 50 + [(2, "y"), (None, "z")], "k long, r string")
    a = sorted(map(tuple, left_join_skew_safe(left, right, ["k"]).collect()), key=str)
    b = sorted(map(tuple, left.join(right, "k", "left").select("k", "l", "r").collect()), key=str)
    assert a == b
    assert len(a) == 100 + 1 + 1 + 1


def test_skew_safe_left_join_two_keys_with_nulls(spark):
    left = spark.createDataFrame([(1, "r", "a"), (1, None, "b"), (None, "r", "c"), (2, "s", "d"), (None, None, "e"),
                                  (3, "t", "f")], "k long, g string, l string")
    right = spark.createDataFrame([(1, "r", "x")] * 20 + [(1, None, "y"), (None, "r", "z"), (2, "s", "w")],
                                  "k long, g string, r string")
    a = sorted(map(tuple, left_join_skew_safe(left, right, ["k", "g"]).collect()), key=str)
    b = sorted(map(tuple, left.join(right, ["k", "g"], "left").select("k", "g", "l", "r").collect()), key=str)
    assert a == b and len(a) == 20 + 5


def test_roles_join(spark):
    base = spark.createDataFrame([("1", "L1", "CON GESTIÓN"), ("2", "L2", "CON GESTIÓN"), ("3", "L3", "SIN GESTIÓN")],
                                 "Cedula_Cliente string, Credito string, Estado_Gestion string")
    contacts = spark.createDataFrame([("1", "GESTOR"), ("1", "ABOGADO"), ("1", "GESTOR")],
                                     "Cedula_Cliente string, Cargo_Usuario string")
    merged = followups.join_client_roles(base, contacts)
    rows = sorted((r.Credito, r.Cargo_Usuario) for r in merged.collect())
    assert rows == [("L1", "ABOGADO"), ("L1", "GESTOR"), ("L2", "SIN ASIGNAR"), ("L3", "SIN ASIGNAR")]
    valid = sorted(r.Credito for r in followups.valid_assignment(merged).collect())
    assert valid == ["L1", "L1", "L3"]


def test_page_bounds():
    assert search.page_bounds(45, 0, 20) == (1, 3)
    assert search.page_bounds(45, 9, 20) == (3, 3)
    assert search.page_bounds(0, 4, 20) == (1, 0)


def test_search_literal_and_regex(spark):
    df = spark.createDataFrame([("axb",), ("a.b",)], "Nombre_Cliente string")
    lit = [r[0] for r in search.search_text(df, "a.b").collect()]
    rx = sorted(r[0] for r in search.search_text(df, "a.b", regex=True).collect())
    assert lit == ["a.b"] and rx == ["a.b", "axb"]


def test_search_page_rows(spark):
    df = spark.range(45).select(F.col("id").cast("string").alias("Credito"), F.lit("CL1").alias("Zona"))
    p = search.search_page(df, search.SearchRequest(page=5, page_size=20), ["Credito"]).collect()
    assert len(p) == 5 and p[0].pagina_actual == 3 and p[0].total_paginas == 3 and p[0].total_registros == 45


def test_role_predicate_unassigned(spark):
    df = spark.createDataFrame([("GESTOR",), (None,), ("",), ("ABOGADO",)], "Cargo_Usuario string")
    got = df.where(search.role_predicate(df, ["SIN ASIGNAR"], excluded=["ABOGADO"])).count()
    assert got == 2


def test_empty_filter_gives_metrics_of_nothing(spark):
    """A filter that matches nothing reports nothing; ``parity`` keeps the other reading."""
    from collectra.operators.callcenter import base
    from collectra.operators.search import SearchRequest
    from collectra.plans.live_metrics import live_cc_metrics
    from collectra.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    contacts, calls = fx.contacts(spark, sf), fx.calls(spark, sf)
    detail = base.management_detail(fx.portfolio(spark, sf), contacts)
    req = SearchRequest(zona=["ZZZ"], call_center=["CL1"])

    def metrics(**kw):
        return {(r.seccion, r.metric): r.value for r in live_cc_metrics(detail, contacts, calls, fx.messages(spark, sf), req, fx.AS_OF_PROMISES, **kw)
                .where("seccion IN ('meta', 'kpis', 'llamadas')").collect()}

    got, other = metrics(), metrics(parity=True)
    assert got["meta", "total_cuentas"] == 0 and got["kpis", "total"] == 0
    assert other["kpis", "total"] == contacts.count() and other["llamadas", "total_llamadas"] > got["llamadas", "total_llamadas"]


def test_scope_probe_without_semi_join_agrees(spark):
    """The live-metrics emptiness probe skips the validity semi join; it must
    agree with probing the filtered scope itself, empty scopes included."""
    from collectra.operators.search import SearchRequest
    from collectra.plans.live_metrics import filter_portfolio, portfolio_scope_is_empty, scope_is_empty
    from collectra.sources import fixtures as fx
    pf = fx.portfolio(spark, "/root/testdata/sf0.001")
    reqs = [SearchRequest(), SearchRequest(vigencia=["vigente"]), SearchRequest(vigencia=["no existe"]),
            SearchRequest(zona=["CL1"], vigencia=["anticipado"]), SearchRequest(zona=["ZZZ"], vigencia=["vigente"]),
            SearchRequest(call_center=["CL1", "CL5"], franja=["AL DIA"], vigencia=["vencido"]),
            SearchRequest(novedades=["Con Novedades"], vigencia=["vigente", "vencido"])]
    seen = set()
    for r in reqs:
        want = scope_is_empty(filter_portfolio(pf, r))
        assert portfolio_scope_is_empty(pf, r) == want, r
        seen.add(want)
    assert seen == {True, False}


def test_pages_of_a_large_result(spark, monkeypatch):
    """First, middle and last page, as a top-k and as a range-partitioned sort."""
    df = spark.range(4_005).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("Credito"), F.col("id").alias("v")).repartition(7)
    for deep in (10_000, 100):
        monkeypatch.setattr(search, "DEEP", deep)
        for page, want in ((1, range(0, 20)), (101, range(2000, 2020)), (10**6, range(4000, 4005))):
            got = search.find_page(df, search.SearchRequest(page=page, page_size=20), ["Credito"])
            assert [r.v for r in got.rows.orderBy("Credito").collect()] == list(want)
            assert (got.total, got.pages, got.page) == (4005, 201, min(page, 201))


def test_an_empty_page_has_its_numbers(spark):
    df = spark.createDataFrame([("1", "CL1")], "Credito string, Zona string")
    got = search.find_page(df, search.SearchRequest(zona=["CL9"], page=4), ["Credito"])
    assert (got.rows.count(), got.total, got.page, got.pages) == (0, 0, 1, 0)


def test_validity_filter_is_never_ignored(spark):
    import pytest
    df = spark.createDataFrame([("1", "c")], "Credito string, Cedula_Cliente string")
    with pytest.raises(ValueError, match="portfolio"):
        search.apply_filters(df, search.SearchRequest(vigencia=["vigente"]))


def test_related_rows_and_lookup(spark):
    df = spark.createDataFrame([("42\t", "Ana Paz", "7"), ("42", "Eva", "8"), ("420", "An.", "9")], "Cedula_Cliente string, Nombre_Cliente string, Credito string")
    assert sorted(r.Credito for r in search.related_rows(df, "Cedula_Cliente", " 42 ").collect()) == ["7", "8"]
    assert [r.Credito for r in search.lookup_clients(df, "an.").collect()] == ["9"]
    assert [r.Credito for r in search.lookup_clients(df, "an.", regex=True).collect()] == ["7", "9"]


def test_charts_and_facets_have_a_total_order(spark):
    from collectra.operators import portfolio as pf
    from collectra.sources import fixtures as fx
    p = fx.portfolio(spark, "/root/testdata/sf0.001")
    fb = followups.followup_base(p)
    facets = [tuple(r) for r in pf.facet_values(p).collect()]
    assert facets == sorted(facets)
    roll = [tuple(str(r[c]) for c in ("Rodamiento", "Empresa", "Regional_Cobro", "Zona")) for r in followups.roll_rate(fb).collect()]
    assert roll == sorted(roll)
    merged = followups.join_client_roles(fb, fx.contacts(spark, "/root/testdata/sf0.001"))
    sun = followups.sunburst(merged, sort=True).collect()
    keys = [(-r.Cantidad, r.Empresa, r.Regional_Cobro, r.Zona, r.Franja_Cartera) for r in sun]
    assert keys == sorted(keys)


def test_every_application_state_is_counted(spark):
    from collectra.operators import commercial
    df = spark.createDataFrame([("v", "F"), ("v", "F"), ("v", "X"), (None, None)], "Nombre_Vendedor string, Estado string")
    assert {(r.Nombre_Vendedor, r.Estado, r["count"]) for r in commercial.application_matrix(df).collect()} == {("v", "F", 2), ("v", "X", 1), (None, None, 1)}

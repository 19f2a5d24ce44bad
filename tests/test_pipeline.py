"""Whole-table invariants, sinks and streaming on the smallest driver tables."""

import datetime as dt

from pyspark.sql import functions as F

from collectra.operators import portfolio as pf
from collectra.operators.callcenter import base, messaging as ms
from collectra.session import fresh_path
from collectra.sources import fixtures as fx
from collectra.sources import store

SF_SMALL = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "Cumplimiento_%" in df.columns


def test_cube_counts_sum_to_rows(spark):
    p = fx.portfolio(spark, SF_SMALL)
    n = p.count()
    assert pf.cube_regional(p).agg(F.sum("count")).first()[0] == n
    assert pf.cube_validity(p).agg(F.sum("count")).first()[0] == n
    states = {r[0] for r in p.select("Estado_Vigencia").distinct().collect()}
    assert states <= {"vigente", "vencido", "anticipado"}


def test_funnel_monotone(spark):
    f = ms.msg_funnel(fx.messages(spark, SF_SMALL), fx.contacts(spark, SF_SMALL),
                      base.callcenter_enrich(fx.portfolio(spark, SF_SMALL))).orderBy("stage").collect()
    v = [r.value for r in f]
    assert len(v) == 4 and v[0] > v[1] > v[2] > v[3] > 0


def test_detail_roundtrip_and_summary(spark):
    root = fresh_path(spark, "test-store")
    p = fx.portfolio(spark, SF_SMALL)
    store.write_detail(p, root, "detallados_cartera", "j1", ["Credito", "Zona", "Bogus"])
    store.write_detail(p.limit(3), root, "detallados_cartera", "j2", ["Credito", "Zona"])
    back = store.resolve_dataset(spark, root, "detallados_cartera", "j1")
    assert back.columns == ["Credito", "Zona"] and back.count() == p.count()
    s = pf.cube_regional(p)
    store.write_summary(s, root, "cartera", "j1", "ACME", dt.datetime(2024, 1, 1))
    r = store.read_summary(spark, root, "cartera", "j1", schema=s.schema)
    assert r.count() == s.count()


def test_stored_jobs_are_apart(spark):
    """A job has its own columns; an empty rewrite replaces, and is readable."""
    root = fresh_path(spark, "test-store")
    a = spark.createDataFrame([("1", "x")], "Credito string, Zona string")
    store.write_detail(a.drop("Zona"), root, "comercial_cosechas", "j1")
    store.write_detail(a, root, "comercial_cosechas", "j2")
    assert store.resolve_dataset(spark, root, "comercial_cosechas", "j2").columns == ["Credito", "Zona"]
    assert store.resolve_dataset(spark, root, "comercial_cosechas", "j1").columns == ["Credito"]
    store.write_detail(a.limit(0), root, "comercial_cosechas", "j2")
    assert store.resolve_dataset(spark, root, "comercial_cosechas", "j2").count() == 0
    assert store.resolve_dataset(spark, root, "comercial_cosechas", "j1").count() == 1
    store.write_summary(a, root, "cartera/uno", "j1")
    store.write_summary(a.drop("Zona"), root, "cartera/dos", "j1")
    store.write_summary(a, root, "cartera/uno", "j2")
    store.write_summary(a.limit(0), root, "cartera/uno", "j1")
    module = store.read_module(spark, root, "cartera", "j1")
    assert sorted(module) == ["dos", "uno"] and module["uno"].count() == 0 and "Zona" in module["uno"].columns
    assert module["dos"].first().Credito == "1" and store.read_summary(spark, root, "cartera/uno", "j2").count() == 1


def test_landed_cells_and_columns(spark):
    """Line breaks stay in a cell, absent columns stay away, the sheet's order comes back."""
    from collectra.operators.callcenter import base
    from collectra.operators.cleaning import clean_contacts
    from collectra.schemas import CONTACT_SCHEMA
    from collectra.sources.landing import land_as_text, scan_sheet
    raw = spark.createDataFrame([(1, "7", "2024-01-05", "COMPROMISO", "uno\nlinea dos"), (2, "7", "2024-01-05", "AUSENCIA", None)],
                                "seq long, Cedula_Cliente string, Fecha_Novedad string, Tipo_Novedad string, Novedad string")
    for fmt in ("parquet", "csv"):
        path = land_as_text(raw, fresh_path(spark, "landed"), fmt=fmt, row="seq")
        sheet = scan_sheet(spark, path, CONTACT_SCHEMA, fmt=fmt, order_col="seq")
        rows = sheet.orderBy("seq").collect()
        assert [r.Novedad for r in rows] == ["uno\nlinea dos", None] and "Empresa" not in sheet.columns
        last = base.latest_contact(clean_contacts(sheet)).collect()
        assert [(r.Cedula_Cliente, r.Tipo_Novedad) for r in last] == [("7", "AUSENCIA")]


def test_absent_columns_meet_their_defaults(spark):
    from collectra.operators import results
    from collectra.operators.cleaning import clean_portfolio, enrich_portfolio
    raw = fx.portfolio_raw(spark, SF_SMALL).drop("Empresa", "Franja_Cartera", "Zona_Cobro", "Fecha_Desembolso")
    p = enrich_portfolio(clean_portfolio(raw))
    assert results.default_dims(p).select("Empresa").distinct().count() == 1
    assert pf.cube_collection(p).count() == 0 and pf.cube_disbursement(p, fx.AS_OF_PORTFOLIO, min_year=1995).count() == 0


def test_ingest_of_a_folder_of_files(spark, tmp_path):
    """The events table as a folder of part files, and a second run that finds more."""
    from collectra.streaming.ingest import ingest_call_drops, ingest_new_drops
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    e.repartition(5).write.parquet(f"{tmp_path}/events.parquet")
    both = [{tuple(r) for r in ingest_call_drops(spark, sf).collect()} for sf in (SF_SMALL, str(tmp_path))]
    assert both[0] == both[1] and both[0]
    out, ckpt, land = (f"{tmp_path}/{x}" for x in ("out", "ckpt", "land"))
    for n in (30, 12):  # the checkpoint knows what is done: a replay adds nothing
        spark.range(n).repartition(3).write.mode("append").parquet(land)
        ingest_new_drops(spark, land, spark.range(1).schema, lambda b: b.groupBy().count(), out, ckpt, files_per_batch=2)
        ingest_new_drops(spark, land, spark.range(1).schema, lambda b: b.groupBy().count(), out, ckpt, files_per_batch=2)
    assert spark.read.parquet(out).agg(F.sum("count")).first()[0] == 42


def test_streaming_ingest(spark):
    from collectra.streaming.ingest import ingest_call_drops
    out = ingest_call_drops(spark, SF_SMALL)
    calls = fx.calls(spark, SF_SMALL).where(F.col("Call_Center_Limpio") != "SIN DATO").count()
    assert out.agg(F.sum("Total_Intentos")).first()[0] == calls


def test_run_report(spark):
    from collectra.plans.pipeline import run_report
    root = fresh_path(spark, "test-report")
    raw = {"portfolio": fx.portfolio_raw(spark, SF_SMALL), "contacts": fx.contacts_raw(spark, SF_SMALL),
           "calls": fx.calls_raw(spark, SF_SMALL), "messages": fx.messages_raw(spark, SF_SMALL),
           "applications": fx.applications_raw(spark, SF_SMALL)}
    res = run_report(spark, raw, root, "job-x", "ACME", fx.AS_OF_PORTFOLIO, fx.AS_OF_PROMISES, min_year=1995)
    assert res["errors"] == {}
    assert "manifest" in res["outputs"]
    m = store.read_manifest(spark, root).first()
    assert m.active_job_id == "job-x" and m.creditos == fx.portfolio(spark, SF_SMALL).count()
    z = store.read_summary(spark, root, "resultados/zona", "job-x")
    assert z.count() > 0
    assert {"cubo_regional", "filtros"} <= set(store.read_module(spark, root, "cartera", "job-x"))
    # search and live metrics run on what the job has stored
    from collectra.operators.search import SearchRequest, search_stored
    from collectra.plans.live_metrics import live_cc_metrics, stored_cc_metrics
    page = search_stored(spark, root, "job-x", SearchRequest(origen="cartera", zona=["CL1"], vigencia=["vigente"]), ["Credito"])
    assert page.total > 0 and page.rows.count() == min(20, page.total)
    req = SearchRequest(call_center=["CL1", "CL2"])
    nov, calls, msgs = fx.contacts(spark, SF_SMALL), fx.calls(spark, SF_SMALL), fx.messages(spark, SF_SMALL)
    detail = base.management_detail(fx.portfolio(spark, SF_SMALL), nov)
    live, direct = ({tuple(r) for r in df.collect()} for df in (
        stored_cc_metrics(spark, root, "job-x", req, fx.AS_OF_PROMISES), live_cc_metrics(detail, nov, calls, msgs, req, fx.AS_OF_PROMISES)))
    assert live == direct and len({r[0] for r in live}) == 14


def test_run_landed_report(spark):
    """Sheets landed as text CSV -> declared-schema scan -> full report."""
    from collectra.plans.pipeline import SHEETS, run_landed_report
    from collectra.sources.landing import land_as_text
    landing = fresh_path(spark, "test-landing")
    raw = {"portfolio": fx.portfolio_raw(spark, SF_SMALL), "contacts": fx.contacts_raw(spark, SF_SMALL),
           "calls": fx.calls_raw(spark, SF_SMALL), "messages": fx.messages_raw(spark, SF_SMALL),
           "applications": fx.applications_raw(spark, SF_SMALL)}
    for k, df in raw.items():
        land_as_text(df, f"{landing}/{SHEETS[k]}", row="seq" if "seq" in df.columns else None)
    root = fresh_path(spark, "test-landed-out")
    res = run_landed_report(spark, landing, root, "job-l", "ACME", fx.AS_OF_PORTFOLIO, fx.AS_OF_PROMISES,
                            min_year=1995)
    assert res["errors"] == {}
    direct = pf.cube_regional(fx.portfolio(spark, SF_SMALL))
    landed = store.read_summary(spark, root, "cartera/cubo_regional", "job-l", schema=direct.schema)
    cols = ["Empresa", "Zona", "Franja_Meta", "count", "Total_Recaudo"]
    a = sorted(map(tuple, direct.select(*cols).collect()), key=str)
    b = sorted(map(tuple, landed.select(*cols).collect()), key=str)
    assert a == b


def test_ingest_report_drops(spark):
    """Manifests of landed reports drive the pipeline once each; bad drops are recorded."""
    import json
    import os
    from collectra.plans.pipeline import SHEETS
    from collectra.sources.landing import land_as_text
    from collectra.streaming.ingest import ingest_report_drops
    landing = fresh_path(spark, "test-drop-landing")
    raw = {"portfolio": fx.portfolio_raw(spark, SF_SMALL), "contacts": fx.contacts_raw(spark, SF_SMALL),
           "calls": fx.calls_raw(spark, SF_SMALL), "messages": fx.messages_raw(spark, SF_SMALL),
           "applications": fx.applications_raw(spark, SF_SMALL)}
    for k, df in raw.items():
        land_as_text(df, f"{landing}/{SHEETS[k]}", row="seq" if "seq" in df.columns else None)
    drops = fresh_path(spark, "test-drops")
    os.makedirs(drops)
    big = 26 * 1024 * 1024  # a report of any size is taken
    for i, (job, name, size, at) in enumerate([("job-lost", "Reporte_General Dos.xlsx", 10, f"{landing}-missing"),
                                              ("job-ok", "Reporte_General Enero.xlsx", big, landing), ("job-bad", "Ventas_2026.xlsx", 1000, landing)]):
        with open(f"{drops}/drop-{i}.json", "w") as f:
            json.dump({"job_id": job, "landing": at, "file_name": name, "size": size, "empresa": "ACME"}, f)
    root, ckpt = fresh_path(spark, "test-drop-out"), fresh_path(spark, "test-drop-ckpt")
    n = ingest_report_drops(spark, drops, root, ckpt, fx.AS_OF_PORTFOLIO, fx.AS_OF_PROMISES, min_year=1995)
    assert n == 1
    assert store.read_manifest(spark, root).first().active_job_id == "job-ok"
    rej = spark.read.parquet(f"{root}/rejected_drops").collect()
    assert [(r.job_id, r.reason) for r in rej] == [("job-bad", "name")]
    lost = spark.read.parquet(f"{root}/failed_drops").collect()
    assert [r.job_id for r in lost] == ["job-lost"] and lost[0].errors
    # a second run finds nothing new
    assert ingest_report_drops(spark, drops, root, ckpt, fx.AS_OF_PORTFOLIO, fx.AS_OF_PROMISES, min_year=1995) == 0

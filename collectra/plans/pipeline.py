"""Batch run of one report: load -> clean -> modules -> summaries, details, masters, manifest.

The cleaned portfolio and contact log are written once under the job's
stage folder and every module reads them back (lineage cut, survives
executor loss).  Modules are independent Spark jobs submitted from a small
driver thread pool; each output is captured separately, so one failing
output does not lose the others.  The manifest is written only when every
output succeeded.
"""

from __future__ import annotations

import datetime as _dt
import functools
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from collectra.operators import commercial, followups, portfolio as pf, results
from collectra.operators.callcenter import base, calls as cl, contacts as ct, fuzzy, messaging as ms
from collectra.operators.cleaning import (clean_applications, clean_calls, clean_contacts, clean_messages,
                                          clean_portfolio, enrich_portfolio)
from collectra.session import fresh_path
from collectra.sources import indexes, store


def _stage(spark: SparkSession, df: DataFrame, root: str, job_id: str, name: str) -> DataFrame:
    path = f"{root}/_stage/{job_id}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def run_report(spark: SparkSession, raw: dict, root: str, job_id: str, empresa: str, as_of,
               promises_as_of=None, workers: int = 4, min_year: int = 2018, center: str | None = None) -> dict:
    """``raw``: landed tables ``portfolio, contacts, calls, messages, applications``.
    ``center``: restricts the contact KPIs to one call centre (all, if not given)."""
    as_of = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    promises_as_of = promises_as_of or as_of
    p = _stage(spark, enrich_portfolio(clean_portfolio(raw["portfolio"])), root, job_id, "portfolio")
    nov = _stage(spark, clean_contacts(raw["contacts"]), root, job_id, "contacts")
    # every landed sheet is parsed once
    calls = _stage(spark, clean_calls(raw["calls"]), root, job_id, "calls")
    msgs = _stage(spark, clean_messages(raw["messages"]), root, job_id, "messages")
    apps = _stage(spark, clean_applications(raw["applications"]), root, job_id, "applications") \
        if raw.get("applications") is not None else None

    fb = followups.followup_base(p)
    merged = followups.join_client_roles(fb, nov)
    cc_p = base.callcenter_enrich(p)
    unified = base.management_base(p)
    scoped = cl.call_scope(calls)
    vint = commercial.vintage_early_risk(p, as_of)
    refi = commercial.refinance_candidates(p)

    # scored once: attribution now and live metrics later choose among these
    @functools.cache
    def candidates():
        return _stage(spark, fuzzy.center_candidates(nov, calls), root, job_id, "candidates")

    def attributed():
        return fuzzy.attribute(nov, fuzzy.choose_centers(candidates()))

    summaries = {
        "cartera/cubo_regional": lambda: pf.cube_regional(p),
        "cartera/cubo_cobro": lambda: pf.cube_collection(p),
        "cartera/cubo_desembolso": lambda: pf.cube_disbursement(p, as_of, min_year=min_year),
        "cartera/cubo_vigencia": lambda: pf.cube_validity(p),
        "cartera/filtros": lambda: pf.facet_values(p),
        "seguimientos/donut": lambda: followups.donut_payment(fb),
        "seguimientos/rodamiento": lambda: followups.roll_rate(fb),
        "seguimientos/sunburst": lambda: followups.sunburst(merged),
        "seguimientos/pago": lambda: followups.sunburst(merged, "PAGO"),
        "seguimientos/sin_pago": lambda: followups.sunburst(merged, "SIN PAGO"),
        "resultados/zona": lambda: results.results_by_zone(fb),
        "resultados/cobrador": lambda: results.results_by_collector(fb),
        "comercial/cosechas": lambda: commercial.vintage_sections(vint),
        "comercial/retanqueos": lambda: commercial.refinance_total(refi),
        "call_center/cumplimiento": lambda: base.goal_attainment(unified),
        "call_center/rodamiento": lambda: base.roll_rate_cc(unified),
        "call_center/meta": lambda: base.cc_meta(unified),
        "call_center/llamadas": lambda: cl.call_totals(scoped),
        "call_center/efectividad": lambda: cl.call_effectiveness(scoped),
        "call_center/umbral": lambda: cl.call_threshold(scoped),
        "call_center/por_dia": lambda: cl.calls_by_day(scoped),
        "call_center/mensajeria": lambda: ms.msg_effectiveness(msgs),
        "call_center/funnel": lambda: ms.msg_funnel(msgs, nov, cc_p),
        "call_center/clientes_con_pago": lambda: ms.paying_client_count(msgs, nov, cc_p),
        "call_center/grafico_llamadas": lambda: cl.call_totals_long(scoped),
        "call_center/filtros": lambda: base.facet_values_cc(base.management_detail(p, nov)),
        "seguimientos/filtros": lambda: pf.facet_values(fb),
    }
    if apps is not None:
        summaries["comercial/fnz"] = lambda: commercial.application_summary(apps)
        summaries["comercial/fnz_matriz"] = lambda: commercial.application_matrix(apps)

    def one(name, build):
        try:
            return name, store.write_summary(build(), root, name, job_id, empresa), None
        except Exception as e:  # noqa: BLE001  (per-output capture)
            return name, None, str(e)[:500]

    out, errors = {}, {}
    with ThreadPoolExecutor(max_workers=workers) as pool:
        for name, path, err in pool.map(lambda kv: one(*kv), summaries.items()):
            (errors.__setitem__(name, err) if err else out.__setitem__(name, path))

    # contact KPIs share one attributed log: stage it once
    try:
        att = ct.center_filter(_stage(spark, attributed(), root, job_id, "attributed"), center)
        for name, build in {"call_center/novedades_cc": lambda: ct.contacts_by_center(att),
                            "call_center/novedades_tipo": lambda: ct.contacts_by_center_type(att),
                            "call_center/compromisos": lambda: ct.promises_by_state(att, promises_as_of),
                            "call_center/kpis": lambda: ct.contact_kpis(att)}.items():
            n, path, err = one(name, build)
            (errors.__setitem__(n, err) if err else out.__setitem__(n, path))
    except Exception as e:  # noqa: BLE001
        errors["call_center/novedades"] = str(e)[:500]

    @functools.cache
    def clients():
        return indexes.client_numbers(p, fresh_path(spark, "clients"))

    @functools.cache
    def detail():
        return _stage(spark, followups.followup_detail(p, nov, clients()), root, job_id, "detail")

    details = {
        "detallados_call_center": lambda: store.write_detail(base.management_detail(p, nov), root,
                                                             "detallados_call_center", job_id),
        # what live metrics read back for the job
        "novedades_base": lambda: store.write_detail(nov, root, "novedades_base", job_id),
        "llamadas_base": lambda: store.write_detail(calls, root, "llamadas_base", job_id),
        "mensajes_base": lambda: store.write_detail(msgs, root, "mensajes_base", job_id),
        "candidatos_centro": lambda: store.write_detail(candidates(), root, "candidatos_centro", job_id),
        "comercial_retanqueos": lambda: store.write_detail(refi, root, "comercial_retanqueos", job_id),
        "comercial_cosechas": lambda: store.write_detail(vint, root, "comercial_cosechas", job_id),
        "masters": lambda: store.master_tables(root, job_id, fb, detail(), nov),
        "busqueda": lambda: store.search_tables(root, job_id, detail(), p, clients()),
    }
    if apps is not None:
        details["comercial_fnz"] = lambda: store.write_detail(apps, root, "comercial_fnz", job_id)
    for name, fn in details.items():
        try:
            out[name] = fn()
        except Exception as e:  # noqa: BLE001
            errors[name] = str(e)[:500]

    if not errors:
        stats = p.agg({"*": "count"}).withColumnRenamed("count(1)", "creditos")
        out["manifest"] = store.write_manifest(spark, root, job_id, empresa,
                                               _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), stats)
    return {"outputs": out, "errors": errors}


SHEETS = {"portfolio": "Analisis_de_Cartera", "contacts": "Detalle_Novedades", "calls": "Reporte_Llamadas",
          "messages": "Reporte_Mensajes", "applications": "FNZ007"}


def read_landed_report(spark: SparkSession, landing_dir: str, fmt: str = "parquet") -> dict:
    """The five sheets of one landed report (``<landing_dir>/<sheet name>/``),
    read as text with the declared schemas (no inference)."""
    from collectra.schemas import (APPLICATION_SCHEMA, CALL_SCHEMA, CONTACT_SCHEMA, MESSAGE_SCHEMA,
                                   PORTFOLIO_SCHEMA)
    from collectra.sources.landing import scan_sheet
    from pyspark.sql import types as T

    def text_dates(schema):  # raw sheets keep dates as text; cleaning parses them
        return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType)
                                           else f.dataType) for f in schema.fields])
    schemas = {"portfolio": text_dates(PORTFOLIO_SCHEMA), "contacts": text_dates(CONTACT_SCHEMA),
               "calls": text_dates(CALL_SCHEMA), "messages": text_dates(MESSAGE_SCHEMA),
               "applications": APPLICATION_SCHEMA}
    # the instalment text column is parsed by the cleaning step, keep it text
    schemas["portfolio"] = T.StructType([f if f.name != "Valor_Cuota_Vigente" else
                                         T.StructField(f.name, T.StringType()) for f in schemas["portfolio"].fields])
    return {k: scan_sheet(spark, f"{landing_dir.rstrip('/')}/{SHEETS[k]}", schemas[k], fmt=fmt,
                          order_col="seq" if k in ("contacts", "calls", "messages") else None)
            for k in SHEETS}


def landed_errors(spark: SparkSession, landing_dir: str, fmt: str = "parquet") -> DataFrame:
    """Sheets, files and cells of a landed report that could not be read, with the reason."""
    from collectra.schemas import (APPLICATION_SCHEMA, CALL_SCHEMA, CONTACT_SCHEMA, MESSAGE_SCHEMA, PORTFOLIO_SCHEMA)
    from collectra.sources.landing import sheet_errors
    from pyspark.sql import types as T

    # the instalment holds more than numbers on purpose (the prepaid mark)
    portfolio = T.StructType([f for f in PORTFOLIO_SCHEMA.fields if f.name != "Valor_Cuota_Vigente"])
    schemas = {"portfolio": portfolio, "contacts": CONTACT_SCHEMA, "calls": CALL_SCHEMA, "messages": MESSAGE_SCHEMA, "applications": APPLICATION_SCHEMA}
    return functools.reduce(DataFrame.unionByName, [
        sheet_errors(spark, SHEETS[k], f"{landing_dir.rstrip('/')}/{SHEETS[k]}", schemas[k], fmt) for k in SHEETS])


def run_landed_report(spark: SparkSession, landing_dir: str, root: str, job_id: str, empresa: str,
                      as_of, promises_as_of=None, **kw) -> dict:
    """The report of a landing folder.  What cannot be read of it is stored with the
    job (``errores_carga``) and the rest goes on; a landing without any readable
    sheet is an error."""
    from pyspark.sql import functions as F

    store.write_detail(landed_errors(spark, landing_dir), root, "errores_carga", job_id)
    errors = store.resolve_dataset(spark, root, "errores_carga", job_id)
    lost = errors.where(F.col("archivo").endswith(F.col("hoja")) & F.col("columna").isNull()).select("hoja").distinct().count()
    if lost == len(SHEETS):
        raise FileNotFoundError(f"no sheet can be read in {landing_dir}")
    return run_report(spark, read_landed_report(spark, landing_dir), root, job_id, empresa, as_of,
                      promises_as_of, **kw)

"""Sheets that cannot be read, and contact state across drops."""

import os

import pytest
from pyspark.sql import functions as F

from collectra.operators.callcenter import base
from collectra.operators.cleaning import clean_contacts
from collectra.schemas import CALL_SCHEMA, CONTACT_SCHEMA
from collectra.session import fresh_path
from collectra.sources import fixtures as fx
from collectra.sources import landing, store
from collectra.streaming import state

SF = "/root/testdata/sf0.001"


def contact_rows(spark, rows):
    return spark.createDataFrame(rows, "seq long, Cedula_Cliente string, Fecha_Novedad string, Tipo_Novedad string, Valor string")


def test_broken_file_and_bad_cells_beside_good_ones(spark):
    path = fresh_path(spark, "sheet")
    landing.land_as_text(contact_rows(spark, [(1, "7", "2024-01-05", "A", "10.5"), (2, "8", "not a date", "B", "ten"), (3, "9", "", "C", None)]).coalesce(1), path, row="seq")
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-broken.parquet", "wb") as f:
        f.write(b"PAR1 this is not parquet")
    sheet = landing.scan_sheet(spark, path, CONTACT_SCHEMA, order_col="seq")
    rows = {r.seq: r for r in sheet.collect()}
    assert sorted(rows) == [1, 2, 3] and rows[1].Valor == 10.5 and rows[2].Valor is None and rows[2].Fecha_Novedad is None
    errors = {(r.hoja, r.fila, r.columna, r.valor, r.motivo) for r in landing.sheet_errors(spark, "Detalle", path, CONTACT_SCHEMA).collect()}
    assert errors == {("Detalle", 2, "Fecha_Novedad", "not a date", "not a date"), ("Detalle", 2, "Valor", "ten", "not a double"),
                      ("Detalle", None, None, None, "FILE_NOT_READABLE")}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_missing_sheet_is_an_empty_typed_table(spark, fmt):
    path = fresh_path(spark, "nowhere")
    sheet = landing.scan_sheet(spark, path, CALL_SCHEMA, fmt=fmt, order_col="seq")
    assert sheet.count() == 0 and sheet.columns == [*CALL_SCHEMA.names, "seq"] and [f.dataType for f in sheet.schema][:-1] == [f.dataType for f in CALL_SCHEMA]
    assert [(r.hoja, r.archivo, r.motivo) for r in landing.sheet_errors(spark, "Llamadas", path, CALL_SCHEMA, fmt).collect()] == [("Llamadas", path, "PATH_NOT_FOUND")]


def test_only_broken_files_are_an_empty_table_too(spark):
    path = fresh_path(spark, "broken")
    os.makedirs(path)
    with open(f"{path}/part-0.parquet", "wb") as f:
        f.write(b"no parquet at all here")
    assert landing.scan_sheet(spark, path, CALL_SCHEMA).count() == 0
    assert landing.sheet_errors(spark, "Llamadas", path, CALL_SCHEMA).count() == 1


def test_report_goes_on_without_a_sheet(spark):
    from collectra.plans.pipeline import SHEETS, run_landed_report
    land, root = fresh_path(spark, "land"), fresh_path(spark, "out")
    for k, df in {"portfolio": fx.portfolio_raw(spark, SF), "contacts": fx.contacts_raw(spark, SF), "calls": fx.calls_raw(spark, SF)}.items():
        landing.land_as_text(df, f"{land}/{SHEETS[k]}", row="seq" if "seq" in df.columns else None)
    res = run_landed_report(spark, land, root, "j", "ACME", fx.AS_OF_PORTFOLIO, fx.AS_OF_PROMISES, min_year=1995)
    assert res["errors"] == {}
    lost = store.resolve_dataset(spark, root, "errores_carga", "j").where("fila is null").collect()
    assert sorted(r.hoja for r in lost) == sorted([SHEETS["messages"], SHEETS["applications"]])
    assert store.read_summary(spark, root, "call_center/mensajeria", "j").count() == 0
    with pytest.raises(FileNotFoundError):
        run_landed_report(spark, f"{land}-nowhere", root, "k", "ACME", fx.AS_OF_PORTFOLIO)


@pytest.mark.parametrize("cuts", [[], [900], [1, 300, 301, 2000]])
def test_drops_in_any_split_give_the_batch_rows(spark, cuts):
    """Also replayed, out of order, and with rows of a drop that came before."""
    log = spark.read.schema(fx.contacts_raw(spark, SF).schema).parquet(_written(spark, fx.contacts_raw(spark, SF)))
    land, out, ckpt = fresh_path(spark, "drops"), fresh_path(spark, "state"), fresh_path(spark, "ckpt")
    n = log.count()
    edges = [0, *cuts, n + 1]
    pieces = [log.where((F.col("seq") >= a) & (F.col("seq") < b)) for a, b in zip(edges, edges[1:])]
    for i, piece in enumerate(reversed(pieces)):  # the latest first
        piece.write.parquet(f"{land}/drop-{i}")
        state.ingest_contacts(spark, land, log.schema, out, ckpt, files_per_batch=2)
        state.ingest_contacts(spark, land, log.schema, out, ckpt)  # nothing new
    pieces[0].write.parquet(f"{land}/again")
    state.ingest_contacts(spark, land, log.schema, out, ckpt)
    clean = clean_contacts(log)
    want = sorted(map(tuple, base.latest_contact(clean).collect()), key=str)
    assert sorted(map(tuple, base.of_last(state.stored_last(spark, out)).collect()), key=str) == want and want
    detail = fx.portfolio(spark, SF).select("Credito", "Cedula_Cliente")
    assert sorted(map(str, state.join_stored_contact(detail, out).collect())) == sorted(map(str, base.join_latest_contact(detail, clean).collect()))


def _written(spark, df):
    path = fresh_path(spark, "log")
    df.write.parquet(path)
    return path

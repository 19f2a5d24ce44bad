"""The source system's own test cases, re-expressed on Spark."""

from collectra.operators import results
from collectra.sources.store import drop_reason


def test_results_by_zone_two_rows(spark):
    rows = [("Empresa A", "Norte", "Z1", "1 A 30", "1 A 30", "CL1", 0, 100.0, 50.0, 0.0, 0.0),
            ("Empresa A", "Norte", "Z1", "1 A 30", "1 A 30", "CL1", 0, 200.0, 100.0, 0.0, 0.0)]
    schema = ("Empresa string, Regional_Cobro string, Zona string, Franja_Meta string, Franja_Cartera string, "
              "CALL_CENTER_FILTRO string, Cantidad_Novedades long, `Meta_$` double, Recaudo_Meta double, "
              "Total_Recaudo_Sin_Anti double, `Meta_T.R_$` double")
    out = results.results_by_zone(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 1
    r = out[0]
    assert r["Meta_Total"] == 300.0 and r["Recaudo_Total"] == 150.0 and r["Cumplimiento_%"] == 0.5
    assert r["Total_Cuentas"] == 2


def test_drop_validation(spark):
    names = ["Reporte_General Enero.xlsx", "Ventas_2026.xlsx", "Reporte_General.csv", "Reporte_General.XLSX"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.reason for r in df.select("name", drop_reason(df.name).alias("reason")).collect()}
    assert got == dict(zip(names, [None, "name", "extension", None]))

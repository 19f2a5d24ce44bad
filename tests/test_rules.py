"""Row-level rules on hand-written edge rows (FIXTURES.md section 4)."""

import datetime as dt

from pyspark.sql import functions as F

from collectra.functions import amounts, states
from collectra.functions.dates import dmy_date, mixed_date
from collectra.functions.text import name_tokens, normalize_phone, strip_ws
from collectra.operators import cleaning, commercial


def col1(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_mixed_dates(spark):
    got = col1(spark, ["2026-02-16 08:31:21", "2026/02/16", "16/02/2026", "", None], mixed_date)
    d = dt.date(2026, 2, 16)
    assert got == [d, d, None, None, None]


def test_amounts(spark):
    vals = ["ANTICIPADO", "1,234.5", "1,234,567", "x", None, "anticipado"]
    assert col1(spark, vals, lambda c: amounts.parse_amount(c)) == [0.0, 1234.5, 1234567.0, 0.0, 0.0, 0.0]
    assert col1(spark, vals, lambda c: amounts.parse_amount(c, parity=True))[2] == 0.0
    assert col1(spark, vals, amounts.prepaid_flag) == ["ANTICIPADO", "NORMAL", "NORMAL", "NORMAL", "NORMAL", "ANTICIPADO"]


def test_phone_and_strip(spark):
    assert col1(spark, ["3001.0", " 3001", None, "30.01"], normalize_phone) == ["3001", "3001", None, "30.01"]
    assert col1(spark, ["\t a b  \n"], strip_ws) == ["a b"]


def test_zone_cascade(spark):
    df = spark.createDataFrame([("cl 1", "CL7"), ("Z9", "cl7"), ("CL7", "CL2")], "Zona string, Call_Center_Apoyo string")
    out = cleaning.assign_call_center(cleaning.normalize_zones(df)).select("CALL_CENTER_FILTRO").collect()
    assert [r[0] for r in out] == ["CL1", "CL7", "SIN CALL CENTER"]


def test_validity_and_substate(spark):
    rows = [("ANTICIPADO", dt.date(2024, 1, 5)), ("NORMAL", dt.date(2024, 1, 10)),
            ("NORMAL", dt.date(2024, 1, 20)), ("NORMAL", dt.date(2024, 1, 21)), ("NORMAL", None)]
    df = spark.createDataFrame(rows, "Tipo_Vigencia_Temp string, Fecha_Cuota_Vigente date")
    df = states.validity_state(df)
    out = df.select("Estado_Vigencia", states.validity_substate(F.col("Estado_Vigencia"), F.col("Fecha_Cuota_Vigente"))).collect()
    assert [tuple(r) for r in out] == [("anticipado", None), ("vigente", "Días 1-10"), ("vigente", "Días 11-20"),
                                       ("vigente", "Días 21+"), ("vencido", None)]


def test_payment_modes(spark):
    df = spark.createDataFrame([("NORMAL", 50000.0), ("NORMAL", 50000.01), ("ANTICIPADO", 90000.0)],
                               "Tipo_Vigencia_Temp string, Total_Recaudo double")
    a = [r[0] for r in states.payment_state(df, "portfolio").select("Estado_Pago").collect()]
    c = [r[0] for r in states.payment_state(df, "callcenter").select("Estado_Pago").collect()]
    assert a == ["SIN PAGO", "PAGO", "ANTICIPADO"]
    assert c == ["SIN PAGO", "PAGO", "PAGO"]
    no_total = spark.createDataFrame([("x",)], "a string")
    assert states.payment_state(no_total, "callcenter").first()["Estado_Pago"] == "SIN DATO"
    assert states.payment_state(no_total, "portfolio").first()["Estado_Pago"] == "SIN PAGO"


def test_refinance_rule(spark):
    ins = [(6, 4), (8, 7), (9, 5), (12, 11)]
    outs = [(6, 6), (6, 3), (9, 9), (12, 7), (5, 4)]
    df = spark.createDataFrame([(float(t), float(p), 0.0, f"{t}-{p}") for t, p in ins + outs],
                               "Total_Cuotas double, Cuotas_Pagadas double, Dias_Atraso_Final double, k string")
    got = sorted(r.k for r in commercial.refinance_candidates(df).collect())
    assert got == sorted(f"{t}-{p}" for t, p in ins)


def test_promise_state(spark):
    as_of = dt.date(2024, 3, 5)
    rows = [(None,), (as_of - dt.timedelta(days=1),), (as_of,)]
    df = spark.createDataFrame(rows, "d date")
    got = [r[0] for r in df.select(states.promise_state(F.col("d"), as_of)).collect()]
    assert got == ["ACUERDOS SIN FECHA", "ACUERDOS VENCIDOS", "ACUERDOS VIGENTES"]
    assert col1(spark, ["05/03/24", "5-3-2024", "bad", None], dmy_date) == [as_of, as_of, None, None]


def test_name_tokens(spark):
    got = col1(spark, ["José  Pérez", "de la", "María Gómez de la Cruz", None], lambda c: F.array_sort(name_tokens(c)))
    assert got == [["jose", "perez"], [], ["cruz", "gomez", "maria"], []]

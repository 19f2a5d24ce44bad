"""Decided readings of source-system quirks (README table), both readings shown."""

import datetime as dt

from pyspark.sql import functions as F

from collectra.functions import amounts
from collectra.functions.dates import dmy_date
from collectra.functions.states import promise_state
from collectra.operators import cleaning, search
from collectra.operators.callcenter import messaging as ms
from collectra.operators.callcenter.base import attribute_centers
from collectra.operators.cleaning import assign_call_center, normalize_zones


def test_first_comma_parity(spark):
    df = spark.createDataFrame([("1,234,567",), ("1,234.5",)], "v string")
    default = [r[0] for r in df.select(amounts.parse_amount(F.col("v"))).collect()]
    parity = [r[0] for r in df.select(amounts.parse_amount(F.col("v"), parity=True)).collect()]
    assert default == [1234567.0, 1234.5]
    assert parity == [0.0, 1234.5]


def test_message_date_is_parsed(spark):
    df = spark.createDataFrame([("2024-01-02 10:00:00",)], "Fecha_Mensaje string")
    assert cleaning.clean_messages(df).first()[0] == dt.date(2024, 1, 2)


def test_promise_dates_both_readings(spark):
    """Source reads the contact date as d-m-y (an ISO date is unreadable ->
    SIN FECHA); we read the promise date column as a date."""
    df = spark.createDataFrame([("2024-01-10", dt.date(2024, 1, 10))], "txt string, d date")
    as_of = dt.date(2024, 1, 15)
    src = df.select(promise_state(F.col("txt"), as_of, is_date=False)).first()[0]
    ours = df.select(promise_state(F.col("d"), as_of)).first()[0]
    assert src == "ACUERDOS SIN FECHA" and ours == "ACUERDOS VENCIDOS"
    assert df.select(dmy_date(F.lit("10-01-2024"))).first()[0] == dt.date(2024, 1, 10)


def test_two_center_rules(spark):
    """Loading assigns own zone (CL1-4) then support (CL5-9); the management
    base takes any CL zone only when up to date, else the support centre."""
    rows = [("CL7", "CL2", "AL DIA"), ("CL2", "CL5", "1 A 30"), ("CL2", "CL5", "AL DIA")]
    df = spark.createDataFrame(rows, "Zona string, Call_Center_Apoyo string, Franja_Meta string") \
        .withColumns({"Cobrador": F.lit("c"), "Nombre_Call_Center": F.lit("a"), "Meta_General": F.lit(1.0),
                      "Meta_$": F.lit(2.0), "Recaudo_Meta": F.lit(0.0)})
    load = [r[0] for r in assign_call_center(normalize_zones(df)).select("CALL_CENTER_FILTRO").collect()]
    mgmt = [r[0] for r in attribute_centers(df).select("CALL_CENTER_FILTRO").collect()]
    assert load == ["SIN CALL CENTER", "CL2", "CL2"]
    assert mgmt == ["CL7", "CL5", "CL2"]


def test_paying_rows_vs_clients(spark):
    """The funnel's last stage counts conversation x client rows; the
    distinct-client count is exposed separately."""
    msgs = spark.createDataFrame([(1, "3001.0", "text", "CL1"), (2, "3001.0", "audio", "CL1")],
                                 "seq long, Numero_Telefono string, Tipo_Respuesta_Agente string, Call_Center string")
    contacts = spark.createDataFrame([("7", "3001", None)], "Cedula_Cliente string, Telefono_Cliente string, Celular_Cliente string")
    pf = spark.createDataFrame([("7", "PAGO")], "Cedula_Cliente string, Estado_Pago string")
    funnel = {r.name: r.value for r in ms.msg_funnel(msgs, contacts, pf).collect()}
    assert funnel["Clientes con Pago"] == 2
    assert ms.paying_client_count(msgs, contacts, pf).first()[0] == 1


def test_excluded_roles_applied(spark):
    df = spark.createDataFrame([("GESTOR",), ("ABOGADO",)], "Cargo_Usuario string")
    assert df.where(search.role_predicate(df, None, excluded=["ABOGADO"])).count() == 1


def test_contact_log_without_role(spark):
    """Quirk 14: no Cargo_Usuario column -> every loan SIN ASIGNAR, detail still built."""
    from collectra.operators import followups
    base = spark.createDataFrame([("1", "L1", 2.0, 60000.0)],
                                 "Cedula_Cliente string, Credito string, Cantidad_Novedades double, Total_Recaudo double")
    contacts = spark.createDataFrame([("1", "hola", 5)], "Cedula_Cliente string, Novedad string, seq long")
    d = followups.followup_detail(base, contacts).collect()
    assert len(d) == 1 and d[0].Cargo_Usuario == "SIN ASIGNAR" and d[0].Novedades_Por_Cargo == 0


def test_state_derived_before_cubes(spark):
    """Quirk 1: a portfolio without Estado_Vigencia still gets it as a cube dimension."""
    from collectra.operators import portfolio as pf
    df = spark.createDataFrame([("E", "1 A 30", None, "NORMAL", 1.0)],
                               "Empresa string, Franja_Meta string, Fecha_Cuota_Vigente date, "
                               "Tipo_Vigencia_Temp string, Total_Recaudo double")
    out = pf.cube_regional(df)
    assert "Estado_Vigencia" in out.columns and out.first().Estado_Vigencia == "vencido"

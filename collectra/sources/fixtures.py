"""Domain tables derived from the driver's TPC-H-like parquet tables.

These play the role of the five landed report sheets (portfolio, contacts,
calls, messages, applications).  They are plain DataFrame plans over the
parquet scans, so column pruning and filter pushdown reach the files.

Scale notes: the portfolio view joins orders with a per-order lineitem
aggregate (both hash-partitioned on the order key) and then with customer
and a per-user events aggregate (both on the customer key), so Catalyst
plans two co-partitioned shuffle joins.  Spark broadcasts ``nation`` and
``region`` by the measured size of their files, or does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# ---------------------------------------------------------------------------
# FIXED VALUES (fixture definitions; see FIXTURES.md)
# ---------------------------------------------------------------------------
AS_OF_PORTFOLIO = "2001-08-01"
AS_OF_PROMISES = "2024-01-15"
ZONE_CODES = ["ZCN", "1AB", "CC01", "1CE", "CEC", "X99"]          # o_orderkey % 7 = 0..5, 6 -> NULL
CONTACT_USERS = ["torres ana", "Luis Rojaz", "DIAZ MARTA", "Jorje Pineda", "Carla Mejía",
                 "Silva Pedro", "Sofia Luna", "Diego Cano", "Ruth Vga"]   # user_id % 9
UNKNOWN_USER = "Xavier Quintero"   # user_id % 10 = 9: like no agent
BAND_USER = "Luis Paz"             # else user_id % 11 = 7: near Luis Rojas, in the fallback band only
CALL_AGENTS = ["Ana Torres", "Luis Rojas", "Marta Diaz", "Jorge Pineda", "Carla Mejia",
               "Pedro Silva", "Sofia Luna", "Diego Cano", "Ruth Vega"]    # user_id % 9
CONTACT_ROLES = ["GESTOR", "CALL CENTER", "ABOGADO", None]                # event_id % 4
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(idx: Column, values) -> Column:
    """``values[idx]`` as a CASE expression (NULL for None entries / out of range)."""
    e = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        e = F.when(idx == i, lit) if e is None else e.when(idx == i, lit)
    return e


def _txt(c: Column) -> Column:
    return c.cast("string")


def portfolio_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, columns as landed (``Valor_Cuota_Vigente`` still text)."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    geo = (table(spark, sf_dir, "nation")
           .join(table(spark, sf_dir, "region"),
                 F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "n_name", "r_name"))
    li = (table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.count_if(F.col("l_linestatus") == "F").alias("nf"),
               F.sum(F.when(F.col("l_returnflag") == "N",
                            F.col("l_extendedprice").cast("decimal(18,2)"))).alias("paid"),
               F.max("l_shipdate").alias("ship")))
    ev = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("nov"))

    base = (o.join(li, o.o_orderkey == li.l_orderkey, "left")
            .join(c, o.o_custkey == c.c_custkey)
            .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(ev, F.col("o_custkey") == F.col("user_id"), "left"))

    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    price2 = F.col("o_totalprice").cast("decimal(18,2)")
    days = F.when(ok % 4 == 0, F.lit(0)).otherwise(ok % 401).cast("double")
    # one client in seven has paid nothing
    total = F.when(ck % 7 == 3, F.lit(0.0)).otherwise(F.coalesce(F.col("paid"), F.lit(0).cast("decimal(18,2)")).cast("double"))
    no_goal = ok % 13 == 0
    goal = lambda f: F.when(no_goal, F.lit(0.0)).otherwise(
        (price2 * F.lit(str(f)).cast("decimal(2,1)")).cast("double"))
    from collectra.functions.states import days_late_bucket
    cuotas = (ok % 12 + 1).cast("double")
    out = base.select(
        F.col("c_mktsegment").alias("Empresa"),
        _txt(ok).alias("Credito"),
        _txt(ck).alias("Cedula_Cliente"),
        F.col("c_name").alias("Nombre_Cliente"),
        F.col("r_name").alias("Regional_Cobro"),
        F.col("r_name").alias("Regional_Venta"),
        F.when(F.col("n_nationkey") < 9, F.concat(F.lit("CL"), _txt(F.col("n_nationkey") + 1)))
        .otherwise(F.col("n_name")).alias("Zona"),
        F.when(ck % 2 == 0, F.concat(F.lit("CL"), _txt(ck % 9 + 1))).otherwise(F.lit("SIN APOYO"))
        .alias("Call_Center_Apoyo"),
        F.concat(F.lit("Cobrador "), _txt(ck % 20)).alias("Cobrador"),
        F.concat(F.lit("Agente "), _txt(ck % 9)).alias("Nombre_Call_Center"),
        F.concat(F.lit("Vendedor "), _txt(ck % 15)).alias("Nombre_Vendedor"),
        _pick(ok % 7, ZONE_CODES).alias("Zona_Cobro"),
        days.alias("Dias_Atraso_Final"),
        days_late_bucket(days).alias("Franja_Meta"),
        days_late_bucket(days).alias("Franja_Cartera"),
        cuotas.alias("Total_Cuotas"),
        F.least(cuotas, (F.coalesce(F.col("nf"), F.lit(0)) + ok % 2).cast("double")).alias("Cuotas_Pagadas"),
        F.col("o_totalprice").alias("Valor_Desembolso"),
        F.to_date("o_orderdate").alias("Fecha_Desembolso"),
        F.when(ok % 10 == 0, F.lit("ANTICIPADO")).when(ok % 7 == 3, F.format_number(price2, 2))
        .when(ok % 7 == 5, F.format_number(price2 * 100, 2)).otherwise(_txt(price2)).alias("Valor_Cuota_Vigente"),
        F.when(F.col("o_orderstatus") != "F", F.to_date("ship")).alias("Fecha_Cuota_Vigente"),
        total.alias("Total_Recaudo"),
        F.when(ok % 10 == 0, F.lit(0.0)).otherwise(total).alias("Total_Recaudo_Sin_Anti"),
        goal(0.5).alias("Meta_$"),
        goal(0.4).alias("Meta_General"),
        goal(0.6).alias("Meta_T.R_$"),
        F.least(total, goal(0.5)).alias("Recaudo_Meta"),
        F.when(F.col("o_orderstatus") == "P", F.lit("MEJORA"))
        .when(F.col("o_orderstatus") == "F", F.lit("EMPEORA"))
        .when(F.col("o_orderstatus") == "O", F.lit("NORMALIZO")).alias("Rodamiento"),
        F.col("nov").cast("double").alias("Cantidad_Novedades"),
    )
    return out


def contacts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contacts_from_events(table(spark, sf_dir, "events"))


def contacts_from_events(e: DataFrame) -> DataFrame:
    uid, eid, et = F.col("user_id"), F.col("event_id"), F.col("event_type")
    return e.select(
        eid.alias("seq"),
        _txt(uid).alias("Cedula_Cliente"),
        F.to_date("ts").alias("Fecha_Novedad"),
        F.when(uid % 10 == 9, F.lit(UNKNOWN_USER)).when(uid % 11 == 7, F.lit(BAND_USER))
        .otherwise(_pick(uid % 9, CONTACT_USERS)).alias("Nombre_Usuario"),
        _pick(eid % 4, CONTACT_ROLES).alias("Cargo_Usuario"),
        F.when(et == "purchase", F.lit("COMPROMISO DE PAGO")).when(et == "error", F.lit("AUSENCIA"))
        .when(et == "view", F.lit("NOVEDAD")).otherwise(F.lit("PAGO")).alias("Tipo_Novedad"),
        F.col("props").alias("Novedad"),
        F.when((et == "purchase") & (eid % 5 != 0), F.to_date("ts")).alias("Fecha_Compromiso"),
        F.when(uid % 4 == 1, F.concat(F.lit("300"), _txt(uid), F.lit(".0")))
        .when(uid % 4 > 1, F.concat(F.lit("300"), _txt(uid))).alias("Telefono_Cliente"),
        F.when(uid % 8 == 0, F.concat(F.lit("300"), _txt(uid)))
        .when(uid % 6 == 1, F.concat(F.lit("3110"), _txt(uid % 3))).alias("Celular_Cliente"),
        F.col("value").alias("Valor"),
    )


def calls_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls_from_events(table(spark, sf_dir, "events"))


def calls_from_events(e: DataFrame) -> DataFrame:
    uid, et = F.col("user_id"), F.col("event_type")
    return e.select(
        F.col("event_id").alias("seq"),
        F.to_date("ts").alias("Fecha_Llamada"),
        F.when(et == "click", F.lit(" answered ")).when(et == "error", F.lit(None).cast("string"))
        .otherwise(F.lit("NO ANSWER")).alias("Estado_Llamada"),
        F.when(uid % 11 == 10, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" cl"), _txt(uid % 9 + 1), F.lit(" "))).alias("Call_Center"),
        _pick(uid % 9, CALL_AGENTS).alias("Nombre_Call"),
    )


def messages_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_events(table(spark, sf_dir, "events"))


def messages_from_events(e: DataFrame) -> DataFrame:
    """One message per event (the whole table; no id subset)."""
    uid, et = F.col("user_id"), F.col("event_type")
    return e.select(
        F.col("event_id").alias("seq"),
        F.col("ts").alias("Fecha_Mensaje"),
        F.concat(F.lit("300"), _txt(uid), F.lit(".0")).alias("Numero_Telefono"),
        F.when(et == "view", F.lit(" Text")).when(et == "click", F.lit("audio"))
        .when(et == "error", F.lit(None).cast("string")).otherwise(F.lit("template"))
        .alias("Tipo_Respuesta_Agente"),
        F.when(uid % 11 == 10, F.lit("SIN DATO")).otherwise(F.concat(F.lit("CL"), _txt(uid % 9 + 1)))
        .alias("Call_Center"),
    )


def applications_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy column names, before renaming."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                             "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    geo = (table(spark, sf_dir, "nation")
           .join(table(spark, sf_dir, "region"),
                 F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "r_name"))
    ck = F.col("o_custkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                _txt(F.col("o_orderkey")).alias("PAGARE"),
                F.col("o_orderstatus").alias("ESTADO"),
                F.concat(F.lit("Analista "), _txt(ck % 6)).alias("ANALISTA"),
                F.col("r_name").alias("REGIONAL"),
                F.concat(F.lit("Vendedor "), _txt(ck % 15)).alias("VENNOMBRE"),
                _txt(ck).alias("CEDULA"),
                F.col("o_totalprice").alias("VALOR_TOTA"),
                _txt(F.to_date("o_orderdate")).alias("FS1NACFEC"),
            ))


# --- loaded (cleaned) domain tables -----------------------------------------

def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned and enriched portfolio (validity + payment state)."""
    from collectra.operators.cleaning import clean_portfolio, enrich_portfolio
    return enrich_portfolio(clean_portfolio(portfolio_raw(spark, sf_dir)))


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from collectra.operators.cleaning import clean_contacts
    return clean_contacts(contacts_raw(spark, sf_dir))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from collectra.operators.cleaning import clean_calls
    return clean_calls(calls_raw(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from collectra.operators.cleaning import clean_messages
    return clean_messages(messages_raw(spark, sf_dir))


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    from collectra.operators.cleaning import clean_applications
    return clean_applications(applications_raw(spark, sf_dir))

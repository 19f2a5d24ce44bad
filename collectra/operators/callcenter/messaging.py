"""Messaging KPIs and the four-stage conversion funnel.

The funnel counts *rows* (conversations, and conversation x client pairs),
so the conversation table is first reduced to one count per phone
(map-side combined): the joins then move one row per phone instead of every
message, and a phone holding a third of all messages is a single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collectra.functions.columns import q
from collectra.functions.states import conversation_flag
from collectra.functions.text import normalize_phone


def valid_center_messages(msgs: DataFrame) -> DataFrame:
    if "Call_Center" not in msgs.columns:
        return msgs
    cc = q("Call_Center").cast("string")
    return msgs.where(cc.isNotNull() & (F.upper(cc) != "SIN DATO") & (cc != ""))


def with_conversation_flag(msgs: DataFrame) -> DataFrame:
    c = q("Tipo_Respuesta_Agente") if "Tipo_Respuesta_Agente" in msgs.columns else None
    return msgs.withColumn("Es_Conversacion", conversation_flag(c))


def msg_effectiveness(msgs: DataFrame) -> DataFrame:
    m = with_conversation_flag(valid_center_messages(msgs))
    return (m.groupBy(q("Call_Center").alias("name"))
            .agg(F.count(F.lit(1)).alias("entregados"),
                 F.count_if(q("Es_Conversacion")).alias("conversaciones"))
            .withColumn("porcentaje", F.when(F.col("entregados") > 0,
                                             F.col("conversaciones") / F.col("entregados") * 100)
                        .otherwise(F.lit(0.0)))
            .orderBy(F.col("entregados").desc(), F.col("name")))


def conversations(msgs: DataFrame) -> DataFrame:
    m = with_conversation_flag(valid_center_messages(msgs)).where(q("Es_Conversacion"))
    return m.withColumn("Tel_Norm", normalize_phone(q("Numero_Telefono")))


def _phone_pairs(contacts: DataFrame) -> DataFrame:
    """Distinct (phone, client) of the contact log, both phone columns; the client may be NULL."""
    cols = [c for c in ["Telefono_Cliente", "Celular_Cliente"] if c in contacts.columns]
    arr = F.array(*[normalize_phone(q(c)) for c in cols])
    return (contacts.select(F.explode(arr).alias("Tel"), q("Cedula_Cliente").cast("string").alias("Cedula_Cliente"))
            .where(F.col("Tel").isNotNull() & (F.col("Tel") != "")).distinct())


def contact_phones(contacts: DataFrame) -> DataFrame:
    """Distinct normalised phones of the contact log (both phone columns)."""
    return _phone_pairs(contacts).select("Tel").distinct()


def phone_clients(contacts: DataFrame) -> DataFrame:
    """Distinct (phone, client) pairs of the contact log."""
    return _phone_pairs(contacts).where(q("Cedula_Cliente").isNotNull())


def paying_clients(portfolio: DataFrame) -> DataFrame:
    if "Estado_Pago" in portfolio.columns:
        cond = q("Estado_Pago") == "PAGO"
    elif "Total_Recaudo" in portfolio.columns:
        cond = q("Total_Recaudo") > 0
    else:
        cond = F.lit(False)
    return portfolio.where(cond).select(q("Cedula_Cliente").cast("string").alias("Cedula_Cliente")).distinct()


def msg_phone_match(msgs: DataFrame, contacts: DataFrame) -> DataFrame:
    """Conversations whose phone appears in the contact log (semi join)."""
    phones = contact_phones(contacts)
    conv = conversations(msgs)
    return conv.join(phones, conv.Tel_Norm == phones.Tel, "left_semi")


def msg_payer_match(msgs: DataFrame, contacts: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Matched conversations x the clients of that phone who paid (row level)."""
    matched = msg_phone_match(msgs, contacts)
    pc = phone_clients(contacts)
    return (matched.join(pc, matched.Tel_Norm == pc.Tel).drop("Tel")
            .join(paying_clients(portfolio), "Cedula_Cliente"))


def paying_phones(contacts: DataFrame) -> DataFrame:
    """(Tel, payers): every phone of the contact log and how many of its clients pay.

    ``contacts`` carry their client's ``pays``; one pass over both phone columns.
    """
    cols = [c for c in ["Telefono_Cliente", "Celular_Cliente"] if c in contacts.columns]
    arr = F.array(*[normalize_phone(q(c)) for c in cols])
    pairs = (contacts.select(F.explode(arr).alias("Tel"), q("Cedula_Cliente").cast("string").alias("Cedula_Cliente"), "pays")
             .where(F.col("Tel").isNotNull() & (F.col("Tel") != "")).distinct())
    return pairs.groupBy("Tel").agg(F.count_if(F.col("pays") & q("Cedula_Cliente").isNotNull()).alias("payers"))


def with_payers(contacts: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Phones, clients and ``pays`` of the contact log: does the client have a paid loan?"""
    cols = [c for c in ["Telefono_Cliente", "Celular_Cliente"] if c in contacts.columns]
    # (phones, client) once each before the join: the log repeats them
    log = contacts.select(q("Cedula_Cliente").cast("string").alias("Cedula_Cliente"), *[q(c) for c in cols]).distinct()
    return log.join(paying_clients(portfolio).withColumn("pays", F.lit(True)), "Cedula_Cliente", "left") \
        .withColumn("pays", F.coalesce("pays", F.lit(False)))


def funnel_stages(msgs: DataFrame, phones: DataFrame) -> DataFrame:
    """The four stages, from one pass over the messages and one join by phone.

    Messages are reduced to one row per phone (those that are no conversation
    to one row without a phone), so a hot phone is a single row."""
    m = with_conversation_flag(valid_center_messages(msgs))
    per_phone = m.groupBy(F.when(q("Es_Conversacion"), normalize_phone(q("Numero_Telefono"))).alias("Tel_Norm")).agg(
        F.count(F.lit(1)).alias("a"), F.count_if(q("Es_Conversacion")).alias("b"))
    met = per_phone.join(phones, per_phone.Tel_Norm == phones.Tel, "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    s = met.agg(total("a").alias("a"), total("b").alias("b"), total(F.when(F.col("Tel").isNotNull(), F.col("b"))).alias("c"),
                total(F.col("b") * F.col("payers")).alias("d"))
    return s.select(F.expr("stack(4, 0, 'Mensajes Entregados', a, 1, 'Conversaciones', b, 2, 'Gestión en Sistema', c, "
                           "3, 'Clientes con Pago', d) AS (stage, name, value)"))


def msg_funnel(msgs: DataFrame, contacts: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Delivered -> conversations -> matched in system -> with payment."""
    return funnel_stages(msgs, paying_phones(with_payers(contacts, portfolio)))


def paying_client_count(msgs: DataFrame, contacts: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Distinct paying clients reached (the funnel's last stage counts rows)."""
    pairs = phone_clients(contacts).join(paying_clients(portfolio), "Cedula_Cliente", "left_semi")
    hit = conversations(msgs).select("Tel_Norm").distinct()
    return pairs.join(hit, pairs.Tel == hit.Tel_Norm, "left_semi").agg(F.countDistinct("Cedula_Cliente").alias("clientes_con_pago"))

"""The follow-up detail is joined per client: same rows as loan by loan, and the wide loans are shuffled once."""

import random

from pyspark.sql import functions as F

from collectra.operators import followups
from collectra.session import fresh_path
from collectra.sources import indexes, store


def made(spark):
    rng = random.Random(3)
    client = lambda: rng.choice([None, *"abcdefg"])
    loans = spark.createDataFrame([(client(), f"L{i % 50}", rng.choice([0.0, 3.0, None]), rng.choice([0.0, 90_000.0]), "propia") for i in range(60)],
                                  "Cedula_Cliente string, Credito string, Cantidad_Novedades double, Total_Recaudo double, Valor string")
    role = lambda: rng.choice([None, "GESTOR", "ABOGADO", "SIN ASIGNAR"])
    log = [(i, rng.choice([None, *"abcdxyz"]), role(), rng.choice([None, "nota"]), "E", float(i)) for i in range(80)]
    contacts = spark.createDataFrame(log + log[:9], "seq long, Cedula_Cliente string, Cargo_Usuario string, Novedad string, Empresa string, Valor double")
    return loans, contacts


def loan_by_loan(loans, contacts):
    merged = followups.join_client_roles(followups.followup_base(loans), contacts)
    return followups.join_contact_detail(followups.join_contacts_per_role(merged, contacts), contacts)


def test_detail_per_client_is_the_detail_loan_by_loan(spark):
    loans, contacts = made(spark)
    for log in (contacts, contacts.drop("Cargo_Usuario"), contacts.limit(0)):
        got, want = followups.followup_detail(loans, log), loan_by_loan(loans, log)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_loans_are_not_shuffled_after_the_fan_out(spark):
    loans, contacts = made(spark)
    plan = followups.followup_detail(loans, contacts)._jdf.queryExecution().optimizedPlan()
    wide = [p for p in _subplans(plan) if p.nodeName() == "Join" and "Credito" in p.output().mkString(",")]
    assert len(wide) == 1 and wide[0].joinType().toString() == "Inner"


def _subplans(plan):
    out, todo = [], [plan]
    while todo:
        p = todo.pop()
        out.append(p)
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return out


def test_numbered_detail_is_stored_without_a_join(spark, monkeypatch):
    loans, contacts = made(spark)
    loans = loans.withColumn("Estado_Vigencia", F.lit("vigente")).withColumn("Nombre_Cliente", F.lit("Ana"))
    numbers = indexes.client_numbers(loans, fresh_path(spark, "clients"))
    detail = followups.followup_detail(loans, contacts, numbers)
    plain = indexes.with_client(followups.followup_detail(loans, contacts), numbers)
    assert sorted(map(str, detail.collect())) == sorted(map(str, plain.select(*detail.columns).collect()))
    monkeypatch.setattr(indexes, "with_client", None)  # the fan-out is not joined again
    tables = store.search_tables(fresh_path(spark, "numbered"), "j", detail, loans, numbers)
    stored = store.read_stored(spark, tables["busqueda_gestion"])
    assert sorted(map(str, stored.select(*detail.columns).collect())) == sorted(map(str, detail.collect()))


def test_a_frequent_trigram_is_dealt_to_many_tasks(spark):
    """Every row holds the trigram ``cli``: its list is written range by range, not by one task."""
    rows = spark.range(4_000).selectExpr("concat('cli', id) AS Nombre_Cliente", "CAST(id AS STRING) AS Cedula_Cliente", "CAST(id AS STRING) AS Credito")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        path = store.write_lookup(rows, fresh_path(spark, "lists"), "busqueda_clientes", "j", parts=8)
    finally:
        spark.conf.set(key, before)
    stored = indexes._postings(spark, store.current(spark, path)).where("gram = 'cli'")
    assert stored.count() == 4_000
    assert stored.select(F.input_file_name()).distinct().count() > 1

"""Queries that read a table once do not write it first: same rows from its plan as from the written table."""

import pytest
from pyspark.sql import functions as F

from collectra.plans.registry import QUERIES, T
from collectra.sources import materialize

CHARTS = ["sunburst_paid", "join_client_roles", "roll_rate"]


@pytest.fixture()
def folder(spark, tmp_path):
    """Domain tables of the test's own: clients and orders that repeat, orders without lines, users without a client."""
    ts = F.timestamp_seconds(F.lit(900_000_000) + F.col("id") * 86_400)
    n = lambda k, *cols: spark.range(k).select(*cols)
    i = F.col("id")
    made = {
        "region": n(2, i.alias("r_regionkey"), F.concat(F.lit("R"), i).alias("r_name")),
        "nation": n(12, i.alias("n_nationkey"), F.concat(F.lit("N"), i).alias("n_name"), (i % 2).alias("n_regionkey")),
        "customer": n(40, (i % 37).alias("c_custkey"), F.concat(F.lit("C"), i).alias("c_name"), (i % 12).alias("c_nationkey"), F.lit("E").alias("c_mktsegment")),
        "orders": n(200, F.when(i % 50 != 7, i % 190).alias("o_orderkey"), (i % 41).alias("o_custkey"), F.element_at(F.array(*map(F.lit, "FOP")), (i % 3 + 1).cast("int")).alias("o_orderstatus"),
                    (i * 1_000.5).alias("o_totalprice"), ts.alias("o_orderdate")),
        "lineitem": n(500, (i % 170).alias("l_orderkey"), (i * 731.25).alias("l_extendedprice"), F.when(i % 3 > 0, "N").otherwise("R").alias("l_returnflag"),
                      F.when(i % 2 > 0, "F").otherwise("O").alias("l_linestatus"), ts.alias("l_shipdate")),
        "events": n(300, i.alias("event_id"), ts.alias("ts"), F.when(i % 9 > 0, i % 45).alias("user_id"), F.element_at(F.array(*map(F.lit, ["view", "click", "error", "purchase"])), (i % 4 + 1).cast("int")).alias("event_type"),
                    (i * 1.5).alias("value"), F.concat(F.lit("p"), i).alias("props")),
    }
    for name, df in made.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def rows(df):
    return sorted(map(str, df.collect()))


def written(folder):
    return {memo[1] for memo in materialize._DONE if memo[2] == materialize._hash(memo[1], folder)}


def test_planned_and_written_tables_give_the_same_rows(spark, folder):
    planned = {k: QUERIES[k](spark, folder) for k in CHARTS}
    got = {k: (df.columns, rows(df)) for k, df in planned.items()}
    assert written(folder) == set()  # no query has written the wide tables to read a few of their columns
    t = T(spark, folder)
    t.portfolio(), t.contacts()
    for k in CHARTS:
        df = QUERIES[k](spark, folder)
        assert not any("lineitem" in f for f in df.inputFiles())  # the written tables are taken
        assert (df.columns, rows(df)) == got[k] and got[k][1]


def test_live_detail_answers_every_click_like_the_whole_detail(spark, folder):
    from collectra.operators.search import SearchRequest
    from collectra.plans import live_metrics as lm

    t = T(spark, folder)
    small = t.live_detail()
    assert "portfolio" not in written(folder) and "Nombre_Cliente" not in small.columns
    whole = t.management_detail()
    assert t.live_detail().columns == whole.columns  # the stored detail is taken once it is there
    assert rows(small) == rows(lm.click_columns(whole)) and small.count() == whole.count() > 0
    req = SearchRequest(empresa=["E"], regional=["R0", "R1"], zona=["CL1", "CL2", "CL3"], franja=["AL DIA", "1 A 30", "91 A 180"], call_center=["CL1", "CL2", "CL3"],
                        rodamiento=["MEJORA", "EMPEORA"], novedades=["Con Novedades"], vigencia=["vigente", "vencido", "anticipado"])
    assert lm.filter_portfolio(whole, req).count() > 0
    for r in (req, SearchRequest()):
        got, want = (rows(lm.live_cc_metrics(d, t.contacts(), t.calls(), t.messages(), r, "1999-01-01", candidates=t.candidates())) for d in (small, whole))
        assert got == want


def test_search_tables_store_the_detail_whole_without_a_first_copy(spark, folder, monkeypatch):
    from collectra.operators import followups
    from collectra.sources import indexes, store

    monkeypatch.setattr(indexes, "RANGE_ROWS", 400)
    got = rows(QUERIES["search_text"](spark, folder))
    assert "contact_detail" not in written(folder)  # its plan is stored by page key at once
    t = T(spark, folder)
    tables = t.search_tables()
    assert sorted(tables) == ["busqueda_clientes", "busqueda_gestion", "busqueda_validez"]
    want = followups.followup_detail(t.portfolio(), t.contacts(), t.client_numbers())
    path, kept, _ = store.open_stored(spark, tables["busqueda_gestion"])
    whole = kept.drop(indexes.PART)
    assert whole.columns == want.columns and rows(whole) == rows(want) and whole.count() > 800
    # ranges by the number of rows, which is known well enough beforehand
    sizes = [r["n"] for r in indexes.order_index(spark, path).collect()]
    assert 3 <= len(sizes) <= indexes.ranges_for(followups.detail_size(t.portfolio(), t.contacts())) and max(sizes) < 700
    # a detail that is written already is taken instead: same rows
    for memo in [m for m in materialize._DONE if m[1] == "search"]:
        del materialize._DONE[memo]
    t.contact_detail()
    again = QUERIES["search_text"](spark, folder)
    assert rows(again) == got and rows(store.read_stored(spark, t.search_tables()["busqueda_gestion"])) == rows(want)

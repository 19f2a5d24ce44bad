"""Versions of stored datasets, and search through the indexes beside them."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from collectra.operators import search
from collectra.operators.search import SearchRequest
from collectra.session import fresh_path
from collectra.sources import indexes, store

COLS = "Credito string, seq long, Nombre_Cliente string, Cedula_Cliente string, Novedad string, Zona string, Estado_Vigencia string"


def made(n=2000, seed=1):
    rng = random.Random(seed)
    names = ["ANA", "Luz", "José", "MARÍA", "Ñuñez", None, "", "x", "İpek"]
    out = []
    for i in range(n):
        name = " ".join(str(rng.choice(names)) for _ in range(2)) if rng.random() < 0.95 else None
        out.append((f"{rng.randrange(n):06d}" if rng.random() < 0.98 else None, i, name, str(rng.randrange(400)), rng.choice([None, "llamar mañana", "ok", "no contesta"]),
                    rng.choice(["CL1", "CL2", None]), rng.choice(["vigente", "vencido"])))
    out[n * 7 // 18] = ("000777", 777, "Zacarías Rarísimo", "99999", "un término único", "CL1", "vigente")
    return out


@pytest.fixture(scope="module")
def stored(spark):
    root = fresh_path(spark, "stored")
    df = spark.createDataFrame(made(), COLS).repartition(5)
    store.write_detail(df, root, "busqueda_gestion", "j", order_by=["Credito", "seq"], text_columns=["Nombre_Cliente", "Cedula_Cliente", "Novedad"], parts=12)
    store.write_lookup(clients(spark), root, "busqueda_clientes", "j", parts=9)
    return df.cache(), store.job_path(root, "busqueda_gestion", "j"), store.job_path(root, "busqueda_clientes", "j"), root


def clients(spark):
    """One row per loan."""
    return spark.createDataFrame(list({r[0]: r for r in made()}.values()), COLS).repartition(4)


def opened(df) -> int:
    """Files of ranges that the execution reads."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size()) if leaves.apply(i).nodeName().startswith("Scan parquet")]
        return sum(s.metrics().apply("numFiles").value() for s in scans)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def ranges(path) -> set:
    return {f.split("=")[-1] for f in glob.glob(f"{path}/v-*/rows/{indexes.PART}=*")}


def test_rows_come_back_in_ranges_of_the_key(spark, stored):
    df, path, _, _ = stored
    folder, rows, order = store.open_stored(spark, path)
    assert order == ["Credito", "seq"] and len(ranges(path)) == 12
    assert sorted(map(str, rows.drop(indexes.PART).collect())) == sorted(map(str, df.collect()))
    key = lambda r: (r.Credito is not None, r.Credito or "", r.seq)
    by = [[key(r) for r in rows.where(F.col(indexes.PART) == i).collect()] for i in range(12)]
    assert all(b == sorted(b) for b in by) and all(a[-1] < b[0] for a, b in zip(by, by[1:]))
    assert {r[0]: r["n"] for r in indexes.order_index(spark, folder).collect()} == {i: len(b) for i, b in enumerate(by)}


@pytest.mark.parametrize("term", ["ZACARÍAS", "término ú", "ana", "ña", "", "nadie", "İPEK", "no contesta", "'; %_"])
def test_text_search_loses_no_row(spark, stored, term):
    df, path, _, _ = stored
    want = sorted(map(str, search.search_text(df, term).collect()))
    assert sorted(map(str, search.search_text_stored(spark, path, term).collect())) == want


def test_a_rare_term_opens_one_range(spark, stored):
    _, path, _, _ = stored
    got = search.search_text_stored(spark, path, "Zacarías")
    assert opened(got) == 1 and got.count() == 1
    assert opened(search.search_text_stored(spark, path, "qqqqq")) == 0
    assert opened(search.search_text_stored(spark, path, "Zac.r", regex=True)) == 12


def test_full_filters_drop_nothing(spark, monkeypatch):
    """More trigrams than bits: everything is opened, nothing is lost."""
    monkeypatch.setattr(indexes, "FILTER_BITS", 8)
    root = fresh_path(spark, "full")
    df = spark.createDataFrame(made(300), COLS)
    store.write_detail(df, root, "d", "j", order_by=["Credito", "seq"], text_columns=["Nombre_Cliente", "Novedad"], parts=4)
    got = search.search_text_stored(spark, store.job_path(root, "d", "j"), "contesta")
    assert got.count() == search.search_text(df, "contesta", cols=["Nombre_Cliente", "Novedad"]).count() > 0


REQUESTS = [SearchRequest(page=3), SearchRequest(page=10**6), SearchRequest(zona=["CL1"], page=2, page_size=7), SearchRequest(search_term="ana", page=4, page_size=9),
            SearchRequest(vigencia=["vigente"], zona=["CL2"], page=5, page_size=50), SearchRequest(zona=["CL9"], page=2), SearchRequest(search_term="único")]


@pytest.mark.parametrize("req", REQUESTS)
def test_pages_from_the_order_index(spark, stored, req):
    df, path, _, _ = stored
    got, want = search.find_page_stored(spark, path, req, df), search.find_page(df, req, ["Credito", "seq"], df)
    assert (got.total, got.page, got.pages) == (want.total, want.page, want.pages)
    assert [tuple(r) for r in got.rows.collect()] == [tuple(r) for r in want.rows.collect()]
    if req.page_size <= 50 and not req.vigencia:
        assert opened(got.rows) <= 2


def test_keyset_pages_walk_through_everything(spark, stored):
    df, path, _, _ = stored
    for req in (SearchRequest(page_size=333), SearchRequest(page_size=100, zona=["CL1"])):
        want = [tuple(r) for r in search.apply_filters(df, req).orderBy("Credito", "seq").collect()]
        got = [tuple(r) for r in search.find_page_stored(spark, path, req).rows.collect()]
        while True:
            page = search.page_after(spark, path, req, (got[-1][0], got[-1][1]))
            rows = [tuple(r) for r in page.collect()]
            if not rows:
                break
            assert opened(page) <= 4
            got += rows
        assert got == want


@pytest.mark.parametrize("term", ["ana luz", "777", "í", "", "zzz", "MARÍA", "0001"])
def test_lookup_by_posting_lists(spark, stored, term):
    _, _, path, _ = stored
    loans = clients(spark)
    for limit in (1, 40):
        want = [r.Credito for r in search.lookup_clients(loans, term, limit).collect()]
        assert [r.Credito for r in search.lookup_stored(spark, path, term, limit).collect()] == want
    assert [r.Credito for r in search.lookup_stored(spark, path, "an. ", 7, regex=True).collect()] == \
        [r.Credito for r in search.lookup_clients(loans, "an. ", 7, regex=True).collect()]


def test_lookup_verifies_in_chunks(spark, stored, monkeypatch):
    """More candidates than a chunk holds: it goes on until the limit or the end."""
    monkeypatch.setattr(search, "CHUNK", 3)
    _, _, path, _ = stored
    loans = clients(spark)
    want = [r.Credito for r in search.lookup_clients(loans, "ana ana", 1000).collect()]
    assert [r.Credito for r in search.lookup_stored(spark, path, "ana ana", 1000).collect()] == want and len(want) > 3


def test_a_rewrite_that_fails_halfway_leaves_the_old_rows(spark, stored):
    root = fresh_path(spark, "versions")
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "Credito string, Zona string")
    bad = a.withColumn("Zona", F.when(F.col("Credito") == "2", F.raise_error(F.lit("lost"))).otherwise(F.col("Zona")))
    store.write_detail(a, root, "d", "j")
    store.write_summary(a, root, "m/s", "j")
    import datetime as dt
    store.write_manifest(spark, root, "j", "ACME", dt.datetime(2024, 1, 1))
    held = store.resolve_dataset(spark, root, "d", "j")
    for write in (lambda: store.write_detail(bad, root, "d", "j"), lambda: store.write_detail(bad, root, "d", "j", order_by=["Credito"]),
                  lambda: store.write_summary(bad, root, "m/s", "j"),
                  lambda: store.write_manifest(spark, root, "k", "ACME", dt.datetime(2024, 1, 1), bad.agg(F.max("Zona").alias("z")))):
        with pytest.raises(Exception, match="lost"):
            write()
    assert store.resolve_dataset(spark, root, "d", "j").count() == 2
    assert store.read_summary(spark, root, "m/s", "j").count() == 2
    assert store.read_manifest(spark, root).first().active_job_id == "j"
    store.write_detail(a.limit(1), root, "d", "j")
    assert store.resolve_dataset(spark, root, "d", "j").count() == 1 and held.count() == 2  # a reader that has begun goes on
    for _ in range(3):
        store.write_detail(a.limit(0), root, "d", "j", order_by=["Credito"])
    path = store.job_path(root, "d", "j")
    assert store.read_stored(spark, path).count() == 0 and store.read_stored(spark, path).columns == ["Credito", "Zona"]
    assert len(store.versions(spark, path)) == 2 and search.find_page_stored(spark, path, SearchRequest()).pages == 0
    with pytest.raises(FileNotFoundError):
        store.resolve_dataset(spark, root, "d", "other")


def test_client_bitmaps_are_the_semi_join(spark, monkeypatch):
    """Random clients over more than one bitmap, null and unknown clients; the rows are not shuffled."""
    rng = random.Random(5)
    loans = spark.createDataFrame([(f"c{rng.randrange(90_000):05d}" if rng.random() < 0.99 else None, rng.choice(["vigente", "vencido", "anticipado", None])) for _ in range(70_000)],
                                  "Cedula_Cliente string, Estado_Vigencia string").repartition(6)
    rows = spark.createDataFrame([(f"c{rng.randrange(99_000):05d}" if rng.random() < 0.99 else None, i) for i in range(5_000)], "Cedula_Cliente string, seq long")
    numbers = indexes.client_numbers(loans, fresh_path(spark, "clients"))
    n = loans.where("Cedula_Cliente is not null").select("Cedula_Cliente").distinct().count()
    assert numbers.agg(F.min(indexes.CLIENT), F.max(indexes.CLIENT), F.countDistinct(indexes.CLIENT), F.count("*")).first() == (0, n - 1, n, n) and n > 40_000
    root = fresh_path(spark, "bitmaps")
    store.write_detail(indexes.state_bitmaps(loans, numbers), root, "busqueda_validez", "j")
    store.write_detail(indexes.with_client(rows, numbers), root, "d", "j")
    bitmaps, detail = (store.read_stored(spark, store.job_path(root, f, "j")) for f in ("busqueda_validez", "d"))
    for states in (["vigente"], ["vencido", "anticipado"], ["no hay"]):
        got = indexes.keep_states(detail, bitmaps, states)
        want = search.semi_join_validity(rows, loans, states)
        assert sorted(r.seq for r in got.collect()) == sorted(r.seq for r in want.collect())
    plan = indexes.keep_states(detail, bitmaps, ["vigente"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1  # of the bitmaps of the states


def test_pages_by_client_bitmaps(spark):
    root = fresh_path(spark, "pages")
    df = spark.createDataFrame(made(), COLS)
    tables = store.search_tables(root, "j", df, df)
    for req in (SearchRequest(vigencia=["vigente"], page=3), SearchRequest(vigencia=["vencido"], zona=["CL1"], page_size=30)):
        got = search.find_page_stored(spark, tables["busqueda_gestion"], req, validity=store.read_stored(spark, tables["busqueda_validez"]))
        want = search.find_page(df, req, ["Credito", "seq"], df)
        cols = df.columns
        assert got.total == want.total and [tuple(r) for r in got.rows.select(*cols).collect()] == [tuple(r) for r in want.rows.select(*cols).collect()]
        assert indexes.CLIENT not in got.rows.columns


@pytest.mark.parametrize("alike", [[], ["Nombre_Cliente", "Cedula_Cliente"], ["Nombre_Cliente", "Cedula_Cliente", "Novedad"]])
def test_trigram_filters_hold_the_trigrams_of_each_column(spark, stored, alike):
    """Bits worked out by hand; columns whose values repeat together are taken apart once."""
    import zlib
    _, path, _, _ = stored
    rows, cols = store.open_stored(spark, path)[1], ["Nombre_Cliente", "Cedula_Cliente", "Novedad"]
    want = {}
    for r in rows.select(indexes.PART, *[F.lower(c).alias(c) for c in cols]).collect():
        for c in cols:
            for g in indexes.term_trigrams(r[c] or ""):
                want.setdefault((r[0], c), set()).add(zlib.crc32(g.encode()) % indexes.FILTER_BITS)
    to = fresh_path(spark, "filters")
    indexes.write_trigram_filters(rows, to, cols, alike)
    got = {}
    for r in spark.read.parquet(f"{to}/trigrams").collect():
        bits = {(int(r["bucket"]) - 1) * indexes.BUCKET_BITS + 8 * i + k for i, b in enumerate(r["bits"]) for k in range(8) if b >> k & 1}
        got.setdefault((r[indexes.PART], r["columna"]), set()).update(bits)
    assert got == want and len(want) == 36


def test_postings_name_each_trigram_of_a_row_once(spark, stored):
    """A trigram that comes twice in a text, or in two texts of a row, is one posting; null and short texts have none."""
    _, _, path, _ = stored
    folder = store.current(spark, path)
    want = set()
    for r in spark.read.parquet(f"{folder}/lookup").collect():
        texts = [(r.Nombre_Cliente or "").lower(), r.Cedula_Cliente or "", r.Credito or ""]
        want |= {(g, r[indexes.PART], r[indexes.ROW]) for t in texts for g in indexes.term_trigrams(t)}
    got = [(r.gram, r[indexes.PART], r[indexes.ROW]) for r in indexes._postings(spark, folder).collect()]
    assert len(got) == len(set(got)) and set(got) == {(g, p, n) for g, p, n in want} and len(got) > 1_000

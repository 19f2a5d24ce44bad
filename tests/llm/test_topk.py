import duckdb
import numpy as np
import pandas as pd
import pytest

from collectra.llm import queries
from collectra.llm import topk as T
from collectra.llm.common import table

LONG = (1 << 63) - 1


def brute(rows, k=5, every=50):
    """rows: (vec_id, list). Python integers."""
    held = {}
    for i, v in rows:
        if i is None or not v or any(c is None or not np.isfinite(c) or not np.isfinite(256.0 * c) for c in v):
            continue
        v = [int(np.floor(256.0 * c)) for c in v]
        held[i] = min(v, held.get(i, v))
    out = []
    for q in held:
        if q % every == 0:
            scores = [(max(-LONG, min(LONG, sum(a * b for a, b in zip(held[q], v)))), i) for i, v in held.items() if i != q]
            out += [(q, r, i, s) for r, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:k], 1)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<double>, Vec_ID string, score double").repartition(3)
    return sorted(map(tuple, T.top_k(df, **kw).collect()))


def test_query_against_duckdb(spark):
    got = queries.op13_topk(spark, "/root/testdata/sf0.001")
    con = duckdb.connect()
    con.sql("create view embeddings as select * from '/root/testdata/sf0.001/embeddings.parquet'")
    want = con.sql(queries.ORACLE_SQL["op13_topk"])
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (50, [0.5, -0.25]), (1, [0.5, -0.25]), (1, [0.5, -0.5]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [None, 1.0]),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1e308, 1.0]), (None, [9.0, 9.0]), (-50, [-1.0, -1.0]), (9, [1.0]), (100, [1.0, 2.0, 3.0]),
            (10, [-0.001, 0.001]), (11, [1e9, -1e9]), (150, [3e17, 1.0]), (200, [-3e17, 2.0]), (12, [5e16, 1e15])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, k=50) == brute(rows, k=50)  # more than there are


@pytest.mark.parametrize("scale", [1.0, 2.0 ** 12, 2.0 ** 30])
def test_numbers_of_any_size_and_ties(spark, monkeypatch, scale):
    """Several parts, a third of the rows the same vector, every number type."""
    monkeypatch.setattr(T, "PART_LEAST", 64)
    rng = np.random.default_rng(3)
    rows = [(int(i), (rng.integers(-3, 4, 6) / 4 * scale).tolist()) for i in rng.permutation(700)]
    same = (np.array([1, -1, 0.5, 0.25, 0, 1]) * scale).tolist()
    rows += [(i, same) for i in range(700, 1050)]
    assert run(spark, rows, every=7) == brute(rows, every=7)


def test_blocks_are_pruned(spark, monkeypatch):
    """On vectors in tight groups most pairs are never scored, and copies beyond the k-th block neither."""
    monkeypatch.setattr(T, "PART_LEAST", 1024)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(24, 16))
    x = np.concatenate([centres[rng.integers(0, 24, 4000)] + rng.normal(size=(4000, 16)) * 0.02, np.tile(centres[0] * 1.5, (2000, 1))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = T.search(df).cache()
    assert sorted(tuple(r)[:4] for r in found.where("rank <= 5").collect()) == brute(rows)
    scored = found.selectExpr("sum(scored)").first()[0]
    assert scored < 0.35 * len(rows) * (len(rows) // 50)


def test_part_scores_few_blocks():
    rng = np.random.default_rng(0)
    x = np.repeat(rng.integers(-50, 50, (40, 8)), 256, axis=0).astype(float)
    part = T.Part(np.arange(len(x)), x)
    q = x[::256][:10]
    score, ids = part.search(np.full(10, -1), q, [None] * 10, np.full(10, LONG), 5, False)
    full = q @ x.T
    for row, s, i in zip(full, score, ids):
        assert i.tolist() == np.lexsort((np.arange(len(x)), -row))[:5].tolist() and s.tolist() == row[i].tolist()
    assert part.scored == 10 * 256  # equal rows: one block each


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(0, None), (50, [float("nan")])]) == []
    assert run(spark, [(50, [1.0])]) == []
    assert list(T.search_part(1, pd.DataFrame(), pd.DataFrame(), 5, 1, True).columns) == [c.split()[0] for c in T.FOUND.split(", ")]


def test_table_is_read_whole(spark):
    d = table(spark, "/root/testdata/sf0.001", "embeddings")
    n = d.where("vec_id % 50 = 0").count()
    assert T.top_k(d).count() == 5 * n

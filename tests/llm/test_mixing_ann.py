import re
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from samples import SF, rows

from collectra.llm import ann, mixing, queries
from collectra.llm.common import WORD

# --- mixing ----------------------------------------------------------------------


def fair(sizes, weights=(1, 2, 3), most=3):
    """Targets by filling up sources one after the other. ``sizes``: in weight order."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    full, total = set(), sum(sizes)
    while True:
        left = total - sum(most * sizes[i] for i in full)
        share = sum(w[i] for i in range(len(sizes)) if i not in full)
        t = [most * s if i in full else left * w[i] / share for i, s in enumerate(sizes)]
        over = {i for i in range(len(sizes)) if i not in full and t[i] > most * sizes[i]}
        if not over:
            return t
        full |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 5, 3, 2], [0, 7, 100, 0, 1], [5], [1, 1, 1, 1, 9999, 40, 2]])
def test_targets(spark, sizes):
    names = [chr(97 + i) for i in range(len(sizes) - 1)] + [None]
    df = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long").repartition(2)
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert [got[n] for n in names] == pytest.approx(fair(sizes))


def test_sources_stand_by_code_point(spark):
    names = ["", "Z", "a", "é", "￮", "\U0001f600", None]
    df = spark.createDataFrame([(n, 100) for n in reversed(names)], "source string, source_size long")
    got = {r.source: r.weight for r in mixing.targets(df).collect()}
    assert [got[n] for n in names] == [1, 2, 3, 1, 2, 3, 1]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 4097])
def test_permutation(spark, n):
    got = [r.p for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(7)).alias("p")).collect()]
    assert sorted(got) == list(range(n)) and (n < 100 or np.corrcoef(np.arange(n), got)[0, 1] < 0.15)


def check(got, size_of, block):
    by = defaultdict(list)
    for r in got:
        assert r["size"] == size_of[r.doc_id] and 0 <= r.taken <= 3 * r["size"]
        by[r.source].append(r)
    order = sorted(by, key=lambda s: (s is None, s or ""))
    want = fair([sum(r["size"] for r in by[s]) for s in order])
    for s, t in zip(order, want):
        assert {r.source_size for r in by[s]} == {sum(r["size"] for r in by[s])}
        assert all(r.target == pytest.approx(t) for r in by[s])
        assert abs(sum(r.taken for r in by[s]) - t) <= 0.5001  # to the word
        assert all((r.first_shard is None) == (r.taken == 0) for r in by[s] if "first_shard" in r)


def test_op2_query(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    size = {i: len(re.findall(WORD, x or "")) for i, x in zip(t["doc_id"], t["text"])}
    one, two = queries.op2_mixing(spark, SF).collect(), queries.op2_mixing(spark, SF).collect()
    assert len(one) == len(size) and sorted(one) == sorted(two)
    check(one, size, mixing.BLOCK_WORDS)


def test_shard_counts_are_draws_of_the_targets(spark):
    df = spark.createDataFrame([("a", 30_000), ("b", 20_000), ("c", 50_000)], "source string, size long") \
        .select(F.monotonically_increasing_id().alias("doc_id"), "source", F.repeat(F.lit("w "), F.col("size").cast("int")).alias("text"))
    plan = mixing.plan(mixing.placed(df), block=10)
    shards = defaultdict(dict)
    for r in mixing.shard_counts(plan, shard=500).collect():
        shards[r.shard][r.source] = r.n
    slots = {r.source: r.slots for r in plan.collect()}
    assert {s: sum(x.get(s, 0) for x in shards.values()) for s in slots} == slots
    full = [x for x in shards.values() if sum(x.values()) == 500]
    assert len(full) == sum(slots.values()) // 500
    share = np.array([x["b"] / 500 for x in full])
    p = slots["b"] / sum(slots.values())
    assert abs(share.mean() - p) < 0.03 and 0.3 < share.std() / np.sqrt(p * (1 - p) / 500) < 2


def test_small_sources_meet_their_targets(spark):
    """Sources of 20 to 100 words, smaller than a block or just above it."""
    sizes = {"a": 100, "b": 70, "c": 20, "d": 64, "e": 65, None: 31}
    docs, i = [], 0
    for s, n in sizes.items():
        while n:
            k = min(n, 7 + i % 5)
            docs.append((i, " ".join(["w"] * k), s))
            n, i = n - k, i + 1
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    got = mixing.taken_words(df).collect()
    check(got, {d[0]: len(d[1].split()) for d in docs}, 64)
    mixed = mixing.mix(df).selectExpr("source", "size(split(text, ' ')) AS n").groupBy("source").sum("n").collect()
    assert {r[0]: r[1] for r in mixed} == {s: sum(r.taken for r in got if r.source == s) for s in sizes}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 999])
def test_permutation_backwards(spark, n):
    x = F.col("id")
    back = spark.range(n).select(mixing.unpermuted(mixing.permuted(x, F.lit(n), F.lit(7)), F.lit(n), F.lit(7)).alias("y"), "id")
    assert all(r.y == r.id for r in back.collect())


def test_slots_are_numbered_shard_by_shard(spark):
    df = spark.createDataFrame([(i, " ".join(["w"] * 50), "ab"[i % 2]) for i in range(300)], "doc_id long, text string, source string")
    plan = mixing.plan(mixing.placed(df), block=10)
    got = mixing.slots(plan, shard=64).collect()
    by = {r.source: r for r in plan.collect()}
    for s, src in by.items():
        own = sorted((r for r in got if r.source == s), key=lambda r: r.place)  # place order is shard order
        assert [r.epoch for r in own] == [k // src.blocks for k in range(src.slots)]
        assert [r.words for r in own[:-1]] == [None] * (src.slots - 1) and own[-1].words == src.cut


def test_no_block_is_taken_twice_before_all_are_once(spark):
    df = spark.createDataFrame([(i, "a" if i % 5 else "b", " ".join(["w"] * (i % 37))) for i in range(400)], "doc_id long, source string, text string")
    sources = mixing.plan(mixing.placed(df), block=8)
    times = defaultdict(list)
    for r in mixing.slots(sources).groupBy("source", "block").count().collect():
        times[r.source].append(r["count"])
    for r in sources.collect():
        low, extra = divmod(r.slots, r.blocks)
        assert sorted(times[r.source]) == sorted([x for x in [low] * (r.blocks - extra) + [low + 1] * extra if x])


def test_mixing_edges(spark, odd, empty):
    got = mixing.taken_words(odd, block=4).collect()
    size = {r[0]: len(re.findall(WORD, r[1] or "")) for r in rows()}
    assert len(got) == len(rows())
    check(got, size, 4)
    assert mixing.taken_words(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mixed_texts_hold_the_taken_words(spark, odd):
    mixed = mixing.mix(odd, block=4)
    assert mixed.columns == odd.columns
    out, sources = defaultdict(int), {}
    source_text = {r[0]: re.findall(WORD, r[1] or "") for r in rows()}
    for r in map(tuple, mixed.collect()):
        w = re.findall(WORD, r[1])
        out[r[0]] += len(w)
        sources[r[0]] = r[3]
        assert set(w) <= set(source_text[r[0]]) and len(r[1]) == r[4]
    want = defaultdict(int)
    for r in mixing.taken_words(odd, block=4).collect():
        want[r.doc_id] += r.taken
    assert out == {i: n for i, n in want.items() if n}


def test_mixing_plan_is_native(spark):
    for df in (queries.op2_mixing(spark, SF), mixing.mix(spark.read.parquet(f"{SF}/documents.parquet"))):
        text = df._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", text)


# --- nearest neighbours -------------------------------------------------------------

def brute(vectors, k, every):
    ids, x = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors], dtype=np.float64)
    out = {}
    for i, v in vectors:
        if i % every == 0:
            s = x @ np.array(v, dtype=np.float64)
            s[ids == i] = -np.inf
            top = np.lexsort((ids, -s))[: min(k, (ids != i).sum())]
            out[i] = list(zip(ids[top].tolist(), s[top].tolist()))
    return out


def results(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / max(1, len(w)) for q, w in want.items()])


@pytest.mark.parametrize("kind", ["uniform", "lengths", "copies"])
def test_recall(spark, kind, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 24))
    if kind == "lengths":  # the largest inner product is not the smallest angle
        x *= rng.lognormal(0, 0.7, size=(3000, 1))
    if kind == "copies":
        x[500:1700] = x[7]
        monkeypatch.setattr(ann, "PART_ROWS", 100)
    v = [(i, r.tolist()) for i, r in enumerate(x)]
    got = results(ann.nearest(spark.createDataFrame(v, "vec_id long, embedding array<double>").repartition(4)))
    want = brute(v, 20, 20)
    assert set(got) == set(want)
    if kind != "copies":
        assert recall(got, want) >= 0.9
    for q, near in got.items():
        assert near == sorted(near, key=lambda p: (-p[1], p[0])) and len(near) == 20
        assert all(s == pytest.approx(float(x[q] @ x[i]), abs=1e-9) for i, s in near)
    if kind == "copies":  # the copies' own neighbours are all the other copies: smallest ids first
        assert np.mean([sum(s for _, s in got[q]) / sum(s for _, s in w) for q, w in want.items()]) > 0.97
        assert [i for i, _ in got[520]] == [7, *range(500, 519)]


def test_op7_query(spark):
    t = pq.read_table("/root/testdata/sf0.01/embeddings.parquet").to_pydict()
    want = brute(list(zip(t["vec_id"], t["embedding"])), 20, 20)
    got = results(queries.op7_neighbours(spark, "/root/testdata/sf0.01"))
    assert set(got) == set(want) and recall(got, want) >= 0.9


def test_few_true_neighbours_are_given_up_where_vectors_point_all_ways(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 32)
    rng = np.random.default_rng(8)
    v = [(i, r.tolist()) for i, r in enumerate(rng.normal(size=(6000, 24)))]
    got = results(ann.nearest(spark.createDataFrame(v, "vec_id long, embedding array<double>").repartition(4)))
    assert recall(got, brute(v, 20, 20)) >= 0.99


def test_groups_of_a_part_are_bounded(spark, monkeypatch):
    """A third of the rows are copies of one vector, and all lists are asked: neither side of a scan grows with them."""
    monkeypatch.setattr(ann, "PART_ROWS", 200)
    monkeypatch.setattr(ann, "SLICE_ROWS", 20)
    seen, groups = [], ann.groups
    monkeypatch.setattr(ann, "groups", lambda *x: seen.append(groups(*x)) or seen[-1])
    x = np.random.default_rng(3).normal(size=(3000, 8))
    x[1000:2000] = x[0]
    v = [(i, r.tolist()) for i, r in enumerate(x)]
    v += [(2990, x[5].tolist()), (40, x[50].tolist()), (40, x[40].tolist())]  # ids with several vectors, a row twice
    got = results(ann.nearest(spark.createDataFrame(v, "vec_id long, embedding array<double>").repartition(4), prune=9.0))
    ids, x = np.array([i for i, _ in v]), np.array([r for _, r in v])
    assert len(got) == 150
    for q, near in got.items():
        s = (x[ids == q] @ x.T).max(axis=0)
        score = {}
        for i, a in zip(ids.tolist(), s.tolist()):
            score[i] = max(a, score.get(i, a))
        want = sorted((i for i in score if i != q), key=lambda i: (-round(score[i], 9), i))[:20]
        assert [i for i, _ in near] == want and [a for _, a in near] == pytest.approx([score[i] for i in want], abs=1e-9)
    (rows, questions), = seen
    sizes = [r["count"] for r in questions.groupBy("part", "slice").count().collect()]
    assert max(sizes) < 60 and max(r.n for r in rows.groupBy("part", "slice").agg(F.sum(F.size("ids")).alias("n")).collect()) < 500
    # the hot vector is asked once in a part, and has k + 1 ids
    assert questions.groupBy("part", "vector").count().agg(F.max("count")).first()[0] == 1
    assert rows.agg(F.max(F.size("ids"))).first()[0] == 21


def test_small_lists_are_topped_up(spark, monkeypatch):
    """The lists nearest to most queries have one row, or rows of one id only."""
    x = np.random.default_rng(4).normal(size=(400, 8))
    x[300:] = x[0] + 0.001 * x[300:]
    monkeypatch.setattr(ann, "fit", lambda v: (ann.CentroidGraph.build(ann.unit(np.c_[x, np.zeros(400)])), float(np.sqrt((x * x).sum(1)).max())))
    v = [(i if i < 300 else 7, r.tolist()) for i, r in enumerate(x)]
    got = results(ann.nearest(spark.createDataFrame(v, "vec_id long, embedding array<double>").repartition(4), prune=1.0))
    assert len(got) == 15 and all(len(near) == 20 and q not in {i for i, _ in near} for q, near in got.items())


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    v = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]),
         (7, [1.0]), (20, [0.0, 3.0]), (None, [1.0, 1.0]), (40, [0.5, 0.5]), (60, [-1.0, 0.0])]
    df = spark.createDataFrame([x + ("a", 1) for x in v], "vec_id long, embedding array<double>, list string, part int")
    got = results(ann.nearest(df))
    assert got[0] == [(1, 2.0), (40, 0.5), (20, 0.0), (60, -1.0)] and set(got) == {0, 20, 40, 60}
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(none).count() == 0
    alone = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert ann.nearest(alone).count() == 0


def test_graph_finds_what_a_scan_finds():
    rng = np.random.default_rng(9)
    c = ann.unit(rng.normal(size=(700, 16)))
    x = ann.unit(rng.normal(size=(60, 16)))
    graph = ann.CentroidGraph.build(c)
    d = np.sqrt(ann.squared(x, c))
    base = np.sort(d, axis=1)[:, ann.BASE - 1]
    found = [len(set(np.flatnonzero(r <= 1.15 * b)) & set(g.tolist())) / (r <= 1.15 * b).sum() for r, b, g in zip(d, base, graph.near(x, 1.15))]
    assert np.mean(found) > 0.95


def test_parts_follow_list_sizes():
    first, n = ann.parts_of(np.array([10, 0, ann.PART_ROWS * 5, 7, ann.PART_ROWS, 3]))
    assert n.tolist() == [1, 1, 5, 1, 1, 1] and (np.diff(first) >= 0).all() and first[3] >= first[2] + 5

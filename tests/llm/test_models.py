import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from samples import SF, rows

from collectra.llm import langid, quality, queries, toxicity
from collectra.llm.common import table

BIG = "/root/testdata/sf0.01"


def held(i, parts, part):
    return zlib.crc32(str(i).encode()) % parts == part


def labelled(column):
    t = pq.read_table(f"{BIG}/labels.parquet").to_pydict()
    return dict(zip(t["doc_id"], t[column]))


# --- quality -------------------------------------------------------------------

def test_quality_held_out_accuracy(spark):
    got = queries.op1_quality(spark, BIG).collect()
    y = labelled("quality")
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == held(r.doc_id, 5, 0) for r in got)
    out = [(r.score, y[r.doc_id]) for r in got if r.held_out and y.get(r.doc_id) is not None]
    good, bad = [s for s, q in out if q == 1], [s for s, q in out if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([s >= 0.3 for s in good]) > 0.9


def test_tables_learn_pairs():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no feature alone tells anything
    m = quality.fit(x[:3000], y[:3000], pairs=2)
    assert (0, 1) in m.pairs and np.mean((m.score(x[3000:]) > 0.5) == y[3000:]) > 0.85
    alone = quality.fit(x[:3000], y[:3000], pairs=0)
    assert np.mean((alone.score(x[3000:]) > 0.5) == y[3000:]) < 0.65


def test_score_is_the_sum_of_table_entries():
    rng = np.random.default_rng(1)
    x = rng.random((500, 3))
    m = quality.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0.8).astype(float), rounds=20, pairs=2)
    for row, s in zip(x[:20], m.score(x[:20])):
        total = m.base + sum(t[np.searchsorted(c, row[f], side="right")] for f, (c, t) in enumerate(zip(m.cuts, m.tables)))
        total += sum(t[np.searchsorted(m.pair_cuts[a], row[a], side="right"), np.searchsorted(m.pair_cuts[b], row[b], side="right")]
                     for (a, b), t in zip(m.pairs, m.pair_tables))
        assert s == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_edges(odd, empty, labels, no_labels):
    for docs, n in ((odd, len(rows())), (empty, 0)):
        for lab in (labels, no_labels):
            got = quality.quality(docs, lab).collect()
            assert len(got) == n and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert all(not r.held_out for r in quality.quality(odd, labels).collect() if r.doc_id is None)
    assert quality.fit(np.zeros((0, 2)), np.zeros(0)).score(np.zeros((1, 2))) == pytest.approx([0.5])


# --- language ------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    got = queries.op4_language(spark, BIG).collect()
    t = pq.read_table(f"{BIG}/documents.parquet").to_pydict()
    lang = dict(zip(t["doc_id"], t["lang"]))
    assert len(got) == 1000 and all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in got if r.held_out]) > 0.98


def test_filter_returns_all_languages_of_a_gram():
    rng = np.random.default_rng(3)
    langs = [f"l{i}" for i in range(70)]  # more than one mask word
    gram = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    owner, of = rng.integers(0, 70, 6000), rng.choice(gram, 6000)
    f = langid.LanguageFilter.build(langs, owner, of)
    a, b = (f.cells[at] for at in f._at(of))
    masks = a & b
    assert ((masks[np.arange(6000), owner // 64] >> (owner % 64).astype(np.uint64)) & np.uint64(1)).all()
    by_hand = [sum(int(m[i // 64]) >> (i % 64) & 1 for m in masks) for i in range(70)]
    assert f._popcounts(masks).tolist() == by_hand
    assert (f._popcounts(masks[:, :1])[:0].size == 0) and f.chance.max() < 0.2


def test_grams():
    n = [len(langid.grams(t)) for t in ("", None, "12 !?", "a", "ab", "a b", "a1 2b")]
    assert n == [0, 0, 0, 3, 5, 6, 6]
    assert sorted(langid.grams("Ab cd")) == sorted(langid.grams("  ab--CD 9"))


def test_language_edges(spark, odd, empty):
    got = {}
    for r in langid.identify(odd).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert got[3] == got[4] == got[5] == [("und", 0.0)]
    assert sum(map(len, got.values())) == len(rows()) and all(p in ("en", "fr", "und") for x in got.values() for p, _ in x)
    assert langid.identify(empty).count() == 0
    unknown = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in langid.identify(unknown).collect()] == [(1, False, "und", 0.0)]


# --- toxicity --------------------------------------------------------------------

def test_toxicity_held_out_accuracy(spark):
    got = queries.op6_toxicity(spark, "/root/testdata/sf0.1").select("doc_id", "held_out", "score", "predicted").collect()
    t = pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pydict()
    y = dict(zip(t["doc_id"], t["toxic"]))
    assert len(got) == 10_000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == held(r.doc_id, 4, 2) for r in got)
    out = [(r.predicted, y[r.doc_id]) for r in got if r.held_out and y.get(r.doc_id) is not None]
    assert np.mean([p for p, q in out if q == 1]) > 0.9 and np.mean([p for p, q in out if q == 0]) < 0.02


def test_nearest_equals_brute_force():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(40)]
    counts = [{words[j]: int(rng.integers(1, 5)) for j in rng.choice(40, rng.integers(0, 6), replace=False)} for _ in range(700)]
    ids = rng.permutation(700).astype(np.int64) + 10
    index = toxicity.BlockMaxIndex.build(words, 1 + rng.random(40), ids, rng.integers(0, 2, 700), counts)
    order = [i for i in np.argsort(ids) if counts[i]]
    assert index.ids.tolist() == ids[order].tolist()
    dense = np.zeros((len(order), 40))
    for e, i in enumerate(order):
        t, w = index.vector(counts[i])
        dense[e, t] = w
    for e in range(0, len(order), 3):
        t, w = index.vector(counts[order[e]])
        sims = np.round(dense[:, t] @ w, 12)
        want = [x for x in np.lexsort((np.arange(len(sims)), -sims)) if sims[x] > 0 and x != e][:16]
        near, got = index.nearest(t, w, without=e)
        assert near.tolist() == want and np.allclose(got, sims[want])


def test_isotonic_rises_and_keeps_the_mean():
    x, y = np.array([0, 0, 1, 2, 3, 3, 4.]), np.array([0, 1, 0, 1, 1, 0, 1.])
    at, values = toxicity.isotonic(x, y)
    assert (np.diff(values) >= 0).all() and np.interp(x, at, values).sum() == pytest.approx(y.sum())


def test_toxicity_edges(odd, empty, labels, no_labels):
    for docs, n in ((odd, len(rows())), (empty, 0)):
        for lab in (labels, no_labels):
            got = toxicity.toxicity(docs, lab).collect()
            assert len(got) == n and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 and r.neighbours == [] for r in toxicity.toxicity(odd, no_labels).collect())
    assert {r.score for r in toxicity.toxicity(odd, labels).collect()} == {0.5}  # one text of each label, no term that tells


def test_op4_against_plain_gram_sets(spark):
    """Every prediction and score against sets of n-grams counted plainly from the same labelled texts."""
    from collections import Counter

    def plain(text):
        out = Counter()
        for w in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
            out.update(f" {w} "[i:i + n] for n in langid.SIZES for i in range(len(w) + 3 - n))
        return out

    docs = table(spark, SF, "documents").collect()
    counts, labelled = {}, Counter()
    for r in docs:
        if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            counts.setdefault(r.lang, Counter()).update(plain(r.text))
            labelled[r.lang] += 1
    freq = {x: {g: n / c.total() for g, n in c.items()} for x, c in counts.items()}
    top = Counter()
    for f in freq.values():
        for g, v in f.items():
            top[g] = max(top[g], v)
    own = {x: {g for g, v in f.items() if v >= langid.SHARE * top[g]} for x, f in freq.items()}
    assert max(map(len, own.values())) < langid.MAX_GRAMS and max(labelled.values()) < langid.MAX_DOCS  # all of them are learnt
    got = {r.doc_id: r for r in queries.op4_language(spark, SF).collect()}
    long = 0
    for r in docs:
        g = plain(r.text)
        if not g:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        hits = {x: sum(n for k, n in g.items() if k in s) for x, s in own.items()}
        best, second = sorted(hits.values())[-1], sorted(hits.values())[-2]
        if best - second > 0.1 * g.total():  # beyond what the filter's chance hits can turn
            assert got[r.doc_id].lang_pred == max(hits, key=hits.get)
        if g.total() > 500:
            long += 1
            assert abs(got[r.doc_id].score - hits[got[r.doc_id].lang_pred] / sum(hits.values())) < 0.03
    assert long > 50


def test_op6_against_plain_cosines_votes_and_calibration(spark):
    """The query's scores from dense vectors, all examples compared, and a calibration by plain averages."""
    from collections import Counter
    big = "/root/testdata/sf0.01"
    docs, labels = table(spark, big, "documents"), table(spark, big, "labels")
    model = toxicity.learn(docs, labels)
    text = {r.doc_id: r.text for r in docs.collect()}
    names = list(model.vocabulary)

    def dense(t):
        c = Counter(x for x in toxicity.terms(toxicity.words(t)) if x in model.vocabulary)
        v = np.array([(1 + np.log(c[x])) * model.idf[model.vocabulary[x]] if c[x] else 0.0 for x in names])
        return v / np.sqrt(v @ v) if v.any() else v

    examples = np.array([dense(text[i]) for i in model.ids.tolist()])

    def vote(v, without=None):
        sims = examples @ v
        near = [i for i in sorted(range(len(sims)), key=lambda i: (-round(sims[i], 12), i)) if sims[i] > 0 and i != without][:toxicity.NEIGHBOURS]
        w = np.array([sims[i] for i in near])
        return (sum(w * model.labels[near]) + toxicity.PRIOR * model.prior) / (w.sum() + toxicity.PRIOR) if near else model.prior

    votes = [vote(v, i) for i, v in enumerate(examples)]
    rows = {r.doc_id for r in labels.where("toxic in (0, 1)").collect() if r.doc_id in text}
    learnt = [i for i in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    pairs = sorted(zip(votes + [model.prior] * (len(learnt) - len(votes)), [*model.labels, *[model.prior] * (len(learnt) - len(votes))]))
    blocks = []
    for x, y in pairs:  # equal votes first, then pool what falls
        if blocks and blocks[-1][2] == x:
            blocks[-1][0] += y
            blocks[-1][1] += 1
        else:
            blocks.append([y, 1, x, x])
    i = 0
    while i + 1 < len(blocks):
        a, b = blocks[i], blocks[i + 1]
        if a[0] / a[1] >= b[0] / b[1]:
            blocks[i:i + 2] = [[a[0] + b[0], a[1] + b[1], a[2], b[3]]]
            i = max(0, i - 1)
        else:
            i += 1
    at, level = [p for b in blocks for p in b[2:]], [b[0] / b[1] for b in blocks for _ in (0, 1)]
    got = {r.doc_id: r for r in queries.op6_toxicity(spark, big).collect()}
    assert len(got) == len(text)
    for i, t in text.items():
        want = float(np.interp(vote(dense(t)), at, level))
        assert abs(got[i].score - want) < 1e-6 and got[i].predicted == int(got[i].score >= toxicity.THRESHOLD)

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from samples import rows

from collectra.llm import phrases as P

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, least, covered=80, top=2000):
    """docs: (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = {(lang, w[i:i + m]) for (lang, w), a in found.items() for m in range(2, len(w)) for i in range(len(w) - m + 1)
            if 100 * a >= covered * f[lang, w[i:i + m]]}
    by = defaultdict(list)
    for (lang, w), a in found.items():
        if (lang, w) not in gone:
            score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            by[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i, p.decode(), -a, x, y, n[lang], -s) for lang, rows in by.items()
                  for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1))


def mine(df, **kw):
    return sorted(map(tuple, P.phrases(df, **kw).collect()))


def test_odd_rows(odd):
    docs = [r[1:3] for r in rows()]
    want = brute(docs, 2)
    assert want and mine(odd, least=2) == want
    assert mine(odd, least=2, top=3) == brute(docs, 2, top=3)
    assert mine(odd, least=2, covered=50) == brute(docs, 2, covered=50)


def test_random_texts_in_small_slices(spark, monkeypatch):
    """Many phrases, few bytes at a time, more counters than the capacity."""
    rng = np.random.default_rng(5)
    words = ["a", "B", "ç", "de", "la", "x\x85y", "n\x00", "日本", *[f"w{i}" for i in range(300)]]
    docs = []
    for i in range(300):
        w = rng.choice(words, size=rng.integers(0, 60), p=np.r_[np.full(8, 0.08), np.full(300, 0.36 / 300)])
        seps = rng.choice([" ", "  ", "\t", ", ", ".", "\n", " ?! "], size=len(w))
        docs.append(("".join(a + b for a, b in zip(w, seps)), ["en", None, "fr", ""][i % 4]))
    df = spark.createDataFrame(docs, "text string, lang string").selectExpr("null as doc_id", "*").repartition(4)
    assert mine(df, least=5) == brute(docs, 5)
    # in this process: what the tasks do, in slices of 50 bytes
    monkeypatch.setattr(P, "SLICE", 50)
    import pyarrow as pa
    batch = pa.record_batch([pa.array([t for t, _ in docs]), pa.array([x if x is not None else "und" for _, x in docs])], names=["text", "lang"])
    got = Counter()
    for w in P.slices(batch):
        for n, at, _ in w.phrases([1, 2, 3, 4]):
            for lang, phrase, count in w.counted(n, at):
                got[lang, phrase] += count
    want = Counter()
    for text, lang in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", text.translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            want.update((lang if lang is not None else "und", " ".join(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    assert got == want


@pytest.mark.parametrize("seed", range(5))
def test_summary_keeps_every_frequent_fingerprint(seed):
    """However the stream is cut, with the least capacity that the rule allows."""
    rng = np.random.default_rng(seed)
    stream = rng.permutation(np.r_[rng.integers(0, 1 << 40, 5000), np.repeat(rng.integers(0, 1 << 40, 40), rng.integers(25, 40, 40))]).astype(np.uint64)
    s = P.Summary(len(stream) // 30 + 1)
    for part in np.array_split(stream, 37):
        s.add(*np.unique(part, return_counts=True))
    kept = set(s.may_reach(30).tolist())
    fps, n = np.unique(stream, return_counts=True)
    assert set(fps[n >= 30].tolist()) <= kept and len(s.fps) <= s.capacity and s.lost < 30


def test_filter(spark):
    fps = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 3000)
    f = P.Filter.of(spark.createDataFrame([(int(x),) for x in fps], "fp long"))
    assert f(fps.view(np.uint64)).all()
    assert f(np.random.default_rng(2).integers(0, 1 << 63, 10_000).astype(np.uint64)).mean() < 0.05


def test_large_counts_are_exact(spark):
    """Scores of counts whose product with 2,000,000 passes 64 bits."""
    big = 9_000_000_000_000_000_000
    df = spark.createDataFrame([("en", "a b", ["a", "b"], big - 1), ("en", "a", ["a"], big), ("en", "b", ["b"], big + 7)],
                               "lang string, phrase string, words array<string>, f long")
    r = P.scored(df).first()
    assert r.score == 2_000_000 * (big - 1) // (2 * big + 7) and (r.l, r.r) == (big, big + 7)


def test_empty(spark, empty):
    assert mine(empty) == []
    assert mine(spark.createDataFrame([(1, None, None), (2, "", "en")], "doc_id long, text string, lang string"), least=1) == []

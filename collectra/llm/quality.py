"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text (counts and shares over the whole text) is cut into
quantile bins.  Cyclic boosting: round after round, one shallow tree per feature
is fitted to the gradients of the logistic loss and added, with a small rate, to
that feature's lookup table.  The pairs of features whose joint tree explains
most of what is left then get two-dimensional tables in the same way.  A score is
the logistic function of a sum of table entries, found by binning all texts of a
batch at once.

Learning takes about ``MAX_ROWS`` labelled documents (by a hash of the id; the
bound is a parameter); their features, not their texts, come to the driver.
Labels, language, source and id are not features.

Edge cases: null and empty texts have the features of an empty text and get a
score; null labels, labels other than 0 and 1 and labels of unknown documents are
not used; without labels, or with one class only, all scores are the share of
label 1 (0.5 if there are none).  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collectra.llm.common import bounded_sample, fold, label_rows, pick, texts

MAX_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 10
ROUNDS = 150
RATE = 0.15
LEAVES = 3
MIN_HESSIAN = 2.0
RIDGE = 1.0
THRESHOLD = 0.3

FEATURES = [
    "log_bytes", "log_words", "word_length", "word_length_sd", "long_words", "upper", "digits", "spaces", "line_breaks",
    "full_stops", "commas", "other_marks", "non_ascii", "distinct_words", "top_word", "repeated_lines", "line_words",
    "marked_words", "sentence_words", "repeated_neighbours", "capital_words",
]
_UPPER, _DIGIT = np.arange(65, 91), np.arange(48, 58)
_MARKS = np.array([b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,'-"])


def features(text: str | None) -> np.ndarray:
    raw = (text or "").encode("utf-8", "replace")
    n = len(raw)
    if not n:
        return np.zeros(len(FEATURES))
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1, np.int64)
    w = max(1, len(words))
    seen: dict[bytes, int] = {}
    for x in words:
        seen[x] = seen.get(x, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    marks = c[_MARKS].sum()
    return np.array([
        np.log1p(n), np.log1p(len(words)), lengths.mean(), lengths.std(), (lengths > 12).mean(),
        c[_UPPER].sum() / n, c[_DIGIT].sum() / n, c[32] / n, c[10] / n, c[46] / n, c[44] / n, marks / n,
        c[128:].sum() / n, len(seen) / w, max(seen.values(), default=0) / w,
        1 - len(set(lines)) / max(1, len(lines)), w / max(1, len(lines)), marks / w, w / (1 + c[46]),
        sum(a == b for a, b in zip(words, words[1:])) / w, sum(x[:1].isupper() for x in words) / w,
    ])


def feature_rows(batch) -> np.ndarray:
    return np.stack([features(t) for t in batch]) if len(batch) else np.zeros((0, len(FEATURES)))


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _leaf(g, h):
    return -g / (h + RIDGE)


def _gain(g, h):
    return g * g / (h + RIDGE)


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Values per bin of a tree with ``leaves`` leaves over sums of gradients by bin."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None)
        for i, (a, b) in enumerate(parts):
            gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            if not len(gl):
                continue
            gr, hr = g[a:b].sum() - gl, h[a:b].sum() - hl
            gain = np.where((hl >= MIN_HESSIAN) & (hr >= MIN_HESSIAN), _gain(gl, hl) + _gain(gr, hr) - _gain(gl + gr, hl + hr), 0)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (i, a + k + 1))
        if best[1] is None:
            break
        i, cut = best[1]
        a, b = parts[i]
        parts[i:i + 1] = [(a, cut), (cut, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def shallow_tree_2d(g: np.ndarray, h: np.ndarray):
    """Values per cell of a tree that cuts rows once and each half's columns once; its gain."""
    best, out = 0.0, np.zeros_like(g)
    whole = _gain(g.sum(), h.sum())
    for cut in range(1, g.shape[0]):
        gain, made = -whole, np.zeros_like(g)
        for rows in (slice(0, cut), slice(cut, None)):
            gc, hc = g[rows].sum(axis=0), h[rows].sum(axis=0)
            if hc.sum() < MIN_HESSIAN:
                break
            values = shallow_tree(gc, hc, 2)
            edge = np.flatnonzero(np.diff(values))
            k = edge[0] + 1 if len(edge) else len(gc)
            gain += _gain(gc[:k].sum(), hc[:k].sum()) + (_gain(gc[k:].sum(), hc[k:].sum()) if k < len(gc) else 0)
            made[rows] = values
        else:
            if gain > best:
                best, out = gain, made
    return out, best


@dataclass
class AdditiveModel:
    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, f], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[np.searchsorted(self.pair_cuts[a], x[:, a], side="right"),
                           np.searchsorted(self.pair_cuts[b], x[:, b], side="right")]
        return _logistic(total)


def _quantile_cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="lower"))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS) -> AdditiveModel:
    """``x``: (rows, features), ``y``: 0 or 1."""
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return AdditiveModel(float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    m = AdditiveModel(float(np.log(y.mean() / (1 - y.mean()))))
    total = np.full(len(y), m.base)
    n = x.shape[1]
    m.cuts = [_quantile_cuts(x[:, f], BINS) for f in range(n)]
    at = [np.searchsorted(m.cuts[f], x[:, f], side="right") for f in range(n)]
    m.tables = [np.zeros(len(c) + 1) for c in m.cuts]

    def sums(where, size):
        p = _logistic(total)
        return np.bincount(where, p - y, size), np.bincount(where, p * (1 - p), size)

    for _ in range(rounds):
        for f in range(n):  # one feature after the other, each on what is left
            add = RATE * shallow_tree(*sums(at[f], len(m.tables[f])))
            m.tables[f] += add
            total += add[at[f]]
    m.pair_cuts = [_quantile_cuts(x[:, f], PAIR_BINS) for f in range(n)]
    low = [np.searchsorted(m.pair_cuts[f], x[:, f], side="right") for f in range(n)]
    size = [len(c) + 1 for c in m.pair_cuts]

    def grid(a, b):
        g, h = sums(low[a] * size[b] + low[b], size[a] * size[b])
        return g.reshape(size[a], size[b]), h.reshape(size[a], size[b])

    gains = sorted(((shallow_tree_2d(*grid(a, b))[1], a, b) for a in range(n) for b in range(a + 1, n)), reverse=True)
    m.pairs = [(a, b) for gain, a, b in gains[:pairs] if gain > 0]
    m.pair_tables = [np.zeros((size[a], size[b])) for a, b in m.pairs]
    for _ in range(rounds // 3):
        for (a, b), table in zip(m.pairs, m.pair_tables, strict=True):
            add = RATE * shallow_tree_2d(*grid(a, b))[0]
            table += add
            total += add[low[a], low[b]]
    return m


def learn(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, label: str = "quality", max_rows: int = MAX_ROWS) -> AdditiveModel:
    def made(batch: pd.Series) -> pd.Series:
        return pd.Series(list(feature_rows(batch)))

    rows = label_rows(labels, label, parts, held)
    sample = bounded_sample(rows, "doc_id", max_rows, rows.count())
    found = (texts(docs).join(sample, "doc_id").select("doc_id", "y", F.pandas_udf(made, "array<double>")("text").alias("x"))
             .toPandas().sort_values("doc_id", kind="stable").drop_duplicates("doc_id"))  # about max_rows short rows
    x = np.stack(found["x"].to_numpy()) if len(found) else np.zeros((0, len(FEATURES)))
    return fit(x, found["y"].to_numpy(dtype=np.float64))


def score_udf(spark: SparkSession, model: AdditiveModel):
    """A function of a text column: score (0 to 1, higher: label 1 likelier). The tables (some 20 kB) are broadcast."""
    sent = spark.sparkContext.broadcast(model)

    def score(batch: pd.Series) -> pd.Series:
        return pd.Series(sent.value.score(feature_rows(batch)))

    return F.pandas_udf(score, "double")


def quality(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    score = score_udf(docs.sparkSession, learn(docs, labels, parts, held))
    d = pick(docs, "doc_id", "text").withColumn("score", score(F.col("text").cast("string")))
    return d.select("doc_id", fold("doc_id", parts, held).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

"""Toxicity: votes of the nearest labelled examples by exact TF-IDF cosine.

*Terms* are words and the beginnings of words (``BEGINNINGS`` letters) whose
presence in the labelled texts depends on the label, so that likeness means
likeness in what the label is about: log odds of at least ``STRONG`` between the
labels, in at least ``MIN_TEXTS`` different texts, and a chi-square of at least
``SIGNIFICANT`` times the logarithm of the number of terms that are tested.  The
first does not depend on the number of texts, the last only keeps chance terms
out (of m tested terms about m ** -0.5 pass by chance); fifty labelled texts are
enough if a word tells them apart.  ``MIN_TEXTS`` leaves out words that fewer
labelled texts hold; if more than ``MAX_TERMS`` qualify, those of the largest
chi-square are taken.  Vectors are (1 + log tf) * idf, of length one.

*Index.*  Examples that have a term stand in blocks of ``BLOCK``; a term's
postings keep, per block, their entries and the largest weight.  A query adds up
the largest weights of its terms for each block, which bounds all cosines there.
It scores the blocks of the highest bounds, then those whose bound reaches the
k-th cosine so far; the others are skipped.  So the ``NEIGHBOURS`` nearest
examples are exact.

*Vote.*  Neighbours vote for their label with their cosine as weight; examples
that share no term have cosine 0 and stand in as one vote of weight ``PRIOR``
for their own share of label 1.  The vote is calibrated on the examples
themselves, each left out in turn, as the share of label 1 among like votes
(isotonic).  Neighbours and cosines are the evidence.

Learning takes about ``MAX_ROWS`` labelled documents (by a hash of the id; the
bound is a parameter).  Labels, language, source and id are no input of a score.

Edge cases: null and empty texts, and texts without any term, get the calibrated
prior; nearest ties go to the smaller example id; null labels, labels other than
0 and 1 and labels of unknown documents are not used; without labels of both
kinds all scores are the share of label 1 (0 if there are none).  Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collectra.llm.common import bounded_sample, fold, label_rows, pick, texts, written

MAX_ROWS = 20_000
MAX_TERMS = 16_384
SIGNIFICANT = 3.0
STRONG = 3.0
MIN_TEXTS = 5
BEGINNINGS = (5, 6, 7, 8, 9)
NEIGHBOURS = 16
BLOCK = 32
PRIOR = 0.05
THRESHOLD = 0.3

WORD = re.compile(r"[^\W_]+")
FIRST = min(BEGINNINGS)


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def terms(found: list[str]) -> list[str]:
    """The words and their beginnings (marked by a star)."""
    return found + [w[:n] + "*" for n in BEGINNINGS for w in found if len(w) > n]


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


@dataclass
class BlockMaxIndex:
    """Unit vectors of examples, by term and block of examples.

    ``entry``: first (term, block) entry of each term; an entry has its block, the
    largest weight, and the range of its postings (example, weight).
    """

    vocabulary: dict[str, int]
    idf: np.ndarray
    ids: np.ndarray  # of the examples that have a term, rising
    labels: np.ndarray
    entry: np.ndarray
    block: np.ndarray
    most: np.ndarray
    start: np.ndarray
    length: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    prior: float = 0.0  # share of label 1 among the examples without a term
    steps: tuple = ((0.0,), (0.0,))  # votes, and the calibrated score at each

    @classmethod
    def build(cls, vocabulary: list[str], idf: np.ndarray, ids: np.ndarray, labels: np.ndarray, counts: list[dict[str, int]]) -> BlockMaxIndex:
        """``ids``, ``labels`` and ``counts`` (of terms): the examples."""
        none = np.zeros(0, np.int64)
        index = cls({t: i for i, t in enumerate(vocabulary)}, idf, none, none, none, none, none, none, none, none, none)
        order = [i for i in np.argsort(ids, kind="stable") if counts[i]]
        index.ids, index.labels = ids[order], labels[order].astype(np.float64)
        vectors = [index.vector(counts[i]) for i in order]
        size = [len(t) for t, _ in vectors]
        term = np.concatenate([t for t, _ in vectors]) if vectors else none
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        example = np.repeat(np.arange(len(order)), size) if vectors else none
        by = np.lexsort((example, term))
        term, index.example, index.weight = term[by], example[by], weight[by]
        key = term * (1 + len(order) // BLOCK) + index.example // BLOCK
        index.start = np.flatnonzero(np.diff(key, prepend=-1))
        index.length = np.diff(index.start, append=len(key))
        index.block = index.example[index.start] // BLOCK
        index.most = np.maximum.reduceat(index.weight, index.start) if len(key) else np.zeros(0)
        index.entry = np.searchsorted(term[index.start], np.arange(len(vocabulary) + 1))
        bare = np.array([not c for c in counts], dtype=bool)
        if len(labels):
            index.prior = float(labels[bare].mean()) if bare.any() else float(labels.mean())
        return index

    def counts(self, text: str | None) -> dict[str, int]:
        """How often the text has each term of the vocabulary."""
        gate, vocabulary = self.gate, self.vocabulary
        return Counter([t for t in terms([w for w in words(text) if w[:FIRST] in gate]) if t in vocabulary])

    @cached_property
    def gate(self) -> set[str]:
        """First letters of all terms: most words go no further."""
        return {t[:FIRST] for t in self.vocabulary}

    def vector(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of a text, of length one."""
        t = np.fromiter((self.vocabulary[x] for x in counts), dtype=np.int64, count=len(counts))
        w = (1 + np.log(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))) * self.idf[t]
        norm = np.sqrt((w * w).sum())
        return t, w / norm if norm else w

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of the largest cosine over 0, and the cosines; ties to the smaller id."""
        size = self.entry[t + 1] - self.entry[t]
        entries = _spread(self.entry[t], size)
        q = np.repeat(w, size)
        bound = np.bincount(self.block[entries], q * self.most[entries])
        first = np.argsort(-bound, kind="stable")[: 1 + k // BLOCK * 2]
        open_ = np.zeros(len(bound), dtype=bool)
        open_[first] = True
        best, sims = self._score(entries, q, open_, k, without)
        rest = (bound > 0) & ~open_
        if len(best) >= k:
            rest &= bound >= sims[k - 1] - 1e-9
        if rest.any():
            more, also = self._score(entries, q, rest, k, without)
            best, sims = self._top(np.r_[best, more], np.r_[sims, also], k)
        return best, sims

    def _score(self, entries, q, blocks, k, without):
        """The best examples of the blocks."""
        use = blocks[self.block[entries]]
        e, q = entries[use], q[use]
        at = _spread(self.start[e], self.length[e])
        found = np.bincount(self.example[at], np.repeat(q, self.length[e]) * self.weight[at])
        new = np.flatnonzero(found > 0)
        new = new[new != without]
        return self._top(new, found[new], k)

    @staticmethod
    def _top(examples, sims, k):
        top = np.lexsort((examples, -np.round(sims, 12)))[:k]
        return examples[top], sims[top]

    def vote(self, examples: np.ndarray, sims: np.ndarray) -> float:
        return float((sims @ self.labels[examples] + PRIOR * self.prior) / (sims.sum() + PRIOR))

    def calibrate(self, counts: list[dict[str, int]], bare: int) -> None:
        """``steps`` from the examples, each without itself; ``bare`` of them have no term.

        ``counts``: of the examples that have a term, by rising id.
        """
        votes = [self.vote(*self.nearest(*self.vector(c), without=e)) for e, c in enumerate(counts)]
        votes, labels = np.array(votes + [self.prior] * bare), np.r_[self.labels, np.full(bare, self.prior)]
        if len(votes):
            self.steps = isotonic(votes, labels)

    def score(self, text: str | None) -> tuple[float, np.ndarray, np.ndarray]:
        counts = self.counts(text)
        near, sims = self.nearest(*self.vector(counts)) if counts else (np.zeros(0, np.int64), np.zeros(0))
        return float(np.interp(self.vote(near, sims), *self.steps)), self.ids[near], sims


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the rising line nearest to ``y`` over ``x`` (pool adjacent violators)."""
    values, at, n = np.unique(x, return_inverse=True, return_counts=True)
    pools: list[list[float]] = []  # mean, weight, first value, last value
    for v, s, m in zip(values, np.bincount(at, y), n, strict=True):
        pools.append([s / m, m, v, v])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            w = a[1] + b[1]
            pools.append([(a[0] * a[1] + b[0] * b[1]) / w, w, a[2], b[3]])
    return (np.array([p for pool in pools for p in pool[2:]]), np.array([pool[0] for pool in pools for _ in (0, 1)]))


def learn(docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2, label: str = "toxic", max_rows: int = MAX_ROWS) -> BlockMaxIndex:
    spark = docs.sparkSession
    rows = label_rows(labels, label, parts, held)
    sample = bounded_sample(rows, "doc_id", max_rows, rows.count())
    labelled = texts(docs).join(sample, "doc_id").select("doc_id", "y", "text")

    labelled = written(spark, labelled.dropDuplicates(["doc_id"]).withColumn("copy", F.xxhash64("text")), "labelled")
    # copies of a text tell no more about a term than the text
    single = labelled.groupBy("copy").agg(F.min("doc_id").alias("doc_id"), F.max("y").alias("y"))
    n, positive = single.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    got = labelled.select("doc_id", "y").toPandas().sort_values("doc_id")  # about max_rows rows
    counts: dict[int, dict[str, int]] = {i: {} for i in got["doc_id"].tolist()}
    vocabulary, idf = [], np.zeros(0)

    def present(batches):
        """Texts and texts of label 1 with each term, summed over some documents at a time."""
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256).to_pydict()
                all_, ones = Counter(), Counter()
                for text, y in zip(part["text"], part["y"], strict=True):
                    found = set(terms(words(text)))
                    all_.update(found)
                    if y:
                        ones.update(found)
                yield pa.record_batch([pa.array(list(all_), pa.string()), pa.array(list(all_.values()), pa.int64()),
                                       pa.array([ones[t] for t in all_], pa.int64())], names=["term", "texts", "with_1"])

    if 0 < positive < n:
        table = written(spark, labelled.drop("y").join(single.select("doc_id", "y"), "doc_id").select("text", "y")
                 .mapInArrow(present, "term string, texts long, with_1 long")
                 .groupBy("term").agg(F.sum("texts").alias("texts"), F.sum("with_1").alias("with_1")).where(F.col("texts") >= MIN_TEXTS), "terms")
        tested = max(2, table.count())
        # chi-square of the two-by-two table of presence and label
        a, m, p = F.col("with_1").cast("double"), F.col("texts").cast("double"), positive / n
        off = a - m * F.lit(p)
        chi = off * off / (m * F.lit(p) * F.lit(1 - p) * (1 - m / F.lit(float(n))) + F.lit(1e-9))
        # log odds of the term between the labels, each count with a half more
        odds = F.log((a + 0.5) / (positive - a + 0.5)) - F.log((m - a + 0.5) / ((n - positive) - (m - a) + 0.5))
        chosen = (table.withColumn("chi", chi).where((F.col("chi") >= SIGNIFICANT * math.log(tested)) & (F.abs(odds) >= STRONG))
                  .orderBy(F.desc("chi"), "term").limit(MAX_TERMS).toPandas().sort_values("term"))
        vocabulary, idf = chosen["term"].tolist(), np.log1p(n / chosen["texts"].to_numpy(dtype=np.float64))
        sent = spark.sparkContext.broadcast(set(vocabulary))  # at most MAX_TERMS words

        def counted(batches):
            for b in batches:
                part = b.to_pydict()
                rows = [(i, t, c) for i, text in zip(part["doc_id"], part["text"], strict=True)
                        for t, c in Counter(t for t in terms(words(text)) if t in sent.value).items()]
                yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.int64()))],
                                      names=["doc_id", "term", "n"])

        # the chosen terms of about max_rows documents
        found = (labelled.select(F.col("doc_id").cast("long"), "text").mapInArrow(counted, "doc_id long, term string, n long")
                 .toPandas().sort_values(["doc_id", "term"]))
        for i, t, c in zip(found["doc_id"].tolist(), found["term"].tolist(), found["n"].tolist(), strict=True):
            counts[i][t] = c
    index = BlockMaxIndex.build(vocabulary, idf, got["doc_id"].to_numpy(np.int64), got["y"].to_numpy(np.int64), list(counts.values()))
    index.calibrate([c for c in counts.values() if c], sum(not c for c in counts.values()))
    return index


def score_udf(spark: SparkSession, model: BlockMaxIndex):
    """A function of a text column: struct of score and the evidence (examples' ids and cosines, nearest first).

    The index is broadcast: at most about ``MAX_ROWS`` vectors over ``MAX_TERMS`` terms.
    """
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("score double, neighbours array<long>, cosines array<double>")
    def score(batch: pd.Series) -> pd.DataFrame:
        model = sent.value
        return pd.DataFrame([model.score(t) for t in batch], columns=["score", "neighbours", "cosines"])

    return score


def toxicity(docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted, neighbours, cosines for every row."""
    score = score_udf(docs.sparkSession, learn(docs, labels, parts, held))
    d = pick(docs, "doc_id", "text").withColumn("s", score(F.col("text").cast("string")))
    return d.select("doc_id", fold("doc_id", parts, held).alias("held_out"), "s.score",
                    (F.col("s.score") >= THRESHOLD).cast("int").alias("predicted"), "s.neighbours", "s.cosines")

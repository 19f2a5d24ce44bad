"""Language identification with language-bitmask n-gram filters.

The n-grams of each language (letters in lower case, words padded with a space)
are kept in one bit-sliced Bloom filter: a cell is a bitmask with a bit for each
language, so looking up an n-gram (the AND of its cells) gives all languages
that hold it in one step.  The score of a language is the number of n-grams of
the text that it holds, less the number that its share of set bits would give by
chance; the largest decides.

An n-gram belongs to a language if its frequency there is at least ``SHARE`` of
its highest frequency in any language, so contamination of the labelled texts
does not make every n-gram belong to all.  Learning takes a sample of about
``MAX_DOCS`` labelled documents per language (by a hash of the id; the bound is
a parameter), their n-grams are counted as a Spark aggregate and the
``MAX_GRAMS`` most frequent per language fill the filter.

Edge cases: a null text or one without letters is ``und`` with score 0; ties go
to the language with more sampled documents, then by name; without any labelled
document every text is ``und``.  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from collectra.llm.common import fold, pick, written

SIZES = (2, 3)
HASHES = 2
SHARE = 0.4
MAX_DOCS = 2_000
MAX_GRAMS = 32_768
CELLS_PER_GRAM = 8

_letter: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters; made once per process."""
    if not _letter:
        _letter.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _letter[0]


def grams(text: str | None) -> np.ndarray:
    """Hashes of all n-grams of the whole text, repeats included."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype="<u4")
    c = np.where(letters()[c], c, np.uint32(32))
    c = c[np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]] if len(c) else c  # one space for a gap
    if not (c != 32).any():
        return np.zeros(0, np.uint64)
    c = np.concatenate([[32], c[int(c[0] == 32):], [32][: int(c[-1] != 32)]]).astype(np.uint64)
    out = []
    for n in SIZES:
        if len(c) < n:
            continue
        x = np.full(len(c) - n + 1, n, dtype=np.uint64)
        inner = np.zeros(len(x), dtype=bool)
        for i in range(n):
            part = c[i:len(c) - n + 1 + i]
            x = (x ^ part) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
            if 0 < i < n - 1:
                inner |= part == 32
        out.append(x[~inner])  # no n-gram reaches over a gap
    return np.concatenate(out)


@dataclass
class LanguageFilter:
    """``cells[h]``: bitmask words of a cell; ``chance``: how likely a language holds any n-gram."""

    langs: list[str]
    cells: np.ndarray  # (cells, words) uint64
    chance: np.ndarray

    @classmethod
    def build(cls, langs: list[str], lang: np.ndarray, gram: np.ndarray) -> LanguageFilter:
        """``lang[i]``: the index of the language that holds ``gram[i]``."""
        m = 1 << max(10, int(np.ceil(np.log2(max(1, len(np.unique(gram)) * CELLS_PER_GRAM)))))
        f = cls(langs, np.zeros((m, -(-len(langs) // 64)), dtype=np.uint64), np.zeros(0))
        for at in f._at(gram):
            np.bitwise_or.at(f.cells, (at, lang // 64), np.uint64(1) << (lang % 64).astype(np.uint64))
        f.chance = f._popcounts(f.cells) / m
        f.chance **= HASHES
        return f

    def _at(self, gram: np.ndarray):
        m = np.uint64(len(self.cells) - 1)
        step = (gram >> np.uint64(32)) | np.uint64(1)
        return [((gram + np.uint64(i) * step) & m).astype(np.int64) for i in range(HASHES)]

    def _popcounts(self, masks: np.ndarray) -> np.ndarray:
        """For each language the number of masks that have its bit."""
        values, n = (np.unique(masks[:, 0], return_counts=True) if masks.shape[1] == 1 else (None, None))
        if values is not None:  # few masks are different: count each once
            bits = (values[:, None] >> np.arange(len(self.langs), dtype=np.uint64)) & np.uint64(1)
            return (bits.astype(np.int64) * n[:, None]).sum(axis=0)
        return np.array([((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).sum() for i in range(len(self.langs))], dtype=np.int64)

    def predict(self, text: str | None) -> tuple[str, float]:
        g = grams(text)
        if not len(g) or not self.langs:
            return "und", 0.0
        hits = np.zeros(len(self.langs))
        for i in range(0, len(g), 1 << 16):  # bounded memory for very long texts
            masks = None
            for at in self._at(g[i:i + (1 << 16)]):
                masks = self.cells[at] if masks is None else masks & self.cells[at]
            hits += self._popcounts(masks)
        true = np.maximum(0.0, (hits - len(g) * self.chance) / np.maximum(1e-9, 1 - self.chance))
        best = int(np.argmax(true))
        total = true.sum()
        return self.langs[best], float(true[best] / total) if total else 0.0


def learn(docs: DataFrame, parts: int = 4, held: int = 2, max_docs: int = MAX_DOCS, max_grams: int = MAX_GRAMS) -> LanguageFilter:
    """Learns from text and non-null lang of rows that are not held out."""
    spark = docs.sparkSession
    d = pick(docs, "doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    d = d.where(~fold("doc_id", parts, held))
    sizes = {r.lang: r.n for r in d.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    langs = sorted(sizes, key=lambda x: (-min(sizes[x], max_docs), x))
    if not langs:
        return LanguageFilter([], np.zeros((1, 1), np.uint64), np.zeros(0))
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, max_docs / n))]), F.col("lang"))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = d.where(draw < share).select("lang", "text")

    def count(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256).to_pydict()
                by: dict[str, list] = {}
                for lang, text in zip(part["lang"], part["text"], strict=True):
                    by.setdefault(lang, []).append(grams(text))
                for lang, found in by.items():
                    g, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.record_batch([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n)],
                                          names=["lang", "gram", "n"])

    counts = written(spark, sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram")
                     .agg(F.sum("n").alias("n")), "grams")
    total = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not total:
        return LanguageFilter([], np.zeros((1, 1), np.uint64), np.zeros(0))
    all_of = F.element_at(F.create_map(*[F.lit(x) for k, n in total.items() for x in (k, n)]), F.col("lang"))
    freq = counts.withColumn("f", F.col("n") / all_of)
    own = freq.withColumn("top", F.max("f").over(Window.partitionBy("gram"))).where(F.col("f") >= SHARE * F.col("top"))
    # the frequency that leaves about max_grams of a language: a quantile by language, not a sort of each
    kinds = {r.lang: (r.n, r.cuts) for r in own.groupBy("lang").agg(
        F.count("*").alias("n"), F.percentile_approx("n", [i / 256 for i in range(257)], 10_000).alias("cuts")).collect()}
    least = {k: (cuts[min(256, int(np.ceil(256 * (1 - max_grams / n))))] if n > max_grams else 1) for k, (n, cuts) in kinds.items()}
    floor = F.element_at(F.create_map(*[F.lit(x) for k, n in least.items() for x in (k, int(n))]), F.col("lang"))
    at = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(langs) for x in (k, i)]), F.col("lang"))
    kept = own.where(F.col("n") >= floor).select(at.alias("lang"), "gram").toPandas()  # at most some max_grams per language
    return LanguageFilter.build(langs, kept["lang"].to_numpy(np.int64), kept["gram"].to_numpy(np.int64).view(np.uint64))


def predict_udf(spark: SparkSession, model: LanguageFilter):
    """A function of a text column: struct of lang_pred and score.

    The filter is broadcast: ``CELLS_PER_GRAM`` cells for each of at most
    ``MAX_GRAMS`` n-grams of a language.
    """
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        model = sent.value
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    model = learn(docs, parts, held)
    p = predict_udf(docs.sparkSession, model)
    d = pick(docs, "doc_id", "text").withColumn("p", p(F.col("text").cast("string")))
    return d.select("doc_id", fold("doc_id", parts, held).alias("held_out"), "p.lang_pred", "p.score")

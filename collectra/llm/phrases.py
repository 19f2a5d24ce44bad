"""Phrase (collocation) mining: Misra-Gries summaries, then exact counts.

A phrase of 1 to 4 words of one language is *frequent* if it occurs ``LEAST``
times or more in the corpus.

1. *Summaries.*  Every scan task counts the 64-bit fingerprints of its phrases
   and cuts them by the fingerprint's high bits into hash partitions: one
   summary each.  A count is clipped at ``LEAST`` (a phrase that reaches it in
   one summary is frequent, whatever the others say), so a hot phrase weighs no
   more than ``LEAST`` per summary.  The summaries of a hash partition meet in
   one task and merge: counters of equal fingerprints add up, and when more than
   the capacity are left, the next largest count is subtracted from all.  The
   capacity exceeds mass / ``LEAST``, so all that is subtracted together stays
   below ``LEAST`` and a frequent phrase keeps a counter.  A counter that cannot
   reach ``LEAST`` even with all that was subtracted goes.
2. *Shorter ones first.*  A frequent phrase holds frequent phrases only, so words
   are summarised first, then pairs of words that may be frequent, and so on:
   phrases of n words are taken only where both of n - 1 words survived.  This
   keeps the mass of the longer summaries small, at one reading of the texts each.
3. *Exact counts.*  The texts are read again; phrases that may be survivors are
   counted by their words (not by fingerprints) and summed in Spark.  Survivors
   are tested in bit filters of at most ``MAX_BITS`` bits; what passes by
   chance, or because more survive than the filter has room for, is counted
   exactly like the rest and falls below ``LEAST``.

Scores, the test against longer candidates and the ranks are DataFrame joins of
the frequent phrases.

Edge cases: a null text has no words, a null language is ``und``; repeated rows
count each time; an empty table or one without frequent phrases gives no rows;
words longer than any bound are kept whole.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from collectra.llm.common import ship, texts, written

LEAST = 30
LONGEST = 4
COVERED = 80  # percent of a candidate's occurrences that a longer one has to hold
TOP = 2000
SLICE = 2 << 20  # bytes of text handled at a time
HELD = 1 << 20  # fingerprints of one task's summaries
CAPACITY = 1 << 20  # counters that a hash partition should need
ROW = 4096  # counters in one row of a summary: keeps what is shuffled and sent to Python in small pieces
PARTS = 6  # bits of a fingerprint that name its hash partition, at least
KEPT = 5  # bytes of a fingerprint beside them
DROPPED = 64 - PARTS - 8 * KEPT  # low bits that no summary holds, at most
MAX_BITS = 1 << 27  # of the filter of the survivors of one length: 16 MB at most
KEY_BITS = 16  # bits of the filter for each survivor

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09]] = True
_CUT = np.zeros(256, dtype=bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """The words of a slice of texts: ids, fingerprints, and which follow each other in a piece."""

    def __init__(self, data: np.ndarray, doc_starts: np.ndarray, lang_of: np.ndarray, langs: list[str]):
        """``data``: bytes of texts one after the other; ``doc_starts``: where each begins; ``lang_of``: its language."""
        data = _LOWER[data]
        cut = _CUT[data]
        word = ~(cut | _BLANK[data])
        first = np.zeros(len(data) + 1, dtype=bool)
        first[doc_starts[doc_starts < len(data)]] = True
        starts = word.copy()
        starts[1:] &= ~word[:-1] | first[1:-1]
        ends = word.copy()
        ends[:-1] &= ~word[1:] | first[1:-1]
        at = np.flatnonzero(starts)
        self.n = len(at)
        sizes = np.flatnonzero(ends) + 1 - at
        doc = np.searchsorted(doc_starts, at, side="right") - 1
        piece = np.cumsum(cut, dtype=np.int32)[at]
        self.linked = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])
        # the bytes of the words without gaps are an Arrow array: its dictionary gives exact ids
        offsets = np.zeros(self.n + 1, dtype=np.int32)
        np.cumsum(sizes, out=offsets[1:])
        encoded = pa.Array.from_buffers(pa.binary(), self.n, [None, pa.py_buffer(offsets), pa.py_buffer(data[word])]).dictionary_encode()
        self.words = encoded.dictionary.to_pylist()
        ids = encoded.indices.to_numpy()
        self.lang, self.langs = lang_of[doc], langs
        self.ids = self.lang.astype(np.int64) * max(1, len(self.words)) + ids
        plain = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.words), dtype=np.uint64, count=len(self.words))
        salt = np.fromiter((xxhash.xxh64_intdigest(x, 1) for x in langs), dtype=np.uint64, count=len(langs))
        self.fp = mixed(plain[ids] ^ salt[self.lang]) if self.n else np.zeros(0, np.uint64)

    def phrases(self, sizes, filters=()) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words, positions, fingerprints) of the phrases of each of ``sizes``.

        ``filters``: of the phrases of 1, 2, ... words that may be frequent; a
        phrase is taken only if its filter has it and the two of one word less
        that it holds were taken.
        """
        fp, at = self.fp, np.arange(self.n)
        for n in range(1, max(sizes) + 1):
            if n > 1:
                taken = np.zeros(self.n + 1, dtype=bool)
                taken[at] = True
                ok = taken[at + 1]  # its words after the first
                ok[ok] = self.linked[at[ok] + n - 2]
                at = at[ok]
                fp = mixed(fp[ok] * np.uint64(0x9E3779B97F4A7C15) + self.fp[at + n - 1])
            if n <= len(filters):
                ok = filters[n - 1](fp)
                at, fp = at[ok], fp[ok]
            if n in sizes:
                yield n, at, fp

    def counted(self, n: int, at: np.ndarray) -> Iterator[tuple[str, str, int]]:
        """(language, phrase, count) of the phrases of ``n`` words at ``at``, told apart by their words."""
        if not len(at):
            return
        codes = self.ids[at]
        for i in range(1, n):
            codes = pd.factorize(codes)[0].astype(np.int64) << 32 | pd.factorize(self.ids[at + i])[0]
        codes, kinds = pd.factorize(codes)
        first = np.empty(len(kinds), dtype=np.int64)
        first[codes[::-1]] = at[::-1]
        plain = self.ids % len(self.words)
        for p, count in zip(first.tolist(), np.bincount(codes).tolist(), strict=True):
            yield self.langs[self.lang[p]], b" ".join([self.words[w] for w in plain[p:p + n].tolist()]).decode(), count


def slices(batch: pa.RecordBatch) -> Iterator[Words]:
    """The words of a batch (text, lang), some ``SLICE`` bytes at a time.

    Slices end where a text or a piece ends, so no phrase is cut.
    """
    text = batch.column(0).cast(pa.large_string())
    lang = batch.column(1).dictionary_encode()
    if not batch.num_rows:
        return
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    starts = offsets[:-1] - offsets[0]
    lang_of, langs = lang.indices.to_numpy(), lang.dictionary.to_pylist()
    ends = np.union1d(starts, np.flatnonzero(_CUT[data]) + 1) if len(data) > SLICE else starts
    ends = np.append(ends[ends > 0], len(data))
    pos = 0
    while pos < len(data):
        i = max(np.searchsorted(ends, pos + SLICE, side="right") - 1, np.searchsorted(ends, pos, side="right"))
        end = int(ends[i])
        a = np.searchsorted(starts, pos, side="right") - 1
        b = np.searchsorted(starts, end, side="left")
        yield Words(data[pos:end], np.maximum(starts[a:b] - pos, 0), lang_of[a:b], langs)
        pos = end


class Filter:
    """Fingerprints that may have been put in (a Bloom filter of two bits each)."""

    def __init__(self, bits: int, packed: np.ndarray):
        self.bits, self.packed = bits, packed

    @staticmethod
    def places(fp, bits: int):
        """Column expressions of the two bits of a fingerprint, from those bits of it that summaries keep."""
        top = 64 - int(math.log2(bits))
        return F.array(F.shiftrightunsigned(fp, top), F.shiftrightunsigned(fp, DROPPED).bitwiseAND(F.lit(bits - 1)))

    def __call__(self, fps: np.ndarray) -> np.ndarray:
        out = np.ones(len(fps), dtype=bool)
        for p in (fps >> np.uint64(64 - int(math.log2(self.bits))), fps >> np.uint64(DROPPED) & np.uint64(self.bits - 1)):
            out &= self.packed[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1 == 1
        return out

    @classmethod
    def of(cls, survivors: DataFrame) -> Filter:
        n = survivors.count()
        bits = min(MAX_BITS, max(1 << 16, 1 << math.ceil(math.log2(max(1, n) * KEY_BITS))))
        # Spark numbers the places of a bitmap from 1, 32,768 to a bucket
        at = survivors.select(F.explode(F.transform(cls.places("fp", bits), lambda x: x + 1)).alias("at"))
        # one row of 4 kB for 32,768 bits: MAX_BITS bound what comes to the driver
        rows = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        packed = np.zeros(bits // 8, dtype=np.uint8)
        for r in rows.collect():
            start = (r.bucket - 1) * 4096
            packed[start:start + len(r.bits)] |= np.frombuffer(r.bits, np.uint8)
        return cls(bits, packed)


def summed(fps: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counters of equal fingerprints added up, by fingerprint."""
    if not len(fps):
        return fps, counts
    order = np.argsort(fps)
    fps, counts = fps[order], counts[order]
    first = np.flatnonzero(np.r_[True, fps[1:] != fps[:-1]])
    return fps[first], np.add.reduceat(counts, first)


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters, and what was subtracted in all."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.fps, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, fps: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((fps, counts))
        if sum(len(f) for f, _ in self.waiting) > self.capacity:
            self.merge()

    def merge(self) -> None:
        self.fps, self.counts = summed(np.concatenate([self.fps, *[f for f, _ in self.waiting]]),
                                       np.concatenate([self.counts, *[c for _, c in self.waiting]]))
        self.waiting = []
        if len(self.fps) > self.capacity:
            cut = int(np.partition(self.counts, -self.capacity - 1)[-self.capacity - 1])
            self.lost += cut
            keep = self.counts > cut
            self.fps, self.counts = self.fps[keep], self.counts[keep] - cut

    def may_reach(self, least: int) -> np.ndarray:
        self.merge()
        return self.fps[self.counts + self.lost >= least]


def survivors(docs: DataFrame, sizes, mass: float, least: int, filters=()) -> DataFrame:
    """(fp): fingerprints of all phrases of ``sizes`` words that occur ``least`` times, and few others.

    ``mass``: about how many occurrences there are (it sets the number of hash
    partitions); ``filters``: of the shorter phrases that may be frequent.
    """
    spark = docs.sparkSession
    part_bits = max(PARTS, math.ceil(math.log2(max(1, mass / least / CAPACITY))))
    # a summary holds the next KEPT bits of a fingerprint: phrases that share them count together, which loses none
    low_bits = 64 - part_bits - 8 * KEPT
    sent = spark.sparkContext.broadcast(filters)
    count_type = np.dtype(np.uint8 if least < 256 else "<u4")

    def build(batches):
        held, counts, size = [], [], 0

        def flush():
            """A row of the mass of each hash partition, which sorts first, and rows of its counters."""
            fps, n = summed(np.concatenate(held) >> np.uint64(low_bits), np.concatenate(counts))
            n = np.minimum(n, least)
            first = np.unique(fps >> np.uint64(8 * KEPT), return_index=True)[1]
            low = fps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEPT]
            rows = []
            for i, j in zip(first, [*first[1:], len(fps)], strict=True):
                part = int(fps[i] >> np.uint64(8 * KEPT))
                rows.append((part, int(n[i:j].sum()), None))
                rows += [(part, None, low[k:min(j, k + ROW)].tobytes() + n[k:min(j, k + ROW)].astype(count_type).tobytes()) for k in range(i, j, ROW)]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.binary()])], names=["part", "mass", "data"])

        for b in batches:
            for w in slices(b):
                for _, _, fps in w.phrases(sizes, sent.value):
                    if len(fps):
                        fps, n = np.unique(fps, return_counts=True)
                        held.append(fps)
                        counts.append(n)
                        size += len(fps)
                if size > HELD:
                    fps, n = summed(np.concatenate(held), np.concatenate(counts))
                    held, counts, size = [fps], [n], len(fps)
                    if size > HELD // 2:
                        yield flush()
                        held, counts, size = [], [], 0
        if size:
            yield flush()

    def merge(batches):
        """Rows come sorted by hash partition, masses first: its summaries are merged, then let go."""
        now, total, held = None, 0, None
        for b in batches:
            for part, mass, data in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
                if part != now:
                    if held is not None:
                        yield done(now, held)
                    now, total, held = part, 0, None
                if data is None:
                    total += mass
                    continue
                held = held or Summary(total // least + 1)
                n = len(data) // (KEPT + count_type.itemsize)
                fps = np.zeros((n, 8), np.uint8)
                fps[:, :KEPT] = np.frombuffer(data, np.uint8, n * KEPT).reshape(n, KEPT)
                held.add(fps.view("<u8").ravel(), np.frombuffer(data, count_type, n, n * KEPT).astype(np.int64))
        if held is not None:
            yield done(now, held)

    def done(part, held):
        fps = (held.may_reach(least) | np.uint64(part << 8 * KEPT)) << np.uint64(low_bits)
        return pa.record_batch([pa.array(fps.view(np.int64))], names=["fp"])

    rows = docs.select("text", "lang").mapInArrow(build, "part long, mass long, data binary")
    rows = rows.repartition("part").sortWithinPartitions("part", F.col("mass").desc_nulls_last())
    return written(spark, rows.mapInArrow(merge, "fp long"), "survivors")


def exact_counts(docs: DataFrame, filters: list[Filter], least: int) -> DataFrame:
    """(lang, phrase, n) of the frequent phrases of 1 to ``LONGEST`` words; phrase null: all words of the language."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def count(batches):
        for b in batches:
            for w in slices(b):
                rows = [(w.langs[i], None, n) for i, n in enumerate(np.bincount(w.lang, minlength=len(w.langs)).tolist()) if n]
                for n, at, _ in w.phrases(range(1, LONGEST + 1), sent.value):
                    rows += w.counted(n, at)
                if rows:
                    lang, phrase, n = zip(*rows)
                    yield pa.record_batch([pa.array(lang, pa.string()), pa.array(phrase, pa.string()), pa.array(n, pa.int64())], names=["lang", "phrase", "n"])

    return (docs.select("text", "lang").mapInArrow(count, "lang string, phrase string, n long")
            .groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("phrase").isNull() | (F.col("n") >= least)))


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of the frequent phrases, and (lang, n) of the languages."""
    spark = docs.sparkSession
    ship(spark)
    d = texts(docs, "lang").withColumn("lang", F.coalesce(F.col("lang").cast("string"), F.lit("und")))
    words = (d.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 6
    filters: list[Filter] = []
    for n in range(1, LONGEST + 1):
        filters.append(Filter.of(survivors(d, [n], words, least, list(filters))))
    counts = written(spark, exact_counts(d, filters, least), "phrases")
    some = counts.where(F.col("phrase").isNotNull()).select("lang", "phrase", F.split("phrase", " ").alias("words"), F.col("n").alias("f"))
    return some, counts.where(F.col("phrase").isNull()).select("lang", "n")


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of the candidates, at their lowest-scoring cut."""
    least = frequent.select("lang", "phrase", "words", F.col("f").alias("a")).where(F.size("words") > 1)
    part = lambda a, n: F.array_join(F.slice("words", a, n), " ")
    cuts = least.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select("*", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.size("words") - F.col("k")).alias("tail"))
    of = lambda name, f: frequent.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(of("head", "l"), ["lang", "head"]).join(of("tail", "r"), ["lang", "tail"])
    # exact: 20 digits times 2,000,000 stay within a decimal's 38
    cuts = cuts.withColumn("score", F.expr("cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + r)"))
    low = F.struct("score", "k", "l", "r")
    return (cuts.groupBy("lang", "phrase").agg(F.min(low).alias("low"), F.first("a").alias("a"), F.first("words").alias("words"))
            .select("lang", "phrase", "words", "a", "low.l", "low.r", "low.score"))


def phrases(docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    frequent, langs = frequent_phrases(docs, least)
    found = scored(frequent)
    # a longer candidate that covers a phrase holds one of one word more that does: only those are asked
    longer = frequent.where(F.size("words") > 2)
    inner = lambda start: F.array_join(F.slice("words", start, F.size("words") - 1), " ").alias("phrase")
    held = longer.select("lang", "f", F.explode(F.array(inner(F.lit(1)), inner(F.lit(2)))).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = found.join(held, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.expr("cast(most as decimal(20,0)) * 100") < F.expr(f"cast(a as decimal(20,0)) * {int(covered)}")))
    w = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return ranked.join(langs, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

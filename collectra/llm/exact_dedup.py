"""Exact dedup: counting quotient filters find the repeated fingerprints.

Every scan task builds counting quotient filters over the 64-bit fingerprints
of its texts: the high bits of a fingerprint (the quotient) are stored by
position, as the run lengths of a slot directory; only the low bits (the
remainder) are stored as values, sorted within their run, beside a count.  One
filter covers one *range* of quotients, so filters of a range from all tasks
meet in one place and merge losslessly by their sorted remainders: a
fingerprint repeated a billion times is one entry of each task's filter.

Fingerprints counted more than once route their documents to the byte
verification: those texts are grouped by their bytes (collapsed inside each
task before the shuffle), which gives the size of the group and the row that
stays.  All other documents are alone in their group and move no text.

Edge cases: a null text is an empty text and all empty texts are one group;
rows that repeat a ``doc_id`` with the same text all carry the same decision;
a null ``doc_id`` loses to any other id, and a group of null ids only keeps
them (``keep_id`` null, ``kept`` true).  Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collectra.llm.common import sha256_text, texts, written

# fingerprints a range should hold when its filters are merged: some 16 MB
RANGE_ENTRIES = 1 << 20


class CountingQuotientFilter:
    """Fingerprints of one range and their counts, without loss.

    ``runs[q]`` is the number of remainders of quotient ``q`` (what the
    occupied and run-end bits of a slot table say); ``rems`` are all remainders
    in quotient order, sorted within a run; ``extra`` holds (slot, count) of
    the entries that occur more than once, as a slot alone means one.
    """

    def __init__(self, quotient_bits: int, remainder_bits: int, fps: np.ndarray, counts: np.ndarray):
        """``fps``: distinct and sorted; only their low quotient + remainder bits are kept."""
        self.q, self.r = quotient_bits, remainder_bits
        quotient = (fps >> np.uint64(self.r)) & np.uint64((1 << self.q) - 1)
        self.runs = np.bincount(quotient.astype(np.int64), minlength=1 << self.q)
        self.rems = fps & np.uint64((1 << self.r) - 1)
        slots = np.flatnonzero(counts > 1)
        self.extra = slots, counts[slots]

    def entries(self):
        """Sorted fingerprints (their bits within the range) and counts."""
        quotient = np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs)
        counts = np.ones(len(self.rems), dtype=np.int64)
        counts[self.extra[0]] = self.extra[1]
        return (quotient << np.uint64(self.r)) | self.rems, counts

    def to_bytes(self) -> bytes:
        # the directory in unary: a one for each remainder, a zero ends a run
        ones = np.ones(len(self.rems) + len(self.runs), dtype=np.uint8)
        ones[np.cumsum(self.runs) + np.arange(len(self.runs))] = 0
        width = -(-self.r // 8)
        return b"".join([np.array([self.q, self.r, len(self.rems), len(self.extra[0])], "<i8").tobytes(),
                         self.rems.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes(),
                         self.extra[0].astype("<i8").tobytes(), self.extra[1].astype("<i8").tobytes(),
                         np.packbits(ones).tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        f = cls.__new__(cls)
        f.q, f.r, n, m = (int(x) for x in np.frombuffer(data, "<i8", 4))
        width, at = -(-f.r // 8), 32
        rems = np.zeros((n, 8), np.uint8)
        rems[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
        f.rems = rems.view("<u8").ravel()
        at += n * width
        f.extra = np.frombuffer(data, "<i8", m, at), np.frombuffer(data, "<i8", m, at + 8 * m)
        ones = np.unpackbits(np.frombuffer(data, np.uint8, offset=at + 16 * m))[: n + (1 << f.q)]
        f.runs = np.diff(np.flatnonzero(ones == 0), prepend=-1) - 1
        return f

    @staticmethod
    def merge(filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        parts = [f.entries() for f in filters]
        return CountingQuotientFilter(filters[0].q, filters[0].r, *_summed(
            np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])))


def _summed(fps: np.ndarray, counts: np.ndarray):
    if not len(fps):
        return fps, counts
    order = np.argsort(fps, kind="stable")  # merges the sorted runs
    fps, counts = fps[order], counts[order]
    first = np.flatnonzero(np.r_[True, fps[1:] != fps[:-1]])
    return fps[first], np.add.reduceat(counts, first)


def repeated_fingerprints(fingerprints: DataFrame, rows: int) -> DataFrame:
    """(fp, n) of the values of the long column ``fp`` that occur more than once.

    ``rows``: about how many rows there are; it sets the number of ranges.
    """
    range_bits = max(6, math.ceil(math.log2(max(1, rows / RANGE_ENTRIES))))
    quotient_bits = max(1, 16 - range_bits)
    low = 64 - range_bits

    def filters(seen, at):
        fps, counts = _summed(np.concatenate(seen), np.concatenate(at))
        ranges, start = np.unique(fps >> np.uint64(low), return_index=True)
        data = [CountingQuotientFilter(quotient_bits, low - quotient_bits, fps[i:j], counts[i:j]).to_bytes()
                for i, j in zip(start, [*start[1:], len(fps)], strict=True)]
        if data:
            yield pa.record_batch([pa.array(ranges.astype(np.int64)), pa.array(data, pa.binary())], names=["range", "cqf"])

    def build(batches):
        seen, at, held = [], [], 0
        for b in batches:
            fps, n = np.unique(b.column(0).to_numpy().view(np.uint64), return_counts=True)
            seen.append(fps)
            at.append(n)
            held += len(fps)
            if held > RANGE_ENTRIES:  # bounded memory: what is gathered goes out as filters
                yield from filters(seen, at)
                seen, at, held = [], [], 0
        if seen:
            yield from filters(seen, at)

    def merged(batches):
        """Rows come sorted by range: the filters of one are merged, then let go."""
        now, held = None, []
        for b in batches:
            for r, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if r != now and held:
                    yield repeated(now, held)
                    held = []
                now = r
                held.append(CountingQuotientFilter.from_bytes(data))
                if len(held) >= 256:
                    held = [CountingQuotientFilter.merge(held)]
        if held:
            yield repeated(now, held)

    def repeated(now, held):
        fps, counts = CountingQuotientFilter.merge(held).entries()
        fps = fps[counts > 1] | np.uint64(now << low)
        return pa.record_batch([pa.array(fps.view(np.int64)), pa.array(counts[counts > 1])], names=["fp", "n"])

    return (fingerprints.select("fp").mapInArrow(build, "range long, cqf binary")
            .repartition("range").sortWithinPartitions("range").mapInArrow(merged, "fp long, n long"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    d = texts(docs).withColumn("fp", F.xxhash64("text"))
    repeated = written(spark, repeated_fingerprints(d, docs.count()).select("fp"), "repeated")

    keyed = written(spark, d.select("doc_id", "fp", sha256_text("text").alias("text_sha256")), "keyed")
    # byte verification: grouping by the text itself compares bytes; copies
    # within a task collapse before the shuffle
    groups = (d.join(repeated, "fp", "left_semi")
              .groupBy("fp", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
              .select("fp", sha256_text("text").alias("text_sha256"), "keep_id", "group_size")
              .where("group_size > 1"))
    groups = written(spark, groups, "groups")
    # hot groups meet in this join only, whose sides are plain scans: Spark splits a hot key
    joined = keyed.join(groups, ["fp", "text_sha256"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")

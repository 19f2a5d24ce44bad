"""Line dedup with deletion neighbourhoods: a line goes if an earlier one is within one edit.

Lines are compared without surrounding white space; an edit inserts, deletes or
replaces one character.  Lines are ordered by (doc_id, line number).  Every line
of at least ``MIN_CHARS`` characters that equals an earlier line, or is one edit
away from an earlier line (kept or not), is dropped; shorter lines (headings,
braces, blank lines) are structure and stay.

1. *Equal lines.*  Each distinct line (128-bit hash) keeps its first place and
   its number of places, summed before the shuffle.
2. *Who can have a neighbour.*  One edit leaves the first or the last half of a
   line as it is.  Distinct lines that share neither half with another line of
   like length have no neighbour and go no further; nothing is lost.
3. *Variants.*  The others emit the hash of every string that one deletion makes
   of them (rolling hashes, all positions at once), with the position, and the
   hash of the line itself.  Two lines are one replacement apart if they share a
   variant at the same position, and one insertion apart if one is a variant of
   the other; so in an equi-join on (variant) a line need only meet the earliest
   line of its position and the line that the variant is: as many pairs as
   variants, whatever the size of the group.
4. *Verification.*  The pairs' texts are compared by edit distance (built in).

Edge cases: a null text is an empty text; rows that repeat a ``doc_id`` are one
document, whose line n is the same place in all of them; rows with a null
``doc_id`` are documents of their own, equal texts among them one, and come after
all others by a hash of the text (ids from 2^63 - 2^55 on must not be used).
Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from collectra.llm.common import let, texts, written

MIN_CHARS = 20
LAST = (1 << 63) - 1
SLICE_CHARS = 1 << 17  # characters of lines whose variants a task makes at a time
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 998_244_353)


def bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def place_key(doc_id: Column, text: Column) -> Column:
    """A document's place in the order: its id; without one, after all others by a hash of its text."""
    return F.coalesce(doc_id.cast("long"), F.lit(LAST) - F.shiftrightunsigned(F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))), 8))


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, line_no, line) of the lines that take part."""
    d = texts(docs).withColumn("doc_id", place_key(F.col("doc_id"), F.col("text")))
    each = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return each.withColumn("line", bare(F.col("line"))).where(F.char_length("line") >= min_chars)


def variant_rows(line: str) -> tuple[np.ndarray, np.ndarray]:
    """62-bit hashes and positions: of the line without each character, and (-1) of the line."""
    c = np.frombuffer(line.encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    n, out = len(c), np.zeros(len(c) + 1, dtype=np.uint64)
    for p, base in zip(PRIMES, BASES, strict=True):
        mod = np.uint64(p)
        power = _powers(n, p, base)
        terms = c % mod * power % mod
        upto = np.r_[np.uint64(0), np.cumsum(terms)]  # n terms below 2**31
        rest = (upto[-1] - upto[1:]) % mod * np.uint64(pow(base, -1, p)) % mod
        without = (upto[:-1] + rest) % mod
        out = (out << np.uint64(31)) | np.r_[without, upto[-1] % mod]
    return out.view(np.int64), np.r_[np.arange(n), -1].astype(np.int32)


_power_table: dict[tuple[int, int], np.ndarray] = {}


def _powers(n: int, p: int, base: int) -> np.ndarray:
    have = _power_table.get((p, base))
    if have is None or len(have) < n:
        have, size = np.ones(1, np.uint64), 1
        while size < n:  # doubling
            have = np.r_[have, have * np.uint64(pow(base, size, p)) % np.uint64(p)]
            size *= 2
        _power_table[p, base] = have
    return have[:n]


def char_slices(batch: pa.RecordBatch, column: int):
    """Slices of about ``SLICE_CHARS`` characters of a column, a longer line by itself."""
    upto = np.cumsum(pc.utf8_length(batch.column(column)).to_numpy())
    start = np.flatnonzero(np.diff(upto // SLICE_CHARS, prepend=-1))
    for a, b in zip(start, [*start[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def _halves(line: Column) -> list[Column]:
    """Keys of the halves that one edit leaves alone: for the line as the shorter
    of a pair, as one of two equal lengths, and as the longer."""
    n = F.char_length(line)
    return [F.xxhash64(F.lit(side), m, cut(line, F.floor(m / 2).cast("int"))) for m in (n, n - 1)
                     for side, cut in (("first", lambda x, k: F.left(x, k)), ("last", lambda x, k: F.right(x, k)))]


def near_lines(distinct: DataFrame, lines: DataFrame) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier one within one edit.

    ``distinct``: h1, h2, doc_id, line_no (first place), k0..k3 (halves); ``lines``: the occurrences.
    """
    spark = distinct.sparkSession
    keys = distinct.select("h1", "h2", F.explode(F.array("k0", "k1", "k2", "k3")).alias("half"))
    shared = keys.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    has = keys.join(shared, "half", "left_semi").select("h1", "h2").distinct()
    near = written(spark, distinct.select("h1", "h2", "doc_id", "line_no").join(has, ["h1", "h2"]), "half_shared")
    # the text of a distinct line, from its first place
    # (a shuffle join at any size: lines with a shared half are a share of all lines)
    near = written(spark, lines.join(near.hint("merge"), ["doc_id", "line_no"]).where(F.xxhash64("line") == F.col("h1"))
                   .dropDuplicates(["h1", "h2"]), "half_shared_lines")

    def variants(batches):
        for b in batches:
            for part in char_slices(b, 4):
                found = [variant_rows(x) for x in part.column(4).to_pylist()]  # line
                if not found:
                    continue
                size = np.array([len(v) for v, _ in found])
                at = pa.array(np.repeat(np.arange(len(found)), size))
                at_, pos = np.repeat(size - 1, size), np.concatenate([p for _, p in found])
                yield pa.record_batch([pa.array(np.concatenate([v for v, _ in found])), pa.array((at_ - (pos >= 0)).astype(np.int32)),
                                       pa.array(pos), *[part.column(k).take(at) for k in range(4)]],
                                      names=["v", "size", "pos", "h1", "h2", "doc_id", "line_no"])

    each = near.select("h1", "h2", "doc_id", "line_no", "line").mapInArrow(
        variants, "v long, size int, pos int, h1 long, h2 long, doc_id long, line_no int")
    me = F.struct("doc_id", "line_no", "h1", "h2")
    # groups of a variant come together once; both windows keep that order
    each = each.repartition("v", "size").withColumn("me", me)
    same = Window.partitionBy("v", "size", "pos")
    whole = Window.partitionBy("v", "size")
    each = (each.withColumn("other", F.min("me").over(same))
            .withColumn("base", F.min(F.when(F.col("pos") < 0, F.col("me"))).over(whole))
            .withColumn("member", F.min(F.when(F.col("pos") >= 0, F.col("me"))).over(whole)))
    met = each.select("h1", "h2", "me", F.explode(F.when(F.col("pos") < 0, F.array("member")).otherwise(F.array("other", "base"))).alias("o")) \
        .where(F.col("o") < F.col("me")).select("h1", "h2", F.col("o.h1").alias("o1"), F.col("o.h2").alias("o2")).distinct()
    a, b = near.select("h1", "h2", "line"), near.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("line").alias("other"))
    return met.join(a, ["h1", "h2"]).join(b, ["o1", "o2"]).where(F.levenshtein("line", "other", 1).between(0, 1)) \
        .select("h1", "h2").distinct()


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, line_no, h1, near) of every place whose line is dropped; ``doc_id`` is the :func:`place_key`."""
    spark = docs.sparkSession
    lines = occurrences(docs, min_chars)
    halves = _halves(F.col("line"))
    keyed = written(spark, lines.select("doc_id", "line_no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
                                        *[k.alias(f"k{i}") for i, k in enumerate(halves)]), "lines")
    first = F.min(F.struct("doc_id", "line_no"))
    distinct = keyed.groupBy("h1", "h2").agg(first.alias("first"), F.count("*").alias("places"), *[F.min(f"k{i}").alias(f"k{i}") for i in range(4)])
    distinct = written(spark, distinct.select("h1", "h2", "first.doc_id", "first.line_no", "places", *[f"k{i}" for i in range(4)]), "distinct_lines")
    near = near_lines(distinct, lines).withColumn("near", F.lit(True))
    decided = distinct.select("h1", "h2", F.struct("doc_id", "line_no").alias("first"), "places").join(near, ["h1", "h2"], "left") \
        .where(F.col("near") | (F.col("places") > 1)).select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    decided = written(spark, decided, "decided_lines")
    # plain scans on both sides: Spark splits a line that a third of the places hold
    return (keyed.select("doc_id", "line_no", "h1", "h2").join(decided, ["h1", "h2"])
            .where(F.col("near") | (F.col("first") != F.struct("doc_id", "line_no"))).select("doc_id", "line_no", "h1", "near"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the dropped lines cut out of ``text``, and n_lines, n_equal, n_near.

    ``n_equal`` and ``n_near`` count the dropped lines of a row; a text that loses
    no line is the same as before.
    """
    spark = docs.sparkSession
    by_doc = dropped_lines(docs, min_chars).groupBy(F.col("doc_id").alias("drop_id")).agg(
        F.collect_set(F.struct("line_no", "h1", "near")).alias("drops"))
    by_doc = written(spark, by_doc, "drops")
    names = docs.columns
    at = {c: F.col(f"c{names.index(c)}") for c in ("doc_id", "text")}
    d = docs.toDF(*[f"c{i}" for i in range(len(names))])
    d = d.join(by_doc, place_key(at["doc_id"], at["text"]) == F.col("drop_id"), "left")
    split = F.split(at["text"], "\n")

    def cut(lines):
        # a place counts for the row only if the row's line is the one dropped there
        own = F.filter("drops", lambda x: F.xxhash64(bare(F.get(lines, x["line_no"]))) == x["h1"])
        return let(own, lambda own: F.struct(
            # set difference of line numbers: linear in the lines of a text, however many go
            F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.transform(own, lambda x: x["line_no"])),
                                     lambda i: F.get(lines, i)), "\n").alias("text"),
            F.size(own).alias("n"), F.size(F.filter(own, lambda x: x["near"])).alias("near")))

    d = d.withColumn("cut", F.when(F.col("drops").isNotNull(), let(split, cut)))
    text = F.when(F.col("cut.n") > 0, F.col("cut.text")).otherwise(at["text"])
    counts = (F.coalesce(F.col("cut.n") - F.col("cut.near"), F.lit(0)).alias("n_equal"), F.coalesce("cut.near", F.lit(0)).alias("n_near"))
    return d.select(*[text.alias(n) if n == "text" else F.col(f"c{i}").alias(n) for i, n in enumerate(names)],
                    F.coalesce(F.size(split), F.lit(0)).alias("n_lines"), *counts)

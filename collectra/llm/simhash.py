"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprint: lower-case A-Z, cut the whole text into words, hash every shingle
of ``shingle`` words (XXH64, seed 42); a bit is 1 if it is 1 in over half of
the hashes.  Documents link when their fingerprints differ in at most
``max_bits`` bits; a component is what links reach.

Search, on distinct fingerprints (copies collapse first):

1. With ``max_bits`` + 1 blocks of bits, two linked fingerprints agree on at
   least one block.  Each block in turn leads a rotated fingerprint; the rows
   of one leading block value form the top node of an index, so the index is
   spread over the cluster by (block, value) and no pair of a link is missed.
2. Within a top node, rows stand in Gray order, where neighbours share long bit
   patterns.  Runs of rows make a node, runs of nodes a higher node; a node
   keeps the bits that all its rows share (pattern and mask).  A pair of nodes
   is dropped with all its rows as soon as the shared bits differ in more than
   ``max_bits`` places.  What reaches the leaves is compared bit by bit.  The top
   nodes of a task are one forest of such trees, whatever their sizes, and are
   searched level by level together.
3. A top node gives a spanning forest of its links, not all of them: never more
   edges than rows.  A top node with more rows than a task's fair share (all rows
   by the number of shuffle partitions) is dealt to parts of that share, and every
   pair of parts is searched by a task of its own: no link is lost, no task holds
   them all.
4. Edges are joined to components with alternating large and small stars,
   each round a written table.

Edge cases: null, empty and blank texts have fingerprint zero and link like
any other; rows that repeat a ``doc_id`` are rows of one document; rows with a
null ``doc_id`` get a fingerprint and the smallest id that their fingerprint
reaches (null if none).  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collectra.llm.common import texts, written
from collectra.llm.components import components

SEED = 42
FANOUT = 8  # children of an index node
CHUNK = 4_096  # a top node of fewer rows is never split


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of one text, in chunks of shingles: memory does not grow with the text."""
    from xxhash import xxh64_intdigest as h

    words = text.lower().split()  # bytes: A-Z only, and the ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    k = min(shingle, len(words))
    a, b = starts[: len(words) - k + 1], ends[k - 1:]
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(a), 8192):
        hashes = [h(joined[x:y], SEED) for x, y in zip(a[i:i + 8192].tolist(), b[i:i + 8192].tolist(), strict=True)]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(a)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp long) for every row."""
    d = texts(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):  # a few texts as Python objects at a time
                part = b.slice(i, 256)
                fps = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], dtype=np.uint64)
                yield pa.record_batch([part.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return d.mapInArrow(run, f"doc_id {kind}, fp long")


def with_fingerprint(df: DataFrame, text: str, shingle: int) -> DataFrame:
    """``df`` with ``fp``, the fingerprint of its column ``text`` (null counts as empty)."""
    @F.pandas_udf("long")
    def fp(batch: pd.Series) -> pd.Series:
        values = np.array([fingerprint((t or "").encode(), shingle) for t in batch], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return df.withColumn("fp", fp(F.col(text).cast("string")))


# --- the index over the rows of one top node ------------------------------------

def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a bit pattern in Gray order: the inverse of n ^ (n >> 1)."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        """Root of every position; halves all paths until they are flat."""
        while not np.array_equal(up := self.up[self.up], self.up):
            self.up = up
        return self.up

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        """Unite the pairs; the smaller root wins, again and again until all agree."""
        while len(a):
            r = self.roots()
            ra, rb = r[a], r[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))


class GrayIndex:
    """The top nodes of many groups at once: rows of a group in Gray order and,
    above them, levels of (pattern, mask) nodes, up to one node per group."""

    def __init__(self, fps: np.ndarray, group: np.ndarray):
        self.order = np.lexsort((gray_rank(fps), group))
        self.fps, group = fps[self.order], group[self.order]
        self.groups = np.unique(group)
        none = np.zeros(0, np.int64)
        # per level: pattern, mask, first node below and number of nodes below
        self.levels = [(self.fps, np.full(len(fps), ~np.uint64(0)), none, none)]
        low = high = self.fps
        while len(low) > len(self.groups):
            start = np.flatnonzero(np.diff(group, prepend=-1))
            place = np.arange(len(group)) - np.repeat(start, np.diff(start, append=len(group)))
            at = np.flatnonzero(place % FANOUT == 0)
            group = group[at]
            low, high, below = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at), np.diff(at, append=len(low))
            self.levels.append((low, ~(low ^ high), at, below))  # bits that all rows below share

    def raised(self, levels: int) -> None:
        """Add levels that pass on what stands below, so that two indexes are equally high."""
        while len(self.levels) < levels:
            low, mask = self.levels[-1][:2]
            self.levels.append((low, mask, np.arange(len(low)), np.ones(len(low), np.int64)))

    def links(self, other: GrayIndex, max_bits: int, forest: Forest, here: np.ndarray, there: np.ndarray) -> int:
        """Unite in ``forest`` all rows of a group of both that differ in at most ``max_bits`` bits.

        ``here``, ``there``: the rows' positions in the forest, in index order.
        Pairs of nodes are followed from the top nodes, in slices that bound
        memory.  Returns the number of node pairs that were visited.
        """
        top = max(len(self.levels), len(other.levels))
        self.raised(top)
        other.raised(top)
        _, a, b = np.intersect1d(self.groups, other.groups, assume_unique=True, return_indices=True)
        todo, visits = [(top - 1, a, b)], 0
        while todo:
            level, a, b = todo.pop()
            (pa_, ma, first_a, below_a), (pb, mb, first_b, below_b) = self.levels[level], other.levels[level]
            visits += len(a)
            near = popcount((pa_[a] ^ pb[b]) & ma[a] & mb[b]) <= max_bits  # differences gathered so far
            if self is other:
                near &= a <= b
            a, b = a[near], b[near]
            if level == 0:
                forest.union(here[a], there[b])
                continue
            child = np.arange(FANOUT)
            for i in range(0, len(a), 16_384):
                x, y = a[i:i + 16_384], b[i:i + 16_384]
                real = (child < below_a[x, None])[:, :, None] & (child < below_b[y, None])[:, None, :]
                x, y = np.broadcast_arrays((first_a[x, None] + child)[:, :, None], (first_b[y, None] + child)[:, None, :])
                todo.append((level - 1, x[real], y[real]))
        return visits


def forest_edges(fps: np.ndarray, ids: np.ndarray, group: np.ndarray, side: np.ndarray, max_bits: int):
    """Spanning edges (smaller id, id) of the links among the rows of each group, and the node pairs visited.

    ``side``: 0 for all rows of a group, or 1 and 2 where only pairs between the two count.
    """
    order = np.argsort(ids, kind="stable")  # then the root of a tree is its smallest id
    fps, ids, group, side = fps[order], ids[order], group[order], side[order]
    forest, visits = Forest(len(fps)), 0
    alone, left, right = (np.flatnonzero(side == x) for x in (0, 1, 2))
    if len(alone):
        x = GrayIndex(fps[alone], group[alone])
        visits += x.links(x, max_bits, forest, alone[x.order], alone[x.order])
    if len(left) and len(right):
        x, y = GrayIndex(fps[left], group[left]), GrayIndex(fps[right], group[right])
        visits += x.links(y, max_bits, forest, left[x.order], right[y.order])
    roots = forest.roots()
    child = np.flatnonzero(roots != np.arange(len(roots)))
    return ids[roots[child]], ids[child], visits


# --- Spark ----------------------------------------------------------------------

def block_masks(max_bits: int) -> list[int]:
    """``max_bits`` + 1 masks that share out the 64 bits."""
    cuts = [round(i * 64 / (max_bits + 1)) for i in range(max_bits + 2)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]


def links(reps: DataFrame, max_bits: int) -> DataFrame:
    """Edges (u, v), u < v, whose reach is that of all links among ``reps`` (id, fp)."""
    spark = reps.sparkSession
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks(max_bits)]
    keyed = reps.select("id", "fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(signed)])).alias("k")
    ).select("id", "fp", "k.block", "k.value")
    share = max(CHUNK, reps.count() * len(signed) // int(spark.conf.get("spark.sql.shuffle.partitions")))
    # how many rows a top node has, summed before the shuffle; only the hot ones are kept
    hot = written(spark, keyed.groupBy("block", "value").count().where(F.col("count") > share)
                  .select("block", "value", F.ceil(F.col("count") / share).cast("int").alias("parts")), "hot")
    if hot.isEmpty():
        dealt = keyed.withColumn("task", F.lit(0)).withColumn("side", F.lit(0))
    else:
        # a pair of parts is a task: a row goes to the pairs of its own part
        part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        pair = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(
            (F.least(o, F.col("part")) * F.col("parts") + F.greatest(o, F.col("part"))).alias("task"),
            F.when(o == F.col("part"), 0).when(F.col("part") < o, 1).otherwise(2).alias("side")))
        dealt = (keyed.join(hot, ["block", "value"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
                 .withColumn("part", part).withColumn("p", F.explode(pair))
                 .select("id", "fp", "block", "value", "p.task", "p.side"))

    def search(batches):
        """Rows come sorted by group; a group is searched when it is complete."""
        held, keys = [], None
        for b in batches:
            cols = [b.column(i).to_numpy() for i in range(6)]
            held = cols if not held else [np.concatenate(x) for x in zip(held, cols)]
            key = np.stack(held[2:5])
            new = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            if len(new):
                cut = new[-1]  # the last group may go on in the next batch
                yield edges([x[:cut] for x in held], np.r_[0, new[:-1]], np.r_[new[:-1], cut])
                held = [x[cut:] for x in held]
        if held and len(held[0]):
            key = np.stack(held[2:5])
            new = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            yield edges(held, np.r_[0, new], np.r_[new, len(held[0])])

    def edges(cols, start, end):
        ids, fps, side = cols[0], cols[1].view(np.uint64), cols[5]
        group = np.repeat(np.arange(len(start)), end - start)
        u, v, _ = forest_edges(fps, ids, group, side, max_bits)
        return pa.record_batch([pa.array(u.astype(np.int64)), pa.array(v.astype(np.int64))], names=["u", "v"])

    return (dealt.select("id", "fp", "block", "value", "task", "side")
            .repartition("block", "value", "task").sortWithinPartitions("block", "value", "task")
            .mapInArrow(search, "u long, v long").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per document: doc_id, fp (long), component_id (smallest doc_id reachable)."""
    spark = docs.sparkSession
    fps = written(spark, fingerprints(docs, shingle), "fingerprints")
    reps = written(spark, fps.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").cast("long").alias("id")), "reps")
    roots = components(links(reps, max_bits))
    named = written(spark, reps.join(roots, F.col("id") == F.col("node"), "left")
                    .select("fp", F.coalesce("root", "id").alias("component_id")), "classes")
    # plain scans on both sides: Spark splits a fingerprint that a third of the rows have
    return fps.join(named, "fp", "left").select("doc_id", "fp", "component_id")

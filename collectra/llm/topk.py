"""Exact top-k search by inner product, pruned block at a time.

*Blocks.*  Vectors become integers (floor of 256 times a component).  They are
ordered by cells of like vectors (cells come from a bounded sample; they steer
the order only) and then by id, range-partitioned into *parts* and cut into
blocks of ``BLOCK`` rows.  A block keeps its rows as a matrix (the forward
index) with the largest and smallest value of each component.

*Search.*  The bound of a block for a query is the sum over the components of
the larger of q * max and q * min.  A query takes the blocks of a part by
falling bound, scores each through its matrix, and stops when the next bound
falls below its k-th score (at an equal score: when the block's smallest id is
no smaller than the k-th id).  Queries first search the part that they stand
in, which gives each a k-th score to begin with; then they go to those other
parts only whose bound reaches it, and at most ``k`` rows per query and part
leave a task.

*Size.*  The stated queries are a fixed share of the rows and each may have to
meet every block; a task holds one part (at most ``PART_VALUES`` components) and
one slice of its queries (as many).  Of the driver only the sample, the cells
and the parts' bounds (one row per part) are asked.

All arithmetic is exact: 32-bit floats while every sum stays below 2^24, then
doubles below 2^53, then Python integers.

Edge cases: vectors that are null, empty, hold null or non-finite components
(also after the multiplication) take no part, nor do rows with a null id; of rows
that share an id the smallest vector (component by component) stands for the id,
so a query never finds its own id; components that a shorter vector lacks count
as zero; a score beyond 64 bits is given as the nearest long (it still ranks
exactly); an empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from collectra.llm.common import bounded_sample, pick, ship, written

SCALE = 256
BLOCK = 256
PART_VALUES = 4 << 20
PART_LEAST = 4096  # rows below which a part is not worth a task
MAX_SAMPLE = 32_768
MAX_CELLS = 1024
ROUNDS = 4
AT_ONCE = 1024  # queries whose bounds stand in memory together
LONG = (1 << 63) - 1


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): doubles that hold whole numbers, one row per id."""
    d = pick(embeddings, "vec_id", "embedding").where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0))
    d = d.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double") * scale).alias("x"))
    # a comparison with null or NaN is not true (NaN counts as larger than any number in Spark)
    fine = F.forall("x", lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))
    # doubles keep floors exact at any size; 0.0 and -0.0 are one value
    whole = F.transform("x", lambda v: F.when(F.abs(v) < 2.0 ** 53, F.floor(v).cast("double")).otherwise(v) + F.lit(0.0))
    return d.where(fine).select("vec_id", whole.alias("vector")).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def cells_of(sample: np.ndarray, cells: int) -> np.ndarray:
    """Directions of like vectors, in an order where neighbours are alike (a few rounds of spherical k-means)."""
    x = sample / np.maximum(np.sqrt((sample * sample).sum(axis=1, keepdims=True)), 1e-300)
    c = x[np.linspace(0, len(x) - 1, cells).astype(np.int64)]
    for _ in range(ROUNDS):
        own = (x @ c.T).argmax(axis=1)
        c = np.array([x[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(cells)])
        c /= np.maximum(np.sqrt((c * c).sum(axis=1, keepdims=True)), 1e-300)
    at, left = 0, np.ones(cells, dtype=bool)
    order = []
    for _ in range(cells):  # nearest unvisited one next
        order.append(at)
        left[at] = False
        at = int(np.where(left, c @ c[at], -np.inf).argmax())
    return c[order]


def matrix(rows, width: int) -> np.ndarray:
    """Whole-number doubles, shorter rows filled with zeros."""
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def exact(a: np.ndarray, b: np.ndarray) -> type:
    """The number type in which every inner product of rows of ``a`` and ``b``, and each part of the sum, is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else object


def as_kind(x: np.ndarray, kind: type) -> np.ndarray:
    if kind is object:
        return np.frompyfunc(int, 1, 1)(x).astype(object) if x.size else x.astype(object)
    return x.astype(kind)


def upper_bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Bound of each query (row) in each block (column): the summed maxima of the components."""
    return clipped(np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T)


def clipped(s: np.ndarray) -> np.ndarray:
    return np.maximum(np.minimum(s, LONG), -LONG) if s.dtype == object else s.astype(np.float64)


def by_score(score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places of each row by falling score, ties by rising id."""
    first = np.argsort(ids, axis=1, kind="stable")
    then = np.argsort(-np.take_along_axis(score, first, axis=1), axis=1, kind="stable")
    return np.take_along_axis(first, then, axis=1)


class Part:
    """The blocks of one part."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, block: int = BLOCK):
        """``ids`` and ``rows`` in block order."""
        self.starts = np.arange(0, len(ids), block)
        self.ends = np.append(self.starts[1:], len(ids))
        # within a block by id, as ties go to smaller ids
        order = np.lexsort((ids, np.arange(len(ids)) // block))
        self.ids, self.rows = ids[order], rows[order]
        self.high = np.maximum.reduceat(self.rows, self.starts, axis=0)
        self.low = np.minimum.reduceat(self.rows, self.starts, axis=0)
        self.least = self.ids[self.starts]
        self.scored = 0  # pairs of a query and a row that were scored

    def search(self, qids: np.ndarray, queries: np.ndarray, kth: list, kth_id: np.ndarray, k: int, home: bool):
        """Scores and ids of up to ``k`` rows per query that its k-th so far does not rule out (else -inf).

        ``home``: the queries' own rows may be here and do not count.
        """
        kind = exact(queries, self.rows)
        q = as_kind(queries, kind)
        rows = as_kind(self.rows, kind)
        bound = upper_bounds(q, as_kind(self.high, kind), as_kind(self.low, kind))
        plan = by_score(bound, np.broadcast_to(self.least, bound.shape))
        held = object if kind is object else np.float64
        score, ids = np.full((len(q), k), -np.inf, dtype=held), np.full((len(q), k), LONG)
        # a k-th score of 2^53 or more lies above all sums of a part that doubles can hold
        floor = np.array([-np.inf if s is None else s for s in kth], dtype=held)
        floor_id = kth_id.copy()
        active = np.arange(len(q))
        for step in range(len(self.starts)):
            block = plan[active, step]
            up = bound[active, block]
            go = up >= floor[active]
            active, block, up = active[go], block[go], up[go]
            if not len(active):
                break
            # at an equal bound only a smaller id can win
            go = (up > floor[active]) | (self.least[block] < floor_id[active])
            todo, block = active[go], block[go]
            by = np.argsort(block, kind="stable")
            for some in np.split(by, np.flatnonzero(np.diff(block[by])) + 1) if len(by) else []:
                b, at = block[some[0]], todo[some]
                a, e = self.starts[b], self.ends[b]
                s = clipped(q[at] @ rows[a:e].T)
                self.scored += s.size
                if home:
                    s[qids[at][:, None] == self.ids[a:e]] = -np.inf
                near = s.max(axis=1) >= floor[at]
                at, s = at[near], s[near]
                if not len(at):
                    continue
                top = np.argsort(-s, axis=1, kind="stable")[:, :k]
                both = np.concatenate([score[at], np.take_along_axis(s, top, axis=1)], axis=1)
                both_ids = np.concatenate([ids[at], self.ids[a:e][top]], axis=1)
                first = by_score(both, both_ids)[:, :k]
                score[at], ids[at] = np.take_along_axis(both, first, axis=1), np.take_along_axis(both_ids, first, axis=1)
                last, last_id = score[at, k - 1], ids[at, k - 1]
                better = (last > floor[at]) | ((last == floor[at]) & (last_id < floor_id[at]))
                floor[at[better]], floor_id[at[better]] = last[better], last_id[better]
        return score, ids


ASKED = "part long, slice long, query_id long, vector array<double>, kth long, kth_id long"
FOUND = "query_id long, vec_id long, score long, part long, scored long"


def _kth(some: pd.DataFrame) -> tuple[list, np.ndarray]:
    kth = [None if pd.isna(s) else int(s) for s in some["kth"]]
    return kth, np.array([LONG if pd.isna(i) else int(i) for i in some["kth_id"]], dtype=np.int64)


def search_part(part_no: int, queries: pd.DataFrame, rows: pd.DataFrame, k: int, width: int, home: bool) -> pd.DataFrame:
    """One part against one slice of the queries that ask it."""
    out = []
    if len(queries) and len(rows):
        rows = rows.sort_values("at", kind="stable")
        part = Part(rows["vec_id"].to_numpy(), matrix(rows["vector"], width))
        for i in range(0, len(queries), AT_ONCE):
            some = queries.iloc[i:i + AT_ONCE]
            qids, before = some["query_id"].to_numpy(), part.scored
            score, ids = part.search(qids, matrix(some["vector"], width), *_kth(some), k, home)
            at, j = np.nonzero(score != -np.inf)
            found = pd.DataFrame({"query_id": qids[at], "vec_id": ids[at, j], "score": [int(x) for x in score[at, j]], "part": part_no})
            found["scored"] = 0
            if len(found):
                found.loc[0, "scored"] = part.scored - before
            out.append(found)
    return pd.concat(out) if out else pd.DataFrame({c.split()[0]: pd.Series(dtype="int64") for c in FOUND.split(", ")})


def route(slice_no: int, queries: pd.DataFrame, bounds: pd.DataFrame, width: int) -> pd.DataFrame:
    """The parts that each query of a slice still has to ask: those whose bound reaches its k-th score."""
    out = []
    if len(queries) and len(bounds):
        high, low, parts = matrix(bounds["high"], width), matrix(bounds["low"], width), bounds["part"].to_numpy()
        for i in range(0, len(queries), AT_ONCE):
            some = queries.iloc[i:i + AT_ONCE]
            q = matrix(some["vector"], width)
            kind = exact(q, np.concatenate([high, low]))
            up = upper_bounds(as_kind(q, kind), as_kind(high, kind), as_kind(low, kind))
            kth = np.array([-np.inf if s is None else s for s in _kth(some)[0]], dtype=up.dtype)
            at, p = np.nonzero((up >= kth[:, None]) & (parts != some["home"].to_numpy()[:, None]))
            asked = some.iloc[at][["query_id", "vector", "kth", "kth_id"]]
            out.append(asked.assign(part=parts[p], slice=slice_no)[["part", "slice", "query_id", "vector", "kth", "kth_id"]])
    return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in ASKED.split(", ")])


def placed_in_blocks(vectors: DataFrame, n: int, width: int) -> DataFrame:
    """(part, at, vec_id, vector): rows in the order of their blocks; ``at`` numbers the rows of a part."""
    spark = vectors.sparkSession
    sample = bounded_sample(vectors, "vec_id", max(1, min(MAX_SAMPLE, PART_VALUES // width)), n).orderBy("vec_id").toPandas()
    x = matrix(sample["vector"], width)
    x = x / max(np.abs(x).max(initial=0), 1)
    cells = cells_of(x, min(MAX_CELLS, max(1, len(x) // 16))) if len(x) else np.zeros((1, width))
    sent = spark.sparkContext.broadcast(cells)  # at most MAX_CELLS vectors

    def near(batches):
        for b in batches:
            x = matrix(b.column(1).to_pylist(), width)
            x /= np.maximum(np.abs(x).max(axis=1, keepdims=True), 1)
            yield pa.record_batch([pa.array((x @ sent.value.T).argmax(axis=1), pa.int32()), *b.columns], names=["cell", "vec_id", "vector"])

    rows = max(1, min(PART_VALUES // width, max(PART_LEAST, n // (2 * spark.sparkContext.defaultParallelism))))
    order = vectors.mapInArrow(near, "cell int, vec_id long, vector array<double>")
    order = order.repartitionByRange(-(-n // rows), "cell", "vec_id").sortWithinPartitions("cell", "vec_id").withColumn("mid", F.monotonically_increasing_id())
    # the number of a row holds that of its partition above bit 33
    order = order.select(F.shiftright("mid", 33).alias("part"), F.col("mid").bitwiseAND(F.lit((1 << 33) - 1)).alias("at"), "vec_id", "vector")
    return written(spark, order, "blocks")


def part_bounds(placed: DataFrame, width: int) -> DataFrame:
    """(part, high, low): largest and smallest value of each component, one row per part."""
    def bounds(batches):
        for b in batches:
            part, x = b.column(0).to_numpy(), matrix(b.column(1).to_pylist(), width)
            for p in np.unique(part):
                own = x[part == p]
                yield pa.record_batch([pa.array([p]), pa.array([own.max(axis=0).tolist()]), pa.array([own.min(axis=0).tolist()])], names=["part", "high", "low"])

    some = placed.select("part", "vector").mapInArrow(bounds, "part long, high array<double>, low array<double>")
    # one row per Arrow batch: component by component, then put together again
    each = some.select("part", F.posexplode(F.arrays_zip("high", "low"))).groupBy("part", "pos").agg(F.max("col.high").alias("high"), F.min("col.low").alias("low"))
    put = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("pos", c))), lambda x: x[c]).alias(c)
    return each.groupBy("part").agg(put("high"), put("low"))


def search(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score) and ``scored``: pairs that the query's task scored (on one row of it)."""
    spark = embeddings.sparkSession
    ship(spark)
    vectors = written(spark, integer_vectors(embeddings), "vectors")
    n, width = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long, scored long")
    placed = placed_in_blocks(vectors, n, width)
    queries = placed.where(F.col("vec_id") % every == 0).select(F.col("part").alias("home"), F.col("vec_id").alias("query_id"), "vector")

    def against(asked: DataFrame, rows: DataFrame, home: bool) -> DataFrame:
        def cell(key, q, r):
            return search_part(key[0], q, r, k, width, home)
        return asked.groupBy("part", "slice").cogroup(rows.groupBy("part", "slice")).applyInPandas(cell, FOUND)

    none = F.lit(None).cast("long")
    own = queries.select(F.col("home").alias("part"), F.lit(0).cast("long").alias("slice"), "query_id", "vector", none.alias("kth"), none.alias("kth_id"))
    first = written(spark, against(own, placed.withColumn("slice", F.lit(0).cast("long")), True), "home")

    # the k-th so far, where there are k: lowest score, then largest id
    last = F.min(F.struct("score", F.bitwise_not("vec_id").alias("not_id"))).alias("last")
    kth = first.groupBy("query_id").agg(F.count("*").alias("held"), last).where(F.col("held") >= k)         .select("query_id", F.col("last.score").alias("kth"), F.bitwise_not("last.not_id").alias("kth_id"))
    at_most = max(1, PART_VALUES // width)
    slices, groups = -(-n // every // at_most) + 1, placed.agg(F.max("part")).first()[0] // at_most + 1
    sliced = queries.join(kth, "query_id", "left").withColumn("slice", F.pmod(F.xxhash64("query_id"), F.lit(slices).cast("long")))
    sliced = sliced.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    bounds = part_bounds(placed, width).withColumn("group", F.floor(F.col("part") / at_most).cast("int"))         .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))

    def routed(key, q, b):
        return route(key[0], q, b, width)

    asked = written(spark, sliced.groupBy("slice", "group").cogroup(bounds.groupBy("slice", "group")).applyInPandas(routed, ASKED), "asked")
    # a part goes along with each slice that asks it
    rows = placed.toDF(*placed.columns).join(asked.select("part", F.col("slice").alias("s")).distinct(), "part").withColumnRenamed("s", "slice")
    found = first.unionByName(against(asked, rows, False))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).select("query_id", "rank", "vec_id", "score", "scored")


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The ``k`` rows of largest inner product for each row whose id ``every`` divides: query_id, rank, vec_id, score."""
    return search(embeddings, k, every).where(F.col("rank") <= k).drop("scored")

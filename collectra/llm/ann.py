"""Approximate nearest neighbours by inner product, with balanced posting lists.

*Space.*  A vector x gets one more component, sqrt(1 - |x|^2 / M^2) over the
largest length M, and a query none: then the nearest in distance is the one of
the largest inner product, for vectors of any length.

*Lists.*  Centroids come from recursive, balance-seeking k-means on a sample of
about ``MAX_SAMPLE`` vectors (by a hash of the id; the bound is a parameter): a
cell is split until it holds its share.  Every vector is then posted to its
nearest centroid and, if it lies at a boundary, to up to ``REPLICAS`` lists whose
centroid is at most ``BOUNDARY`` times as far, unless a chosen centroid is nearer
to that centroid than the vector is.

*Search.*  Centroids are few (at most ``MAX_LISTS``) and searched by an in-memory
neighbour graph, best first.  A query takes every list whose centroid is at most
``PRUNE`` times as far as the ``BASE``-th nearest one, however many these are; a pool that
turns out too small is doubled.  Where these lists hold fewer than k + 1 ids,
further ones are taken in order of distance, and a query that still has too few
results (ids may have several vectors) is searched again in more lists.  Lists hold distinct vectors with their k + 1
smallest ids (no query needs more of them), and stand in parts of about
``PART_ROWS`` ids: short neighbouring lists share one, a long list has many.
Each distinct query vector is searched once: it goes to each part that holds a
list of its own, in an equi-join, and the best k + 1 of the parts are merged and
then given to all queries with that vector, but for the query's own id.  The
query vectors of a part are cut into slices of about ``SLICE_ROWS``, each with
the part's rows, so a task holds bounded groups of both.

Edge cases: vectors that are null, zero, hold null or non-finite components, or
have another number of components than most, take no part; rows that repeat an
id count once per query, with their best score; an empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from collectra.llm.common import bounded_sample, pick, written

MAX_SAMPLE = 65_536
MAX_LISTS = 8_192
LIST_ROWS = 256
PART_ROWS = 16_384
SLICE_ROWS = 4_096
REPLICAS = 6
BOUNDARY = 1.25
PRUNE = 1.22
BASE = 3  # a tight list around a query says little of how far the next neighbours are
LINKS = 24
POOL = 48  # lists that a search keeps at first
BATCH = 256


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(1e-12, np.sqrt((x * x).sum(axis=-1, keepdims=True)))


def balanced_centroids(x: np.ndarray, most: int, seed: int = 0) -> np.ndarray:
    """Centroids of cells of at most ``most`` rows of length one; a cell of equal rows is one cell.

    Centroids have length one too: else the mean of many rows, which is short,
    would be the nearest of most rows where these point all ways.
    """
    rng = np.random.default_rng(seed)
    out, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        here = x[rows]
        if len(rows) <= most or (here == here[0]).all():
            out.append(unit(here.mean(axis=0)))
            continue
        k = int(min(16, max(2, -(-len(rows) // most))))
        c = here[rng.choice(len(rows), k, replace=False)]
        load = np.zeros(k)
        for _ in range(8):
            d = squared(here, c)
            # a cell with more than its share looks farther away
            at = (d + d.mean() * 0.2 * (load - 1).clip(0)).argmin(axis=1)
            n = np.bincount(at, minlength=k)
            load = n * k / len(rows)
            sums = np.zeros((k, x.shape[1]))
            np.add.at(sums, at, here)
            c = np.where(n[:, None] > 0, unit(sums), here[rng.choice(len(rows), k)])
        at = squared(here, c).argmin(axis=1)
        if np.bincount(at).max() == len(rows):  # no split found: halve along the widest axis
            axis = int(here.var(axis=0).argmax())
            at = (here[:, axis] > np.median(here[:, axis])).astype(int)
            if at.max() == at.min():
                at = (here[:, axis] > here[:, axis].min()).astype(int)
        todo += [rows[at == j] for j in np.unique(at)]
    return np.stack(out)


@dataclass
class CentroidGraph:
    centroids: np.ndarray
    links: np.ndarray  # (lists, LINKS) neighbours of each centroid
    entries: np.ndarray

    @classmethod
    def build(cls, centroids: np.ndarray) -> CentroidGraph:
        c = centroids.astype(np.float32)
        k = min(LINKS, len(c))
        links = np.concatenate([np.argpartition(squared(c[i:i + 512], c), k - 1, axis=1)[:, :k] for i in range(0, len(c), 512)])
        # entries all over: one of every stretch of the centroids, which stand in split order
        entries = np.unique(np.linspace(0, len(c) - 1, min(len(c), max(16, int(len(c) ** 0.5)))).astype(np.int64))
        return cls(c, links.astype(np.int64), entries)

    def near(self, x: np.ndarray, ratio: float, held: np.ndarray | None = None, need: int = 0) -> Iterator[np.ndarray]:
        """For each row of ``x`` the lists at most ``ratio`` times as far as the ``BASE``-th, nearest first.

        Further lists are taken until all together have ``need`` of the rows that are ``held``.
        """
        for i in range(0, len(x), BATCH):
            some, size = x[i:i + BATCH].astype(np.float32), POOL
            while True:
                ids, dist = self.pool(some, size, ratio)
                inside = dist <= ratio * _base(dist)
                if ids.shape[1] < size or size >= len(self.centroids) or not inside[:, -1].any():
                    break
                size *= 2  # lists within the ratio may be missing
            for row, r, k in zip(some, ids, inside, strict=True):
                short = held is not None and held[r[k]].sum() < need
                yield self.further(row, ratio, held, need) if short else r[k]

    def further(self, row: np.ndarray, ratio: float, held: np.ndarray, need: int) -> np.ndarray:
        """``near`` of one row by the distances of all centroids: links need not lead to all lists."""
        dist = np.sqrt(squared(row[None], self.centroids))[0]
        order = np.argsort(dist, kind="stable")
        inside = (dist <= ratio * _base(dist[order][None])[0, 0]).sum()
        return order[:max(inside, np.searchsorted(held[order].cumsum(), need) + 1)]

    def pool(self, x: np.ndarray, size: int, ratio: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search: the ``size`` nearest lists found for each row, and their distances.

        Steps go on from every pooled list, or those within ``ratio``.
        """
        c, n = self.centroids, len(self.centroids)
        rows = np.arange(len(x))[:, None]
        ids = np.broadcast_to(self.entries, (len(x), len(self.entries)))
        dist = np.sqrt(squared(x, c[self.entries]))
        seen = np.zeros((len(x), n), dtype=bool)
        seen[:, self.entries] = True
        done = np.zeros(ids.shape, dtype=bool)
        while True:
            order = np.argsort(dist, axis=1, kind="stable")[:, :size]
            ids, dist, done = (np.take_along_axis(v, order, 1) for v in (ids, dist, done))
            todo = ~done & np.isfinite(dist)
            if ratio is not None:
                todo &= dist <= ratio * _base(dist)
            if not todo.any():
                return ids, dist
            # the eight nearest open ones of every row step to their neighbours
            step = np.argsort(~todo, axis=1, kind="stable")[:, :8]
            use = np.take_along_axis(todo, step, 1)
            np.put_along_axis(done, step, np.take_along_axis(done, step, 1) | use, 1)
            new = np.where(use[:, :, None], self.links[np.take_along_axis(ids, step, 1)], n).reshape(len(x), -1)
            new.sort(axis=1)
            at = np.minimum(new, n - 1)
            fresh = (new < n) & np.c_[np.ones(len(x), bool), new[:, 1:] != new[:, :-1]] & ~seen[rows, at]
            far = np.full(new.shape, np.inf, dtype=np.float32)
            r, k = np.nonzero(fresh)
            seen[r, at[r, k]] = True
            far[r, k] = np.sqrt(((x[r] - c[at[r, k]]) ** 2).sum(axis=1))
            ids, dist, done = np.c_[ids, at], np.c_[dist, far], np.c_[done, ~fresh]


def _base(dist: np.ndarray) -> np.ndarray:
    at = min(BASE, dist.shape[1]) - 1
    return dist[:, at:at + 1]


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    y = x / longest
    return np.c_[y, np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))]


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part."""
    e = pick(embeddings, "vec_id", "embedding").withColumn("vec_id", F.col("vec_id").cast("long"))
    fine = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() \
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))) \
        & F.exists("embedding", lambda x: x != 0)
    e = e.where(fine)
    by_size = e.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return e.where(F.size("embedding") == (by_size.n if by_size else -1))


def fit(vectors: DataFrame) -> tuple[CentroidGraph, float] | None:
    """Graph of the centroids and the largest length. None if there is no vector."""
    n, longest = vectors.agg(F.count("*"), F.max(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x)))).first()
    if not n:
        return None
    sample = bounded_sample(vectors, "vec_id", MAX_SAMPLE, n).select("vec_id", "embedding").toPandas().sort_values("vec_id", kind="stable")
    x = lifted(np.stack(sample["embedding"].to_numpy()).astype(np.float64), longest)
    lists = min(MAX_LISTS, max(1, n // LIST_ROWS))
    return CentroidGraph.build(balanced_centroids(x, max(2, len(x) // lists))), float(longest)


def nearest(embeddings: DataFrame, k: int = 20, every: int = 20, prune: float = PRUNE) -> DataFrame:
    """The ``k`` nearest rows of each row whose id ``every`` divides: query_id, rank, vec_id, score."""
    spark = embeddings.sparkSession
    vectors = written(spark, valid_vectors(embeddings), "vectors")
    found = fit(vectors)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(spark, vectors, vectors.where(F.col("vec_id") % every == 0), *found, k=k, prune=prune)


def boundary_lists(graph: CentroidGraph, y: np.ndarray) -> list[np.ndarray]:
    """The lists that each row of ``y`` is posted to, nearest first."""
    out = []
    for i in range(0, len(y), BATCH):
        x = y[i:i + BATCH].astype(np.float32)
        ids, dist = graph.pool(x, POOL)
        c = graph.centroids[ids]
        between = 2 - 2 * np.einsum("bid,bjd->bij", c, c)  # squared, of unit vectors
        chosen = np.zeros(ids.shape, dtype=bool)
        chosen[:, 0] = True
        for j in range(1, ids.shape[1]):
            apart = (~chosen | (between[:, :, j] >= dist[:, j, None] ** 2)).all(axis=1)
            chosen[:, j] = apart & (dist[:, j] <= BOUNDARY * dist[:, 0]) & (chosen.sum(axis=1) < REPLICAS)
        out += [r[k] for r, k in zip(ids, chosen, strict=True)]
    return out


def _matrix(part: pa.RecordBatch) -> np.ndarray:
    return part.column(1).flatten().to_numpy().astype(np.float64).reshape(part.num_rows, -1)


def posted(spark: SparkSession, vectors: DataFrame, graph: CentroidGraph, longest: float) -> DataFrame:
    """(list, vector, embedding, ids, main): each distinct vector in the lists it is posted to, the nearest marked."""
    # at most MAX_LISTS centroids and their links: some 5 MB
    sent = spark.sparkContext.broadcast((graph, longest))

    def post(batches):
        graph, longest = sent.value
        for b in batches:
            for i in range(0, b.num_rows, BATCH):
                part = b.slice(i, BATCH)
                own = boundary_lists(graph, lifted(_matrix(part), longest))
                at = pa.array(np.repeat(np.arange(len(own)), [len(x) for x in own]))
                yield pa.record_batch([pa.array(np.concatenate(own).astype(np.int32)), *[part.column(c).take(at) for c in range(3)],
                                       pa.array(np.concatenate([np.arange(len(x)) == 0 for x in own]))],
                                      names=["list", "vector", "embedding", "ids", "main"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    return vectors.select("vector", "embedding", "ids").mapInArrow(post, f"list int, vector long, embedding {kind}, ids array<long>, main boolean")


def parts_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First part and number of parts of each list, given the rows of each."""
    first, n, part, held = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), 0, 0
    for i, rows in enumerate(sizes):
        if held and held + rows > PART_ROWS:
            part, held = part + 1, 0
        first[i], n[i] = part, max(1, -(-int(rows) // PART_ROWS))
        held += rows
        if rows > PART_ROWS:
            part, held = part + n[i], 0
    return first, n


def asked(spark: SparkSession, queries: DataFrame, graph: CentroidGraph, first: np.ndarray, n: np.ndarray, prune: float,
          held: np.ndarray, need: int) -> DataFrame:
    """(part, vector, embedding, lists): each query vector with the lists it searches in each part."""
    sent = spark.sparkContext.broadcast((graph, first, n, held))

    def ask(batches):
        graph, first, n, held = sent.value
        for b in batches:
            for i in range(0, b.num_rows, BATCH):
                part = b.slice(i, BATCH)
                x = _matrix(part)
                x = np.c_[x / np.sqrt((x * x).sum(axis=1))[:, None], np.zeros(len(x))]
                at, to, lists = [], [], []
                for row, ids in enumerate(graph.near(x, prune, held, need)):
                    by: dict[int, list[int]] = {}
                    for j in ids.tolist():
                        for p in range(first[j], first[j] + n[j]):
                            by.setdefault(p, []).append(j)
                    at += [row] * len(by)
                    to += by
                    lists += by.values()
                at = pa.array(at, pa.int64())
                yield pa.record_batch([pa.array(to, pa.int32()), part.column(0).take(at), part.column(1).take(at), pa.array(lists, pa.list_(pa.int32()))],
                                      names=["part", "vector", "embedding", "lists"])

    kind = queries.schema["embedding"].dataType.simpleString()
    return queries.select("vector", "embedding").mapInArrow(ask, f"part int, vector long, embedding {kind}, lists array<int>")


def distinct_vectors(vectors: DataFrame, most: int) -> DataFrame:
    """(vector, embedding, ids): each distinct embedding with a number and its ``most`` smallest ids."""
    # a task passes on ``most`` rows of an embedding at most, however many there are
    first = Window.partitionBy("embedding").orderBy("vec_id")
    each = vectors.select("vec_id", "embedding").distinct().withColumn("at", F.row_number().over(first)).where(F.col("at") <= most)
    each = each.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return written(vectors.sparkSession, each.select(F.monotonically_increasing_id().alias("vector"), "embedding", "ids"), "distinct_vectors")


def groups(rows: DataFrame, questions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both by (part, slice): about ``SLICE_ROWS`` questions of a part each, and the part's rows for each slice."""
    slices = questions.groupBy("part").agg(F.ceil(F.count("*") / SLICE_ROWS).cast("int").alias("slices"))
    rows = rows.join(slices, "part").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    questions = questions.join(slices, "part").withColumn("slice", F.pmod(F.xxhash64("vector"), F.col("slices")).cast("int"))
    return rows.drop("slices"), questions.drop("slices")


def search(spark: SparkSession, vectors: DataFrame, queries: DataFrame, graph: CentroidGraph, longest: float, k: int, prune: float) -> DataFrame:
    most = k + 1  # of a query vector: one of its results may be the query itself
    distinct = distinct_vectors(vectors, most)
    # written right after the join: Spark splits a vector that very many queries have
    copies = written(spark, queries.select(F.col("vec_id").alias("query_id"), "embedding").distinct()
                     .join(distinct.select("embedding", "vector"), "embedding").select("query_id", "vector"), "copies")
    postings = written(spark, posted(spark, distinct, graph, longest), "postings")
    ids = F.size("ids")
    count = {r.list: r for r in postings.groupBy("list").agg(  # at most MAX_LISTS rows
        F.sum(ids).alias("n"), F.sum(F.when(F.col("main"), ids).otherwise(0)).alias("held")).collect()}
    lists = range(len(graph.centroids))
    first, n = parts_of(np.array([count[i].n if i in count else 0 for i in lists]))
    # a vector counts in one list only
    held = np.array([count[i].held if i in count else 0 for i in lists])
    place = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(zip(first, n, strict=True))], "list int, first int, parts int")
    rows = postings.join(F.broadcast(place), "list").select(  # at most MAX_LISTS short rows
        (F.col("first") + F.pmod(F.xxhash64("vector"), F.col("parts"))).cast("int").alias("part"), "list", "embedding", "ids")

    def best(row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An id once per row (its best score), then the first ``most`` of each row."""
        order = np.lexsort((-score, ids, row))
        row, ids, score = row[order], ids[order], score[order]
        once = np.r_[True, (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])][:len(row)]
        row, ids, score = row[once], ids[once], score[once]
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < most
        return row[keep], ids[keep], score[keep]

    def scan(key, rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """The best ``most`` ids of this part for each query vector, from the lists that it searches."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(rows) and len(asked):
            x, of = np.stack(rows["embedding"].to_numpy()), rows["list"].to_numpy()
            own = rows["ids"].to_numpy()
            q = np.stack(asked["embedding"].to_numpy()).astype(np.float64)
            wants = np.repeat(np.arange(len(asked)), asked["lists"].str.len())
            wanted = np.concatenate(asked["lists"].to_numpy())
            for one in np.unique(of):
                at, who = np.flatnonzero(of == one), wants[wanted == one]
                y = x[at].astype(np.float64)
                ids = np.concatenate(own[at])
                by = np.argsort(ids, kind="stable")
                vector = np.repeat(np.arange(len(at)), [len(i) for i in own[at]])[by]
                ids, start = np.unique(ids[by], return_index=True)
                for i in range(0, len(who), BATCH):
                    some = who[i:i + BATCH]
                    # by id: the best of the vectors that have it
                    score = np.maximum.reduceat((q[some] @ y.T)[:, vector], start, axis=1)
                    # ids that reach the last of the best of the list
                    least = np.partition(score, -min(most, len(ids)), axis=1)[:, [-min(most, len(ids))]]
                    r, c = np.nonzero(score >= least)
                    out.append(best(some[r], ids[c], score[r, c]))
        row, ids, score = best(*map(np.concatenate, zip(*out)))
        return pd.DataFrame({"vector": asked["vector"].to_numpy(np.int64)[row], "vec_id": ids, "score": score})

    def searched(queries: DataFrame, need: int) -> DataFrame:
        """(vector, found): the best ``most`` ids of each query vector, from lists that hold ``need`` at least."""
        questions = written(spark, asked(spark, queries, graph, first, n, prune, held, need), "questions")
        each = [x.groupBy("part", "slice") for x in groups(rows, questions)]
        each = each[0].cogroup(each[1]).applyInPandas(scan, "vector long, vec_id long, score double")
        # an id may come from parts of several lists; the best of a vector are cut before they are shuffled
        per = each.groupBy("vector", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("vector").orderBy(F.desc("score"), "vec_id")
        per = per.withColumn("at", F.row_number().over(order)).where(F.col("at") <= most)
        return written(spark, per.groupBy("vector").agg(F.collect_list(F.struct("vec_id", "score")).alias("found")), "found")

    left, need = distinct.join(copies.select("vector").distinct(), "vector", "left_semi"), most
    per = found = searched(left, need)
    some = most  # or all ids of a table that has fewer
    if not found.where(F.size("found") < most).isEmpty():
        some = vectors.select("vec_id").distinct().limit(most).count()
    full = F.size("found") >= some
    # ids that have several vectors count more than once in ``held``: the short ones are searched again, in more lists
    while need < held.sum() and not (left := left.join(found.where(full), "vector", "left_anti")).isEmpty():
        need *= 8
        found = searched(left, need)
        per = per.where(full).unionByName(found)
    # to the copies of each vector; an id that has several vectors takes its best of all
    per = copies.join(per, "vector").select("query_id", F.inline("found")).where("vec_id != query_id")
    per = per.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return per.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

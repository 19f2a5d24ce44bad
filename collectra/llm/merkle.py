"""Merkle manifest of a dataset: one tree per source, one over the sources, and a proof per row.

A row's leaf is the digest of its fields, made in the JVM where the text is; from
there on only digests move.  Leaves get their place in their source from a range
sort (per partition counts, added up, give the offsets), and trees grow by
*aligned append with incremental witnesses* (:class:`Appender`): nodes are
appended in order, a run of ``ARITY`` siblings that fills up becomes a node one
level up, and at that moment the witnesses of all leaves below the run are
extended with the siblings they were missing.  A task appends one block of
``BLOCK`` leaves after the other; the roots of the blocks are written and appended
in the next round in blocks of their own, as often as a source needs (the driver
sees the number of rounds only), and the subroots of the sources likewise.

Witnesses run back the other way: what a block root's witness has gained in the
later rounds is joined to the block (one row each) and shared by its leaves; a
leaf's own proof is put together only in the task that hashes and folds it, so
no table ever holds the full witnesses of all rows.

Edge cases: in a source, rows with a null id stand first and rows of one id by
their leaf (equal leaves are equal rows); a null source is a source of its own
and stands first; a source with one row has that leaf as subroot; a row without
any sibling has the digest of nothing as proof; a null or mixed-case-free text
is not changed by tampering, so it verifies; an empty table gives no rows.  Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from collectra.llm.common import pick, ship, written

ARITY = 16
BLOCK = ARITY * ARITY  # nodes appended by one block: two levels
ROWS = 32  # blocks in an Arrow batch that leaves a task
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPERED_EVERY = 5


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: dict):
    """Digest of the fields' lengths and values; ``-`` where null."""
    def part(c):
        v = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return F.sha2(F.concat(*[part(fields[c]) for c in FIELDS]).cast("binary"), 256)


class Appender:
    """Nodes appended in order, with a witness for each leaf that grows as its siblings complete.

    A witness is a list of steps, one per level: the siblings before and after
    the node on the leaf's way up.
    """

    def __init__(self, levels: int):
        """``levels``: of the tree that the appended nodes are the leaves of."""
        self.levels = levels
        # per level: nodes of the open run, and the leaves below each
        self.open: list[list[tuple[str, list[int]]]] = [[] for _ in range(levels + 1)]
        self.witnesses: list[list[tuple[str, str]]] = []

    def append(self, node: str) -> None:
        self.witnesses.append([])
        self._add(0, node, [len(self.witnesses) - 1])

    def _add(self, level: int, node: str, below: list[int]) -> None:
        run = self.open[level]
        run.append((node, below))
        if level < self.levels and len(run) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """A run has all its nodes: leaves below get the siblings, the run goes up as one node."""
        run, self.open[level] = self.open[level], []
        nodes = [n for n, _ in run]
        for i, (_, below) in enumerate(run):
            step = "".join(nodes[:i]), "".join(nodes[i + 1:])
            for leaf in below:
                self.witnesses[leaf].append(step)
        self._add(level + 1, digest(*nodes), [leaf for _, below in run for leaf in below])

    def root(self) -> str:
        """No more nodes come: open runs are completed as they are."""
        for level in range(self.levels):
            if self.open[level]:
                self._complete(level)
        (node, _), = self.open[self.levels]
        return node


def levels_of(total: int) -> int:
    """Levels that a block of a tree with ``total`` nodes adds: all of a small tree, else two."""
    return 0 if total == 1 else 1 if total <= ARITY else 2


def fold(node: str, steps) -> str:
    """The root that a leaf and its witness make."""
    for left, right in steps:
        node = digest(left, node, right)
    return node


NODE = "grp string, pos long, total long, node string"


def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` with ``pos``, the place in ``grp`` by ``order``, and ``total``, the nodes of the group.

    A range sort deals out a hot group; each row is numbered by its partition's
    row numbers and the counts of the partitions before.
    """
    spark = nodes.sparkSession
    # rows that are equal in all of ``order`` may be split too
    ranged = nodes.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    keys = [F.col(c).asc_nulls_first() for c in ("grp", *order, "salt")]
    ranged = ranged.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("salt").withColumn("mid", F.monotonically_increasing_id())
    ranged = written(spark, ranged.withColumn("p", F.shiftright("mid", 33)), "ranged")
    held = ranged.groupBy("grp", "p").agg(F.min("mid").alias("first"), F.count("*").alias("n"))
    w = Window.partitionBy("grp")
    before = F.sum("n").over(w.orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    held = held.select(F.col("grp").alias("g"), F.col("p").alias("q"), "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(w).alias("total"))
    joined = ranged.join(held, (F.col("p") == F.col("q")) & F.col("grp").eqNullSafe(F.col("g")))
    return joined.withColumn("pos", F.col("mid") - F.col("first") + F.col("before")).drop("mid", "p", "g", "q", "first", "before")


def blocks(nodes: DataFrame, more: dict[str, str]) -> DataFrame:
    """One row per block of up to ``BLOCK`` nodes: (grp, block, total, root, nodes, and ``more`` columns as arrays).

    ``more``: names and types of columns that go along.
    """
    names = list(more)

    def append(batches):
        now, made, rows = None, None, []
        for b in batches:
            columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
            for grp, block, total, node, *rest in zip(*columns, strict=True):
                if (grp, block) != now:
                    if made is not None:
                        rows.append(done(now, made))
                        if len(rows) >= ROWS:
                            yield batch(rows)
                            rows = []
                    now, made = (grp, block), (total, Appender(levels_of(total)), [], [[] for _ in names])
                made[1].append(node)
                made[2].append(node)
                for held, v in zip(made[3], rest, strict=True):
                    held.append(v)
        if made is not None:
            rows.append(done(now, made))
        if rows:
            yield batch(rows)

    def done(now, made):
        total, appender, nodes, rest = made
        return [*now, total, appender.root(), nodes, *rest]

    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string())] + [pa.list_(pa.int64() if t == "long" else pa.string()) for t in more.values()]

    def batch(rows):
        return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                               names=["grp", "block", "total", "root", "nodes", *names])

    schema = "grp string, block long, total long, root string, nodes array<string>" + "".join(f", {n} array<{t}>" for n, t in more.items())
    d = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK)).repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
    return written(nodes.sparkSession, d.select("grp", "block", "total", "node", *names).mapInArrow(append, schema), "blocks")


def rounds(nodes: DataFrame, more: dict[str, str]) -> list[DataFrame]:
    """Blocks of the nodes, blocks of their roots, and so on until each group is one block."""
    out = [blocks(nodes, more)]
    while out[-1].where(F.col("block") > 0).limit(1).count():
        last = out[-1]
        total = F.ceil(F.col("total") / BLOCK).cast("long")
        out.append(blocks(last.select("grp", F.col("block").alias("pos"), total.alias("total"), F.col("root").alias("node")), {}))
    return out


def witnessed(block: dict) -> Iterator[list[tuple[str, str]]]:
    """The witnesses of a block's nodes within the block, with what its root has gained above."""
    appender = Appender(levels_of(block["total"]))
    for node in block["nodes"]:
        appender.append(node)
    appender.root()
    above = list(zip(block["lefts"] or [], block["rights"] or [], strict=True))
    for own in appender.witnesses:
        yield own + above


ABOVE = "grp string, block long, lefts array<string>, rights array<string>"


def unfolded(blocks_: DataFrame, above: DataFrame) -> DataFrame:
    """(grp, block, lefts, rights): the full witness of each node of a block, ``block`` being its place in the group."""
    def unfold(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                for i, steps in enumerate(witnessed(r)):
                    rows.append((r["grp"], r["block"] * BLOCK + i, [x for x, _ in steps], [y for _, y in steps]))
            if rows:
                types = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      names=["grp", "block", "lefts", "rights"])

    return written(blocks_.sparkSession, with_above(blocks_, above).select("grp", "block", "total", "nodes", "lefts", "rights").mapInArrow(unfold, ABOVE), "witnesses")


def with_above(blocks_: DataFrame, above: DataFrame) -> DataFrame:
    a = above.select(F.col("grp").alias("g"), F.col("block").alias("b"), "lefts", "rights")
    return blocks_.join(a, (F.col("block") == F.col("b")) & F.col("grp").eqNullSafe(F.col("g")), "left").drop("g", "b")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; and source."""
    spark = docs.sparkSession
    ship(spark)
    d = pick(docs, *FIELDS)
    fields = {c: F.col(c) for c in FIELDS}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_EVERY == 0
    small = fields | {"text": F.translate(F.col("text").cast("string"), UPPER, SMALL)}
    leaves = d.select(F.col("source").cast("string").alias("grp"), "doc_id", leaf_digest(fields).alias("node"),
                      F.when(tampered, leaf_digest(small)).alias("seen"))
    leaves = written(spark, leaves, "leaves")
    kind = leaves.schema["doc_id"].dataType.simpleString()
    leaves = numbered(leaves.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "node")
    by_source = rounds(leaves, {"doc_id": "long", "seen": "string"})
    subroots = by_source[-1].select("grp", F.col("root").alias("node"))
    # the sources in order: the tree over their subroots is one group
    top = numbered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("source"), "node"), "source")
    top = written(spark, top, "sources")
    over = rounds(top, {})

    above = spark.createDataFrame([], ABOVE)
    for r in reversed(over):
        above = unfolded(r, above)
    # from here on a node above is the one block that a source has in its last round
    above = top.join(above.drop("grp"), F.col("pos") == F.col("block")).select(F.col("source").alias("grp"), F.lit(0).cast("long").alias("block"), "lefts", "rights")
    above = written(spark, above, "above")
    for r in reversed(by_source[1:]):
        above = unfolded(r, above)

    roots = over[-1].select(F.col("root").alias("tree"))  # one row, none for an empty table

    def prove(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                for node, doc, seen, steps in zip(r["nodes"], r["doc_id"], r["seen"], witnessed(r), strict=True):
                    proof = digest(*[x for step in steps for x in step])
                    rows.append((r["grp"], doc, node, proof, fold(node if seen is None else seen, steps)))
            if rows:
                types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      names=["source", "doc_id", "leaf", "proof_sha256", "folded_root"])

    proved = with_above(by_source[0], above).select("grp", "block", "total", "nodes", "doc_id", "seen", "lefts", "rights") \
        .mapInArrow(prove, "source string, doc_id long, leaf string, proof_sha256 string, folded_root string")
    tree = roots.first()
    sub = subroots.select(F.col("grp").alias("s"), F.col("node").alias("subroot"))
    root = F.lit(tree.tree if tree else None).cast("string")
    return proved.join(sub, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("doc_id").cast(kind).alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"), "source")

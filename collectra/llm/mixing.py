"""Mixing sources to target weights, with DataFrame and SQL functions only.

1. *Sizes.*  The words of a source, document after document, are one stream,
   cut into blocks of ``block`` words; a document lies in one or more blocks.
   Places in the stream are prefix sums of two levels (hashed chunks of a
   source, then documents of a chunk), so no task sorts a whole source.
2. *Targets.*  Sources by code point, null last, weigh 1, 2, 3 and so on again;
   the sum of all sizes is shared by weight.  A target stops at ``most`` times
   the size of its source; the excess goes to the others by weight until none
   is above.
3. *Slots.*  A source with target t has as many slots as it takes, block by
   block, to give t words (rounded); the last slot takes only the words that are
   left of t.  A pseudorandom permutation of all slots deals them to output
   shards of ``shard`` slots: the source counts of a shard are multinomial
   draws, given that they sum to the slots of each source, so targets are met to
   the word at any size of the mix.  The counts of the shards before number a
   source's slots in a shard.
4. *Blocks.*  The k-th slot of a source takes the block at place k of a
   pseudorandom permutation of its blocks, then starts over: no block is taken
   twice before all are taken once, and none more than ``most`` times.
   Slots and blocks meet in an equi-join on (source, block).

The permutations are swap-or-not shuffles: a few rounds of a keyed hash that
permute 0..n-1 for any n, so nothing is sorted or numbered, and a lost executor
or another run gives the same draw.

Edge cases: null and empty texts have size 0 and are taken 0 times; a null
source is a source of its own, after all others; a source without words has
target 0.  Rows that repeat a ``doc_id`` are rows of one document: ``taken`` and
``size`` are per row, and rows with equal ids are told apart by text and source
(full copies have equal sizes and share what the mix takes).  A null ``doc_id``
is kept.  An empty table gives an empty mix.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from collectra.llm.common import WORD, let, pick, written

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
WEIGHTS = (1, 2, 3)
MOST = 3
ROUNDS = 16
CHUNK_DOCS = 1024


def words(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def permuted(x: Column, n: Column, *key) -> Column:
    """Place of ``x`` in a keyed pseudorandom permutation of 0..n-1 (swap-or-not shuffle)."""
    def turn(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - at, n)
        return F.when(F.pmod(F.xxhash64(*key, r, F.greatest(at, other)), F.lit(2)) == 0, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), turn)


def unpermuted(x: Column, n: Column, *key) -> Column:
    """The ``y`` with ``permuted(y) = x``: every round undoes itself, so the rounds run backwards."""
    def turn(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - at, n)
        return F.when(F.pmod(F.xxhash64(*key, r, F.greatest(at, other)), F.lit(2)) == 0, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(ROUNDS), F.lit(1)), x.cast("long"), turn)


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) with weight and target added; one row per source.

    The excess is reshared in closed form: sources fill up in order of
    size / weight, so with sources in that order the first i are full exactly if
    the share of the rest per weight is still above their bound.  Sums run over
    one row per source, as the numbering by code point needs them in one order.
    """
    all_rows = Window.partitionBy()
    # byte order of UTF-8 is code point order
    rank = F.row_number().over(Window.partitionBy().orderBy(F.col("source").isNull(), F.col("source").cast("binary")))
    w = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                                  (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int")))
    fill = Window.partitionBy().orderBy(F.col("bound") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    w = (w.withColumn("bound", F.col("source_size") * F.lit(float(most)))
         .withColumn("total", F.sum("source_size").over(all_rows).cast("double"))
         .withColumn("left", F.col("total") - F.coalesce(F.sum("bound").over(before), F.lit(0.0)))
         .withColumn("weight_left", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("full", F.col("left") / F.col("weight_left") * F.col("weight") >= F.col("bound")))
    # the share per weight once the full ones are filled: that of the first that is not
    level = F.max(F.when(~F.col("full"), F.struct(-F.col("bound") / F.col("weight"), F.col("left") / F.col("weight_left")))).over(all_rows)
    return w.select("source", "source_size", "weight",
                    F.when(F.col("full"), F.col("bound")).otherwise(F.col("weight") * level["col2"]).alias("target"))


def placed(docs: DataFrame) -> DataFrame:
    """Each row's size and the place ``start`` of its first word in the stream of its source."""
    spark = docs.sparkSession
    d = pick(docs, "doc_id", "text", "source").withColumn("size", words(F.col("text").cast("string")))
    d = d.select("doc_id", "source", "size", F.xxhash64("text").alias("tie"))
    chunks = max(1, d.count() // CHUNK_DOCS)  # of the largest source a task sorts no more rows than these
    d = written(spark, d.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(chunks))), "sizes")
    sums = d.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
    # one row per source and chunk
    by_chunk = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("source", "chunk", F.coalesce(F.sum("words").over(by_chunk), F.lit(0)).alias("base"))
    in_chunk = Window.partitionBy("source", "chunk").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = d.withColumn("inner", F.coalesce(F.sum("size").over(in_chunk), F.lit(0)))
    return rows.alias("d").join(base.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.chunk") == F.col("b.chunk"))) \
        .select("d.doc_id", "d.source", "d.tie", "d.size", (F.col("base") + F.col("inner")).alias("start"))


def plan(placed_rows: DataFrame, block: int = BLOCK_WORDS, weights=WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """One row per source: source_size, target, blocks, slots, cut, first_slot, all_slots.

    Whole rounds over the blocks come first; the slots of the last round are as
    many as its words need, and the last of them takes ``cut`` words of its block
    only, so a source gives its rounded target to the word.
    """
    sizes = placed_rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = targets(sizes, weights, most).withColumn("blocks", F.ceil(F.col("source_size") / block))
    size, blocks = F.col("source_size"), F.col("blocks")
    t = t.withColumn("goal", F.round("target").cast("long")) \
        .withColumn("rounds", F.when(size > 0, F.floor(F.col("goal") / size)).otherwise(0)) \
        .withColumn("rest", F.col("goal") - F.col("rounds") * size) \
        .withColumn("missing", blocks * block - size) \
        .withColumn("short_at", F.when(blocks > 0, unpermuted(blocks - 1, blocks, F.lit(seed), F.col("source"))))
    # words of the first m blocks of a round: the short block counts if it is one of them
    reach = lambda m: m * block - F.when(F.col("short_at") < m, F.col("missing")).otherwise(0)
    few = F.ceil(F.col("rest") / block)
    t = t.withColumn("m", few + F.when(reach(few) < F.col("rest"), 1).otherwise(0)) \
        .withColumn("cut", F.when(F.col("m") > 0, F.col("rest") - reach(F.col("m") - 1))) \
        .withColumn("slots", (F.col("rounds") * blocks + F.col("m")).cast("long"))
    before = Window.partitionBy().orderBy(F.col("source").isNull(), F.col("source")).rowsBetween(Window.unboundedPreceding, -1)
    return t.select("source", "source_size", "weight", "target", "blocks", "slots", "cut") \
        .withColumn("first_slot", F.coalesce(F.sum("slots").over(before), F.lit(0))) \
        .withColumn("all_slots", F.sum("slots").over(Window.partitionBy()))


def draws(sources: DataFrame, shard: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """Every slot of the mix dealt to a shard: shard, place, source."""
    step = 16_384  # a hot source's slots are made by many tasks
    all_slots = sources.agg(F.max("all_slots")).first()[0] or 0
    runs = (sources.where("slots > 0")
            .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(step).cast("long"))))
            # so few bytes that Spark would take them into one task: the number of tasks is said
            .repartition(min(100_000, 1 + all_slots // step), "source", "run"))
    each = runs.withColumn("k", F.explode(F.sequence(F.col("run"), F.least(F.col("run") + step, F.col("slots")) - 1)))
    return (each.withColumn("place", permuted(F.col("first_slot") + F.col("k"), F.col("all_slots"), F.lit(seed)))
            .select(F.floor(F.col("place") / shard).alias("shard"), "place", "source"))


def shard_counts(sources: DataFrame, shard: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """The draw of every output shard: shard, source, n."""
    return draws(sources, shard, seed).groupBy("shard", "source").agg(F.count("*").alias("n"))


def slots(sources: DataFrame, shard: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """Every slot of the mix: shard, place, source, epoch, the block it takes and ``words``, how many of it (null: all).

    A source's slots are numbered shard by shard: the counts drawn before give
    the first number in a shard, the places there the rest.
    """
    spark = sources.sparkSession
    drawn_ = written(spark, draws(sources, shard, seed), "draws")
    n = drawn_.groupBy("shard", "source").agg(F.count("*").alias("n"))
    # one row per source and shard
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = n.select("shard", "source", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    in_shard = drawn_.withColumn("i", F.row_number().over(Window.partitionBy("shard", "source").orderBy("place")) - 1)
    same = F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.shard") == F.col("b.shard"))
    numbered = in_shard.alias("d").join(base.alias("b"), same).select("d.shard", "d.place", "d.source", (F.col("base") + F.col("i")).alias("k"))
    s = sources.select(F.col("source").alias("s"), "blocks", "slots", "cut")
    each = numbered.join(s, F.col("source").eqNullSafe(F.col("s")))
    return each.select("shard", "place", "source", F.floor(F.col("k") / F.col("blocks")).alias("epoch"),
                       permuted(F.pmod("k", "blocks"), F.col("blocks"), F.lit(seed), F.col("source")).alias("block"),
                       F.when(F.col("k") == F.col("slots") - 1, F.col("cut")).alias("words"))


def pieces(placed_rows: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The part of each row that lies in each block: first word (from 0) and number of words."""
    p = placed_rows.where("size > 0")
    p = p.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block),
                                                   F.floor((F.col("start") + F.col("size") - 1) / block))))
    first = F.greatest(F.col("start"), F.col("block") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    return p.select("doc_id", "source", "tie", "start", "block", (first - F.col("block") * block).alias("offset"),
                    (first - F.col("start")).alias("first"), (end - first).alias("n"))


def of_cut(cut: Column) -> Column:
    """Words of a piece among the first ``cut`` of its block."""
    # null: none (least and greatest pass over nulls)
    return F.when(cut.isNotNull(), F.greatest(F.lit(0), F.least(F.col("offset") + F.col("n"), cut) - F.col("offset")))


def drawn(placed_rows: DataFrame, sources: DataFrame, block: int = BLOCK_WORDS, shard: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """``pieces`` joined by block with the slots that take them: epoch, shard and place added."""
    p, s = pieces(placed_rows, block).alias("p"), written(placed_rows.sparkSession, slots(sources, shard, seed), "slots").alias("s")
    return p.join(s, F.col("p.source").eqNullSafe(F.col("s.source")) & (F.col("p.block") == F.col("s.block"))) \
        .select("p.*", "s.epoch", "s.shard", "s.place", "s.words") \
        .withColumn("n", F.when(F.col("words").isNull(), F.col("n")).otherwise(of_cut(F.col("words")))).where("n > 0").drop("words")


def taken_words(docs: DataFrame, block: int = BLOCK_WORDS, weights=WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (and source, first_shard).

    ``first_shard``: the first output shard that holds words of it (null: none does).
    """
    spark = docs.sparkSession
    rows = written(spark, placed(docs), "placed")
    sources = written(spark, plan(rows, block, weights, most, seed), "sources")
    # how often each block is taken: one row per block that is, summed before the join
    # (written, as Spark would guess its size from that of ``sources`` and broadcast it)
    whole = F.col("words").isNull()
    times = written(spark, slots(sources, seed=seed).groupBy("source", "block").agg(
        F.count_if(whole).alias("times"), F.min(F.when(whole, F.col("shard"))).alias("shard"),
        F.max("words").alias("cut"), F.min(F.when(~whole, F.col("shard"))).alias("cut_shard")), "times")
    p = pieces(rows, block).alias("p")
    cut = F.coalesce(of_cut(F.col("cut")), F.lit(0))
    first = F.least(F.col("shard"), F.when(cut > 0, F.col("cut_shard")))
    taken = (p.join(times.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")) & (F.col("p.block") == F.col("t.block")))
             .groupBy("p.doc_id", "p.tie", "p.source", "p.start").agg(F.sum(F.col("n") * F.col("times") + cut).alias("taken"), F.min(first).alias("first_shard")))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ("doc_id", "tie", "source", "start")]
    with_taken = rows.alias("r").join(taken.alias("k"), same[0] & same[1] & same[2] & same[3] & (F.col("r.size") > 0), "left") \
        .select("r.doc_id", "r.source", "r.size", F.coalesce("k.taken", F.lit(0)).alias("taken"), "k.first_shard")
    return (with_taken.alias("r").join(sources.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")), "left")
            .select("r.doc_id", "r.source", "r.size", "s.source_size", "s.target", "r.taken", "r.first_shard"))


def mix(docs: DataFrame, block: int = BLOCK_WORDS, weights=WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """The mixed documents, in the columns of ``docs``.

    A row for each time (epoch) that the mix takes words of a document: its whole
    text where it takes all of them, else the words of the blocks that it takes,
    in order, with a space between.  ``n_chars`` (if there) follows the text.
    """
    spark = docs.sparkSession
    rows = written(spark, placed(docs), "placed")
    sources = written(spark, plan(rows, block, weights, most, seed), "sources")
    taken = (drawn(rows, sources, block, seed=seed).groupBy("doc_id", "tie", "source", "start", "epoch")
             .agg(F.sort_array(F.collect_list(F.struct("first", "n"))).alias("parts"), F.sum("n").alias("n")))
    taken = written(spark, taken.select("doc_id", "tie", "source", "parts", "n"), "taken")
    names = docs.columns
    d = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = {c: F.col(f"c{names.index(c)}") for c in ("doc_id", "text", "source")}
    # equal rows are one row here: ``taken`` has the share of each of them
    d = d.withColumn("tie", F.xxhash64(at["text"])).dropDuplicates([f"c{names.index(c)}" for c in ("doc_id", "source")] + ["tie"])
    d = d.withColumn("size", words(at["text"]))
    t = taken.alias("t")
    j = d.join(t, at["doc_id"].eqNullSafe(F.col("t.doc_id")) & at["source"].eqNullSafe(F.col("t.source")) & (d["tie"] == F.col("t.tie")))
    whole = F.col("t.n") == F.col("size")
    cut = let(F.regexp_extract_all(at["text"], F.lit(f"({WORD})"), F.lit(1)), lambda w: F.array_join(F.flatten(F.transform(
        F.col("parts"), lambda p: F.slice(w, (p["first"] + 1).cast("int"), p["n"].cast("int")))), " "))
    made = j.withColumn("new", F.when(whole, at["text"]).otherwise(cut))
    return made.select(*[F.col("new").alias(n) if n == "text" else F.length("new").cast("long").alias(n) if n == "n_chars"
                         else F.col(f"c{i}").alias(n) for i, n in enumerate(names)])

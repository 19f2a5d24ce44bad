"""Indexes that are written beside a stored detail and read before it.

*Order index.*  Rows are stored range-partitioned and sorted by a page key, one
folder ``_parte=<n>`` per range, with the number of rows and the last key of
each: a page, wherever it is, opens the ranges that hold it and no other.

*Trigram filters.*  Per range and text column, a bit filter of the character
trigrams that occur in it.  A term can only be where all its trigrams are, so
ranges without one of them are dropped before the scan.  A filter that is full
drops nothing; a row is never lost.

*Posting lists.*  Trigram -> row numbers, in key order, with the length of each
list: a lookup intersects its rarest lists, reads the rows they name and
verifies them, in key order, until it has enough.

*Client bitmaps.*  Clients are numbered, stored rows carry their client's number,
and each validity state has the set of its clients as bitmaps of 32,768 numbers.
A validity filter looks a row's bit up: the bitmaps (an eighth of a byte per
client) meet the detail by bucket, in a broadcast where Spark measures them small
enough, so the detail is not shuffled.

Everything is a table in the job's own folder, made and read by Spark.
"""

from __future__ import annotations

import zlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from collectra.functions.columns import existing, q

PART = "_parte"
ROW = "_fila"
CLIENT = "_cliente"
FILTER_BITS = 1 << 18  # per range and column: 32 kB when it is full
BUCKET_BITS = 32_768  # of one bitmap row
LIST_BUCKETS = 16  # folders that posting lists are dealt to
LISTS = 3  # rarest lists that a lookup intersects
RANGE_ROWS = 400_000  # of a range, where the number of rows is known: wide rows of one are sorted in memory
MANY = 1_000  # ranges that a plan names one by one; more are given as a table


def _starts(text: Column) -> Column:
    """Where the trigrams of a text begin; nowhere if it is null or shorter."""
    n = F.length(text)
    return F.when(n >= 3, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))


def term_trigrams(term: str) -> list[str]:
    return sorted({term[i:i + 3] for i in range(len(term) - 2)})


def ranges_for(rows: int) -> int:
    """Ranges that so many rows are stored in."""
    return max(1, -(-rows // RANGE_ROWS))


def write_ordered(df: DataFrame, path: str, order, parts: int | None = None) -> DataFrame:
    """``df`` under ``path/rows`` by ranges of ``order``, and ``path/order``; returns the stored rows."""
    keys = [q(c) for c in order]
    ranged = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    (ranged.withColumn(PART, F.spark_partition_id()).sortWithinPartitions(PART, *keys)
     .write.partitionBy(PART).option("compression", "snappy").parquet(f"{path}/rows"))
    rows = _read(df.sparkSession, path, df)
    last = F.max(F.struct(*keys)).alias("last")
    rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), last).coalesce(1).write.parquet(f"{path}/order")
    return rows


def _read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    schema = T.StructType([*like.schema.fields, T.StructField(PART, T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{path}/rows")


def order_index(spark: SparkSession, path: str) -> DataFrame:
    """(_parte, n, last): rows and last key of each range."""
    return spark.read.parquet(f"{path}/order")


def write_trigram_filters(rows: DataFrame, path: str, cols, alike=()) -> None:
    """One bit filter per range and column of its lower-cased trigrams, as rows of 32,768 bits.

    ``alike``: those of ``cols`` whose values many rows of a range repeat together (a
    loan's, in each row of its contacts); only the different ones are taken apart."""
    cols = existing(rows, cols)

    def values_of(some):
        each = F.array(*[F.struct(F.lit(c).alias("columna"), F.lower(q(c).cast("string")).alias("v")) for c in some])
        sets = rows.select(PART, *[q(c) for c in some]).distinct()
        return sets.select(PART, F.explode(each).alias("x")).select(PART, "x.columna", "x.v").where(F.length("v") >= 3)

    sides = [s for s in ([c for c in cols if c in alike], [c for c in cols if c not in alike]) if s]
    # a value that many rows of a range repeat is cut into trigrams once
    values = reduce(DataFrame.unionAll, map(values_of, sides)).distinct()
    # exploded by place, so the cutting is compiled; a bit that many values set is kept once
    starts = values.select(PART, "columna", "v", F.explode(_starts(F.col("v"))).alias("i"))
    at = starts.select(PART, "columna", place(F.substring("v", F.col("i"), F.lit(3))).alias("at")).distinct()
    bits = at.groupBy(PART, "columna", F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    bits.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/trigrams")


def place(trigram: Column) -> Column:
    """Place of a trigram in a filter, from 1 (as Spark numbers the bits of a bitmap)."""
    return F.pmod(F.crc32(trigram.cast("binary")), F.lit(FILTER_BITS)) + 1


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def folders(spark: SparkSession, path: str, column: str, values, schema) -> DataFrame:
    """Only the folders ``column=value`` of a table: the others are not even listed."""
    named = [f"{path}/{column}={v}" for v in sorted(set(values))]
    named = [p for p in named if _exists(spark, p)]
    if not named:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*named)


def parts_with(spark: SparkSession, path: str, term: str, cols) -> DataFrame | None:
    """(_parte) of the ranges that may hold ``term`` (lower-cased) in one of ``cols``; None: no trigram to ask for.

    A term that no range can hold gives no rows.
    """
    places = sorted({zlib.crc32(g.encode()) % FILTER_BITS + 1 for g in term_trigrams(term)})
    if not places:
        return None
    bucket = lambda p: (p - 1) // BUCKET_BITS + 1
    index = folders(spark, f"{path}/trigrams", "bucket", map(bucket, places), f"{PART} int, columna string, bits binary, bucket long")

    def has(p):
        bit = (p - 1) % BUCKET_BITS
        byte = F.conv(F.hex(F.substring(F.col("bits"), bit // 8 + 1, 1)), 16, 10).cast("int")
        return (F.col("bucket") == bucket(p)) & (F.coalesce(byte, F.lit(0)).bitwiseAND(F.lit(1 << bit % 8)) != 0)

    hits = F.sum(sum((F.when(has(p), 1).otherwise(0) for p in places), F.lit(0)))
    return index.where(F.col("columna").isin(*cols)).groupBy(PART, "columna").agg(hits.alias("h")).where(F.col("h") == len(places)).select(PART).distinct()


def rows_of(spark: SparkSession, path: str, schema: T.StructType, parts) -> DataFrame:
    """The stored rows of some ranges (a list of their numbers)."""
    return folders(spark, f"{path}/rows", PART, parts, schema)


def only_parts(rows: DataFrame, path: str, parts: DataFrame) -> DataFrame:
    """``rows`` of ``parts``: their folders alone are opened, unless there are very many."""
    some = [r[0] for r in parts.limit(MANY + 1).collect()]
    if len(some) > MANY:
        return rows.join(parts, PART, "left_semi")
    return rows_of(rows.sparkSession, path, rows.schema, some)


def write_postings(rows: DataFrame, path: str, texts: list[Column], order, keep) -> None:
    """``path/lookup``: the columns ``keep`` with their range and row number in key order;
    ``path/postings``: (gram, _parte, _fila) and ``path/lists``: (gram, n)."""
    w = Window.partitionBy(PART).orderBy(*[q(c) for c in order])  # a range: what one file holds
    kept = rows.select(PART, F.row_number().over(w).alias(ROW), *[q(c) for c in keep])
    kept.write.partitionBy(PART).parquet(f"{path}/lookup")
    kept = rows.sparkSession.read.schema(kept.schema).parquet(f"{path}/lookup")
    cut = kept.select(PART, ROW, *[t.alias(f"_{k}") for k, t in enumerate(texts)])

    def grams_of(k):
        """Trigrams of the text ``k`` of each row, where they first come in the row (compiled, unlike a set of each row's)."""
        at = cut.select(PART, ROW, *[f"_{j}" for j in range(k + 1)], F.explode(_starts(F.col(f"_{k}"))).alias("i"))
        at = at.withColumn("gram", F.substring(f"_{k}", F.col("i"), F.lit(3))).where(F.instr(F.col(f"_{k}"), F.col("gram")) == F.col("i"))
        for j in range(k):
            at = at.where(~F.coalesce(F.col(f"_{j}").contains(F.col("gram")), F.lit(False)))
        return at.select("gram", PART, ROW)

    post = reduce(DataFrame.unionAll, map(grams_of, range(len(texts)))).withColumn("bucket", _bucket(F.col("gram")))
    # a frequent trigram's list is dealt out by its ranges, so tasks grow with neither
    (post.repartition("bucket", PART).sortWithinPartitions("bucket", "gram", PART, ROW)
     .write.partitionBy("bucket").parquet(f"{path}/postings"))
    stored = _postings(rows.sparkSession, path)
    stored.groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("n")).repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/lists")


def _bucket(gram: Column) -> Column:
    return F.pmod(F.crc32(gram.cast("binary")), F.lit(LIST_BUCKETS)).cast("int")


def lookup_rows(spark: SparkSession, path: str, like: DataFrame, parts) -> DataFrame:
    """The rows of some ranges of a lookup, with their range and number; ``like`` has their columns."""
    schema = T.StructType([T.StructField(ROW, T.IntegerType()), *like.schema.fields, T.StructField(PART, T.IntegerType())])
    return folders(spark, f"{path}/lookup", PART, parts, schema)


POSTING = f"gram string, {PART} int, {ROW} int, bucket int"


def _postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POSTING).parquet(f"{path}/postings")


def candidates(spark: SparkSession, path: str, term: str) -> DataFrame | None:
    """(_parte, _fila) of the rows that may hold ``term``; None: no trigram to ask for."""
    grams = term_trigrams(term)
    if not grams:
        return None
    bucket = {g: zlib.crc32(g.encode()) % LIST_BUCKETS for g in grams}
    lists = folders(spark, f"{path}/lists", "bucket", bucket.values(), "gram string, n long, bucket int") \
        .where(F.col("gram").isin(grams)).collect()  # a number for each trigram of the term
    if len(lists) < len(grams):  # a trigram that no row has
        return spark.createDataFrame([], f"{PART} int, {ROW} int")
    rare = [r.gram for r in sorted(lists, key=lambda r: (r.n, r.gram))[:LISTS]]
    post = folders(spark, f"{path}/postings", "bucket", [bucket[g] for g in rare], POSTING).where(F.col("gram").isin(rare))
    return post.groupBy(PART, ROW).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(rare)).select(PART, ROW)


def client_numbers(portfolio: DataFrame, path: str) -> DataFrame:
    """(Cedula_Cliente, _cliente): the clients numbered from 0 in their order, written at ``path``."""
    spark = portfolio.sparkSession
    clients = portfolio.select("Cedula_Cliente").where(q("Cedula_Cliente").isNotNull()).distinct()
    (clients.repartitionByRange("Cedula_Cliente").sortWithinPartitions("Cedula_Cliente")
     .withColumn("mid", F.monotonically_increasing_id()).write.parquet(path))
    placed = spark.read.schema(clients.schema.add("mid", "long")).parquet(path)
    part = F.shiftright("mid", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # one row per written partition
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offset = sizes.select("part", F.coalesce(before, F.lit(0)).alias("first"))
    return placed.withColumn("part", part).join(offset, "part") \
        .select("Cedula_Cliente", (F.col("first") + F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))).alias(CLIENT))


def with_client(df: DataFrame, numbers: DataFrame) -> DataFrame:
    """``df`` with its client's number (null for an unknown client)."""
    return df.join(numbers, "Cedula_Cliente", "left")


def state_bitmaps(portfolio: DataFrame, numbers: DataFrame) -> DataFrame:
    """(Estado_Vigencia, bucket, bits): the clients that have a loan in each state."""
    held = portfolio.select("Cedula_Cliente", "Estado_Vigencia").distinct().join(numbers, "Cedula_Cliente")
    at = F.col(CLIENT) + 1  # Spark numbers the bits of bitmaps from 1
    return held.groupBy("Estado_Vigencia", F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))


def keep_states(df: DataFrame, bitmaps: DataFrame, states) -> DataFrame:
    """Rows whose client has a loan in one of ``states``; ``df`` has the clients' numbers."""
    some = bitmaps.where(q("Estado_Vigencia").isin(*states)).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    at = F.col(CLIENT) + 1
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    on = F.call_function("shiftright", byte, F.pmod(bit, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return df.join(some, F.bitmap_bucket_number(at) == F.col("bucket")).where(on).drop("bucket", "bits")

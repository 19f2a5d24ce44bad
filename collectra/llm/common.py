"""Helpers shared by the training-data operators."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import collectra
from collectra.session import delete_on_exit, shared_path

# words are maximal runs of anything but ASCII white space
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


# rows that Spark hands to Python at a time: whole texts may be long
ARROW_ROWS = 512


def ship(spark: SparkSession) -> None:
    """Prepare a session for this package's functions on the executors.

    The package is sent there once per application (on a cluster it need not be
    installed), and Arrow batches are kept to ``ARROW_ROWS`` rows, unless the
    cluster says otherwise: the memory of a Python worker is bounded by them.
    """
    app, rows = spark.sparkContext.applicationId, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(rows):
        spark.conf.set(rows, str(ARROW_ROWS))
    if app not in _shipped:
        home = Path(collectra.__file__).parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/collectra-{app}", "zip", home.parent, home.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table; from here on executors can import this package."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """Only the columns ``names`` (and ``new=old``), chosen by exact name.

    Works beside extra columns whose names differ only in case, which a plain
    ``select`` would call ambiguous.
    """
    want = {n: n for n in names} | renamed
    at = {c: i for i, c in reversed(list(enumerate(df.columns)))}
    missing = [old for old in want.values() if old not in at]
    if missing:
        raise ValueError(f"missing columns {missing}; got {df.columns}")
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_{at[old]}").alias(new) for new, old in want.items()])


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, whole ``text`` (null counts as empty) and ``more`` columns."""
    d = pick(docs, "doc_id", "text", *more)
    return d.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage there.

    The files outlive lost executors and go when the application ends.
    """
    path = shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def fold(col, parts: int, *held: int):
    """Is the row held out: crc32 of the id as text, modulo ``parts``, in ``held``.

    A null id is not held out.
    """
    return F.coalesce((F.crc32(F.col(col).cast("string").cast("binary")) % parts).isin(*held), F.lit(False))


def label_rows(labels: DataFrame, label: str, parts: int, *held: int) -> DataFrame:
    """(doc_id, label 0/1) to learn from: no held-out fold, null or unknown label.

    A document labelled more than once counts once, with the larger label.
    """
    rows = pick(labels, "doc_id", y=label).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
    return rows.where(~fold("doc_id", parts, *held)).groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))


def bounded_sample(rows: DataFrame, key: str, bound: int, count: int) -> DataFrame:
    """Rows whose key hash falls in a share that makes about ``bound`` of ``count``.

    All rows when there are no more than ``bound``; the same rows on every run.
    """
    if count <= bound:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 30))
                      < int(bound / count * (1 << 30)))


def let(value, body):
    """``body`` of a column that is evaluated once.

    A plain column that ``body`` uses inside a lambda is copied into it by the
    optimizer and evaluated for each element.
    """
    return F.transform(F.array(value), body)[0]


def sha256_text(col):
    return F.sha2((F.col(col) if isinstance(col, str) else col).cast("binary"), 256)

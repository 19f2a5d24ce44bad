"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, source mixing, BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept.  All but the last return the columns of ``documents``; the result of a
stage is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collectra.llm import bpe, line_dedup, mixing, simhash, toxicity
from collectra.llm.common import pick, ship, table, texts, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go.

    The others stay as they are: repeated rows, null ids, null and empty texts
    (which have no evidence).  Where the labels give the model no term to judge by,
    nothing goes; an empty table stays empty.
    """
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    if not model.vocabulary:
        return docs
    names = docs.columns
    d = docs.toDF(*[f"c{i}" for i in range(len(names))])
    score = toxicity.score_udf(spark, model)(F.col(f"c{names.index('text')}").cast("string"))["score"]
    return d.where(score < toxicity.THRESHOLD).toDF(*names)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines with an earlier line within one edit go; a document that loses all its words goes too.

    A document that loses nothing stays untouched, a null or blank text too;
    ``n_chars`` follows a changed text.
    """
    ship(spark)
    names = docs.columns
    d = line_dedup.dedup_lines(docs)
    d = d.toDF(*[f"c{i}" for i in range(len(names))], "n_lines", "n_equal", "n_near")
    cut = F.col("n_equal") + F.col("n_near") > 0
    text = F.col(f"c{names.index('text')}")
    d = d.where(~cut | (F.length(line_dedup.bare(text)) > 0))
    return d.select(*[F.when(cut, F.length(text)).otherwise(F.col(f"c{i}")).cast("long").alias(n) if n == "n_chars"
                      else F.col(f"c{i}").alias(n) for i, n in enumerate(names)])


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash, one row stays: that of the smallest id.

    Of rows that repeat this id the smallest one stays (text first, then the other
    columns).  A row without an id goes where a row with one is linked; of
    unidentified rows that only share a fingerprint among themselves the smallest
    stays.
    """
    ship(spark)
    classes = written(spark, simhash.near_duplicates(docs, shingle=3, max_bits=3), "classes")
    gone = written(spark, classes.where(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    names = docs.columns
    at, key = names.index("doc_id"), F.col(f"c{names.index('doc_id')}")
    columns = [f"c{i}" for i in range(len(names))]
    # the smallest row of a group is found inside the tasks first: a hot id sends one row per task
    order = F.struct(f"c{names.index('text')}", *[c for c in columns if c not in (f"c{at}", f"c{names.index('text')}")], f"c{at}")
    smallest = lambda d, by: d.groupBy(by).agg(F.min(order).alias("r")).select(*[f"r.{c}" for c in columns])
    d = docs.toDF(*columns)
    kept = d.where(key.isNotNull()).join(gone, key == F.col("gone_id"), "left_anti")
    repeated = written(spark, classes.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("again")), "repeated")
    if not repeated.isEmpty():
        again = F.col(f"c{at}") == F.col("again")
        kept = kept.join(repeated, again, "left_anti").unionByName(smallest(kept.join(repeated, again, "left_semi"), f"c{at}"))
    if not classes.where(F.col("doc_id").isNull()).isEmpty():
        linked = classes.where(F.col("component_id").isNotNull()).select("fp").distinct()
        nameless = simhash.with_fingerprint(d.where(key.isNull()), f"c{names.index('text')}", 3).join(linked, "fp", "left_anti")
        kept = kept.unionByName(smallest(nameless, "fp"))
    return kept.toDF(*names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes words of a document, with exactly those words.

    Documents without words are not taken; equal rows share what the mix takes of
    them; a null source is a source of its own; null ids stay null.
    """
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and the digest of the text that they decode to; a null text is empty and has no ids."""
    ship(spark)
    return bpe.encode(texts(docs, "source"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", one_of_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# nearest neighbours, hashed permutations and byte-pair merges have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text", "lang", "source", "n_chars")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

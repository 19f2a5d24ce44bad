"""Token counts by a two-tier lookup of pre-token lengths.

Spaces become the mark U+2581 and one mark leads the text, as the model does.
No piece of the vocabulary holds a mark behind another character, so no merge
crosses the place where a mark follows something else: the text is cut there
into pre-tokens, and the count of a text is the sum of theirs.

First tier: a compact table of the most frequent pre-tokens and their lengths,
broadcast to all workers.  It is made from all texts: each task counts its
pre-tokens in a bounded table and passes on its ``TASK_TOP`` most frequent, the
``TABLE_ENTRIES`` largest sums stay.  Which ones stay changes the speed only.
Second tier: a pre-token that is not in the table is encoded by the library and
kept in the worker's bounded cache.  The pre-tokens of a text never leave the
task that reads it.

Edge cases: a null text counts as an empty one, with 0 tokens.  Strings of
special tokens are ordinary text, as is the library's default.  Each row gives
one row; extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collectra.llm.common import texts

MARK = "▁"
PRE_TOKEN = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
TABLE_ENTRIES = 65_536
TASK_TOP = 2_048
TASK_ENTRIES = 100_000
CACHE_ENTRIES = 400_000
CACHE_CHARS = 64

_loaded: dict = {}  # one lookup per worker process and model


def pre_tokens(text: str) -> list[str]:
    return PRE_TOKEN.findall(MARK + text.replace(" ", MARK)) if text else []


class Lengths(dict):
    """Pre-token to token count; missing ones are encoded and kept."""

    def __init__(self, model: bytes, frequent: dict[str, int]):
        from sentencepiece import SentencePieceProcessor

        super().__init__()
        self.lib = SentencePieceProcessor(model_proto=model)
        pieces = map(self.lib.id_to_piece, range(self.lib.get_piece_size()))
        if any(MARK in p.lstrip(MARK) for p in pieces) or self.lib.encode("a  b", out_type=str)[0] != MARK + "a":
            raise ValueError("pre-tokens of this model do not end where a space follows")
        self.frequent = frequent

    def __missing__(self, pre: str) -> int:
        n = self.frequent.get(pre)
        if n is None:  # the library puts the first mark itself, but for an empty text
            n = len(self.lib.encode(pre[1:], num_threads=1)) if len(pre) > 1 else 1
        if len(pre) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[pre] = n
        return n

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, pre_tokens(text)))


def frequent_pre_tokens(docs: DataFrame) -> DataFrame:
    """(pre, n): the largest sums of what the tasks found frequent, at most ``TABLE_ENTRIES``."""

    def count(batches):
        seen = Counter()
        for b in batches:
            for i in range(0, b.num_rows, 256):
                for t in b.column(0).slice(i, 256).to_pylist():
                    seen.update(pre_tokens(t))
                if len(seen) > 2 * TASK_ENTRIES:
                    seen = Counter(dict(seen.most_common(TASK_ENTRIES)))
        top = [(p, n) for p, n in seen.most_common(TASK_TOP) if len(p) <= CACHE_CHARS]
        yield pa.record_batch([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["pre", "n"])

    return (texts(docs).select("text").mapInArrow(count, "pre string, n long")
            .groupBy("pre").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pre").limit(TABLE_ENTRIES))


def count_udf(spark: SparkSession, docs: DataFrame, path: str):
    """A function of a text column that gives its number of tokens.

    The model (0.5 MB) and the table (``TABLE_ENTRIES`` short strings) are broadcast.
    """
    with open(path, "rb") as f:
        model = f.read()
    lib = Lengths(model, {})
    table = [r.pre for r in frequent_pre_tokens(docs).collect()]
    # at most CACHE_CHARS characters of at most 4 bytes each: lengths fit 16 bits
    name = uuid.uuid4().hex
    sent = spark.sparkContext.broadcast((model, table, np.array([lib[p] for p in table], dtype=np.uint16)))

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        if _loaded.get("name") != name:
            model, table, n = sent.value
            _loaded.update(name=name, lengths=Lengths(model, dict(zip(table, n.tolist(), strict=True))))
        return pd.Series([_loaded["lengths"].count(t or "") for t in texts], dtype="int64")

    return count


def token_counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) for every row."""
    d = texts(docs)
    n = count_udf(docs.sparkSession, docs, path)
    return (d.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), n("text").alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))

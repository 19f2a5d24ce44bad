"""Byte-level BPE encoding and decoding with forced-boundary splitting.

A merge can only join bytes that stand side by side inside some token of the
vocabulary.  So between two bytes that never do, every encoding has a token
boundary: the fragments between such forced boundaries encode independently
and their ids concatenate to the ids of the whole.  Added tokens are cut out
first and the tokenizer's own pre-tokenizer splits the rest, as in the library;
each pre-token is then cut at its forced boundaries and its fragments go
through the library's BPE model.  Pre-tokens repeat, so a worker keeps the ids
of those it has met (a bounded cache; long ones are not kept).

A long run without white space is the case the cuts are for: the work of the
model's merges is bounded by the fragment, not by the text.

Edge cases: a null text encodes as an empty one, to no ids.  Every row gives
one row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CACHE_ENTRIES = 250_000
CACHE_CHARS = 64

# fixed value: the split of byte-level vocabularies
PLAIN_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
BEYOND_PLAIN = re.compile("[\u0250-\U0010ffff]")

_loaded: dict = {}  # one codec per worker process and vocabulary


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


class _Kept(dict):
    """Pre-token to its ids; what is missing is made and, if short, kept."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        ids = self.make(piece)
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = ids
        return ids


class ForcedBoundaryBPE:
    def __init__(self, spec: str):
        """``spec``: the JSON text of a byte-level BPE tokenizer."""
        from tokenizers import Tokenizer, pre_tokenizers

        j = json.loads(spec)
        model, pre = j["model"], j["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or j["normalizer"] or j["post_processor"]:
            raise ValueError("a byte-level BPE without normalizer and post-processor is needed")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in j["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.model = Tokenizer.from_str(json.dumps(j | {"added_tokens": [], "pre_tokenizer": None, "decoder": None,
                                                        "truncation": None, "padding": None})).model
        self.pre = pre_tokenizers.ByteLevel(add_prefix_space=pre["add_prefix_space"], use_regex=pre["use_regex"])
        self.added = {t["content"]: t["id"] for t in j["added_tokens"]}
        self.added_re = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") \
            if self.added else None
        alphabet = byte_alphabet()
        self.stand_in = dict(enumerate(alphabet))
        byte_of = {c: b for b, c in enumerate(alphabet)}
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in model["vocab"].items()}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        # pairs of (stand-ins of) bytes that some token holds side by side
        self.inside = {t[i:i + 2] for t in model["vocab"] for i in range(len(t) - 1)}
        self.kept = _Kept(self.piece_ids)
        # the library's split, by a pattern, for texts of characters whose classes
        # are the same in both (tested over the whole range); others go to the library
        self.plain = pre["use_regex"] and not pre["add_prefix_space"]

    def fragments(self, piece: str) -> list[str]:
        """``piece`` (in stand-ins) cut at its forced boundaries."""
        cuts = [0, *[i for i in range(1, len(piece)) if piece[i - 1:i + 1] not in self.inside], len(piece)]
        return [piece[i:j] for i, j in zip(cuts, cuts[1:])]

    def piece_ids(self, piece: str) -> bytes:
        """Ids of a pre-token (raw text): those of its fragments, one after the other."""
        raw = piece.encode().decode("latin-1").translate(self.stand_in)
        return array("I", [t.id for f in self.fragments(raw) for t in self.model.tokenize(f)]).tobytes()

    def pre_tokens(self, text: str) -> list[str]:
        if self.plain and not BEYOND_PLAIN.search(text):
            return PLAIN_SPLIT.findall(text)
        return [text[i:j] for _, (i, j) in self.pre.pre_tokenize_str(text)]

    def encode(self, text: str) -> np.ndarray:
        out = []
        for i, part in enumerate(self.added_re.split(text) if self.added_re else [text]):
            if i % 2:
                out.append(np.array([self.added[part]], dtype="<u4").tobytes())
            elif part:
                out.extend(map(self.kept.__getitem__, self.pre_tokens(part)))
        return np.frombuffer(b"".join(out), dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _codec(spec) -> ForcedBoundaryBPE:
    key = hash(spec.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ForcedBoundaryBPE(spec.value)
    return _loaded[key]


def read_spec(path: str):
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(df: DataFrame, path: str, text: str = "text", with_ids: bool = False) -> DataFrame:
    """``df`` without its text column; added: n_tokens, ids_sha256 (of the ids as
    little-endian 32-bit integers), decoded_sha256 (of the text decoded from them,
    in UTF-8) and, if asked for, ids.

    The vocabulary file (1.5 MB) is read by the driver and broadcast.  Texts become
    Python objects a few at a time, and results leave as they are made.
    """
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))
    keep = [c for c in df.columns if c != text]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != text]
    names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]

    def run(batches):
        codec = _codec(spec)
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                n, ids_sha, text_sha, all_ids = [], [], [], []
                for t in part.column(len(keep)).to_pylist():
                    ids = codec.encode(t or "")
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    text_sha.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
                    all_ids.append(ids)
                cols = [*part.columns[:-1], pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
                if with_ids:
                    ends = pa.array(np.cumsum([0, *n]), pa.int32())
                    cols.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(all_ids).astype(np.int32))))
                yield pa.record_batch(cols, names=names)

    made = ["n_tokens long", "ids_sha256 string", "decoded_sha256 string", *(["ids array<int>"] if with_ids else [])]
    return df.select(*[F.col(f"`{c}`") for c in [*keep, text]]).mapInArrow(run, ", ".join([*kinds, *made]))


def decode_udf(spark: SparkSession, path: str):
    """A function of an ids column (array<int>); gives the text. Null ids give null."""
    spec = spark.sparkContext.broadcast(read_spec(path))

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        codec = _codec(spec)
        return pd.Series([None if x is None else codec.decode(np.asarray(x, dtype=np.int64)) for x in ids], dtype=object)

    return decode

import hashlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from samples import SF, rows
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from collectra.llm import bpe, queries, token_counts
from collectra.llm.common import texts

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a  b ", "a" * 5000, "x\n\n\t y", "don't we'll I'M", "▁ a▁b ▁▁", " " * 100, "a　b c", "ﬁ ① ½", "\U0001f469‍\U0001f467",
       "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "0123456789" * 30, "你好" * 300]


def digests(lib, text):
    ids = lib.encode(text, add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_bpe_equals_the_library(texts_of):
    lib, own = Tokenizer.from_file(BPE), bpe.ForcedBoundaryBPE(bpe.read_spec(BPE))
    for t in [*texts_of.values(), *ODD, *[r[1] or "" for r in rows()]]:
        ids = own.encode(t)
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids
        assert own.decode(ids) == t


def test_plain_split_equals_the_library():
    own = bpe.ForcedBoundaryBPE(bpe.read_spec(BPE))
    for c in map(chr, range(0x250)):
        for form in ("a{}b", "1{}2", " {}!", "  {}  {} x", "{}'ll", "{}"):
            t = form.format(c, c)
            assert own.pre_tokens(t) == [t[i:j] for _, (i, j) in own.pre.pre_tokenize_str(t)], t


def test_forced_boundaries_are_cuts():
    own = bpe.ForcedBoundaryBPE(bpe.read_spec(BPE))
    piece = "qzxjqvwzx" * 50
    parts = own.fragments(piece)
    assert "".join(parts) == piece and len(parts) > 1
    assert all(p[i:i + 2] in own.inside for p in parts for i in range(len(p) - 1))


def test_bpe_rows_and_edges(spark, odd, empty):
    lib = Tokenizer.from_file(BPE)
    for docs, n in ((odd, len(rows())), (empty, 0)):
        got = bpe.encode(texts(docs).withColumn("own", F.col("text")), BPE, with_ids=True).collect()
        assert len(got) == n
        for r in got:
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(lib, r.own) and len(r.ids) == r.n_tokens
    back = bpe.encode(texts(odd).withColumn("own", F.col("text")), BPE, with_ids=True).withColumn("back", bpe.decode_udf(spark, BPE)("ids"))
    assert back.where(~F.col("back").eqNullSafe(F.col("own"))).count() == 0


def test_op3_query(spark, texts_of):
    lib = Tokenizer.from_file(BPE)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op3_bpe(spark, SF).collect()}
    assert got == {i: digests(lib, t or "") for i, t in texts_of.items()}


def test_token_counts_equal_the_library(texts_of):
    lib = SentencePieceProcessor(model_file=PIECES)
    own = token_counts.Lengths(Path(PIECES).read_bytes(), {})
    for t in [*texts_of.values(), *ODD, *[r[1] or "" for r in rows()]]:
        assert own.count(t) == len(lib.encode(t)), t[:80]


@pytest.mark.parametrize("entries", [token_counts.CACHE_ENTRIES, 3])
def test_full_cache_changes_nothing(monkeypatch, texts_of, entries):
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", entries)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", entries)
    own, lib = token_counts.Lengths(Path(PIECES).read_bytes(), {"▁the": 1}), SentencePieceProcessor(model_file=PIECES)
    b, blib = bpe.ForcedBoundaryBPE(bpe.read_spec(BPE)), Tokenizer.from_file(BPE)
    for t in list(texts_of.values())[:20]:
        assert own.count(t) == len(lib.encode(t)) and b.encode(t).tolist() == blib.encode(t).ids


def test_op5_query_and_edges(spark, odd, empty, texts_of):
    lib = SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op5_token_counts(spark, SF).collect()}
    want = {i: (len((t or "").encode()), len(lib.encode(t or ""))) for i, t in texts_of.items()}
    assert got == {i: (b, n, n > 4096) for i, (b, n) in want.items()}
    got = sorted((r.n_bytes, r.n_tokens) for r in token_counts.token_counts(odd, PIECES).collect())
    assert got == sorted((len((r[1] or "").encode()), len(lib.encode(r[1] or ""))) for r in rows())
    assert token_counts.token_counts(empty, PIECES).count() == 0

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from samples import SF
from test_dedup import brute_components, brute_fingerprint, brute_lines
from tokenizers import Tokenizer

import corpus_pipeline as p
from collectra.llm import line_dedup, mixing
from collectra.llm.common import WORD, pick, table, written

BIG = "/root/testdata/sf0.01"  # enough labels to learn from
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark):
    """Every stage on what its predecessor kept; the toxicity model itself is tested apart."""
    docs = pick(table(spark, BIG, "documents"), *COLUMNS)
    kept = [docs]
    for name, stage in p.STAGES[:-1]:
        kept.append(written(spark, stage(spark, kept[-1], BIG), name))
        assert kept[-1].columns == COLUMNS
    text = [{r.doc_id: r.text for r in d.collect()} for d in kept[:4]]
    assert len(text[1]) < len(text[0]) and all(text[0][i] == t for i, t in text[1].items())
    toxic = {i for i, y in zip(*pq.read_table(f"{BIG}/labels.parquet").select(["doc_id", "toxic"]).to_pydict().values()) if y == 1}
    # documents labelled toxic that hold a word that only such documents hold (some labels fit no word)
    insult = re.compile("idiot|clown|moron|trash|scum|worthless|pathetic|loser|disgusting|stupid")
    plain = {i for i in toxic if i in text[0] and insult.search(text[0][i].lower())}
    assert len(plain) > 30 and len(plain & set(text[1])) <= 0.1 * len(plain) and len(set(text[0]) - set(text[1]) - toxic) < 0.02 * len(text[0]) + len(toxic)
    clean = {i for i, y in zip(*pq.read_table(f"{BIG}/labels.parquet").select(["doc_id", "toxic"]).to_pydict().values()) if y == 0} & set(text[0])
    assert len(clean & set(text[1])) >= 0.98 * len(clean)

    lines = brute_lines(text[1], line_dedup.MIN_CHARS)
    assert text[2] == {i: t for i, (e, n, t) in lines.items() if not e + n or t.strip(" \t\n\x0b\x0c\r")}

    roots = brute_components({i: brute_fingerprint(t) for i, t in text[2].items()}, 3)
    assert text[3] == {i: t for i, t in text[2].items() if roots[i] == i}

    mixed = kept[4].collect()
    words, source = Counter(), defaultdict(int)
    for r in mixed:
        n = len(re.findall(WORD, r.text))
        words[r.doc_id] += n
        source[r.source] += n
        assert r.n_chars == len(r.text) and set(re.findall(WORD, r.text)) <= set(re.findall(WORD, text[3][r.doc_id]))
    assert words == Counter({r.doc_id: r.taken for r in mixing.taken_words(kept[3]).collect() if r.taken})

    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in mixed:
        ids = lib.encode(r.text, add_special_tokens=False).ids
        want[(r.doc_id, r.source, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest(), tuple(ids))] += 1
    got = Counter((r.doc_id, r.source, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in p.STAGES[-1][1](spark, kept[4], BIG).collect())
    assert got == want


def test_run_and_edges(spark, odd, empty):
    assert p.run(spark, SF).columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    for docs in (odd, empty):
        for name, stage in p.STAGES:
            docs = written(spark, _plain(stage(spark, docs, SF)), f"edge-{name}")
    assert docs.count() == 0


def _plain(df):
    """Parquet takes no two names that differ in case only."""
    return pick(df, *[c for c in df.columns if c != "Text"])


def test_one_row_of_each_group_of_near_copies(spark):
    """Null ids, repeated ids, and rows without an id that only meet each other."""
    a, b, c = "one two three four five", "six seven eight nine ten", "an other text of no kin"
    rows = [(1, a, "en", "s", 1), (1, a, "en", "s", 1), (1, a + " x", "en", "s", 0), (2, a, "en", "s", 2), (None, a, "en", "s", 3), (None, a, "fr", "s", 3),
            (None, b, "en", "t", 5), (None, b, "de", "t", 4), (None, c, "en", "t", 6), (3, c + " d", "en", "t", 7), (7, None, "en", "u", 0), (8, "", "en", "u", 0), (None, " ", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for n in (1, 4):
        got = sorted(map(tuple, p.one_of_near_copies(spark, df.repartition(n), SF).collect()), key=str)
        assert got == sorted([(1, a, "en", "s", 1), (None, b, "de", "t", 4), (None, c, "en", "t", 6), (3, c + " d", "en", "t", 7), (7, None, "en", "u", 0)], key=str)


def test_few_labels_without_a_word_to_judge_by_drop_nothing(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i} text{i}", "en", "s", 9) for i in range(60)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert p.drop_toxic(spark, docs, str(tmp_path)).count() == 60


def test_fifty_labels_told_apart_by_two_words_are_enough(spark, tmp_path):
    import random
    rng = random.Random(1)
    text = lambda i: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma", "theta"]) for _ in range(30)) + (f" {rng.choice(['rotten', 'wretch'])}" if i % 2 else "")
    docs = spark.createDataFrame([(i, text(i), "en", "s", 9) for i in range(200)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, 1, i % 2) for i in range(66)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = [r.doc_id for r in p.drop_toxic(spark, docs, str(tmp_path)).collect()]
    assert sorted(kept) == list(range(0, 200, 2))


def test_registered(spark):
    import __spark_entry__ as e
    names = [k for k in e.queries() if re.match(r"op\d+_|pipeline$", k)]
    assert sorted(int(re.findall(r"\d+", n)[0]) for n in names if n != "pipeline") == list(range(1, 14)) and "pipeline" in names
    assert {"op9_exact_dedup", "op11_phrases", "op12_merkle", "op13_topk"} <= set(e.oracle_sql()) and "pipeline" not in e.oracle_sql()

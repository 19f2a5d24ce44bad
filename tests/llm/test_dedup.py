import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F
from samples import SF, rows

from collectra.llm import components, exact_dedup, line_dedup, queries, simhash
from collectra.llm.exact_dedup import CountingQuotientFilter


# --- exact dedup --------------------------------------------------------------

def test_filter_round_trip_and_merge():
    rng = np.random.default_rng(1)
    parts = [np.unique(rng.integers(0, 1 << 58, 5000, dtype=np.uint64) % np.uint64(20_000) << np.uint64(40), return_counts=True) for _ in range(4)]
    filters = [CountingQuotientFilter.from_bytes(CountingQuotientFilter(10, 48, f, c).to_bytes()) for f, c in parts]
    for (f, c), g in zip(parts, filters):
        assert np.array_equal(g.entries()[0], f) and np.array_equal(g.entries()[1], c)
    fps, counts = CountingQuotientFilter.merge(filters).entries()
    want = defaultdict(int)
    for f, c in parts:
        for x, n in zip(f.tolist(), c.tolist()):
            want[x] += n
    assert dict(zip(fps.tolist(), counts.tolist())) == want and (np.diff(fps.astype(object)) > 0).all()
    none = CountingQuotientFilter(3, 20, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert len(CountingQuotientFilter.from_bytes(none.to_bytes()).entries()[0]) == 0


def test_repeated_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "RANGE_ENTRIES", 500)  # many filters of a range in one task
    random.seed(2)
    values = [random.choice((random.getrandbits(64) - (1 << 63), 7, -7, random.randrange(200))) for _ in range(8000)]
    got = exact_dedup.repeated_fingerprints(spark.createDataFrame([(v,) for v in values], "fp long").repartition(5), len(values))
    count = defaultdict(int)
    for v in values:
        count[v] += 1
    assert {r.fp: r.n for r in got.collect()} == {v: n for v, n in count.items() if n > 1}


def test_exact_groups_edges(odd, empty):
    got = exact_dedup.exact_groups(odd).collect()
    by = defaultdict(list)
    for r in rows():
        by[r[1] or ""].append(r[0])
    assert len(got) == len(rows()) and exact_dedup.exact_groups(empty).count() == 0
    for r in got:
        text = next(t for t in by if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert r.group_size == len(by[text]) and r.keep_id == max(i for i in by[text] if i is not None)
        assert r.kept == (r.doc_id == r.keep_id)


# --- line dedup ----------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute_lines(docs, least):
    """doc_id to (lines, equal, near, text) by comparing every line with every earlier one."""
    bare = lambda x: x.strip(" \t\n\x0b\x0c\r")
    first = {}
    for i in sorted(docs):
        for k, line in enumerate((docs[i] or "").split("\n")):
            if len(bare(line)) >= least:
                first.setdefault(bare(line), (i, k))
    near = {x for x in first if any(first[y] < first[x] and one_edit(x, y) for y in first if y != x)}
    out = {}
    for i, t in docs.items():
        kept, equal, close = [], 0, 0
        for k, line in enumerate((t or "").split("\n")):
            b = bare(line)
            if b in near:
                close += 1
            elif b in first and first[b] != (i, k):
                equal += 1
            else:
                kept.append(line)
        out[i] = (equal, close, "\n".join(kept))
    return out


def test_line_dedup_against_brute_force(spark):
    random.seed(3)
    base = ["".join(random.choice("abcé \U0001f600") for _ in range(random.randrange(1, 14))) for _ in range(60)]

    def edit(x):
        i, kind = random.randrange(len(x) + 1), random.randrange(4)
        return x[:i] + ("" if kind == 0 else random.choice("abcé")) + x[i + (kind < 2):] if kind < 3 else x

    docs = {i: "\n".join(random.choice((edit(x), x, " " + x, edit(edit(x)))) for x in random.choices(base, k=8)) for i in range(60)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    want = brute_lines(docs, 4)
    assert sum(w[1] for w in want.values()) > 50
    got = {r.doc_id: (r.n_equal, r.n_near, r.text) for r in line_dedup.dedup_lines(df, min_chars=4).collect()}
    assert got == want


def test_variants_meet_exactly_at_one_edit():
    seen = {}
    for x in ("abcd", "abxd", "abd", "abccd", "dcba"):
        v, pos = line_dedup.variant_rows(x)
        seen[x] = set(zip(v.tolist(), pos.tolist()))
    same = lambda a, b: bool(seen[a] & seen[b])
    whole = lambda x: next(v for v, p in seen[x] if p < 0)
    assert same("abcd", "abxd") and not same("abcd", "dcba")
    assert whole("abd") in {v for v, _ in seen["abcd"]} and whole("abcd") in {v for v, _ in seen["abccd"]}
    assert whole("abd") not in {v for v, _ in seen["abccd"]}


def test_line_dedup_edges(odd, empty):
    got = line_dedup.dedup_lines(odd)
    assert got.columns[: len(odd.columns)] == odd.columns and line_dedup.dedup_lines(empty).count() == 0
    out = [tuple(r) for r in got.collect()]
    assert len(out) == len(rows())
    by = defaultdict(list)
    for r in out:
        by[r[0]].append(r)
    assert by[1][0][1] == rows()[0][1]  # the earliest place stays
    assert by[2][0][1] == "" and by[2][0][-2] == 2 and by[None][0][-2] == 2
    assert by[7][0][1] == "" and (by[7][0][-2], by[7][0][-1]) == (1, 1)
    assert by[3][0][1] is None and by[4][0][1] == "" and len(by[8]) == 2 and by[8][0][1] == by[8][1][1] == rows()[7][1]


def test_op8_query(spark, texts_of):
    want = brute_lines(texts_of, line_dedup.MIN_CHARS)
    got = {r.doc_id: (r.n_equal, r.n_near, r.text_sha256) for r in queries.op8_line_dedup(spark, SF).collect()}
    assert got == {i: (e, n, hashlib.sha256(t.encode()).hexdigest()) for i, (e, n, t) in want.items()}


# --- SimHash ---------------------------------------------------------------------

def brute_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(fps, bits):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprints_equal_the_definition(texts_of):
    for t in [*list(texts_of.values())[:60], *[r[1] for r in rows() if r[0] != 6], "one", "one two", "É É É É", "A a A a"]:
        assert simhash.fingerprint((t or "").encode(), 3) == brute_fingerprint(t)


def test_links_against_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    fps = []
    for _ in range(40):  # clusters of every tightness, one of them large
        centre = rng.getrandbits(64)
        for _ in range(rng.choice((1, 2, 5, 40))):
            x = centre
            for b in rng.sample(range(64), rng.randrange(0, 6)):
                x ^= 1 << b
            fps.append(x)
    fps = {i: x for i, x in enumerate(dict.fromkeys(fps))}
    reps = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in fps.items()], "id long, fp long").repartition(3)
    for bits in (0, 1, 3, 4):
        want = brute_components(fps, bits)
        for chunk in (4096, 8):  # with and without split top nodes
            monkeypatch.setattr(simhash, "CHUNK", chunk)
            got = {r.node: r.root for r in components.components(simhash.links(reps, bits)).collect()}
            assert {i: got.get(i, i) for i in fps} == want


def test_gray_index_prunes_nothing_it_should_not():
    rng = np.random.default_rng(7)
    fps = np.unique(np.r_[rng.integers(0, 1 << 20, 300, dtype=np.uint64), rng.integers(0, 1 << 63, 300, dtype=np.uint64)])
    ids = rng.permutation(len(fps)).astype(np.int64)
    zero = np.zeros(len(fps), np.int64)
    u, v, _ = simhash.forest_edges(fps, ids, zero, zero, 3)
    want = brute_components(dict(zip(ids.tolist(), fps.tolist())), 3)
    assert len(u) == len(fps) - len(set(want.values())) and all(want[a] == want[b] for a, b in zip(u.tolist(), v.tolist()))
    ranks = simhash.gray_rank(fps)
    assert np.array_equal(ranks ^ (ranks >> np.uint64(1)), fps)


def test_gray_index_of_many_top_nodes(monkeypatch):
    """Groups of every size in one index: all links within a group and between its two sides, none across groups; most pairs are never visited."""
    rng = np.random.default_rng(6)
    fps, group, side = [], [], []
    for g, n in enumerate([1, 2, 3, 7, 8, 9, 64, 65, 700]):
        base = rng.integers(0, 1 << 63, max(1, n // 4)).astype(np.uint64)
        x = base[rng.integers(0, len(base), n)]
        for _ in range(4):
            x ^= (rng.random(n) < 0.5).astype(np.uint64) << rng.integers(0, 64, n).astype(np.uint64)
        fps.append(x)
        group += [g] * n
        side += ([0] * n if g % 2 else rng.integers(1, 3, n).tolist())
    fps, group, side = np.concatenate(fps), np.array(group), np.array(side)
    ids = rng.permutation(10_000)[:len(fps)]
    u, v, visits = simhash.forest_edges(fps, ids, group, side, 3)
    near = (np.bitwise_count(fps[:, None] ^ fps[None]) <= 3) & (group[:, None] == group[None]) & ((side[:, None] != side[None]) | (side[:, None] == 0))
    up = {int(i): int(i) for i in ids}
    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in zip(*np.nonzero(near)):
        x, y = sorted((root(int(ids[a])), root(int(ids[b]))))
        up[y] = x
    found = {int(i): int(i) for i in ids}
    for a, b in zip(u.tolist(), v.tolist()):
        assert a < b
        found[b] = a
    assert all(found[i] == root(i) for i in up)
    assert len(fps) < visits < 0.3 * 700 ** 2


def test_query_goes_through_the_gray_index(spark, monkeypatch):
    """The rows that the query's tasks hold on sf0.01 are all visited in the index."""
    from collections import defaultdict
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.fp, r.doc_id) for r in simhash.near_duplicates(d).collect()]
    reps = {fp: min(i for f, i in rows if f == fp) for fp in {f for f, _ in rows}}
    fps, ids = np.array(list(reps), dtype=np.int64).view(np.uint64), np.array(list(reps.values()))
    top = defaultdict(list)
    for m in simhash.block_masks(3):
        for i, f in enumerate(fps.tolist()):
            top[m, f & m].append(i)
    at = np.concatenate([np.array(x) for x in top.values()])
    group = np.repeat(np.arange(len(top)), [len(x) for x in top.values()])
    _, _, visits = simhash.forest_edges(fps[at], ids[at], group, np.zeros(len(at), np.int64), 3)
    assert visits >= len(at)


def test_components_of_a_long_path_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(130, 200), (129, 200), (300, 301)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long").repartition(3)).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 130: 100, 200: 100, 300: 300, 301: 300}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_edges(odd, empty):
    got = simhash.near_duplicates(odd).collect()
    want = brute_components({r[0]: brute_fingerprint(r[1]) for r in rows() if r[0] is not None}, 3)
    assert len(got) == len(rows()) and simhash.near_duplicates(empty).count() == 0
    for r in got:
        assert r.component_id == want[1 if r.doc_id is None else r.doc_id]
    assert want[3] == want[4] == want[5] == 3


def test_op10_query(spark, texts_of):
    fps = {i: brute_fingerprint(t) for i, t in texts_of.items()}
    want = brute_components(fps, 3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op10_simhash(spark, SF).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}


def test_one_document_of_each_group_stays(spark, odd):
    import corpus_pipeline as p
    kept = p.one_of_near_copies(spark, odd, SF)
    assert kept.columns == odd.columns
    ids = [r[0] for r in kept.select(F.col("doc_id")).collect()]  # the row without an id is linked to one that has one
    roots = brute_components({r[0]: brute_fingerprint(r[1]) for r in rows() if r[0] is not None}, 3)
    assert None not in ids and sorted(ids) == sorted(i for i, c in roots.items() if i == c)


def test_lines_of_rows_without_an_id_and_of_a_repeated_id(spark):
    """Each text without an id is a document of its own; rows of one id are one document."""
    same, other = "this line stands in each of the texts", "a second line that all of them hold, too"
    docs = [(None, f"{same}\nfirst of the texts without an id {i} {i * 7919}") for i in range(3)] + [(None, f"{other}\n{same}")] * 2 + [(9, other), (9, other), (9, f"{other} and more of it")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.text) for r in line_dedup.dedup_lines(df).collect()]
    text = [t for _, t in got]
    # one text without an id keeps the line (both rows of it, if it is the repeated one)
    holders = {t for i, t in got if same in t.split("\n")}
    assert len(got) == 8 and len(holders) == 1
    assert sum(t.startswith("first of") or "\nfirst of" in t for t in text) == 3  # own lines stay
    assert sorted(t for i, t in got if i == 9) == sorted([other, other, f"{other} and more of it"])
    assert not any(other in t.split("\n") for i, t in got if i is None)


def test_very_long_lines_with_a_neighbour(spark):
    rng = np.random.default_rng(2)
    line = "".join(rng.choice(list("abcdefgh "), 30_000))
    near = line[:15_000] + "#" + line[15_001:]
    df = spark.createDataFrame([(1, line), (2, near), (3, line[:-1]), (4, line[::-1])], "doc_id long, text string")
    got = {r.doc_id: (r.n_near, len(r.text)) for r in line_dedup.dedup_lines(df).collect()}
    assert line.strip() == line and got == {1: (0, 30_000), 2: (1, 0), 3: (1, 0), 4: (0, 30_000)}

import zlib
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from samples import rows

from collectra.llm import merkle as M
from collectra.llm import queries

SMALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """Root and, per leaf, (before, after) siblings level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            a = at[i] // 16 * 16
            p.append(("".join(nodes[a:at[i]]), "".join(nodes[at[i] + 1:a + 16])))
            at[i] //= 16
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(docs):
    """docs: (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in docs:
        by.setdefault(r[1], []).append((r[0], leaf(r), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in by[s]])
    if not by:
        return []
    root, over = tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, over):
        for (i, own, r), path in zip(by[s], trees[s][1]):
            path = path + top
            node = own
            if i is not None and zlib.crc32(str(i).encode()) % 5 == 0:
                node = leaf(r[:4] + (None if r[4] is None else r[4].translate(SMALL),))
            for a, b in path:
                node = h(a, node, b)
            out.append((i, own, trees[s][0], root, h(*[x for p in path for x in p]), node, node == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
TABLE = "doc_id long, source string, lang string, n_chars long, text string"


def run(df):
    return sorted((tuple(r) for r in M.manifest(df).select(*COLUMNS).collect()), key=str)


def test_odd_rows(odd):
    want = brute([(r[0], r[3], r[2], r[4], r[1]) for r in rows()])
    assert run(odd) == want


@pytest.mark.parametrize("sizes", [[1], [2, 1], [16, 17], [256, 257, 1, 255], [5000, 300, 16]])
def test_sizes_around_runs_and_blocks(spark, sizes):
    docs = [(int(i), ["a", None, "b", ""][g], "en", 5, f"Text {i % 7}") for g, n in enumerate(sizes) for i in np.random.default_rng(g).permutation(n)]
    got = run(spark.createDataFrame(docs, TABLE).repartition(5))
    assert got == brute(docs) and (len(docs) < 500 or {r[-1] for r in got} == {True, False})


def test_many_sources_and_one_id_for_a_third_of_the_rows(spark):
    docs = [(i, f"s{i}é", None, None, "A") for i in range(700)] + [(7, "hot", "x", i % 3, "B") for i in range(600)] + [(None, "hot", None, None, "C")] * 40
    assert run(spark.createDataFrame(docs, TABLE).repartition(5)) == brute(docs)


def test_appender_extends_witnesses_as_runs_complete():
    a = M.Appender(2)
    for i in range(16):
        assert a.witnesses == [[] for _ in range(i)]  # partial: nothing is complete yet
        a.append(h(str(i)))
    assert [len(w) for w in a.witnesses] == [1] * 16
    for i in range(16, 40):
        a.append(h(str(i)))
    assert [len(w) for w in a.witnesses] == [1] * 32 + [0] * 8
    root = a.root()
    assert [len(w) for w in a.witnesses] == [2] * 40
    assert all(M.fold(h(str(i)), w) == root for i, w in enumerate(a.witnesses)) and root == tree([h(str(i)) for i in range(40)])[0]


def test_query_against_duckdb(spark):
    got = queries.op12_merkle(spark, "/root/testdata/sf0.001")
    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = con.sql(queries.ORACLE_SQL["op12_merkle"])
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_empty(empty):
    assert run(empty) == []

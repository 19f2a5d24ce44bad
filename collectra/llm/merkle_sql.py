"""DuckDB SQL of the Merkle manifest: one pair of queries per level of the trees.

A source may have up to 16 ** ``levels`` rows, and there may be 16 ** ``over`` sources.
"""

from __future__ import annotations

from collectra.llm.merkle import FIELDS, SMALL, UPPER


def _field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(text if c == "text" else c) for c in FIELDS) + ")"


# DuckDB has no crc32: byte by byte, eight steps of the reflected polynomial each
CRC = """xor(list_reduce([4294967295::UBIGINT] || [ascii(x)::UBIGINT FOR x IN string_split(doc_id::VARCHAR, '')],
                lambda c, b: list_reduce([xor(c, b)] || range(8)::UBIGINT[],
                lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)), 4294967295::UBIGINT)"""


def _level(src: str, dst: str, key: str) -> str:
    """Nodes (key, pos, node) to runs and the nodes above; a group of one node stays as it is."""
    return f"""
        {dst}_runs AS MATERIALIZED (
            SELECT {key}, pos // 16 AS run, list(node ORDER BY pos) AS nodes, any_value(total) AS total FROM {src} GROUP BY {key}, pos // 16),
        {dst} AS MATERIALIZED (
            SELECT {key}, run AS pos, CASE WHEN total = 1 THEN nodes[1] ELSE sha256(array_to_string(nodes, '')) END AS node,
                   (total + 15) // 16 AS total FROM {dst}_runs)"""


def _step(src: str, dst: str, runs: str, key: str) -> str:
    """The proof and fold of every row, one level on."""
    return f"""
        {dst} AS (
            SELECT s.* REPLACE (s.pos // 16 AS pos,
                   CASE WHEN r.total = 1 THEN proof ELSE proof || array_to_string([x FOR x, i IN r.nodes IF i <> s.pos % 16 + 1], '') END AS proof,
                   CASE WHEN r.total = 1 THEN folded
                        ELSE sha256(array_to_string([CASE WHEN i = s.pos % 16 + 1 THEN folded ELSE x END FOR x, i IN r.nodes], '')) END AS folded)
            FROM {src} s JOIN {runs} r ON r.run = s.pos // 16 AND {key})"""


def manifest_sql(levels: int = 6, over: int = 3) -> str:
    parts = [f"""
        d AS MATERIALIZED (SELECT *, {_leaf('text')} AS node, {_leaf(f"translate(text, '{UPPER}', '{SMALL}')")} AS small, {CRC} AS crc FROM documents),
        n0 AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, node) - 1 AS pos,
                   count(*) OVER (PARTITION BY source) AS total FROM d)"""]
    parts += [_level(f"n{i}", f"n{i + 1}", "source") for i in range(levels)]
    parts.append(f"""
        subroots AS MATERIALIZED (SELECT source, node AS subroot FROM n{levels}),
        m0 AS MATERIALIZED (
            SELECT 0 AS g, source, subroot AS node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS total FROM subroots)""")
    parts += [_level(f"m{i}", f"m{i + 1}", "g") for i in range(over)]
    parts.append("""
        p0 AS (SELECT doc_id, source, node AS leaf, CASE WHEN crc % 5 = 0 THEN small ELSE node END AS folded, '' AS proof, pos FROM n0)""")
    parts += [_step(f"p{i}", f"p{i + 1}", f"n{i + 1}_runs", "r.source IS NOT DISTINCT FROM s.source") for i in range(levels)]
    parts.append(f"""
        q0 AS (SELECT p.* REPLACE (m.pos AS pos), m.node AS subroot FROM p{levels} p JOIN m0 m ON m.source IS NOT DISTINCT FROM p.source)""")
    parts += [_step(f"q{i}", f"q{i + 1}", f"m{i + 1}_runs", "r.g = 0") for i in range(over)]
    return f"""
        WITH {",".join(parts)}
        SELECT doc_id, leaf, subroot, m.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = m.node AS verified
        FROM q{over} CROSS JOIN m{over} m"""

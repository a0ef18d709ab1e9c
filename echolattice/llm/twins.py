"""DuckDB SQL of the operators that SQL can express, with other steps than theirs: no dictionaries, no archives, no descent."""

from __future__ import annotations

#: Heights of a tree in the SQL: 8^8 leaves of a group.
HEIGHTS = 8

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), g AS (
  SELECT body, max(page_id) AS newest FROM p WHERE octet_length(encode(body)) >= 1000 GROUP BY body
)
SELECT page_id, octet_length(encode(p.body)) AS payload_bytes, sha1(p.body) AS payload_digest,
       CASE WHEN newest > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN newest > page_id THEN newest END AS refers_to
FROM p LEFT JOIN g ON p.body = g.body
"""


def vector_codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
, d{k} AS (
  SELECT c.row_no, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS d
  FROM comp c JOIN b{k} b ON c.part = b.part AND c.pos = b.pos GROUP BY ALL
), a{k} AS (
  SELECT row_no, part, entry, d FROM d{k} QUALIFY row_number() OVER (PARTITION BY row_no, part ORDER BY d, entry) = 1
), b{k + 1} AS (
  SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (
    SELECT c.part, a.entry, c.pos, floor(sum(c.x)::DOUBLE / count(*))::BIGINT AS x
    FROM comp c JOIN a{k} a ON c.row_no = a.row_no AND c.part = a.part GROUP BY ALL
  ) m ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos
)""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS row_no, list_transform(embedding, lambda v: floor(256 * v::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), comp AS (
  SELECT row_no, (k - 1) // (len(v) // {parts}) AS part, (k - 1) % (len(v) // {parts}) AS pos, v[k] AS x
  FROM (SELECT row_no, v, unnest(range(1, len(v) + 1)) AS k FROM kept)
), b0 AS (
  SELECT part, row_no - 1 AS entry, pos, x FROM comp WHERE row_no <= {entries}
){"".join(steps)}
, coded AS (
  SELECT row_no, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY row_no
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (row_no)
"""


def merkle(heights: int = HEIGHTS) -> str:
    def field(value: str) -> str:
        return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    crc = """xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))))"""

    def tree(name: str, group: str) -> str:
        """Levels name0 .. with digest, number in group and the group's size; steps of each node to its parent."""
        out = []
        for k in range(heights):
            out.append(f"""
, {name}{k + 1} AS (
  SELECT {group}, i // 8 AS i, any_value((n + 7) // 8) AS n, CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY i)) END AS digest
  FROM {name}{k} GROUP BY {group}, i // 8
), {name}s{k} AS (
  SELECT a.{group}, a.i, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM {name}{k} a JOIN {name}{k} b ON a.{group} IS NOT DISTINCT FROM b.{group} AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.{group}, a.i
)""")
        return "".join(out)

    joins, proof = [], []
    steps = [("t", "lang", "l.i", k) for k in range(heights)] + [("g", "one", "q.i", k) for k in range(heights)]
    picks = []
    for n, (name, group, place, k) in enumerate(steps):
        on = f"s{n}.lang IS NOT DISTINCT FROM l.lang" if name == "t" else "s{}.one = 0".format(n)
        joins.append(f"LEFT JOIN {name}s{k} s{n} ON {on} AND s{n}.i = {place} // {8**k}")
        proof.append(f"coalesce(s{n}.l || s{n}.r, '')")
        picks.append(f"s{n}.l AS l{n}, s{n}.r AS r{n}")
    folded = "joined"
    chain = []
    for n in range(len(steps)):
        chain.append(f", f{n} AS (SELECT * REPLACE (CASE WHEN l{n} IS NULL THEN own ELSE sha256(l{n} || own || r{n}) END AS own) FROM {folded})")
        folded = f"f{n}"
    return f"""
WITH leaves AS (
  SELECT doc_id, lang, {leaf('text')} AS leaf,
         CASE WHEN {crc} % 3 = 0 THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {leaf('text')} END AS changed
  FROM documents
), t0 AS (
  SELECT doc_id, lang, leaf AS digest, changed, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves
){tree('t', 'lang')}
, g0 AS (
  SELECT 0 AS one, lang, digest, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t{heights}
){tree('g', 'one')}
, joined AS (
  SELECT l.doc_id, l.digest AS leaf, q.digest AS subroot, (SELECT digest FROM g{heights}) AS root, sha256({' || '.join(proof)}) AS proof_sha256, l.changed AS own, {', '.join(picks)}
  FROM t0 l JOIN g0 q ON l.lang IS NOT DISTINCT FROM q.lang {' '.join(joins)}
){''.join(chain)}
SELECT doc_id, leaf, subroot, root, proof_sha256, own AS folded_root, own = root AS verified FROM {folded}
"""

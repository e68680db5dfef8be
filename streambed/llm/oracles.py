"""The SQL that checks the queries of this subpackage where SQL can say what they return."""

from __future__ import annotations

_LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     named AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS last_id FROM payloads)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + ((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last_id THEN last_id END AS refers_to
FROM named"""

_CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
formatted AS (
    SELECT *, 4 + length(replace(regexp_replace(role, '(\\|### |</turn>)', '\\\1', 'g'), ':', '\:')) + 2
              + length(regexp_replace(text, '(\\|### |</turn>)', '\\\1', 'g')) + 8 AS chars
    FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM formatted GROUP BY conv_id"""

_JOIN = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM worded WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * c >= 75 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reached(doc_id, root) AS (
    SELECT doc_id, doc_id FROM sizes
    UNION SELECT edges.y, reached.root FROM reached JOIN edges ON edges.x = reached.doc_id WHERE reached.root < edges.y)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(r.root, d.doc_id) AS component_id, coalesce(e.n, 0) AS n_links
FROM documents d LEFT JOIN sizes s USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, count(*) AS n FROM edges GROUP BY x) e USING (doc_id)
LEFT JOIN (SELECT doc_id, min(root) AS root FROM reached GROUP BY doc_id) r USING (doc_id)"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BENCHMARK = rf"""
WITH worded AS (SELECT doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
items AS (
    SELECT item_id, w, least(13, len(w)) AS m
    FROM (SELECT item_id, regexp_extract_all({_LOW.format("text")}, '{_WORD}') AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
    SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s
    FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM items)),
places AS (
    SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
    FROM (SELECT doc_id, w, m, unnest(range(1, greatest(len(w) - m + 2, 1))) AS i FROM worded, (SELECT DISTINCT m FROM items))),
found AS (SELECT doc_id, p.m, i, item_id FROM places p JOIN windows v ON v.m = p.m AND v.s = p.s),
hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + m)) AS place FROM found) GROUP BY doc_id),
held AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM worded LEFT JOIN hits USING (doc_id) LEFT JOIN held USING (doc_id)"""

def _codes(rounds: int = 2) -> str:
    """Lloyd's rounds one after another, every part against every entry."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
    SELECT rid, p, min(CAST(list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - b.x[i]) * (v.x[i] - b.x[i]))) AS BIGINT) * 64 + e) AS best
    FROM parts v JOIN book{k} b USING (p) GROUP BY rid, p)""")
        if k < rounds:
            steps.append(f"""
means{k} AS (
    SELECT p, e, list(m ORDER BY i) AS x
    FROM (SELECT p, best % 64 AS e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m
          FROM near{k} JOIN parts USING (rid, p), (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i) GROUP BY p, e, i) GROUP BY p, e),
book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN means{k} m USING (p, e))""")
    return f"""
WITH whole AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
    FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT rid, p, c[p * (len(c) // 16) + 1:(p + 1) * (len(c) // 16)] AS x FROM whole, (SELECT unnest(range(16)) AS p)),
book0 AS MATERIALIZED (
    SELECT p, e, x FROM parts JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, c) - 1 AS e FROM whole) USING (rid) WHERE e < 64),
{",".join(steps)},
coded AS (
    SELECT rid, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, CAST(sum(best // 64) AS BIGINT) AS error FROM near{rounds} GROUP BY rid),
digest AS (
    SELECT sha256(string_agg(CAST(x[i] AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM book{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM whole JOIN coded USING (rid), digest"""


def _manifest(levels: int = 8) -> str:
    """One step per level; eight levels hold 16 million leaves a language and as many languages."""
    def field(name: str, value: str = "") -> str:
        text = f"CAST({value or name} AS VARCHAR)"
        return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"

    def climb(sign: str) -> str:
        steps = []
        for k in range(levels):
            run = "PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN"
            steps.append(f"""
{sign}side{k} AS (
    SELECT tree, pos, n, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS ahead,
           coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS behind FROM {sign}n{k}),
{sign}n{k + 1} AS MATERIALIZED (
    SELECT tree, pos // 8 AS pos, any_value((n + 7) // 8) AS n, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h
    FROM {sign}n{k} GROUP BY tree, pos // 8)""")
        return ",".join(steps)

    def chain(sign: str, source: str) -> str:
        """One CTE per level, so that the folded digest is named once."""
        steps, before = [], source
        for k in range(levels):
            steps.append(f"""
{sign}f{k} AS MATERIALIZED (
    SELECT f.* EXCLUDE (folded, proof), proof || ahead || behind AS proof, CASE WHEN n > 1 THEN sha256(ahead || folded || behind) ELSE folded END AS folded
    FROM {before} f JOIN {sign}side{k} s ON s.tree = f.{sign}tree AND s.pos = f.{sign}at // {8 ** k})""")
            before = f"{sign}f{k}"
        return ",".join(steps)

    leaf = "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
    forged = "sha256(" + " || ".join([*(field(c) for c in ("doc_id", "source", "lang", "n_chars")), field("text", _LOW.format("text"))]) + ")"
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))"
    crc = (f"xor(4294967295, list_reduce({digits}, lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)), CAST(4294967295 AS BIGINT)))")
    return f"""
WITH leaves AS MATERIALIZED (
    SELECT doc_id, coalesce('1' || lang, '0') AS tree, {leaf} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {forged} END AS forged FROM documents),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
n0 AS (SELECT tree, pos, n, leaf AS h FROM placed),{climb("")},
cn0 AS MATERIALIZED (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, h, tree AS name FROM n{levels}),{climb("c")},
started AS (SELECT doc_id, tree, pos AS at, leaf, coalesce(forged, leaf) AS folded, '' AS proof FROM placed),{chain("", "started")},
crowned AS (SELECT f.*, '' AS ctree, c.pos AS cat, c.h AS subroot FROM f{levels - 1} f JOIN cn0 c ON c.name = f.tree),{chain("c", "crowned")}
SELECT doc_id, leaf, subroot, (SELECT h FROM cn{levels}) AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = (SELECT h FROM cn{levels}) AS verified
FROM cf{levels - 1}"""


_MIX = r"""
WITH sized AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce('0' || source, '1') AS source_key, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffle FROM documents),
sources AS (SELECT source_key, CAST(sum(size) AS BIGINT) AS source_size, CAST([5, 2, 1][(row_number() OVER (ORDER BY source_key) - 1) % 3 + 1] AS BIGINT) AS w FROM sized GROUP BY source_key),
-- A source stops once its size for its weight is small; with the k smallest stopped, the others share what is left.
ranked AS (SELECT *, row_number() OVER (ORDER BY source_size / w, source_key) AS k FROM sources),
rest AS (
    SELECT k, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words,
           sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight, 3 * source_size AS most, w FROM ranked),
level AS (SELECT CAST(words AS BIGINT) AS words, CAST(weight AS BIGINT) AS weight FROM rest WHERE w * words <= most * weight ORDER BY k LIMIT 1),
figures AS (
    SELECT source_key, source_size,
           CASE WHEN w * words > 3 * source_size * weight THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(w * words AS DOUBLE) / weight END AS target,
           CASE WHEN w * words > 3 * source_size * weight THEN 3 * source_size ELSE (w * words) // weight END AS quota
    FROM sources, level),
laid AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source_key ORDER BY shuffle, doc_id, size, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM sized)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(list_sum(list_transform([0, 1, 2], lambda r: greatest(0, least(r * source_size + ahead + size, quota) - (r * source_size + ahead)))) AS BIGINT) AS taken
FROM laid JOIN figures USING (source_key)"""

ORACLES: dict[str, str] = {
    "op6_warc_index": _WARC,
    "op7_chat_formatting": _CHAT,
    "op8_ngram_jaccard_join": _JOIN,
    "op9_benchmark_decontamination": _BENCHMARK,
    "op11_cover_tree_codes": _codes(),
    "op12_merkle_manifest": _manifest(),
    "op13_source_mixing": _MIX,
}

"""DuckDB twins of the queries that SQL can express.

Without one: the license scan (zstandard), the mix (a seeded draw), the
classifier (a fit), SimHash (XXH64), byte-pair encoding and the pipeline; tests hold these against
brute force, exact sums or held-out accuracy.
"""

from __future__ import annotations

from .chat import INST
from .decontam import WINDOW as SHARED
from .linededup import MIN_CHARS
from .secrets import ALLOWED, CANDIDATE, CLASSES, COST, WINDOW, entropy_limit
from .topk import DIVISOR, K, SCALE

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _lower(c: str) -> str:
    return f"translate({c}, '{UPPER}', '{LOWER}')"


_WARC = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body, row_number() OVER () AS rid FROM pages),
d AS (SELECT *, strlen(body) AS payload_bytes, sha1(body) AS h FROM p),
o AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST, rid) AS nth,
             max(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31 AS BIGINT), 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN nth > 1 THEN first END AS refers_to
FROM o"""

_DECONTAM = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid,
                  regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
             regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(len(w), {SHARED}) AS n, unnest(range(1, len(w) - least(len(w), {SHARED}) + 2)) AS i FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM bi),
di AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM di),
hit AS (SELECT rid, i, n, t FROM dw SEMI JOIN iw USING (n, t)),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT rid, item_id FROM hit JOIN iw USING (n, t)) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)"""

_LINES = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, rid, unnest(ls) AS line, unnest(range(len(ls))) AS n FROM d),
k AS (SELECT *, {_lower("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
f AS (SELECT *, length(key) >= {MIN_CHARS} AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY rid"""

_TOPK = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % {DIVISOR} = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {K}"""


def _located(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    """Rows (rid, start, rank, end, kind, word) of the matches of one pattern."""
    return f"""
  SELECT rid, s AS start, {rank} AS rank, s + length(m[i]) AS "end", '{kind}' AS kind, m[i] AS word FROM (
    SELECT rid, m, g, i, CAST(list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
    FROM (SELECT rid, m, g, gap, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT rid, regexp_extract_all(text, {pattern}, 0) AS m, regexp_extract_all(text, {pattern}, {group}) AS g, string_split_regex(text, {pattern}) AS gap FROM d)))
  WHERE length(g[i]) >= {least}"""


def _secrets() -> str:
    names = "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token"))
    api = "".join(f"[{c.upper()}{c}]" for c in "api") + "_?" + "".join(f"[{c.upper()}{c}]" for c in "key")
    assign = _q(rf"""({names}|{api})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    base = " UNION ALL ".join([_located("assign", 0, assign, 2, 8), _located("access", 1, _q("AKIA[A-Z0-9]+"), 0, 16),
                               _located("hex", 2, _q("[0-9a-f]{32,}"), 0, 32)])
    allowed = " OR ".join(f"regexp_matches(word, {_q(p)})" for p in ALLOWED)
    limit = "CASE " + " ".join(f"WHEN regexp_matches(word, {_q(p)}) THEN {entropy_limit(bits)}" for _, p, bits in CLASSES) + " END"
    cost = "[" + ", ".join(map(str, COST)) + "]"

    def listed(where):
        return f"""coalesce((SELECT string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank, "end") FROM {where} x WHERE x.rid = d.rid), '')"""

    def count(kind):
        return f"(SELECT count(*) FROM base x WHERE x.rid = d.rid AND kind = '{kind}') AS n_{kind}"

    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
base AS ({base}),
cand AS (SELECT *, row_number() OVER () AS cid, {limit} AS most, string_split(word, '') AS c FROM ({_located("entropy", 3, _q(CANDIDATE), 0, 20)}) WHERE NOT ({allowed})),
win AS (SELECT rid, cid, start, most, i, c[i:i + {WINDOW} - 1] AS w FROM (SELECT *, unnest(range(1, len(c) - {WINDOW} + 2)) AS i FROM cand)),
hot AS (SELECT rid, cid, start + i - 1 AS a, start + i - 1 + {WINDOW} AS z FROM win
        WHERE list_sum(list_transform(map_values(histogram_of(w)), lambda n: {cost}[n + 1])) <= most),
isle AS (SELECT *, sum(fresh) OVER (PARTITION BY cid ORDER BY a) AS run FROM (
        SELECT *, CASE WHEN lag(z) OVER (PARTITION BY cid ORDER BY a) >= a THEN 0 ELSE 1 END AS fresh FROM hot)),
added AS (SELECT rid, min(a) AS start, 3 AS rank, max(z) AS "end", 'entropy' AS kind FROM isle GROUP BY rid, cid, run),
alls AS (SELECT rid, start, rank, "end", kind FROM base UNION ALL SELECT * FROM added a
         WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = a.rid AND b.start <= a.start AND a."end" <= b."end"))
SELECT doc_id, {count("assign")}, {count("access")}, {count("hex")}, sha256({listed("base")}) AS base_sha256, {listed("alls")} AS spans
FROM d""".replace("map_values(histogram_of(w))", "list_transform(list_distinct(w), lambda x: len(list_filter(w, lambda y: y = x)))")


def _chat() -> str:
    def escaped(c):
        out = f"replace({c}, '\\', '\\\\')"
        for m in INST.marks():
            out = f"replace({out}, {_q(m)}, {_q(m[0] + chr(92) + m[1:])})"
        return out

    around = " ".join(f"WHEN '{n}' THEN {len(r.before) + len(r.after)}" for n, r in INST.roles.items())
    before = " ".join(f"WHEN '{n}' THEN {len(r.before)}" for n, r in INST.roles.items())
    learned = ", ".join(_q(n) for n, r in INST.roles.items() if r.loss)
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (SELECT *, length({escaped("text")}) AS body, CASE role {around} ELSE {sum(map(len, INST.other))} + length({escaped("role")}) END + length({escaped("text")}) AS chars,
             CASE role {before} ELSE 0 END AS lead, row_number() OVER w - 1 AS n, lag(role) OVER w AS last, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS back
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
t AS (SELECT *, {len(INST.begin)} + CAST(sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS BIGINT) - chars + lead AS spot,
             CASE WHEN n = 0 THEN role IN ('system', 'user') WHEN last = 'system' THEN role = 'user' WHEN last = 'user' THEN role = 'assistant'
                  WHEN last = 'assistant' THEN role = 'user' ELSE false END AS in_order FROM s),
g AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY n) AS said,
             coalesce(string_agg(text, '' ORDER BY n) FILTER (role IN ({learned})), '') AS loss,
             sum(chars) AS chars, min(n) FILTER (NOT in_order) AS first_wrong, min(role) FILTER (back = 1) AS end_role,
             coalesce(string_agg(spot || ':' || (spot + body), ',' ORDER BY n) FILTER (role IN ({learned})), '') AS loss_spans FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST({len(INST.begin)} + chars AS BIGINT) AS formatted_chars, first_wrong, first_wrong IS NOT NULL OR end_role <> 'assistant' AS ends_open, loss_spans FROM g"""


_LEXICAL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid,
                  regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
q AS (SELECT item_id, t, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
c AS (SELECT count(*) AS docs, CAST(sum(len(ws)) AS BIGINT) AS terms FROM d WHERE len(ws) > 0),
tf AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ws) AS t FROM d) GROUP BY ALL),
df AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY t, docs),
m AS (SELECT rid, doc_id, 75 + (25 * len(ws) * docs) // terms AS m FROM d, c WHERE len(ws) > 0),
s AS (SELECT item_id, rid, any_value(doc_id) AS doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN tf USING (t) JOIN df USING (t) JOIN m USING (rid) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20"""


def _merkle() -> str:
    """Levels one by one: five for a source (a million rows), three for the sources; a group of one node stays as it is."""
    def field(c):
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def level(nodes, up, fold):
        return f"""{up}n AS (SELECT g, pos // 16 AS pos, any_value(n) AS n, list(digest ORDER BY pos) AS kids FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {nodes}) GROUP BY g, pos // 16),
{up} AS (SELECT g, pos, CASE WHEN n = 1 THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS digest FROM {up}n),
{up}f AS (SELECT f.* REPLACE (f.pos // 16 AS pos,
               CASE WHEN n = 1 THEN folded ELSE sha256(array_to_string(kids[1:f.pos % 16] || [folded] || kids[f.pos % 16 + 2:], '')) END AS folded,
               CASE WHEN n = 1 THEN proof ELSE proof || array_to_string(kids[1:f.pos % 16] || kids[f.pos % 16 + 2:], '') END AS proof)
         FROM {fold} f JOIN {up}n k ON k.g = f.g AND k.pos = f.pos // 16)"""

    plain = [field(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    other = [*plain[:4], field(_lower("text"))]
    lower_levels = ",\n".join(level(f"a{i}", f"a{i + 1}", f"a{i}f") for i in range(5))
    upper_levels = ",\n".join(level(f"b{i}", f"b{i + 1}", f"b{i}f") for i in range(3))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS g, sha256({" || ".join(plain)}) AS leaf, sha256({" || ".join(other)}) AS other,
                  list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT)) AS code FROM documents),
e AS (SELECT *, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, code), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]),
             lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END))) AS crc FROM d),
a0f AS (SELECT rid, doc_id, g, leaf, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
               CASE WHEN crc % 5 = 0 THEN other ELSE leaf END AS folded, '' AS proof FROM e),
a0 AS (SELECT g, pos, leaf AS digest FROM a0f),
{lower_levels},
b0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, g AS of, digest FROM a5),
b0f AS (SELECT rid, doc_id, '' AS g, leaf, b0.digest AS subroot, b0.pos, folded, proof FROM a5f JOIN b0 ON a5f.g = of),
{upper_levels}
SELECT doc_id, leaf, subroot, b3.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = b3.digest AS verified FROM b3f, b3"""


ORACLE_SQL: dict[str, str] = {
    "op3_warc": _WARC,
    "op5_decontaminate": _DECONTAM,
    "op6_line_dedup": _LINES,
    "op7_topk": _TOPK,
    "op8_secrets": _secrets(),
    "op10_chat": _chat(),
    "chat_turn_order": f"SELECT conv_id, first_wrong, ends_open, loss_spans FROM ({_chat()})",
    "op11_lexical_search": _LEXICAL,
    "op13_merkle": _merkle(),
}

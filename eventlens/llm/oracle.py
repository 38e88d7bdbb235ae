"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

WORDS = r"""
list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

#: Base32 of a 160-bit hexadecimal digest: every five digits are four letters.
OP2 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hx, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hx) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + ((('0x' || substr(hx, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""

OP3 = r"""
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
keyed AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos, len(ls) AS n FROM lines),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM keyed),
common AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, common.key IS NOT NULL AS bad FROM k LEFT JOIN common USING (key))
SELECT doc_id, max(n)::BIGINT AS n_lines, count(*) FILTER (bad)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT bad), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

OP4 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[s + 1 : s + 5], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)"""

OP6 = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|im_', '<| im_') AS text,
    coalesce(turn // 256, 0)::BIGINT AS part FROM conversations),
who AS (SELECT DISTINCT conv_id, role AS speaker FROM c WHERE role <> 'system'),
r AS (
  SELECT c.*, speaker, CASE WHEN role = speaker THEN '<|im_start|>assistant' || chr(10)
    WHEN role = 'system' THEN '<|im_start|>system' || chr(10)
    ELSE '<|im_start|>user name=' || role || chr(10) END AS head
  FROM c JOIN who ON c.conv_id IS NOT DISTINCT FROM who.conv_id),
p AS (
  SELECT *, coalesce(sum(length(head) + length(text) + 11) OVER (PARTITION BY conv_id, speaker, part ORDER BY turn, role, text
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM r)
SELECT conv_id, speaker, part, count(*)::BIGINT AS n_turns, count(*) FILTER (role = speaker)::BIGINT AS n_own,
  string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS text,
  coalesce(string_agg((base + length(head)) || ':' || (base + length(head) + length(text) + 10), ',' ORDER BY turn, role, text)
    FILTER (role = speaker), '') AS mask
FROM p GROUP BY conv_id, speaker, part"""

OP8 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
i AS (SELECT item_id, {WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, w[s + 1 : s + 10] AS ws
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(ws) AS l FROM win),
places AS (
  SELECT doc_id, s, l, w[s + 1 : s + l] AS ws
  FROM (SELECT doc_id, w, l, unnest(range(greatest(len(w) - l + 1, 0))) AS s FROM d, lens)),
found AS (SELECT doc_id, s, l, item_id FROM places JOIN win USING (ws)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM found) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""

OP9 = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256)::BIGINT AS group_size,
  doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS kept,
  text_sha256
FROM n"""


def _matches(kind: int, pattern: str, keep: str) -> str:
    """Matches of a pattern with their places, from the pieces between them."""
    return f"""
  SELECT doc_id, owner, {kind} AS kind, m, length(array_to_string(b[1 : j], '')) + length(array_to_string(ms[1 : j - 1], '')) AS s
  FROM (SELECT doc_id, owner, ms, b, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS j FROM (
    SELECT doc_id, source AS owner, regexp_extract_all(coalesce(text, ''), '{pattern}') AS ms,
      regexp_split_to_array(coalesce(text, ''), '{pattern}') AS b FROM documents))
  WHERE {keep}"""


_HEAD = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?"""

OP10 = rf"""
WITH raw AS (
  {_matches(0, _HEAD + "[A-Za-z0-9+/_.=-]+", f"length(regexp_replace(m, '^' || '{_HEAD}', '')) >= 12")}
  UNION ALL {_matches(1, "AKIA[A-Z0-9]+", "length(m) >= 18")}
  UNION ALL {_matches(2, "[0-9a-f]+", "length(m) >= 16")}
  UNION ALL {_matches(3, "[A-Za-z0-9]+", "length(m) >= 20 AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]')")}),
c AS (
  SELECT doc_id, owner, kind, s, s + length(m) AS e,
    CASE kind WHEN 0 THEN regexp_replace(m, '^' || '{_HEAD}', '') ELSE m END AS value FROM raw),
own AS (SELECT value, count(DISTINCT coalesce(owner, chr(0))) AS owners, count(DISTINCT coalesce(owner, chr(0)) || ' ' || doc_id) AS repos FROM c GROUP BY value),
j AS (SELECT c.*, owners >= 3 OR repos >= 10 AS example FROM c JOIN own USING (value)),
sp AS (
  SELECT doc_id,
    string_agg(['assign', 'access', 'hex', 'live'][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans,
    string_agg(['assign', 'access', 'hex', 'live'][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
    count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
    count(*) FILTER (NOT example) AS n_owned
  FROM j WHERE kind < 3 OR NOT example GROUP BY doc_id)
SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_owned, 0)::BIGINT AS n_owned
FROM documents LEFT JOIN sp USING (doc_id)"""

#: CRC-32 of a text of ASCII letters, its table made by eight shifts.
_CRC_TABLE = """crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS c FROM range(256) r(i)))"""
_CRC = """xor(list_reduce(list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT),
  lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295)"""


def _more(at: str, cost: str, letter: str) -> str:
    return f"{{'c': {at}.c + {cost}, 'a': {at}.a || {letter}}}"


def _stay(at: str, role: str) -> str:
    price = f"CASE WHEN x.f IN ('b', 'd') THEN 1000000000 ELSE CASE x.f WHEN 't' THEN 3 ELSE 0 END + CASE x.r WHEN '{role}' THEN 0 ELSE 3 END END"
    return _more(at, price, f"CASE x.r WHEN '{role}' THEN 'K' ELSE 'R' END")


#: The best (cost, audit) z in each of four states, after possible insertions and after a row x.
_USER = f"""least(z[3], {_more('z[1]', '3', "'I'")}, {_more('z[2]', '3', "'I'")}, {_more('z[4]', '3', "'I'")})"""
_INSERT = f"""[z[1], z[2], {_USER}, least(z[4], {_more(_USER, '3', "'I'")})]"""
_SYSTEM = "CASE WHEN x.r <> 's' OR x.f IN ('b', 'd') THEN 1000000000 WHEN x.f = 't' THEN 3 ELSE 0 END"
_ROW = f"""[{_more('z[1]', '4', "'D'")}, least({_more('z[2]', '4', "'D'")}, {_more('z[1]', _SYSTEM, "'K'")}),
    least({_more('z[3]', '4', "'D'")}, {_stay('z[1]', 'u')}, {_stay('z[2]', 'u')}, {_stay('z[4]', 'u')}),
    least({_more('z[4]', '4', "'D'")}, {_stay('z[3]', 'a')})]"""

OP11 = f"""
WITH {_CRC_TABLE},
d AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM (SELECT *, {_CRC} % 20 AS h FROM (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations), crc)
  WHERE h <> 0),
e AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS p FROM d),
f AS (
  SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS r,
    CASE WHEN said = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'd'
      WHEN right(said, 1) IN ('.', '!', '?') THEN '.' ELSE 't' END AS f FROM e),
g AS (SELECT *, lag(r) OVER (PARTITION BY conv_id ORDER BY p) AS q FROM f),
c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank,
    count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
    count(*) FILTER (q IS NOT NULL AND q || r NOT IN ('su', 'ua', 'au')) AS illegal,
    list({{'r': r, 'f': f, 'role': role, 'text': text}} ORDER BY p) AS rows FROM g GROUP BY conv_id),
w AS (
  SELECT *, list_reduce(
    list_append(flatten(list_transform(rows, lambda x: [{{'r': '+', 'f': '+'}}, {{'r': x.r, 'f': x.f}}])), {{'r': '+', 'f': '+'}}),
    lambda z, x: CASE x.r WHEN '+' THEN {_INSERT} ELSE {_ROW} END,
    [{{'c': 0, 'a': ''}}, {{'c': 1000000000, 'a': ''}}, {{'c': 1000000000, 'a': ''}}, {{'c': 1000000000, 'a': ''}}]) AS z FROM c),
b AS (SELECT *, least(z[1], z[4]) AS best FROM w),
o AS (
  SELECT *, list_reduce(list_filter(string_split(best.a, ''), lambda x: x <> ''), lambda y, x: {{
      'i': y.i + CASE x WHEN 'I' THEN 0 ELSE 1 END,
      'next': CASE WHEN x = 'D' THEN y.next WHEN x = 'K' AND rows[y.i].r = 's' THEN 'user' WHEN y.next = 'user' THEN 'assistant' ELSE 'user' END,
      'said': CASE x WHEN 'D' THEN y.said WHEN 'K' THEN list_append(y.said, rows[y.i].role || ':' || rows[y.i].text)
        WHEN 'R' THEN list_append(y.said, y.next || ':' || rows[y.i].text) ELSE list_append(y.said, y.next || ':') END}},
    {{'i': 1, 'next': 'user', 'said': []::VARCHAR[]}}) AS y FROM b)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(y.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN (SELECT conv_id AS cid, * EXCLUDE (conv_id) FROM o) o ON i.conv_id IS NOT DISTINCT FROM o.cid"""

ORACLE_SQL = {
    "op2_warc": OP2,
    "op3_line_dedup": OP3,
    "op4_near_dedup": OP4,
    "op6_chat_format": OP6,
    "op8_decontaminate": OP8,
    "op9_exact_dedup": OP9,
    "op10_secret_scan": OP10,
    "op11_conversation_repair": OP11,
}

"""DuckDB statements for the queries that SQL can express; written from the contracts, not from the Spark code."""

from __future__ import annotations

from .queries import CHAT_SAMPLE, URL_RULES
from .secret_scan import RULES

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_SAMPLE = _quote(CHAT_SAMPLE)
_ESC = r"replace(replace(replace(replace({0}, '\', '\b'), '###', '\h'), '</turn>', '\e'), '[[', '\o')"

OP2 = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {_SAMPLE} UNION ALL SELECT -7, 1, 'assistant', {_SAMPLE}),
e AS (SELECT *, {_ESC.format('text')} AS body, replace({_ESC.format('role')}, ':', '\\c') AS head FROM m)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(head) + 2 + length(body) + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

_FIT = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
    for h, p, _ in sorted(URL_RULES, key=lambda r: -len(r[0] + r[1])))
_SAID = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in URL_RULES)
OP7 = f"""
WITH u AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UP}', '{_LOW}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\\?([^#]*)', 1), '') AS query FROM pages),
c AS (
  SELECT *, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\\.', '') AS h,
    regexp_replace(regexp_replace(path, '/index\\.html?$', '/'), '/+$', '') AS p,
    array_to_string(list_sort(list_filter(string_split(query, '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(?:utm_[^=]*|ref|fbclid|gclid|sessionid)(?:=|$)'))), '&') AS q FROM u),
k AS (SELECT *, CASE WHEN h <> '' THEN h || p || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS canonical FROM c),
n AS (SELECT *, CASE WHEN canonical IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY canonical) END AS rows_of,
        CASE {_FIT} END AS rule FROM k)
SELECT page_id, host, path, rule,
  CASE {_SAID} WHEN rows_of >= 2 THEN 'block' ELSE 'allow' END AS verdict
FROM n
"""


def _spans(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    p = _quote(pattern)
    return f"""SELECT doc_id, row_no, unnest(list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
        'start': CAST(list_sum(list_transform(x[1:i], lambda s: length(s))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda s: length(s))), 0) AS BIGINT),
        'ord': {order}, 'kind': '{kind}', 'size': length(m[i]), 'part': length(g[i])}}), lambda r: r.part >= {least})) AS r
      FROM (SELECT doc_id, row_no, regexp_extract_all(text, {p}, 0) AS m, regexp_extract_all(text, {p}, {group}) AS g,
              string_split_regex(text, {p}) AS x FROM d WHERE regexp_matches(text, {p}))"""


#: the shortest run is written into the expression where the whole match is one run of a class after fixed letters
_SQL_RULES = list(RULES)
_SQL_RULES = [("hex", r"[0-9a-f]{32,}", 0, 32) if r[0] == "hex" else r for r in _SQL_RULES]
OP10 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_no, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_spans(k, i, p, g, n) for i, (k, p, g, n) in enumerate(_SQL_RULES))}),
t AS (SELECT row_no, r.kind AS kind, r.kind || ':' || r.start || ':' || (r.start + r.size) AS span, r.start AS first, r.ord AS ord FROM s),
a AS (SELECT row_no, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(span, ',' ORDER BY first, ord) FILTER (kind IN ('assign', 'access', 'hex')) AS base,
        string_agg(span, ',' ORDER BY first, ord) AS spans FROM t GROUP BY row_no)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (row_no)
"""

_LETTERS = "(VALUES ('A'), ('B'), ('C'), ('D'), ('E'))"
OP11 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
l AS (SELECT doc_id AS labelled, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(words) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
      FROM w LEFT JOIN l ON doc_id = labelled),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM {_LETTERS} a(x), {_LETTERS} b(x), {_LETTERS} c(x), {_LETTERS} d(x), {_LETTERS} e(x)
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
r AS (SELECT c.*, filter_order, coalesce(list_min(list_transform(string_split(fails, ''), lambda x: CASE WHEN x = '' THEN 9 ELSE strpos(filter_order, x) END)), 9) AS gone
      FROM c, o),
s AS (SELECT *, substring(filter_order, step, 1) AS letter FROM r, range(1, 6) t(step)),
g AS (SELECT part, filter_order, step, letter,
        sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN contains(fails, letter) AND gone < step THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
      FROM s GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM g
"""


def _nearest(name: str, books: str) -> str:
    """A CTE with the nearest entry of every part: near.d its distance, near.e its number."""
    return f"""{name} AS (SELECT rid, p.part, min(struct_pack(d := CAST(list_sum(list_transform(range(1, len(p.sub) + 1),
        lambda i: (p.sub[i] - b.sub[i]) * (p.sub[i] - b.sub[i]))) AS BIGINT), e := b.entry)) AS near
      FROM p JOIN {books} b ON p.part = b.part GROUP BY rid, p.part)"""


def _means(name: str, books: str, nearest: str) -> str:
    """CTEs with the floored means of the parts of every entry, unused entries as they were."""
    return f"""{name}_sums AS (SELECT part, entry, pos, sum(x) AS total, count(*) AS n FROM (
        SELECT p.part, a.near.e AS entry, unnest(range(1, len(p.sub) + 1)) AS pos, unnest(p.sub) AS x FROM p JOIN {nearest} a ON p.rid = a.rid AND p.part = a.part)
      GROUP BY part, entry, pos),
    {name}_new AS (SELECT part, entry, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS sub FROM {name}_sums GROUP BY part, entry),
    {name} AS (SELECT b.part, b.entry, coalesce(m.sub, b.sub) AS sub FROM {books} b LEFT JOIN {name}_new m ON b.part = m.part AND b.entry = m.entry)"""


OP13 = f"""
WITH k AS (SELECT row_number() OVER () AS rid, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT rid, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS sub FROM k, range(0, 16) t(part)),
s AS (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM k),
b0 AS (SELECT part, entry, sub FROM p JOIN s ON p.rid = s.rid WHERE entry < 64),
{_nearest('n1', 'b0')}, {_means('b1', 'b0', 'n1')}, {_nearest('n2', 'b1')}, {_means('b2', 'b1', 'n2')}, {_nearest('n3', 'b2')},
c AS (SELECT rid, string_agg(format('{{:02x}}', near.e), '' ORDER BY part) AS code, CAST(sum(near.d) AS BIGINT) AS error FROM n3 GROUP BY rid),
h AS (SELECT sha256(string_agg(array_to_string(sub, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM k JOIN c ON k.rid = c.rid, h
"""

SQL = {"op11_filter_audit": OP11, "op13_vector_codes": OP13, "op2_chat_format": OP2, "op7_url_filter": OP7, "op10_secret_scan": OP10}

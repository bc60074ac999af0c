"""DuckDB CTEs that rebuild the test inputs from the given tables.

Written independently of the Spark builders (``seedmill/plans/fixtures.py``):
same key rules, relational SQL, no shared code. ``with_ctes(sql, names)``
prefixes a statement with the named CTEs and everything they depend on.
"""

from __future__ import annotations

import re

from seedmill.functions import vocab


def H(*parts: str) -> str:
    """DuckDB text of the portable hash over SQL expressions."""
    inner = ", ".join(f"coalesce(cast({p} as varchar), '')" for p in parts)
    return f"('0x' || substr(md5(concat_ws('|', {inner})), 1, 15))::bigint"


def lst(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def vals(rows) -> str:
    def q(x):
        if isinstance(x, str):
            return "'" + x.replace("'", "''") + "'"
        return str(x)
    return ", ".join("(" + ", ".join(q(x) for x in r) + ")" for r in rows)


WS = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
WS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in WS) + ")"


def pstrip(x: str) -> str:
    """Python str.strip() in DuckDB."""
    return f"trim({x}, {WS_SQL})"


DIMS = vocab.DIMENSIONS
_B = vocab.BUNDLES["medicine"]

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


cte("fx_seeds", f"""
SELECT cast(doc_id AS varchar) AS seed_id,
       {lst(vocab.DOMAINS)}[doc_id % 10 + 1] AS domain,
       text, lang AS language,
       CASE WHEN doc_id % 4 = 0 THEN []::varchar[]
            WHEN doc_id % 4 = 1 THEN [source] ELSE [source, lang] END AS tags,
       CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE text END AS ground_truth,
       doc_id
FROM documents""")

cte("fx_ranges", f"SELECT * FROM (VALUES {vals(vocab.DOMAIN_RANGES)}) t(domain, target_concepts_range)")

cte("fx_ledger", """
SELECT CASE WHEN s.doc_id % 10 = 0 THEN 'N/A' ELSE md5('run|' || cast(s.doc_id AS varchar)) END AS run_id,
       s.seed_id, s.domain, r.target_concepts_range,
       CASE WHEN s.doc_id % 10 = 0 THEN 'FAILED_CREATE' WHEN s.doc_id % 10 = 1 THEN 'FAILED_START'
            WHEN s.doc_id % 7 = 0 THEN '  STARTED ' ELSE 'STARTED' END AS status,
       s.doc_id
FROM fx_seeds s JOIN fx_ranges r USING (domain)""")

cte("fx_concepts", f"""
SELECT md5('run|' || cast(s.doc_id AS varchar)) AS run_id, s.seed_id, s.domain,
       p.p_name AS concept_name,
       {lst(vocab.CONCEPT_TYPES)}[(s.doc_id + g.pos) % 7 + 1] AS concept_type,
       {pstrip('substr(s.text, (length(s.text) * g.pos // (s.doc_id % 6))::int + 1, (length(s.text) * (g.pos + 1) // (s.doc_id % 6) - length(s.text) * g.pos // (s.doc_id % 6))::int)')} AS concept_definition,
       md5(s.seed_id || '|' || cast(g.pos AS varchar)) AS concept_id,
       cast(g.pos AS integer) AS pos, s.doc_id
FROM fx_seeds s
JOIN range(0, 5) g(pos) ON g.pos < s.doc_id % 6
JOIN part p ON p.p_partkey = (s.doc_id * 7 + g.pos) % (SELECT count(*) FROM part)
WHERE s.doc_id % 10 NOT IN (0, 1)""")

cte("fx_dims", "SELECT * FROM (VALUES " + vals(
    [(d, i, v) for d in DIMS for i, v in enumerate(_B[d])]) + ") t(dim, pos, value)")

cte("fx_rules", f"SELECT * FROM (VALUES {vals(vocab.BAN_RULES)}) t(dim, concept_type, value)")

cte("fx_space", """
SELECT t.rule_type, f.value AS format, a.value AS audience, g.value AS angle, o.value AS cognitive_operation
FROM (SELECT DISTINCT concept_type AS rule_type FROM fx_rules UNION ALL SELECT '*') t
JOIN fx_dims f ON f.dim = 'format'
JOIN fx_dims a ON a.dim = 'audience'
JOIN fx_dims g ON g.dim = 'angle'
JOIN fx_dims o ON o.dim = 'cognitive_operation'
WHERE NOT EXISTS (
  SELECT 1 FROM fx_rules r WHERE r.concept_type = t.rule_type AND (
     (r.dim = 'format' AND r.value = f.value) OR (r.dim = 'audience' AND r.value = a.value)
  OR (r.dim = 'angle' AND r.value = g.value) OR (r.dim = 'cognitive_operation' AND r.value = o.value)))""")

# allowed values numbered per rule type and dimension; a type's combos numbered in mixed radix (format first)
cte("fx_pos", """
SELECT t.rule_type, d.dim, d.value, row_number() OVER (PARTITION BY t.rule_type, d.dim ORDER BY d.pos) - 1 AS k,
       count(*) OVER (PARTITION BY t.rule_type, d.dim) AS size
FROM (SELECT DISTINCT concept_type AS rule_type FROM fx_rules UNION ALL SELECT '*') t CROSS JOIN fx_dims d
WHERE NOT EXISTS (SELECT 1 FROM fx_rules r WHERE r.concept_type = t.rule_type AND r.dim = d.dim AND r.value = d.value)""")

cte("fx_pool", """
SELECT f.rule_type, f.value AS format, a.value AS audience, g.value AS angle, o.value AS cognitive_operation,
       f.k + f.size * (a.k + a.size * (g.k + g.size * o.k)) AS x, f.size * a.size * g.size * o.size AS n
FROM fx_pos f JOIN fx_pos a USING (rule_type) JOIN fx_pos g USING (rule_type) JOIN fx_pos o USING (rule_type)
WHERE f.dim = 'format' AND a.dim = 'audience' AND g.dim = 'angle' AND o.dim = 'cognitive_operation'""")

cte("fx_prime", """
SELECT n, min(p) AS p FROM (SELECT n, unnest(range(n, n + 400)) AS p FROM (SELECT DISTINCT n FROM fx_pool))
WHERE len(list_filter(range(2, cast(floor(sqrt(p)) AS bigint) + 1), lambda d: p % d = 0)) = 0 GROUP BY n""")

cte("fx_sample", f"""
SELECT c.* EXCLUDE (a, b, n, p, i, rule_type), s.format, s.audience, s.angle, s.cognitive_operation,
       {H('c.concept_id', 's.format', 's.audience', 's.angle', 's.cognitive_operation')} AS combo_id, sample_rank
FROM (SELECT *, row_number() OVER (PARTITION BY concept_id ORDER BY i) AS sample_rank FROM (
        SELECT *, unnest(range(0, p)) AS i FROM (
          SELECT c.*, q.rule_type, q.n, r.p, {H('c.concept_id', "'a'")} % (r.p - 1) + 1 AS a, {H('c.concept_id', "'b'")} % r.p AS b
          FROM fx_concepts c JOIN (SELECT DISTINCT rule_type, n FROM fx_pool) q
            ON q.rule_type = CASE WHEN c.concept_type IN (SELECT concept_type FROM fx_rules) THEN c.concept_type ELSE '*' END
          JOIN fx_prime r ON r.n = q.n))
      WHERE (a * i + b) % p < n QUALIFY row_number() OVER (PARTITION BY concept_id ORDER BY i) <= {vocab.SAMPLES_PER_CONCEPT}) c
JOIN fx_pool s ON s.rule_type = c.rule_type AND s.x = (c.a * c.i + c.b) % c.p""")

cte("fx_descriptions", "SELECT dim, value, p_name || ', ' || lower(p_type) AS description FROM (VALUES " + vals(
    [(d, v, i) for i, (d, v) in enumerate((d, v) for d in DIMS for v in _B[d])]) + ") t(dim, value, k) JOIN part ON p_partkey = k")

cte("fx_done", f"""
SELECT run_id, seed_id, domain, concept_name, concept_type, concept_definition,
       format, audience, angle, cognitive_operation,
       CASE WHEN {H('combo_id')} % 5 = 0 THEN ''
            WHEN {H('concept_id', 'format', 'audience', 'angle', 'cognitive_operation')} % 100 < 40 THEN 'True'
            ELSE 'False' END AS is_valid,
       'earlier run' AS reason, concept_id
FROM fx_sample WHERE {H('combo_id')} % 3 = 0""")

cte("fx_batches", """
SELECT *, md5(concept_id || '|' || cast(batch_no AS varchar)) AS batch_id FROM (
  SELECT *, cast((sample_rank - 1) // 10 AS integer) AS batch_no,
            cast((sample_rank - 1) % 10 AS integer) AS slot
  FROM fx_sample)""")


# CTEs read more than once by some statements: computed once.
HEAVY = {"fx_sample", "fx_batches", "fx_batch_fault", "fx_aligned", "fx_shl", "fx_sh", "fx_pool", "fx_prime", "fx_pos", "fx_reps", "fx_sig",
         "fx_band", "fx_cand", "fx_jac", "fx_concepts", "fx_dd"}


def _deps(sql: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{n}\b", sql)]


def with_ctes(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with every fixture CTE it (transitively) references."""
    pool = dict(CTES)
    pool.update(extra or {})
    order: list[str] = []

    def visit(name, seen=()):
        if name in order:
            return
        for d in [n for n in pool if n != name and re.search(rf"\b{n}\b", pool[name])]:
            if d not in seen:
                visit(d, seen + (name,))
        order.append(name)

    for n in [n for n in pool if re.search(rf"\b{n}\b", sql)]:
        visit(n)
    if not order:
        return sql
    head = "WITH " + ",\n".join(
        f"{n} AS {'MATERIALIZED ' if n in HEAVY else ''}({pool[n]})" for n in order)
    body = sql.lstrip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + head[5:] + ",\n" + body[15:]
    if body[:5].upper() == "WITH ":
        return head + ",\n" + body[5:]
    return head + "\n" + body

cte("fx_seed_lines", """
SELECT unnest(CASE WHEN doc_id % 5 = 0 THEN [line, '   '] ELSE [line] END) AS value FROM (
  SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '  ' || cast(doc_id AS varchar) || chr(9)
                      WHEN doc_id % 3 = 1 THEN cast(doc_id AS varchar) || ' '
                      ELSE cast(doc_id AS varchar) END AS line
  FROM documents)""")

cte("fx_started", "SELECT * FROM fx_ledger WHERE trim(status) = 'STARTED'")

cte("fx_draft_state", """
SELECT l.run_id, l.seed_id, l.domain, l.doc_id,
       l.doc_id % 43 <> 0 AS has_draft,
       CASE WHEN l.doc_id % 43 = 0 THEN 'no_draft'
            WHEN l.doc_id % 29 = 0 THEN 'no_drafts'
            WHEN l.doc_id % 17 = 0 THEN 'invalid_json'
            WHEN l.doc_id % 19 = 0 THEN 'empty'
            WHEN l.doc_id % 23 = 0 THEN 'null_input'
            WHEN l.doc_id % 31 = 0 THEN 'invalid_json'
            WHEN l.doc_id % 37 = 0 THEN 'invalid_json'
            WHEN l.doc_id % 6 = 0 THEN 'no_concepts' END AS reason,
       CASE WHEN l.doc_id % 29 = 0 THEN 'null_input'
            WHEN l.doc_id % 17 = 0 THEN 'invalid_json'
            WHEN l.doc_id % 19 = 0 THEN 'empty'
            WHEN l.doc_id % 23 = 0 THEN 'null_input'
            WHEN l.doc_id % 31 = 0 OR l.doc_id % 37 = 0 THEN 'invalid_json' END AS parse_error
FROM fx_started l""")

cte("fx_extracted", """
SELECT c.run_id, c.seed_id,
       CASE WHEN c.doc_id % 41 = 0 AND c.doc_id % 13 <> 0 THEN c.domain ELSE upper(c.domain) END AS domain,
       c.pos, c.concept_name,
       CASE WHEN c.doc_id % 47 = 0 AND c.pos = 0 THEN 'Other' ELSE c.concept_type END AS concept_type,
       c.concept_definition, c.doc_id % 41 = 0 AND c.doc_id % 13 <> 0 AS domain_from_ledger, c.concept_id
FROM fx_concepts c JOIN fx_draft_state s ON s.run_id = c.run_id
WHERE s.reason IS NULL""")

cte("fx_batch_fault", f"""
SELECT *, {H('batch_id')} % 50 AS f, max(slot) OVER (PARTITION BY batch_id) AS last_slot FROM fx_batches""")

cte("fx_aligned", f"""
SELECT batch_id, slot, concept_id, concept_type, format, audience, angle, cognitive_operation,
       CASE WHEN f = 4 OR (f = 0 AND slot = last_slot) THEN NULL
            ELSE {H('concept_id', 'format', 'audience', 'angle', 'cognitive_operation')} % 100 < 40 END AS is_valid,
       CASE WHEN f = 4 OR (f = 0 AND slot = last_slot) THEN NULL
            WHEN f = 3 THEN 'Parse error fallback' ELSE 'reason for ' || slot END AS reason,
       CASE WHEN f = 4 THEN 'unparsable' WHEN f = 0 AND slot = last_slot THEN 'missing_slot' ELSE 'ok' END AS outcome
FROM fx_batch_fault
UNION ALL
SELECT batch_id, cast(max(slot) + 1 AS integer), NULL, NULL, NULL, NULL, NULL, NULL, true, 'extra', 'extra_id'
FROM fx_batch_fault WHERE f = 5 GROUP BY batch_id""")

cte("fx_dd", f"""
SELECT concept_id, run_id, seed_id, domain, concept_name, concept_type, concept_definition, pos,
       {pstrip(pstrip("coalesce(concept_name, '')") + " || ' ' || " + pstrip("coalesce(concept_definition, '')"))} AS dedup_text,
       seed_id || chr(1) || run_id || chr(1) || lpad(cast(pos AS varchar), 5, '0') AS order_key
FROM fx_concepts""")

# grams from a list of characters: substr() would walk every text from its start for each gram
_GRAMS = """
SELECT concept_id, list_distinct(list_transform(range(1, len(ch) - 1), lambda i: ch[i] || ch[i + 1] || ch[i + 2])) AS grams
FROM (SELECT concept_id, regexp_extract_all(lower(dedup_text), '(?s).') AS ch FROM {})"""
cte("fx_shl", _GRAMS.format("fx_dd"))
cte("fx_sh", "SELECT concept_id, unnest(grams) AS s FROM fx_shl")

cte("fx_reps", """
SELECT * FROM (SELECT d.*, row_number() OVER (PARTITION BY domain, dedup_text ORDER BY order_key) AS rn
               FROM fx_dd d WHERE concept_id IN (SELECT concept_id FROM fx_sh)) WHERE rn = 1""")

cte("fx_perm", f"""
SELECT k, {H("'a'", 'k')} % 2147483646 + 1 AS a, {H("'b'", 'k')} % 2147483647 AS b FROM range(0, 128) t(k)""")

cte("fx_sig", f"""
SELECT h.concept_id, p.k, min((p.a * h.hv + p.b) % 2147483647) AS v
FROM (SELECT concept_id, {H('s')} % 2147483647 AS hv FROM fx_sh
      WHERE concept_id IN (SELECT concept_id FROM fx_reps)) h, fx_perm p
GROUP BY h.concept_id, p.k""")

cte("fx_band", f"""
SELECT r.concept_id, r.domain, r.order_key, g.band,
       {H('g.str', 'g.band')} AS bucket
FROM (SELECT concept_id, k // 5 AS band, string_agg(cast(v AS varchar), ',' ORDER BY k) AS str
      FROM fx_sig WHERE k < 125 GROUP BY concept_id, k // 5) g
JOIN fx_reps r USING (concept_id)""")

cte("fx_cand", """
SELECT DISTINCT x.concept_id AS a, y.concept_id AS b
FROM fx_band x JOIN fx_band y ON x.domain = y.domain AND x.band = y.band AND x.bucket = y.bucket
 AND x.order_key < y.order_key""")

cte("fx_jac", """
SELECT c.a, c.b, i.n * 1.0 / (na.n + nb.n - i.n) AS jaccard
FROM fx_cand c
JOIN (SELECT concept_id, count(*) AS n FROM fx_sh GROUP BY 1) na ON na.concept_id = c.a
JOIN (SELECT concept_id, count(*) AS n FROM fx_sh GROUP BY 1) nb ON nb.concept_id = c.b
JOIN (SELECT c2.a, c2.b, count(*) AS n FROM fx_cand c2
      JOIN fx_sh x ON x.concept_id = c2.a JOIN fx_sh y ON y.concept_id = c2.b AND y.s = x.s
      GROUP BY 1, 2) i ON i.a = c.a AND i.b = c.b""")

cte("fx_vecn", """
SELECT id, list_transform(v, lambda x: x / greatest(sqrt(list_dot_product(v, v)), 1e-10)) AS nv FROM (
  SELECT vec_id AS id, cast(embedding AS DOUBLE[]) AS v FROM embeddings)""")

cte("fx_planted", """
SELECT id, list_transform(v, lambda x: x / greatest(sqrt(list_dot_product(v, v)), 1e-10)) AS nv FROM (
  SELECT vec_id AS id, cast(embedding AS DOUBLE[]) AS v FROM embeddings
  UNION ALL
  SELECT 1000000 + vec_id, list_transform(cast(embedding AS DOUBLE[]),
         lambda x, i: CASE WHEN i - 1 = vec_id % 64 THEN x + 0.2 * (1 + vec_id % 3) ELSE x END)
  FROM embeddings WHERE vec_id % 5 = 0)""")

cte("fx_stage", f"""
SELECT s.run_id, t.stage, {H('s.run_id', 't.stage')} % 100 < 85 AS passed
FROM fx_started s, (VALUES {vals(list(enumerate(vocab.GATE_STAGES)))}) t(si, stage)
WHERE NOT ({H('s.run_id')} % 40 = 0 AND t.si = {H('s.run_id')} % 5)""")

cte("fx_pivot", "SELECT run_id, " + ", ".join(
    f"bool_or(passed) FILTER (WHERE stage = '{s}') AS {s}" for s in vocab.GATE_STAGES)
    + " FROM fx_stage GROUP BY run_id")

cte("fx_fest", """
SELECT DISTINCT n.n_name AS region, p.p_brand AS value
FROM nation n JOIN part p ON p.p_partkey % 25 = n.n_nationkey""")

"""Independent DuckDB statements, one per registered query (same column names)."""

from __future__ import annotations

from oracle.fixtures import H, pstrip, with_ctes

SQL: dict[str, str] = {}

RULE_TYPE = ("CASE WHEN {t} IN (SELECT concept_type FROM fx_rules) THEN {t} ELSE '*' END")

COMBO_LINE = "slot || ': ' || format || ', ' || audience || ', ' || angle || ', ' || cognitive_operation"


def sql(name: str, text: str) -> None:
    SQL[name] = with_ctes(text)


# ------------------------------------------------------------------ combos
sql("combo_product", """
SELECT t.concept_type, f.value AS format, a.value AS audience, g.value AS angle, o.value AS cognitive_operation
FROM (SELECT DISTINCT concept_type FROM fx_concepts) t, fx_dims f, fx_dims a, fx_dims g, fx_dims o
WHERE f.dim = 'format' AND a.dim = 'audience' AND g.dim = 'angle' AND o.dim = 'cognitive_operation'""")

sql("combo_prune", f"""
SELECT t.concept_type, s.format, s.audience, s.angle, s.cognitive_operation
FROM (SELECT DISTINCT concept_type FROM fx_concepts) t
JOIN fx_space s ON s.rule_type = {RULE_TYPE.format(t='t.concept_type')}""")

sql("combo_sample", """
SELECT concept_id, format, audience, angle, cognitive_operation, combo_id, cast(sample_rank AS integer) AS sample_rank
FROM fx_sample""")

sql("scan_validity_done", f"""
SELECT run_id, concept_name, format, audience, angle, cognitive_operation, is_valid, reason
FROM fx_done WHERE {pstrip('is_valid')} <> ''""")

sql("combo_resume", """
SELECT concept_id, format, audience, angle, cognitive_operation, cast(sample_rank AS integer) AS sample_rank,
       cast((rn - 1) // 10 AS integer) AS batch_no, cast((rn - 1) % 10 AS integer) AS slot
FROM (SELECT s.*, row_number() OVER (PARTITION BY s.concept_id ORDER BY s.sample_rank) AS rn
      FROM fx_sample s
      WHERE NOT EXISTS (SELECT 1 FROM fx_done d
                        WHERE d.is_valid <> '' AND d.concept_id = s.concept_id AND d.format = s.format
                          AND d.audience = s.audience AND d.angle = s.angle
                          AND d.cognitive_operation = s.cognitive_operation))""")

sql("micro_batch", f"""
SELECT batch_id, concept_id, batch_no, cast(count(*) AS integer) AS batch_size,
       string_agg({COMBO_LINE}, chr(10) ORDER BY slot) AS combos_text
FROM fx_batches GROUP BY batch_id, concept_id, batch_no""")

sql("render_validity_prompt", f"""
SELECT batch_id,
       'Field: ' || domain || '. The ' || concept_type || ' "' || concept_name || '" means: ' || concept_definition || chr(10) ||
       'Say of each of these ' || count(*) || ' plans for a text about it whether it would work.' || chr(10) ||
       string_agg({COMBO_LINE}, chr(10) ORDER BY slot) AS prompt
FROM fx_batches GROUP BY batch_id, domain, concept_name, concept_type, concept_definition""")

sql("model_route", f"""
SELECT CASE WHEN {H('batch_id')} % 10000 < 6000 THEN 'model_a' ELSE 'model_b' END AS model,
       count(*) AS requests
FROM (SELECT DISTINCT batch_id FROM fx_batches) GROUP BY 1""")

sql("fixed_batches", """
SELECT seed_id, domain, cast((rn - 1) // 32 AS integer) AS batch_no, cast((rn - 1) % 32 AS integer) AS slot
FROM (SELECT seed_id, domain, row_number() OVER (PARTITION BY domain ORDER BY doc_id) AS rn FROM fx_seeds)""")

sql("work_estimate", f"""
WITH pool AS (SELECT rule_type, count(*) AS pool FROM fx_space GROUP BY 1),
     dn AS (SELECT concept_id, count(*) AS done FROM fx_done WHERE is_valid <> '' GROUP BY 1),
     per AS (SELECT c.domain, least(p.pool, 700) AS planned, coalesce(dn.done, 0) AS done
             FROM fx_concepts c
             JOIN pool p ON p.rule_type = {RULE_TYPE.format(t='c.concept_type')}
             LEFT JOIN dn ON dn.concept_id = c.concept_id)
SELECT domain, count(*) AS concepts, sum(planned)::bigint AS planned, sum(done)::bigint AS done,
       sum(greatest(planned - done, 0))::bigint AS remaining,
       sum(ceil(greatest(planned - done, 0) / 10))::bigint AS calls
FROM per GROUP BY domain""")

sql("rule_count", """
SELECT c.concept_type, c.n_concepts, coalesce(r.n_rules, 0) AS n_rules
FROM (SELECT concept_type, count(*) AS n_concepts FROM fx_concepts GROUP BY 1) c
LEFT JOIN (SELECT concept_type, count(*) AS n_rules FROM fx_rules GROUP BY 1) r USING (concept_type)""")

sql("prune_yield", f"""
SELECT c.concept_type, count(*) AS n_concepts, max(p.pool) AS pool_per_concept,
       sum(p.pool)::bigint AS pool_total, sum(least(p.pool, 700))::bigint AS sampled_total
FROM fx_concepts c
JOIN (SELECT rule_type, count(*) AS pool FROM fx_space GROUP BY 1) p
  ON p.rule_type = {RULE_TYPE.format(t='c.concept_type')}
GROUP BY c.concept_type""")

# --------------------------------------------------------------- extraction
sql("scan_seed_ids", f"""
SELECT {pstrip('value')} AS seed_id FROM fx_seed_lines WHERE {pstrip('value')} <> ''""")

sql("scan_runs_started", """
SELECT run_id, seed_id, domain, target_concepts_range FROM fx_started""")

sql("scan_drafts", """
SELECT layout, run_id, CASE WHEN doc_id % 29 = 0 THEN 0 ELSE 1 END AS n_drafts,
  doc_id % 29 <> 0 AND (doc_id % 17 = 0 OR doc_id % 19 = 0 OR doc_id % 23 <> 0) AS has_response
FROM fx_draft_state, (VALUES ('parquet'), ('json')) t(layout) WHERE has_draft""")

sql("scan_embeddings", """
SELECT cast(vec_id AS varchar) AS concept_id, cast(len(embedding) AS integer) AS dims, cast(embedding[1] AS double) AS first, cast(embedding[-1] AS double) AS last
FROM embeddings""")

_SAID = "string_agg(upper(role[1]) || lower(role[2:]) || ': ' || regexp_replace(text, '^(\\\\*(?:User|Assistant|System): )', '\\\\\\1', 'gm'), chr(10) ORDER BY turn)"
sql("scan_templates", f"""
SELECT conv_id, 'turns' || count(*) AS family, 'Write for {{{{ seed.language }}}} readers.' || chr(10) || {_SAID} || chr(10) || '{{style}} {{{{seed.language}}}}' AS template,
  'seed.language,style' AS placeholders
FROM conversations GROUP BY conv_id""")

sql("ledger_status", """
SELECT seed_id, CASE WHEN doc_id % 10 = 0 THEN NULL ELSE md5('run|' || seed_id) END AS run_id,
       CASE WHEN doc_id % 10 = 0 THEN 'FAILED_CREATE' WHEN doc_id % 10 = 1 THEN 'FAILED_START'
            ELSE 'STARTED' END AS status
FROM fx_seeds""")

sql("target_range", """
SELECT s.seed_id, s.domain, cast(split_part(r.target_concepts_range, '-', 1) AS integer) AS target_min,
       cast(split_part(r.target_concepts_range, '-', 2) AS integer) AS target_max,
       r.domain IS NOT NULL AS range_ok
FROM fx_seeds s LEFT JOIN fx_ranges r ON r.domain = s.domain""")

sql("seed_by_range", """
SELECT s.seed_id, s.domain, r.target_concepts_range,
       cast(split_part(r.target_concepts_range, '-', 1) AS integer) AS target_min,
       cast(split_part(r.target_concepts_range, '-', 2) AS integer) AS target_max
FROM fx_seeds s JOIN fx_ranges r ON r.domain = s.domain""")

sql("join_runs_drafts", "SELECT run_id, seed_id, has_draft FROM fx_draft_state")

sql("parse_json_strict", """
SELECT run_id, parse_error IS NULL AS ok, parse_error AS error FROM fx_draft_state WHERE has_draft""")

sql("explode_concepts", """
SELECT run_id, seed_id, domain, pos, concept_name, concept_type, concept_definition FROM fx_extracted""")

sql("concept_fields", "SELECT run_id, pos, domain, domain_from_ledger FROM fx_extracted")

sql("sink_rejects", """
SELECT 'extraction' AS stage, run_id AS key, reason FROM fx_draft_state WHERE reason IS NOT NULL""")

sql("v_concepts", """
SELECT run_id, n_concepts, array_to_string(list_filter([
         CASE WHEN n_concepts < 1 OR n_concepts > hi THEN 'count_out_of_range' END,
         CASE WHEN doc_id % 47 = 0 AND n_concepts > 0 THEN 'bad_type' END,
         CASE WHEN doc_id % 53 = 0 THEN 'missing_summary' END], lambda x: x IS NOT NULL), ',') AS violations,
       NOT (n_concepts < 1 OR n_concepts > hi OR (doc_id % 47 = 0 AND n_concepts > 0) OR doc_id % 53 = 0) AS passed
FROM (SELECT s.run_id, s.doc_id, cast(s.doc_id % 6 AS integer) AS n_concepts,
             cast(split_part(r.target_concepts_range, '-', 2) AS integer) AS hi
      FROM fx_draft_state s JOIN fx_ranges r ON r.domain = s.domain
      WHERE s.has_draft AND s.parse_error IS NULL)""")

sql("concept_counts", """
SELECT domain, count(*) AS concepts, count(DISTINCT seed_id) AS seeds FROM fx_extracted GROUP BY domain""")

sql("ledger_status_counts", f"""
SELECT domain, {pstrip('status')} AS status, count(*) AS runs
FROM fx_ledger GROUP BY 1, 2""")

sql("concepts_in_range", """
SELECT s.run_id, coalesce(e.n, 0) AS n_concepts,
       coalesce(e.n, 0) BETWEEN cast(split_part(r.target_concepts_range, '-', 1) AS integer)
                            AND cast(split_part(r.target_concepts_range, '-', 2) AS integer) AS in_range
FROM fx_started s JOIN fx_ranges r ON r.domain = s.domain
LEFT JOIN (SELECT run_id, count(*) AS n FROM fx_extracted GROUP BY 1) e ON e.run_id = s.run_id""")

# ----------------------------------------------------------------- verdicts
sql("join_verdict_align", """
SELECT batch_id, slot, concept_id, format, audience, angle, cognitive_operation, is_valid, reason, outcome
FROM fx_aligned""")

sql("verdict_default", """
SELECT batch_id, slot, is_valid, reason FROM fx_aligned WHERE reason = 'Parse error fallback'""")

sql("strip_code_fence", f"""
SELECT DISTINCT batch_id, {H('batch_id', "'fence'")} % 11 = 0 AS fenced, f <> 4 AS ok FROM fx_batch_fault""")

sql("v_validity", """
SELECT DISTINCT batch_id,
       CASE f WHEN 4 THEN 'unparsable' WHEN 0 THEN 'missing_id' WHEN 5 THEN 'unknown_id'
              WHEN 3 THEN 'missing_reason' ELSE '' END AS violations,
       f NOT IN (0, 3, 4, 5) AS passed
FROM fx_batch_fault""")

sql("valid_filter", """
SELECT concept_id, format, audience, angle, cognitive_operation FROM fx_aligned
WHERE outcome = 'ok' AND is_valid""")

sql("run_counters", "SELECT outcome, count(*) AS combos FROM fx_aligned GROUP BY outcome")

sql("verdict_rate", """
SELECT dim, value, count(*) AS answered, sum(cast(is_valid AS integer))::bigint AS valid,
       round(sum(cast(is_valid AS integer)) / count(*), 4) AS valid_rate
FROM (SELECT 'concept_type' AS dim, concept_type AS value, is_valid FROM fx_aligned WHERE outcome = 'ok'
      UNION ALL SELECT 'format', format, is_valid FROM fx_aligned WHERE outcome = 'ok'
      UNION ALL SELECT 'audience', audience, is_valid FROM fx_aligned WHERE outcome = 'ok'
      UNION ALL SELECT 'angle', angle, is_valid FROM fx_aligned WHERE outcome = 'ok'
      UNION ALL SELECT 'cognitive_operation', cognitive_operation, is_valid FROM fx_aligned WHERE outcome = 'ok')
GROUP BY dim, value""")


# -------------------------------------------------------------------- dedup
def greedy(nodes: str, edges: str, select: str = "SELECT gn.grp, gn.id") -> str:
    """Sequential keep-first as a recursive CTE: walk rows in order per group,
    carrying the kept list; a row is kept unless an earlier neighbour is kept.
    ``nodes``: grp, id, ord. ``edges``: grp, a, b (a earlier than b)."""
    return f"""
WITH RECURSIVE gall AS MATERIALIZED (SELECT grp, id, ord FROM ({nodes})),
gedge AS MATERIALIZED ({edges}),
gn AS MATERIALIZED (SELECT grp, id, row_number() OVER (PARTITION BY grp ORDER BY ord) AS rn FROM gall
       WHERE id IN (SELECT a FROM gedge UNION ALL SELECT b FROM gedge)),
nbr AS MATERIALIZED (SELECT e.grp, nb.rn, list(na.rn) AS earlier FROM gedge e
       JOIN gn na ON na.grp = e.grp AND na.id = e.a JOIN gn nb ON nb.grp = e.grp AND nb.id = e.b GROUP BY e.grp, nb.rn),
gmax AS MATERIALIZED (SELECT grp, max(rn) AS mx FROM gn GROUP BY grp),
walk(grp, rn, kept) AS (
  SELECT grp, cast(0 AS bigint), cast([] AS bigint[]) FROM gmax
  UNION ALL
  SELECT w.grp, w.rn + 1,
         CASE WHEN list_has_any(w.kept, coalesce(n.earlier, cast([] AS bigint[]))) THEN w.kept
              ELSE list_append(w.kept, w.rn + 1) END
  FROM walk w JOIN gmax m ON m.grp = w.grp AND w.rn < m.mx
  LEFT JOIN nbr n ON n.grp = w.grp AND n.rn = w.rn + 1),
kept AS (SELECT gn.grp, gn.id FROM (SELECT w.grp, unnest(w.kept) AS rn FROM walk w
                                    JOIN gmax m ON m.grp = w.grp AND w.rn = m.mx) k
         JOIN gn ON gn.grp = k.grp AND gn.rn = k.rn
         UNION ALL SELECT grp, id FROM gall WHERE id NOT IN (SELECT id FROM gn))
"""


sql("dedup_text", "SELECT concept_id, dedup_text FROM fx_dd")

sql("dedup_exact", """
SELECT concept_id, domain FROM (
  SELECT concept_id, domain, row_number() OVER (PARTITION BY domain, dedup_text ORDER BY order_key) AS rn FROM fx_dd)
WHERE rn = 1""")

sql("char_shingles", "SELECT concept_id, cast(coalesce(len(grams), 0) AS integer) AS n_shingles FROM fx_shl")

sql("minhash_signature", """
SELECT concept_id, string_agg(cast(v AS varchar), ',' ORDER BY k) AS sig FROM fx_sig GROUP BY concept_id""")

sql("lsh_candidates", "SELECT a, b FROM fx_cand")

sql("jaccard_verify", "SELECT a, b FROM fx_jac WHERE jaccard >= 0.5")

MINHASH_KEPT = greedy(
    "SELECT domain AS grp, concept_id AS id, order_key AS ord FROM fx_reps",
    "SELECT r.domain AS grp, j.a, j.b FROM fx_jac j JOIN fx_reps r ON r.concept_id = j.a WHERE j.jaccard >= 0.5")
MINHASH_ALL = ("mh AS (SELECT id AS concept_id FROM kept UNION ALL "
               "SELECT concept_id FROM fx_dd WHERE concept_id NOT IN (SELECT concept_id FROM fx_sh))")

sql("dedup_minhash", MINHASH_KEPT + "," + MINHASH_ALL + """
SELECT d.concept_id, d.domain FROM fx_dd d JOIN mh USING (concept_id)""")

sql("join_seed_lost", MINHASH_KEPT + "," + MINHASH_ALL + """
SELECT DISTINCT seed_id FROM fx_dd
WHERE seed_id NOT IN (SELECT d.seed_id FROM fx_dd d JOIN mh USING (concept_id))""")

sql("dedup_summary", MINHASH_KEPT + "," + MINHASH_ALL + """,
ex AS (SELECT concept_id FROM (SELECT concept_id, row_number() OVER (PARTITION BY domain, dedup_text
                                                                    ORDER BY order_key) AS rn FROM fx_dd) WHERE rn = 1),
res AS (SELECT 'exact' AS method, d.seed_id FROM fx_dd d JOIN ex USING (concept_id)
        UNION ALL SELECT 'minhash', d.seed_id FROM fx_dd d JOIN mh USING (concept_id)),
per AS (SELECT method, seed_id, count(*) AS c FROM res GROUP BY 1, 2)
SELECT method, cast(sum(c) AS bigint) AS kept, cast((SELECT count(*) FROM fx_dd) - sum(c) AS bigint) AS removed,
       cast((SELECT count(DISTINCT seed_id) FROM fx_dd) - count(*) AS bigint) AS seeds_lost,
       median(c) AS median_per_seed
FROM per GROUP BY method""")

COS_PAIRS = "SELECT x.id AS a, y.id AS b, list_dot_product(x.nv, y.nv) AS sim FROM {t} x JOIN {t} y ON x.id < y.id"

sql("cosine_pairs", f"SELECT a, b FROM ({COS_PAIRS.format(t='fx_vecn')}) WHERE sim >= 0.30")

sql("greedy_keep_first", greedy(
    "SELECT 1 AS grp, id, id AS ord FROM fx_vecn",
    f"SELECT 1 AS grp, a, b FROM ({COS_PAIRS.format(t='fx_vecn')}) WHERE sim >= 0.30") + """
SELECT id AS vec_id FROM kept""")

sql("dedup_semantic", greedy(
    "SELECT 1 AS grp, id, id AS ord FROM fx_planted",
    f"SELECT 1 AS grp, a, b FROM ({COS_PAIRS.format(t='fx_planted')}) WHERE sim >= 0.90") + """
SELECT id AS vec_id FROM kept""")

sql("dedup_sweep", greedy(
    "SELECT t.label AS grp, p.id, p.id AS ord FROM fx_planted p, "
    "(VALUES ('0.80'), ('0.90'), ('0.95')) t(label)",
    f"SELECT t.label AS grp, a, b FROM ({COS_PAIRS.format(t='fx_planted')}) c, "
    "(VALUES ('0.80', 0.80), ('0.90', 0.90), ('0.95', 0.95)) t(label, th) WHERE c.sim >= t.th") + """
SELECT grp AS label, count(*) AS kept FROM kept GROUP BY grp""")


# ------------------------------------------------------------------- gates
from seedmill.functions import vocab as _v  # noqa: E402
from oracle.fixtures import vals as _vals  # noqa: E402

sql("gate_pivot", "SELECT * FROM fx_pivot")

sql("gate_accept", "SELECT run_id, " + " AND ".join(f"coalesce({s}, false)" for s in _v.GATE_STAGES)
    + " AS accepted FROM fx_pivot")

_alive = []
_fun = []
for _i, _s in enumerate(_v.GATE_STAGES):
    _entered = " AND ".join(_alive) if _alive else "true"
    _alive.append(f"coalesce({_s}, false)")
    _fun.append(f"SELECT {_i} AS step, '{_s}' AS stage, cast(sum(CASE WHEN {_entered} THEN 1 ELSE 0 END) AS bigint) AS entered, "
                f"cast(sum(CASE WHEN {' AND '.join(_alive)} THEN 1 ELSE 0 END) AS bigint) AS passed FROM fx_pivot")
sql("gate_funnel", " UNION ALL ".join(_fun))

sql("term_screen", """
SELECT doc_id, array_to_string(list_filter([
  CASE WHEN regexp_matches(text, '(?i)\\bMIT License\\b') THEN 'MIT License' END,
  CASE WHEN regexp_matches(text, '(?i)\\bApache License\\b') THEN 'Apache License' END,
  CASE WHEN regexp_matches(text, '(?i)\\bLicensed\\b') THEN 'Licensed' END], lambda x: x IS NOT NULL), ',') AS terms_found
FROM documents
WHERE regexp_matches(text, '(?i)\\bMIT License\\b') OR regexp_matches(text, '(?i)\\bApache License\\b')
   OR regexp_matches(text, '(?i)\\bLicensed\\b')""")

sql("safety_scores", """
SELECT s.seed_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic, l.doc_id IS NOT NULL AS scored,
       coalesce(l.quality >= 1, false) AND coalesce(l.toxic <= 0, false) AS safe
FROM fx_seeds s LEFT JOIN labels l ON l.doc_id = s.doc_id""")

# ------------------------------------------------------- fan-out, rendering
sql("render_seed_default", "SELECT seed_id, coalesce(nullif(ground_truth, ''), 'not provided') AS ground_truth FROM fx_seeds")

sql("render_tag", """
SELECT seed_id, coalesce(nullif(tags[1], ''), 'general') AS tag0, coalesce(nullif(tags[2], ''), 'any') AS tag1
FROM fx_seeds""")

sql("render_prompt", """
SELECT seed_id, 'Language: ' || language || ' | Tag: ' || coalesce(nullif(tags[1], ''), 'general') ||
       ' | Domain: ' || domain || chr(10) || text AS prompt FROM fx_seeds""")

sql("fanout_single", """
SELECT c.concept_id, t.task FROM fx_concepts c, (VALUES ('analogy'), ('misconception'), ('qa_concept')) t(task)""")

sql("fanout_pairs", """
SELECT 'unordered' AS kind, a.seed_id, a.concept_id AS concept_id_a, b.concept_id AS concept_id_b
FROM fx_concepts a JOIN fx_concepts b ON a.seed_id = b.seed_id AND a.pos < b.pos
UNION ALL
SELECT 'ordered', a.seed_id, a.concept_id, b.concept_id
FROM fx_concepts a JOIN fx_concepts b ON a.seed_id = b.seed_id AND a.pos <> b.pos""")

_DESC = " ".join(
    f"JOIN (SELECT value, description AS {d}_description FROM fx_descriptions WHERE dim = '{d}') d_{d} ON d_{d}.value = v.{d}"
    for d in _v.DIMENSIONS)
_VALID = ("(SELECT a.concept_id, a.format, a.audience, a.angle, a.cognitive_operation, c.concept_name, "
          "c.concept_definition FROM fx_aligned a JOIN fx_concepts c USING (concept_id) "
          "WHERE a.outcome = 'ok' AND a.is_valid) v")

sql("join_descriptions", f"""
SELECT v.concept_id, v.format, v.audience, v.angle, v.cognitive_operation, format_description,
       audience_description, angle_description, cognitive_operation_description
FROM {_VALID} {_DESC}""")

_GEN = ("'Write a ' || v.format || ' (' || format_description || ') for a ' || v.audience || ' reader (' || "
        "audience_description || '), taking the ' || v.angle || ' angle (' || angle_description || "
        "') and asking them to ' || v.cognitive_operation || ' (' || cognitive_operation_description || "
        "'). Concept: ' || v.concept_name || '. ' || v.concept_definition")

sql("generation_requests", f"""
SELECT v.concept_id, v.format, v.audience, v.angle, v.cognitive_operation, {_GEN} AS prompt
FROM {_VALID} {_DESC}""")

_SCEN = f"""
SELECT concept_id, slot, 'Scenario: ' || line AS prompt FROM (
  SELECT c.concept_id, cast(i AS integer) AS slot, {pstrip('string_split(s.text, chr(10))[i + 1]')} AS line
  FROM fx_concepts c JOIN fx_seeds s USING (seed_id),
       LATERAL (SELECT unnest(range(0, len(string_split(s.text, chr(10))))) AS i))
WHERE line <> ''"""

sql("scenario_requests", _SCEN)

sql("union_requests", f"""
SELECT 'combo' AS kind, v.concept_id, {_GEN} AS prompt FROM {_VALID} {_DESC}
UNION ALL SELECT 'scenario', concept_id, prompt FROM ({_SCEN})""")

sql("rephrase_requests", """
SELECT s.seed_id, o.operator, t.style FROM fx_seeds s,
 (VALUES ('simplify'), ('formalize'), ('summarize')) o(operator),
 (VALUES ('textbook'), ('conversational'), ('news')) t(style)""")

sql("cot_requests", """
SELECT s.seed_id, r.reasoning_style, t.topology FROM fx_seeds s,
 (VALUES ('deductive'), ('abductive')) r(reasoning_style), (VALUES ('chain'), ('tree')) t(topology)""")

sql("translate_requests", """
SELECT s.seed_id, t.target_language, lower(s.language) = lower(t.target_language) AS low_quality
FROM fx_seeds s, (VALUES ('en'), ('fr'), ('de'), ('es'), ('hi')) t(target_language)""")

sql("rotate_exhaust", f"""
SELECT seed_id, rk AS rotation_rank,
       (SELECT list(r_name ORDER BY r_regionkey) FROM region)[rk % (SELECT count(*) FROM region) + 1] AS value
FROM (SELECT seed_id, row_number() OVER (ORDER BY {H('seed_id')}, seed_id) - 1 AS rk FROM fx_seeds)""")

sql("rotate_region", """
SELECT s.seed_id, n.n_name AS region, f.variable, f.value
FROM fx_seeds s JOIN nation n ON n.n_nationkey = s.doc_id % 25 JOIN (
  SELECT DISTINCT p_partkey % 25 AS k, 'festival' AS variable, p_brand AS value FROM part
  UNION ALL SELECT DISTINCT p_partkey % 25, 'preservation_method', p_type FROM part) f ON f.k = n.n_nationkey""")

sql("scan_rotation", """
SELECT 'regions' AS variable, NULL AS region, cast(row_number() OVER (ORDER BY n_nationkey) - 1 AS integer) AS pos,
       n_name AS value FROM nation
UNION ALL
SELECT 'audiences', NULL, cast(row_number() OVER (ORDER BY r_regionkey) - 1 AS integer), r_name FROM region
UNION ALL
SELECT 'festivals_by_region', region, cast(row_number() OVER (PARTITION BY region ORDER BY value) - 1 AS integer),
       value FROM fx_fest""")

sql("stream_progress_batch", """
SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, event_type, count(*) AS n
FROM events GROUP BY 1, 2""")

# --------------------------------------------------------------- curriculum
_CHN = """(SELECT 'book ' || o_custkey AS topic, cast(CASE WHEN o_custkey % 9 = 3 AND c = n THEN c + 1 ELSE c END AS integer) AS chapter,
    CASE WHEN o_custkey % 5 = 1 AND c = 2 THEN first_name WHEN o_custkey % 7 = 2 AND c = n THEN 'Introduction' ELSE own END AS name
  FROM (SELECT o_custkey, row_number() OVER w AS c, count(*) OVER (PARTITION BY o_custkey) AS n, 'Order ' || o_orderkey AS own,
               'Order ' || first(o_orderkey) OVER w AS first_name FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)))"""

sql("v_chapters", f"""
SELECT topic, count(*) AS n_chapters, array_to_string(list_filter([
  CASE WHEN list_sort(list(chapter)) <> range(1, count(*) + 1) THEN 'bad_ids' END,
  CASE WHEN count(*) < 3 OR count(*) > 12 THEN 'count_out_of_range' END,
  CASE WHEN count(DISTINCT lower(name)) < count(*) THEN 'duplicate_name' END,
  CASE WHEN bool_or(name IN ('Introduction', 'Conclusion', 'Overview', 'Summary')) THEN 'generic_name' END],
  lambda x: x IS NOT NULL), ',') AS violations
FROM {_CHN} GROUP BY topic""")

sql("running_context", f"""
SELECT topic, chapter,
       coalesce(array_to_string(list(name) OVER (PARTITION BY topic ORDER BY chapter
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ', '), '') AS earlier,
       lag(name) OVER (PARTITION BY topic ORDER BY chapter) AS previous
FROM {_CHN}""")

sql("parse_dialogue", "SELECT conv_id, turn, role, text FROM conversations")

sql("v_dialogue_turns", """
WITH t AS (SELECT conv_id, turn, CASE WHEN conv_id % 5 = 1 AND turn = 1 THEN 'system' WHEN conv_id % 7 = 2 AND turn = 1 THEN 'user' ELSE role END AS role,
             trim(text) = '' AS empty FROM conversations),
u AS (SELECT *, role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS same FROM t)
SELECT conv_id, count(*) + CASE WHEN conv_id % 9 = 3 THEN 1 ELSE 0 END AS n_turns, array_to_string(list_filter([
  CASE WHEN conv_id % 9 = 3 THEN 'no_label' END, CASE WHEN bool_or(role = 'system') THEN 'unknown_speaker' END,
  CASE WHEN bool_or(empty) THEN 'empty_turn' END, CASE WHEN bool_or(coalesce(same, false)) THEN 'not_alternating' END], lambda x: x IS NOT NULL), ',') AS violations
FROM u GROUP BY conv_id""")

# ------------------------------------------------- evidence, reports, shapes
_EV = f"""(SELECT cast(doc_id AS varchar) AS seed_id, cast(doc_id AS varchar) || ':' || cast(k AS varchar) AS chunk_id,
           ({H("cast(doc_id AS varchar) || ':' || cast(k AS varchar)")} % 1000) / 1000.0 AS score
    FROM (SELECT doc_id, unnest(range(0, greatest(cast(ceil(length(text) / 200) AS bigint), 1))) AS k FROM documents))"""
_TOPK = f"""(SELECT * FROM (SELECT c.concept_id, e.chunk_id,
             cast(row_number() OVER (PARTITION BY c.concept_id ORDER BY e.score DESC, e.chunk_id) AS integer) AS rank
           FROM fx_concepts c JOIN {_EV} e USING (seed_id)) WHERE rank <= 3)"""

sql("topk_evidence", f"SELECT concept_id, rank, chunk_id FROM {_TOPK}")

sql("join_evidence", f"""
WITH ch AS (SELECT cast(doc_id AS varchar) AS seed_id, 'retrieved' AS source, cast(doc_id AS varchar) || ':' || k AS chunk_id,
        substr(text, (k * 200 + 1)::int, 200) AS chunk, ({H("cast(doc_id AS varchar) || ':' || cast(k AS varchar)")} % 1000) / 1000.0 AS score
    FROM (SELECT doc_id, text, unnest(range(0, greatest(cast(ceil(length(text) / 200) AS bigint), 1))) AS k FROM documents)
  UNION ALL SELECT seed_id, 'seed', 'truth', ground_truth, 0.995 FROM fx_seeds
  UNION ALL SELECT cast(page_id AS varchar), 'web', 'page ' || page_id, url, ({H("'page ' || cast(page_id AS varchar)")} % 1000) / 1000.0 FROM pages),
best AS (SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, source, chunk_id) AS rank FROM ch WHERE coalesce(chunk, '') <> ''
         QUALIFY row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, source, chunk_id) <= 4)
SELECT c.concept_id, coalesce(string_agg(source || '/' || chunk_id, ',' ORDER BY rank), '') AS evidence,
  coalesce(string_agg(chunk, chr(10) || chr(10) ORDER BY rank), '') AS evidence_text
FROM fx_concepts c LEFT JOIN best USING (seed_id) GROUP BY c.concept_id""")

sql("template_usage", f"""
WITH a AS (SELECT list(c_mktsegment ORDER BY c_mktsegment) AS names FROM (SELECT DISTINCT c_mktsegment FROM customer)),
s AS (SELECT seed_id, language, names[(row_number() OVER (ORDER BY {H('seed_id')}, seed_id) - 1) % len(names) + 1] AS value FROM fx_seeds, a)
SELECT t.task, s.language, s.value, count(*) AS requests
FROM fx_concepts c JOIN s USING (seed_id), (VALUES ('analogy'), ('misconception'), ('qa_concept')) t(task)
GROUP BY ROLLUP (t.task, s.language, s.value)""")

sql("word_count_target", f"""
SELECT seed_id, cast(CASE WHEN {pstrip('text')} = '' THEN 0
                          ELSE len(string_split_regex({pstrip('text')}, '\\s+')) END AS integer) AS words,
       CASE WHEN {pstrip('text')} = '' THEN 0 ELSE len(string_split_regex({pstrip('text')}, '\\s+')) END
         BETWEEN 300 AND 800 AS in_target
FROM fx_seeds""")

sql("answer_shape", """
SELECT cast(doc_id AS varchar) AS seed_id, doc_id % 43 = 0 AS rejected,
       doc_id % 43 <> 0 AND doc_id % 47 = 0 AS low_quality,
       doc_id % 43 <> 0 AND (doc_id % 47 = 0 OR doc_id % 5 <> 0) AS json_only
FROM documents""")

sql("scan_concepts", """
SELECT run_id, seed_id, domain, concept_name, concept_type, concept_definition, 6 AS layout FROM fx_concepts
UNION ALL
SELECT run_id, seed_id, domain, concept_name, NULL, concept_definition, 5 FROM fx_concepts""")

sql("scan_rules", f"""
SELECT t.concept_type, p.pool
FROM (SELECT DISTINCT concept_type FROM fx_concepts) t
JOIN (SELECT rule_type, count(*) AS pool FROM fx_space GROUP BY 1) p ON p.rule_type = {RULE_TYPE.format(t='t.concept_type')}""")

_WC = "CASE WHEN {x} = '' THEN 0 ELSE len(string_split_regex({x}, '\\s+')) END"
sql("amplification", f"""
WITH sw AS (SELECT domain, sum({_WC.format(x=pstrip('text'))}) AS seed_words FROM fx_seeds GROUP BY 1),
     ow AS (SELECT c.domain, sum({_WC.format(x=pstrip('r.prompt'))}) AS output_words
            FROM ({_SCEN}) r JOIN fx_concepts c USING (concept_id) GROUP BY 1)
SELECT sw.domain, cast(sw.seed_words AS bigint) AS seed_words, cast(coalesce(ow.output_words, 0) AS bigint) AS output_words,
       round(coalesce(ow.output_words, 0) / sw.seed_words, 4) AS ratio
FROM sw LEFT JOIN ow USING (domain)""")

sql("notation_conflicts", """
SELECT p_name AS symbol, count(DISTINCT p_type) AS meanings FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1""")

_SEC = """(SELECT conv_id, turn, chr(10) || CASE conv_id % 7
     WHEN 1 THEN 'Diagnosis:' || chr(10) || text || chr(10) || 'Safety:' || chr(10) || text
     WHEN 2 THEN 'Diagnosis:' || chr(10) || text || chr(10) || 'Safety:' || chr(10) || text || chr(10) || 'Steps:' || chr(10) || text
     WHEN 3 THEN 'Diagnosis:' || chr(10) || text || chr(10) || 'Steps:' || chr(10) || text || chr(10) || 'Safety:' || chr(10) || text || chr(10) || 'Safety:' || chr(10) || text
     ELSE 'Diagnosis:' || chr(10) || text || chr(10) || 'Steps:' || chr(10) || text || chr(10) || 'Safety:' || chr(10) || text END AS t
   FROM conversations)"""
_CNT = "(length(t) - length(replace(t, chr(10) || '{l}:', ''))) // length(chr(10) || '{l}:')"
_POS = "nullif(strpos(t, chr(10) || '{l}:'), 0)"
sql("v_sections", "SELECT conv_id, turn, array_to_string(list_filter([" + ", ".join(
    [f"CASE WHEN {_CNT.format(l=l)} = 0 THEN 'missing:{l}' END, CASE WHEN {_CNT.format(l=l)} > 1 THEN 'duplicate:{l}' END"
     for l in ["Diagnosis", "Steps", "Safety"]]) + """,
  CASE WHEN NOT (coalesce(""" + _POS.format(l="Diagnosis") + " < " + _POS.format(l="Steps") + """, true)
             AND coalesce(""" + _POS.format(l="Steps") + " < " + _POS.format(l="Safety") + """, true)) THEN 'out_of_order' END,
  CASE WHEN coalesce(strpos(t, chr(10) || 'Steps:') > 0 AND (strpos(t, chr(10) || 'Diagnosis:') = 0 OR strpos(t, chr(10) || 'Steps:') < strpos(t, chr(10) || 'Diagnosis:')), false)
         OR coalesce(strpos(t, chr(10) || 'Safety:') > 0 AND (strpos(t, chr(10) || 'Diagnosis:') = 0 OR strpos(t, chr(10) || 'Safety:') < strpos(t, chr(10) || 'Diagnosis:')), false)
       THEN 'first_not:Diagnosis' END], lambda x: x IS NOT NULL), ',') AS violations FROM """ + _SEC)

_LIST = "(SELECT list({c} ORDER BY o) FROM (SELECT DISTINCT {c}, {o} AS o FROM {t}))"
_LISTS = {"dietary": _LIST.format(c="p_type", o="p_type", t="part"), "audiences": _LIST.format(c="c_mktsegment", o="c_mktsegment", t="customer"),
          "regions": _LIST.format(c="n_name", o="n_nationkey", t="nation"), "languages": _LIST.format(c="lang", o="lang", t="documents")}
_TURN = {k: f"{v}[rk % len({v}) + 1]" for k, v in _LISTS.items()}
sql("rotate_bind", f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY {H('seed_id')}, seed_id) - 1 AS rk FROM fx_seeds),
g AS (SELECT n_name AS region, list_sort(list(DISTINCT p_brand)) AS festivals, list_sort(list(DISTINCT p_type)) AS methods
      FROM nation JOIN part ON p_partkey % 25 = n_nationkey GROUP BY n_name),
x AS (SELECT r.*, {_TURN['regions']} AS region, {_TURN['dietary']} AS dietary, {_TURN['audiences']} AS audience, {_TURN['languages']} AS target,
        rk // len({_LISTS['regions']}) AS again FROM r)
SELECT seed_id, task, array_to_string(CASE task
    WHEN 'C1' THEN [dietary] WHEN 'C14' THEN [dietary] WHEN 'C2' THEN CASE WHEN coalesce(ground_truth, '') = '' THEN [] ELSE [ground_truth] END
    WHEN 'C3' THEN tags WHEN 'C6' THEN tags WHEN 'C4' THEN [x.region] WHEN 'C9' THEN [x.region] WHEN 'C11' THEN [x.region]
    WHEN 'C5' THEN [['2', '4', '4', '6', '10'][rk % 5 + 1], ['4', '6', '10', '25', '50'][rk % 5 + 1]]
    WHEN 'C7' THEN [audience] WHEN 'C8' THEN [audience] WHEN 'C10' THEN [language, target]
    WHEN 'C12' THEN [festivals[again % len(festivals) + 1]] WHEN 'C13' THEN [methods[again % len(methods) + 1]] END, '|') AS tags
FROM x LEFT JOIN g ON g.region = x.region, (VALUES {", ".join(f"('C{i}')" for i in range(1, 15))}) t(task)""")

# JSON task contracts: the expected code follows from the key rule only
for _name, _codes in {
    "v_scenarios": "too_few too_many repeated empty_item too_long",
    "v_c1_substitution": "no_substitutions empty_field original_not_in_seed",
    "v_c2_diagnosis": "empty_diagnosis empty_scientific_reason empty_rescue_fix empty_prevention_tip",
    "v_c3_workflow": "no_prep bad_prep bad_step_type bad_time bad_numbering empty_step",
    "v_c4_pairing": "no_notes missing_side_dish missing_grain_bread",
    "v_c5_scaling": "empty_calculation wrong_multiplier unflagged_identity bad_adjustment empty_list",
    "v_c6_scraps": "no_scraps empty_mini_recipe empty_transformation same_dish",
    "v_c7_dialogue": "empty_persona bad_speaker empty_text no_error no_correction bad_ending",
    "v_c8_faq": "too_few_items too_many_items missing_storage missing_equipment missing_scaling empty_item",
    "v_c9_narrative": "empty_context empty_narrative missing_sense numbered_list table",
    "v_c10_translation": "empty_source wrong_target empty_translation lost_term unflagged_same",
    "v_c11_tradition": "empty_tradition too_few_markers no_techniques empty_note",
    "v_c12_festive": "festival_mismatch empty_anchor dish_count empty_dish missing_note no_serving_order",
    "v_c13_preservation": "method_mismatch empty_science bad_adjustment missing_storage_field empty_warning",
    "v_c14_nutrition": "too_few_ingredients empty_field incomplete_ayurvedic empty_assessment",
}.items():
    _all = ["", *_codes.split()]
    sql(_name, f"SELECT cast(doc_id AS varchar) AS seed_id, {_all}[doc_id % {len(_all)} + 1] AS violations FROM documents")

# household answers: the expected code follows from the key rule only
for _name, _codes in {
    "v_h5_schedule": ["no_task:Weekly", "missing_system:hvac", "untagged_item", "out_of_order"], "v_h6_budget": ["empty:Discretionary", "reserve_percent"],
    "v_h7_emergency": ["missing_number:101", "prevention_count", "missing:Hazard", "out_of_order,first_not:Phase 1 — Immediate (0-60 sec)"], "v_h12_costs": ["uncosted_item", "missing:Mould / Pest Note"],
    "v_h13_never": ["missing_sign:sound", "not_numbered", "too_few_never", "missing_number:1906"], "v_h14_myths": ["too_few_myths", "no_call", "out_of_order,first_not:Step 0 — First 30 seconds"],
    "v_h16_inaction": ["item_count", "missing_inaction"], "v_h17_budget": ["over_budget", "no_cost", "no_logic"],
    "v_h18_level": ["bad_level", "age_mismatch", "no_boundary"], "v_h20_final": ["no_hard_stop", "bad_final"],
    "v_dialogue_shape": ["bad_opening", "bad_closing", "unknown_speaker"], "v_dialogue_principles": ["bad_closing", "principles"],
    "v_h1_sections": ["missing:Indian Home Note", "duplicate:Indian Home Note", "out_of_order"],
    "v_h2_step0": ["missing:Local Note", "duplicate:Local Note", "out_of_order"],
    "v_h3_sections": ["missing:Indian Home Note", "duplicate:Indian Home Note", "out_of_order"],
    "v_h4_sections": ["missing:Hard-water note", "duplicate:Hard-water note", "out_of_order"],
    "v_h8_sections": ["missing:Indian Laundry Note", "duplicate:Indian Laundry Note", "out_of_order"],
    "v_h9_sections": ["missing:Immediate Declutter Rule", "duplicate:Immediate Declutter Rule", "out_of_order"],
    "v_h11_sections": ["missing:Indian Riding Note", "duplicate:Indian Riding Note", "out_of_order"],
    "v_h15_sections": ["missing:Pro-Tip", "duplicate:Pro-Tip", "out_of_order"],
}.items():
    _all = ["", *_codes]
    sql(_name, f"SELECT cast(doc_id AS varchar) AS seed_id, {_all}[doc_id % {len(_all)} + 1] AS violations FROM documents")

sql("validity_agreement", f"""
SELECT concept_type, count(*) AS shared,
       cast(sum(CASE WHEN {H("concept_id", "format", "audience", "angle", "cognitive_operation", "'b'")} % 7 = 0
                THEN 0 ELSE 1 END) AS bigint) AS agree
FROM fx_batches
WHERE {H('batch_id')} % 10 = 0
GROUP BY concept_type""")

# free-text answers: the expected code follows from the key rule only
for _name, _codes, _more in [
    ("parse_qa_pairs", ["preamble", "pair_count", "bad_numbering", "empty_part", "repeated_question"], ", CASE WHEN doc_id % 6 = 2 THEN 1 ELSE 2 END AS n_pairs"),
    ("v_cot_sets", ["preamble", "set_count", "empty_set", "repeated_question"], ""),
    ("v_content_block", ["no_block", "many_blocks", "outside_text", "empty_block"], ""),
    ("v_question_form", ["not_a_question", "no_answer", "labelled"], ""),
]:
    _all = ["", *_codes]
    sql(_name, f"SELECT cast(doc_id AS varchar) AS seed_id, {_all}[doc_id % {len(_all)} + 1] AS violations{_more} FROM documents")

sql("v_outline_flags", """
SELECT conv_id, cast(count(*) AS integer) AS units,
  cast(count(*) FILTER (turn % 3 <> 2 AND conv_id % 7 <> 0) AS integer) AS ok_units, cast(count(*) FILTER (turn % 3 = 2) AS integer) AS flagged_units,
  coalesce(string_agg(cast(n AS varchar), ',' ORDER BY n) FILTER (turn % 3 = 2), '') AS unresolved,
  array_to_string(list_filter([CASE WHEN count(*) FILTER (turn % 3 <> 2 AND conv_id % 7 = 0) > 0 THEN 'unmarked_unit' END,
    CASE WHEN count(*) FILTER (turn % 3 = 2) > 0 THEN 'unresolved' END], lambda x: x IS NOT NULL), ',') AS violations
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) GROUP BY conv_id""")

_T = "lower(regexp_replace(trim(text, chr(32) || chr(9) || chr(10) || chr(13)), '\\s+', ' ', 'g'))"
_W = f"' ' || regexp_replace({_T}, '[^\\p{{L}}\\p{{N}}'']+', ' ', 'g') || ' '"
sql("v_style_phrases", f"""
SELECT doc_id, array_to_string(list_filter([
  CASE WHEN contains({_W}, ' licensed under ') THEN 'label:licensed under' END,
  CASE WHEN regexp_matches({_T}, '^all rights reserved([^\\p{{L}}\\p{{N}}]|$)') THEN 'opener:all rights reserved' END,
  CASE WHEN regexp_matches({_T}, '^of the([^\\p{{L}}\\p{{N}}]|$)') THEN 'opener:of the' END,
  CASE WHEN regexp_matches({_T}, '^think of it as([^\\p{{L}}\\p{{N}}]|$)') THEN 'opener:think of it as' END,
  CASE WHEN contains({_W}, ' and the ') THEN 'reference:and the' END], lambda x: x IS NOT NULL), ',') AS found
FROM documents""")

# ------------------------------------------------------ curriculum trees
from oracle.book import BOOK  # noqa: E402

SQL.update(BOOK)

"""Concept extraction path: run ledger, target ranges, run/draft join, strict
parse of the model's JSON and one row per concept (P2, P3, P5, P14, P16, J1,
X8, X19, V1, K5).

Plan shape: one shuffle, on ``run_id``, to meet runs and drafts. Parsing,
exploding and checking are narrow (per row), JVM-side expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedmill.functions import vocab
from seedmill.functions.jsonparse import with_parsed
from seedmill.functions.text import py_strip, strip_code_fence

DRAFT_DDL = ("struct<domain:string,summary:string,"
             "concepts:array<struct<name:string,definition:string,type:string>>>")
MAX_RANGE_ROWS = 100_000


# P16 ------------------------------------------------------------------------
def ledger_status(calls: DataFrame) -> DataFrame:
    """Ledger rows from the run service's answers.

    ``calls`` has ``created_run_id`` (NULL when creation failed) and ``start_ok``.
    No id -> FAILED_CREATE (run_id NULL); started -> STARTED; else FAILED_START.
    """
    status = (F.when(F.col("created_run_id").isNull(), F.lit(vocab.STATUS_FAILED_CREATE))
              .when(F.coalesce(F.col("start_ok"), F.lit(False)), F.lit(vocab.STATUS_STARTED))
              .otherwise(F.lit(vocab.STATUS_FAILED_START)))
    return calls.withColumn("run_id", F.col("created_run_id")).withColumn("status", status)


# P2 -------------------------------------------------------------------------
def ranges_table(spark: SparkSession, ranges=None) -> DataFrame:
    return spark.createDataFrame(list(ranges or vocab.DOMAIN_RANGES), "domain string, target_concepts_range string")


def attach_range(df: DataFrame, ranges: DataFrame, strict: bool = False) -> DataFrame:
    """Domain -> ``target_concepts_range``, ``target_min``, ``target_max``.

    The range table is a parameter (one row per domain); the planner broadcasts it
    when it is small. Unknown domains raise in strict mode; otherwise ``range_ok`` is false.
    """
    r = ranges.select(F.col("domain").alias("_rd"), F.col("target_concepts_range").alias("_rr"))
    out = df.join(r, F.col("domain") == F.col("_rd"), "left")
    rng = F.col("_rr")
    if strict:
        rng = F.when(F.col("_rd").isNull(),
                     F.raise_error(F.concat(F.lit("domain not in range map: "), F.col("domain")))
                     ).otherwise(rng)
    parts = F.split(rng, "-")
    return (out.withColumn("target_concepts_range", rng)
            .withColumn("target_min", F.try_element_at(parts, F.lit(1)).try_cast("int"))
            .withColumn("target_max", F.try_element_at(parts, F.lit(2)).try_cast("int"))
            .withColumn("range_ok", F.col("_rd").isNotNull())
            .drop("_rd", "_rr"))


# P14 / X19 ------------------------------------------------------------------
def run_request_payload(stages=None) -> Column:
    """The nested run-creation request as JSON text."""
    stages = stages or [("teacher_a", "teacher-model"), ("auditor", "auditor-model"),
                        ("dean", "dean-model"), ("tool_verifier", "verifier-model"),
                        ("final_guardrail", "guard-model")]
    st = F.array(*[F.struct(F.lit(t).alias("type"), F.lit(m).alias("model")) for t, m in stages])
    return F.to_json(F.struct(
        F.col("seed_id").alias("seed_data_id"),
        F.lit("concept_extraction").alias("task_type"),
        F.lit(False).alias("is_thinking"),
        st.alias("prompt_template_ids"),
        F.struct(F.struct(F.col("domain").alias("domain"),
                          F.col("target_concepts_range").alias("target_concepts_range")
                          ).alias("request")).alias("custom_vars")))


def extraction_requests(seeds: DataFrame, ranges: DataFrame, strict: bool = False) -> DataFrame:
    """One extraction request per seed with its target range attached."""
    r = attach_range(seeds, ranges, strict)
    return r.withColumn("payload", run_request_payload())


# J1 / X8 / P3 / P5 -----------------------------------------------------------
def parse_drafts(runs: DataFrame, drafts: DataFrame, ddl: str = DRAFT_DDL) -> DataFrame:
    """J1 + P4 + P5: one row per STARTED run with its parsed first draft.

    Adds ``has_draft``, ``raw`` (first candidate response), ``parsed``
    (struct ok/value/error) and ``reason`` (NULL when usable):
    no_draft, no_drafts, null_input, empty, invalid_json, no_concepts.
    """
    d = drafts.select("run_id", "drafts")
    j = runs.join(d, "run_id", "left")
    raw = F.try_element_at(F.col("drafts"), F.lit(1))["teacher_output"]["candidate_response"]
    j = (j.withColumn("has_draft", F.col("drafts").isNotNull())
         .withColumn("raw", raw))
    j = with_parsed(j, strip_code_fence(F.col("raw")), ddl)
    n = F.coalesce(F.size(F.col("parsed.value.concepts")), F.lit(0))
    reason = (F.when(~F.col("has_draft"), F.lit("no_draft"))
              .when(F.size("drafts") == 0, F.lit("no_drafts"))
              .when(~F.col("parsed.ok"), F.col("parsed.error"))
              .when(n == 0, F.lit("no_concepts")))
    return j.withColumn("reason", reason).drop("drafts")


def concepts_from(parsed: DataFrame) -> DataFrame:
    """X8 + P3: one row per concept of a usable draft.

    The response's domain wins over the ledger's; name, type and definition
    default to '' and are stripped.
    """
    ok = parsed.filter(F.col("reason").isNull())
    e = ok.select("run_id", "seed_id", F.col("domain").alias("_ledger_domain"),
                  F.col("parsed.value.domain").alias("_resp_domain"),
                  F.posexplode("parsed.value.concepts").alias("pos", "c"))
    return e.select(
        "run_id", "seed_id",
        F.coalesce("_resp_domain", "_ledger_domain").alias("domain"),
        py_strip(F.coalesce(F.col("c.name"), F.lit(""))).alias("concept_name"),
        py_strip(F.coalesce(F.col("c.type"), F.lit(""))).alias("concept_type"),
        py_strip(F.coalesce(F.col("c.definition"), F.lit(""))).alias("concept_definition"),
        F.col("pos").cast("int").alias("pos"),
        F.col("_resp_domain").isNull().alias("domain_from_ledger"),
        F.md5(F.concat_ws("|", "seed_id", F.col("pos").cast("string"))).alias("concept_id"))


def rejects_from(parsed: DataFrame, stage: str = "extraction") -> DataFrame:
    """K5: dead-letter rows ``stage, key, reason, raw`` for unusable drafts."""
    bad = parsed.filter(F.col("reason").isNotNull())
    return bad.select(F.lit(stage).alias("stage"), F.col("run_id").alias("key"), "reason",
                      "raw")


# V1 ---------------------------------------------------------------------------
def check_concepts(parsed: DataFrame, types=None) -> DataFrame:
    """V1: contract checks of a parsed extraction answer, one row per run.

    ``violations`` holds codes: count_out_of_range (needs target_min/max),
    bad_type, empty_name, empty_definition, missing_summary.
    """
    types = types or vocab.CONCEPT_TYPES
    cs = F.coalesce(F.col("parsed.value.concepts"),
                    F.array().cast("array<struct<name:string,definition:string,type:string>>"))
    tarr = F.array(*[F.lit(t) for t in types])
    n = F.size(cs)
    checks = [
        ("count_out_of_range", (n < F.col("target_min")) | (n > F.col("target_max"))),
        ("bad_type", F.exists(cs, lambda c: ~F.array_contains(tarr, py_strip(F.coalesce(c["type"], F.lit("")))))),
        ("empty_name", F.exists(cs, lambda c: py_strip(F.coalesce(c["name"], F.lit(""))) == "")),
        ("empty_definition", F.exists(cs, lambda c: py_strip(F.coalesce(c["definition"], F.lit(""))) == "")),
        ("missing_summary", py_strip(F.coalesce(F.col("parsed.value.summary"), F.lit(""))) == ""),
    ]
    viol = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(code)) for code, c in checks]),
                    lambda x: x.isNotNull())
    return (parsed.filter(F.col("parsed.ok"))
            .select("run_id", n.alias("n_concepts"), viol.alias("violations"))
            .withColumn("passed", F.size("violations") == 0))


# A8 ---------------------------------------------------------------------------
def concepts_in_range(concepts: DataFrame, runs_with_range: DataFrame) -> DataFrame:
    """Concepts per run against the run's target range (runs with 0 concepts count)."""
    per = concepts.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_concepts"))
    r = runs_with_range.select("run_id", "target_min", "target_max")
    j = r.join(per, "run_id", "left").withColumn("n_concepts", F.coalesce("n_concepts", F.lit(0)))
    return j.withColumn("in_range", F.col("n_concepts").between(F.col("target_min"), F.col("target_max")))

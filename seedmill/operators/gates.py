"""Quality gates over evaluator verdict tables.

Verdicts arrive as a long table ``run_id, stage, passed``. The pivot uses the
fixed stage list, so its schema is stable and it costs no extra job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedmill.functions import vocab


def gate_pivot(verdicts: DataFrame, stages=None, key: str = "run_id") -> DataFrame:
    """G1: one boolean column per stage (NULL when the stage gave no verdict)."""
    stages = stages or vocab.GATE_STAGES
    return verdicts.groupBy(key).pivot("stage", stages).agg(F.first("passed"))


def gate_accept(pivoted: DataFrame, stages=None, key: str = "run_id") -> DataFrame:
    """Accepted iff every stage passed; a missing verdict is a fail."""
    stages = stages or vocab.GATE_STAGES
    ok = F.lit(True)
    for s in stages:
        ok = ok & F.coalesce(F.col(s), F.lit(False))
    return pivoted.select(key, ok.alias("accepted"))


def gate_funnel(pivoted: DataFrame, stages=None) -> DataFrame:
    """Rows entering and passing each stage, in stage order (a miss stops a row)."""
    stages = stages or vocab.GATE_STAGES
    alive = F.lit(True)
    aggs = []
    for i, s in enumerate(stages):
        entered = alive
        alive = alive & F.coalesce(F.col(s), F.lit(False))
        aggs += [F.sum(entered.cast("int")).alias(f"e{i}"), F.sum(alive.cast("int")).alias(f"p{i}")]
    row = pivoted.agg(*aggs)
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("step"), F.lit(s).alias("stage"),
                                         F.col(f"e{i}").cast("bigint").alias("entered"),
                                         F.col(f"p{i}").cast("bigint").alias("passed"))
                                for i, s in enumerate(stages)]))
    return row.select(pairs.alias("x")).select("x.*")


def term_screen(df: DataFrame, text: str, terms) -> DataFrame:
    """Which user-supplied terms occur as whole words (case-insensitive).

    ``terms`` is a short parameter list; each becomes one JVM regex test.
    """
    import re
    hits = F.array(*[F.when(F.col(text).rlike(r"(?i)\b" + re.escape(t) + r"\b"), F.lit(t)) for t in terms])
    return df.withColumn("terms_found", F.filter(hits, lambda x: x.isNotNull()))


def safety_scores(df: DataFrame, scores: DataFrame, key: str, rules: dict) -> DataFrame:
    """Attach classifier scores (one column per category) and apply a
    threshold per category; ``rules`` maps column -> (op, value).

    Rows without scores stay, marked ``scored = false``; like any missing score
    they are not safe."""
    j = (df.join(scores.withColumn("scored", F.lit(True)), key, "left")
         .withColumn("scored", F.coalesce("scored", F.lit(False))))
    ok = F.lit(True)
    for c, (op, v) in rules.items():
        cond = {"<=": F.col(c) <= v, ">=": F.col(c) >= v, "==": F.col(c) == v, "<": F.col(c) < v,
                ">": F.col(c) > v}[op]
        ok = ok & F.coalesce(cond, F.lit(False))
    return j.withColumn("safe", ok)


def model_agreement(verdicts: DataFrame, key: list, models=("model_a", "model_b"),
                    by: str = "concept_type") -> DataFrame:
    """Agreement of two routed models on combos both judged.

    ``verdicts`` is long (key..., model, is_valid, by); pivot on the fixed
    model list, keep combos both answered, count agreement per ``by``.
    """
    p = verdicts.groupBy(*key, by).pivot("model", list(models)).agg(F.first("is_valid"))
    a, b = models
    both = p.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return both.groupBy(by).agg(F.count(F.lit(1)).alias("shared"),
                                F.sum((F.col(a) == F.col(b)).cast("int")).cast("bigint").alias("agree"))

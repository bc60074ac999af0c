"""Request fan-out and prompt rendering.

Vocabularies (tasks, styles, languages, descriptions) are parameters; rows are
multiplied by ``explode`` of literal arrays (a Generate), never by a join.
Templates are compiled once on the driver into ``concat`` of literals and
columns, so rendering is a plain JVM expression.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedmill.functions import vocab
from seedmill.operators.numbering import number_rows

_PLACEHOLDER = re.compile(r"\{\{\s*([A-Za-z_][\w.]*)\s*\}\}|\{([A-Za-z_][\w.]*)\}")


def compile_template(template: str, bindings: dict) -> Column:
    """``{name}`` and ``{{ a.b }}`` placeholders -> ``concat`` expression.

    ``bindings`` maps each placeholder name to a Column (or column name). An
    unbound name raises on the driver, before any job runs.
    """
    parts, pos = [], 0
    for m in _PLACEHOLDER.finditer(template):
        name = m.group(1) or m.group(2)
        if name not in bindings:
            raise KeyError(f"unbound placeholder: {name}")
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        b = bindings[name]
        parts.append(F.coalesce((F.col(b) if isinstance(b, str) else b).cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def explode_values(df: DataFrame, name: str, values) -> DataFrame:
    """Multiply rows by a literal vocabulary (one output row per value)."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def fanout_single(concepts: DataFrame, tasks=("analogy", "misconception", "qa_concept")) -> DataFrame:
    """Each concept x each single-concept task."""
    return explode_values(concepts, "task", tasks)


MAX_CONCEPTS = 20  # the contract's largest target range


def oversized_seeds(concepts: DataFrame, key: str = "seed_id", limit: int = MAX_CONCEPTS) -> DataFrame:
    """Seeds with more concepts than the contract allows, with their count: rejects of the pair fan-out."""
    return concepts.groupBy(key).agg(F.count(F.lit(1)).alias("concepts")).where(F.col("concepts") > limit)


def fanout_pairs(concepts: DataFrame, key: str = "seed_id", pos: str = "pos", ordered: bool = False, limit: int = MAX_CONCEPTS) -> DataFrame:
    """Concept pairs within a seed (unordered: pos_a < pos_b; ordered: pos_a != pos_b).

    An equi-join on the seed key. Seeds with more than ``limit`` concepts break the extraction contract; they make no pairs and are
    reported by :func:`oversized_seeds`, so a seed yields at most limit * (limit - 1) rows.
    """
    concepts = concepts.join(oversized_seeds(concepts, key, limit).select(key), key, "left_anti")
    a = concepts.select(*[F.col(c).alias(f"{c}_a") if c != key else F.col(c) for c in concepts.columns])
    b = concepts.select(*[F.col(c).alias(f"{c}_b") if c != key else F.col(c) for c in concepts.columns])
    cond = (F.col(f"{pos}_a") != F.col(f"{pos}_b")) if ordered else (F.col(f"{pos}_a") < F.col(f"{pos}_b"))
    return a.join(b, key).filter(cond)


def join_descriptions(combos: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Dimension value -> description, one equi-join per dimension with the caller's table (dim, value, description).

    The table holds one row per dimension value and is broadcast: left to the planner, whose size of a joined table is the product of both,
    every combo would be shuffled once a dimension.
    """
    out = combos
    for d in vocab.DIMENSIONS:
        t = descriptions.where(F.col("dim") == d).select(F.col("value").alias(d), F.col("description").alias(f"{d}_description"))
        out = out.join(F.broadcast(t), d)
    return out


def rotate_exhaust(df: DataFrame, order: Column, values, name: str = "value") -> DataFrame:
    """Give each row one value so that every value is used once before any repeats.

    Rows are numbered globally by ``order`` without a one-task window: range
    partition + sort, per-partition counts (one small row per partition) and
    offsets, then ``value = values[(rank) mod n]``.
    """
    n = len(values)
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    from seedmill.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    # checkpointed so the counting job and the final job see the same partitions
    s = (df.withColumn("_o", order).repartitionByRange(int(parts), "_o").sortWithinPartitions("_o")
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_m", F.monotonically_increasing_id())).checkpoint()
    stats = sorted(s.groupBy("_pid").agg(F.count(F.lit(1)).alias("c"), F.min("_m").alias("m0")).collect())
    off, acc = [], 0
    for r in stats:
        off.append((r["_pid"], acc, r["m0"]))
        acc += r["c"]
    offsets = df.sparkSession.createDataFrame(off, "_pid int, _base long, _m0 long")
    ranked = (s.join(F.broadcast(offsets), "_pid")
              .withColumn("rotation_rank", F.col("_base") + F.col("_m") - F.col("_m0")))
    arr = F.array(*[F.lit(v) for v in values])
    return (ranked.withColumn(name, F.element_at(arr, (F.col("rotation_rank") % n + 1).cast("int")))
            .drop("_o", "_pid", "_m", "_base", "_m0"))


def rotate_bind(seeds: DataFrame, order: list, tasks: dict[str, Column]) -> DataFrame:
    """X11: (the columns of ``seeds``, rotation_rank, task, bound): for every task the tags that the seed's turn binds.

    ``tasks``: task -> array expression over the columns of ``seeds`` and ``rotation_rank`` (the seed's
    place in ``order``, from 0). Ranks are numbered by ranges and offsets; one row per seed and task.
    """
    ranked = number_rows(seeds.withColumn("_all", F.lit(0)), ["_all"], order, "_rn").withColumn("rotation_rank", F.col("_rn") - 1)
    bound = F.explode(F.array(*[F.struct(F.lit(t).alias("task"), tags.alias("bound")) for t, tags in tasks.items()]))
    return ranked.select(*seeds.columns, "rotation_rank", bound.alias("_t")).select(*seeds.columns, "rotation_rank", "_t.task", "_t.bound")


def turn_of(values, rank: Column) -> Column:
    """The value whose turn it is: every value once before any comes again. ``values``: literals, or an array column."""
    arr = values if isinstance(values, Column) else F.array(*[F.lit(v) for v in values])
    return F.try_element_at(arr, (rank % F.greatest(F.size(arr), F.lit(1)) + 1).cast("int"))

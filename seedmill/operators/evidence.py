"""Evidence per candidate (O1, J10): chunks of several sources, the best k of each key, their texts in one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

COLUMNS = ["chunk_id", "chunk", "score"]


def union_sources(sources: dict[str, DataFrame], key: str = "seed_id") -> DataFrame:
    """(key, source, chunk_id, chunk, score) of all sources; chunks without text or score take no part."""
    named = [df.select(key, F.lit(name).alias("source"), *COLUMNS) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), named).where("coalesce(chunk, '') <> '' AND score IS NOT NULL")


def best_chunks(chunks: DataFrame, k: int, key: str = "seed_id") -> DataFrame:
    """The k best chunks of each key with their rank (score, then source and chunk id).

    The planner limits each key to k rows before the shuffle (window group limit), so a key of any size
    sends k rows a task.
    """
    w = Window.partitionBy(key).orderBy(F.col("score").desc(), "source", "chunk_id")
    return chunks.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def join_evidence(candidates: DataFrame, chunks: DataFrame, k: int, key: str = "seed_id") -> DataFrame:
    """Every candidate with its key's evidence: ids and texts of the k best chunks in rank order, '' without any.

    Ranked once per key, not per candidate; a key's k chunks are one row when they meet the candidates.
    """
    best = best_chunks(chunks, k, key)
    g = best.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "source", "chunk_id", "chunk"))).alias("_e"))
    join = lambda f, sep: F.coalesce(F.array_join(F.transform("_e", f), sep), F.lit(""))
    return candidates.join(g, key, "left").select(
        *candidates.columns, join(lambda x: F.concat_ws("/", x["source"], x["chunk_id"]), ",").alias("evidence"),
        join(lambda x: x["chunk"], "\n\n").alias("evidence_text"))

"""Corpus pipeline: toxicity, line dedup, near duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on every row of docs and returns a DataFrame. ``run``
writes each stage's rows as Parquet in the shared folder and reads them back for the next one. All
stages but the last return the columns of ``documents`` (others that docs had as well).

Defined cases, in every stage: a null text counts as an empty one and stays null; texts of any length are read whole; rows that
repeat are rows of their own until the near-duplicate stage keeps one of them; a null doc_id comes last where
order decides; extra columns travel along, whatever their names; an empty table gives an empty one.

No SQL can express the toxicity model, so ORACLE_SQL is None; tests hold the stages against
brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedmill.llm import line_dedup, ngram_join, packing, template_decontam, toxicity
from seedmill.llm.common import saved, table
from seedmill.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores below its threshold; learnt from labelled rows of docs that are not held out."""
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.keep_clean(docs, model)


def _free(docs: DataFrame, name: str) -> str:
    """The name, with as many ``_`` in front as no column of docs has it."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier line matches, n_chars to suit.

    A document that lost lines and has none but blank ones left goes as well.
    """
    clean, removed = (_free(docs, name) for name in ("clean", "removed"))
    done = line_dedup.dedup_lines(docs, clean=clean, removed=removed)
    kept = (F.size(removed) == 0) | F.col(clean).rlike(r"\S")
    changed = {"text": F.col(clean), "n_chars": F.when(F.size(removed) > 0, F.length(clean).cast("long")).otherwise(done["n_chars"])}
    # in two steps, so that no name is read as an alias of the same select
    out = done.where(kept).select(*[changed.get(c, done[c]).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    return out.toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.8 or more: the smallest doc_id."""
    return ngram_join.keep_one(docs, k=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, verbatim (in any case and spacing) or re-parameterised with consistent names."""
    leaks = template_decontam.find_leaks(docs, table(spark, sf_dir, "benchmark")).where("consistent or literal")
    bad = leaks.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_doc"]) & (F.xxhash64(docs["text"]) == bad["_hash"]), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in training sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

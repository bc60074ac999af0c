"""File sources (S1-S9): explicit schemas, no inference, CSV only as an import format.

Each reader returns a DataFrame; the cleaning step of each reader is a separate
function over a DataFrame so it can be applied to data that arrives any other way.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedmill.functions import vocab
from seedmill.functions.text import py_strip

CSV_OPTS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}

LEDGER_SCHEMA = ("run_id string, seed_id string, domain string, target_concepts_range string, "
                 "status string, timestamp string")
CONCEPTS6_SCHEMA = ("run_id string, seed_id string, domain string, concept_name string, "
                    "concept_type string, concept_definition string")
CONCEPTS5_SCHEMA = "run_id string, seed_id string, domain string, concept_name string, concept_definition string"
VALIDITY_SCHEMA = ("run_id string, seed_id string, domain string, concept_name string, concept_type string, "
                   "concept_definition string, format string, audience string, angle string, "
                   "cognitive_operation string, is_valid string, reason string")


def path_exists(spark: SparkSession, path: str | None) -> bool:
    """Existence check through Hadoop's FileSystem (local, HDFS and object stores alike)."""
    if not path:
        return False
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


# S1 ------------------------------------------------------------------------
def clean_seed_ids(lines: DataFrame, col: str = "value") -> DataFrame:
    """One id per line: strip all whitespace, drop blank lines."""
    v = py_strip(F.col(col))
    return lines.select(v.alias("seed_id")).filter(F.col("seed_id") != "")


def read_seed_ids(spark: SparkSession, path: str) -> DataFrame:
    return clean_seed_ids(spark.read.text(path))


# S2 ------------------------------------------------------------------------
def started_runs(ledger: DataFrame) -> DataFrame:
    """Ledger rows whose stripped status is STARTED; ids and domain stripped."""
    return (ledger.filter(py_strip(F.col("status")) == vocab.STATUS_STARTED)
            .withColumn("run_id", py_strip("run_id"))
            .withColumn("seed_id", py_strip("seed_id"))
            .withColumn("domain", py_strip(F.coalesce(F.col("domain"), F.lit("")))))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(**CSV_OPTS).schema(LEDGER_SCHEMA).csv(path)


def read_runs_started(spark: SparkSession, path: str) -> DataFrame:
    return started_runs(read_ledger(spark, path))


# S3 ------------------------------------------------------------------------
def read_concepts(spark: SparkSession, path: str) -> DataFrame:
    """Concept CSVs in either layout, also mixed in one folder; ``concept_type`` is NULL when absent.

    One read with six positional columns; each file's own header row says which
    layout its rows have, and rows meet their header by file name.
    """
    opts = {**CSV_OPTS, "header": "false"}
    raw = (spark.read.options(**opts).schema(", ".join(f"c{i} string" for i in range(6))).csv(path)
           .withColumn("_file", F.col("_metadata.file_path")))
    is_header = (py_strip(F.regexp_replace("c0", "^\ufeff", "")) == "run_id") & (py_strip("c1") == "seed_id")
    head = raw.filter(is_header).select("_file", (py_strip("c4") == "concept_type").alias("_six")).distinct()
    rows = raw.filter(~F.coalesce(is_header, F.lit(False))).join(head, "_file")
    return rows.select(F.col("c0").alias("run_id"), F.col("c1").alias("seed_id"), F.col("c2").alias("domain"),
                       F.col("c3").alias("concept_name"), F.when(F.col("_six"), F.col("c4")).alias("concept_type"),
                       F.when(F.col("_six"), F.col("c5")).otherwise(F.col("c4")).alias("concept_definition"))


def normalize_concepts(df: DataFrame) -> DataFrame:
    """Bring a 5- or 6-column concept table to the 6-column layout."""
    if "concept_type" not in df.columns:
        df = df.withColumn("concept_type", F.lit(None).cast("string"))
    return df.select("run_id", "seed_id", "domain", "concept_name", "concept_type",
                     "concept_definition", *[c for c in df.columns if c not in (
                         "run_id", "seed_id", "domain", "concept_name", "concept_type",
                         "concept_definition")])


# S4 ------------------------------------------------------------------------
RULES_SCHEMA = T.StructType([T.StructField(k, T.ArrayType(T.ArrayType(T.StringType())))
                             for k in vocab.RULE_FILE_KEYS])


def rules_long(raw: DataFrame) -> DataFrame:
    """The three rule lists of a rules document as ``dim, concept_type, value`` rows."""
    parts = [raw.select(F.explode_outer(F.col(k)).alias("p")).select(
        F.lit(dim).alias("dim"), F.col("p")[0].alias("concept_type"), F.col("p")[1].alias("value"))
        for k, dim in vocab.RULE_FILE_KEYS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("concept_type").isNotNull()).distinct()


def read_rules(spark: SparkSession, path: str | None, required: bool = False) -> DataFrame:
    """Read a rules JSON; a missing file means no rules (unless ``required``)."""
    empty = spark.createDataFrame([], "dim string, concept_type string, value string")
    if not path_exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return empty
    raw = spark.read.option("multiLine", "true").schema(RULES_SCHEMA).json(path)
    return rules_long(raw)


# S5 ------------------------------------------------------------------------
ROTATION_GLOBALS = ["dietary_restrictions", "audiences", "languages_out", "regions"]
ROTATION_MAPS = ["festivals_by_region", "preservation_methods_by_region"]


def rotation_long(raw_json: DataFrame, col: str = "value") -> DataFrame:
    """Flatten a rotation document (one JSON text per row) to
    ``variable, region, pos, value, scale_from, scale_to``."""
    schema = ("global_variables struct<dietary_restrictions:array<string>, audiences:array<string>, "
              "languages_out:array<string>, regions:array<string>, "
              "serving_scales:array<struct<`from`:string,`to`:string>>>, "
              "regional_variables struct<festivals_by_region:map<string,array<string>>, "
              "preservation_methods_by_region:map<string,array<string>>>")
    doc = raw_json.select(F.from_json(F.col(col), schema).alias("d"))
    outs = []
    for v in ROTATION_GLOBALS:
        outs.append(doc.select(F.lit(v).alias("variable"), F.lit(None).cast("string").alias("region"),
                               F.posexplode(F.col(f"d.global_variables.{v}")).alias("pos", "value"))
                    .withColumn("scale_from", F.lit(None).cast("string"))
                    .withColumn("scale_to", F.lit(None).cast("string")))
    outs.append(doc.select(F.lit("serving_scales").alias("variable"), F.lit(None).cast("string").alias("region"),
                           F.posexplode(F.col("d.global_variables.serving_scales")).alias("pos", "s"))
                .select("variable", "region", "pos",
                        F.concat_ws("->", "s.from", "s.to").alias("value"),
                        F.col("s.from").alias("scale_from"), F.col("s.to").alias("scale_to")))
    for v in ROTATION_MAPS:
        outs.append(doc.select(F.lit(v).alias("variable"),
                               F.explode(F.col(f"d.regional_variables.{v}")).alias("region", "vals"))
                    .select("variable", "region", F.posexplode("vals").alias("pos", "value"))
                    .withColumn("scale_from", F.lit(None).cast("string"))
                    .withColumn("scale_to", F.lit(None).cast("string")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def read_rotation(spark: SparkSession, path: str) -> DataFrame:
    return rotation_long(spark.read.text(path, wholetext=True))


# S6 ------------------------------------------------------------------------
DRAFTS_SCHEMA = "run_id string, drafts array<struct<teacher_output:struct<candidate_response:string>>>"


def read_drafts(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored draft responses keyed by run_id (the model service writes them)."""
    if fmt == "json":
        return spark.read.schema(DRAFTS_SCHEMA).json(path)
    return spark.read.parquet(path).select("run_id", "drafts")


# S7 ------------------------------------------------------------------------
def completed_rows(done: DataFrame) -> DataFrame:
    """Rows of an earlier verdict output that count as done (non-blank ``is_valid``)."""
    return done.filter(py_strip(F.coalesce(F.col("is_valid"), F.lit(""))) != "")


def read_validity_done(spark: SparkSession, path: str | None) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], VALIDITY_SCHEMA)
    return completed_rows(spark.read.options(**CSV_OPTS).schema(VALIDITY_SCHEMA).csv(path))


# S8 ------------------------------------------------------------------------
_PLACEHOLDER = r"\{\{\s*([A-Za-z_][A-Za-z0-9_.]*)\s*\}\}|\{([A-Za-z_][A-Za-z0-9_.]*)\}"


def read_templates(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """Template files, one row per file: path, family (its folder), task_id (its name up to the first ``_``), template, placeholders.

    A folder or file may be named ``key=value``, as Spark writes partitions; the value counts. ``placeholders``: the distinct
    names of ``{name}`` and ``{{ a.b }}`` in order of first use.
    """
    df = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
          .text(root, wholetext=True)
          .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("template")))
    value = lambda c: F.regexp_replace(c, "^[^=]*=", "")
    names = F.transform(F.regexp_extract_all("template", F.lit(_PLACEHOLDER), F.lit(0)), lambda x: F.regexp_replace(x, r"[{}\s]", ""))
    return df.select(
        "path", "template",
        value(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)).alias("family"),
        value(F.regexp_extract("path", r"/([^/_]+)[^/]*$", 1)).alias("task_id"),
        F.array_distinct(names).alias("placeholders"))


# S9 ------------------------------------------------------------------------
def read_embeddings(spark: SparkSession, path: str, key: str = "concept_id") -> DataFrame:
    """Vectors as ``key, embedding array<float>``; order is a join key, not a position."""
    return spark.read.parquet(path).select(key, "embedding")


def rules_json_text(rules) -> str:
    """Serialize rule tuples to the three-list document layout (for writing test files)."""
    out = {k: [] for k in vocab.RULE_FILE_KEYS}
    inv = {v: k for k, v in vocab.RULE_FILE_KEYS.items()}
    for dim, t, v in rules:
        out[inv[dim]].append([t, v])
    return json.dumps(out)

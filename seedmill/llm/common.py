"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedmill.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor costs the tasks it ran, never an earlier round.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/seedmill-{uuid.uuid4().hex}/{tag}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z alone, so that no other letter changes its length."""
    return F.translate(c, UPPER, LOWER)


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def rows(spark: SparkSession, data: list, schema: str) -> DataFrame:
    """A small parameter table as a local relation (no Python worker)."""
    return spark.createDataFrame(data, schema) if data else spark.createDataFrame([], schema)

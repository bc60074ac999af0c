"""Row numbers within large groups, without a window task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seedmill.session import written


def number_rows(df: DataFrame, keys: list, order: list, out: str = "rn", partitions: int | None = None) -> DataFrame:
    """``out``: the position (from 1) of each row among the rows of ``keys`` in ``order``.

    Rows are dealt by range of (keys, order) and written, so the ranges are fixed; a range numbers its own rows and
    starts behind the counts of the ranges before it. A key of any share of the rows is as many groups as it has
    ranges. ``order`` should be unique within a key; rows equal in it share a range and take any order.
    """
    n = int(partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(df.repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("_r", *[f"_k{i}" for i in range(len(keys))], F.coalesce(before, F.lit(0)).alias("_before"))
    own = dealt.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order)))
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return own.join(counts, same).withColumn(out, F.col("_before") + F.col("_rn")).select(*df.columns, out)

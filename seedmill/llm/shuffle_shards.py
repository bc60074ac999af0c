"""Sharding by a two-pass external shuffle, in DataFrame functions alone.

Pass 1 scatters the records uniformly over memory-sized buckets by a seeded hash of the whole record.
Pass 2 takes one bucket a task, deals its records into the order of a Fisher-Yates permutation drawn
from the seed and the bucket's number, and gives every record its place in the whole shuffled
sequence. That sequence is cut into shards whose row counts differ by at most one.

Only counts leave a task: the permutation is drawn from the number of a bucket's records (4 bytes
each) and joined to the records by (bucket, position), so no array ever holds a text.

The result is a function of the rows, the seed, the number of shards and the size of a bucket; a task
that is run again after a lost executor deals the same places. Defined results: a null text has
size 16 and the crc32 of no bytes; rows that are equal in all columns are interchangeable, each has a
place of its own, and they share a bucket, whose sort spills; very long texts are shuffled whole (a bucket
holds at least one record); an empty table gives no row. Extra columns, whatever their names, travel along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, text_or_empty

OVERHEAD = 16  # bytes of a record besides its text
BUCKET_BYTES = 32 << 20
GROUP = 1024  # buckets that one task adds up; the groups' sums are added up in one more task


def record_size(text: Column | str) -> Column:
    """UTF-8 bytes of the text (none of a null) and the record's overhead."""
    return F.octet_length(text_or_empty(text)).cast("long") + OVERHEAD


def record_hashes(docs: DataFrame, seed: int) -> list[Column]:
    """Two seeded 64-bit hashes of all columns; the second one decides where the first is equal."""
    cols = [docs[c] for c in docs.columns]
    missing = [F.isnull(c) for c in cols]
    return [F.xxhash64(F.lit(seed), F.lit(i), *cols, *missing) for i in (0, 1)]


def bucket_places(counts: DataFrame, buckets: int, shards: int, seed: int) -> DataFrame:
    """(bucket, at, place): place ``at`` of each bucket's Fisher-Yates permutation in the whole sequence, and the shard.

    ``shuffle`` is seeded with the seed and the number of its task, which here is the bucket's number.
    """
    wide = counts.withColumn("_group", (F.col("_bucket") / GROUP).cast("int"))
    groups = wide.groupBy("_group").agg(F.sum("_n").alias("_sum"))
    groups = groups.select("_group", (F.sum("_sum").over(Window.orderBy("_group")) - F.col("_sum")).alias("_before"),
                           F.sum("_sum").over(Window.partitionBy(F.lit(0))).alias("_all"))
    within = F.sum("_n").over(Window.partitionBy("_group").orderBy("_bucket")) - F.col("_n")
    offsets = wide.withColumn("_within", within).join(groups, "_group")
    offsets = offsets.select("_bucket", "_n", (F.col("_before") + F.col("_within")).alias("_start"), "_all")
    drawn = offsets.repartitionById(buckets, F.col("_bucket")).select(
        "_bucket", "_start", "_all", F.shuffle(F.sequence(F.lit(0), (F.col("_n") - 1).cast("int")), seed).alias("_perm"))
    dealt = drawn.select("_bucket", "_start", "_all", F.posexplode("_perm").alias("_to", "_at"))
    place, n = F.col("_start") + F.col("_to"), F.col("_all")
    # integer division of longs: few + 1 rows in the first shards, few in the others
    dealt = dealt.select("_bucket", "_at", place.alias("_place"), F.expr(f"_all DIV {int(shards)}").alias("_few"), (n % shards).alias("_more"))
    shard = F.expr("CASE WHEN _place < _more * (_few + 1) THEN _place DIV (_few + 1) ELSE _more + (_place - _more * (_few + 1)) DIV greatest(_few, 1L) END")
    dealt = dealt.withColumn("shard", shard.cast("int"))
    first = F.least(F.col("shard").cast("long"), F.col("_more")) + F.col("shard") * F.col("_few")
    return dealt.select("_bucket", "_at", "shard", (F.col("_place") - first).alias("slot"))


def shuffle_shards(docs: DataFrame, shards: int, seed: int = 0, bucket_bytes: int = BUCKET_BYTES, text: str = "text") -> DataFrame:
    """docs with shard (0 to shards - 1) and slot (gapless from 0 in each shard) of a seeded uniform shuffle."""
    clash = {"shard", "slot"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are what the operator adds; rename them first")
    size = docs.agg(F.sum(record_size(docs[text]))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    low, high = record_hashes(docs, seed)
    bucket = F.pmod(low, F.lit(buckets)).cast("int")
    counts = saved(docs.select(bucket.alias("_bucket")).groupBy("_bucket").agg(F.count("*").alias("_n")), "counts")
    scattered = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)], bucket.alias("_bucket"), low.alias("_low"), high.alias("_high"))
    scattered = scattered.repartitionById(buckets, F.col("_bucket"))
    at = F.row_number().over(Window.partitionBy("_bucket").orderBy("_low", "_high")) - 1
    numbered = scattered.select(*[f"c{i}" for i in range(len(docs.columns))], "_bucket", at.alias("_at"))
    places = bucket_places(counts, buckets, shards, seed)
    out = numbered.join(places.hint("shuffle_hash"), ["_bucket", "_at"])
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)], "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int, seed: int = 0, bucket_bytes: int = BUCKET_BYTES, text: str = "text") -> None:
    """Write the shards as Parquet, one folder a shard; a bucket's task writes to the one or two shards that its places fall in.

    A file holds a run of slots; readers that need the exact sequence sort by slot.
    """
    shuffle_shards(docs, shards, seed, bucket_bytes, text).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

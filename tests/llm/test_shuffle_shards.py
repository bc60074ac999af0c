import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seedmill.llm import queries as Q
from seedmill.llm import shuffle_shards as S
from seedmill.llm.common import rows
from tests.conftest import SF0001


def fisher_yates(n, seed):
    """The inside-out permutation of 0..n-1 drawn from a Mersenne twister seeded with 64 bits."""
    r = np.random.RandomState([seed >> 32 & 0xFFFFFFFF, seed & 0xFFFFFFFF])

    def below(m):
        while True:
            bits = int.from_bytes(r.bytes(4), "little") >> 1
            if m & (m - 1) == 0:
                return m * bits >> 31
            if bits - bits % m + m - 1 < 1 << 31:
                return bits % m
    out = [0] * n
    for i in range(n):
        j = below(i + 1)
        out[i] = out[j]
        out[j] = i
    return out


def brute(docs, shards, seed, bucket_bytes):
    """Scatter, shuffle each bucket in a loop, deal out the concatenation. docs: rows with their two hashes."""
    size = sum(len((d["text"] or "").encode()) + 16 for d in docs)
    n = max(1, -(-size // bucket_bytes))
    whole = []
    for b in range(n):
        mine = sorted((d for d in docs if d["low"] % n == b), key=lambda d: (d["low"], d["high"]))
        perm = fisher_yates(len(mine), seed + b)
        places = [None] * len(mine)
        for to, at in enumerate(perm):
            places[to] = mine[at]["key"]
        whole += places
    out, at = {}, 0
    for s in range(shards):
        n = len(whole) // shards + (s < len(whole) % shards)
        out.update({k: (s, i) for i, k in enumerate(whole[at:at + n])})
        at += n
    return out


def hashed(df, seed):
    low, high = S.record_hashes(df, seed)
    return [{"key": (r["doc_id"], r["text"]), "text": r["text"], "low": r["low"], "high": r["high"]} for r in df.select("*", low.alias("low"), high.alias("high")).collect()]


@pytest.mark.parametrize("n, shards, bucket", [(500, 7, 4000), (40, 40, 100), (23, 40, 1 << 20), (1, 3, 5)])
def test_equals_a_plain_loop(spark, n, shards, bucket):
    rng = random.Random(n)
    docs = [(i, rng.choice([None, "", "x" * rng.randrange(300), "same", "Zoë 文 " * 5])) for i in range(n)]
    df = rows(spark, docs, "doc_id long, text string").selectExpr("*", "1 AS _bucket", "2 AS _at", "3 AS c0", "4 AS _n")
    got = {(r["doc_id"], r["text"]): (r["shard"], r["slot"]) for r in S.shuffle_shards(df, shards, 9, bucket).collect()}
    assert got == brute(hashed(df, 9), shards, 9, bucket)


def test_layout_changes_nothing_and_seeds_do(spark):
    df = spark.read.parquet(f"{SF0001}/documents.parquet")
    take = lambda d, seed: {r["doc_id"]: (r["shard"], r["slot"]) for r in S.shuffle_shards(d, 10, seed, 50_000).collect()}
    one = take(df, 1)
    assert one == take(df.repartition(7), 1) and one != take(df, 2)
    n = Counter(s for s, _ in one.values())
    assert max(n.values()) - min(n.values()) <= 1
    for s in n:
        assert sorted(i for t, i in one.values() if t == s) == list(range(n[s]))


def test_shards_are_mixed(spark):
    """Neighbours in the table land independently: shard counts of one half of the ids stay near their mean."""
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    got = S.shuffle_shards(df, 20, 5, 40_000).where("doc_id < 10000").groupBy("shard").count().collect()
    assert len(got) == 20 and all(abs(r["count"] - 500) < 100 for r in got)


def test_query_columns_and_edge_rows(spark, tmp_path):
    docs = [(1, None), (2, ""), (3, "aé\U0001F600"), (None, "x"), (None, "x"), (None, None), (7, "long " * 200_000)]
    rows(spark, docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = Q.op12_shuffle_shards(spark, str(tmp_path)).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert sorted(r["shard"] for r in got) == list(range(7)) and {(r["law"], r["slot"], r["grown_shard"]) for r in got} == {("rows", 0, None)}
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    assert S.shuffle_shards(empty, 40).collect() == []
    with pytest.raises(ValueError):
        S.shuffle_shards(empty.selectExpr("*", "1 AS slot"), 40)


def test_written_shards(spark, tmp_path):
    df = spark.read.parquet(f"{SF0001}/documents.parquet")
    S.write_shards(df, f"{tmp_path}/out", 5, 3, 50_000)
    back = spark.read.parquet(f"{tmp_path}/out")
    want = S.shuffle_shards(df, 5, 3, 50_000)
    key = lambda d: sorted((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in d.collect())
    assert key(back) == key(want)

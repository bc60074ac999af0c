import random
import zlib

import numpy as np

from seedmill.llm import toxicity as T
from seedmill.llm.common import rows

BAD = ["grumbletoad", "snarkfiend", "mudbrained", "vileworm"]


def corpus(n=900, seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghilmnoprstu", k=rng.randrange(2, 9))) for _ in range(500)]
    out = []
    for i in range(n):
        t = rng.choices(words, k=rng.randrange(5, 120))
        toxic = int(rng.random() < .25)
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                b = rng.choice(BAD)
                if zlib.crc32(str(i).encode()) % 4 == 2:  # spellings that the fit never sees
                    p = rng.randrange(2, len(b) - 2)
                    b = b[:p] + rng.choice("xyz1") + b[p + 1:]
                t.insert(rng.randrange(len(t)), b)
        out.append((i, " ".join(t), toxic))
    return out


def test_held_out_misspellings(spark):
    data = corpus()
    docs = rows(spark, [(i, t, 1.0) for i, t, _ in data], "doc_id long, text string, score double")
    labels = rows(spark, [(i, y, 0) for i, _, y in data], "doc_id long, toxic int, quality int")
    model = T.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in T.score_documents(docs, model).collect()}
    held = [i for i, _, _ in data if zlib.crc32(str(i).encode()) % 4 == 2]
    y = np.array([data[i][2] for i in held])
    p = np.array([got[i] for i in held])
    rank = p.argsort().argsort() + 1
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum())
    flagged = p >= T.THRESHOLD
    assert auc >= .95 and (flagged & (y == 1)).sum() / max(flagged.sum(), 1) >= .9


def test_edges(spark):
    docs = rows(spark, [(1, None), (2, ""), (3, "... !!"), (4, "word " * 300_000), (None, "abc"), (5, "😀 ß İ"), (1, None)], "doc_id long, text string")
    for labels in ([], [(1, 0)], [(1, 0), (3, 1), (None, 1), (2, None)]):
        model = T.train(docs, rows(spark, labels, "doc_id long, toxic int"))
        out = T.score_documents(docs, model).collect()
        assert len(out) == 7 and all(0 <= r["score"] <= 1 for r in out)
    assert T.score_documents(docs.limit(0), model).count() == 0
    assert T.keep_clean(docs, (np.zeros(T.BUCKETS, np.float32), -5.0)).collect() == docs.collect()
    assert T.keep_clean(docs, (np.zeros(T.BUCKETS, np.float32), 5.0)).count() == 0


def test_whole_text_counts():
    table = np.zeros(T.BUCKETS)
    bucket, _ = T.word_grams(["grumbletoad"])
    table[bucket] = 50
    text = "aa bb " * 200_000
    low, high = T.score_texts([text, text + "grumbletoad"], table, -3.0, {})
    assert low < .1 < .5 < high

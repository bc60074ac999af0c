import zlib
from collections import defaultdict

import numpy as np
import pytest

from seedmill.llm import packing as P
from seedmill.llm.common import rows
from tests.conftest import SF0001

public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


def ids_of(text):
    from tokenizers import Tokenizer
    global _T
    if "_T" not in globals():
        _T = Tokenizer.from_file(PATH)
    return _T.encode(text or "", add_special_tokens=False).ids + [2]


def check(docs, pieces):
    """Each id in exactly one piece, checksums right, sequences gapless and full or a power of two."""
    want = defaultdict(list)
    for d, t in docs:
        want[d].append(ids_of(t))
    got = defaultdict(list)
    for p in pieces:
        got[p["doc_id"]].append(p)
    assert set(got) == set(want)
    for d, texts in want.items():
        if len(texts) == 1:
            at = 0
            for p in sorted(got[d], key=lambda p: p["start"]):
                part = texts[0][at:at + p["length"]]
                assert p["start"] == at and p["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes()) and p["doc_tokens"] == len(texts[0])
                at += p["length"]
            assert at == len(texts[0])
        else:
            assert sum(p["length"] for p in got[d]) == sum(map(len, texts))
    seq = defaultdict(list)
    for p in pieces:
        seq[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at and n > 0
            at += n
        assert at <= 4096 and at & (at - 1) == 0
    return seq


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF0001}/documents.parquet")
    check([(r["doc_id"], r["text"]) for r in df.collect()], P.pack_documents(df, PATH).collect())


def test_edges(spark, monkeypatch):
    docs = [(1, None), (2, ""), (3, "word " * 30_000), (4, "It's 12 o'clock, naïve café — ﬁn <|endoftext|> İstanbul ΣΑΣ é    x\x01y \x1c z​q 😀"), (5, "a."),
            (None, "none"), (6, "rep rep"), (6, "rep rep"), (7, "Ünïcödé ÀÉÎ, ß! µ ª º..?"), (8, "\n\t ")]
    df = rows(spark, [(*d, 5) for d in docs], "doc_id long, text string, tokens int")
    check(docs, P.pack_documents(df, PATH).collect())
    assert P.pack_documents(df.limit(0), PATH).count() == 0


def test_neighbours_share_a_window():
    rng = np.random.default_rng(0)
    rows_ = []
    for topic in range(4):  # four topics, each with its own ids
        for i in range(30):
            ids = rng.integers(1000 * topic, 1000 * topic + 200, 700).astype("<u2")
            rows_.append((topic * 100 + i, 0, 700, ids.tobytes()))
    rows_ = [rows_[i] for i in rng.permutation(len(rows_))]
    df = np.zeros(1 << 16)
    for r in rows_:
        df[np.unique(np.frombuffer(r[3], "<u2"))] += 1
    shard = P.Shard(rows_, np.log1p((len(rows_) - df + .5) / (df + .5)))
    mixed = total = 0
    for s in shard.sequences():
        topics = {rows_[i][0] // 100 for i, _, _ in s}
        total += 1
        mixed += len(topics) > 1
    assert total >= 20 and mixed <= 6


def test_caches_serve_all_tasks_of_a_worker_and_counts_equal_a_loop(spark):
    import numpy as np
    from seedmill.llm import packing
    from seedmill.llm.queries import tokenizer_path
    words = packing.word_ids(tokenizer_path())
    assert words is packing.word_ids(tokenizer_path())
    texts = ["Plain words, Plain WORDS plain", "Größe größe! 12 a-b", "", "same same same."]
    assert words.texts(texts) == words.texts(texts) == packing.WordIds(tokenizer_path()).texts(texts)
    rng = np.random.default_rng(5)
    held = [rng.integers(0, 40 if i % 2 else 1 << 16, rng.integers(1, 900), dtype=np.uint16).astype("<u2").tobytes() for i in range(600)]
    want = np.zeros(1 << 16, np.int64)
    for t in held:
        want[np.unique(np.frombuffer(t, dtype="<u2"))] += 1
    df = spark.createDataFrame([(bytearray(t),) for t in held], "tokens binary")
    assert (packing.frequencies(df) == want).all()

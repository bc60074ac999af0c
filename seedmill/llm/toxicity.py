"""Toxicity by subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3 to 5, with word ends), hashed into ``BUCKETS``
embeddings; a window is the mean over its words (a repeated word counts once); a softmax over two classes reads the window. A
document's score is that of its most toxic window, so a few words in a long text are not averaged
away; windows of ``WINDOW`` words at half steps cover the whole text. An unseen misspelling shares
most n-grams with the word it comes from, and with them the score.

Fitting: a bounded sample of labelled rows (``FIT_ROWS`` of each class at most in expectation, texts
of at most ``FIT_CHARS`` characters, chosen by a hash of the id), weighted back to the share of
the classes, on the driver: embeddings and softmax by Adam on the log loss, first on all windows
and then on each document's highest window.

Scoring: embeddings and softmax reduce to one number per bucket (embedding times weight
difference), 1 MB whatever the data, which is broadcast. Every character of every text is hashed
in vectorised numpy. No shuffle.

Defined cases: null and empty texts get the score of a text without words (the softmax bias);
repeated rows each get their score; without both classes among the labels the score is the share
of label 1 (0 if there are no labels); empty tables and extra columns are fine.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, DIM, WINDOW = 1 << 18, 4, 12
FIT_ROWS, FIT_CHARS = 2500, 20_000
THRESHOLD = 0.3
RATE, FLOOR = 0.1, 1e-7  # of Adam
SLICE = 1 << 20  # characters read at once
CACHE = 400_000  # words whose score a worker keeps
WORD = re.compile(r"[^\W_]+")
_MUL, _ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, index of its word) of the character n-grams of all words, each word between two end signs."""
    cp = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le", "replace"), dtype=np.uint32)
    inside = cp != 10
    c = cp.astype(np.uint64)
    owner = np.cumsum(~inside) - 1              # an end sign counts to the word after it
    ok = np.ones(len(c) - 1, dtype=bool)
    h = (c + np.uint64(1)) * _MUL
    buckets, owners = [], []
    for size in range(2, 6):
        if len(c) < size:
            break
        # all between its first and last character is inside the word
        ok = ok[:len(c) - size + 1] & inside[size - 2:len(c) - 1] if size > 2 else ok
        h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * _MUL + c[size - 1:] * _ADD
        if size > 2:
            at = np.flatnonzero(ok)
            g = h[at]
            buckets.append((((g ^ (g >> np.uint64(31))) * _MUL) >> np.uint64(64 - 18)).astype(np.int64))
            owners.append(owner[at])
    return np.concatenate(buckets), np.concatenate(owners)


def learn_words(words, table: np.ndarray, cache: dict[str, float]) -> None:
    """Put the mean of the table over each new word's n-grams into the cache."""
    if len(cache) > CACHE:
        cache.clear()
    if fresh := [w for w in set(words) if w not in cache]:
        bucket, owner = word_grams(fresh)
        total = np.bincount(owner, weights=table[bucket], minlength=len(fresh))
        cache.update(zip(fresh, (total / np.maximum(np.bincount(owner, minlength=len(fresh)), 1)).tolist()))


def slices(text: str) -> Iterator[str]:
    """The text in parts of SLICE characters at most, cut between words."""
    at = 0
    while at < len(text):
        end = min(len(text), at + SLICE)
        if end < len(text):
            cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = cut if cut > at else end
        yield text[at:end]
        at = end


def word_scores(texts: list[str], table: np.ndarray, cache: dict[str, float]) -> list[np.ndarray]:
    """Per text, the scores of its words in order; the new words of all texts are hashed together."""
    out: list[np.ndarray] = []
    if sum(map(len, texts)) <= SLICE:
        words = [WORD.findall(t.lower()) for t in texts]
        learn_words([w for ws in words for w in ws], table, cache)
        return [np.fromiter(map(cache.__getitem__, ws), dtype=np.float64, count=len(ws)) for ws in words]
    if len(texts) > 1:
        half = len(texts) // 2
        return word_scores(texts[:half], table, cache) + word_scores(texts[half:], table, cache)
    for part in slices(texts[0]):
        words = WORD.findall(part.lower())
        learn_words(words, table, cache)
        out.append(np.fromiter(map(cache.__getitem__, words), dtype=np.float64, count=len(words)))
    return [np.concatenate(out)]


def window_means(scores: np.ndarray) -> np.ndarray:
    """Sums over windows of WINDOW words at half steps, by WINDOW; a word said again within WINDOW words adds nothing."""
    n = len(scores)
    if not n:
        return np.zeros(0)
    order = np.argsort(scores, kind="stable")
    again = (scores[order][1:] == scores[order][:-1]) & (np.diff(order) < WINDOW)
    scores = scores.copy()
    scores[order[1:][again]] = 0
    total = np.concatenate(([0.0], np.cumsum(scores)))
    start = np.append(np.arange(0, max(n - WINDOW, 0), WINDOW // 2), max(n - WINDOW, 0))
    return (total[np.minimum(start + WINDOW, n)] - total[start]) / WINDOW


def score_texts(texts: list[str | None], table: np.ndarray, bias: float, cache: dict[str, float]) -> np.ndarray:
    means = [window_means(x) for x in word_scores([t or "" for t in texts], table, cache)]
    logit = bias + np.array([m.max() if len(m) else 0.0 for m in means], dtype=np.float64)
    return 1.0 / (1.0 + np.exp(-np.clip(logit, -60, 60)))


def _batch(texts: list[str], labels: np.ndarray, weights: np.ndarray) -> dict:
    """Words, n-grams and windows of some documents, as index arrays."""
    vocab: dict[str, int] = {}
    word, of, doc, k = [], [], [], 0
    for d, t in enumerate(texts):
        ws = np.array([vocab.setdefault(w, len(vocab)) for w in WORD.findall(t.lower())], dtype=np.int64)
        for s in range(0, len(ws), WINDOW):
            part = np.unique(ws[max(0, min(s, len(ws) - WINDOW)):][:WINDOW])
            word.append(part)
            of.append(np.full(len(part), k))
            doc.append(d)
            k += 1
    gram, own = word_grams(list(vocab))
    doc = np.array(doc, dtype=np.int64)
    of = np.concatenate(of)
    starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    return {"gram": gram, "own": own, "per": np.maximum(np.bincount(own, minlength=len(vocab)), 1).astype(np.float32),
            "word": np.concatenate(word), "of": of, "k": k, "starts": starts, "runs": np.diff(np.append(starts, k)),
            "y": labels[doc].astype(int), "weight": weights[doc].astype(np.float32), "total": float(weights[doc[starts]].sum())}


def _summed(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the columns of values (dimensions in rows) by index."""
    return np.stack([np.bincount(index, weights=v, minlength=n) for v in values]).astype(np.float32)


def fit(texts: list[str], labels: np.ndarray, weights: np.ndarray, steps: int = 160, batch: int = 400, seed: int = 7) -> tuple[np.ndarray, float]:
    """Train embeddings (DIM x BUCKETS) and softmax (DIM x 2) jointly; return them as one number per bucket, and a bias."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    parts = [order[i:i + batch] for i in range(0, len(order), batch)]
    parts = [_batch([texts[i] for i in p], labels[p], weights[p]) for p in parts if any(WORD.search(texts[i]) for i in p)]
    E = (rng.standard_normal((DIM, BUCKETS)) * 0.05).astype(np.float32)
    W = (rng.standard_normal((DIM, 2)) * 0.5).astype(np.float32)
    B = np.zeros(2, np.float32)
    seen = np.zeros(BUCKETS, bool)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (E, W, B)]
    step = 0
    epochs = -(-steps // max(len(parts), 1))  # small samples are passed over more often
    for epoch in range(epochs):
        for b in parts:
            step += 1
            n = len(b["per"])
            V = _summed(b["own"], E[:, b["gram"]], n) / b["per"]
            X = _summed(b["of"], V[:, b["word"]], b["k"]) / WINDOW
            z = X.T @ W + B
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            if 10 * epoch < 3 * epochs:  # first every window bears its document's label, then the highest alone
                pick = b["weight"] / np.repeat(b["runs"], b["runs"])
            else:
                margin = z[:, 1] - z[:, 0]
                hit = margin == np.repeat(np.maximum.reduceat(margin, b["starts"]), b["runs"])
                pick = b["weight"] * hit / np.repeat(np.add.reduceat(hit.astype(np.float32), b["starts"]), b["runs"])
            p[np.arange(b["k"]), b["y"]] -= 1
            g = (p * (pick / b["total"])[:, None]).astype(np.float32)
            gW, gB = X @ g, g.sum(0)
            gV = _summed(b["word"], (W @ g.T / WINDOW)[:, b["of"]], n) / b["per"]
            gE = _summed(b["gram"], gV[:, b["own"]], BUCKETS)
            seen[b["gram"]] = True
            for (m, v), param, grad in zip(state, (E, W, B), (gE, gW, gB)):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                param -= (RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + FLOOR)).astype(np.float32)
    table = np.where(seen, (W[:, 1] - W[:, 0]) @ E, 0).astype(np.float32)
    return table, float(B[1] - B[0])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Fit on labelled rows that are not held out. docs: (doc_id, text), labels: (doc_id, toxic)."""
    lab = labels.select("doc_id", "toxic").where("toxic in (0, 1)").where(~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    count = {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(count.values())
    if len(count) < 2:
        share = (count.get(1, 0) / total) if total else 0.0
        return np.zeros(BUCKETS, np.float32), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    cut = F.when(F.col("toxic") == 1, F.lit(min(1.0, FIT_ROWS / count[1]))).otherwise(F.lit(min(1.0, FIT_ROWS / count[0])))
    # labels are thinned first: about 2 * FIT_ROWS ids at any size of the tables, few enough to broadcast
    chosen = lab.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < cut * (1 << 30))
    sample = docs.select("doc_id", "text").where(f"length(text) between 1 and {FIT_CHARS}").join(F.broadcast(chosen), "doc_id") \
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic").collect()
    sample.sort(key=lambda r: (r["toxic"], r["text"]))
    y = np.array([r["toxic"] for r in sample])
    if len(set(y.tolist())) < 2 or not any(WORD.search(r["text"]) for r in sample):
        return np.zeros(BUCKETS, np.float32), float(np.log(count[1] / count[0]))
    n = np.bincount(y, minlength=2)
    weight = np.where(y == 1, count[1] / n[1], count[0] / n[0]) / total
    return fit([r["text"] for r in sample], y, weight.astype(np.float32))


def score_documents(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, score) for every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value
        table, cache = table.astype(np.float64), {}
        for batch in batches:
            score = score_texts(batch.column("text").to_pylist(), table, bias, cache)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

    typ = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {typ}, score double")


def keep_clean(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that score below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value
        table, cache = table.astype(np.float64), {}
        for batch in batches:
            score = score_texts(batch.column("text").to_pylist(), table, bias, cache)
            yield batch.filter(pa.array(score < threshold))

    return docs.mapInArrow(run, docs.schema)

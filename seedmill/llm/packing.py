"""Lexical retrieval packing of documents into training sequences.

1. Every document becomes token ids (vocabulary file given by path) and one end id. Whole windows
   of a long document are sequences of their own at once, map-side; the rest (shorter than a
   window) is a fragment. So no document, however long, weighs on a task.
2. Document frequencies of the ids are counted over all fragments. The vocabulary bounds that
   table (49,408 ids), so it is broadcast.
3. Fragments are ordered by their most telling ids (largest tf x idf) and dealt by range into
   shards of ``SHARD_TOKENS``; lexically close documents come near each other, and equal keys are
   split by a hash, so copies of one text never pile up in one task.
4. Each shard holds a BM25 inverted index of its fragments. A seed's heaviest terms query it;
   the unused neighbours, best first, fill the seed's window. The last one is cut to fit and its
   rest stays unused in the index. A shard's remainder closes in sequences of powers of two, which
   need no padding.

Ids: words of plain letters run through the same merges by a faster library when it agrees with
the vocabulary file, each distinct word once per worker cache; everything else goes to
``tokenizers``. Both give the same ids (tested on whole tables).

Defined cases: null and empty texts are the end id alone; repeated rows are packed each on its own;
a null doc_id stays null; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import gc
import json
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

WINDOW, END_ID = 4096, 2
SHARD_TOKENS, TERMS = 1_500_000, 12
K1, B = 1.2, 0.75
CACHE = 600_000  # entries of a worker's caches
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
PIECE_NAMES = [c.split()[0] for c in PIECE.split(", ")]
_MARK = "\x01"  # ends a word where the faster library merges; texts that hold it go the plain way


class WordIds:
    """Token ids of texts, as little-endian 16-bit bytes; same ids as ``tokenizers`` without special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.plain = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}  # by chunk between white space
        self.words: dict[str, bytes] = {}  # by lower-cased word
        self.tails: dict[str, bytes] = {}  # by end marks
        self.fast, self.ids, self.ends = self._merges(path)

    @staticmethod
    def _merges(path: str):
        """The file's merges as ranked byte strings; a word's last byte carries the end mark first of all."""
        import tiktoken
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        sign = {b: chr(b) for b in printable}  # byte-level alphabet: printable bytes as themselves, the others from 256 on
        sign |= {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in sign)}
        byte = {c: bytes([b]) for b, c in sign.items()}

        def raw(token: str) -> bytes:
            word = token.removesuffix("</w>")
            return b"".join(byte[c] for c in word) + (_MARK.encode() if word != token else b"")

        ranks: dict[bytes, int] = {}
        ids: list[int] = []
        for suffix in ("</w>", ""):
            for c, b in byte.items():
                if b != _MARK.encode() or not suffix:
                    ranks[raw(c + suffix)] = len(ids)
                    ids.append(vocab.get(c + suffix, -1))
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            if raw(a + b) not in ranks:
                ranks[raw(a + b)] = len(ids)
                ids.append(vocab[a + b])
        ends = np.zeros(len(ids), bool)
        for token, rank in ranks.items():
            ends[rank] = token.endswith(_MARK.encode())
        fast = tiktoken.Encoding("words", pat_str=rf"[^{_MARK}]+{_MARK}", mergeable_ranks=ranks, special_tokens={})
        return fast, np.array(ids), ends

    def _whole(self, text: str) -> bytes:
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def _learn(self, chunks: set[str]) -> None:
        """Put the ids of the chunks into the cache; each new word of plain letters is merged once, whatever its case and its end marks."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        if len(self.words) > CACHE:
            self.words.clear()
        fresh = chunks.difference(self.cache)
        bare = [c for c in fresh if c.isascii() and c.isalpha()]  # most words: no end marks to part
        lows = list(map(str.lower, bare))
        simple: list[tuple[str, str, str]] = []
        for chunk in fresh.difference(bare):
            core = chunk.rstrip(".,;:!?")
            if core.isalpha() and (core.isascii() or max(core) < "Ā"):
                simple.append((chunk, core.lower(), chunk[len(core):]))
            else:
                self.cache[chunk] = self._whole(chunk)
        if new := list({*lows, *(low for _, low, _ in simple)}.difference(self.words)):
            ranks = self.fast.encode_to_numpy(_MARK.join(new) + _MARK)
            raw = self.ids[ranks].astype("<u2").tobytes()
            stops = ((np.flatnonzero(self.ends[ranks]) + 1) * 2).tolist()
            self.words.update(zip(new, map(raw.__getitem__, map(slice, [0, *stops], stops))))
        self.cache.update(zip(bare, map(self.words.__getitem__, lows)))
        for chunk, low, tail in simple:
            if not tail:
                self.cache[chunk] = self.words[low]
                continue
            if tail not in self.tails:
                self.tails[tail] = self._whole(tail)
            self.cache[chunk] = self.words[low] + self.tails[tail]

    def texts(self, texts: list[str]) -> list[bytes]:
        odd = [any(c in t for c in ("<|", "\x01", "\x1c", "\x1d", "\x1e", "\x1f")) for t in texts]
        words = [[] if o else t.split() for t, o in zip(texts, odd)]
        self._learn(set().union(*words))
        get = self.cache.__getitem__
        return [self._whole(t) if o else b"".join(map(get, ws)) for t, ws, o in zip(texts, words, odd)]


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One per worker process: its tasks share the caches, which hold at most ``CACHE`` entries each."""
    return WordIds(path)


@contextmanager
def no_cycles() -> Iterator[None]:
    """Without the search for reference cycles: the caches hold none, and it would walk them again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def rows_batch(out: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Rows as an Arrow batch of longs and, for ``tokens``, bytes; missing values stay missing."""
    columns = list(zip(*out)) if out else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "tokens" else pa.int64()) for n, c in zip(names, columns)], names)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """Rows of whole windows (tokens null, sequence_id set) and of fragments (tokens set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base = (1 << 62) + (TaskContext.get().partitionId() << 36)
        words, windows = word_ids(path), 0
        end = np.array([END_ID], dtype="<u2").tobytes()
        for batch in batches:
            ids_of, part, size = [], [], 0
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for t in [*texts, None]:  # about a million characters at a time
                if t is None or size > 1 << 20:
                    with no_cycles():
                        ids_of += words.texts(part)
                    part, size = [], 0
                if t is not None:
                    part.append(t)
                    size += len(t)
            out = []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), ids_of):
                ids = np.frombuffer(raw + end, dtype="<u2")
                whole = len(ids) // WINDOW * WINDOW
                for at in range(0, whole, WINDOW):
                    out.append((doc_id, at, WINDOW, crc(ids[at:at + WINDOW]), len(ids), base + windows, 0, None))
                    windows += 1
                if whole < len(ids):
                    out.append((doc_id, whole, len(ids) - whole, None, len(ids), None, None, ids[whole:].tobytes()))
            yield rows_batch(out, [*PIECE_NAMES, "tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECE + ", tokens binary")


def frequencies(fragments: DataFrame, vocabulary: int = 1 << 16) -> np.ndarray:
    """Number of fragments that hold each id; one row per task and id, summed by id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = np.zeros(vocabulary, np.int64)
        for pdf in batches:
            held = pdf["tokens"].tolist()
            for at in range(0, len(held), 256):  # sorted together: fragment above id, each pair once
                part = held[at:at + 256]
                ids = np.frombuffer(b"".join(part), dtype="<u2").astype(np.uint32)
                owner = np.repeat(np.arange(len(part), dtype=np.uint32), [len(t) // 2 for t in part])
                pairs = np.sort(owner << np.uint32(16) | ids)
                once = np.flatnonzero(np.diff(pairs, prepend=pairs[:1] ^ np.uint32(1)))
                count += np.bincount(pairs[once] & np.uint32(0xFFFF), minlength=vocabulary)
        at = np.flatnonzero(count)
        yield pd.DataFrame({"id": at, "n": count[at]})

    df = np.zeros(vocabulary, np.int64)
    for r in fragments.select("tokens").mapInPandas(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        df[r["id"]] = r["n"]
    return df


def telling(ids: np.ndarray, idf: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with the largest tf x idf and their counts."""
    u, tf = np.unique(ids, return_counts=True)
    weight = idf[u] * tf * (K1 + 1) / (tf + K1)
    by = np.lexsort((u, -weight))[:terms]
    return u[by], tf[by]


def keyed(fragments: DataFrame, shared) -> DataFrame:
    """Fragments with the order of their shard: their two most telling ids, then a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, salt = [], []
            for t in batch.column("tokens").to_pylist():
                top, _ = telling(np.frombuffer(t, dtype="<u2"), shared.value, 2)
                key.append((int(top[0]) << 16) + int(top[-1]))
                salt.append(zlib.crc32(t))
            yield batch.append_column("key", pa.array(key, pa.int64())).append_column("salt", pa.array(salt, pa.int64()))

    f = fragments.select("doc_id", "start", "length", "doc_tokens", "tokens")
    return f.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, tokens binary, key long, salt long")


class Shard:
    """A BM25 index over some fragments, and the windows filled from it."""

    def __init__(self, rows: list[tuple], idf: np.ndarray):
        self.rows, self.idf = rows, idf
        self.ids = [np.frombuffer(r[3], dtype="<u2") for r in rows]
        n = len(rows)
        unique = [np.unique(x, return_counts=True) for x in self.ids]
        size = np.array([len(x) for x in self.ids], dtype=np.float64)
        term = np.concatenate([u for u, _ in unique])
        tf = np.concatenate([c for _, c in unique]).astype(np.float64)
        owner = np.repeat(np.arange(n), [len(u) for u, _ in unique])
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[owner] / size.mean()))
        by = np.argsort(term, kind="stable")
        self.owner, self.weight = owner[by], weight[by]
        self.first = np.searchsorted(term[by], np.arange(1 << 16))
        self.last = np.searchsorted(term[by], np.arange(1 << 16), side="right")
        self.used = np.zeros(n, bool)
        self.start = np.zeros(n, np.int64)  # ids of the fragment that are already packed

    def neighbours(self, seed: int) -> np.ndarray:
        """Unused fragments that share a query term with the seed, best score first."""
        terms, _ = telling(self.ids[seed], self.idf, TERMS)
        spans = [slice(self.first[t], self.last[t]) for t in terms]
        score = np.bincount(np.concatenate([self.owner[s] for s in spans]), weights=np.concatenate([self.weight[s] for s in spans]),
                            minlength=len(self.rows))
        score[self.used] = 0
        found = np.flatnonzero(score)
        return found[np.lexsort((found, -score[found]))]

    def sequences(self) -> Iterator[list[tuple[int, int, int]]]:
        """Lists of (fragment, start, length), each a full window or a power of two."""
        window: list[tuple[int, int, int]] = []
        room = WINDOW

        def put(i: int) -> None:
            nonlocal room
            take = min(room, len(self.ids[i]) - int(self.start[i]))
            window.append((i, int(self.start[i]), take))
            self.start[i] += take
            room -= take
            if self.start[i] == len(self.ids[i]):
                self.used[i] = True

        nxt = 0
        while True:
            while nxt < len(self.rows) and self.used[nxt]:
                nxt += 1
            if nxt == len(self.rows):
                break
            seed = nxt  # opens a window, or goes on with one whose seeds have no more neighbours
            put(seed)
            if room:
                for i in self.neighbours(seed):
                    put(int(i))
                    if not room:
                        break
            if not room:
                yield window
                window, room = [], WINDOW
        # the rest of the shard: a power of two at a time
        left = WINDOW - room
        while left:
            size = 1 << (left.bit_length() - 1)
            part, need = [], size
            while need:
                i, s, n = window[0]
                take = min(n, need)
                part.append((i, s, take))
                window[0] = (i, s + take, n - take)
                if n == take:
                    window.pop(0)
                need -= take
            yield part
            left -= size


def packed(fragments: DataFrame, shared) -> DataFrame:
    """Pieces of the sequences of all shards; a task cuts its sorted rows into shards as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        idf, count = shared.value, TaskContext.get().partitionId() << 36

        def close(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal count
            shard, out = Shard(rows, idf), []
            for sequence in shard.sequences():
                offset = 0
                for i, s, n in sequence:
                    doc_id, start, doc_tokens, _ = rows[i]
                    out.append((doc_id, start + s, n, crc(shard.ids[i][s:s + n]), doc_tokens, count, offset))
                    offset += n
                count += 1
            return rows_batch(out, PIECE_NAMES)

        rows, size = [], 0
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "tokens")]):
                tokens = row[3]
                rows.append(row)
                size += len(tokens) // 2
                if size >= SHARD_TOKENS:
                    yield close(rows)
                    rows, size = [], 0
        if rows:
            yield close(rows)

    return fragments.select("doc_id", "start", "doc_tokens", "tokens").mapInArrow(run, PIECE)


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    table = saved(tokenized(docs, tokenizer_path), "tokens")
    fragments = table.where("tokens is not null")
    df = frequencies(fragments)
    counted = fragments.agg(F.count("*").alias("n"), F.sum("length").alias("ids")).first()
    total = counted["n"]
    idf = np.log1p((total - df + 0.5) / (df + 0.5))
    shared = spark.sparkContext.broadcast(idf)
    shards = max(1, -(-(counted["ids"] or 0) // SHARD_TOKENS))
    dealt = keyed(fragments, shared).repartitionByRange(shards, "key", "salt").sortWithinPartitions("key", "salt", "doc_id", "start")
    whole = table.where("tokens is null").drop("tokens")
    return whole.unionByName(packed(dealt, shared))

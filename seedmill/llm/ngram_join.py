"""N-gram Jaccard join by vertical partitioning.

A document is the set of its distinct k-word shingles (64-bit hashes). A global order of all
shingles, rare ones first, is cut into ``FRAGMENTS`` vertical fragments. A pair of documents is
counted fragment by fragment, and the partial overlaps are summed per pair.

1. One pass gives each document's set size and a 128-bit digest of the set, and each task's part
   of a frequency sketch (``SKETCH`` counters). Documents with equal sets are one class from here on.
2. The order is (sketch count, hash): the same for all documents, so prefix filtering is exact
   whatever the sketch's collisions; rare shingles come first, frequent ones last. Fragment
   borders cut the order into parts of equal load.
3. Classes that can reach the threshold share a shingle among the first n - ceil(t n) + 1. For each
   such shingle one pivot (the class in whose order it stands first) is paired with the others:
   as many pairs as postings, not their square.
4. Pairs are verified exactly by summed partial overlaps; components of the links follow.
5. Pairs of one posting that stand in different components after that are verified too (length,
   positional and parity filters first, all exact), so no link between components is missed. A pair inside a component
   cannot change it, which is why near copies are never expanded into all pairs.

Sets are never shuffled as a whole: the segments of classes that occur in some pair are sent
(a Bloom filter of ``BLOOM`` bits picks them map-side; false positives fall out in the join).
Sketch and Bloom filter have a fixed size (2 and 8 MB), so both broadcasts are bounded; past
their resolution they only cost work, never a pair.

Defined cases: null, empty and white-space texts have the empty set and are linked with nothing; a
text of fewer than k words has one shingle, all its words; rows with equal texts are one class;
rows that share a doc_id are judged each on its own text; a null doc_id never names a component
(alone it gets a null component). Extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved
from .components import components

SKETCH, FRAGMENTS, BLOOM, CHUNKS = 1 << 19, 4, 1 << 26, 64
HOT = 50_000  # a shingle counted more often is dealt over count / HOT parts
LAST = (1 << 63) - 1
PARITY = [f"w{i}" for i in range(8)]
PART = 1 << 20  # bytes of a text hashed at once
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9DDFEA08EB382D69)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S33)) * _M1
    h = (h ^ (h >> _S33)) * _M2
    return h ^ (h >> _S33)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word (between ASCII white space, A-Z lower-cased), in order."""
    data = text.encode("utf-8", "surrogatepass").lower()
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + PART)
        if end < len(data):
            cut = max(data.rfind(b" ", at, end), data.rfind(b"\n", at, end))
            if cut <= at:  # a word longer than a part: up to its end
                nxt = [i for i in (data.find(b" ", end), data.find(b"\n", end)) if i >= 0]
                cut = min(nxt) if nxt else len(data)
            end = cut
        b = np.frombuffer(data[at:end], dtype=np.uint8)
        at = end
        inside = ~_SPACE[b]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        nth = np.cumsum(first) - 1
        place = np.arange(len(b)) - starts[np.maximum(nth, 0)]
        longest = int(place[inside].max()) + 1
        power = np.cumprod(np.full(longest, _STEP, dtype=np.uint64))
        v = np.where(inside, _BYTE[b], np.uint64(0))
        v *= power[np.minimum(place, longest - 1)]
        out.append(mix(np.add.reduceat(v, starts)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    w = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(w):
        return w
    size = min(k, len(w))
    n = len(w) - size + 1
    h = np.full(n, size * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for i in range(size):
        h = h + mix(w[i:i + n] * _PLACE[i])
    return np.unique(mix(h))


def digest(s: np.ndarray) -> tuple[int, int, int]:
    """(size, node, check): identifies the set; node also names its class."""
    node = s.sum(dtype=np.uint64)
    check = mix(s ^ _M1).sum(dtype=np.uint64)
    return len(s), int(node.astype(np.int64)), int(check.astype(np.int64))


def parity(s: np.ndarray) -> list[int]:
    """512 bits as eight words: of each of 512 parts of the hash space, whether the set has an odd number there.

    Two sets differ in at least as many elements as their parities differ in bits.
    """
    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) & 511, minlength=512).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64).tolist()


def counter(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - 19)).astype(np.int64)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def chunk_rows(array: np.ndarray, task: int) -> pd.DataFrame:
    parts = np.split(array, CHUNKS)
    return pd.DataFrame({"chunk": range(CHUNKS), "task": task, "data": [zlib.compress(p.tobytes(), 1) for p in parts]})


def fold_arrays(df: DataFrame, dtype, join) -> np.ndarray:
    """Combine fixed-size arrays that tasks emitted as (chunk, task, data); two rounds keep groups small."""

    def step(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(zlib.decompress(pdf["data"].iloc[0]), dtype=dtype).copy()
        for d in pdf["data"].iloc[1:]:
            join(total, np.frombuffer(zlib.decompress(d), dtype=dtype), out=total)
        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "task": [pdf["task"].iloc[0] % 64], "data": [zlib.compress(total.tobytes(), 1)]})

    schema = "chunk int, task long, data binary"
    once = df.groupBy("chunk", F.pmod("task", F.lit(64)).alias("part")).applyInPandas(lambda pdf: step(pdf), schema)
    got = once.groupBy("chunk").applyInPandas(lambda pdf: step(pdf), schema).collect()
    parts = {r["chunk"]: np.frombuffer(zlib.decompress(r["data"]), dtype=dtype) for r in got}
    return np.concatenate([parts[i] for i in range(CHUNKS)]) if parts else None


class NgramJoin:
    """Classes, links and components of one table (doc_id, text)."""

    def __init__(self, docs: DataFrame, k: int = 4, percent: int = 85):
        self.k, self.percent = k, percent
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tag"))
        self.spark = docs.sparkSession

    def digests(self) -> DataFrame:
        """Rows (doc_id, tag, n, node, check, parity) of all documents, and rows (chunk, task, data) of the sketch, in one table."""
        k = self.k
        longs = ["doc_id", "tag", "n", "node", "check", *PARITY]
        schema = ", ".join(f"{c} long" for c in longs) + ", chunk int, task long, data binary"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            sketch = np.zeros(SKETCH, np.int64)
            any_rows = False
            for batch in batches:
                rows = []
                for text in batch.column("text").to_pylist():
                    s = shingle_set(text, k)
                    if len(s) > 50_000:
                        sketch += np.bincount(counter(s), minlength=SKETCH)
                    elif len(s):
                        np.add.at(sketch, counter(s), 1)
                    rows.append((*digest(s), *parity(s)))
                any_rows = any_rows or bool(rows)
                found = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * (3 + len(PARITY))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), *found, pa.nulls(len(rows), pa.int32()),
                                                  pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.binary())], [*longs, "chunk", "task", "data"])
            if any_rows:
                part = chunk_rows(sketch, TaskContext.get().partitionId())
                yield pa.RecordBatch.from_arrays([*[pa.nulls(CHUNKS, pa.int64())] * len(longs), pa.array(part["chunk"], pa.int32()),
                                                  pa.array(part["task"], pa.int64()), pa.array(part["data"], pa.binary())], [*longs, "chunk", "task", "data"])

        return saved(self.docs.mapInArrow(run, schema), "digests")

    def order(self, sketch: np.ndarray):
        """(counts, fragment of each counter): borders of equal load in the order of counts."""
        by = np.argsort(sketch, kind="stable")
        load = np.cumsum(sketch[by])
        frag = np.zeros(SKETCH, np.uint8)
        frag[by] = np.minimum((load - 1).clip(0) * FRAGMENTS // max(int(load[-1]), 1), FRAGMENTS - 1)
        # counters of equal count must not straddle a border
        for c in np.unique(sketch[by][np.flatnonzero(np.diff(frag[by])) + 1]) if len(by) > 1 else []:
            same = sketch == c
            frag[same] = frag[same].min()
        return np.minimum(sketch, np.iinfo(np.int32).max).astype(np.int32), frag

    def postings(self, shared) -> DataFrame:
        """(gram, part, parts, node, n, pos) of each class's prefix; a gram that the sketch counts once joins nothing.

        part: which of ``parts`` the row of a gram goes to; a gram has more than one if the sketch counts it often.
        """
        k, percent = self.k, self.percent
        names = ["gram", "part", "parts", "node", "n", "pos"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, _ = shared.value
            seen: set[int] = set()
            for batch in batches:
                out: list[list[np.ndarray]] = [[] for _ in names]
                for text in batch.column("text").to_pylist():
                    s = shingle_set(text, k)
                    n, node, _ = digest(s)
                    if not n or node in seen:
                        continue
                    if len(seen) < 200_000:
                        seen.add(node)
                    c = counts[counter(s)]
                    by = np.lexsort((s, c))[:prefix_size(n, percent)]
                    keep = np.flatnonzero(c[by] > 1)
                    parts = 1 + c[by][keep].astype(np.int64) // HOT
                    size = len(keep)
                    for column, value in zip(out, (s[by][keep].view(np.int64), node % parts, parts, np.full(size, node), np.full(size, n), keep)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64()) for x in out], names)

        return self.docs.select("text").mapInArrow(run, ", ".join(f"{c} long" for c in names))

    def shared_postings(self, shared) -> DataFrame:
        """(gram, node, n, pos, b, nb, pb) of the grams that several classes have; b: the gram's pivot class."""
        post = self.postings(shared)
        own = Window.partitionBy("gram", "part")
        post = post.withColumn("p", F.min(F.struct("pos", "node", "n")).over(own)) \
            .withColumn("lo", F.min("node").over(own)).withColumn("hi", F.max("node").over(own))
        post = saved(post.where("lo <> hi or parts > 1"), "parts")
        whole = post.where("parts = 1")
        hot = post.where("parts > 1")
        found = hot.groupBy("gram").agg(F.min("p").alias("p"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi")
        hot = hot.drop("p", "lo", "hi").join(found, "gram")
        both = whole.unionByName(hot).select("gram", "node", "n", "pos", F.col("p.node").alias("b"), F.col("p.n").alias("nb"), F.col("p.pos").alias("pb"))
        return both.distinct()

    def segments(self, shared, nodes: DataFrame) -> DataFrame:
        """(node, n, frag, grams) of the classes that the Bloom filter of ``nodes`` lets pass."""
        k = self.k

        def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext
            bits = None
            for pdf in batches:
                bits = np.zeros(BLOOM // 8, np.uint8) if bits is None else bits
                h = mix(pdf["node"].to_numpy(dtype=np.int64).view(np.uint64))
                for g in (h >> np.uint64(38), (h & np.uint64(BLOOM - 1))):
                    np.bitwise_or.at(bits, (g >> np.uint64(3)).astype(np.int64), np.uint8(1) << (g & np.uint64(7)).astype(np.uint8))
            if bits is not None:
                yield chunk_rows(bits, TaskContext.get().partitionId())

        bits = fold_arrays(nodes.select("node").distinct().mapInPandas(mark, "chunk int, task long, data binary"), np.uint8, np.bitwise_or)
        bloom = self.spark.sparkContext.broadcast(bits if bits is not None else np.zeros(BLOOM // 8, np.uint8))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            (_, frag), bits = shared.value, bloom.value
            seen: set[int] = set()
            for pdf in batches:
                out = []
                for text in pdf["text"]:
                    s = shingle_set(text, k)
                    n, node, _ = digest(s)
                    if not n or node in seen:
                        continue
                    h = int(mix(np.array([node], dtype=np.int64).view(np.uint64))[0])
                    if any(not (bits[g >> 3] >> (g & 7)) & 1 for g in (h >> 38, h & (BLOOM - 1))):
                        continue
                    if len(seen) < 200_000:
                        seen.add(node)
                    f = frag[counter(s)]
                    out += [(node, n, i, s[f == i].view(np.int64)) for i in range(FRAGMENTS)]
                yield pd.DataFrame(out, columns=["node", "n", "frag", "grams"])

        raw = self.docs.mapInPandas(run, "node long, n long, frag int, grams array<long>")
        return raw.groupBy("node", "frag").agg(F.first("n").alias("n"), F.first("grams").alias("grams"))

    def verify(self, pairs: DataFrame, shared) -> DataFrame:
        """(a, b) of the pairs whose summed partial overlaps reach the threshold."""
        nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
        seg = saved(self.segments(shared, nodes), "segments")
        left = pairs.join(seg.select(F.col("node").alias("a"), "frag", F.col("n").alias("na"), F.col("grams").alias("ga")), "a")
        right = seg.select(F.col("node").alias("b"), "frag", F.col("n").alias("nb"), F.col("grams").alias("gb"))
        partial = left.join(right, ["b", "frag"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).cast("long").alias("part"))
        total = partial.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.sum("part").alias("o"))
        return total.where(f"100 * o >= {self.percent} * (na + nb - o)").select("a", "b")

    def bound(self, na: str, pa: str, nb: str, pb: str):
        """Length and positional filter: the overlap still possible, given one common shingle at these places."""
        t = self.percent
        most = F.least(pa, pb) + 1 + F.least(F.col(na) - F.col(pa) - 1, F.col(nb) - F.col(pb) - 1)
        return (100 * F.least(na, nb) >= t * F.greatest(na, nb)) & ((100 + t) * most >= t * (F.col(na) + F.col(nb)))

    def close(self, na: str, a: str, nb: str, b: str):
        """Difference filter: parities that differ in too many bits rule a pair out."""
        bits = sum((F.bit_count(F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}"))) for w in PARITY), F.lit(0))
        return (100 + self.percent) * bits <= (100 - self.percent) * (F.col(na) + F.col(nb))

    def run(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(digests, links between classes, components of classes)."""
        table = self.digests()
        sketch = fold_arrays(table.where("chunk is not null").select("chunk", "task", "data"), np.int64, np.add)
        shared = self.spark.sparkContext.broadcast(self.order(sketch if sketch is not None else np.zeros(SKETCH, np.int64)))
        docs = table.where("n is not null").select("doc_id", "tag", "n", "node", "check")
        words = table.where("n > 0").groupBy("node").agg(F.first(F.struct(*PARITY)).alias("w"))
        post = saved(self.shared_postings(shared), "postings")
        near = post.where("node <> b").where(self.bound("n", "pos", "nb", "pb"))
        near = near.select(F.col("node").alias("a"), F.col("n").alias("na"), "b", "nb").distinct() \
            .join(words.select(F.col("node").alias("a"), F.col("w").alias("wa")), "a") \
            .join(words.select(F.col("node").alias("b"), F.col("w").alias("wb")), "b").where(self.close("na", "wa", "nb", "wb"))
        pairs = saved(near.select("a", "b"), "pairs")
        links = saved(self.verify(pairs, shared), "links")
        comp = components(links)
        # pairs of one posting, without its pivot, that are still in different components
        at = post.where("node <> b").select("gram", "node", "n", "pos")
        more = at.groupBy("gram").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("gram")
        at = at.join(more, "gram", "left_semi").join(comp, "node", "left").select("gram", "node", "n", "pos", F.coalesce("root", "node").alias("root"))
        at = saved(at, "open")
        mixed = at.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("gram")
        at = at.join(mixed, "gram", "left_semi").join(words, "node")
        x = at.select("gram", F.col("node").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("root").alias("ra"), F.col("w").alias("wa"))
        y = at.select("gram", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("root").alias("rb"), F.col("w").alias("wb"))
        rest = x.join(y, "gram").where("a < b and ra <> rb").where(self.bound("na", "pa", "nb", "pb")) \
            .where(self.close("na", "wa", "nb", "wb")).select("a", "b").distinct()
        rest = saved(rest, "rest")
        if rest.isEmpty():
            return docs, links, comp
        links = links.unionByName(saved(self.verify(rest, shared), "more"))
        return docs, links, components(links)


def judged(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, tag, n, node, component, first, links) per row: first is the (doc_id, tag) that stands for its component.

    A null doc_id counts as the largest long here, so it names a component only where all its rows have none.
    """
    rows, links, comp = NgramJoin(docs, k, percent).run()
    by_class = rows.where("n > 0").groupBy("node").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "tag")).alias("first"))
    root = by_class.join(comp, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    named = root.groupBy("root").agg(F.min("first").alias("first"))
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    classes = root.select("node", "root").join(named, "root").join(degree, "node", "left").select("node", "first", F.coalesce("links", F.lit(0)).alias("links"))
    return rows.join(classes, "node", "left")


def ngram_components(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, connecting_links) for every row of docs.

    component_id: the smallest doc_id reachable by links; connecting_links: verified links of the row's class
    to classes with other sets that were needed to connect its component.
    """
    out = judged(docs, k, percent)
    component = F.when(F.col("first.doc") < LAST, F.col("first.doc")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(component, "doc_id").alias("component_id"), F.coalesce("links", F.lit(0)).alias("connecting_links"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of linked documents, the one with the smallest doc_id (null last); rows without words all stay."""
    found = judged(docs, k, percent)
    out = found.where(F.col("n") > 0).where((F.coalesce("doc_id", F.lit(LAST)) != F.col("first.doc")) | (F.col("tag") != F.col("first.tag")))
    out = saved(out.select("doc_id", "tag").distinct(), "out")
    # names of our own for all columns, so that none of docs' can clash
    given = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    doc, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    match = lambda: doc.cast("long").eqNullSafe(F.col("_doc")) & (F.xxhash64(text) == F.col("_tag"))
    left = given.join(out.select(F.col("doc_id").alias("_doc"), F.col("tag").alias("_tag")), match(), "left_anti")
    # rows repeated as a whole: one of them (rows without words are never linked)
    again = found.where(F.col("n") > 0).groupBy("doc_id", "tag").agg(F.count("*").alias("rows")).where("rows > 1")
    again = saved(again.select(F.col("doc_id").alias("_doc"), F.col("tag").alias("_tag")), "again")
    if not again.isEmpty():
        twice = left.join(again, match())
        first = twice.withColumn("_r", F.row_number().over(Window.partitionBy("_doc", "_tag").orderBy(F.lit(1)))).where("_r = 1")
        left = left.join(again, match(), "left_anti").unionByName(first.select(*given.columns))
    return left.toDF(*docs.columns)

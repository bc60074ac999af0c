"""Vector code compression: product codes over integer vectors, distances by per-dimension value dictionaries.

Every component x becomes the integer floor(256 * x); a vector is cut into equal consecutive parts, and a
part is coded by the nearest entry of its position's codebook (squared Euclidean distance, ties to the lower index).

Method: a block of vectors (one Arrow batch) holds few distinct integers in a dimension. Each dimension gets
the dictionary of its distinct integers and the vectors' codes in it; the squared difference of every
distinct integer to every entry's component is tabulated once, and the distances of all parts are
gathers from these tables by the codes, added over the part's dimensions.

Spark deals the blocks. A round's sums (part, entry, component) leave a block as partial sums, are added up
by Spark, and only the codebooks, whose size depends on the width alone, come to the driver and go out with
the next round's tasks. Sums travel as 40-bit limbs, so they are exact for every finite float.

Defined results: rows whose vector is null or holds a null or non-finite component take no part; without any
row left the result is empty. Null ids come last among the starting rows, equal ids are ordered by their
vectors. Vectors of another width than the first, or a width that the number of parts does not divide, end the run with an
error. A code's error beyond 64 bits ends it too (components beyond about 10^7). Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

PARTS, ENTRIES, ROUNDS = 16, 64, 2
LIMB = 40
SAFE = 1 << 26  # below it squared differences of 2^10 dimensions fit into 64 bits; beyond, Python integers count


def usable(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def integers(vectors: pa.ListArray, width: int | None) -> np.ndarray:
    """(rows, width) of floor(256 * x), exact: 64-bit integers, or Python ones where a value is large."""
    lengths = np.diff(vectors.offsets.to_numpy())
    if width is None:
        width = int(lengths[0]) if len(lengths) else 0
    if (lengths != width).any():
        raise ValueError(f"vectors of {width} components are expected, one has {int(lengths[lengths != width][0])}")
    x = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * 256.0)
    if x.size and not np.isfinite(x).all():
        raise OverflowError("a component beyond the range of 64-bit floats")
    out = np.array([int(v) for v in x], dtype=object) if x.size and np.abs(x).max() >= SAFE else x.astype(np.int64)
    return out.reshape(len(lengths), width)


def assign(v: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row and part the nearest entry's index and its squared distance. books: (parts, entries, step)."""
    parts, entries, step = books.shape
    index = np.zeros((len(v), parts), np.int64)
    least = np.zeros((len(v), parts), object if v.dtype == object or books.dtype == object else np.int64)
    for p in range(parts):
        total = np.zeros((len(v), entries), least.dtype)
        for j in range(step):
            values, codes = np.unique(v[:, p * step + j], return_inverse=True)
            table = (values[:, None] - books[p, :, j][None, :]) ** 2
            total += table[codes]
        index[:, p] = total.argmin(axis=1)
        least[:, p] = total[np.arange(len(v)), index[:, p]]
    return index, least


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """The value as signed multiples of powers of 2^LIMB, least first."""
    place, sign = 0, -1 if value < 0 else 1
    value = abs(value)
    while value:
        value, low = divmod(value, 1 << LIMB)
        if low:
            yield place, sign * low
        place += 1


def partial_sums(v: np.ndarray, index: np.ndarray, shape: tuple) -> Iterator[tuple[int, int, int, int, int]]:
    """(part, entry, component, limb, value) of a block's sums; component -1 holds the count."""
    parts, entries, step = shape
    for p in range(parts):
        count = np.bincount(index[:, p], minlength=entries)
        sums = np.zeros((entries, step), v.dtype)
        np.add.at(sums, index[:, p], v[:, p * step:(p + 1) * step])
        for e in np.nonzero(count)[0]:
            yield p, int(e), -1, 0, int(count[e])
            for j in range(step):
                for place, value in limbs(int(sums[e, j])):
                    yield p, int(e), j, place, value


def start(vectors: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """The parts of the vectors of the smallest ids, (parts, entries, step); None without a vector."""
    first = vectors.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).toArrow()
    if not first.num_rows:
        return None
    column = first.column("v").combine_chunks()
    v = integers(column if isinstance(column, pa.ListArray) else column.cast(pa.list_(column.type.value_type)), None)
    if v.shape[1] % parts:
        raise ValueError(f"{v.shape[1]} components cannot be cut into {parts} equal parts")
    return np.stack(np.split(v, parts, axis=1)) if v.shape[1] else np.zeros((parts, len(v), 0), np.int64)


def _tidy(books: list) -> np.ndarray:
    """Codebooks as 64-bit integers where they are small enough."""
    out = np.array(books, dtype=object)
    return out.astype(np.int64) if out.size == 0 or max(abs(x) for x in out.ravel()) < SAFE else out


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts, entries, step) after ``rounds`` of assignment and replacement by floored means; None without a vector.

    ``vectors``: id, v (usable vectors only).
    """
    books = start(vectors, parts, entries)
    for _ in range(rounds if books is not None else 0):
        width = books.shape[0] * books.shape[2]

        def sums(batches, books=books, width=width):
            for b in batches:
                v = integers(b.column(0), width)
                index, _ = assign(v, books)
                found = list(partial_sums(v, index, books.shape))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*found) if found else [()] * 5, [pa.int32()] * 4 + [pa.int64()])], ["part", "entry", "component", "limb", "value"])

        blocks = vectors.select("v").mapInArrow(sums, "part int, entry int, component int, limb int, value long")
        counts, total = {}, {}
        for r in blocks.groupBy("part", "entry", "component", "limb").agg(F.sum("value").alias("value")).toLocalIterator():
            if r["component"] < 0:
                counts[r["part"], r["entry"]] = r["value"]
            else:
                at = r["part"], r["entry"], r["component"]
                total[at] = total.get(at, 0) + (r["value"] << LIMB * r["limb"])
        books = _tidy([[[total.get((p, e, j), 0) // counts[p, e] if (p, e) in counts else int(books[p, e, j]) for j in range(books.shape[2])]
                        for e in range(books.shape[1])] for p in range(books.shape[0])]).reshape(books.shape)
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """Code (two hex digits a part; entries beyond 256 take as many as the largest index) and error of every vector; the other columns stay."""
    digits = max(2, len(f"{books.shape[1] - 1:x}"))
    width = books.shape[0] * books.shape[2]
    others = [c for c in vectors.columns if c != "v"]

    def codes(batches):
        for b in batches:
            index, least = assign(integers(b.column(b.schema.get_field_index("v")), width), books)
            text = ["".join(f"{e:0{digits}x}" for e in row) for row in index.tolist()]
            error = [sum(int(x) for x in row) for row in least.tolist()]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in others] + [pa.array(text, pa.string()), pa.array(error, pa.int64())],
                                             [*others, "code", "error"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields if f.name != "v"], "code string", "error long"])
    return vectors.mapInArrow(codes, schema)


def codebooks_digest(books: np.ndarray) -> str:
    """sha256 of all entries' components in decimal, by part, entry and component."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def compress(table: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """(id, label, code, error, label_error) of every usable row, and the codebooks.

    The codes are written once; errors are added up by label map-side first, so a label of a third of
    all rows is a few partial sums, and the totals come back by a join that Spark broadcasts where they are small.
    """
    given = table.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v")).where(usable(F.col("v")))
    books = train(given, parts, entries, rounds)
    if books is None:
        return given.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")).limit(0), None
    coded = saved(encode(given, books), "codes")
    totals = saved(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "errors")
    return coded.join(totals, coded["label"].eqNullSafe(totals["_label"])).drop("_label"), books

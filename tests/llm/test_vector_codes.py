import hashlib
import math
import random

import pytest

from seedmill.llm import queries as Q
from seedmill.llm import vector_codes as V
from seedmill.llm.common import rows
from tests.conftest import SF0001


def brute(table, parts=V.PARTS, entries=V.ENTRIES, rounds=V.ROUNDS):
    """Plain loops over Python integers. table: (vec_id, vector, label)."""
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in table if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return {}, ""
    step = len(kept[0][1]) // parts
    cut = [[v[p * step:(p + 1) * step] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))[:entries]
    books = [[list(cut[r][p]) for r in order] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda c: [min((dist(c[p], e), i) for i, e in enumerate(books[p])) for p in range(parts)]
    for _ in range(rounds):
        at = [near(c) for c in cut]
        books = [[([sum(x) // len(own) for x in zip(*own)] if own else e) for i, e in enumerate(books[p])
                  for own in [[c[p] for c, a in zip(cut, at) if a[p][1] == i]]] for p in range(parts)]
    at = [near(c) for c in cut]
    error = [sum(d for d, _ in a) for a in at]
    by = {}
    for (_, _, lab), e in zip(kept, error):
        by[lab] = by.get(lab, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{k:02x}" for _, k in a), e, by[lab]) for (i, _, lab), a, e in zip(kept, at, error)), digest


def found(spark, table, tmp_path, kind="float"):
    df = rows(spark, table, f"vec_id long, embedding array<{kind}>, label int").selectExpr("*", "1 AS id", "2 AS v", "3 AS code", "4 AS error", "'x' AS _label")
    df.write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    got = Q.op13_vector_codes(spark, str(tmp_path)).collect()
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"]) for r in got), got[0]["codebooks_sha256"] if got else ""


def test_on_given_embeddings(spark):
    table = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()]
    got = Q.op13_vector_codes(spark, SF0001).collect()
    want, digest = brute(table)
    assert sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"]) for r in got) == want
    assert {r["codebooks_sha256"] for r in got} == {digest}


@pytest.mark.parametrize("width", [16, 48])
def test_unusable_rows_ties_and_repeats(spark, tmp_path, width):
    rng = random.Random(width)
    vec = lambda: [rng.choice([-1.5, -0.004, 0.0, 0.25, 0.999, 3.0]) for _ in range(width)]
    table = [(i, vec(), rng.choice([None, 1, 2])) for i in rng.sample(range(-500, 500), 150)]
    table += [table[0]] * 40 + [(None, vec(), 1), (None, vec(), None), (5000, None, 1), (5001, [0.5] * (width - 1) + [None], 1),
                                (5002, [0.5] * (width - 1) + [math.nan], 1), (-5003, [math.inf] + [0.5] * (width - 1), 1), (-5004, [None], 2)]
    assert found(spark, table, tmp_path) == brute(table)


def test_few_none_and_large_values(spark, tmp_path):
    rng = random.Random(3)
    assert found(spark, [], tmp_path) == ([], "")
    assert found(spark, [(1, None, 1), (2, [math.nan] * 16, None)], tmp_path) == ([], "")
    few = [(i, [float(i + j) for j in range(32)], i % 2) for i in range(5)]
    assert found(spark, few, tmp_path) == brute(few)
    large = [(i, [rng.choice([-1e6, 1e6, 0.1, 2.0 ** 20 + 0.5]) for _ in range(16)], i % 2) for i in range(90)]
    assert found(spark, large, tmp_path, "double") == brute(large)


def test_sums_beyond_64_bits_are_exact(spark):
    """Equal huge vectors have error 0: their mean must come back exactly."""
    for x in (3.4e38, -3.4e38, 1e300):
        df = rows(spark, [(i, [x] * 16, 1) for i in range(9)], "vec_id long, embedding array<double>, label int")
        coded, books = V.compress(df)
        assert {(r["code"], r["error"]) for r in coded.collect()} == {("00" * 16, 0)} and int(books[0, 0, 0]) == math.floor(256 * x)


def test_widths(spark):
    with pytest.raises(ValueError):
        V.compress(rows(spark, [(1, [1.0] * 17, 1)], "vec_id long, embedding array<float>, label int"))
    with pytest.raises(Exception, match="components are expected"):
        V.compress(rows(spark, [(1, [1.0] * 16, 1), (2, [1.0] * 32, 1)], "vec_id long, embedding array<float>, label int"))

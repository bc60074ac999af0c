import random
import re
from itertools import permutations

import pytest

from seedmill.llm import filter_audit as A
from seedmill.llm.common import rows
from tests.conftest import SF0001


def failed(text, is_copy):
    words = re.findall("[^\x20\x09-\x0D]+", text)
    said = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text), "E": is_copy}
    return {c for c, x in said.items() if x}


def brute(docs, labels):
    """Every order run filter by filter over the documents."""
    first, marks = {}, {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, q, x in labels:
        g, b = marks.get(i, (0, 0))
        marks[i] = (max(g, int(q == 1)), max(b, int(x == 1)))
    told = [(part or "", failed(t or "", i is not None and i > first[t or ""]), *(marks.get(i, (0, 0)) if i is not None else (0, 0))) for i, t, part in docs]
    out = {}
    for part in {t[0] for t in told}:
        mine = [t[1:] for t in told if t[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [t for t in left if c in t[0]]
                kept = [t for t in left if c not in t[0]]
                again = sum(c in t[0] for t in mine) - len(gone)
                out[part, "".join(order), step] = [len(kept), len(gone), again, sum(t[0] == {c} for t in mine), sum(t[1] for t in gone), sum(t[2] for t in gone)]
                total[c] += len(gone)
                left = kept
        for (p, order, step), r in out.items():
            if p == part:
                r.append(total[order[step - 1]])
    return out


def found(docs, labels):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
            for r in A.audit(docs, labels).collect()}


def made(n=120, seed=11):
    rng = random.Random(seed)
    texts = ["", " \t\r\n", None, "A" * 10, "word " * 250, " ".join(f"w{i}" for i in range(250)), " ".join(f"w{i} X" for i in range(250)) + " #"]
    texts += [" ".join(rng.choice(["Up", "low", "x|y", "10%", "más", "Ölung"]) + str(rng.randrange(200)) for _ in range(rng.choice([20, 199, 200, 260]))) for _ in range(30)]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, "", "zz"])) for i in rng.sample(range(1000), n)]
    docs += [docs[0], docs[0], (None, docs[1][1], "en"), (None, None, None), (None, "own text", "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, _, _ in docs for _ in range(rng.randrange(3))]
    return docs, labels


def frames(spark, docs, labels):
    d = rows(spark, docs, "doc_id long, text string, lang string").selectExpr("*", "1 AS mask", "2 AS n", "3 AS part", "4 AS good", "'x' AS _text", "5 AS filter")
    return d, rows(spark, labels, "doc_id long, quality int, toxic int").selectExpr("*", "'y' AS text", "1 AS n", "7 AS part")


def test_equals_running_every_order(spark):
    docs, labels = made()
    assert found(*frames(spark, docs, labels)) == brute(docs, labels)


def test_on_given_documents(spark):
    d, lab = (spark.read.parquet(f"{SF0001}/{t}.parquet") for t in ("documents", "labels"))
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in d.collect()]
    assert found(d, lab) == brute(docs, [(r["doc_id"], r["quality"], r["toxic"]) for r in lab.collect()])


def test_one_text_of_a_third_of_all_rows(spark):
    docs = [(i, "same text" if i % 3 == 0 else f"text {i}", "en" if i % 2 else "de") for i in range(300)]
    assert found(*frames(spark, docs, [])) == brute(docs, [])


def test_empty_tables_and_long_texts(spark):
    d, lab = frames(spark, [], [])
    assert A.audit(d, lab).collect() == []
    docs = [(1, "long " * 400_000, None), (2, "é" * 300_000 + "#", None)]
    assert found(*frames(spark, docs, [])) == brute(docs, [])


def test_path_counts_and_limit(spark):
    from math import factorial
    for k in (1, 3, 5):
        for s, f, reach, leave in A.lattice(k):
            size = bin(s).count("1")
            assert reach == factorial(size) and leave == factorial(k - size - 1) and not s >> f & 1
    with pytest.raises(ValueError):
        A.audit(*frames(spark, [], []), letters="ABCDEFGH")

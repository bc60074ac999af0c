import random
import re

from seedmill.llm import ngram_join as N
from seedmill.llm.common import rows
from tests.conftest import SF0001


def brute(docs, k=4, percent=85):
    """(n, component) per row, by all pairs and union-find."""
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def near_copies(seed=5, groups=6, size=25, words=80):
    """Groups of copies with a few changed words, so that links form chains as well as stars."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=words)
        for _ in range(size):
            t = list(base)
            for _ in range(rng.randrange(6)):
                t[rng.randrange(words)] = rng.choice(vocabulary)
            if rng.random() < .3:
                base = t
            docs.append(" ".join(t))
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_components_equal_all_pairs(spark):
    docs = near_copies() + [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "One two"), (1004, "one TWO"), (1005, "a b c d"), (1006, "A B  C\nD"),
                            (1007, "é b c d"), (1008, "x " * 30000), (1009, "x " * 4), (3, "w1 w2 w3"), (1003, "One two"), (None, "lonely text here now"),
                            (None, "one two")]
    df = rows(spark, [(*d, "x") for d in docs], "doc_id long, text string, n string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in N.ngram_components(df).collect()), key=str)
    assert got == brute(docs)


def test_on_given_documents(spark):
    df = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in N.ngram_components(df, 5, 80).collect()), key=str)
    assert got == brute(docs, 5, 80)


def test_word_hashes_cut_anywhere(monkeypatch):
    text = "ab cd\tef  " * 50 + "z" * 300 + " end"
    whole = N.word_hashes(text).tolist()
    monkeypatch.setattr(N, "PART", 64)
    assert N.word_hashes(text).tolist() == whole and len(whole) == 152


def test_keep_one_and_empty(spark):
    docs = [(5, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (7, None), (8, ""), (8, ""), (2, "a b c d e f g"), (2, "other words stand here now")]
    df = rows(spark, [(d, t, i) for i, (d, t) in enumerate(docs)], "doc_id long, text string, node long")
    kept = N.keep_one(df, 5, 80)
    assert kept.columns == df.columns
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect()) == [("2", "a b c d e f g"), ("2", "other words stand here now"), ("7", ""), ("8", ""), ("8", "")]
    assert N.ngram_components(df.limit(0)).count() == 0 and N.keep_one(df.limit(0)).count() == 0


def test_components_of_paths(spark):
    from seedmill.llm.components import components
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (300, 100), (7, 7)]
    got = {r["node"]: r["root"] for r in components(rows(spark, edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}


def test_link_column_is_named_for_what_it_counts(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    from seedmill.llm.ngram_join import ngram_components
    assert ngram_components(df).columns == ["doc_id", "n_shingles", "component_id", "connecting_links"]

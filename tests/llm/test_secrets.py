import random
import re

from pyspark.sql import functions as F

from seedmill.llm import secret_scan as S
from seedmill.llm.common import rows


def brute(text):
    out = []
    for order, (kind, pattern, group, least) in enumerate(S.RULES):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m.group(group)) >= least:
                out.append((m.start(), order, kind, m.end()))
    return sorted(out)


TEXTS = [None, "", "password=12345678", "PassWd : 'abcdefgh1' token=x secret = \"ABCDEFGH=\"", "😀é api_key:AAAAAAAA apikey=BBBBBBBB\n" * 3,
         "AKIA1234567890AB AKIA12 AKIAAKIAAKIAAKIA", "f" * 31 + " " + "0" * 32 + "g" + "a" * 40, "x" * 200_000 + " token=" + "q" * 9,
         "password=short password=longenough", "passwd='secret=12345678'", "ghp_" + "A" * 36, "xoxb-12345678901234", "-----BEGIN RSA PRIVATE KEY-----",
         "secret==========", "tokentoken=aaaaaaaaa", "api_key = = password"]


def test_spans_equal_plain_search(spark):
    data = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "password=12345678", ""), (2, TEXTS[2], "")]
    out = S.scan_secrets(rows(spark, data, "doc_id long, text string, spans string")).collect()
    assert len(out) == len(data)
    got = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), [tuple(s) for s in r["spans"]]) for r in out)
    want = sorted(((-1 if i is None else i), brute(t)) for i, t, _ in data)
    assert got == want


def grams(word):
    return sorted({word[i:i + 3] for i in range(len(word) - 2)})


def test_queries_come_from_the_expressions():
    q = {kind: S.trigram_query(pattern) for kind, pattern, _, _ in S.RULES}
    assert q["assign"] == sorted(grams(w) for w in ("password", "passwd", "secret", "token", "apikey", "api_key"))
    assert q["access"] == [["aki", "kia"]] and q["hex"] == []
    assert q["github"] == sorted(grams(f"gh{c}_") for c in "pousr") and q["slack"] == sorted(grams(f"xox{c}-") for c in "abprs")
    assert q["pem"] == [sorted(set(grams("-----begin ")) | set(grams("private key-----")))]
    for pattern, clauses in {"": [], "ab": [], "abc": [["abc"]], "abc|abcd": [["abc"]], "(?i)ABC": [["abc"]], "a.c": [], "abc.*def": [["abc", "def"]], "(ab)+c": [],
                             "(abc)+": [["abc"]], "(abc){2}": [["abc", "bca", "cab"]], "(abc)*": [], "x(abc)?y": [], "xx(abc)?yy": sorted([["abc", "bcy", "cyy", "xab", "xxa"], ["xxy", "xyy"]]),
                             "[ab]cd": [["acd"], ["bcd"]], r"ab\d+cd": [], r"^abc\b": [["abc"]], "abc(?=d)": [["abc"]], r"(abc|\w)": []}.items():
        assert S.trigram_query(pattern) == clauses, pattern


def test_queries_hold_for_every_match():
    """Texts made from an expression satisfy its query, whatever the expression."""
    rng = random.Random(8)

    def make(depth):
        if depth == 0 or rng.random() < .3:
            return rng.choice(["a", "b", "ab", "abc", "c", "[ab]", "[a-f]", ".", "xyz", "A"])
        kind = rng.randrange(4)
        if kind == 0:
            return make(depth - 1) + make(depth - 1)
        if kind == 1:
            return f"(?:{make(depth - 1)}|{make(depth - 1)})"
        return f"(?:{make(depth - 1)})" + rng.choice(["?", "*", "+", "{2}", "{0,3}", "{1,2}", "*?"]) if kind == 2 else make(depth - 1) + rng.choice(["abc", "q"]) + make(depth - 1)

    matched = 0
    for _ in range(300):
        pattern = make(4)
        query = S.trigram_query(pattern)
        for _ in range(200):
            m = re.search(pattern, "".join(rng.choices(["abc", "ab", "a", "b", "c", "q", "xyz", "abcq", "A"], k=rng.randrange(12))))
            if m and query:
                matched += 1
                low = m.group(0).lower()
                assert any(all(g in low for g in c) for c in query), (pattern, m.group(0), query)
    assert matched > 500


def test_a_changed_rule_changes_the_search(spark):
    docs = rows(spark, [(1, "see zebra-123456 here"), (2, "see horse-123456 here"), (3, "9999 and 55")], "doc_id long, text string")
    scan = lambda p, n: {r["doc_id"]: [(x["start"], x["end"]) for x in r["spans"]] for r in S.scan_secrets(docs, [("own", p, 0, n)]).collect()}
    assert scan("zebra-[0-9]+", 1) == {1: [(4, 16)], 2: [], 3: []}
    assert {r["doc_id"] for r in S.candidates(docs, [("own", "zebra-[0-9]+", 0, 1)]).collect()} == {1}
    assert scan("horse-[0-9]+", 1) == {1: [], 2: [(4, 16)], 3: []} and {r["doc_id"] for r in S.candidates(docs, [("own", "horse-[0-9]+", 0, 1)]).collect()} == {2}
    assert S.trigram_query("[0-9]+") == [] and scan("[0-9]+", 3) == {1: [(10, 16)], 2: [(10, 16)], 3: [(0, 4)]}


def test_index_skips_documents(spark):
    docs = rows(spark, [(1, "nothing to see here"), (2, "the token of"), (3, "tok oke ken")], "doc_id long, text string")
    got = {r["doc_id"]: set(r["kinds"]) for r in S.candidates(docs).collect()}
    assert got == {2: {"assign"}, 3: {"assign"}}
    assert S.scan_secrets(docs.limit(0)).count() == 0
    assert S.scan_secrets(docs).where(F.size("spans") > 0).count() == 0

from seedmill.llm import url_filter as U
from seedmill.llm.common import rows
from seedmill.llm.queries import URL_RULES


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    import re
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[1:] if fit else None


URLS = [None, "", "nothing", "http://", "http://NET/", "http://net", "https://a.example.net/en/1?x#y", "http://example.net/fr/", "http://notnet/",
        "http://x.example.com/de/z", "http://x.example.com/de", "ftp://w.org/fr/", "http://org/fr/a/fr/", "http://ÀB.net/", "http://a.com?net/", "http://a.com/1",
        "http://www.a.com:80/1/?utm_source=q#t", "http://b.com/" + "x" * 5000, "://net/a", "a://b://net/", "http://a.com/1"]


def test_rules_and_listing(spark):
    pages = rows(spark, [(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, verdict string")
    rules = rows(spark, URL_RULES, "host string, path string, verdict string")
    out = {r["page_id"]: r for r in U.judge_urls(pages, rules, U.repeated_urls(pages)).collect()}
    assert len(out) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, fit = brute(u)
        assert (out[i]["host"], out[i]["path"]) == (host, path), u
        assert out[i]["rule"] == (fit[0] if fit else None), u
        if fit:
            assert out[i]["verdict"] == fit[1]
    assert [out[i]["verdict"] for i in (15, 16, 20)] == ["block"] * 3 and out[17]["verdict"] == "allow"


def test_filter_never_loses_a_key(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) as key")
    for blocks in (1, 64):
        assert U.possible_hits(keys, U.bloom_filter(keys, blocks), blocks).count() == 3000
    other = spark.range(3000).selectExpr("concat('z', id) as key")
    assert U.possible_hits(other, U.bloom_filter(keys, 1 << 10), 1 << 10).count() < 60


def test_empty_tables(spark):
    pages = rows(spark, [], "page_id long, url string")
    rules = rows(spark, [], "host string, path string, verdict string")
    assert U.judge_urls(pages, rules, U.repeated_urls(pages)).count() == 0
    one = rows(spark, [(1, "http://net/")], "page_id long, url string")
    assert U.judge_urls(one, rules, U.repeated_urls(one)).collect()[0]["verdict"] == "allow"


def test_kinds_of_entries_do_not_meet(spark):
    """A host that spells like another kind's key fits no entry of that kind."""
    rules = rows(spark, URL_RULES + [("u", "", "block")], "host string, path string, verdict string")
    listed = rows(spark, [("evil.com/abc",), ("rnet",)], "canonical string")
    urls = ["http://=evil.com/abc/x", "http://uevil.com/abc", "http://revil.com/abc/x", "http://evil.com/abc", "http://rnet/", "http://xnet/", "http://a.u/x"]
    out = [r["verdict"] for r in U.judge_urls(rows(spark, list(enumerate(urls)), "page_id long, url string"), rules, listed).orderBy("page_id").collect()]
    assert out == ["allow", "allow", "allow", "block", "block", "allow", "block"]


def test_long_hosts(spark):
    host = ".".join(["x"] * 50_000)
    urls = [f"http://{host}.net/", f"http://{host}/", "http://" + "y" * 100_000 + ".example.com/de/"]
    pages = rows(spark, list(enumerate(urls)), "page_id long, url string")
    rules = rows(spark, URL_RULES, "host string, path string, verdict string")
    out = {r["page_id"]: (r["rule"], r["verdict"]) for r in U.judge_urls(pages, rules, U.repeated_urls(pages)).collect()}
    assert out == {0: ("net/", "block"), 1: (None, "allow"), 2: ("example.com/de/", "block")}

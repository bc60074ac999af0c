from seedmill.llm import html_wrapper as H
from seedmill.llm.common import rows

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/1">One</a><li>Two</ul></nav><!-- <p>gone</p> --><div class="ad">Buy</div>
<div class="cookie-notice">We use cookies</div><article><header><h1>Head &amp; line {n}</h1></header><p><b>First {n}.</b><br>more&nbsp;text<p>Second
   {n}</p><ul><li>item a {n}<li>item b</ul><div class="share-buttons">Share</div><form><label>Mail</label><input></form>
<blockquote>Quote &lt;{n}&gt; &eacute;</blockquote>{extra}<section class="comments"><p>Great read {n}</p></section></article>
<aside id="sidebar"><p>Also {n}</p></aside><footer>&copy; host</footer></body></html>"""


def want(n, extra=()):
    return "\n\n".join([f"Head & line {n}", f"First {n}. more text", f"Second {n}", f"item a {n}", "item b", f"Quote <{n}> é", *extra])


def test_article_alone(spark):
    data = [(i, "http://a.x/%d" % i, PAGE.replace("{n}", str(i)).replace("{extra}", "<p>Extra</p>" if i % 3 == 0 else "")) for i in range(12)]
    data += [(50, "http://b.x/", None), (51, None, ""), (52, "http://b.x/1", "plain words"), (53, "http://c.x/", "<p>one<p>two"), (0, data[0][1], data[0][2]),
             (54, "http://d.x/", "<article><p>open <i>to</i> the end"), (55, "http://e.x/", "<p>a</p>" * 3000), (None, "http://a.x/n", PAGE), (56, "http://f.x/", "<div <p>x")]
    df = rows(spark, [(*d, "c") for d in data], "page_id long, url string, html string, text string")
    out = {}
    for r in H.extract_pages(df).collect():
        out.setdefault(r["page_id"], []).append(r["text"])
    for i in range(12):
        assert out[i] == [want(i, ["Extra"] if i % 3 == 0 else [])] * (2 if i == 0 else 1)
    assert out[50] == out[51] == [""] and out[53] == ["one\n\ntwo"] and out[54] == ["open to the end"] and out[55] == ["\n\n".join(["a"] * 3000)]
    assert out[52] == ["plain words"] and len(out[56]) == 1 and len(out[None]) == 1
    assert H.extract_pages(df.limit(0)).count() == 0


def test_wrapper_resolves_mismatches():
    page = lambda n, extra: H.fold(H.tokens(PAGE.replace("{n}", n).replace("{extra}", extra)))
    w = H.align(H.align(page("1", ""), page("2", "<p>E</p>")), page("3", ""))
    text = str(w)
    assert "'?'" in text and "'+'" in text and "'s'" in text and "'t'" in text
    found = H.places(w)
    assert found["html/body/footer"] is False and any(found[p] for p in found if p.endswith("article/p"))


def test_constants_are_boilerplate_without_article_mark(spark):
    page = "<body><div class='top'><p>Welcome to our site</p></div><div class='main'><p>Story {n} begins</p><p>and {n} ends</p></div></body>"
    df = rows(spark, [(i, "http://h/", page.replace("{n}", str(i))) for i in range(6)], "page_id long, url string, html string")
    assert {r["text"] for r in H.extract_pages(df).collect()} == {f"Story {i} begins\n\nand {i} ends" for i in range(6)}


def test_pages_keep_their_text_whatever_the_host(spark):
    marked = lambda n: f"<body><div class='page with-sidebar'><article><p>Art {n}</p></article><div class='sidebar'>Side</div></div></body>"
    around = lambda n: f"<body><div class='sidebar-layout'><article><p>In {n}</p></article><div class='comments'><article>C {n}</article></div></div></body>"
    div = lambda n: f"<body><div class='top'><p>Hi</p></div><div class='main'><h2>Abstract</h2><p>Story {n}</p></div></body>"
    data = [(1, "http://a/", marked(1)), (2, "http://a/", marked(2)), (3, "http://a/", div(3)), (4, "http://a/", div(4)), (5, "http://a/", around(5)),
            (6, "http://b/", div(6)), (7, "http://b/", div(6)), (8, "http://c/", div(8)), (9, "http://c/", div(9)),
            (10, "http://c/", "<body><div class='main'><h2>Abstract</h2></div></body>"), (11, "http://d/", "<div class='ad-free'><p>one</p><p>two</p></div>"),
            (12, "http://c/", div(12).replace("</p></div></body>", "</p><blockquote>alone</blockquote></div></body>"))]
    out = {r["page_id"]: r["text"].split("\n\n") for r in H.extract_pages(rows(spark, data, "page_id long, url string, html string")).collect()}
    assert out == {1: ["Art 1"], 2: ["Art 2"], 3: ["Abstract", "Story 3"], 4: ["Abstract", "Story 4"], 5: ["In 5"], 6: ["Hi", "Abstract", "Story 6"],
                   7: ["Hi", "Abstract", "Story 6"], 8: ["Abstract", "Story 8"], 9: ["Abstract", "Story 9"], 10: ["Abstract"], 11: ["one", "two"],
                   12: ["Abstract", "Story 12", "alone"]}


def test_offsets_survive_letters_that_grow_in_lower_case():
    page = "<article><p>" + "\u0130" * 40 + " one <span class=ad>gone</span> two three four.</p><p>five</p></article>"
    assert H.extract(page, {}) == "\u0130" * 40 + " one two three four.\n\nfive"


def test_compound_names_of_content_stay():
    for name in ("long-form", "form-of-verbs", "search-theory", "header-files", "related-rates"):
        assert H.extract(f"<article><p>a</p><div class='{name}'><p>b</p></div></article>", {}) == "a\n\nb", name
    for name in ("search-box", "contact-form", "cookie-notice", "ad-slot", "share", "related-posts", "comment_list", "site-footer"):
        assert H.extract(f"<article><p>a</p><div class='{name}'><p>b</p></div></article>", {}) == "a", name

"""HTML main text by union-free regular-expression inference.

Pages of one host come from one template. ``infer_wrappers`` aligns their token streams step by
step: a wrapper is a union-free expression of tags, text constants, text slots, optional groups
``(...)?`` and repeated groups ``(...)+``.

1. ``tokens`` reads a page into block tags and text blocks (inline markup, references and white
   space resolved; scripts, styles and comments left out).
2. ``fold`` turns adjacent copies of one unit (list items, paragraphs) into a repeated group.
3. ``align`` lines a folded stream up with the wrapper: text against other text becomes a slot, a
   group on one side only becomes optional, a unit against its repetition becomes repeated.
4. Wrappers of parts of a host are aligned with each other in the same way, in two rounds.

``label`` then marks each text place of the wrapper by whether its text is constant over the
host's distinct pages, and ``extract`` reads every page with its host's labels. A page that marks its
article itself gives what is inside; any other page gives its places outside boilerplate containers
without the constant ones, or with them where it would be left without text. Headings next to
varying text stay. Class words of elements around the article do not make it boilerplate.

Scale: step 3 runs map-side per Arrow batch and emits one wrapper per (batch, host); a host is
first merged in ``FAN`` parts, then the parts. A
wrapper's size is that of the template, not of the host's pages. Pages join wrappers by host with
the pages on the side that adaptive execution may split, so a hot host is spread.

Defined cases: null or empty html gives the empty text; a null URL is the host ''; unclosed
tags end with their parent or the next block; repeated rows each give their text; empty tables
and extra columns are fine.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby, takewhile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .url_filter import url_host

FAN = 64
#: HTML elements by kind.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "button", "math", "object", "audio", "video", "canvas", "head"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q",
          "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
#: Opening one of these ends an open p; opening a key ends an open element among its values.
ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
          "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Containers that never hold article text, by element and by a word of class, id or role.
SIDE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
SIDE_WORDS = {"ad", "ads", "advert", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies",
              "copyright", "disclaimer", "disqus", "footer", "form", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
              "newsletter", "notice", "pagination", "pager", "popup", "promo", "promoted", "related", "recommended", "replies", "reply", "search", "share",
              "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "contentinfo", "complementary", "alert"}
MAIN_TAGS = {"article", "main"}
#: A class or id with one of these words tells of a layout (with-sidebar, ad-free), not of a container.
LAYOUT_WORDS = {"with", "without", "has", "no", "non", "free"}
#: Words of SIDE_WORDS that also name content: in a compound (long-form, search-theory) they count only beside these.
AMBIGUOUS = {"alert", "banner", "copyright", "footer", "form", "header", "menu", "notice", "related", "reply", "search", "share", "social"}
BESIDE = {"area", "bar", "block", "body", "bottom", "box", "button", "buttons", "contact", "container", "content", "feedback", "global", "icon", "icons", "inner", "item",
          "items", "left", "link", "links", "list", "main", "outer", "page", "panel", "post", "posts", "primary", "right", "secondary", "section", "site", "text", "title", "top",
          "wrap", "wrapper"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

TOKEN = re.compile(r"([^<]+)|(</?[a-zA-Z][^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*>)|<!--.*?(?:-->|$)|<[!?][^>]*>?|(<)", re.S)
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)


@lru_cache(maxsize=20_000)
def read_tag(tag: str) -> tuple[bool, str, bool, tuple[str, ...]]:
    """(closing, name, closes itself, words) of a tag as written."""
    m = TAG.match(tag)
    attrs = tag[m.end():-1]
    closing = bool(m.group(1))
    return closing, m.group(2).lower(), attrs.rstrip().endswith("/"), () if closing or not attrs.strip() else words_of(attrs)


@lru_cache(maxsize=100)
def closing_tag(name: str) -> re.Pattern:
    return re.compile(f"</{name}", re.I | re.A)


def words_of(attrs: str) -> tuple[str, ...]:
    """Lower-case words of class, id and role; ``hidden`` for an element that is not shown."""
    found = []
    for name, a, b, c in ATTR.findall(attrs):
        value, name = (a or b or c).lower(), name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            found.append("hidden")
        elif name in ("class", "id", "role"):
            for one in value.split():
                parts = [w for w in re.split(r"[^a-z]+", one) if w]
                rest = [w for w in parts if w not in AMBIGUOUS]
                told = not SIDE_WORDS.isdisjoint(rest) or BESIDE.issuperset(rest)
                found += parts if len(parts) < 2 or told and LAYOUT_WORDS.isdisjoint(parts) else ["-".join(parts)]
    return tuple(found)


def tokens(page: str | None) -> list[tuple[str, str]]:
    """(path, text) of each text block in page order; path: enclosing block elements with their words."""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []
    buffer: list[str] = []

    def flush() -> None:
        if buffer:
            text = "".join(buffer)
            buffer.clear()
            if "&" in text:
                text = html_lib.unescape(text)
            if text := " ".join(text.split()):
                out.append(("/".join(s for _, s in stack), text))

    page = page or ""
    at, n = 0, len(page)
    while at < n:
        m = TOKEN.match(page, at)
        if m is None:  # a tag that never ends
            break
        at = m.end()
        if (text := m.group(1) or m.group(3)) is not None:
            buffer.append(text)
            continue
        if m.group(2) is None:
            continue
        closing, name, alone, words = read_tag(m.group(2))
        if name in RAW and not closing:
            if not alone:
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else (n if name in ("script", "style") else at)
            if name not in ("button", "svg", "math", "object", "canvas"):
                flush()
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name == "br":
                buffer.append(" ")
            continue
        if name in INLINE:
            if not closing and words and (side(words) or "hidden" in words) and (end := closing_tag(name).search(page, at)):
                at = end.start()
            continue
        flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        if name in ENDS_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    del stack[i:]
                    break
                if stack[i][0] in ("td", "li", "div", "section", "article", "blockquote"):
                    break
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in ENDS.get(name, ()):
                del stack[i:]
                break
            if stack[i][0] in ("ul", "ol", "dl", "table"):
                break
        if not alone:
            stack.append((name, ".".join((name, *words))))
    flush()
    return out


def side(words) -> bool:
    return any(w in SIDE_WORDS for w in words)


# A wrapper item is [kind, path, text, items]: kind "t" constant text, "s" slot, "?" optional, "+" repeated.
def fold(stream: list) -> list:
    """Replace adjacent copies of a unit of equal shape by one repeated group, short units first."""
    items: list = []
    for path, run in groupby(stream, key=lambda x: x[0]):
        texts = [t for _, t in run]
        one = ["t", path, texts[0], []] if len(set(texts)) == 1 else ["s", path, "", []]
        items.append(one if len(texts) == 1 else ["+", "", "", [one]])
    for size in (2, 3, 4):
        out: list = []
        i = 0
        while i < len(items):
            unit, j = items[i:i + size], i + size
            while j + size <= len(items) and all(same_shape(a, b) for a, b in zip(unit, items[j:j + size])):
                unit = [merge_item(a, b) for a, b in zip(unit, items[j:j + size])]
                j += size
            if j > i + size:
                out.append(["+", "", "", unit])
                i = j
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def shape(item: list) -> str:
    """What must agree for two items to be the same place: paths, not texts."""
    return item[1] if item[0] in "ts" else "(" + " ".join(shape(x) for x in item[3]) + ")"


def same_shape(a: list, b: list) -> bool:
    return shape(strip_group(a)) == shape(strip_group(b))


def strip_group(item: list) -> list:
    """A group of one item stands for that item."""
    while item[0] in "?+" and len(item[3]) == 1:
        item = item[3][0]
    return item


def merge_item(a: list, b: list) -> list:
    """The least general item that covers both (they have the same shape)."""
    marks = {x for x in "?+" for y in (a, b) if has_mark(y, x)}
    x, y = strip_group(a), strip_group(b)
    if x[0] in "ts":
        core = ["t" if x[0] == y[0] == "t" and x[2] == y[2] else "s", x[1], "", []]
        core[2] = x[2] if core[0] == "t" else ""
    else:
        core = [x[0], "", "", [merge_item(p, q) for p, q in zip(x[3], y[3])]]
    for mark in "+?":
        if mark in marks and core[0] != mark:
            core = [mark, "", "", [core]]
    return core


def has_mark(item: list, mark: str) -> bool:
    while item[0] in "?+":
        if item[0] == mark:
            return True
        if len(item[3]) != 1:
            return False
        item = item[3][0]
    return False


def align(a: list, b: list) -> list:
    """Align two item lists; what only one of them has becomes optional (longest common shape sequence)."""
    ka, kb = [shape(strip_group(x)) for x in a], [shape(strip_group(x)) for x in b]
    if ka == kb:
        return [merge_item(x, y) for x, y in zip(a, b)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if ka[i] == kb[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    optional = lambda x: x if x[0] == "?" else ["?", "", "", [x]]
    while i < n or j < m:
        if i < n and j < m and ka[i] == kb[j]:
            out.append(merge_item(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append(optional(a[i]))
            i += 1
        else:
            out.append(optional(b[j]))
            j += 1
    return compact(out)


def compact(items: list) -> list:
    """Adjacent optional items of one shape are one repeated place, which keeps a wrapper as short as its template."""
    out: list = []
    for x in items:
        if out and same_shape(out[-1], x):
            y = merge_item(out[-1], x)
            out[-1] = y if has_mark(y, "+") else ["+", "", "", [y]]
        else:
            out.append(x)
    return out


def places(items: list) -> dict[str, bool]:
    """path -> whether some text there differs between pages (a slot)."""
    found: dict[str, bool] = {}

    def walk(item):
        if item[0] in "ts":
            found[item[1]] = found.get(item[1], False) or item[0] == "s"
        for x in item[3]:
            walk(x)

    for x in items:
        walk(x)
    return found


def is_side(path: str, around: str = "") -> bool:
    """Whether an enclosing element is a boilerplate container; a header inside the article heads the article.

    Words of the elements that ``around`` names, those that the article lies in, do not count.
    """
    steps, spared = [s.split(".") for s in path.split("/") if s], [s.split(".") for s in around.split("/") if s]
    inside = next((i for i, s in enumerate(steps) if s[0] in MAIN_TAGS), len(steps))
    for i, s in enumerate(steps):
        if s[0] in SIDE_TAGS or "hidden" in s[1:] or s[0] == "header" and i < inside:
            return True
        if s[0] in ("html", "body", "article", "main") or steps[:i + 1] == spared[:i + 1]:
            continue
        if side(w for w in s[1:] if not (i > inside and w == "header")):
            return True
    return False


def in_main(path: str) -> bool:
    return any(s.split(".")[0] in MAIN_TAGS for s in path.split("/"))


def article_path(blocks: list[tuple[str, str]]) -> str:
    """Path of the page's first article (else main) element that no tag makes boilerplate, empty without one."""
    for tag in ("article", "main"):
        for path, _ in blocks:
            steps = path.split("/")
            ends = [i for i, s in enumerate(steps) if s.split(".")[0] == tag]
            if ends and not is_side(top := "/".join(steps[:ends[0] + 1]), top):
                return top
    return ""


def label(items: list, seen: dict[str, list[int]]) -> dict[str, bool]:
    """path -> False where distinct pages have one text, for pages that do not mark their article. seen: smallest and largest page hash of a path."""
    found = places(items)
    parent = lambda p: p.rpartition("/")[0]
    varying = {parent(p) for p, slot in found.items() if slot and not is_side(p)}
    heads = lambda p: p.split("/")[-1].split(".")[0] in HEADINGS and parent(p) in varying
    return {p: slot or p not in seen or seen[p][0] == seen[p][1] or heads(p) for p, slot in found.items()}


def extract(page: str | None, labels: dict[str, bool]) -> str:
    """Article blocks in page order, joined by an empty line."""
    blocks = tokens(page)
    if around := article_path(blocks):
        return "\n\n".join(t for p, t in blocks if in_main(p) and not is_side(p, around))
    own = [(p, t) for p, t in blocks if not is_side(p)]
    if not own:  # an element around several places, all the page has, is its layout
        shown = [p.split("/") for p, _ in blocks if not is_side(p, p)]
        if len({tuple(p) for p in shown}) > 1:
            common = [s[0] for s in takewhile(lambda s: len(set(s)) == 1, zip(*shown))]
            own = [(p, t) for p, t in blocks if not is_side(p, "/".join(common))]
    return "\n\n".join([t for p, t in own if labels.get(p, True)] or [t for _, t in own])


def widen(seen: dict[str, list[int]], more: dict[str, list[int]]) -> None:
    for p, (lo, hi) in more.items():
        had = seen.get(p, (lo, hi))
        seen[p] = [min(lo, had[0]), max(hi, had[1])]


def _partial_wrappers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        hosts: dict[str, tuple[list, dict[str, list[int]]]] = {}
        for host, page in zip(pdf["host"], pdf["html"]):
            blocks = tokens(page)
            items = fold(blocks)
            if not items:
                continue
            h = int.from_bytes(hashlib.blake2b("\0".join(x for b in blocks for x in b).encode("utf-8", "replace"), digest_size=6).digest(), "big")
            wrapper, seen = hosts.get(host, (None, {}))
            widen(seen, {p: [h, h] for p, _ in blocks})
            hosts[host] = (align(wrapper, items) if wrapper else items, seen)
        yield pd.DataFrame([(h, json.dumps(w, ensure_ascii=False), json.dumps(s)) for h, (w, s) in hosts.items()], columns=["host", "wrapper", "seen"])


def _merge_wrappers(pdf: pd.DataFrame) -> pd.DataFrame:
    merged, seen = None, {}
    for w in sorted(pdf["wrapper"]):
        merged = json.loads(w) if merged is None else align(merged, json.loads(w))
    for s in pdf["seen"]:
        widen(seen, json.loads(s))
    return pd.DataFrame([(pdf["host"].iloc[0], json.dumps(merged, ensure_ascii=False), json.dumps(seen))], columns=["host", "wrapper", "seen"])


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, seen): one union-free expression per host and the page hashes of its paths, as JSON. pages: (url, html)."""
    schema = "host string, wrapper string, seen string"
    part = pages.select(url_host(F.col("url")).alias("host"), "html").mapInPandas(_partial_wrappers, schema)
    salted = part.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(FAN)))
    half = salted.groupBy("host", "part").applyInPandas(lambda pdf: _merge_wrappers(pdf), schema)
    return half.groupBy("host").applyInPandas(lambda pdf: _merge_wrappers(pdf), schema)


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache: dict[str, dict[str, bool]] = {}
    for pdf in batches:
        texts = []
        for page, wrapper in zip(pdf["html"], pdf["labels"]):
            if wrapper not in cache:
                if len(cache) > 1000:
                    cache.clear()
                cache[wrapper] = json.loads(wrapper) if isinstance(wrapper, str) else {}
            texts.append(extract(page, cache[wrapper]))
        yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts})


def _label_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"host": pdf["host"], "labels": [json.dumps(label(json.loads(w), json.loads(s)), sort_keys=True) for w, s in zip(pdf["wrapper"], pdf["seen"])]})


def extract_pages(pages: DataFrame, wrappers: DataFrame | None = None) -> DataFrame:
    """(page_id, url, text) for every row of pages (page_id, url, html)."""
    p = pages.select("page_id", "url", "html")
    wrappers = infer_wrappers(p) if wrappers is None else wrappers
    labels = saved(wrappers.mapInPandas(_label_rows, "host string, labels string"), "labels")
    joined = p.withColumn("host", url_host(F.col("url"))).join(labels, "host", "left")
    return joined.select("page_id", "url", "html", "labels").mapInPandas(_extract, "page_id long, url string, text string")

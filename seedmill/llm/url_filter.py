"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

The listing holds two kinds of entries, both reduced to one string key that opens with the kind's letter:
* prefix rules (host, path, verdict): key ``r + host + path``, fits the host and its subdomains;
* canonical URLs: key ``u + canonical``, fits every spelling with that canonical form.

A page offers the keys it could be listed under (host suffixes of as many labels as some rule's host has,
x the listed path lengths, and its canonical URL), however long its host is. The Bloom filter drops nearly all of them map-side; what passes goes
to an exact join, which removes the false positives. The longest prefix rule wins, then the
canonical listing, then ``default``.

The filter is ``blocks`` rows of eight 64-bit words at most, whatever the listing's size, so
its broadcast is bounded (2**16 blocks: 4.7 MB). A listing too long for it lets more keys pass
and loses none. The exact join carries no hint: the planner broadcasts the listing when it is
small, and otherwise adaptive skew handling splits a key that many pages share.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no rule and has
no canonical form, so it gets the default verdict. Repeated rows each keep their verdict.
Empty pages or an empty listing work. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

WORDS = 8
TRACKING = "utm_[^=]*|ref|fbclid|gclid|sessionid"


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without www. and default port, path without index page and final slash, sorted query without tracking."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(url_path(url), r"/index\.html?$", "/"), r"/+$", "")
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^(?:{TRACKING})(?:=|$)"))
    tail = F.array_join(F.array_sort(kept), "&")
    return F.when(host != "", F.concat(host, path, F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(F.lit(""))))


def repeated_urls(pages: DataFrame, min_rows: int = 2) -> DataFrame:
    """Listing of canonical URLs that at least ``min_rows`` rows carry (one address crawled again and again)."""
    c = pages.select(canonical_url(F.col("url")).alias("canonical")).where("canonical is not null")
    return c.groupBy("canonical").agg(F.count("*").alias("n")).where(F.col("n") >= min_rows).select("canonical")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bit(key: Column, i: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(i)), F.lit(64)).cast("int")


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7): one bit in each word of the block for each key; at most ``blocks`` rows."""
    k = F.col("key")
    return keys.groupBy(_block(k, blocks).alias("block")).agg(
        *[F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(key, {i}), 64) as int))")).alias(f"w{i}") for i in range(WORDS)])


def possible_hits(keys: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``keys`` whose key the filter cannot rule out."""
    probe = keys.withColumn("block", _block(F.col("key"), blocks)).join(F.broadcast(bloom), "block")
    for i in range(WORDS):
        probe = probe.where(F.expr(f"(shiftright(w{i}, cast(pmod(xxhash64(key, {i}), 64) as int)) & 1L) = 1L"))
    return probe.drop("block", *[f"w{i}" for i in range(WORDS)])


def judge_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, default: str = "allow",
               listed_verdict: str = "block", blocks: int = 1 << 16) -> DataFrame:
    """Return page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    rules: (host, path, verdict); listed: (canonical). The distinct lengths of the rules' paths and the distinct label
    counts of their hosts are read to the driver: their numbers are bounded by the longest path and host, not by the rules.
    """
    rules = rules.select(ascii_lower(F.col("host")).alias("h"), F.col("path").alias("p"), F.col("verdict").alias("v"))
    lengths = sorted(r[0] for r in rules.select(F.length("p")).distinct().collect() if r[0] is not None)
    depths = sorted(r[0] for r in rules.select(F.size(F.split("h", r"\."))).distinct().collect() if r[0] is not None and r[0] > 0)
    listing = rules.select(F.concat(F.lit("r"), "h", "p").alias("key"), F.concat("h", "p").alias("found"), F.col("v"),
                           F.length(F.concat("h", "p")).alias("size")) \
        .unionByName(listed.select(F.concat(F.lit("u"), F.col("canonical")).alias("key"), F.lit(None).cast("string").alias("found"),
                                   F.lit(listed_verdict).alias("v"), F.lit(0).alias("size"))) \
        .groupBy("key").agg(F.max(F.struct("size", "found", "v")).alias("e"))
    urls = pages.select("url").where("url is not null").distinct() \
        .select("url", url_host(F.col("url")).alias("h"), url_path(F.col("url")).alias("p"), canonical_url(F.col("url")).alias("c"))
    labels = F.split("h", r"\.")
    suffixes = F.array_compact(F.array(*[F.when(F.size(labels) >= n, F.array_join(F.slice(labels, -n, n), ".")) for n in depths])) if depths \
        else F.array().cast("array<string>")
    heads = F.array_distinct(F.array(*[F.expr(f"substring(p, 1, {n})") for n in lengths])) if lengths else F.array().cast("array<string>")
    prefix_keys = F.flatten(F.transform(suffixes, lambda s: F.transform(heads, lambda q: F.concat(F.lit("r"), s, q))))
    keys = urls.select("url", F.explode_outer(F.concat(
        F.when(F.col("h") != "", prefix_keys).otherwise(F.array().cast("array<string>")),
        F.filter(F.array(F.concat(F.lit("u"), F.col("c"))), lambda x: x.isNotNull()))).alias("key")).where("key is not null")
    hits = possible_hits(keys, bloom_filter(listing.select("key"), blocks), blocks)
    found = hits.join(listing, "key").groupBy("url").agg(F.max("e").alias("e"))
    out = pages.select("page_id", "url").join(found, "url", "left")
    return out.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
                      F.col("e.found").alias("rule"), F.coalesce(F.col("e.v"), F.lit(default)).alias("verdict"))

r"""Chat formatting of typed content parts.

A message is (conv_id, turn, role, parts) with parts = array<struct<kind, text, uri, units>>.
The visitor walks the parts of each message in order: adjacent texts are joined, escaped and kept; an image, audio
or document part becomes an ordered placeholder ``[[image:1]]`` and an attachment row
(kind, ordinal within its kind, uri, expanded tokens). ``units`` is the size that expands to
tokens: image tiles, audio seconds, document pages, at ``TOKENS_PER_UNIT`` each.

A turn is written as ``### Role: `` + body + ``</turn>\n``. Texts are escaped reversibly, so no
control string can occur in a body: the escape sign first, then each control string becomes an
escape sign and a letter. Texts are escaped as they will stand, joined with their neighbours, and a ``[`` just before a
placeholder is escaped as well, so parts cannot form a control string together either. ``parse_formatted`` reads turns
back and undoes the escapes.

Everything is one shuffle by conversation and built-in functions. One conversation is one output
row, so its turns must meet; nothing else is gathered.

Defined cases: a null text or part list is empty; a null role is the empty role; turns sort by
(turn, role, body) with null turns first, so repeated rows and ties have one order; a null conv_id
is a conversation of its own; texts of any length are kept whole; an empty table gives no row. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, MID, END = "### ", ": ", "</turn>\n"
#: control string -> letter after the escape sign; the escape sign itself comes first
ESCAPES = [("\\", "b"), ("###", "h"), ("</turn>", "e"), ("[[", "o")]
BRACKET = "\\s"  # a single [ before a placeholder
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 800}


def escape(c: Column) -> Column:
    for plain, letter in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit("\\" + letter))
    return c


def unescape(c: Column) -> Column:
    c = F.replace(c, F.lit(BRACKET), F.lit("["))
    for plain, letter in reversed(ESCAPES):
        c = F.replace(c, F.lit("\\" + letter), F.lit(plain))
    return c


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit(":"), F.lit("\\c"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("\\c"), F.lit(":")))


def text_parts(text: Column) -> Column:
    """One text part, for tables that hold plain texts."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("uri"), F.lit(None).cast("long").alias("units")))


def visit_parts(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, body, attachments): parts flattened in order, per message."""
    empty = F.array().cast("array<struct<kind:string,text:string,uri:string,units:bigint>>")
    m = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("parts", empty).alias("parts"))
    kinds = list(TOKENS_PER_UNIT)

    def seen(kind, i):  # parts of that kind up to place i
        return F.size(F.filter(F.slice(F.col("parts"), F.lit(1), i + 1), lambda q: q["kind"] == kind))

    # places of the attachments; the texts between two of them are one text
    n = F.size("parts")
    media = F.filter(F.transform("parts", lambda p, i: F.when(p["kind"].isin(kinds), i + 1)), lambda i: i.isNotNull())
    stops = F.concat(F.array(F.lit(0)), media, F.array(n + 1))

    def run(k):  # the text after the k-th attachment
        first, last = F.element_at(stops, k + 1) + 1, F.element_at(stops, k + 2) - 1
        text = escape(F.array_join(F.transform(F.slice("parts", first, last - first + 1), lambda p: F.coalesce(p["text"], F.lit(""))), ""))
        return F.when((last < n) & text.endswith("["), F.concat(F.substring(text, 1, F.length(text) - 1), F.lit(BRACKET))).otherwise(text)

    def placeholder(at):
        p = F.element_at("parts", at)
        return F.concat(F.lit("[["), p["kind"], F.lit(":"), seen(p["kind"], at - 1).cast("string"), F.lit("]]"))

    text_only = F.size(media) == 0
    plain = escape(F.array_join(F.transform("parts", lambda p: F.coalesce(p["text"], F.lit(""))), ""))
    runs = F.transform(F.sequence(F.lit(0), F.size(media)), run)
    mixed = F.array_join(F.zip_with(runs, F.concat(F.transform(media, placeholder), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    cost = F.create_map(*[F.lit(x) for kv in TOKENS_PER_UNIT.items() for x in kv])
    refs = F.filter(F.transform("parts", lambda p, i: F.when(p["kind"].isin(kinds), F.struct(
        p["kind"].alias("kind"), seen(p["kind"], i).alias("ordinal"), p["uri"].alias("uri"),
        (F.coalesce(p["units"], F.lit(0)) * cost[p["kind"]]).alias("tokens")))), lambda r: r.isNotNull())
    return m.select("conv_id", "turn", "role", F.when(text_only, plain).otherwise(mixed).alias("body"), refs.alias("attachments"))


def format_chats(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans, attachments, attachment_tokens), one row per conversation.

    loss_spans: array<struct<start, length>> in code points of ``formatted``: assistant bodies.
    """
    v = visit_parts(messages)
    turn = F.struct(F.col("turn").alias("turn"), F.col("role").alias("role"), F.col("body").alias("body"),
                    F.col("attachments").alias("attachments"))
    g = v.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    head = lambda t: F.concat(F.lit(HEAD), escape_role(t["role"]), F.lit(MID))
    g = g.withColumn("heads", F.transform("turns", head)) \
        .withColumn("formatted", F.array_join(F.zip_with("heads", "turns", lambda h, t: F.concat(h, t["body"], F.lit(END))), ""))
    sizes = F.zip_with("heads", "turns", lambda h, t: F.struct(F.length(h).alias("h"), F.length(t["body"]).alias("b"),
                                                               (t["role"] == "assistant").alias("on")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    walk = F.aggregate(sizes, start, lambda acc, s: F.struct(
        (acc["at"] + s["h"] + s["b"] + F.lit(len(END))).alias("at"),
        F.when(s["on"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + s["h"]).alias("start"), s["b"].alias("length")))))
        .otherwise(acc["spans"]).alias("spans")), lambda acc: acc["spans"])
    refs = F.flatten(F.transform("turns", lambda t, i: F.transform(t["attachments"], lambda a: F.struct(
        i.alias("turn_no"), a["kind"].alias("kind"), a["ordinal"].alias("ordinal"), a["uri"].alias("uri"), a["tokens"].alias("tokens")))))
    out = g.select("conv_id", "formatted", walk.alias("loss_spans"), refs.alias("attachments"))
    return out.withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, r: a + r["tokens"]))


def parse_formatted(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation (placeholders stay as written)."""
    pieces = F.filter(F.split(formatted, END), lambda s: s != "")
    return F.transform(pieces, lambda s: F.struct(
        unescape_role(F.substring_index(F.substring(s, len(HEAD) + 1, 1 << 30), MID, 1)).alias("role"),
        unescape(F.substring(s, F.length(F.substring_index(s, MID, 1)) + len(MID) + 1, F.lit(1 << 30))).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, nothing between the spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")

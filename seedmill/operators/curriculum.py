"""Curriculum tables (R1, R6, W2) and labelled-dialogue parsing.

Chapters arrive as a JSON map ``{"1": name, ...}`` per topic; sections as ids
``chapter.section``. Windows are per topic (a topic holds a bounded outline).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GENERIC_NAMES = ["Introduction", "Conclusion", "Overview", "Summary"]
SPEAKERS = ["User", "Assistant", "System"]


def explode_chapters(df: DataFrame, topic: str = "topic", text: str = "chapters_json") -> DataFrame:
    """R1 input: the chapter map as rows ``topic, chapter_id (text), chapter (int), name``."""
    m = F.from_json(F.col(text), "map<string,string>")
    e = df.select(topic, F.explode(m).alias("chapter_id", "name"))
    return e.withColumn("chapter", F.col("chapter_id").try_cast("int"))


def check_chapters(ch: DataFrame, topic: str = "topic", lo: int = 3, hi: int = 12,
                   generic=GENERIC_NAMES) -> DataFrame:
    """Ids are 1..n, lo <= n <= hi, names distinct, generic names refused."""
    g = ch.groupBy(topic).agg(
        F.count(F.lit(1)).alias("n_chapters"),
        F.sort_array(F.collect_list("chapter")).alias("_ids"),
        F.countDistinct(F.lower("name")).alias("_names"),
        F.max(F.col("name").isin(*generic).cast("int")).alias("_generic"))
    n = F.col("n_chapters")
    checks = [("bad_ids", F.col("_ids") != F.sequence(F.lit(1), n)),
              ("count_out_of_range", (n < lo) | (n > hi)),
              ("duplicate_name", F.col("_names") < n),
              ("generic_name", F.col("_generic") == 1)]
    viol = F.filter(F.array(*[F.when(c, F.lit(code)) for code, c in checks]), lambda x: x.isNotNull())
    return g.select(topic, "n_chapters", F.array_join(viol, ",").alias("violations"))


def running_context(ch: DataFrame, topic: str = "topic") -> DataFrame:
    """The names of all chapters before the current one, and the one just before."""
    w = Window.partitionBy(topic).orderBy("chapter")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return (ch.withColumn("earlier", F.array_join(F.collect_list("name").over(before), ", "))
            .withColumn("previous", F.lag("name").over(w)))


def _labels(speakers) -> str:
    return "|".join(speakers)


def render_dialogue(turns: DataFrame, key: str = "conv_id", speakers=SPEAKERS) -> DataFrame:
    """Turns -> one labelled text per conversation (``User: ...`` lines, in turn order).

    A line of a text that opens like a label gets a back-slash in front, which ``parse_dialogue`` takes off.
    """
    quoted = F.regexp_replace("text", rf"(?m)^(\\*)((?:{_labels(speakers)}): )", r"\\$1$2")
    line = F.struct("turn", F.concat(F.initcap("role"), F.lit(": "), quoted).alias("l"))
    return (turns.groupBy(key).agg(F.array_sort(F.collect_list(line)).alias("_ls"))
            .select(key, F.array_join(F.transform("_ls", lambda x: x["l"]), "\n").alias("dialogue")))


def parse_dialogue(df: DataFrame, key: str = "conv_id", text: str = "dialogue", speakers=SPEAKERS) -> DataFrame:
    """Labelled dialogue text -> ``(turn, role, text)``; a split on speaker labels. A piece without a label has role ''."""
    alt = _labels(speakers)
    pieces = F.split(F.col(text), rf"\n(?=(?:{alt}): )")
    e = df.select(key, F.posexplode(pieces).alias("turn", "_p"))
    said = F.regexp_replace("_p", rf"^(?:{alt}): ", "")
    return e.select(key, F.col("turn").cast("long").alias("turn"),
                    F.lower(F.regexp_extract("_p", rf"^({alt}): ", 1)).alias("role"),
                    F.regexp_replace(said, rf"(?m)^\\(\\*(?:{alt}): )", "$1").alias("text"))


def check_turns(turns: DataFrame, speakers: list, key: str = "conv_id") -> DataFrame:
    """(key, n_turns, violations) of parsed turns: no_label, unknown_speaker (not of ``speakers``), empty_turn, not_alternating.

    Neighbours are compared by a window over one dialogue's roles alone; the texts stay out of it.
    """
    w = Window.partitionBy(key).orderBy("turn")
    t = turns.select(key, "turn", "role", (F.trim("text") == "").alias("_empty"))
    t = t.withColumn("_same", F.coalesce(F.col("role") == F.lag("role").over(w), F.lit(False)))
    any_ = lambda c: F.max(c.cast("int")) == 1
    g = t.groupBy(key).agg(F.count(F.lit(1)).alias("n_turns"), any_(F.col("role") == "").alias("a"),
                           any_((F.col("role") != "") & ~F.col("role").isin(*speakers)).alias("b"), any_(F.col("_empty")).alias("c"), any_(F.col("_same")).alias("d"))
    codes = [("no_label", "a"), ("unknown_speaker", "b"), ("empty_turn", "c"), ("not_alternating", "d")]
    found = F.array_compact(F.array(*[F.when(F.col(c), F.lit(code)) for code, c in codes]))
    return g.select(key, "n_turns", F.array_join(found, ",").alias("violations"))


def notation_conflicts(df: DataFrame, symbol: str = "symbol", meaning: str = "meaning") -> DataFrame:
    """Symbols used with more than one meaning (a partial aggregate per symbol)."""
    return (df.groupBy(symbol).agg(F.countDistinct(meaning).alias("meanings"))
            .filter(F.col("meanings") > 1))

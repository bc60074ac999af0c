"""Strict JSON parsing with Spark's own JSON reader (P5).

``from_json`` alone is lenient: a truncated object yields a partly filled
struct, and valid JSON followed by prose is accepted. Wrapping the text as the
single element of an array and asking for a corrupt-record column makes the
reader strict: the text is good iff no corrupt record is reported and the array
holds exactly one element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seedmill.functions.text import py_strip

_OPTS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_cr",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "allowUnquotedFieldNames": "false",
}


def parse_strict(c, ddl: str) -> Column:
    """Parse ``c`` as one JSON value of type ``ddl``.

    Returns ``struct<ok boolean, value <ddl>, error string>``; error is one of
    ``null_input``, ``empty``, ``invalid_json`` or NULL when ok.
    """
    col = F.col(c) if isinstance(c, str) else c
    wrapped = F.concat(F.lit('{"w":['), col, F.lit("]}"))
    parsed = F.from_json(wrapped, f"w array<{ddl}>, _cr string", _OPTS)
    ok = (col.isNotNull() & parsed["_cr"].isNull()
          & (F.coalesce(F.size(parsed["w"]), F.lit(0)) == 1))
    ok = F.coalesce(ok, F.lit(False))
    err = (F.when(col.isNull(), F.lit("null_input"))
           .when(py_strip(col) == "", F.lit("empty"))
           .when(~ok, F.lit("invalid_json")))
    return F.struct(ok.alias("ok"), F.when(ok, parsed["w"][0]).alias("value"), err.alias("error"))


def with_parsed(df, text, ddl: str, out: str = "parsed"):
    """DataFrame form of :func:`parse_strict` that evaluates each costly step once.

    The text expression, the JSON read and the checks land in separate
    projections; Catalyst keeps them apart because the costly columns are
    referenced more than once, so neither the text preparation (fence strip)
    nor ``from_json`` runs twice per row.
    """
    from pyspark.sql import DataFrame  # noqa: F401

    col = F.col(text) if isinstance(text, str) else text
    df = df.withColumn("_pj_text", col)
    wrapped = F.concat(F.lit('{"w":['), F.col("_pj_text"), F.lit("]}"))
    df = df.withColumn("_pj_raw", F.from_json(wrapped, f"w array<{ddl}>, _cr string", _OPTS))
    t, raw = F.col("_pj_text"), F.col("_pj_raw")
    ok = F.coalesce(t.isNotNull() & raw["_cr"].isNull()
                    & (F.coalesce(F.size(raw["w"]), F.lit(0)) == 1), F.lit(False))
    err = (F.when(t.isNull(), F.lit("null_input"))
           .when(py_strip(t) == "", F.lit("empty"))
           .when(~ok, F.lit("invalid_json")))
    return (df.withColumn(out, F.struct(ok.alias("ok"), F.when(ok, raw["w"][0]).alias("value"),
                                        err.alias("error")))
            .drop("_pj_raw", "_pj_text"))

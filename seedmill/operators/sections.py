"""Labelled-section answers (V18, V19): every label present once, in order.

Labels count only at the start of a line. Positions come from ``instr`` on
the text with a leading newline, counts from length arithmetic: plain JVM
string functions, no regex scan per label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def found_codes(checks: list) -> Column:
    """The codes whose condition holds, in order. Joined arrays, no lambda: what the conditions share is worked out once a row."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(cond, F.array(F.lit(code))).otherwise(none) for code, cond in checks])


def check_sections(df: DataFrame, text: str, labels: list, first: str | None = None, heading: str | None = None) -> DataFrame:
    """Adds ``violations``: missing:<label>, duplicate:<label>, out_of_order, and (when ``first`` is given)
    first_not:<first> where another section than the ``heading`` comes before it."""
    t = F.concat(F.lit("\n"), F.col(text))
    codes = []
    pos = []
    for lab in labels:
        needle = "\n" + lab + ":"
        cnt = ((F.length(t) - F.length(F.replace(t, F.lit(needle), F.lit("")))) / len(needle)).cast("int")
        codes.append((f"missing:{lab}", cnt == 0))
        codes.append((f"duplicate:{lab}", cnt > 1))
        pos.append(F.instr(t, needle))
    present = [F.when(p > 0, p) for p in pos]
    ordered = F.lit(True)
    for a, b in zip(present, present[1:]):
        ordered = ordered & F.coalesce(a < b, F.lit(True))
    codes.append(("out_of_order", ~ordered))
    if first:
        others = [p for lab, p in zip(labels, pos) if lab not in (first, heading)]
        fpos = pos[labels.index(first)]
        before = F.lit(False)
        for p in others:
            before = before | ((p > 0) & ((fpos == 0) | (p < fpos)))
        codes.append((f"first_not:{first}", before))
    return df.withColumn("violations", found_codes(codes))

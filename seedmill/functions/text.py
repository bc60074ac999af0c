"""Scalar text expressions (all JVM-side, no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seedmill.functions.vocab import LOW_QUALITY_PREFIX, REJECT_MARKER


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's str.isspace() accepts (built from that rule).
PY_WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def py_strip(c) -> Column:
    """Python ``str.strip()``: both ends, every whitespace character.

    SQL ``trim`` strips only spaces; ``btrim`` with the whitespace set is a
    plain scan of the two ends (a regex would scan the whole text).
    """
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def dedup_text(name="concept_name", definition="concept_definition") -> Column:
    """Stripped ``name + ' ' + definition``; the concept type is left out on purpose."""
    joined = F.concat(
        py_strip(F.coalesce(_c(name), F.lit(""))), F.lit(" "),
        py_strip(F.coalesce(_c(definition), F.lit(""))),
    )
    return py_strip(joined)


def strip_code_fence(c) -> Column:
    """If the stripped text opens with a back-tick fence, keep only the fenced body.

    Only the fence and its language tag go; a missing closing fence is allowed.
    """
    s = py_strip(c)
    body = F.regexp_extract(s, r"(?s)^```[A-Za-z0-9_-]*\s*(.*?)\s*(```.*)?$", 1)
    return F.when(s.startswith("```"), body).otherwise(s)


def json_only_shape(c) -> Column:
    """The whole answer is one JSON object: starts with '{' and ends with '}'."""
    return _c(c).rlike(r"(?s)^\{.*\}$")


def is_reject(c) -> Column:
    """The answer is exactly the reject marker (surrounding whitespace ignored)."""
    return F.coalesce(py_strip(c) == F.lit(REJECT_MARKER), F.lit(False))


def has_quality_flag(c) -> Column:
    """The answer opens with the low-quality prefix."""
    return F.coalesce(py_strip(c).startswith(LOW_QUALITY_PREFIX), F.lit(False))


def drop_quality_flag(c) -> Column:
    """The answer with the low-quality prefix removed."""
    s = py_strip(c)
    return F.when(s.startswith(LOW_QUALITY_PREFIX),
                  py_strip(F.substring(s, len(LOW_QUALITY_PREFIX) + 1, 1 << 30))).otherwise(s)


def or_default(c, default: str) -> Column:
    """Value, else the literal default; an empty string counts as missing."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(default))


def tag_or_default(tags, idx: int, default: str) -> Column:
    """P10: ``tags[idx]`` (0-based) when present and non-empty, else ``default``."""
    return or_default(F.try_element_at(_c(tags), F.lit(idx + 1)), default)


def word_count(c) -> Column:
    """Whitespace-separated words of the stripped text (0 for empty or NULL)."""
    s = py_strip(F.coalesce(_c(c), F.lit("")))
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, r"\s+")))


def lower_domain(c) -> Column:
    return F.lower(_c(c))

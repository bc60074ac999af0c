"""Portable stable hash.

``stable_hash(a, b, ...)`` is the first 15 hex digits of
``md5(concat_ws('|', a, b, ...))`` read as a non-negative bigint. The same value
is computable in any SQL engine with md5 (DuckDB:
``('0x' || substr(md5(...), 1, 15))::bigint``), so every sample, route, band and
rotation choice can be checked by an independent oracle. NULL parts hash as ''.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_HASH = 16**15  # exclusive upper bound of stable_hash


def _part(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(""))


def stable_hash(*parts) -> Column:
    """Stable 60-bit hash of the string forms of ``parts`` (columns or names)."""
    joined = F.concat_ws("|", *[_part(p) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def stable_hash_sql(*parts: str) -> str:
    """Spark SQL text of :func:`stable_hash` over SQL expressions."""
    inner = ", ".join(f"coalesce(cast({p} as string), '')" for p in parts)
    return f"cast(conv(substr(md5(concat_ws('|', {inner})), 1, 15), 16, 10) as bigint)"


def bucket(n: int, *parts) -> Column:
    """Stable bucket in ``[0, n)``."""
    return F.pmod(stable_hash(*parts), F.lit(n))

"""AS paths as arrays of ASNs; the origin is the last element."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_collapse(path: str) -> str:
    """SQL: a path without repeats of the hop before (prepends)."""
    return f"filter({path}, (x, i) -> i = 0 OR x <> {path}[i - 1])"


def collapse(path: str) -> Column:
    return F.expr(sql_collapse(path))


def edges(path: str) -> Column:
    """Neighbouring hops of a collapsed path as array<struct<a, b>>, each pair in ascending order."""
    d = sql_collapse(path)
    return F.expr(
        f"CASE WHEN size({d}) < 2 THEN array() ELSE zip_with(slice({d}, 1, size({d}) - 1), slice({d}, 2, size({d}) - 1), "
        "(a, b) -> named_struct('a', least(a, b), 'b', greatest(a, b))) END"
    )


def upstream_of(path: str, origin: str) -> Column:
    """The hop before the origin: before the last hop if that is the origin, else before the origin's last place; null if none."""
    d = sql_collapse(path)
    at = f"(size({d}) - array_position(reverse({d}), {origin}))"  # hops before the origin's last place
    return F.expr(
        f"CASE WHEN try_element_at({d}, -1) = {origin} THEN try_element_at({d}, -2) "
        f"WHEN array_contains({d}, {origin}) AND {at} >= 1 THEN element_at({d}, CAST({at} AS INT)) END"
    )


def canonical_pair(a: str, b: str) -> tuple[Column, Column]:
    return F.least(a, b), F.greatest(a, b)


def pair_key(lo: str, hi: str) -> Column:
    return F.concat_ws("-", F.col(lo).cast("string"), F.col(hi).cast("string"))

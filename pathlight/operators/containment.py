"""Which prefixes hold which: a sweep over prefixes in order of their first address.

Known prefixes and asked ones are dealt out by ranges of (family, address) and sorted by (address, length); in that order a
prefix comes before all that it holds. A task walks its range with a stack of the known prefixes that are still open, so a
short prefix such as /0 is one entry of a stack and no key that all rows meet at. What is open where a range begins is
found beforehand: the prefixes of at most 33 or 129 lengths that hold the range's first address.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ip import WORDS
from ..functions.shared import materialize
from .rib import ancestors

#: Rows of a range, on average.
RANGE = 50_000
PLACE = ("family", *WORDS)
ROW = "known boolean, family int, plen int, w0 bigint, w1 bigint, w2 bigint, w3 bigint, text string, origin bigint, allowed array<struct<max_length:int,origin:bigint>>"


def walk(judge: Callable, names: list[str]):
    """A range's rows to a row for each asked prefix: its text and origin, and what ``judge`` makes of the stack and the row."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by([(c, "ascending") for c in (*PLACE, "plen")] + [("known", "descending")])
        cells = [rows.column(c).to_pylist() for c in ("known", *PLACE, "plen", "text", "origin", "allowed")]
        stack: list[tuple] = []  # (last address, family, length, text, allowed)
        out: list[tuple] = []
        for known, family, a, b, c, d, plen, text, origin, allowed in zip(*cells):
            at, bits = (a, 32) if family == 4 else (a << 96 | b << 64 | c << 32 | d, 128)
            while stack and (stack[-1][1] != family or stack[-1][0] < at):
                stack.pop()
            if known:
                stack.append((at + (1 << (bits - plen)) - 1, family, plen, text, allowed))
            else:
                out.append((text, origin, judge(stack, plen, origin)))
        return pa.table([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=names)

    return run


def shaped(rows: DataFrame, known: bool) -> DataFrame:
    have = set(rows.columns)
    kinds = dict(f.split(" ", 1) for f in ROW.split(", "))
    return rows.select(F.lit(known).alias("known"), *((F.col(c) if c in have else F.lit(None)).cast(k).alias(c) for c, k in list(kinds.items())[1:]))


def swept(known: DataFrame, asked: DataFrame, judge: Callable, names: list[str], rows_a_range: int = RANGE) -> DataFrame:
    """``known``: family, plen, w0 to w3, text, allowed, a row a prefix. ``asked``: the same places, text and origin. Both written."""
    known = shaped(known, True)
    rows = known.unionByName(shaped(asked, False))
    ranges = -(-rows.count() // rows_a_range) or 1
    dealt = materialize(rows.repartitionByRange(ranges, *PLACE).withColumn("part", F.spark_partition_id()), "ranges")
    first = dealt.groupBy("part").agg(F.min(F.struct(*PLACE)).alias("first")).select("part", "first.*")  # a row a range
    first = materialize(first.withColumn("plen", F.when(F.col("family") == 4, 32).otherwise(128)), "first-of-ranges")
    up = ancestors(first.select("*", *(F.col(w).alias(f"_{w}") for w in WORDS)), known.select("family", "plen")).drop("plen").withColumnRenamed("up", "plen")
    before = F.lit(False)
    for w in WORDS:  # one that begins at the range's first address is in it already
        before = before | (F.col(w) != F.col(f"_{w}"))
    carried = up.where(before).drop(*(f"_{w}" for w in WORDS)).join(known, ["family", "plen", *WORDS])
    return dealt.unionByName(carried.select(dealt.columns)).groupBy("part").applyInArrow(walk(judge, names), f"{names[0]} string, {names[1]} bigint, {names[2]} string")


def longest(stack: list[tuple], plen: int, origin: int | None) -> str | None:
    return stack[-1][3] if stack else None


def origin_state(stack: list[tuple], plen: int, origin: int | None) -> str:
    """valid if an open prefix allows the origin and the length, else invalid if one is open, else unknown."""
    if not stack:
        return "unknown"
    return "valid" if any(a["origin"] == origin and plen <= a["max_length"] for *_, allowed in stack for a in allowed) else "invalid"

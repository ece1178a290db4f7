"""Dictionaries that outlive a run: values get numbers once, and keep them.

A dictionary is a table (value, id) of a store. New values are those that an anti-join leaves; they are numbered on from the
last number in the order of their first appearance, by ranges, and appended. Numbers begin at 0 and have no gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.shared import materialize, numbered
from .commits import Transaction


def intern(step: Transaction, name: str, rows: DataFrame, value: str, order: str) -> DataFrame:
    """Number the values of a column; null has none. Returns value and id of each distinct value of ``rows``.

    What is new is appended to the table ``name`` of the transaction and is there for all after its commit.
    """
    first = materialize(rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(order).alias("_seen")), "first")
    known = step.read(name)
    new = first.join(known.select(F.col("value").alias(value)), value, "left_anti")
    last = known.agg(F.max("id")).first()[0]
    new = materialize(numbered(new, "_n", "_seen", value).select(F.col(value).alias("value"), (F.col("_n") + (0 if last is None else last + 1)).alias("id")), "new-values")
    if not new.isEmpty():
        step.append(name, new)
    return first.select(F.col(value).alias("value")).join(known.unionByName(new), "value")


def ids_of(dictionary: DataFrame, rows: DataFrame, value: str, id: str = "id") -> DataFrame:
    """``rows`` with the number of a column's value; null where it has none."""
    return rows.join(dictionary.select(F.col("value").alias(value), F.col("id").alias(id)), value, "left")


def values_of(dictionary: DataFrame, rows: DataFrame, id: str = "id", value: str = "value") -> DataFrame:
    """``rows`` with the value of a number; null where it isn't in use."""
    return rows.join(dictionary.select(F.col("id").alias(id), F.col("value").alias(value)), id, "left")

"""Archives' manifests: which dumps and update files there are, as a table ts_start, ts_end, collector, data_type, url."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "ts_start timestamp, ts_end timestamp, collector string, data_type string, url string"


class NoFiles(LookupError):
    """No file of the kind in the window."""


def find(manifest: DataFrame, start: str, end: str, collector: str | None = None, data_type: str | None = None) -> DataFrame:
    """Files that begin in the window (UTC instants, both ends included), by their start."""
    rows = manifest.where(F.col("ts_start").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    if collector is not None:
        rows = rows.where(F.col("collector") == collector)
    if data_type is not None:
        rows = rows.where(F.col("data_type") == data_type)
    return rows.orderBy("ts_start", "url")


def baseline(manifest: DataFrame, start: str, end: str, collector: str | None = None):
    """The row of the latest routing table of the window."""
    row = find(manifest, start, end, collector, "rib").agg(F.max(F.struct("ts_start", "url", "collector")).alias("r")).first().r
    if row is None:
        raise NoFiles(f"no routing table from {start} to {end}")
    return row


def updates(manifest: DataFrame, start: str, end: str, collector: str | None = None) -> DataFrame:
    """Update files of the window, in order; none is an error."""
    rows = find(manifest, start, end, collector, "updates")
    if rows.isEmpty():
        raise NoFiles(f"no updates from {start} to {end}")
    return rows


def plan(manifest: DataFrame, start: str, end: str, collector: str | None = None) -> DataFrame:
    """The files to rebuild a table from, with ``ord``: the latest routing table, then all updates of the window, older ones too; no updates are fine."""
    base = baseline(manifest, start, end, collector)
    table = manifest.where((F.col("url") == base.url) & (F.col("data_type") == "rib")).limit(1)
    rest = find(manifest, start, end, collector, "updates")
    return table.withColumn("kind", F.lit(0)).unionByName(rest.withColumn("kind", F.lit(1))).orderBy("kind", "ts_start", "url")

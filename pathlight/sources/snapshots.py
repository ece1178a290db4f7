"""Snapshots by day: a folder partitioned by ``day``."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import store
from ..schemas import SNAPSHOT


def write(snapshot: DataFrame, path: str) -> None:
    """Replace the days of ``snapshot`` (with day), and no others."""
    columns = [f.split()[0] for f in SNAPSHOT.split(", ")]
    have = snapshot.columns
    types = dict(f.split(" ", 1) for f in SNAPSHOT.split(", "))
    rows = snapshot.select(*(F.col(c) if c in have else F.lit(None).cast(types[c]).alias(c) for c in columns))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    rows = spark.read.schema(SNAPSHOT).parquet(path)
    return rows if day is None else rows.where(F.col("day") == F.lit(day).cast("date"))


def folders(spark: SparkSession, path: str) -> dict[datetime.date, object]:
    """The days that are stored, from the folders' names."""
    return {datetime.date.fromisoformat(n[4:]): p for n, p in store.folders(spark, path).items() if n.startswith("day=") and not n.endswith("__")}


def prior(spark: SparkSession, path: str, day: datetime.date) -> datetime.date | None:
    """The latest stored day before ``day``."""
    return max((d for d in folders(spark, path) if d < day), default=None)


def prune(spark: SparkSession, path: str, day: datetime.date, retain_days: int) -> list[datetime.date]:
    """Delete the days before ``day`` - ``retain_days``; that day itself stays. Returns them."""
    old = sorted(d for d in folders(spark, path) if d < day - datetime.timedelta(days=retain_days))
    for d in old:
        where = folders(spark, path)[d]
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return old


def import_json(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot kept as one JSON object: as_of, ts_start, collector, source, and prefixes: a map of prefix to its observation."""
    kind = "as_of string, ts_start string, collector string, source string, prefixes map<string,struct<origin_asn:bigint,upstream_asn:bigint,as_path:array<bigint>>>"
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", kind, {"mode": "FAILFAST"}).alias("s")).select("s.*")
    rows = whole.select("as_of", "ts_start", "collector", "source", F.explode("prefixes").alias("prefix", "o"))
    as_of = F.to_timestamp("as_of")
    return rows.select("prefix", "o.origin_asn", "o.upstream_asn", "o.as_path", as_of.alias("as_of"), F.to_timestamp("ts_start").alias("ts_start"), "collector", "source", F.to_date(as_of).alias("day"))

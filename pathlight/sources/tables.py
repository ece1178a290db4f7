"""Text, CSV and JSON tables."""

from __future__ import annotations

import csv
import datetime
import ipaddress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import GLUE
from ..functions.ip import with_network
from ..operators import store
from ..schemas import CASE, EVENT, FEATURE, ORG, RELATION, ROA, SIGNAL

#: Headers of ROA files.
ASN_COLUMNS = ("asn", "as", "origin", "origin asn", "origin_asn")
PREFIX_COLUMNS = ("ip prefix", "prefix", "ip_prefix", "ipprefix")
LENGTH_COLUMNS = ("max length", "maxlen", "max_length", "maxlength", "max len")


def strict(x, pattern: str, kind: str, what: str):
    """A cast that fails the job on text that doesn't match."""
    return F.when(x.rlike(pattern), x.cast(kind)).otherwise(F.raise_error(F.concat(F.lit(f"{what}: "), F.coalesce(x, F.lit("null")))).cast(kind))


def read_glue(spark: SparkSession, path: str | None = None) -> DataFrame:
    """asn: one a line, blank and ``#`` lines aside; any other line is an error. Without a path, the list that comes with the package."""
    if path is None:
        return spark.createDataFrame([(a,) for a in GLUE], "asn bigint")
    lines = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> '' AND NOT startswith(v, '#')")
    return lines.select(strict(F.col("v"), r"^\d{1,10}$", "bigint", "not an ASN").alias("asn")).distinct()


def roa_columns(header: list[str]) -> tuple[int, int, int, bool]:
    """Where ASN, prefix and length stand, and whether the first line is data already."""
    names = [h.strip().lower() for h in header]

    def find(wanted):
        return next((i for i, h in enumerate(names) if h in wanted or h.replace("_", " ") in wanted), None)

    at = [find(c) for c in (ASN_COLUMNS, PREFIX_COLUMNS, LENGTH_COLUMNS)]
    if None not in at:
        return (*at, False)
    if len(names) >= 3 and names[0].isdigit() and names[0].isascii():
        try:
            ipaddress.ip_network(names[1], strict=False)
            return 0, 1, 2, True
        except ValueError:
            pass
    raise ValueError(f"no ASN, prefix and length columns in {header}")


def read_roas(spark: SparkSession, path: str) -> DataFrame:
    """ROAs of a CSV file with or without header. Short rows and rows without ASN are left out.

    A bad value fails the load: text that is no prefix of v4 or v6, or a length or ASN that is no number of its kind.
    """
    lines = spark.read.text(path)
    first = lines.first()
    if first is None:
        return spark.createDataFrame([], ROA)
    header = next(csv.reader([first[0]], skipinitialspace=True))
    asn, prefix, length, data = roa_columns(header)
    kinds = ", ".join(f"c{i} string" for i in range(max(len(header), asn + 1, prefix + 1, length + 1)))
    cells = lines.select(F.from_csv("value", kinds, {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}).alias("r"))
    cells = cells.select(F.array(*(F.trim(F.col(f"r.c{i}")) for i in range(len(kinds.split(", "))))).alias("c")).where(" AND ".join(f"c[{i}] IS NOT NULL" for i in (asn, prefix, length)))
    if not data:  # each file may have the header
        cells = cells.where(F.lower(F.col("c")[asn]) != header[asn].strip().lower())
    cells = cells.where((F.col("c")[asn] != "") & ~F.col("c")[asn].startswith("#"))
    number = F.regexp_replace(F.col("c")[asn], "^(?:AS)*(?:as)*", "")
    rows = with_network(cells.select(F.col("c")[prefix].alias("prefix"), F.col("c")[length].alias("length"), number.alias("number")))
    whole = F.col("prefix").rlike(r"^[^\s/]+/\d{1,3}$") & F.col("family").isNotNull() & ~F.col("prefix").rlike(LEADING_ZEROS)
    return rows.select(
        checked(F.col("prefix"), whole, "prefix").alias("prefix"), checked(F.col("length"), F.col("length").try_cast("int").between(0, 255), "length").cast("int").alias("max_length"),
        checked(F.col("number"), F.col("number").try_cast("bigint").between(0, 2**32 - 1), "ASN").cast("bigint").alias("origin_asn"),
    )


#: A v4 octet or a length with zeros before it is refused, as by a strict parser.
LEADING_ZEROS = r"^(?:\d+\.)*0\d+(?:\.|/)|/0\d"


def checked(x, ok, what: str):
    """``x``, or a failure of the job where ``ok`` doesn't hold."""
    return F.when(F.coalesce(ok & x.rlike(r"^\S+$"), F.lit(False)), x).otherwise(F.raise_error(F.concat(F.lit(f"not a{'n' if what == 'ASN' else ''} {what}: "), F.coalesce(x, F.lit("null")))).cast("string"))


def read_relations(spark: SparkSession, path: str) -> DataFrame:
    """a, b, rel of a pipe-separated file; ``#`` lines are comments."""
    return spark.read.schema(RELATION).csv(path, sep="|", comment="#", mode="FAILFAST")


ORG_FIELDS = "org_id string, name string, asns array<bigint>, domains array<string>, prefix_count_hint bigint, external_id string"


def read_orgs(spark: SparkSession, path: str) -> DataFrame:
    """Organisations of JSON lines (as ``write_orgs`` leaves them), or of one JSON text: an array, or an object with an array ``orgs``.

    Missing fields are null or empty; ``reg_order`` is the line's own, or the place in the file.
    """
    first = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> ''").first()
    lines = first is not None and spark.range(1).select(F.array_contains(F.json_object_keys(F.lit(first.v)), "org_id").alias("x")).first().x
    if lines:
        rows = spark.read.schema(f"{ORG_FIELDS}, reg_order bigint").json(path, mode="FAILFAST")
    else:
        one = f"struct<{ORG_FIELDS}>"
        text = spark.read.text(path, wholetext=True).select(F.ltrim("value").alias("v"))
        wrapped = F.from_json("v", f"struct<orgs:array<{one}>>", {"mode": "FAILFAST"})["orgs"]
        found = F.when(F.col("v").startswith("["), F.from_json("v", f"array<{one}>", {"mode": "FAILFAST"})).otherwise(wrapped)
        rows = text.select(F.posexplode(found).alias("reg_order", "o")).select("o.*", F.col("reg_order").cast("long"))
    return rows.withColumns({c: F.coalesce(c, F.array().cast(k)) for c, k in (("asns", "array<bigint>"), ("domains", "array<string>"))}).select(*(f.split()[0] for f in ORG.split(", ")))


def write_orgs(orgs: DataFrame, path: str, source: str, built_at: str) -> None:
    """JSON lines, each with source and built_at; tasks write their own files, and ``reg_order`` keeps the order."""
    stamped = orgs.select(F.lit(source).alias("source"), F.lit(built_at).alias("built_at"), *(f.split()[0] for f in ORG.split(", ")))
    stamped.write.mode("overwrite").json(path, ignoreNullFields=False)


def write_dated_orgs(orgs: DataFrame, folder: str, source: str, at: datetime.datetime, keep: int = 4) -> str:
    """A copy of the map under its date, as ``current`` names it from then on; of all copies the newest ``keep`` stay. Returns its folder.

    A copy is known when it is whole: ``current`` changes after the write, and the copy that it names is never deleted.
    """
    spark = orgs.sparkSession
    name = f"org-map-{at:%Y%m%dT%H%M%SZ}"
    write_orgs(orgs, f"{folder}/{name}", source, at.strftime("%Y-%m-%dT%H:%M:%SZ"))
    spark.range(1).select(F.lit(name).alias("value")).coalesce(1).write.mode("overwrite").text(f"{folder}/current")
    have = {n: p for n, p in store.folders(spark, folder).items() if n.startswith("org-map-")}
    for old in sorted(have)[: -keep or None]:
        if old != name:
            have[old].getFileSystem(spark._jsc.hadoopConfiguration()).delete(have[old], True)
    return f"{folder}/{name}"


def current_orgs(spark: SparkSession, folder: str) -> DataFrame:
    """The copy that ``current`` names."""
    return read_orgs(spark, f"{folder}/{spark.read.text(f'{folder}/current').first()[0]}")


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """Cases of a JSON lines file; blank and ``#`` lines are skipped, a bad line fails the load. ``expect_hit`` is true by default."""
    lines = spark.read.text(path).where("trim(value) <> '' AND NOT startswith(ltrim(value), '#')")
    rows = lines.select(F.from_json("value", ", ".join(CASE.split(", ")), {"mode": "FAILFAST", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"}).alias("c")).select("c.*")
    return rows.withColumns({"expect_hit": F.coalesce("expect_hit", F.lit(True)), "notes": F.coalesce("notes", F.lit(""))})


ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON lines table; a bad line fails the load, unknown fields are ignored."""
    return spark.read.schema(schema).json(path, mode="FAILFAST", timestampFormat="yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_lines(spark, path, EVENT)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return read_lines(spark, path, FEATURE)


def read_signals(spark: SparkSession, path: str) -> DataFrame:
    rows = read_lines(spark, path, SIGNAL)
    return rows.withColumn("suppress_flags", F.coalesce("suppress_flags", F.array().cast("array<string>")))


def write_lines(rows: DataFrame, path: str, nulls: bool = True, append: bool = False) -> None:
    """JSON lines. Events, features, alerts and results keep nulls; an inbox is appended to, and a rerun appends again."""
    rows.write.mode("append" if append else "overwrite").json(path, ignoreNullFields=not nulls, timestampFormat=ISO)


def write_signals(signals: DataFrame, path: str, append: bool = False) -> None:
    """Signals without absent organisations and empty suppress_flags."""
    write_lines(signals.withColumn("suppress_flags", F.when(F.size("suppress_flags") > 0, F.col("suppress_flags"))), path, nulls=False, append=append)

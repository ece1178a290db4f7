"""Keyed tables that change: upserts that touch only rows that differ, soft deletes, and the changes as a log.

How their versions become the state of a store is in ``commits``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.shared import numbered
from ..functions.values import join_list, trimmed_or_null, utc_iso

CONTACT_KEY = ("asn_a", "asn_b", "as_of")
ORG_KEY = ("org_id",)


def org_rows(orgs: DataFrame) -> DataFrame:
    """Organisations as stored: lists as comma text, empty ids as null."""
    return orgs.select("org_id", "name", join_list(F.col("asns")).alias("asns"), join_list(F.col("domains")).alias("domains"), trimmed_or_null(F.col("external_id")).alias("external_id"), "reg_order")


def contact_rows(signals: DataFrame) -> DataFrame:
    """Signals as stored: instants as text, lists as comma text, empty organisations as null."""
    lists = {c: join_list(F.col(c)) for c in ("domains_a", "domains_b", "event_kinds", "suppress_flags")}
    orgs = {c: trimmed_or_null(F.col(c)) for c in ("org_a", "org_b")}
    return signals.withColumn("as_of_date", F.date_format("as_of", "yyyy-MM-dd")).withColumns(lists | orgs | {c: utc_iso(F.col(c)) for c in ("as_of", "prior_as_of")})


def checked_contacts(rows: DataFrame) -> DataFrame:
    """The rows; one that breaks a rule of the table fails the job."""
    rules = {
        "asn_a < asn_b": F.col("asn_a") < F.col("asn_b"), "kind": F.col("kind") == "network_contact", "as_of_date": F.col("as_of_date") == F.substring("as_of", 1, 10),
        "org_a": F.coalesce(F.col("org_a") != "", F.lit(True)), "org_b": F.coalesce(F.col("org_b") != "", F.lit(True)),
    }
    ok = F.lit(True)
    for name, rule in rules.items():
        ok = F.when(F.coalesce(rule, F.lit(False)), ok).otherwise(F.raise_error(F.lit(f"network_contact: {name}")).cast("boolean"))
    return rows.where(ok)


def upsert(current: DataFrame, incoming: DataFrame, key: tuple[str, ...], now: Column, retract: Column | None = None) -> DataFrame:
    """``current`` (with deleted_at) after ``incoming`` (without): a row with op.

    op is I for a new key, U for a row that differs or was deleted, or that ``retract`` (a condition on current rows)
    lets go as ``incoming`` lacks it: its deleted_at becomes ``now``. It is null for rows left as they are.
    """
    values = [c for c in incoming.columns if c not in key]
    old = current.select(*(F.col(c).alias(f"_o_{c}") for c in (*key, *values, "deleted_at")), F.lit(True).alias("_old"))
    new = incoming.withColumn("_new", F.lit(True))
    both = new.join(old, [F.col(c) == F.col(f"_o_{c}") for c in key], "full_outer")
    differs = F.col("_o_deleted_at").isNotNull()
    for c in values:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    gone = F.col("_new").isNull() & F.col("_o_deleted_at").isNull()
    if retract is not None:
        gone = gone & retract
    op = F.when(F.col("_old").isNull(), "I").when(F.col("_new").isNotNull() & differs, "U").when(gone, "U")
    deleted = F.when(F.col("_new").isNotNull(), F.lit(None)).when(gone, now.cast("long")).otherwise(F.col("_o_deleted_at"))
    return both.select(*(F.coalesce(c, f"_o_{c}").alias(c) for c in key), *(F.when(F.col("_new").isNotNull(), F.col(c)).otherwise(F.col(f"_o_{c}")).alias(c) for c in values), deleted.cast("long").alias("deleted_at"), op.alias("op"))


def in_scope(as_of: Column) -> Column:
    """Rows of one instant, for ``retract`` of a daily commit."""
    return F.col("_o_as_of") == as_of


def outbox(changed: DataFrame, table: str, key: tuple[str, ...], ts: Column, last_seq: int = 0) -> DataFrame:
    """The changes (rows of ``upsert`` with an op) as seq, tbl, op, key (JSON), ts; seq goes on from ``last_seq`` in the order of the keys."""
    rows = changed.where("op IS NOT NULL").select(F.lit(table).alias("tbl"), "op", F.to_json(F.struct(*key)).alias("key"), ts.alias("ts"))
    return numbered(rows, "_n", "tbl", "key").select((F.col("_n") + last_seq + 1).alias("seq"), "tbl", "op", "key", "ts")


def folders(spark: SparkSession, path: str) -> dict[str, object]:
    """The folders in a folder, by name."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName(): s.getPath() for s in fs.listStatus(p)} if fs.exists(p) else {}


ORGS = "org_id string, name string, asns string, domains string, external_id string, reg_order bigint, deleted_at bigint"
CONTACTS = (
    "asn_a bigint, asn_b bigint, as_of string, as_of_date string, prior_as_of string, schema_version int, source string, kind string, org_a string, org_b string, "
    "domains_a string, domains_b string, prefixes_moved bigint, prefix_move_days bigint, new_adj_days bigint, upstream_converge_days bigint, persistence_days bigint, "
    "score bigint, event_kinds string, suppress_flags string, deleted_at bigint"
)
RUNS = "as_of_date string, as_of string, prior_as_of string, status string, signal_count bigint, detail string"
ORG_RUNS = "as_of_date string, started_at string, finished_at string, built_at string, org_count bigint"
OUTBOX = "seq bigint, tbl string, op string, key string, ts string"


def put_run(current: DataFrame, run: DataFrame) -> DataFrame:
    """Run rows by as_of_date; the new one replaces an old one."""
    return current.join(run.select("as_of_date"), "as_of_date", "left_anti").unionByName(run)


def require_fresh(org_runs: DataFrame, live_orgs: int, now: Column, max_age_days: float) -> None:
    """Refuse to go on without a crawl, with one older than ``max_age_days``, or without live organisations."""
    row = org_runs.agg(F.max("finished_at").alias("at"), F.max((F.unix_seconds(now) - F.unix_seconds(F.to_timestamp("finished_at"))) / 86400).alias("_"),
                       F.min((F.unix_seconds(now) - F.unix_seconds(F.to_timestamp("finished_at"))) / 86400).alias("age")).first()
    if row.at is None:
        raise ValueError("no organisation crawl yet")
    if row.age > max_age_days:
        raise ValueError(f"the organisation map is {row.age:.1f} days old; at most {max_age_days} are allowed")
    if not live_orgs:
        raise ValueError("the organisation map has no live organisation")

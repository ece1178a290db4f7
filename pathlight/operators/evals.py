"""Labelled cases against events and features; lead of contacts over announcements; sampled days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import announce_day, horizon_bucket

CONTACT_KINDS = ("prefix_move", "new_adj", "upstream_converge")


def first_match(cases: DataFrame, matches: DataFrame) -> DataFrame:
    """``matches``: id, rank (orderable), detail. Results of all cases: id, hit, passed, matched_detail."""
    best = matches.groupBy("id").agg(F.min(F.struct("rank", "detail")).alias("m"))
    out = cases.join(best, "id", "left")
    hit = F.col("m").isNotNull()
    return out.select("id", hit.alias("hit"), (hit == F.col("expect_hit")).alias("passed"), F.col("m.detail").alias("matched_detail"))


def by_asn(cases: DataFrame) -> DataFrame:
    """Cases with asn_lo and asn_hi of their pair (null for a case of one ASN)."""
    return cases.withColumns({"asn_lo": F.when(F.col("asn_b").isNotNull(), F.least("asn_a", "asn_b")), "asn_hi": F.when(F.col("asn_b").isNotNull(), F.greatest("asn_a", "asn_b"))})


def eval_events(cases: DataFrame, events: DataFrame) -> DataFrame:
    """Each case's first event (by time, then detail and prefix) of its kind, window, prefix and ASNs.

    Two equi-joins, of cases with a pair and of cases with one ASN, instead of a scan of all events for each case.
    """
    e = events.select("kind", "timestamp", "prefix", "detail", F.col("asn_a").alias("ea"), F.least("asn_a", "asn_b").alias("elo"), F.greatest("asn_a", "asn_b").alias("ehi"), F.col("asn_b").isNotNull().alias("two"))
    c = by_asn(cases).withColumnRenamed("prefix", "want")
    pairs = c.where("asn_b IS NOT NULL").join(e.where("two AND ea IS NOT NULL"), (F.col("asn_lo") == F.col("elo")) & (F.col("asn_hi") == F.col("ehi")) & (F.col("kind") == F.col("expect_kind")))
    ones = c.where("asn_b IS NULL").join(e, (F.col("asn_a") == F.col("ea")) & (F.col("kind") == F.col("expect_kind")))
    found = pairs.unionByName(ones).where("timestamp BETWEEN window_start AND window_end AND (want IS NULL OR want = prefix)")
    return first_match(cases, found.select("id", F.struct("timestamp", "detail", "prefix").alias("rank"), "detail"))


def case_focus(cases: DataFrame, explicit: DataFrame) -> DataFrame:
    """asn: those of an explicit list (asn) and of all cases."""
    named = cases.select(F.explode(F.array("asn_a", "asn_b")).alias("asn")).where("asn IS NOT NULL")
    return explicit.select(F.col("asn").cast("long").alias("asn")).union(named.select(F.col("asn").cast("long"))).distinct()


def kind_shown():
    return F.expr("CASE expect_kind WHEN 'prefix_move' THEN prefix_move_days > 0 WHEN 'new_adj' THEN new_adj_days > 0 WHEN 'upstream_converge' THEN upstream_converge_days > 0 WHEN 'footprint_step' THEN true END")


def feature_detail():
    return F.format_string("score=%d prefixes_moved=%d prefix_move_days=%d persistence_days=%d", "score", "prefixes_moved", "prefix_move_days", "persistence_days")


def eval_features(cases: DataFrame, features: DataFrame) -> DataFrame:
    """Each case's first feature (by score, then ASNs) of its ASNs whose span meets its window and whose counters show its kind."""
    f = features.withColumnRenamed("asn_lo", "flo").withColumnRenamed("asn_hi", "fhi")
    c = by_asn(cases)
    pairs = c.where("asn_b IS NOT NULL").join(f, (F.col("asn_lo") == F.col("flo")) & (F.col("asn_hi") == F.col("fhi")))
    ends = f.withColumn("end", F.explode(F.array("flo", "fhi")))
    ones = c.where("asn_b IS NULL").join(ends, F.col("asn_a") == F.col("end")).drop("end")
    found = pairs.unionByName(ones).where(F.expr("NOT (last_seen < window_start OR first_seen > window_end)") & kind_shown())
    return first_match(cases, found.select("id", F.struct((-F.col("score")).alias("s"), "flo", "fhi").alias("rank"), feature_detail().alias("detail")))


def report(events: DataFrame, features: DataFrame) -> DataFrame:
    """One row of counts of two tables of results."""
    def counts(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.count_if("hit").alias(f"{name}_hits"), F.count_if(~F.col("hit")).alias(f"{name}_misses"), F.count_if("passed").alias(f"{name}_passed"), F.count_if(~F.col("passed")).alias(f"{name}_failed"))

    e, f = counts(events, "event"), counts(features, "feature")
    return e.withColumn("_", F.lit(0)).join(f.withColumn("_", F.lit(0)), "_").drop("_")


def pair_contacts(cases: DataFrame, features: DataFrame, events: DataFrame) -> DataFrame:
    """id and first: the first contact of a case's pair in its window, by features (not before the window) or events."""
    c = by_asn(cases).where("asn_b IS NOT NULL").select("id", "asn_lo", "asn_hi", "window_start", "window_end")
    f = c.join(features, ["asn_lo", "asn_hi"]).where("NOT (last_seen < window_start OR first_seen > window_end) AND (prefix_move_days > 0 OR new_adj_days > 0 OR upstream_converge_days > 0)")
    e = events.where(F.col("kind").isin(*CONTACT_KINDS)).select(F.least("asn_a", "asn_b").alias("asn_lo"), F.greatest("asn_a", "asn_b").alias("asn_hi"), "timestamp", (F.col("asn_a").isNotNull() & F.col("asn_b").isNotNull()).alias("two"))
    e = c.join(e.where("two"), ["asn_lo", "asn_hi"]).where("timestamp BETWEEN window_start AND window_end")
    both = f.select("id", F.greatest("first_seen", "window_start").alias("at")).unionByName(e.select("id", F.col("timestamp").alias("at")))
    return both.groupBy("id").agg(F.min("at").alias("first"))


def footprint_targets(cases: DataFrame, events: DataFrame) -> DataFrame:
    """id of the cases whose target (asn_b, else asn_a) has a footprint step in the window."""
    c = cases.select("id", F.coalesce("asn_b", "asn_a").alias("target"), "window_start", "window_end")
    e = events.where("kind = 'footprint_step'").select(F.col("asn_a").alias("target"), "timestamp")
    return c.join(e, "target").where("timestamp BETWEEN window_start AND window_end").select("id").distinct()


def lead_lag(cases: DataFrame, features: DataFrame, events: DataFrame) -> DataFrame:
    """A row for each case: hits, the first contact, its lead in calendar days over the announcement, and the lead's range."""
    fr = eval_features(cases, features).select("id", F.col("hit").alias("feature_hit"), F.col("passed").alias("passed_feature"), F.col("matched_detail").alias("detail"))
    er = eval_events(cases, events).select("id", F.col("hit").alias("event_hit"))
    out = cases.join(fr, "id").join(er, "id").join(pair_contacts(cases, features, events), "id", "left").join(footprint_targets(cases, events).withColumn("fp", F.lit(True)), "id", "left")
    contact = F.col("first").isNotNull()
    lead = F.datediff(announce_day(F.col("notes"), F.col("window_end")), F.to_date("first")).cast("long")
    return out.select(
        "id", "expect_hit", "expect_kind", "asn_a", "asn_b", F.date_format("window_end", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("announce_end"), "feature_hit", "event_hit",
        contact.alias("pair_contact_hit"), F.coalesce("fp", F.lit(False)).alias("target_footprint_hit"), "passed_feature", lead.alias("lead_days"),
        horizon_bucket(lead, contact).alias("horizon_bucket"), F.date_format("first", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("first_seen"), "detail",
    )


def sample_days(spark, start: str, end: str, every: int) -> DataFrame:
    """day: every so many days from start to end, and always the end."""
    return spark.sql(f"SELECT explode(array_distinct(concat(sequence(DATE'{start}', DATE'{end}', INTERVAL {int(every)} DAYS), array(DATE'{end}')))) AS day")


def day_pairs(days: DataFrame) -> DataFrame:
    """prev_day, day of consecutive days. The list of sampled days is short, so one window orders it."""
    return days.selectExpr("lag(day) OVER (ORDER BY day) AS prev_day", "day").where("prev_day IS NOT NULL")


#: In which order neighbouring days are tried for one that has no dump.
OFFSETS = (0, -1, 1, -2, 2, -3, 3)


def nearest_days(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """day and used: the first day in the order of OFFSETS that is among ``have`` (day); null if none is."""
    tries = F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(o).alias("offset")) for i, o in enumerate(OFFSETS)))
    rows = wanted.select("day", F.inline(tries)).withColumn("used", F.date_add("day", F.col("offset")))
    found = rows.join(have.select(F.col("day").alias("used")).distinct(), "used").groupBy("day").agg(F.min(F.struct("rank", "used")).alias("m"))
    return wanted.join(found, "day", "left").select("day", F.col("m.used").alias("used"))

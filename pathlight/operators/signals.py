"""Rolling state of pairs, and signals."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.shared import materialize
from ..functions.values import elapsed_days, saturating_sum
from .attribution import with_primary
from .commits import Transaction

#: Buckets of the table of pairs.
BUCKETS = 64

COUNTERS = ("prefix_move_days", "prefixes_moved", "new_adj_days", "upstream_converge_days")


def merge_state(state: DataFrame, features: DataFrame, as_of: Column, retain_days: int = 30) -> DataFrame:
    """The state after a day: spans widen, counters add up (a rerun of a day adds again), the score is the largest; pairs unseen for ``retain_days`` go."""
    old = state.select("asn_lo", "asn_hi", *(F.col(c).alias(f"_{c}") for c in state.columns if c not in ("asn_lo", "asn_hi")))
    both = features.drop("persistence_days").join(old, ["asn_lo", "asn_hi"], "full_outer")
    zero = F.lit(0).cast("long")
    merged = both.select(
        "asn_lo", "asn_hi", F.coalesce("_org_lo", "org_lo").alias("org_lo"), F.coalesce("_org_hi", "org_hi").alias("org_hi"),
        F.least("_first_seen", "first_seen").alias("first_seen"), F.greatest("_last_seen", "last_seen").alias("last_seen"),
        *(saturating_sum(F.coalesce(f"_{c}", zero), F.coalesce(c, zero)).alias(c) for c in COUNTERS), F.greatest("_score", "score").alias("score"),
    )
    return merged.where(F.col("last_seen") >= as_of - F.expr(f"INTERVAL {int(retain_days)} DAYS"))


def merge_touched(step: Transaction, features: DataFrame, as_of: Column, retain_days: int = 30, buckets: int = BUCKETS, name: str = "pair_state") -> DataFrame:
    """``merge_state`` into a store's table of pairs, bucket by bucket: only those are read and written that the day's pairs
    fall into or that have a pair to let go. Returns the new state of these buckets.

    The table's tag keeps the oldest ``last_seen`` of each bucket, so that buckets with old pairs are known without a look.
    """
    spark = features.sparkSession
    bucket = F.pmod(F.xxhash64("asn_lo", "asn_hi"), F.lit(buckets)).cast("int")
    known = json.loads(step.tags.get(name, "{}"))
    if known.get("buckets") != buckets:  # the first time, or dealt anew
        touched, oldest = list(range(buckets)), {}
    else:
        oldest = known["oldest"]
        end = spark.range(1).select(F.unix_seconds(as_of - F.expr(f"INTERVAL {int(retain_days)} DAYS")).alias("x")).first().x
        touched = sorted({r.b for r in features.select(bucket.alias("b")).distinct().collect()} | {int(k) for k, at in oldest.items() if at < end})
    merged = materialize(merge_state(step.read_buckets(name, touched), features, as_of, retain_days).withColumn("bucket", bucket), "merged-state")
    step.replace(name, merged, "bucket", touched)
    new = {str(r.bucket): r.at for r in merged.groupBy("bucket").agg(F.unix_seconds(F.min("last_seen")).alias("at")).collect()}  # a row a bucket
    step.tag(name, json.dumps({"buckets": buckets, "oldest": {k: v for k, v in oldest.items() if int(k) not in touched} | new}))
    return merged.drop("bucket")


def build_signals(features: DataFrame, primaries: DataFrame, as_of: Column, prior_as_of: Column, state: DataFrame | None = None, source: str = "pathlight") -> DataFrame:
    """A signal for each pair of today's features; counters and score are the state's where that is larger, the persistence is the state's."""
    out = features
    if state is not None:
        old = state.select("asn_lo", "asn_hi", *(F.col(c).alias(f"_{c}") for c in (*COUNTERS, "score")), elapsed_days(F.col("first_seen"), F.col("last_seen")).alias("_persistence"))
        out = features.join(old, ["asn_lo", "asn_hi"], "left")
        kinds = event_kinds()
        out = out.withColumn("event_kinds", kinds).withColumns({c: F.greatest(c, f"_{c}") for c in (*COUNTERS, "score")} | {"persistence_days": F.coalesce("_persistence", "persistence_days")})
    else:
        out = out.withColumn("event_kinds", event_kinds())
    out = with_primary(with_primary(out, primaries, "asn_lo", "_oa", "domains_a"), primaries, "asn_hi", "_ob", "domains_b")
    return out.select(
        F.lit(1).alias("schema_version"), F.lit(source).alias("source"), F.lit("network_contact").alias("kind"), as_of.alias("as_of"), prior_as_of.alias("prior_as_of"),
        F.col("asn_lo").alias("asn_a"), F.col("asn_hi").alias("asn_b"), F.col("org_lo").alias("org_a"), F.col("org_hi").alias("org_b"), "domains_a", "domains_b",
        "prefixes_moved", "prefix_move_days", "new_adj_days", "upstream_converge_days", "persistence_days", "score", "event_kinds", F.array().cast("array<string>").alias("suppress_flags"),
    )


def event_kinds() -> Column:
    """The kinds that today's counters show, in a fixed order."""
    return F.array_compact(F.array(*(F.when(F.col(c) > 0, k) for c, k in (("prefix_move_days", "prefix_move"), ("new_adj_days", "new_adj"), ("upstream_converge_days", "upstream_converge")))))


def ranked(signals: DataFrame) -> DataFrame:
    return signals.orderBy(F.desc("score"), "asn_a", "asn_b")

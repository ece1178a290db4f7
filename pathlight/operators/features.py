"""Events to features of pairs of ASNs, and which pairs are dropped as noise."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SparseConfig
from ..functions.values import day, elapsed_days, present
from .attribution import families_of_asn



def sparse(events: DataFrame, config: SparseConfig | None = None) -> DataFrame:
    """Prefix moves of pairs that have at least so many of them on one UTC day (events, not prefixes); other kinds as configured.

    A move without two ASNs has no pair and is dropped. One pass over the moves: they are counted where they stand.
    """
    config = config or SparseConfig()
    pair_day = Window.partitionBy(F.least("asn_a", "asn_b"), F.greatest("asn_a", "asn_b"), day(F.col("timestamp")))
    moves = events.where("kind = 'prefix_move' AND asn_a IS NOT NULL AND asn_b IS NOT NULL")
    kept = moves.withColumn("_n", F.count("*").over(pair_day)).where(F.col("_n") >= config.min_moves_per_pair_day).drop("_n")
    others = [k for k, on in (("new_adj", config.keep_new_adj), ("upstream_converge", config.keep_upstream_converge), ("footprint_step", config.keep_footprint_step)) if on]
    return kept.unionByName(events.where(F.col("kind").isin(others))) if others else kept


def pair_features(events: DataFrame) -> DataFrame:
    """A row for each undirected pair: distinct days of each kind, distinct prefixes moved, span, score, organisations.

    Organisations are the first that is known: by time, then kind, then detail.
    """
    rows = events.where("asn_a IS NOT NULL AND asn_b IS NOT NULL AND asn_a <> asn_b").withColumns({
        "asn_lo": F.least("asn_a", "asn_b"), "asn_hi": F.greatest("asn_a", "asn_b"), "_day": day(F.col("timestamp")),
        "_lo": F.expr("CASE WHEN asn_a < asn_b THEN org_a ELSE org_b END"), "_hi": F.expr("CASE WHEN asn_a < asn_b THEN org_b ELSE org_a END"),
    })

    def days(kind: str):
        return F.countDistinct(F.when(F.col("kind") == kind, F.col("_day"))).cast("long")

    def first(org: str):
        return F.min(F.when(F.col(org).isNotNull(), F.struct("timestamp", "kind", "detail", org)))[org]

    out = rows.groupBy("asn_lo", "asn_hi").agg(
        first("_lo").alias("org_lo"), first("_hi").alias("org_hi"), days("prefix_move").alias("prefix_move_days"),
        F.countDistinct(F.when(F.col("kind") == "prefix_move", F.col("prefix"))).cast("long").alias("prefixes_moved"),
        days("new_adj").alias("new_adj_days"), days("upstream_converge").alias("upstream_converge_days"),
        F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"),
    )
    out = out.withColumn("persistence_days", elapsed_days(F.col("first_seen"), F.col("last_seen")))
    return out.withColumn("score", F.expr("prefixes_moved * 10 + prefix_move_days * 5 + new_adj_days + upstream_converge_days + greatest(persistence_days, 0)"))


def ranked(features: DataFrame) -> DataFrame:
    return features.orderBy(F.desc("score"), "asn_lo", "asn_hi")


def clean_reason(features: DataFrame, orgs: DataFrame, glue: DataFrame, leasing: DataFrame) -> DataFrame:
    """``features`` with drop_reason: glue, leasing, unattributed, same_org or same_family, the first that holds; null if none."""
    out = features
    fam = families_of_asn(orgs)
    for side in ("lo", "hi"):
        key = f"asn_{side}"
        out = out.join(glue.select(F.col("asn").alias(key), F.lit(True).alias(f"_g{side}")).distinct(), key, "left")
        out = out.join(leasing.select(F.col("asn").alias(key), F.lit(True).alias(f"_l{side}")).distinct(), key, "left")
        out = out.join(fam.select(F.col("asn").alias(key), F.col("families").alias(f"_f{side}")), key, "left")
    reason = (
        F.when(F.coalesce("_glo", "_ghi").isNotNull(), "glue").when(F.coalesce("_llo", "_lhi").isNotNull(), "leasing")
        .when(~present(F.col("org_lo")) | ~present(F.col("org_hi")), "unattributed").when(F.col("org_lo") == F.col("org_hi"), "same_org")
        .when(F.coalesce(F.arrays_overlap("_flo", "_fhi"), F.lit(False)), "same_family")
    )
    return out.select(*features.columns, reason.alias("drop_reason"))


def clean(features: DataFrame, orgs: DataFrame, glue: DataFrame, leasing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The features that are kept, and those that are dropped with their reason."""
    flagged = clean_reason(features, orgs, glue, leasing)
    return flagged.where("drop_reason IS NULL").drop("drop_reason"), flagged.where("drop_reason IS NOT NULL")

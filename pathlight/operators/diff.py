"""Differences of daily snapshots as events: prefix moves, new upstreams, new adjacencies, steps in footprint.

``before`` and ``after`` have the columns of a collapsed snapshot and ``day``, the day of the comparison, the same on
both sides; ``after`` also has ``as_of``. Many days are compared in one job: every key starts with the day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DiffConfig
from ..functions.paths import edges
from ..functions.shared import materialize
from .attribution import org_asn, primary, subjects, with_primary

EVENT = ("kind", "timestamp", "org_a", "org_b", "asn_a", "asn_b", "domains_a", "domains_b", "prefix", "detail")


class Context:
    """What all kinds of events need: numbers of prefixes, the watched ASNs of each day, glue, primary organisations, and the days' instants.

    Numbers, watched ASNs and primaries are read several times and written once.
    """

    def __init__(self, before: DataFrame, after: DataFrame, orgs: DataFrame, glue: DataFrame, config: DiffConfig | None = None):
        self.before, self.after, self.glue, self.config = before, after, glue.select("asn").distinct(), config or DiffConfig()
        bridge = org_asn(orgs)
        sides = [s.select("day", F.col("origin_asn").alias("asn"), F.lit(b).alias("b"), F.lit(a).alias("a")) for s, b, a in ((before, 1, 0), (after, 0, 1))]
        self.counts = materialize(sides[0].unionByName(sides[1]).groupBy("day", "asn").agg(F.sum("b").alias("b"), F.sum("a").alias("a")), "counts")
        self.subjects = materialize(subjects(bridge, self.glue, self.counts.select("day", "asn", F.greatest("b", "a").alias("n")), self.config.subjects, ["day"]), "subjects")
        self.primaries = materialize(primary(bridge, orgs), "primaries")
        self.instants = after.groupBy("day").agg(F.max("as_of").alias("timestamp"))

    def rows(self, found: DataFrame, kind: str, prefix: bool = False) -> DataFrame:
        """kind, day, asn_a, asn_b, prefix and detail of what was found."""
        return found.select(F.lit(kind).alias("kind"), "day", "asn_a", "asn_b", F.col("prefix") if prefix else F.lit(None).cast("string").alias("prefix"), "detail")

    def events(self, rows: DataFrame) -> DataFrame:
        """Rows of any kinds with organisations, domains and instants, all attributed at once. New upstreams of one organisation's own go."""
        rows = with_primary(with_primary(rows, self.primaries, "asn_a", "org_a", "domains_a"), self.primaries, "asn_b", "org_b", "domains_b")
        rows = rows.where("kind <> 'upstream_converge' OR NOT coalesce(org_a = org_b, false)")
        return rows.join(self.instants, "day").select(*EVENT)

    def without_glue(self, rows: DataFrame) -> DataFrame:
        for c in ("asn_a", "asn_b"):
            rows = rows.join(self.glue.select(F.col("asn").alias(c)), c, "left_anti")
        return rows


def moved_prefixes(c: Context) -> DataFrame:
    moved = c.before.select("day", "prefix", F.col("origin_asn").alias("asn_a")).join(c.after.select("day", "prefix", F.col("origin_asn").alias("asn_b")), ["day", "prefix"]).where("asn_a <> asn_b")
    for side in ("asn_a", "asn_b"):
        moved = moved.join(c.subjects.select("day", F.col("asn").alias(side), F.lit(True).alias(f"_{side}")), ["day", side], "left")
    moved = moved.where("coalesce(_asn_a, _asn_b, false)")
    return c.rows(moved.withColumn("detail", F.format_string("origin %d -> %d", "asn_a", "asn_b")), "prefix_move", True)


def new_upstreams(c: Context) -> DataFrame:
    def pairs(snapshot: DataFrame) -> DataFrame:
        return snapshot.where("upstream_asn IS NOT NULL").select("day", F.col("origin_asn").alias("asn_a"), F.col("upstream_asn").alias("asn_b")).distinct()

    new = pairs(c.after).join(pairs(c.before), ["day", "asn_a", "asn_b"], "left_anti").join(c.subjects.select("day", F.col("asn").alias("asn_a")), ["day", "asn_a"], "left_semi")
    return c.rows(new.withColumn("detail", F.format_string("origin %d gained upstream %d", "asn_a", "asn_b")), "upstream_converge")


def adjacencies(snapshot: DataFrame) -> DataFrame:
    """day, asn_a < asn_b: neighbours on some path."""
    return snapshot.select("day", F.explode(edges("as_path")).alias("e")).select("day", F.col("e.a").alias("asn_a"), F.col("e.b").alias("asn_b")).where("asn_a <> asn_b").distinct()


def new_neighbours(c: Context) -> DataFrame:
    new = adjacencies(c.after).join(adjacencies(c.before), ["day", "asn_a", "asn_b"], "left_anti")
    for side in ("asn_a", "asn_b"):
        new = new.join(c.subjects.select("day", F.col("asn").alias(side)), ["day", side], "left_semi")
    return c.rows(new.withColumn("detail", F.format_string("new subject adjacency %d-%d", "asn_a", "asn_b")), "new_adj")


def steps(c: Context) -> DataFrame:
    delta, least = F.abs(F.col("a") - F.col("b")), c.config.footprint_absolute
    rows = c.counts.where((delta >= least) & ((delta / F.greatest(F.col("b"), F.lit(1)) >= c.config.footprint_relative) | (delta >= 4 * least)))
    rows = rows.join(c.subjects, ["day", "asn"], "left_semi").withColumnRenamed("asn", "asn_a").withColumn("asn_b", F.lit(None).cast("long"))
    return c.rows(rows.withColumn("detail", F.format_string("prefix_count %d -> %d (delta %d)", "b", "a", F.col("a") - F.col("b"))), "footprint_step")


def prefix_moves(c: Context) -> DataFrame:
    """Prefixes whose origin changed, with a watched ASN on either side and glue on neither."""
    return c.events(c.without_glue(moved_prefixes(c)))


def upstream_converge(c: Context) -> DataFrame:
    """New (origin, upstream) of watched origins: neither glue, not of one known organisation."""
    return c.events(c.without_glue(new_upstreams(c)))


def new_adjacency(c: Context) -> DataFrame:
    """Neighbours on some path that were not before; both watched, neither glue."""
    return c.events(c.without_glue(new_neighbours(c)))


def footprint_steps(c: Context) -> DataFrame:
    """Watched origins whose number of prefixes changed by much, absolutely and relatively."""
    return c.events(steps(c))


def diff(before: DataFrame, after: DataFrame, orgs: DataFrame, glue: DataFrame, config: DiffConfig | None = None) -> DataFrame:
    """All four kinds of events."""
    c = Context(before, after, orgs, glue, config)
    between = reduce(DataFrame.unionByName, [moved_prefixes(c), new_upstreams(c), new_neighbours(c)])
    return c.events(c.without_glue(between).unionByName(steps(c)))


def diff_days(snapshots: DataFrame, orgs: DataFrame, glue: DataFrame, pairs: DataFrame, config: DiffConfig | None = None) -> DataFrame:
    """Events of many pairs (prev_day, day) of the days of ``snapshots`` at once."""
    before = snapshots.drop("as_of").join(F.broadcast(pairs.select(F.col("prev_day").alias("_p"), F.col("day").alias("_d"))), F.col("day") == F.col("_p")).drop("day", "_p").withColumnRenamed("_d", "day")
    after = snapshots.join(F.broadcast(pairs.select("day")), "day")
    return diff(before, after, orgs, glue, config)

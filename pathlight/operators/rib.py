"""Routing tables: last write for each (prefix, peer), best route for each prefix, matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ip import WORDS, mask, with_network
from ..functions.paths import upstream_of
from ..functions.shared import materialize as written
from ..functions.shared import numbered


#: Rows that one task may put in order.
SMALL_CAP = 100_000


def announcements(elements: DataFrame, *more: str) -> DataFrame:
    """Decoded messages as seq, prefix, peer_asn, withdraw, as_path, origin_asn, ts, and columns ``more``. The origin is the first one listed, else the path's last hop."""
    path = F.coalesce("as_path", F.array().cast("array<bigint>"))
    origin = F.coalesce(F.try_element_at("origin_asns", F.lit(1)), F.try_element_at(path, F.lit(-1)))
    return elements.select("seq", "prefix", "peer_asn", (F.col("elem_type") == "W").alias("withdraw"), path.alias("as_path"), origin.alias("origin_asn"), "ts", *more)


def materialize(updates: DataFrame, order: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """The routes that stand after all updates: the last of each (prefix, peer_asn), and ``by``, by ``order``, unless it withdraws.

    One aggregation; what a task has seen of a route is one row before the shuffle.
    """
    order, keys = order or ["seq"], [*(by or []), "prefix", "peer_asn"]
    rest = [c for c in updates.columns if c not in (*keys, *order)]
    last = updates.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("last"))
    return last.select(*keys, *(F.col(f"last.{c}").alias(c) for c in (*order, *rest))).where("NOT withdraw").drop("withdraw")


def counts(rib: DataFrame) -> DataFrame:
    """One row: prefix_count, route_count."""
    return rib.agg(F.countDistinct("prefix").alias("prefix_count"), F.count("*").alias("route_count"))


def intern(paths: DataFrame, value: str = "as_path", order: str = "seq") -> DataFrame:
    """Distinct values and an id for each, by first appearance; ids start at 0. Tasks number their own ranges."""
    first = paths.groupBy(value).agg(F.min(order).alias("first"))
    return numbered(first, "id", "first", value).select(value, "first", "id")


def first_updates(updates: DataFrame, most: int | None, *order: str) -> DataFrame:
    """At most ``most`` updates, the first ones; all if it is None. Places of a large cap come from ranges, so that it passes through no single task."""
    order = order or ("seq",)
    if most is None:
        return updates
    return updates.orderBy(*order).limit(most) if most <= SMALL_CAP else numbered(updates, "_place", *order).where(F.col("_place") < most).drop("_place")


def collapse(rib: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A row for each prefix: of its routes the longest path, prepends counted, ties to the lowest peer.

    The origin is looked at after that choice, so a prefix whose best route has none is left out.
    """
    by = [*(by or []), "prefix"]
    key = F.struct(F.size("as_path").alias("n"), (-F.col("peer_asn")).alias("p"))
    best = rib.groupBy(*by).agg(F.max(F.struct(key.alias("k"), "origin_asn", "as_path")).alias("best"))
    out = best.select(*by, F.col("best.origin_asn").alias("origin_asn"), F.col("best.as_path").alias("as_path")).where("origin_asn IS NOT NULL")
    return out.withColumn("upstream_asn", upstream_of("as_path", "origin_asn"))


def prefix_counts(snapshot: DataFrame, by: list[str] | None = None) -> DataFrame:
    return snapshot.groupBy(*(by or []), "origin_asn").agg(F.count("*").alias("n")).withColumnRenamed("origin_asn", "asn")


def exact_match(rib: DataFrame, prefixes: DataFrame) -> DataFrame:
    return prefixes.join(rib, "prefix")


def ancestors(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """Each row once for each prefix length that occurs in ``lengths`` (family, plen) and is at most its own, masked to it.

    At most 33 or 129 lengths exist, so they are gathered into one row per family and travel as such.
    """
    known = lengths.groupBy("family").agg(F.sort_array(F.collect_set("plen")).alias("lengths"))
    rows = rows.join(F.broadcast(known), "family").withColumn("up", F.explode(F.filter("lengths", lambda n: n <= F.col("plen"))))
    words = mask(F.col("up"))
    return rows.select(*(c for c in rows.columns if c not in ("lengths", *WORDS)), *(m.alias(w) for m, w in zip(words, WORDS)))


def longest_match(rib_prefixes: DataFrame, addresses: DataFrame, v6: bool = True) -> DataFrame:
    """``addresses``: a column address, any others. Adds ``matched``: the longest of ``rib_prefixes`` (prefix) that holds it, or null.

    Of several texts of one prefix the last in order is named.
    """
    from .containment import longest, swept

    table = with_network(rib_prefixes.select("prefix").distinct(), v6=v6).where("family IS NOT NULL")
    table = written(table.groupBy("family", "plen", *WORDS).agg(F.max("prefix").alias("text")), "prefixes")  # parsed once
    wanted = with_network(addresses.select("address").distinct(), "address", v6=v6).where("family IS NOT NULL")
    found = swept(table, written(wanted.withColumnRenamed("address", "text"), "addresses"), longest, ["address", "_origin", "matched"])
    return addresses.join(found.where("matched IS NOT NULL").select("address", "matched"), "address", "left")

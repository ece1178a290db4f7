"""Security of routes: origin validation against ROAs, valley-free paths, alerts."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ip import WORDS, with_network
from ..functions.paths import sql_collapse
from ..functions.shared import materialize
from .containment import origin_state, swept


def validate_origins(routes: DataFrame, roas: DataFrame, v6: bool = True, network: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``routes`` (prefix, origin_asn) with rpki_state: valid if a covering ROA has the origin and allows the length, else invalid if one covers, else unknown.

    A route without origin is unknown. Distinct (prefix, origin) are validated once, in one sweep over all prefixes.
    ``network`` adds family, plen and w0 to w3 to rows of a prefix (null where it is none); IP prefixes are read if it is None.
    """
    network = network or partial(with_network, v6=v6)
    table = network(roas.select("prefix", "max_length", F.col("origin_asn").alias("origin"))).where("family IS NOT NULL")
    table = materialize(table.groupBy("family", "plen", *WORDS).agg(F.collect_set(F.struct("max_length", "origin")).alias("allowed")), "roas")  # parsed once
    asked = routes.select("prefix", "origin_asn").where("prefix IS NOT NULL AND origin_asn IS NOT NULL").distinct()
    asked = materialize(network(asked).where("family IS NOT NULL").withColumnsRenamed({"prefix": "text", "origin_asn": "origin"}), "asked")
    state = swept(table, asked, origin_state, ["prefix", "origin_asn", "state"])
    out = routes.join(state, ["prefix", "origin_asn"], "left")
    return out.select(*routes.columns, F.coalesce("state", F.lit("unknown")).alias("rpki_state"))


def directed(relations: DataFrame) -> DataFrame:
    """Relations (a, b, rel: -1 a provides b, 0 peers) as src, dst, code: U to a provider, D to a customer, P to a peer; of several, U before D before P."""
    rows = relations.selectExpr("inline(CASE WHEN rel = -1 THEN array(named_struct('src', b, 'dst', a, 'code', 1), named_struct('src', a, 'dst', b, 'code', 2)) "
                                "WHEN rel = 0 THEN array(named_struct('src', a, 'dst', b, 'code', 3), named_struct('src', b, 'dst', a, 'code', 3)) END)")  # fmt: skip
    return rows.groupBy("src", "dst").agg(F.element_at(F.array(F.lit("U"), F.lit("D"), F.lit("P")), F.min("code")).alias("code"))


def path_verdicts(routes: DataFrame, relations: DataFrame) -> DataFrame:
    """``routes`` (as_path) with path_verdict: too_short, leak_suspected, incomplete or valley_free.

    Distinct paths are judged once. From the origin outwards a path must climb, cross at most one peering, and descend;
    hops of unknown relation are skipped, and a path with one that shows no leak is incomplete.
    """
    paths = routes.select("as_path").distinct()
    hops = paths.withColumn("d", F.expr(f"reverse({sql_collapse('as_path')})")).where("size(d) >= 2")
    hops = hops.select("as_path", F.posexplode(F.expr("zip_with(slice(d, 1, size(d) - 1), slice(d, 2, size(d) - 1), (x, y) -> named_struct('src', x, 'dst', y))")).alias("at", "h"))
    coded = hops.select("as_path", "at", "h.src", "h.dst").join(directed(relations), ["src", "dst"], "left")
    judged = coded.groupBy("as_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce("code", F.lit("")).alias("code")))), lambda s: s["code"]), "").alias("codes"),
                                          F.bool_or(F.col("code").isNull()).alias("gaps"))
    verdict = F.when(F.col("codes").isNull(), "too_short").when(~F.col("codes").rlike("^U*P?D*$"), "leak_suspected").when(F.col("gaps"), "incomplete").otherwise("valley_free")
    known = paths.join(judged, "as_path", "left").select("as_path", verdict.alias("path_verdict"))
    return routes.join(known, "as_path").select(*routes.columns, "path_verdict")


def alerts(routes: DataFrame) -> DataFrame:
    """Announcements (timestamp, prefix, origin_asn, as_path, peer_asn, collector, rpki_state, path_verdict) that are invalid or suspected leaks."""
    leak = F.col("path_verdict") == "leak_suspected"
    reason = F.concat_ws(",", F.when(F.col("rpki_state") == "invalid", "rpki_invalid"), F.when(leak, "valley_free_violation"))
    return routes.withColumn("leak_suspected", leak).where("rpki_state = 'invalid' OR leak_suspected").withColumn("reason", reason)

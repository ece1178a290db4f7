"""Organisations of ASNs and domains, and which ASNs are watched."""

from __future__ import annotations

import heapq
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LEASING, SubjectRule
from ..functions.domains import families, normalize
from ..functions.values import present


def normalized(orgs: DataFrame) -> DataFrame:
    """ASNs sorted and distinct; domains normalised, non-empty, sorted and distinct."""
    domains = F.array_sort(F.array_distinct(F.filter(F.transform("domains", normalize), lambda d: d != "")))
    return orgs.withColumns({"asns": F.array_sort(F.array_distinct("asns")), "domains": domains})


def overlay(base: DataFrame, *more: DataFrame) -> DataFrame:
    """Organisations of several sources, in order. The last record of an id is its body.

    ``mapped`` has every ASN that any record of the id has had, with its source and place there: a later source neither
    takes an ASN over nor lets one go, it only adds.
    """
    layers = [d.withColumn("layer", F.lit(i)) for i, d in enumerate((base, *more))]
    body = F.max(F.struct("layer", "reg_order", *(c for c in base.columns if c not in ("org_id", "reg_order"))))
    mapped = F.flatten(F.collect_list(F.transform("asns", lambda a: F.struct(a.alias("asn"), F.col("layer").alias("layer"), F.col("reg_order").alias("place")))))
    return reduce(DataFrame.unionByName, layers).groupBy("org_id").agg(body.alias("r"), mapped.alias("mapped")).select("org_id", "r.*", "mapped").drop("layer")


def org_asn(orgs: DataFrame) -> DataFrame:
    """asn, org_id, reg_order, hint: a row for each ASN of each organisation. After ``overlay``, reg_order is (source, place)."""
    hint = F.col("prefix_count_hint").alias("hint")
    if "mapped" not in orgs.columns:
        return orgs.select("org_id", "reg_order", hint, F.explode("asns").alias("asn"))
    return orgs.select("org_id", hint, F.explode("mapped").alias("m")).select("org_id", F.struct("m.layer", "m.place").alias("reg_order"), "hint", F.col("m.asn").alias("asn"))


def org_domain(orgs: DataFrame) -> DataFrame:
    return orgs.select("org_id", "reg_order", F.explode("domains").alias("domain"))


def primary(bridge: DataFrame, orgs: DataFrame) -> DataFrame:
    """asn, org_id and domains of the organisation that registered each ASN first."""
    first = bridge.groupBy("asn").agg(F.min(F.struct("reg_order", "org_id")).alias("f")).select("asn", F.col("f.org_id").alias("org_id"))
    return first.join(orgs.select("org_id", "domains"), "org_id").select("asn", "org_id", "domains")


def all_orgs(bridge: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """Every organisation of each of ``values`` (a column ``key``: asn or domain)."""
    return values.join(bridge.select(key, "org_id", "reg_order").distinct(), key)


def families_of_asn(orgs: DataFrame) -> DataFrame:
    """asn and the registrable names of all its organisations' domains."""
    rows = orgs.select(F.explode("mapped.asn" if "mapped" in orgs.columns else "asns").alias("asn"), families(F.col("domains")).alias("families"))
    return rows.groupBy("asn").agg(F.array_distinct(F.flatten(F.collect_list("families"))).alias("families"))


def same_family(pairs: DataFrame, orgs: DataFrame, a: str = "asn_lo", b: str = "asn_hi") -> DataFrame:
    """``pairs`` with same_family: whether organisations of the two ASNs share a registrable name."""
    fam = families_of_asn(orgs)
    out = pairs.join(fam.select(F.col("asn").alias(a), F.col("families").alias("_fa")), a, "left").join(fam.select(F.col("asn").alias(b), F.col("families").alias("_fb")), b, "left")
    return out.withColumn("same_family", F.coalesce(F.arrays_overlap("_fa", "_fb"), F.lit(False))).drop("_fa", "_fb")


def is_subject(count, rule: SubjectRule):
    return count.isNull() | count.between(rule.min_prefixes, rule.max_prefixes)


def subjects(bridge: DataFrame, glue: DataFrame, counts: DataFrame | None = None, rule: SubjectRule | None = None, by: list[str] | None = None) -> DataFrame:
    """``by`` and asn: the watched ASNs. A prefix count of ``counts`` (``by``, asn, n) goes before an organisation's hint; an ASN with neither is watched."""
    rule, by = rule or SubjectRule(), by or []
    rows = bridge.select("asn", "hint").distinct()
    if rule.exclude_glue:
        rows = rows.join(glue, "asn", "left_anti")
    if counts is None:
        return rows.where(is_subject(F.col("hint"), rule)).select("asn").distinct()
    if by:
        days = counts.agg(F.collect_set(F.struct(*by)).alias("days")).scalar()  # the compared days, a short list
        rows = rows.select("asn", "hint", F.inline(days))
    rows = rows.join(counts, [*by, "asn"], "left")
    return rows.where(is_subject(F.coalesce("n", "hint"), rule)).select(*by, "asn").distinct()


def focus(snapshot: DataFrame, asns: DataFrame) -> DataFrame:
    """The rows of a snapshot whose origin is among ``asns`` (asn)."""
    return snapshot.join(asns.select(F.col("asn").alias("origin_asn")).distinct(), "origin_asn", "left_semi")


def asn_union(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, [t.select(F.col("asn").cast("long").alias("asn")) for t in tables]).distinct()


def leasing(spark, extra: tuple[int, ...] = ()) -> DataFrame:
    return spark.createDataFrame([(a,) for a in sorted({*LEASING, *extra})], "asn bigint")


def with_primary(rows: DataFrame, primaries: DataFrame, asn: str, org: str, domains: str) -> DataFrame:
    """``rows`` with the organisation (or null) and domains (or none) of the ASN in a column."""
    found = primaries.select(F.col("asn").alias(asn), F.col("org_id").alias(org), F.col("domains").alias(domains))
    return rows.join(found, asn, "left").withColumn(domains, F.coalesce(domains, F.array().cast("array<string>")))


def roll_up(nets: DataFrame, orgs: DataFrame, glue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A registry's networks (org_id, asn, website) and organisations (id, name, website) as organisations, and one row of counts of those left out.

    An organisation has its networks' ASNs but for glue; one without any is left out.
    """
    from ..functions.domains import of_website, with_ascii_names

    flagged = nets.where("asn > 0").join(glue.withColumn("g", F.lit(True)), "asn", "left")
    sites = nets.select("org_id", of_website(F.col("website")).alias("d")).union(orgs.select(F.col("id").alias("org_id"), of_website(F.col("website")).alias("d")))
    sites = with_ascii_names(sites.where("d IS NOT NULL"), "d").where("d IS NOT NULL").groupBy("org_id").agg(F.sort_array(F.collect_set("d")).alias("domains"))
    nets_of = nets.select("org_id").distinct().join(flagged.groupBy("org_id").agg(
        F.sort_array(F.collect_set(F.when(F.col("g").isNull(), F.col("asn")))).alias("asns"), F.coalesce(F.bool_or("g"), F.lit(False)).alias("any_glue")), "org_id", "left")
    empty = F.coalesce(F.size("asns"), F.lit(0)) <= 0
    skipped = nets_of.where(empty).agg(F.count_if(F.coalesce("any_glue", F.lit(False))).alias("skipped_glue"), F.count_if(~F.coalesce("any_glue", F.lit(False))).alias("skipped_heuristic"))
    out = nets_of.where(~empty).join(orgs.select(F.col("id").alias("org_id"), "name"), "org_id", "left").join(sites, "org_id", "left")
    number = F.col("org_id").cast("string")
    out = out.select(
        F.concat(F.lit("pdb:"), number).alias("org_id"), F.coalesce("name", F.concat(F.lit("peeringdb-org-"), number)).alias("name"), "asns",
        F.coalesce("domains", F.array().cast("array<string>")).alias("domains"), F.lit(None).cast("long").alias("prefix_count_hint"),
        F.concat(F.lit("peeringdb_org:"), number).alias("external_id"), F.col("org_id").cast("long").alias("reg_order"),
    )
    return out, skipped


def watched_lines(lines: list[str]) -> list[tuple[str, str]]:
    """Domain and first label of each line of a watchlist that has one."""
    out = []
    for line in lines:
        domain = line.strip().lower().lstrip(".")
        while domain.startswith("*."):
            domain = domain[2:].lstrip(".")
        if domain.split(".")[0] and not domain.startswith("#"):
            out.append((domain, domain.split(".")[0]))
    return out


class Watchlist:
    """Lines in order, and an automaton that finds the labels of all of them in a text at once.

    ``exact``: the lines that are organisations' ids; they belong to that organisation alone.
    """

    def __init__(self, lines: list[tuple[str, str]], exact: set[str]):
        self.lines, self.exact = lines, exact
        self.automaton = None

    def ready(self) -> Watchlist:
        if self.automaton is None:
            import ahocorasick

            by_label: dict[str, list[int]] = {}
            self.by_id = {}
            for i, (domain, label) in enumerate(self.lines):
                if domain in self.exact:
                    self.by_id.setdefault(domain, []).append(i)
                else:
                    by_label.setdefault(label, []).append(i)
            self.automaton = ahocorasick.Automaton()
            for label, places in by_label.items():
                self.automaton.add_word(label, places)
            if by_label:
                self.automaton.make_automaton()
        return self

    def __getstate__(self):
        return {"lines": self.lines, "exact": self.exact, "automaton": None}

    def found(self, text: str) -> set[int]:
        """The lines whose label a text holds."""
        return {i for _, places in self.automaton.iter(text) for i in places} if len(self.automaton) else set()

    def added(self, org_id: str, name: str, domains: list[str]) -> list[str]:
        """The domains after all lines, one after another: a domain that a line adds can hold the label of a later one."""
        out, have = list(domains), set(domains)
        todo = {i for text in (org_id, name, *domains) for i in self.found(text or "")} | set(self.by_id.get(org_id, ()))
        heap = sorted(todo)
        while heap:
            i = heapq.heappop(heap)
            domain = self.lines[i][0]
            if domain in have:
                continue
            out.append(domain)
            have.add(domain)
            for j in self.found(domain):
                if j > i and j not in todo:
                    todo.add(j)
                    heapq.heappush(heap, j)
        return out


def enrich(orgs: DataFrame, lines: list[str]) -> DataFrame:
    """Domains of a watchlist added to the organisations they belong to, line after line, as an added domain can match a later line.

    A line belongs to the organisation whose id it is, else to all whose id, name or domains hold its first label. No line
    needs another organisation: the watchlist (a short text) goes to each task, which looks for all labels in one pass.
    """
    watched = watched_lines(lines)
    if not watched:
        return orgs
    ids = {r.org_id for r in orgs.where(F.col("org_id").isin(sorted({d for d, _ in watched}))).select("org_id").distinct().collect()}  # at most a row a line
    watchlist = Watchlist(watched, ids)

    def run(org_id: pd.Series, name: pd.Series, domains: pd.Series) -> pd.Series:
        own = watchlist.ready()
        return pd.Series([None if d is None else own.added(i, n, list(d)) for i, n, d in zip(org_id, name, domains)])

    return orgs.withColumn("domains", F.pandas_udf(run, "array<string>")("org_id", F.lower("name"), "domains"))


def unattributed(org: str):
    return ~present(F.col(org))

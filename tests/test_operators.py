import datetime
import random

import pytest
from pyspark.sql import functions as F

from pathlight.config import SparseConfig, SubjectRule
from pathlight.functions import domains as dom
from pathlight.functions.shared import numbered
from pathlight.operators import attribution, diff, evals, features, rib, routes, signals, store
from pathlight.schemas import CASE, EVENT, FEATURE, ORG, STATE

DAY = datetime.date(2026, 9, 13)


def ts(day, hour=0):
    return datetime.datetime(2026, 9, 1, hour) + datetime.timedelta(days=day - 1)


def orgs(spark, *records):
    return spark.createDataFrame([(i, i, list(a), list(d), None, None, k) for k, (i, a, d) in enumerate(records)], ORG)


def glue(spark, *asns):
    return spark.createDataFrame([(a,) for a in asns], "asn bigint")


def snapshot(spark, *observed):
    return spark.createDataFrame([(p, o, path, path[-2] if len(path) > 1 else None, DAY, datetime.datetime(2026, 9, 13)) for p, o, path in observed],
                                 "prefix string, origin_asn bigint, as_path array<bigint>, upstream_asn bigint, day date, as_of timestamp")


def event(kind, at, a, b, prefix=None, org_a=None, org_b=None, detail=""):
    return (kind, at, org_a, org_b, a, b, [], [], prefix, detail)


def test_rib_last_write_and_longest_match(spark, rows):
    kind = "seq bigint, prefix string, peer_asn bigint, withdraw boolean, origin_asn bigint, as_path array<bigint>"
    updates = [(1, "10.0.0.0/16", 1, False, 65000, [1, 65000]), (2, "10.0.1.0/24", 1, False, 65000, [1, 65000]), (3, "10.0.1.0/24", 1, True, None, [])]
    address = spark.createDataFrame([("10.0.1.5",), ("9.9.9.9",)], "address string")
    both, last = rib.materialize(spark.createDataFrame(updates[:2], kind)), rib.materialize(spark.createDataFrame(updates, kind))
    assert tuple(rib.counts(both).first()) == (2, 2) and tuple(rib.counts(last).first()) == (1, 1)
    assert rows(rib.longest_match(both, address)) == [("10.0.1.5", "10.0.1.0/24"), ("9.9.9.9", None)]
    assert rows(rib.longest_match(last, address)) == [("10.0.1.5", "10.0.0.0/16"), ("9.9.9.9", None)]


def test_longest_match_v6(spark, rows):
    table = spark.createDataFrame([("2001:db8::/32",), ("2001:db8:1::/48",), ("::/0",)], "prefix string")
    asked = spark.createDataFrame([("2001:db8:1::5",), ("2001:db8:2::5",), ("fe80::1",), ("1.1.1.1",)], "address string")
    assert dict(rows(rib.longest_match(table, asked))) == {"2001:db8:1::5": "2001:db8:1::/48", "2001:db8:2::5": "2001:db8::/32", "fe80::1": "::/0", "1.1.1.1": None}


def test_interning(spark, rows):
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, [1, 2, 3]), (3, [1, 2, 4])], "seq bigint, as_path array<bigint>")
    assert rows(rib.intern(df).select("id", "as_path")) == [(0, [1, 2, 3]), (1, [1, 2, 4])]


def test_best_route_then_origin(spark, rows):
    df = spark.createDataFrame([("p", 2, 7, [1, 7]), ("p", 1, None, [1, 7, 7]), ("q", 5, 8, [4, 8]), ("q", 3, 9, [6, 9])], "prefix string, peer_asn bigint, origin_asn bigint, as_path array<bigint>")
    assert rows(rib.collapse(df)) == [("q", 9, [6, 9], 6)]


def test_move(spark, rows):
    before, after = snapshot(spark, ("203.0.113.0/24", 65000, [1, 65000])), snapshot(spark, ("203.0.113.0/24", 65001, [1, 65001]))
    got = diff.diff(before, after, orgs(spark, ("acme", [65000], []), ("beta", [65001], [])), glue(spark)).where("kind = 'prefix_move'")
    assert rows(got.select("asn_a", "asn_b", "org_a", "org_b", "prefix", "detail")) == [(65000, 65001, "acme", "beta", "203.0.113.0/24", "origin 65000 -> 65001")]


def test_all_kinds(spark, rows):
    before = snapshot(spark, ("198.51.100.0/24", 65000, [3356, 65000]))
    after = snapshot(spark, ("198.51.100.0/24", 65000, [1, 65001, 65000]), *((f"198.51.100.{i}/32", 65000, [65001, 65000]) for i in range(10)))
    got = rows(diff.diff(before, after, orgs(spark, ("a", [65000], []), ("b", [65001], [])), glue(spark, 3356)).select("kind", "asn_a", "asn_b", "detail"))
    assert ("new_adj", 65000, 65001, "new subject adjacency 65000-65001") in got
    assert ("footprint_step", 65000, None, "prefix_count 1 -> 11 (delta 10)") in got
    assert ("upstream_converge", 65000, 65001, "origin 65000 gained upstream 65001") in got
    assert len(got) == 3


def test_glue_is_context(spark):
    before, after = snapshot(spark, ("203.0.113.0/24", 15169, [15169])), snapshot(spark, ("203.0.113.0/24", 65000, [1, 65000]))
    assert diff.diff(before, after, orgs(spark, ("a", [65000], [])), glue(spark, 15169)).where("kind = 'prefix_move'").isEmpty()


def test_unmapped_upstream_counts(spark, rows):
    before, after = snapshot(spark, ("p", 65000, [5, 65000])), snapshot(spark, ("p", 65000, [6, 65000]))
    got = diff.diff(before, after, orgs(spark, ("a", [65000], [])), glue(spark)).select("kind", "asn_a", "asn_b", "org_b")
    assert rows(got) == [("upstream_converge", 65000, 6, None)]


def test_pair_features(spark):
    events = [event("prefix_move", ts(1), 65000, 65001, "p1", "a", None), event("prefix_move", ts(1), 65000, 65001, "p2"), event("prefix_move", ts(3), 65001, 65000, "p3", "b", "x"), event("footprint_step", ts(2), 65000, None), event("new_adj", ts(2), 5, 5)]
    got = features.pair_features(spark.createDataFrame(events, EVENT)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.asn_lo, r.asn_hi, r.prefixes_moved, r.prefix_move_days, r.persistence_days, r.score, r.org_lo, r.org_hi) == (65000, 65001, 3, 2, 2, 42, "a", "b")


def test_sparse(spark):
    events = [event("prefix_move", ts(1), 65000, 65001, "p"), event("prefix_move", ts(1, 5), 65001, 65000, "p"), event("prefix_move", ts(1), 65002, 65003, "q"), event("new_adj", ts(1), 1, 2)]
    df = spark.createDataFrame(events, EVENT)
    assert features.sparse(df).count() == 2
    assert features.sparse(df, SparseConfig(keep_new_adj=True)).count() == 3


def feature(lo, hi, a, b, day=1, score=5, **more):
    base = dict(asn_lo=lo, asn_hi=hi, org_lo=a, org_hi=b, prefix_move_days=1, prefixes_moved=2, new_adj_days=0, upstream_converge_days=0, first_seen=ts(day), last_seen=ts(day), persistence_days=0, score=score)
    return tuple((base | more).values())


def test_clean_order(spark):
    table = orgs(spark, ("a", [1, 2, 10], ["x.fam.com"]), ("b", [3, 11], ["fam.com"]), ("c", [4], ["other.org"]))
    rows = [feature(1, 2, "a", "a"), feature(1, 834, "a", "z"), feature(1, 4, "a", "c"), feature(1, 9, "a", None), feature(1, 8, "a", " "), feature(1, 3, "a", "b"), feature(4, 7, "c", "c")]
    got = features.clean_reason(spark.createDataFrame(rows, FEATURE), table, glue(spark, 7), attribution.leasing(spark))
    assert {(r.asn_lo, r.asn_hi): r.drop_reason for r in got.collect()} == {(1, 2): "same_org", (1, 834): "leasing", (1, 4): None, (1, 9): "unattributed", (1, 8): "unattributed", (1, 3): "same_family", (4, 7): "glue"}


def test_state_adds_and_prunes(spark):
    day = F.lit(ts(1))
    new = spark.createDataFrame([feature(1, 2, "a", None, score=9)], FEATURE)
    state = signals.merge_state(spark.createDataFrame([], STATE), new, day)
    again = signals.merge_state(state, new, day).first()
    assert (again.prefixes_moved, again.score) == (4, 9)
    assert signals.merge_state(state, new.limit(0), F.lit(ts(1) + datetime.timedelta(days=31))).isEmpty()
    assert signals.merge_state(state, new.limit(0), F.lit(ts(1) + datetime.timedelta(days=30))).count() == 1


def test_subject_bounds(spark, rows):
    counts = spark.createDataFrame([(65000, 50000), (65002, 3)], "asn bigint, n bigint")
    table = attribution.org_asn(orgs(spark, ("a", [65000, 65002, 65003], []), ("g", [15169], [])))
    assert rows(attribution.subjects(table, glue(spark, 15169), counts)) == [(65002,), (65003,)]
    assert rows(attribution.subjects(table, glue(spark, 15169), counts, SubjectRule(exclude_glue=False))) == [(15169,), (65002,), (65003,)]


def test_primary_is_first_registered(spark, rows):
    table = orgs(spark, ("z", [5], ["z.com"]), ("a", [5, 6], ["a.com"]))
    bridge = attribution.org_asn(table)
    assert rows(attribution.primary(bridge, table).select("asn", "org_id")) == [(5, "z"), (6, "a")]
    assert rows(attribution.all_orgs(bridge, "asn", spark.createDataFrame([(5,)], "asn bigint")).select("org_id")) == [("a",), ("z",)]


def test_overlay_last_body_wins(spark):
    got = attribution.overlay(orgs(spark, ("a", [1], ["old.com"])), orgs(spark, ("a", [2], ["new.com"]), ("b", [3], [])))
    assert {r.org_id: r.asns for r in got.collect()} == {"a": [2], "b": [3]}


def test_overlay_takes_nothing_over(spark, rows):
    """The first source's organisation stays the primary one, whatever places later sources give; a record that is replaced keeps its old networks."""
    base = orgs(spark, ("x", [9], []), ("a", [1, 2], ["a.com"])).withColumn("reg_order", F.col("reg_order") + 5)
    both = attribution.overlay(base, orgs(spark, ("b", [1, 3], ["b.com"]), ("a", [2], ["new.com"])))
    got = attribution.primary(attribution.org_asn(both), both).select("asn", "org_id", F.array_join("domains", ","))
    assert rows(got) == [(1, "a", "new.com"), (2, "a", "new.com"), (3, "b", "b.com"), (9, "x", "")]
    assert {r.org_id: r.asns for r in both.collect()} == {"a": [2], "b": [1, 3], "x": [9]}


def test_a_long_watchlist_is_a_fold(spark):
    """Lines found by one automaton give what looking at one line after another gives."""
    rng = random.Random(3)
    stock = ["acme", "cloud", "net", "zeta", "beta", "alpha", "io", "x"]
    name = lambda: "-".join(rng.choice(stock) for _ in range(rng.randint(1, 2)))
    orgs = [(f"{name()}{i % 7}" if i % 5 else None, name().upper() if i % 3 else None, [], [f"{name()}.{rng.choice(['com', 'net'])}" for _ in range(i % 3)] if i % 11 else None, None, None, i) for i in range(300)]
    lines = [f"{name()}.{rng.choice(['org', 'com'])}" for _ in range(150)] + ["# no", "", "acme3", "*.zeta5", "cloud1"]
    watched, ids = attribution.watched_lines(lines), {o[0] for o in orgs}

    def fold(org_id, name, domains):
        for domain, label in watched:
            own = org_id == domain if domain in ids else any(label in (t or "") for t in (org_id, (name or "").lower(), *domains))
            if own and domain not in domains:
                domains = [*domains, domain]
        return domains

    got = {r.reg_order: r.domains for r in attribution.enrich(spark.createDataFrame(orgs, ORG), lines).collect()}
    assert got == {o[6]: None if o[3] is None else fold(o[0], o[1], o[3]) for o in orgs}
    assert sum(len(d or []) for d in got.values()) > 1000


def test_international_names(spark, rows):
    pairs = {"bücher.example": "xn--bcher-kva.example", "münchen.de": "xn--mnchen-3ya.de", "例え.テスト": "xn--r8jz45g.xn--zckzah", "faß.de": "xn--fa-hia.de", "BÜCHER.example": "xn--bcher-kva.example", "a。b": "a.b", "plain.example": "plain.example", "ｗｉｄｅ.example": "wide.example", "ü" * 70 + ".example": None}
    df = spark.createDataFrame([(k, i) for i, k in enumerate(pairs)], "d string, i int")
    assert dict(rows(dom.with_ascii_names(df, "d").select("i", "d"))) == dict(enumerate(pairs.values()))


def test_enrichment_depends_on_order(spark):
    table = orgs(spark, ("acme", [1], []), ("zeta", [2], []))
    got = {r.org_id: r.domains for r in attribution.enrich(table, ["# no", "acme-cloud.com", "acme.net", "*.Zeta.org"]).collect()}
    assert got == {"acme": ["acme.net"], "zeta": ["zeta.org"]}


def test_registry_roll_up(spark, rows):
    nets = spark.createDataFrame([(1, 65000, None), (1, 15169, None), (2, 65001, "https://B.example/x"), (3, 15169, None), (4, 0, None)], "org_id bigint, asn bigint, website string")
    meta = spark.createDataFrame([(2, "Beta", "www.beta.com")], "id bigint, name string, website string")
    built, skipped = attribution.roll_up(nets, meta, glue(spark, 15169))
    assert rows(built.select("org_id", "name", "asns", "domains")) == [("pdb:1", "peeringdb-org-1", [65000], []), ("pdb:2", "Beta", [65001], ["b.example", "www.beta.com"])]
    assert tuple(skipped.first()) == (1, 1)


def test_origin_validation(spark):
    roas = spark.createDataFrame([("1.0.0.0/16", 24, 13335), ("2001:db8::/32", 48, 5)], "prefix string, max_length int, origin_asn bigint")
    asked = [("1.0.1.0/24", 13335, "valid"), ("1.0.1.0/24", 64500, "invalid"), ("1.0.1.0/25", 13335, "invalid"), ("8.8.8.0/24", 1, "unknown"), ("1.0.1.0/24", None, "unknown"), ("2001:db8:1::/48", 5, "valid"), ("2001:db8:1::/64", 5, "invalid"), ("0.0.0.0/0", 1, "unknown")]
    got = routes.validate_origins(spark.createDataFrame(asked, "prefix string, origin_asn bigint, want string"), roas)
    assert [r for r in got.collect() if r.want != r.rpki_state] == [] and got.count() == len(asked)


@pytest.mark.parametrize(
    "path, verdict", [([300, 200, 100, 400], "leak_suspected"), ([7], "too_short"), ([7, 7], "too_short"), ([200, 100], "valley_free"), ([200, 9], "incomplete"), ([300, 200, 100, 400, 9], "leak_suspected"), ([200, 100, 100], "valley_free"), ([6, 5, 1], "leak_suspected")]
)
def test_paths(spark, path, verdict):
    relations = spark.createDataFrame([(100, 200, -1), (300, 200, -1), (100, 400, -1), (300, 500, -1), (1, 5, 0), (5, 6, 0)], "a bigint, b bigint, rel int")
    got = routes.path_verdicts(spark.createDataFrame([(path,)], "as_path array<bigint>"), relations).first()
    assert got.path_verdict == verdict


def test_alerts(spark, rows):
    df = spark.createDataFrame([(1, "valid", "valley_free"), (2, "invalid", "valley_free"), (3, "invalid", "leak_suspected"), (4, "unknown", "leak_suspected")], "k int, rpki_state string, path_verdict string")
    assert rows(routes.alerts(df).select("k", "reason")) == [(2, "rpki_invalid"), (3, "rpki_invalid,valley_free_violation"), (4, "valley_free_violation")]


def case(spark, *cells):
    return spark.createDataFrame([cells], CASE)


def test_eval_event(spark):
    epoch = datetime.datetime(1970, 1, 1)
    at = lambda s: epoch + datetime.timedelta(seconds=s)
    events = spark.createDataFrame([event("prefix_move", at(100), 65000, 65001, "p", detail="d")], EVENT)
    got = evals.eval_events(case(spark, "c", "prefix_move", 65001, 65000, None, at(50), at(150), True, ""), events).first()
    assert (got.hit, got.passed, got.matched_detail) == (True, True, "d")
    assert not evals.eval_events(case(spark, "c", "prefix_move", 65001, None, None, at(50), at(150), True, ""), events).first().hit
    assert not evals.eval_events(case(spark, "c", "prefix_move", 65000, None, "q", at(50), at(150), True, ""), events).first().hit


def test_days(spark, rows):
    assert [r.day.day for r in evals.sample_days(spark, "2026-09-01", "2026-09-10", 4).orderBy("day").collect()] == [1, 5, 9, 10]
    have = spark.createDataFrame([(datetime.date(2026, 9, d),) for d in (2, 4)], "day date")
    got = evals.nearest_days(spark.createDataFrame([(datetime.date(2026, 9, d),) for d in (3, 9)], "day date"), have)
    assert [(r.day.day, r.used and r.used.day) for r in got.orderBy("day").collect()] == [(3, 2), (9, None)]


def test_upsert_and_outbox(spark, rows):
    kind = "org_id string, name string"
    old = spark.createDataFrame([("a", "A", None), ("b", "B", None), ("c", "C", 3)], kind + ", deleted_at bigint")
    got = store.upsert(old, spark.createDataFrame([("a", "A"), ("c", "C"), ("d", "D")], kind), ("org_id",), F.lit(9))
    assert rows(got) == [("a", "A", None, None), ("b", "B", 9, "U"), ("c", "C", None, "U"), ("d", "D", None, "I")]
    assert [(r.seq, r.op) for r in store.outbox(got, "orgs", ("org_id",), F.lit("t"), 4).orderBy("seq").collect()] == [(5, "U"), (6, "U"), (7, "I")]


def test_table_rules(spark):
    ok = spark.createDataFrame([(1, 2, "network_contact", "2026-01-01T00:00:00Z", "2026-01-01", None, "x")], "asn_a int, asn_b int, kind string, as_of string, as_of_date string, org_a string, org_b string")
    assert store.checked_contacts(ok).count() == 1
    with pytest.raises(Exception, match="asn_a < asn_b"):
        store.checked_contacts(ok.withColumn("asn_b", F.lit(1))).collect()


def test_numbers_over_a_table(spark, rows):
    got = numbered(spark.range(1000).selectExpr("(id * 7919) % 1000 AS k").repartition(7), "n", "k")
    assert rows(got) == [(k, k) for k in range(1000)] or sorted(map(tuple, got.collect())) == [(k, k) for k in range(1000)]

"""Prefixes that hold others, and dictionaries that outlive a run, against brute force."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from pathlight.functions.ip import WORDS, with_network
from pathlight.operators import commits, containment, interning, rib, routes


@pytest.fixture(scope="module")
def prefixes():
    rng = random.Random(5)
    v4 = [f"{ipaddress.ip_network((rng.getrandbits(32), n), strict=False)}" for n in (0, 1, 4, 8, 8, 12, 16, 16, 20, 24, 24, 32) for _ in range(6)]
    nested = [f"10.{'0.' * k}0/{8 * (k + 1)}" if False else str(ipaddress.ip_network(("10.1.2.3", n), strict=False)) for k, n in enumerate(range(0, 33))]
    v6 = [f"{ipaddress.ip_network((rng.getrandbits(128), n), strict=False)}" for n in (0, 3, 16, 32, 48, 64, 128) for _ in range(4)]
    v6 += [str(ipaddress.ip_network(("2001:db8:1::5", n), strict=False)) for n in range(0, 129, 8)]
    return sorted({*v4, *nested, *v6})


@pytest.fixture
def small_ranges(monkeypatch):
    """Ranges of some rows, so that most prefixes are open where one begins."""
    real = containment.swept
    for module in (containment, routes):
        monkeypatch.setattr(module, "swept", lambda *a: real(*a, rows_a_range=15))


def holds(a, b):
    a, b = ipaddress.ip_network(a), ipaddress.ip_network(b)
    return a.version == b.version and b.subnet_of(a)


def test_longest_match_over_ranges(spark, prefixes, small_ranges):
    rng = random.Random(6)
    asked = [str(ipaddress.IPv4Address(rng.getrandbits(32))) for _ in range(60)] + ["10.1.2.3", "10.1.2.2", "10.0.0.0", "2001:db8:1::5", "2001:db8:1::6", "::", "ffff::1"] + ["bad", None]
    some = [p for p in prefixes if p not in ("0.0.0.0/0", "::/0")]
    for table in (prefixes, some, some[:1]):
        df = spark.createDataFrame([(p,) for p in [*table, "junk"]], "prefix string")
        got = {r.address: r.matched for r in rib.longest_match(df, spark.createDataFrame([(a,) for a in asked], "address string")).collect()}
        for a in asked:
            found = [p for p in table if a not in ("bad", None) and holds(p, str(ipaddress.ip_network(a)))]
            assert got[a] == max(found, key=lambda p: ipaddress.ip_network(p).prefixlen, default=None), a


def test_origins_over_ranges(spark, prefixes, small_ranges):
    rng = random.Random(7)
    roas = [(p, min(ipaddress.ip_network(p).max_prefixlen, ipaddress.ip_network(p).prefixlen + rng.choice((0, 4, 8, 20))), rng.randint(1, 4)) for p in prefixes for _ in range(rng.choice((0, 1, 1, 2)))]
    asked = [(p, o) for p in prefixes for o in (1, 2)] + [("203.0.113.0/24", None), (None, 1), ("junk", 1)]
    got = {(r.prefix, r.origin_asn): r.rpki_state for r in routes.validate_origins(spark.createDataFrame(asked, "prefix string, origin_asn bigint"), spark.createDataFrame(roas, "prefix string, max_length int, origin_asn bigint")).collect()}
    for p, o in asked:
        cover = [] if p in (None, "junk") or o is None else [(m, a) for q, m, a in roas if holds(q, p)]
        want = "unknown" if not cover else "valid" if any(a == o and ipaddress.ip_network(p).prefixlen <= m for m, a in cover) else "invalid"
        assert got[p, o] == want, (p, o)


def test_a_short_prefix_is_no_hot_key(spark):
    """Each range has its own copy of what is open where it begins, and no more."""
    known = with_network(spark.createDataFrame([("0.0.0.0/0",), ("10.0.0.0/8",)], "prefix string"), v6=False).withColumnRenamed("prefix", "text")
    asked = with_network(spark.range(4000).select(F.concat(F.lit("10."), F.shiftright("id", 8), F.lit("."), F.col("id") % 256, F.lit(".0/24")).alias("prefix")), v6=False).withColumnRenamed("prefix", "text")
    got = containment.swept(known, asked, containment.longest, ["a", "o", "m"], 500)
    assert got.where("m = '10.0.0.0/8'").count() == 4000 and set(WORDS) <= set(known.columns)


# Dictionaries


def test_numbers_stay(spark, tmp_path, rows):
    store = commits.Store(spark, f"file://{tmp_path}/d", {"paths": "value string, id bigint"})
    days = [[("b", 1), ("a", 2), ("b", 3), (None, 4), ("c", 2)], [("z", 9), ("a", 7), ("y", 8), ("b", 1)], [("a", 1)], []]
    known = {}
    for n, day in enumerate(days):
        df = spark.createDataFrame(day, "p string, seq bigint")
        step = store.begin()
        got = dict(rows(interning.intern(step, "paths", df, "p", "seq")))
        step.commit()
        for p, _ in sorted({p: s for p, s in sorted(day, key=lambda x: -x[1]) if p}.items(), key=lambda x: (x[1], x[0])):
            known.setdefault(p, len(known))
        assert got == {p: known[p] for p, _ in day if p}
        assert len(store.head().tables["paths"]["folders"]) == min(n + 1, 2)  # nothing new, nothing written
    table = store.read("paths")
    df = spark.createDataFrame([("a", 1), ("nope", 2), (None, 3)], "p string, n int")
    there = interning.ids_of(table, df, "p")
    assert rows(there.select("n", "id")) == [(1, known["a"]), (2, None), (3, None)]
    assert rows(interning.values_of(table, there, value="back").select("n", "back")) == [(1, "a"), (2, None), (3, None)]

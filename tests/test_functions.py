import datetime

import pytest
from pyspark.sql import functions as F

from pathlight.functions import domains, ip, paths, values


def one(spark, column, **cells):
    """A column expression over one row."""
    df = spark.range(1).select(*(F.lit(v).alias(k) if not isinstance(v, list) else (F.array(*map(F.lit, v)) if v else F.array()).cast("array<bigint>").alias(k) for k, v in cells.items()))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "path, origin, upstream",
    [([3356, 65001], 65001, 3356), ([3356, 65001, 65001], 65001, 3356), ([65001], 65001, None), ([9, 65001, 7], 65001, 9), ([1, 2], 5, None), ([], 5, None), ([5, 1, 5, 2], 5, 1)],
)
def test_upstream(spark, path, origin, upstream):
    assert one(spark, paths.upstream_of("p", "o"), p=path, o=origin) == upstream


def test_collapse_and_edges(spark):
    assert one(spark, paths.collapse("p"), p=[1, 1, 2, 2, 1]) == [1, 2, 1]
    assert [tuple(e) for e in one(spark, paths.edges("p"), p=[3, 1, 2])] == [(1, 3), (1, 2)]
    assert one(spark, paths.edges("p"), p=[1]) == []


@pytest.mark.parametrize(
    "text, name",
    [("www.google.com", "google.com"), ("maps.google.co.uk", "google.co.uk"), ("*.*.Google.COM", "google.com"), (" .acme.com ", "acme.com"), ("a.b.example.org", "example.org"), ("", ""), ("localhost", "localhost")],
)
def test_registrable(spark, text, name):
    assert one(spark, domains.registrable(F.col("d")), d=text) == name


@pytest.mark.parametrize(
    "site, host",
    [("https://www.Example.com/path", "www.example.com"), ("cloudflare.com", "cloudflare.com"), ("http://u:p@foo_bar.example.com:80/x", "foo_bar.example.com"), ("", None), ("  ", None), ("https://", None)],
)
def test_website(spark, site, host):
    assert one(spark, domains.of_website(F.col("w")), w=site) == host


def test_shares_family(spark):
    a, b = F.array(F.lit("www.a.com"), F.lit("b.org")), F.array(F.lit("x.b.org"))
    assert one(spark, domains.shares_family(a, b), z=1)
    assert not one(spark, domains.shares_family(F.array(F.lit("")), F.array(F.lit(""))), z=1)


def test_elapsed_is_not_calendar(spark):
    f = lambda t: F.lit(t).cast("timestamp")
    assert one(spark, values.elapsed_days(f("2026-01-01 23:00:00"), f("2026-01-02 01:00:00")), z=1) == 0
    assert one(spark, values.elapsed_days(f("2026-01-01"), f("2026-01-03")), z=1) == 2


@pytest.mark.parametrize("lead, bucket", [(None, "miss"), (366, ">365"), (365, "181-365"), (181, "181-365"), (91, "91-180"), (31, "31-90"), (8, "8-30"), (1, "1-7"), (0, "0"), (-1, "post-announce")])
def test_horizon(spark, lead, bucket):
    assert one(spark, values.horizon_bucket(F.lit(lead).cast("long"), F.lit(True)), z=1) == bucket
    assert one(spark, values.horizon_bucket(F.lit(lead).cast("long"), F.lit(False)), z=1) == "miss"


def test_announce_day(spark):
    end = F.lit("2020-05-05").cast("timestamp")
    assert one(spark, values.announce_day(F.col("n"), end), n="x announce=2020-02-31 announce=2020-03-01") == datetime.date(2020, 3, 1)
    assert one(spark, values.announce_day(F.col("n"), end), n="announce=soon") == datetime.date(2020, 5, 5)


def test_instants(spark):
    assert one(spark, values.utc_iso(values.parse_utc_iso(F.col("t"))), t="2026-08-14T00:30:00Z") == "2026-08-14T00:30:00Z"
    for bad in ("2026-08-14T00:30:00+00:00", "2026-08-14T00:30:00.123Z"):
        with pytest.raises(Exception, match="not a UTC instant"):
            one(spark, values.parse_utc_iso(F.col("t")), t=bad)
    assert str(one(spark, values.parse_instant(F.col("t")), t="86400")) == "1970-01-02 00:00:00"


def test_lists(spark):
    assert one(spark, values.join_list(F.col("a")), a=[]) == ""
    assert one(spark, values.split_list(F.col("t"), "bigint"), t="1,2") == [1, 2]
    assert one(spark, values.split_list(F.col("t")), t="") == []


def test_networks(spark, rows):
    df = spark.createDataFrame([("10.1.2.3/8",), ("1.2.3.4",), ("300.1.1.1/8",), ("2001:db8::1/32",), ("x",), (None,)], "prefix string")
    got = {r.prefix: tuple(r)[1:] for r in ip.with_network(df).collect()}
    assert got["10.1.2.3/8"] == (4, 8, 10 << 24, 0, 0, 0)
    assert got["1.2.3.4"] == (4, 32, 0x01020304, 0, 0, 0)
    assert got["2001:db8::1/32"] == (6, 32, 0x20010DB8, 0, 0, 0)
    assert got["300.1.1.1/8"] == got["x"] == got[None] == (None,) * 6
    two = ip.with_network(spark.createDataFrame([("10.0.0.0/8",)], "prefix string")).selectExpr("struct(family, plen, w0, w1, w2, w3) AS big").crossJoin(
        ip.with_network(spark.createDataFrame([("10.9.0.0/16",), ("11.0.0.0/16",)], "prefix string")).selectExpr("prefix", "struct(family, plen, w0, w1, w2, w3) AS small"))
    assert rows(two.select("prefix", ip.covers("big", "small"))) == [("10.9.0.0/16", True), ("11.0.0.0/16", False)]

import datetime
import gzip
import json
import struct

import pytest
from pyspark.sql import functions as F

from pathlight.operators import rib
from pathlight.plans import jobs
from pathlight.schemas import CASE, ELEMENT, FEATURE, ORG
from pathlight.sources import manifest, registry_crawl, snapshots, tables
from pathlight.sources.mrt import MrtSource
from pathlight.streaming import routes as stream

UTC = datetime.UTC


def record(kind, sub, body, ts=100):
    return struct.pack(">IHHI", ts, kind, sub, len(body)) + body


def attribute(kind, value):
    return bytes([0x40, kind, len(value)]) + value


def path_value(*asns, kind=2):
    return bytes([kind, len(asns)]) + struct.pack(f">{len(asns)}I", *asns)


def dump():
    peer = bytes([2]) + b"\0" * 4 + b"\1\1\1\1" + struct.pack(">I", 4200000000)
    index = b"\0" * 4 + struct.pack(">H", 0) + struct.pack(">H", 1) + peer
    attrs = attribute(2, path_value(4200000000, 65000))
    entry = struct.pack(">HIH", 0, 90, len(attrs)) + attrs
    v4 = struct.pack(">I", 0) + bytes([16, 10, 0]) + struct.pack(">H", 1) + entry
    v6 = struct.pack(">I", 1) + bytes([32, 0x20, 1, 0x0D, 0xB8]) + struct.pack(">H", 1) + entry
    attrs = attribute(2, path_value(7, 8) + path_value(9, kind=1))
    update = struct.pack(">H", 3) + bytes([16, 10, 0]) + struct.pack(">H", len(attrs)) + attrs + bytes([24, 10, 0, 1])
    message = b"\xff" * 16 + struct.pack(">HB", 19 + len(update), 2) + update
    bgp = struct.pack(">IIHH", 7, 1, 0, 1) + b"\0" * 8 + message
    return record(13, 1, index) + record(13, 2, v4) + record(13, 4, v6) + record(16, 4, bgp, 200)


def test_mrt(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(dump()))
    spark.dataSource.register(MrtSource)
    df = spark.read.format("mrt").load(str(tmp_path))
    got = [tuple(r)[1:7] for r in df.orderBy("seq").collect()]
    assert got == [(90.0, "A", "10.0.0.0/16", 4200000000, [4200000000, 65000], [65000]), (90.0, "A", "2001:db8::/32", 4200000000, [4200000000, 65000], [65000]), (200.0, "W", "10.0.0.0/16", 7, [], []), (200.0, "A", "10.0.1.0/24", 7, [], [9])]
    assert spark.read.format("mrt").option("elem_type", "W").load(str(tmp_path)).count() == 1
    assert {(r.prefix, r.origin_asn) for r in rib.materialize(rib.announcements(df)).collect()} == {("10.0.0.0/16", 65000), ("2001:db8::/32", 65000), ("10.0.1.0/24", 9)}


def test_unread_records_fail(spark, tmp_path):
    (tmp_path / "a").write_bytes(dump() + record(13, 8, b"\0" * 20))
    spark.dataSource.register(MrtSource)
    with pytest.raises(Exception, match="subtype 8"):
        spark.read.format("mrt").load(str(tmp_path)).collect()
    assert spark.read.format("mrt").option("skip_unknown", "true").load(str(tmp_path)).count() == 4


def test_ingest_and_snapshot(spark, tmp_path, rows):
    """A table and updates of a manifest; updates alone where there is no table; modes and caps."""
    whole = dump()
    at = whole.index(record(16, 4, b"")[4:8], 12) - 4
    (tmp_path / "rib").write_bytes(whole[:at])
    (tmp_path / "upd").write_bytes(whole[at:])
    t = lambda h: datetime.datetime(2026, 1, 1, h)
    files = spark.createDataFrame([(t(0), t(0), "c", "rib", str(tmp_path / "rib")), (t(1), t(1), "c", "updates", str(tmp_path / "upd")), (t(20), t(20), "d", "updates", str(tmp_path / "upd"))], manifest.SCHEMA)
    kinds = lambda df: [(r.elem_type, r.prefix) for r in df.orderBy("seq").collect()]
    table, changes = [("A", "10.0.0.0/16"), ("A", "2001:db8::/32")], [("W", "10.0.0.0/16"), ("A", "10.0.1.0/24")]
    assert kinds(jobs.ingest(spark, files, "2026-01-01", "2026-01-02", "c")) == table + changes
    assert kinds(jobs.ingest(spark, files, "2026-01-01", "2026-01-02", "c", max_updates=1)) == table + changes[:1]
    assert kinds(jobs.ingest(spark, files, "2026-01-01", "2026-01-02", "c", skip_rib=True)) == changes
    assert kinds(jobs.ingest(spark, files, "2026-01-01", "2026-01-02", "d")) == changes
    with pytest.raises(manifest.NoFiles):
        jobs.ingest(spark, files, "2027-01-01", "2027-01-02")
    window = datetime.datetime(2026, 1, 1, tzinfo=UTC), datetime.datetime(2026, 1, 2, tzinfo=UTC)
    assert rows(jobs.build_snapshot(spark, files, *window, "c").select("prefix", "source")) == [("10.0.0.0/16", "rib"), ("2001:db8::/32", "rib")]
    assert rows(jobs.build_snapshot(spark, files, *window, "c", mode="updates").select("prefix", "origin_asn", "source")) == [("10.0.0.0/16", 65000, "updates"), ("10.0.1.0/24", 9, "updates"), ("2001:db8::/32", 65000, "updates")]


def test_manifest(spark):
    t = lambda h: datetime.datetime(2026, 1, 1, h)
    m = spark.createDataFrame([(t(0), t(0), "rrc", "rib", "r0"), (t(8), t(8), "rrc", "rib", "r8"), (t(1), t(1), "rrc", "updates", "u1"), (t(9), t(9), "x", "updates", "u9")], manifest.SCHEMA)
    assert manifest.baseline(m, "2026-01-01", "2026-01-02").url == "r8"
    assert [r.url for r in manifest.plan(m, "2026-01-01", "2026-01-02").collect()] == ["r8", "u1", "u9"]
    with pytest.raises(manifest.NoFiles):
        manifest.updates(m, "2027-01-01", "2027-01-02")
    with pytest.raises(manifest.NoFiles):
        manifest.baseline(m, "2026-01-01", "2026-01-02", "none")


def test_text_tables(spark, tmp_path, rows):
    (tmp_path / "glue").write_text("# c\n15169\n\n 174 \n15169\n")
    assert rows(tables.read_glue(spark, str(tmp_path / "glue"))) == [(15169,), (174,)]
    assert tables.read_glue(spark).count() == 49
    (tmp_path / "bad").write_text("AS1\n")
    with pytest.raises(Exception, match="not an ASN"):
        tables.read_glue(spark, str(tmp_path / "bad")).collect()
    (tmp_path / "roas").write_text("URI,ASN,IP Prefix,Max Length,Not Before,Not After\nrsync://x,AS13335,1.1.1.0/24,24,a,b\nrsync://y,15169,8.8.8.0/24,24,a,b\nshort,1\nz,#c,1.0.0.0/8,8,a,b\n")
    assert rows(tables.read_roas(spark, str(tmp_path / "roas"))) == [("1.1.1.0/24", 24, 13335), ("8.8.8.0/24", 24, 15169)]
    for bad in ("1,999.1.1.1/24,24", "1,1.0.0.0/40,24", "1,1.2.3.4.5/8,24", "1,1.1.1.0,24", "1,01.1.1.0/24,24", "1,zz::/32,40", "1,2001:db8::/129,40", "1,1.1.1.0/24,256", "1,1.1.1.0/24,x", "4294967296,1.1.1.0/24,24"):
        (tmp_path / "strict").write_text(f"ASN,IP Prefix,Max Length\n5,2001:db8::/32,48\n{bad}\n")
        with pytest.raises(Exception, match="not an? (prefix|length|ASN)"):
            tables.read_roas(spark, str(tmp_path / "strict")).collect()
    (tmp_path / "plain").write_text("13335,1.1.1.0/24,24\n")
    assert rows(tables.read_roas(spark, str(tmp_path / "plain"))) == [("1.1.1.0/24", 24, 13335)]
    with pytest.raises(ValueError):
        tables.roa_columns(["AS13335", "1.1.1.0/24", "24"])
    (tmp_path / "rel").write_text("# c\n1|2|-1\n3|4|0\n")
    assert rows(tables.read_relations(spark, str(tmp_path / "rel"))) == [(1, 2, -1), (3, 4, 0)]
    (tmp_path / "cases").write_text('# none\n\n{"id":"c","expect_kind":"new_adj","asn_a":1,"window_start":"2026-01-01T00:00:00Z","window_end":"2026-01-02T00:00:00Z"}\n')
    c = tables.read_cases(spark, str(tmp_path / "cases")).first()
    assert (c.id, c.asn_b, c.expect_hit, c.notes) == ("c", None, True, "")


def test_org_json(spark, tmp_path):
    record = {"org_id": "a", "name": "A", "asns": [1]}
    for name, body in (("bare", [record]), ("wrapped", {"source": "s", "orgs": [record]})):
        (tmp_path / name).write_text(json.dumps(body))
        got = tables.read_orgs(spark, str(tmp_path / name)).first()
        assert (got.org_id, got.asns, got.domains, got.reg_order) == ("a", [1], [], 0)
    tables.write_orgs(tables.read_orgs(spark, str(tmp_path / "bare")), str(tmp_path / "out"), "s", "t")
    assert tables.read_orgs(spark, str(tmp_path / "out")).first().org_id == "a"


def test_json_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, "a", None, 1, 2, 0, 0, datetime.datetime(2026, 1, 1), datetime.datetime(2026, 1, 2), 1, 5)], FEATURE)
    tables.write_lines(df, str(tmp_path / "f"))
    assert tables.read_features(spark, str(tmp_path / "f")).collect() == df.collect()
    assert '"org_hi":null' in spark.read.text(str(tmp_path / "f")).first()[0]


def test_registry_pages(spark, tmp_path):
    for name, rows in (("net-0", [{"id": 1, "org_id": 1, "asn": 65000}, {"id": 2, "org_id": 2, "asn": 15169}]), ("net-1", [{"id": 3, "org_id": 3, "asn": 65001}]), ("org-0", [{"id": 1, "name": "One"}])):
        (tmp_path / f"{name}.json").write_text(json.dumps({"data": rows}))
    spark.dataSource.register(registry_crawl.RegistrySource)
    read = spark.read.format("registry").option("base", str(tmp_path)).option("page", "2")
    assert {r.asn for r in read.load().collect()} == {65000, 15169, 65001}
    assert read.option("max_pages", "1").load().count() == 2
    assert spark.read.format("registry").option("base", str(tmp_path)).option("what", "org").option("ids", "1,2").load().first().name == "One"
    assert [registry_crawl.wait_after(*a) for a in ((1, None), (9, None), (1, "7"))] == [2, 64, 7]


def test_crawl(spark, tmp_path):
    """Networks, then the organisations that they name, then the map."""
    for name, rows in (("net-0", [{"id": 1, "org_id": 7, "asn": 65000}, {"id": 2, "org_id": 8, "asn": 65001}]), ("org-0", [{"id": 7, "name": "Seven", "website": "seven.example"}])):
        (tmp_path / f"{name}.json").write_text(json.dumps({"data": rows}))
    work, at = jobs.Work(spark, f"file://{tmp_path}/work"), datetime.datetime(2026, 9, 10, tzinfo=UTC)
    assert jobs.crawl_org_map(work, str(tmp_path), tables.read_glue(spark), at, at) == 2
    assert {(r.org_id, r.name, r.reg_order) for r in work.live_orgs().collect()} == {("pdb:7", "Seven", 7), ("pdb:8", "peeringdb-org-8", 8)}


DAYS = datetime.date(2026, 9, 12), datetime.date(2026, 9, 13)


def day_snapshot(spark, day, origin):
    rows = [(f"203.0.113.{i}/32", origin, 15169, [15169, origin], datetime.datetime.combine(day, datetime.time()), None, None, "test", day) for i in range(3)]
    return spark.createDataFrame(rows, jobs.snapshots.SNAPSHOT)


@pytest.fixture
def work(spark, tmp_path):
    work = jobs.Work(spark, f"file://{tmp_path}/work")
    nets = spark.createDataFrame([(1, 65000, None), (2, 65001, None)], "org_id bigint, asn bigint, website string")
    meta = spark.createDataFrame([(1, "acme", "acme.com"), (2, "beta", "beta.org")], "id bigint, name string, website string")
    at = datetime.datetime(2026, 9, 10, tzinfo=UTC)
    assert jobs.build_org_map(work, nets, meta, tables.read_glue(spark), at, at) == 2
    return work


def test_daily(spark, work, tmp_path):
    glue = spark.createDataFrame([(15169,)], "asn bigint")
    now = datetime.datetime(2026, 9, 13, 2, tzinfo=UTC)
    assert jobs.run_daily(work, DAYS[0], day_snapshot(spark, DAYS[0], 65000), glue, now) == "snapshot_only"
    options = jobs.DailyOptions(signals_file=f"{tmp_path}/signals", inbox=f"{tmp_path}/inbox", focus_subjects=True)
    assert jobs.run_daily(work, DAYS[1], day_snapshot(spark, DAYS[1], 65001), glue, now, options) == "ok"
    rows = work.read("network_contact").where("deleted_at IS NULL").collect()
    assert [(r.asn_a, r.asn_b, r.prefixes_moved, r.prefix_move_days, r.persistence_days, r.score, r.domains_a) for r in rows] == [(65000, 65001, 3, 1, 0, 35, "acme.com")]
    assert tables.read_signals(spark, f"{tmp_path}/signals").count() == 1
    assert {(r.as_of_date, r.status) for r in work.read("signal_runs").collect()} == {("2026-09-12", "snapshot_only"), ("2026-09-13", "ok")}
    box = [(r.tbl, r.op) for r in work.read("outbox").orderBy("seq").collect()]
    assert box == [("orgs", "I"), ("orgs", "I"), ("org_map_runs", "I"), ("signal_runs", "I"), ("network_contact", "I"), ("signal_runs", "I")]
    # a rerun of the day adds to the state and so changes the signal
    assert jobs.run_daily(work, DAYS[1], None, glue, now, options) == "ok"
    assert work.read("network_contact").first().prefixes_moved == 6
    assert [(r.tbl, r.op) for r in work.read("outbox").orderBy("seq").collect()][6:] == [("network_contact", "U")]


def test_stale_map_is_refused(spark, work):
    now = datetime.datetime(2026, 11, 1, tzinfo=UTC)
    with pytest.raises(ValueError, match="days old"):
        jobs.run_daily(work, DAYS[0], day_snapshot(spark, DAYS[0], 65000), spark.createDataFrame([], "asn bigint"), now)
    assert work.read("signal_runs").first().status == "error"


def test_orgs_come_and_go(spark, work):
    meta = spark.createDataFrame([(1, "acme", "acme.com")], "id bigint, name string, website string")
    at = datetime.datetime(2026, 9, 11, tzinfo=UTC)
    assert jobs.build_org_map(work, spark.createDataFrame([(1, 65000, None)], "org_id bigint, asn bigint, website string"), meta, tables.read_glue(spark), at, at) == 1
    assert {r.org_id: r.deleted_at is None for r in work.read("orgs").collect()} == {"pdb:1": True, "pdb:2": False}
    with pytest.raises(ValueError, match="empty"):
        jobs.build_org_map(work, spark.createDataFrame([], "org_id bigint, asn bigint, website string"), meta, tables.read_glue(spark), at, at)


def test_retention_is_strict(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    for d in (10, 12, 14):
        snapshots.write(day_snapshot(spark, datetime.date(2026, 8, d), 65000), path)
    assert snapshots.prior(spark, path, datetime.date(2026, 8, 14)) == datetime.date(2026, 8, 12)
    assert snapshots.prune(spark, path, datetime.date(2026, 8, 14), 2) == [datetime.date(2026, 8, 10)]
    assert {r.day.day for r in snapshots.read(spark, path).select("day").distinct().collect()} == {12, 14}


def test_backtest_and_evaluate(spark, tmp_path):
    stored = day_snapshot(spark, DAYS[0], 65000).unionByName(day_snapshot(spark, datetime.date(2026, 9, 15), 65001))
    orgs = spark.createDataFrame([("a", "a", [65000], [], None, None, 0), ("b", "b", [65001], [], None, None, 1)], ORG)
    cases = spark.createDataFrame([("c", "prefix_move", 65001, 65000, None, datetime.datetime(2026, 9, 1), datetime.datetime(2026, 9, 20), True, "announce=2026-09-25")], CASE)
    out = jobs.backtest(spark, stored, "2026-09-12", "2026-09-16", 4, orgs, spark.createDataFrame([(15169,)], "asn bigint"), cases)
    assert out["report"].first().feature_passed == 1
    r = out["lead_lag"].first()
    assert (r.lead_days, r.horizon_bucket, r.pair_contact_hit) == (10, "8-30", True)
    assert jobs.evaluate(cases, out["events"], out["features"], f"{tmp_path}/r") == 0
    # a day that is fetched for the run is kept for the origins in focus alone; results are written
    extra = day_snapshot(spark, datetime.date(2026, 9, 15), 65001).unionByName(day_snapshot(spark, datetime.date(2026, 9, 15), 7).withColumn("prefix", F.lit("9.9.9.0/24")))
    again = jobs.backtest(spark, day_snapshot(spark, DAYS[0], 65000), "2026-09-12", "2026-09-16", 4, orgs, spark.createDataFrame([(15169,)], "asn bigint"), cases, fetched=extra, output=f"{tmp_path}/out")
    key = lambda df: sorted((r.kind, r.asn_a, r.asn_b or 0, r.prefix or "") for r in df.collect())
    assert key(again["events"]) == key(out["events"])
    assert tables.read_events(spark, f"{tmp_path}/out/events").count() == out["events"].count() and json.loads(spark.read.text(f"{tmp_path}/out/report").first()[0])["feature_passed"] == 1
    assert jobs.evaluate(cases.limit(0), out["events"]) == 0
    with pytest.raises(ValueError):
        jobs.evaluate(cases)


ELEMENTS = [(1, 10.0, "A", "10.0.0.0/16", 7, [7, 65000], [65000]), (2, 11.0, "W", "10.0.0.0/16", 7, [], []), (3, 12.5, "A", "1.0.1.0/25", 7, [7, 65001], [65001])]


def test_analyze(spark, tmp_path):
    roas = spark.createDataFrame([("1.0.0.0/16", 24, 65001)], "prefix string, max_length int, origin_asn bigint")
    df = spark.createDataFrame(ELEMENTS, ELEMENT)
    assert jobs.analyze(df, roas, spark.createDataFrame([], "a bigint, b bigint, rel int"), f"{tmp_path}/alerts", "rrc") == 1
    assert json.loads(spark.read.text(f"{tmp_path}/alerts").first()[0])["reason"] == "rpki_invalid"


def test_streams_match_batch(spark, tmp_path):
    df = spark.createDataFrame(ELEMENTS, ELEMENT)
    for i in range(3):
        df.where(F.col("seq") == i + 1).coalesce(1).write.json(f"{tmp_path}/in", mode="append")
    source = spark.readStream.schema(ELEMENT).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    q = stream.rib_changes(rib.announcements(source)).writeStream.outputMode("complete").format("memory").queryName("rib_now").start()
    q.processAllAvailable()
    q.stop()
    live = {(r.prefix, r.peer_asn, r.origin_asn) for r in spark.table("rib_now").where("NOT withdraw").collect()}
    assert live == {(r.prefix, r.peer_asn, r.origin_asn) for r in rib.materialize(rib.announcements(df)).collect()}
    roas = spark.createDataFrame([("1.0.0.0/16", 24, 65001)], "prefix string, max_length int, origin_asn bigint")
    q = stream.write_alerts(source, roas, spark.createDataFrame([], "a bigint, b bigint, rel int"), f"{tmp_path}/alerts", f"{tmp_path}/cp")
    q.processAllAvailable()
    q.stop()
    assert spark.read.json(f"{tmp_path}/alerts").count() == 1

"""Commits of several tables, leases, migrations, and the streams."""

import datetime
import gzip
import json

import pytest
from pyspark.sql import functions as F
from test_sources_and_jobs import DAYS, day_snapshot, dump, work  # noqa: F401  a fixture

from pathlight.operators import commits, rib, signals, store
from pathlight.plans import jobs
from pathlight.schemas import FEATURE, STATE
from pathlight.sources import mrt, tables
from pathlight.streaming import routes as stream

UTC = datetime.UTC
SCHEMAS = {"a": "k bigint, x string", "b": "n bigint"}


@pytest.fixture
def opened(spark, tmp_path):
    return commits.Store(spark, f"file://{tmp_path}/store", SCHEMAS)


def changed(spark, *keys):
    return spark.createDataFrame([(k, "I") for k in keys], "k bigint, op string")


def test_tables_change_together(spark, opened, rows):
    assert opened.head() == commits.Record() and opened.read("a").isEmpty() and opened.changes().isEmpty()
    step = opened.begin()
    step.put("a", spark.createDataFrame([(1, "x")], SCHEMAS["a"]))
    step.put("b", spark.range(3).toDF("n"))
    step.log(changed(spark, 5, 4), "a", ("k",), F.lit("t1"))
    assert opened.read("a").isEmpty() and step.read("b").count() == 3  # seen by the transaction alone
    assert step.commit() == 1 and rows(opened.read("a")) == [(1, "x")] and opened.read("b").count() == 3
    step = opened.begin()
    step.log(changed(spark, 6), "b", ("k",), F.lit("t2"))
    step.log(changed(spark), "b", ("k",), F.lit("t2"))
    step.tag("b", "batch7")
    assert step.commit() == 2 and opened.head().tags == {"b": "batch7"}
    assert [(r.seq, r.tbl, r.key) for r in opened.changes().orderBy("seq").collect()] == [(1, "a", '{"k":4}'), (2, "a", '{"k":5}'), (3, "b", '{"k":6}')]
    assert opened.read("b", opened.record(1)).count() == 3


def test_the_second_writer_is_refused(spark, opened, rows):
    first, second = opened.begin(), opened.begin()
    for n, step in enumerate((first, second)):
        step.put("b", spark.createDataFrame([(n,)], "n bigint"))
        step.log(changed(spark, n), "b", ("k",), F.lit("t"))
    assert first.commit() == 1
    with pytest.raises(commits.Conflict):
        second.commit()
    assert rows(opened.read("b")) == [(0,)] and [(r.seq, r.key) for r in opened.changes().collect()] == [(1, '{"k":0}')]
    again = opened.begin()  # from the new state
    again.log(changed(spark, 1), "b", ("k",), F.lit("t"))
    assert again.commit() == 2 and opened.changes().agg(F.max("seq")).first()[0] == 2


def test_vacuum_leaves_what_readers_may_follow(spark, opened):
    for n in range(4):
        step = opened.begin()
        step.put("b", spark.range(n + 1).toDF("n"))
        step.commit()
    assert opened.vacuum() == []  # too young: another writer's unfinished work may be among them
    assert len(opened.vacuum(keep=2, age_seconds=-5)) == 2
    assert opened.read("b").count() == 4 and opened.read("b", opened.record(3)).count() == 3


def test_a_record_is_created_once(spark, tmp_path):
    path = f"file://{tmp_path}/c/000.json"
    commits.create_once(spark, path, '{"a": "é"}')
    with pytest.raises(FileExistsError):
        commits.create_once(spark, path, "{}")
    assert commits.read_json(spark, path) == {"a": "é"}


def test_migrations(spark, tmp_path, rows):
    path, first = f"file://{tmp_path}/store", commits.Migration(1, "baseline", lambda step: None)
    old = commits.Store(spark, path, {"a": "k bigint"}, [first])
    step = old.begin()
    step.put("a", spark.range(2).toDF("k"))
    step.commit()
    new = commits.Store(spark, path, SCHEMAS)
    assert rows(new.read("a")) == [(0, None), (1, None)]  # an old form is read as the new one
    fill = commits.Migration(2, "fill x", lambda step: step.put("a", step.read("a").withColumn("x", F.lit("y"))))
    assert new.migrate([first, fill]) == 1 and new.migrate([first, fill]) == 0 and rows(new.read("a")) == [(0, "y"), (1, "y")]
    assert [m[:2] for m in new.head().migrations] == [[1, "baseline"], [2, "fill x"]]
    for bad, why in (([first, commits.Migration(3, "gap", fill.apply)], "without gaps"), ([first], "aren't known"), ([first, commits.Migration(2, "other", fill.apply)], "aren't known"), ([fill, first], "without gaps")):
        with pytest.raises(ValueError, match=why):
            commits.Store(spark, path, SCHEMAS, bad)

    def breaks(step):
        step.put("b", step.store.spark.range(1).toDF("n"))
        raise OSError("broken")

    with pytest.raises(OSError):
        new.migrate([first, fill, commits.Migration(3, "breaks", breaks)])
    assert new.read("b").isEmpty() and len(new.head().migrations) == 2
    assert new.migrate([first, fill, commits.Migration(3, "breaks", lambda step: None)]) == 1


def test_lease(spark, tmp_path, opened):
    now = [100.0]
    one, two = (commits.Lease(spark, f"file://{tmp_path}/lease", o, 10, lambda: now[0]) for o in ("one", "two"))
    with one:
        with pytest.raises(commits.Busy):
            two.take()
        step = opened.begin(one)
        now[0] = 109.0
        assert step.commit() == 1  # prolongs it
        now[0] = 115.0
        with pytest.raises(commits.Busy):
            two.take()
        now[0] = 130.0  # the owner is taken for dead
        two.take()
        with pytest.raises(commits.Conflict):
            opened.begin(one).commit()
    with pytest.raises(commits.Busy):
        one.take()
    two.give_back()
    assert one.take().token == two.last()[0]


STEPS = ["replace:pair_state", "put:network_contact", "log", "put:signal_runs", "commit"]


@pytest.mark.parametrize("broken", STEPS)
def test_a_daily_run_is_whole_or_not_there(spark, work, monkeypatch, broken):  # noqa: F811
    """A break after any step of the commit leaves nothing; the rerun gives each change once and adds the state once."""
    glue, now = spark.createDataFrame([(15169,)], "asn bigint"), datetime.datetime(2026, 9, 13, 2, tzinfo=UTC)
    assert jobs.run_daily(work, DAYS[0], day_snapshot(spark, DAYS[0], 65000), glue, now) == "snapshot_only"
    before = work.store.head()
    real = {n: getattr(commits.Transaction, n) for n in ("put", "replace", "log", "commit")}

    def breaking(name):
        def run(self, *args):
            if name == "commit" and broken == "commit":
                raise commits.Conflict("lost")
            out = real[name](self, *args)
            if broken in (name, f"{name}:{args[0] if args else ''}"):
                raise commits.Conflict("lost")  # as where a process ends: not even the error is noted
            return out

        return run

    for name in real:
        monkeypatch.setattr(commits.Transaction, name, breaking(name))
    with pytest.raises(commits.Conflict):
        jobs.run_daily(work, DAYS[1], day_snapshot(spark, DAYS[1], 65001), glue, now)
    for name, f in real.items():
        monkeypatch.setattr(commits.Transaction, name, f)
    assert work.store.head() == before and work.read("pair_state").isEmpty()
    assert jobs.run_daily(work, DAYS[1], None, glue, now) == "ok"
    assert [r.prefixes_moved for r in work.read("pair_state").collect()] == [3]
    assert [(r.seq, r.tbl) for r in work.read("outbox").orderBy("seq").collect()][-2:] == [(5, "network_contact"), (6, "signal_runs")]


def test_two_daily_runs_at_once(spark, work):  # noqa: F811
    with work.lease("daily"), pytest.raises(commits.Busy):
        jobs.run_daily(work, DAYS[0], day_snapshot(spark, DAYS[0], 65000), spark.createDataFrame([], "asn bigint"), datetime.datetime(2026, 9, 13, tzinfo=UTC))
    assert work.read("signal_runs").isEmpty()


def test_dated_maps(spark, tmp_path):
    orgs = lambda n: spark.createDataFrame([(f"o{n}", "O", [n], [], None, None, 0)], jobs.tables.ORG)
    for n in range(6):
        tables.write_dated_orgs(orgs(n), f"{tmp_path}/maps", "registry", datetime.datetime(2026, 1, n + 1))
    assert sorted(store.folders(spark, f"{tmp_path}/maps")) == ["current", *(f"org-map-2026010{n}T000000Z" for n in range(3, 7))]
    assert tables.current_orgs(spark, f"{tmp_path}/maps").first().org_id == "o5"


def test_pair_state_of_a_stream(spark, tmp_path):
    store_ = commits.Store(spark, f"file://{tmp_path}/store", {"pair_state": STATE})
    day = datetime.datetime(2026, 1, 1)
    spark.createDataFrame([(1, 2, None, None, 1, 3, 0, 0, day, day, 0, 5)], FEATURE).coalesce(1).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(FEATURE).parquet(f"{tmp_path}/in")
    for _ in range(2):  # started again without its checkpoint, the batch has the same number
        q = stream.keep_state(source, store_, f"{tmp_path}/cp{_}")
        q.processAllAvailable()
        q.stop()
        assert [(r.asn_lo, r.prefixes_moved) for r in store_.read("pair_state").collect()] == [(1, 3)]


def test_a_day_rewrites_the_buckets_it_touches(spark, tmp_path, rows):
    store_ = commits.Store(spark, f"file://{tmp_path}/store", {"pair_state": STATE})
    day = lambda n: datetime.datetime(2026, 1, 1) + datetime.timedelta(days=n)
    whole, folders = spark.createDataFrame([], STATE), []
    for n, pairs in ((0, range(200)), (1, [3, 4]), (2, [4, 500]), (40, [7]), (41, [])):
        df = spark.createDataFrame([(p, p + 1, None, None, 1, 2, 0, 0, day(n), day(n), 0, p) for p in pairs], FEATURE)
        step = store_.begin()
        got = signals.merge_touched(step, df, F.lit(day(n)), 30, 16)
        step.commit()
        whole = jobs.materialize(signals.merge_state(whole, df, F.lit(day(n)), 30), "whole")
        now = store_.read("pair_state")
        assert rows(now) == rows(whole.select(now.columns)) and {r.asn_lo for r in got.collect()} >= set(pairs)
        folders.append(dict(store_.head().tables["pair_state"]["buckets"]))
    changed = [sum(b.get(k) != a.get(k) for k in {*a, *b}) for a, b in zip(folders, folders[1:])]
    assert len(folders[0]) == 16 and 1 <= changed[0] <= 2 and 1 <= changed[1] <= 2 and changed[2] >= 15 and changed[3] == 0
    assert [r.asn_lo for r in whole.collect()] == [7]


# Streams of routes


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROW = "seq bigint, prefix string, peer_asn bigint, withdraw boolean, as_path array<bigint>, origin_asn bigint, ts double"


def test_withdrawn_routes_leave_the_state(spark, tmp_path):
    batches = [
        [(1, "10.0.0.0/8", 7, False, [7, 9], 9, 1.0), (2, "10.0.0.0/8", 8, False, [8, 9], 9, 1.0), (3, "11.0.0.0/8", 7, False, [7], 7, 1.0), (4, "11.0.0.0/8", 7, True, [], None, 1.5)],
        [(6, "10.0.0.0/8", 7, True, [], None, 2.0), (5, "10.0.0.0/8", 7, False, [7, 5], 5, 1.9), (7, "10.0.0.0/8", 8, True, [], None, 2.0), (8, "12.0.0.0/8", 7, False, [7, 4], 4, 2.0)],
        [(3, "12.0.0.0/8", 7, True, [], None, 1.0), (9, "10.0.0.0/8", 8, False, [8, 3], 3, 3.0)],
    ]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        (tmp_path / "in").mkdir()
        source = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
        q = stream.live_routes(source).writeStream.outputMode("update").format("memory").queryName("live").option("checkpointLocation", f"{tmp_path}/cp").start()
        sizes = []
        for rows_ in batches:
            spark.createDataFrame(rows_, ROW).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
            q.processAllAvailable()
            sizes.append([p["stateOperators"][0]["numRowsTotal"] for p in map(json.loads, (p.json for p in q.recentProgress)) if p["stateOperators"]][-1])
        q.stop()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    changes = spark.table("live")
    latest = changes.groupBy("prefix", "peer_asn").agg(F.max(F.struct("seq", "withdraw", "origin_asn")).alias("r")).where("NOT r.withdraw").select("prefix", "peer_asn", "r.origin_asn")
    every = spark.createDataFrame([r for b in batches for r in b], ROW)
    want = rib.materialize(every).select("prefix", "peer_asn", "origin_asn")
    assert sorted(map(tuple, latest.collect())) == sorted(map(tuple, want.collect())) == [("10.0.0.0/8", 8, 3), ("12.0.0.0/8", 7, 4)]
    assert sizes == [2, 1, 2]


def test_a_late_announcement_meets_the_mark_of_a_withdrawal():
    """With grace, a withdrawal outlives itself; its timer takes it out."""
    import pandas as pd

    class Peers(dict):
        containsKey, getValue, updateValue, iterator = dict.__contains__, dict.__getitem__, dict.__setitem__, dict.items

        def removeKey(self, k):
            del self[k]

    class Handle:
        timers = []

        def getMapState(self, *_):
            return Peers()

        def registerTimer(self, at):
            self.timers.append(at)

    class Now:
        def __init__(self, at):
            self.at = at

        getCurrentProcessingTimeInMs = getExpiryTimeInMs = lambda self: self.at

    own = stream.LiveRoutes(50)
    own.init(Handle())
    columns = [c.split()[0] for c in ROW.split(", ")]
    feed = lambda *rows_: [tuple(x) for df in own.handleInputRows(("p",), iter([pd.DataFrame(rows_, columns=columns)]), Now(1000)) for x in df[["seq", "withdraw"]].itertuples(index=False)]
    assert feed((5, "p", 7, True, [], None, 1.0)) == [(5, True)] and Handle.timers == [1050]
    assert feed((4, "p", 7, False, [7], 7, 0.5)) == []
    assert list(own.handleExpiredTimer(("p",), None, Now(1050))) == [] and not own.peers
    assert feed((6, "p", 7, False, [7], 7, 0.5)) == [(6, False)]


def test_a_stream_of_dumps_reads_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/updates.1.gz").write_bytes(gzip.compress(dump()))
    spark.dataSource.register(mrt.MrtSource)
    roas = spark.createDataFrame([("10.0.0.0/8", 16, 9)], "prefix string, max_length int, origin_asn bigint")
    relations = spark.createDataFrame([], "a bigint, b bigint, rel int")
    alerts = []
    for name in (None, "updates.2.gz", None, "updates.3.gz"):
        if name:
            (tmp_path / f"in/{name}").write_bytes(gzip.compress(dump()))
        source = spark.readStream.format("mrt").load(f"{tmp_path}/in")
        stream.write_alerts(source, roas, relations, f"{tmp_path}/alerts", f"{tmp_path}/cp", once=True).awaitTermination()
        alerts.append(spark.read.json(f"{tmp_path}/alerts").count())
    batch = stream.alerts_of(spark.read.format("mrt").load(f"{tmp_path}/in"), roas, relations)
    assert alerts == [2, 4, 4, 6] and batch.count() == 6
    key = lambda df: sorted((r.prefix, str(r.origin_asn), r.reason) for r in df.select("prefix", "origin_asn", "reason").collect())
    assert key(spark.read.json(f"{tmp_path}/alerts")) == key(batch)


def test_dumps_decode_what_is_asked_for(spark, tmp_path, monkeypatch, capsys):
    for n in range(2):
        (tmp_path / f"{n}").write_bytes(dump())
    every = mrt.load(spark, str(tmp_path))
    whole = lambda df: {tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in df.collect()}
    want = whole(every)
    assert len(want) == 8
    some = every.where("elem_type = 'A' AND peer_asn IN (7, 8) AND prefix LIKE '10%'")
    some.explain("formatted")
    assert "PushedFilters: [EqualTo(elem_type,A), In(peer_asn, [7,8])]" in capsys.readouterr().out
    assert whole(some) == {r for r in want if r[2] == "A" and r[4] in (7, 8) and r[3].startswith("10")}
    narrow = mrt.load(spark, str(tmp_path), columns="prefix string, seq bigint")
    assert whole(narrow) == {(r[3], r[0]) for r in want}
    decoded = []
    monkeypatch.setattr(mrt, "as_path", lambda *a: decoded.append(a) or ([], []))
    import io

    assert [r[0] for r in mrt.elements(io.BytesIO(dump()), wanted=mrt.Wanted(frozenset("W")))] == [2] and len(decoded) == 1
    assert [r[0] for r in mrt.elements(io.BytesIO(dump()), wanted=mrt.Wanted(paths=False))] == [0, 1, 2, 3] and len(decoded) == 1


# Archives


def test_archives(spark, tmp_path):
    from pathlight.sources import archive, manifest

    names = {
        "rv/route-views2/bgpdata/2026.01/RIBS": ["rib.20260131.2200.bz2", "rib.20260131.2200.bz2.md5"], "rv/route-views2/bgpdata/2026.02/RIBS": ["rib.20260201.0000.bz2", "rib.20260203.0000.bz2"],
        "rv/route-views2/bgpdata/2026.02/UPDATES": ["updates.20260201.0015.bz2"], "rv/other/bgpdata/2026.02/UPDATES": ["updates.20260201.0030.bz2"], "ris/rrc00/2026.02": ["bview.20260201.0000.gz", "updates.20260201.0005.gz"],
    }
    for folder, files in names.items():
        (tmp_path / folder).mkdir(parents=True)
        for f in files:
            (tmp_path / folder / f).write_bytes(dump())
    spark.dataSource.register(archive.ArchiveSource)
    read = spark.read.format("archive").options(start="2026-01-31T00:00:00", end="2026-02-02T00:00:00")
    rv = read.option("base", f"{tmp_path}/rv").load()
    assert {(r.collector, r.data_type, r.url.rsplit("/", 1)[1]) for r in rv.collect()} == {("route-views2", "rib", "rib.20260131.2200.bz2"), ("route-views2", "rib", "rib.20260201.0000.bz2"), ("route-views2", "updates", "updates.20260201.0015.bz2"), ("other", "updates", "updates.20260201.0030.bz2")}
    assert rv.rdd.getNumPartitions() == 8 and read.options(base=f"{tmp_path}/rv", collectors="route-views2", data_type="rib").load().rdd.getNumPartitions() == 2
    ris = spark.read.format("archive").options(base=f"{tmp_path}/ris", layout="ris", start="2026-02-01T00:00:00", end="2026-02-01T23:00:00").load()
    assert manifest.baseline(ris, "2026-02-01", "2026-02-02").url.endswith("bview.20260201.0000.gz") and ris.count() == 2
    assert archive.months(datetime.datetime(2025, 12, 5), datetime.datetime(2026, 2, 1)) == ["2025.12", "2026.01", "2026.02"]


def plain_files(spark, tmp_path):
    whole = dump()
    from test_sources_and_jobs import record

    at = whole.index(record(16, 4, b"")[4:8], 12) - 4
    (tmp_path / "rib").write_bytes(whole[:at])
    (tmp_path / "upd").write_bytes(whole[at:])
    t = lambda d, h=0, m=0: datetime.datetime(2026, 1, d, h, m)
    return spark.createDataFrame([(t(2), t(2), "c", "rib", str(tmp_path / "rib")), (t(6, 0, 30), t(6), "c", "rib", str(tmp_path / "rib")), (t(9, 2), t(9), "c", "rib", "late"), (t(6, 1), t(6), "c", "updates", str(tmp_path / "upd"))], jobs.manifest.SCHEMA)


def test_missing_days_are_fetched(spark, tmp_path, rows):
    files = plain_files(spark, tmp_path)
    wanted = lambda *d: spark.createDataFrame([(datetime.date(2026, 1, x),) for x in d], "day date")
    got = jobs.fetch_days(spark, files, wanted(3, 5), "c")
    stamp = lambda d: datetime.datetime(2026, 1, d, 0, 30)
    assert {(r.day.day, r.prefix, r.as_of) for r in got.collect()} == {(d, p, stamp(u)) for d, u in ((3, 2), (5, 6)) for p in ("10.0.0.0/16", "2001:db8::/32")}
    assert jobs.fetch_days(spark, files, wanted(3), "c", spark.createDataFrame([(1,)], "asn bigint")).isEmpty()
    with pytest.raises(jobs.manifest.NoFiles, match="2026-01-12"):  # the table of the 9th is too late in its day
        jobs.fetch_days(spark, files, wanted(3, 12), "c")
    assert jobs.fetch_days(spark, files, wanted(), "c").isEmpty()
    orgs = spark.createDataFrame([], jobs.tables.ORG)
    out = jobs.backtest(spark, spark.createDataFrame([], jobs.SNAPSHOT), "2026-01-02", "2026-01-06", 4, orgs, tables.read_glue(spark), files=files, collector="c")
    assert out["events"].isEmpty()  # two equal days


def test_analyze_a_window(spark, tmp_path):
    files = plain_files(spark, tmp_path)
    roas, none = spark.createDataFrame([("10.0.0.0/8", 16, 9)], "prefix string, max_length int, origin_asn bigint"), spark.createDataFrame([], "a bigint, b bigint, rel int")
    run = lambda **o: jobs.analyze_window(spark, files, "2026-01-06", "2026-01-07", roas, none, f"{tmp_path}/alerts", "c", **o)
    assert run() == {"alerts": 1, "prefixes": 3, "routes": 3}  # the table raises none
    assert run(skip_rib=True) == {"alerts": 1, "prefixes": 1, "routes": 1}
    assert run(max_updates=1) == {"alerts": 0, "prefixes": 2, "routes": 2}

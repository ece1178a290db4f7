"""The jobs: build the organisation map, take a snapshot, compare two, run a day, backtest, evaluate, analyze updates."""

from __future__ import annotations

import datetime
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DiffConfig, SparseConfig
from ..functions.shared import materialize
from ..functions.values import split_list
from ..operators import attribution, commits, diff, evals, features, rib, signals, store
from ..schemas import SNAPSHOT, STATE
from ..sources import manifest, mrt, registry_crawl, snapshots, tables
from ..streaming.routes import alerts_of

UTC = datetime.UTC


#: Steps of the store's form so far.
MIGRATIONS = (commits.Migration(1, "baseline", lambda step: None),)


@dataclass
class Work:
    """A working folder: snapshots by day, and the store's tables, which change together."""

    spark: SparkSession
    path: str

    def __post_init__(self):
        self.snapshots = f"{self.path}/snapshots"
        kinds = {"orgs": store.ORGS, "network_contact": store.CONTACTS, "signal_runs": store.RUNS, "org_map_runs": store.ORG_RUNS, "pair_state": STATE}
        self.store = commits.Store(self.spark, f"{self.path}/store", kinds, MIGRATIONS)

    def read(self, name: str) -> DataFrame:
        return self.store.changes() if name == "outbox" else self.store.read(name)

    def lease(self, job: str, seconds: float = 7200) -> commits.Lease:
        """A lock on a job: one at a time may run."""
        return commits.Lease(self.spark, f"{self.path}/leases/{job}", seconds=seconds)

    def put_run(self, step: commits.Transaction, name: str, row: tuple, now: datetime.datetime) -> None:
        run = self.spark.createDataFrame([row], store.RUNS if name == "signal_runs" else store.ORG_RUNS)
        old = step.read(name)
        changes = store.upsert(old.withColumn("deleted_at", F.lit(None).cast("long")), run, ("as_of_date",), F.lit(0), F.lit(False))
        changes = materialize(changes, "changes")
        step.put(name, store.put_run(old, run))
        step.log(changes, name, ("as_of_date",), F.lit(iso(now)))

    def live_orgs(self, record: commits.Record | None = None) -> DataFrame:
        rows = self.store.read("orgs", record).where("deleted_at IS NULL")
        return rows.select("org_id", "name", split_list(F.col("asns"), "bigint").alias("asns"), split_list(F.col("domains")).alias("domains"), F.lit(None).cast("long").alias("prefix_count_hint"),
                           "external_id", "reg_order")


def iso(at: datetime.datetime) -> str:
    return at.strftime("%Y-%m-%dT%H:%M:%SZ")


def build_org_map(work: Work, nets: DataFrame, orgs: DataFrame, glue: DataFrame, started: datetime.datetime, finished: datetime.datetime, copy: str | None = None, keep: int = 4) -> int:
    """Organisations of a registry's networks into the store, in one commit; those that the crawl lacks are deleted softly. Returns how many live.

    ``copy``: a folder for dated copies of the map, of which the newest ``keep`` stay. Refused while another build runs.
    """
    with work.lease("org-map") as lease:
        built, _ = attribution.roll_up(nets, orgs, glue)
        built = materialize(attribution.normalized(built), "organisations")
        if built.isEmpty():
            raise ValueError("refusing to commit an empty organisation map")
        step = work.store.begin(lease)
        changes = store.upsert(step.read("orgs"), store.org_rows(built), store.ORG_KEY, F.lit(int(finished.timestamp())))
        changes = materialize(changes, "changes")
        step.put("orgs", changes.drop("op"))
        step.log(changes, "orgs", store.ORG_KEY, F.lit(iso(finished)))
        count = changes.where("deleted_at IS NULL").count()
        work.put_run(step, "org_map_runs", (started.date().isoformat(), iso(started), iso(finished), iso(finished), count), finished)
        step.commit()
        work.store.vacuum()
    if copy:
        tables.write_dated_orgs(built, copy, "registry", finished, keep)
    return count


def crawl_org_map(work: Work, base: str, glue: DataFrame, started: datetime.datetime, finished: datetime.datetime, copy: str | None = None, **options) -> int:
    """Crawl a registry, networks first and then the organisations that they name, and build the map of them. Returns how many live.

    The ids go to the second crawl as text: a registry has some ten thousand organisations.
    """
    work.spark.dataSource.register(registry_crawl.RegistrySource)
    read = work.spark.read.format("registry").option("base", base).options(**options)
    nets = materialize(read.option("what", "net").load(), "networks")
    ids = sorted(r.org_id for r in nets.where("org_id IS NOT NULL").select("org_id").distinct().collect())
    orgs = materialize(read.option("what", "org").option("ids", ",".join(map(str, ids))).load(), "organisations")
    return build_org_map(work, nets, orgs, glue, started, finished, copy)


def ingest(spark: SparkSession, files: DataFrame, start: str, end: str, collector: str | None = None, skip_rib: bool = False, max_updates: int | None = None) -> DataFrame:
    """Decoded messages of a manifest's files: the latest table of the window and all updates after it, in the order of ``seq``.

    Without a table, or with ``skip_rib``, updates alone; if there are none either, ``manifest.NoFiles``. ``max_updates``
    caps the messages of update files. What travels through the driver is the list of files.
    """
    try:
        chosen = manifest.updates(files, start, end, collector) if skip_rib else manifest.plan(files, start, end, collector)
    except manifest.NoFiles:
        if skip_rib:
            raise
        chosen = manifest.updates(files, start, end, collector)
    rows = chosen.collect()
    return decoded(spark, [r.url for r in rows], sum(r.data_type == "rib" for r in rows), max_updates)


def decoded(spark: SparkSession, urls: list[str], tables_first: int, max_updates: int | None = None) -> DataFrame:
    """Messages of MRT files in their order, of which the first ``tables_first`` are routing tables."""
    spark.dataSource.register(mrt.MrtSource)
    rows = spark.read.format("mrt").option("paths", json.dumps(urls)).load().drop("file")
    if max_updates is None:
        return rows
    update = F.col("seq") >= tables_first << 40
    return rows.where(~update).unionByName(rib.first_updates(rows.where(update), max_updates))


def build_snapshot(spark: SparkSession, files: DataFrame, start: datetime.datetime, end: datetime.datetime, collector: str | None = None, mode: str = "rib", skip_rib: bool = False, max_updates: int | None = None) -> DataFrame:
    """A snapshot of a window of a manifest. Mode ``rib``: the latest table alone; mode ``updates``: what ``ingest`` gives."""
    if mode == "rib":
        elements = decoded(spark, [manifest.baseline(files, iso(start), iso(end), collector).url], 1)
    elif mode == "updates":
        elements = ingest(spark, files, iso(start), iso(end), collector, skip_rib, max_updates)
    else:
        raise ValueError(f"unknown mode {mode}")
    return take_snapshot(elements, end, start, collector).withColumn("source", F.lit(mode))


def take_snapshot(elements: DataFrame, as_of: datetime.datetime, start: datetime.datetime | None = None, collector: str | None = None, max_updates: int | None = None) -> DataFrame:
    """A snapshot of decoded messages: tables and updates together, in the order of ``seq``. ``max_updates`` caps the messages first."""
    rows = rib.first_updates(rib.announcements(elements), max_updates)
    out = rib.collapse(rib.materialize(rows.drop("ts")))
    stamp = lambda t: F.lit(None if t is None else iso(t)).cast("timestamp")
    return out.withColumns({"as_of": stamp(as_of), "ts_start": stamp(start), "collector": F.lit(collector).cast("string"), "source": F.lit("mrt"), "day": F.lit(as_of.date())})


def compare(before: DataFrame, after: DataFrame, orgs: DataFrame, glue: DataFrame, config: DiffConfig | None = None, watchlist: list[str] | None = None) -> DataFrame:
    """Events between two snapshots. ``watchlist``: domains that are first added to the organisations they belong to."""
    orgs = attribution.enrich(orgs, watchlist) if watchlist else orgs
    day = after.agg(F.max("day")).scalar()
    return diff.diff(before.withColumn("day", day), after, orgs, glue, config)


@dataclass(frozen=True)
class DailyOptions:
    focus_subjects: bool = False
    focus_asns: tuple[int, ...] = ()
    full: bool = False
    clean: bool = True
    leasing: tuple[int, ...] = ()
    max_age_days: float = 14
    retain_snapshots: int = 7
    retain_pairs: int = 30
    signals_file: str | None = None
    inbox: str | None = None
    diff: DiffConfig = field(default_factory=DiffConfig)
    sparse: SparseConfig = field(default_factory=SparseConfig)


def run_daily(work: Work, day: datetime.date, today: DataFrame | None, glue: DataFrame, now: datetime.datetime, options: DailyOptions | None = None, overlays: tuple[DataFrame, ...] = ()) -> str:
    """One day: the snapshot is stored and compared with the latest stored before it. Returns the run's status.

    ``today``: the day's snapshot, if it isn't stored yet. Contacts, pair state, change log and run are one commit: what
    breaks off before it is as if it had not been. An error is noted as a run of status ``error`` and raised. While
    another daily run holds the lease, ``commits.Busy`` is raised and nothing is done.
    """
    options = options or DailyOptions()
    as_of = datetime.datetime.combine(day, datetime.time(), UTC)
    with work.lease("daily") as lease:
        try:
            return _daily(work, lease, day, as_of, today, glue, now, options, overlays)
        except commits.Conflict:  # another owner goes on: nothing of this run is to be seen
            raise
        except Exception as e:
            step = work.store.begin(lease)
            work.put_run(step, "signal_runs", (day.isoformat(), iso(as_of.replace(minute=30)), None, "error", 0, str(e)[:500]), now)
            step.commit()
            raise


def _daily(work, lease, day, as_of, today, glue, now, options, overlays) -> str:
    spark = work.spark
    step = work.store.begin(lease)  # all tables are read as of its beginning
    live = work.live_orgs(step.base)
    store.require_fresh(step.read("org_map_runs"), live.count(), F.lit(iso(now)).cast("timestamp"), options.max_age_days)
    orgs = attribution.overlay(live, *overlays) if overlays else live
    if day not in snapshots.folders(spark, work.snapshots):
        if today is None:
            raise ValueError(f"no snapshot of {day}")
        snapshots.write(today, work.snapshots)
    after = snapshots.read(spark, work.snapshots, day.isoformat())
    focus = None
    if options.focus_subjects or options.focus_asns:
        focus = spark.createDataFrame([(a,) for a in options.focus_asns], "asn bigint")
        if options.focus_subjects:
            focus = attribution.asn_union(focus, attribution.subjects(attribution.org_asn(orgs), glue, rib.prefix_counts(after), options.diff.subjects))
        focus = materialize(focus, "focus")
        # the day is replaced from a written copy: if that breaks off, the copy is still whole
        snapshots.write(materialize(attribution.focus(after, focus), "focused"), work.snapshots)
        after = snapshots.read(spark, work.snapshots, day.isoformat())
    prior = snapshots.prior(spark, work.snapshots, day)
    if prior is None:
        work.put_run(step, "signal_runs", (day.isoformat(), iso(as_of), None, "snapshot_only", 0, None), now)
        step.commit()
        snapshots.prune(spark, work.snapshots, day, options.retain_snapshots)
        return "snapshot_only"
    before = snapshots.read(spark, work.snapshots, prior.isoformat())
    if focus is not None:
        before = attribution.focus(before, focus)
    stamps = [s.agg(F.max("as_of")).first()[0] for s in (before, after)]
    events = compare(before, after, orgs, glue, options.diff)
    if not options.full:
        events = features.sparse(events, options.sparse)
    rows = features.pair_features(events)
    if options.clean:
        rows, _ = features.clean(rows, orgs, glue, attribution.leasing(spark, options.leasing))
    rows = materialize(rows, "pair-features")
    at = F.lit(stamps[1])
    state = signals.merge_touched(step, rows, at, options.retain_pairs)
    primaries = attribution.primary(attribution.org_asn(orgs), orgs)
    out = materialize(signals.build_signals(rows, primaries, at, F.lit(stamps[0]), state), "signals")
    incoming = store.checked_contacts(store.contact_rows(out))
    scope = store.in_scope(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    changes = materialize(store.upsert(step.read("network_contact"), incoming, store.CONTACT_KEY, F.lit(int(now.timestamp())), scope), "changes")
    step.put("network_contact", changes.drop("op"))
    step.log(changes, "network_contact", store.CONTACT_KEY, F.lit(iso(now)))
    work.put_run(step, "signal_runs", (day.isoformat(), iso(as_of), prior.isoformat(), "ok", out.count(), None), now)
    step.commit()
    work.store.vacuum()
    if options.signals_file:
        tables.write_signals(signals.ranked(out), options.signals_file)
    if options.inbox:
        tables.write_signals(out, options.inbox, append=True)
    snapshots.prune(spark, work.snapshots, day, options.retain_snapshots)
    return "ok"


def backtest(spark: SparkSession, stored: DataFrame, start: str, end: str, every: int, orgs: DataFrame, glue: DataFrame, cases: DataFrame | None = None, config: DiffConfig | None = None,
             fetched: DataFrame | None = None, focus_asns: tuple[int, ...] = (), output: str | None = None, files: DataFrame | None = None, collector: str | None = None) -> dict[str, DataFrame]:
    """Events and features of sampled days of ``stored`` snapshots (a missing day is stood in for by a near one), and, with cases, their evaluation.

    ``files``: a manifest from which sampled days that aren't stored are fetched (``fetch_days``); ``fetched``: snapshots
    that were fetched already. Of fetched days the origins in focus are kept: ``focus_asns`` and the cases' ASNs, or all if both are empty. All days are compared in one job. Cases whose window
    misses the sampled span are left out. ``output``: a folder for all results as JSON lines.
    """
    wanted = evals.sample_days(spark, start, end, every)
    if fetched is not None or files is not None:
        explicit = spark.createDataFrame([(a,) for a in focus_asns], "asn bigint")
        focus = materialize(evals.case_focus(cases, explicit) if cases is not None else explicit, "focus")
        kept = None if focus.isEmpty() else focus
        if fetched is not None:
            fetched = fetched.join(stored.select("day").distinct(), "day", "left_anti")
            stored = stored.unionByName(attribution.focus(fetched, kept) if kept else fetched, allowMissingColumns=True)
        if files is not None:
            missing = wanted.join(stored.select("day").distinct(), "day", "left_anti")
            stored = stored.unionByName(materialize(fetch_days(spark, files, missing, collector, kept), "fetched"), allowMissingColumns=True)
    used = evals.nearest_days(wanted, stored.select("day").distinct()).where("used IS NOT NULL")
    planned = stored.withColumnRenamed("day", "used").join(F.broadcast(used), "used").drop("used")
    events = materialize(diff.diff_days(planned, orgs, glue, evals.day_pairs(used.select("day")), config), "events")
    out = {"events": events, "features": features.ranked(features.pair_features(events))}
    if cases is not None:
        inside = cases.where((F.col("window_end") >= F.lit(start).cast("timestamp")) & (F.col("window_start") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")))
        out |= {"event_results": evals.eval_events(inside, events), "feature_results": evals.eval_features(inside, out["features"]), "lead_lag": evals.lead_lag(inside, out["features"], events)}
        out["report"] = evals.report(out["event_results"], out["feature_results"])
    if output:
        for name, rows in out.items():
            tables.write_lines(rows, f"{output}/{name}")
    return out


def fetch_days(spark: SparkSession, files: DataFrame, wanted: DataFrame, collector: str | None = None, focus: DataFrame | None = None) -> DataFrame:
    """Snapshots of the wanted days (day), each from the latest routing table of the day's first half hour.

    A day without one is stood in for by its neighbours in the order of ``evals.OFFSETS``, up to three days off, and is stored
    under its own date; without any, ``manifest.NoFiles``. ``focus``: ASNs (asn) whose prefixes alone are kept. All tables
    are decoded in one job; what travels through the driver is a row a day.
    """
    early = files.where((F.col("data_type") == "rib") & (F.date_format("ts_start", "HH:mm:ss") <= "00:30:00"))
    if collector is not None:
        early = early.where(F.col("collector") == collector)
    tables_of = early.groupBy(F.to_date("ts_start").alias("used")).agg(F.max(F.struct("ts_start", "url")).alias("r"))
    chosen = evals.nearest_days(wanted, tables_of.select(F.col("used").alias("day"))).join(tables_of, "used", "left").select("day", "used", "r.url").orderBy("day").collect()
    if none := [str(r.day) for r in chosen if r.url is None]:
        raise manifest.NoFiles(f"no routing table within three days of {', '.join(none)}")
    if not chosen:
        return spark.createDataFrame([], SNAPSHOT)
    days = spark.createDataFrame([(i, r.day, r.used) for i, r in enumerate(chosen)], "n bigint, day date, used date")
    rows = decoded(spark, [r.url for r in chosen], len(chosen)).withColumn("n", F.shiftright("seq", 40)).join(F.broadcast(days), "n")
    routes = rib.materialize(rib.announcements(rows, "day", "used").drop("ts"), by=["day", "used"])
    best = rib.collapse(routes, ["day", "used"])
    if focus is not None:
        best = attribution.focus(best, focus)
    at = F.to_timestamp("used")
    stamps = {"as_of": at + F.expr("INTERVAL 30 MINUTES"), "ts_start": at, "collector": F.lit(collector).cast("string"), "source": F.lit("rib")}
    return best.withColumns(stamps).select(*(f.split()[0] for f in SNAPSHOT.split(", ")))


def evaluate(cases: DataFrame, events: DataFrame | None = None, pair_features: DataFrame | None = None, output: str | None = None) -> int:
    """Cases against events or features or both; event results go to ``output``. Returns how many cases failed; none given is fine."""
    if events is None and pair_features is None:
        raise ValueError("neither events nor features are given")
    failed = 0
    if events is not None:
        results = evals.eval_events(cases, events)
        if output:
            tables.write_lines(results, output)
        failed += results.where("NOT passed").count()
    if pair_features is not None:
        failed += evals.eval_features(cases, pair_features).where("NOT passed").count()
    return failed


def analyze(updates: DataFrame, roas: DataFrame, relations: DataFrame, output: str, collector: str | None = None, max_updates: int | None = None) -> int:
    """Alerts of decoded updates as JSON lines. Returns how many there are."""
    found = materialize(alerts_of(rib.first_updates(updates, max_updates), roas, relations, collector), "alerts")
    tables.write_lines(found, output)
    return found.count()


def analyze_window(spark: SparkSession, files: DataFrame, start: str, end: str, roas: DataFrame, relations: DataFrame, output: str, collector: str | None = None,
                   skip_rib: bool = False, max_updates: int | None = None) -> dict[str, int]:
    """Alerts of a window of a manifest: its latest routing table, which raises none, and its updates. Returns alerts, prefixes and routes at the end.

    With ``skip_rib``, or where the window has no table, updates alone. ``max_updates`` caps the messages of update files.
    """
    try:
        chosen = manifest.updates(files, start, end, collector) if skip_rib else manifest.plan(files, start, end, collector)
    except manifest.NoFiles:
        if skip_rib:
            raise
        chosen = manifest.updates(files, start, end, collector)
    rows = chosen.collect()
    tables_first = sum(r.data_type == "rib" for r in rows)
    elements = decoded(spark, [r.url for r in rows], tables_first, max_updates)
    alerts = analyze(elements.where(F.col("seq") >= tables_first << 40), roas, relations, output, collector)
    end_state = rib.counts(rib.materialize(rib.announcements(elements).select("seq", "prefix", "peer_asn", "withdraw"))).first()
    return {"alerts": alerts, "prefixes": end_state.prefix_count, "routes": end_state.route_count}

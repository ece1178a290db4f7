"""Structured Streaming twins of the batch operators.

The routing table is kept in two forms. ``rib_changes`` is a built-in aggregation: its state is one row for each route that
was ever seen. ``live_routes`` keeps only routes that stand: a processor with a map of peers for each prefix, from which a
withdrawn route goes when its grace is over. Alerts need no state: each micro-batch goes through the batch operators and
is written under its batch id, so a batch that is run again after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.values import of_seconds
from ..operators import commits, routes, signals
from ..operators.rib import announcements


def rib_changes(updates: DataFrame) -> DataFrame:
    """A stream of the columns of ``announcements`` to the last update of each (prefix, peer_asn), for output mode ``update``: an upsert, or with ``withdraw`` a delete."""
    rest = [c for c in updates.columns if c not in ("prefix", "peer_asn", "seq")]
    last = updates.groupBy("prefix", "peer_asn").agg(F.max(F.struct("seq", *rest)).alias("last"))
    return last.select("prefix", "peer_asn", *(F.col(f"last.{c}").alias(c) for c in ("seq", *rest)))


CHANGE = "prefix string, peer_asn bigint, seq bigint, withdraw boolean, as_path array<bigint>, origin_asn bigint, ts double"


class LiveRoutes(StatefulProcessor):
    """Of each prefix the last update of each peer, while it stands.

    A withdrawal stays for ``grace`` milliseconds as a mark, so that an older announcement that comes late doesn't bring
    the route back; then a timer takes it out. With no grace it goes at once, for sources in order of ``seq``.
    """

    def __init__(self, grace: int):
        self.grace = grace

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.peers = handle.getMapState("peers", "peer_asn bigint", "seq bigint, gone_at bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last: dict[int, tuple] = {}
        for part in rows:
            for row in part.sort_values("seq").itertuples(index=False):
                if row.peer_asn not in last or last[row.peer_asn].seq < row.seq:
                    last[row.peer_asn] = row
        changed = []
        for peer, row in last.items():
            known = self.peers.getValue((peer,)) if self.peers.containsKey((peer,)) else None
            if known is not None and known[0] >= row.seq:
                continue
            if not row.withdraw:
                self.peers.updateValue((peer,), (int(row.seq), -1))
            elif self.grace:
                gone = timerValues.getCurrentProcessingTimeInMs() + self.grace
                self.peers.updateValue((peer,), (int(row.seq), gone))
                self.handle.registerTimer(gone)
            elif known is not None:
                self.peers.removeKey((peer,))
            changed.append(row)
        if changed:
            yield pd.DataFrame(changed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        for peer in [k for k, (_, gone) in self.peers.iterator() if 0 <= gone <= now]:
            self.peers.removeKey(peer)
        return iter(())

    def close(self) -> None:
        pass


def live_routes(updates: DataFrame, grace: int = 0) -> DataFrame:
    """A stream of the columns of ``announcements`` to its effective changes: an upsert of a route, or with ``withdraw`` a delete.

    State has a row for each route that stands (and for withdrawals within their grace). It wants Spark's RocksDB state
    store: ``spark.sql.streaming.stateStore.providerClass``.
    """
    columns = [f.split()[0] for f in CHANGE.split(", ")]
    return updates.select(*columns).groupBy("prefix").transformWithStateInPandas(LiveRoutes(grace), CHANGE, "update", "processingTime" if grace else "none")


def alerts_of(elements: DataFrame, roas: DataFrame, relations: DataFrame, collector: str | None = None, v6: bool = True) -> DataFrame:
    """Alerts of a table of decoded messages; withdrawals raise none."""
    rows = announcements(elements).where("NOT withdraw").select(of_seconds(F.col("ts")).alias("timestamp"), "prefix", "origin_asn", "as_path", "peer_asn", F.lit(collector).cast("string").alias("collector"))
    return routes.alerts(routes.path_verdicts(routes.validate_origins(rows, roas, v6), relations))


def write_alerts(elements: DataFrame, roas: DataFrame, relations: DataFrame, path: str, checkpoint: str, collector: str | None = None, v6: bool = True, once: bool = False) -> StreamingQuery:
    """Alerts of a stream of decoded messages as JSON lines, a folder for each micro-batch. ``once``: what is there now, then stop."""

    def batch(df: DataFrame, number: int) -> None:
        alerts_of(df, roas, relations, collector, v6).write.mode("overwrite").json(f"{path}/batch={number}", ignoreNullFields=False)

    writer = elements.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def keep_state(features: DataFrame, store: commits.Store, checkpoint: str, retain_days: int = 30) -> StreamingQuery:
    """A stream of pair features merged into a store's pair state, a commit for each micro-batch. One that is run again after a failure isn't merged twice."""

    def batch(df: DataFrame, number: int) -> None:
        step = store.begin()
        if step.tags.get("pair_state") != f"batch{number}" and not df.isEmpty():
            as_of = df.agg(F.max("last_seen")).scalar()
            step.put("pair_state", signals.merge_state(step.read("pair_state"), df, as_of, retain_days))
            step.tag("pair_state", f"batch{number}")
            step.commit()

    return features.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).start()

"""Stored snapshots: a loop that builds each due snapshot from the one before and the events since, and positions from them.

A snapshot is a folder of its own under its time; a small commit file under the same name says which run of the build
holds. A build that dies leaves no commit, so readers never see it and the next run makes it again; of two builds of
one time only one can commit. Stored snapshots keep keys whose quantity is zero, so that counts stay whole later; what
positions return leaves them out, as the direct computation does.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import Files
from . import position
from .dedup import latest_by_key

STAMP = "%Y%m%dT%H%M%S"
#: Events with since < ts <= until; since None means from the first event on.
Reader = Callable[[dt.datetime | None, dt.datetime], DataFrame]


@dataclass(frozen=True)
class Measure:
    """What a position is of: keys, the signed quantity, time and id of an event, attributes of the latest event."""

    keys: list[str]
    quantity: str
    ts: str
    event_id: str
    attrs: list[str]


def reader(events: DataFrame, ts: str) -> Reader:
    """Of a DataFrame; for a month-partitioned table use `read_by_month`, which prunes."""

    def read(since: dt.datetime | None, until: dt.datetime) -> DataFrame:
        out = events.where(F.col(ts) <= F.lit(until).cast("timestamp_ntz"))
        return out if since is None else out.where(F.col(ts) > F.lit(since).cast("timestamp_ntz"))

    return read


class SnapshotStore:
    def __init__(self, spark: SparkSession, path: str, measure: Measure):
        self.spark, self.path, self.measure, self.files = spark, path.rstrip("/"), measure, Files(spark)

    def _commit_file(self, at: dt.datetime) -> str:
        return f"{self.path}/commits/at={at.strftime(STAMP)}/commit"

    def times(self) -> list[dt.datetime]:
        """Committed snapshots, oldest first: names only, no data is read."""
        found = [n.removeprefix("at=") for n in self.files.folders(f"{self.path}/commits")]
        return [dt.datetime.strptime(n, STAMP) for n in found]

    def before(self, at: dt.datetime, itself: bool = True) -> dt.datetime | None:
        return max((t for t in self.times() if t < at or (itself and t == at)), default=None)

    def read(self, at: dt.datetime) -> DataFrame:
        """One committed snapshot; only its own folder is listed."""
        commit = json.loads(self.files.text(self._commit_file(at)))
        return self.spark.read.schema(commit["schema"]).parquet(f"{self.path}/data/at={at.strftime(STAMP)}/run={commit['run']}")

    def _parts(self, events: Reader, base: dt.datetime | None, at: dt.datetime) -> DataFrame:
        m = self.measure
        delta = latest_by_key(events(base, at), [m.event_id], [m.ts])
        parts = position._as_parts(delta, m.keys, m.quantity, m.ts, m.event_id, m.attrs)
        return parts if base is None else self.read(base).select(*parts.columns).unionByName(parts)

    def position(self, events: Reader, at: dt.datetime) -> DataFrame:
        """Position at a time: the latest committed snapshot not after it, and the events in (snapshot, at]."""
        base = self.before(at)
        out = position._summed(self._parts(events, base, at), self.measure.keys, self.measure.attrs)
        return out.withColumns({"query_time": position._at(at), "base_snapshot_time": position._at(base)})

    def due(self, events: DataFrame, hours: int, lookback: dt.timedelta | None = None) -> list[dt.datetime]:
        """Every so many hours from the first event's day (or from `lookback` before the last event's hour) to the last event."""
        ts = self.measure.ts
        span = events.agg(F.date_trunc("day", F.min(ts)).cast("timestamp_ntz").alias("lo"), F.max(ts).cast("timestamp_ntz").alias("hi")).first()
        if span["hi"] is None:
            return []
        lo = span["lo"] if lookback is None else span["hi"].replace(minute=0, second=0, microsecond=0) - lookback
        return [lo + k * dt.timedelta(hours=hours) for k in range(int((span["hi"] - lo) / dt.timedelta(hours=hours)) + 1)]

    def plan(self, events: DataFrame, due: list[dt.datetime], batch: int = 10) -> DataFrame:
        """The dry run: snapshot_ts, base_ts (what it would be built from), n_events since then, missing, batch number. Writes nothing."""
        there = self.times()
        known = sorted({*there, *due})
        bounds = F.array(*[position._at(t) for t in known])
        first = F.get(F.filter(bounds, lambda t: t >= F.col(self.measure.ts).cast("timestamp_ntz")), 0)
        counts = {r["t"]: r["n"] for r in events.groupBy(first.alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()} if known else {}  # one row per snapshot
        rows, missing = [], 0
        for k, at in enumerate(known):
            if at in due:
                gone = at not in there
                rows.append((at, known[k - 1] if k else None, counts.get(at, 0), gone, missing // batch + 1 if gone else None))
                missing += gone
        return self.spark.createDataFrame(rows, "snapshot_ts timestamp_ntz, base_ts timestamp_ntz, n_events bigint, missing boolean, batch int")

    def build(self, events: Reader, due: list[dt.datetime], most: int | None = None) -> list[dt.datetime]:
        """Build the due snapshots that are missing, oldest first, `most` of them at most; returns those committed by this call.

        A time older than a committed one is built from what lies before it; later ones are not touched by that.
        """
        there, built = set(self.times()), []
        for at in sorted(t for t in due if t not in there):
            if most is not None and len(built) >= most:
                break
            if self._build(events, at):
                built.append(at)
        return built

    def _build(self, events: Reader, at: dt.datetime) -> bool:
        m, run = self.measure, uuid.uuid4().hex
        parts = self._parts(events, self.before(at, itself=False), at)
        snapshot = position._summed(parts, m.keys, m.attrs, keep_zero=True).withColumn("snapshot_ts", position._at(at))
        snapshot.write.parquet(f"{self.path}/data/at={at.strftime(STAMP)}/run={run}")
        return self.files.create(self._commit_file(at), json.dumps({"run": run, "schema": snapshot._jdf.schema().toDDL()}))

    def invalidate(self, since: dt.datetime) -> list[dt.datetime]:
        """Take back snapshots from a time on, for events that came late: the next `build` makes them again."""
        gone = [t for t in self.times() if t >= since]
        for t in sorted(gone, reverse=True):  # a crash leaves an older part that is still right
            self.files.delete(f"{self.path}/commits/at={t.strftime(STAMP)}")
        return gone

    def all(self) -> DataFrame:
        """Every committed snapshot, without keys of quantity zero."""
        found = [self.read(t) for t in self.times()]
        if not found:
            raise ValueError("no snapshot is committed")
        out = found[0]
        for df in found[1:]:
            out = out.unionByName(df)
        return out.where(F.abs("quantity") > 1e-9)

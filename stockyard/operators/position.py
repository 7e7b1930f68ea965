"""Stock positions: cumulative snapshots, and the position at any time from a snapshot and the events after it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .dedup import latest_by_key


def _at(when: dt.datetime | None):
    return F.lit(when).cast("timestamp_ntz")


def _summed(parts: DataFrame, keys: list[str], attrs: list[str], keep_zero: bool = False) -> DataFrame:
    """Re-aggregate partial positions; attributes come from one row, the latest by (last_ts, last_id)."""
    latest = F.max_by(F.struct("last_ts", "last_id", *attrs), F.struct("last_ts", "last_id"))
    out = parts.groupBy(*keys).agg(F.sum("quantity").alias("quantity"), F.sum("event_count").alias("event_count"), latest.alias("_last"))
    out = out if keep_zero else out.where(F.abs("quantity") > 1e-9)
    return out.select(*keys, "quantity", "event_count", "_last.*")


def _as_parts(events: DataFrame, keys: list[str], quantity: str, ts: str, event_id: str, attrs: list[str]) -> DataFrame:
    return events.select(*keys, F.col(quantity).alias("quantity"), F.lit(1).cast("bigint").alias("event_count"), F.col(ts).alias("last_ts"), F.col(event_id).alias("last_id"), *attrs)


def build_snapshot(events: DataFrame, at: dt.datetime, keys: list[str], quantity: str, ts: str, event_id: str, attrs: list[str], keep_zero: bool = False) -> DataFrame:
    """Cumulative position per key over events with ts <= at; zero positions are dropped, negative ones kept.

    keep_zero: keep them too. A snapshot that positions are counted from needs them, else their event_count is lost.
    One max_by over a struct holds all attributes: one accumulator instead of one per attribute.
    """
    once = latest_by_key(events.where(F.col(ts) <= _at(at)), [event_id], [ts])
    return _summed(_as_parts(once, keys, quantity, ts, event_id, attrs), keys, attrs, keep_zero).withColumn("snapshot_ts", _at(at))


def position_at_time(snapshots: DataFrame, events: DataFrame, at: dt.datetime, keys: list[str], quantity: str, ts: str, event_id: str, attrs: list[str], where: dict[str, object] | None = None) -> DataFrame:
    """Position at a time: the latest snapshot not after it, and the events in (snapshot, at].

    The base time is read first (one value), so that both scans get it as a literal and prune by it.
    """
    for c, v in (where or {}).items():
        snapshots, events = snapshots.where(F.col(c) == F.lit(v)), events.where(F.col(c) == F.lit(v))
    base = snapshots.where(F.col("snapshot_ts") <= _at(at)).agg(F.max("snapshot_ts").alias("t")).first()["t"]
    delta = events.where(F.col(ts) <= _at(at))
    if base is not None:
        delta = delta.where(F.col(ts) > _at(base))
    parts = _as_parts(latest_by_key(delta, [event_id], [ts]), keys, quantity, ts, event_id, attrs)
    if base is not None:
        parts = snapshots.where(F.col("snapshot_ts") == _at(base)).select(*parts.columns).unionByName(parts)
    return _summed(parts, keys, attrs).withColumns({"query_time": _at(at), "base_snapshot_time": _at(base)})


def plan_snapshots(spark: SparkSession, events: DataFrame, snapshots: DataFrame | None, ts: str, hours: int = 24) -> DataFrame:
    """Times at which a snapshot is due (every so many hours after the first event's day) and not there yet."""
    span = events.agg(F.date_trunc("day", F.min(ts)).alias("lo"), F.max(ts).alias("hi"))
    due = span.select(F.explode(F.sequence(F.col("lo").cast("timestamp"), F.col("hi").cast("timestamp"), F.make_dt_interval(hours=F.lit(hours)))).alias("snapshot_ts"))
    due = due.select(F.col("snapshot_ts").cast("timestamp_ntz").alias("snapshot_ts"))
    return due if snapshots is None else due.join(snapshots.select("snapshot_ts").distinct(), "snapshot_ts", "left_anti")


def append_snapshot(spark: SparkSession, path: str, snapshot: DataFrame, at: dt.datetime) -> bool:
    """Append unless there is one of that time. Snapshots are partitioned by their time."""
    stamp = at.strftime("%Y%m%dT%H%M%S")
    try:
        if not spark.read.option("basePath", path).parquet(path).where(F.col("at") == stamp).isEmpty():
            return False
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    snapshot.withColumn("at", F.lit(stamp)).write.mode("append").partitionBy("at").parquet(path)
    return True


def register_table_function(spark: SparkSession, name: str, snapshots_view: str, events_view: str, keys: list[str], quantity: str) -> None:
    """A SQL table function name(warehouse, at): the parameterized view over two views with columns wh_id, ts, snapshot_ts."""
    k = ", ".join(keys)
    kinds = {f.name: f.dataType.simpleString() for f in spark.table(events_view).schema}
    returns = ", ".join([*(f"{c} {kinds[c]}" for c in keys), "quantity DOUBLE"])
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(wh BIGINT, at TIMESTAMP_NTZ) RETURNS TABLE ({returns}) RETURN
        WITH base AS (SELECT max(snapshot_ts) AS t FROM {snapshots_view} WHERE wh_id = wh AND snapshot_ts <= at),
        parts AS (
            SELECT {k}, quantity FROM {snapshots_view} WHERE wh_id = wh AND snapshot_ts = (SELECT t FROM base)
            UNION ALL
            SELECT {k}, CAST({quantity} AS DOUBLE) FROM {events_view}
            WHERE wh_id = wh AND ts <= at AND ts > coalesce((SELECT t FROM base), TIMESTAMP_NTZ '1900-01-01 00:00:00'))
        SELECT {k}, sum(quantity) AS quantity FROM parts GROUP BY {k} HAVING abs(sum(quantity)) > 1e-9
    """)


def register_all_function(spark: SparkSession, name: str, snapshots_view: str, events_view: str, keys: list[str], quantity: str) -> None:
    """The same for all warehouses at once, name(at) with wh_id before the keys: each counts from its own latest snapshot."""
    k = ", ".join(keys)
    kinds = {f.name: f.dataType.simpleString() for f in spark.table(events_view).schema}
    returns = ", ".join([*(f"{c} {kinds[c]}" for c in ("wh_id", *keys)), "quantity DOUBLE"])
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(at TIMESTAMP_NTZ) RETURNS TABLE ({returns}) RETURN
        WITH base AS (SELECT wh_id AS wh, max(snapshot_ts) AS t FROM {snapshots_view} WHERE snapshot_ts <= at GROUP BY wh_id),
        parts AS (
            SELECT wh_id, {k}, quantity FROM {snapshots_view} JOIN base ON wh_id <=> wh AND snapshot_ts = t
            UNION ALL
            SELECT wh_id, {k}, CAST({quantity} AS DOUBLE) FROM {events_view} LEFT JOIN base ON wh_id <=> wh
            WHERE ts <= at AND ts > coalesce(t, TIMESTAMP_NTZ '1900-01-01 00:00:00'))
        SELECT wh_id, {k}, sum(quantity) AS quantity FROM parts GROUP BY wh_id, {k} HAVING abs(sum(quantity)) > 1e-9
    """)

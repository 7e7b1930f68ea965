"""Queries for positions, snapshots, dedup and monitoring, on the events table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import date_diff, seconds_between, year_month
from ..operators import monitoring, position, snapshots
from ..operators.dedup import latest_by_key, not_deleted
from ..sources.shared import shared_path
from ..sources.tables import read_table

SNAP, TARGET, AS_OF = dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 22, 12), dt.datetime(2024, 1, 31)
KEYS, ATTRS = ["user_id", "event_type"], ["props"]
#: Errors and views take stock away, other events add to it.
SIGNED = "CASE WHEN event_type IN ('error', 'view') THEN -value ELSE value END"

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = oracle
        return f

    return add


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").withColumn("qty", F.expr(SIGNED))


#: Snapshot stores of this application by the folder of their tables; a table's snapshots are built once and serve all positions.
_STORES: dict[tuple[str, str], snapshots.SnapshotStore] = {}


def stored_snapshots(spark: SparkSession, sf_dir: str) -> snapshots.SnapshotStore:
    at = spark.sparkContext.applicationId, sf_dir
    if at not in _STORES:
        store = snapshots.SnapshotStore(spark, shared_path(spark, "positions"), snapshots.Measure(KEYS, "qty", "ts", "event_id", ATTRS))
        store.build(snapshots.reader(_events(spark, sf_dir), "ts"), [SNAP - dt.timedelta(days=7), SNAP])
        _STORES[at] = store
    return _STORES[at]


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return position.build_snapshot(_events(spark, sf_dir), SNAP, KEYS, "qty", "ts", "event_id", ATTRS)


_POSITION = f"""
SELECT user_id, event_type, round(sum({SIGNED}), 2) AS quantity, count(*) AS event_count, max(ts) AS last_ts,
       arg_max(event_id, (ts, event_id)) AS last_id, arg_max(props, (ts, event_id)) AS props
FROM events WHERE ts <= TIMESTAMP '{TARGET}' GROUP BY ALL HAVING abs(sum({SIGNED})) > 1e-9"""


@query(f"SELECT *, TIMESTAMP '{TARGET}' AS query_time, TIMESTAMP '{SNAP}' AS base_snapshot_time FROM ({_POSITION})")
def position_at_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From stored snapshots: the base is the newest folder not after the target, and only the events since are read."""
    out = stored_snapshots(spark, sf_dir).position(snapshots.reader(_events(spark, sf_dir), "ts"), TARGET)
    return out.withColumn("quantity", F.round("quantity", 2))


@query(_POSITION)
def position_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = position.build_snapshot(_events(spark, sf_dir), TARGET, KEYS, "qty", "ts", "event_id", ATTRS)
    return out.withColumn("quantity", F.round("quantity", 2)).drop("snapshot_ts")


@query(
    f"""SELECT user_id, event_type, round(sum({SIGNED}), 2) AS quantity, count(*) AS event_count, max(ts) AS last_ts,
    arg_max(event_id, (ts, event_id)) AS last_id, arg_max(props, (ts, event_id)) AS props, TIMESTAMP '{SNAP}' AS snapshot_ts
    FROM events WHERE ts <= TIMESTAMP '{SNAP}' GROUP BY ALL HAVING abs(sum({SIGNED})) > 1e-9"""
)
def snapshot_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(spark, sf_dir).withColumn("quantity", F.round("quantity", 2))


@query(f"SELECT event_type, count(*) AS n_positions, round(sum(quantity), 2) AS quantity, CAST(sum(event_count) AS BIGINT) AS events FROM ({_POSITION}) GROUP BY ALL")
def position_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = position_at_time(spark, sf_dir)
    return p.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_positions"), F.round(F.sum("quantity"), 2).alias("quantity"), F.sum("event_count").alias("events"))


@query(
    f"""SELECT event_type, round(sum({SIGNED}), 2) AS quantity FROM events WHERE user_id % 10 = 3 AND ts <= TIMESTAMP '{TARGET}'
    GROUP BY ALL HAVING abs(sum({SIGNED})) > 1e-9"""
)
def position_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parameterized view as a SQL table function over one warehouse (here user_id mod 10, a column of the view)."""
    e = _events(spark, sf_dir).withColumn("wh_id", F.col("user_id") % 10)
    e.createOrReplaceTempView("tf_events")
    e.where(F.col("ts") <= F.lit(SNAP)).groupBy("wh_id", "event_type").agg(F.sum("qty").alias("quantity")).withColumn("snapshot_ts", F.lit(SNAP)).createOrReplaceTempView("tf_snapshots")
    position.register_table_function(spark, "stock_at", "tf_snapshots", "tf_events", ["event_type"], "qty")
    return spark.sql(f"SELECT event_type, round(quantity, 2) AS quantity FROM stock_at(3, TIMESTAMP_NTZ '{TARGET}')")


@query(
    f"""SELECT user_id % 10 AS wh_id, event_type, round(sum({SIGNED}), 2) AS quantity FROM events WHERE ts <= TIMESTAMP '{TARGET}'
    GROUP BY ALL HAVING abs(sum({SIGNED})) > 1e-9"""
)
def position_all_warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position of every warehouse, from its own latest snapshot."""
    position_table_function(spark, sf_dir)  # makes the views
    position.register_all_function(spark, "stock_of_all", "tf_snapshots", "tf_events", ["event_type"], "qty")
    return spark.sql(f"SELECT wh_id, event_type, round(quantity, 2) AS quantity FROM stock_of_all(TIMESTAMP_NTZ '{TARGET}')")


@query(
    f"""WITH due AS (SELECT unnest(generate_series(date_trunc('day', min(ts)), max(ts), INTERVAL 12 HOUR)) AS snapshot_ts FROM events)
    SELECT snapshot_ts FROM due WHERE snapshot_ts NOT IN (SELECT DISTINCT date_trunc('day', ts) FROM events WHERE ts < TIMESTAMP '{SNAP}')"""
)
def snapshot_plan_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    there = e.where(F.col("ts") < F.lit(SNAP)).select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("snapshot_ts"))
    return position.plan_snapshots(spark, e, there, "ts", 12)


@query("SELECT ts AS stamp, CAST(date_diff('hour', lag(ts) OVER (ORDER BY ts), ts) AS BIGINT) AS gap FROM (SELECT DISTINCT date_trunc('hour', ts) AS ts FROM events)")
def snapshot_gap_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.gaps(_events(spark, sf_dir).select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("stamp")), "stamp")


@query(
    f"""SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS n_rows, count(DISTINCT user_id) AS n_keys, round(sum({SIGNED}), 2) AS total,
    round(sum(abs({SIGNED})), 2) AS total_abs FROM events GROUP BY ALL ORDER BY day DESC LIMIT 20"""
)
def snapshot_status_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.snapshot_status(_events(spark, sf_dir).withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz")), "day", "user_id", "qty", 20)


@query("SELECT count(*) AS n_events, count(DISTINCT user_id) AS n_keys, min(ts) AS first_ts, max(ts) AS last_ts FROM events")
def monitoring_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.health(_events(spark, sf_dir), "ts", "user_id")


@query(f"SELECT user_id, max(ts) AS last_ts, CAST(floor(epoch(TIMESTAMP '{AS_OF}')) - floor(epoch(max(ts))) AS BIGINT) AS seconds_behind FROM events GROUP BY ALL")
def freshness_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.freshness(_events(spark, sf_dir), "user_id", "ts", AS_OF)


@query("SELECT user_id, round(sum(abs(value)), 2) AS moved, count(*) AS n FROM events GROUP BY ALL ORDER BY moved DESC, user_id LIMIT 20")
def top_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.top_movers(_events(spark, sf_dir), "user_id", "qty", 20)


@query(
    """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE user_id = 7), e AS (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM d)
    SELECT day FROM e WHERE day NOT IN (SELECT day FROM d)"""
)
def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.missing_days(_events(spark, sf_dir).where("user_id = 7"), "ts")


@query(
    """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), e AS (SELECT user_id, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM d GROUP BY user_id)
    SELECT user_id, day FROM e WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.user_id IS NOT DISTINCT FROM e.user_id AND d.day = e.day)"""
)
def missing_days_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.missing_days(_events(spark, sf_dir), "ts", "user_id")


_LINE = "l_orderkey, l_linenumber"
_VERSION = "l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"


@query(f"SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY {_LINE} ORDER BY {', '.join(f'{c} DESC' for c in _VERSION.split(', '))}) = 1")
def latest_by_key_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by_key(read_table(spark, sf_dir, "lineitem"), _LINE.split(", "), _VERSION.split(", "))


@query(
    f"""SELECT *, strftime(l_shipdate, '%Y%m') AS ym FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY {_LINE}, strftime(l_shipdate, '%Y%m') ORDER BY {', '.join(f'{c} DESC' for c in _VERSION.split(', '))}) = 1"""
)
def latest_by_key_in_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "lineitem").withColumn("ym", year_month(F.col("l_shipdate")))
    return latest_by_key(df, [*_LINE.split(", "), "ym"], _VERSION.split(", "))


_DEL = "CASE WHEN event_type = 'error' THEN ts + INTERVAL 2 DAY WHEN event_type = 'view' THEN TIMESTAMP '1970-01-01' END"


@query(f"SELECT event_id, {_DEL} AS deactivated_at FROM events WHERE NOT coalesce(({_DEL}) > TIMESTAMP '1970-01-01' AND ({_DEL}) <= TIMESTAMP '{TARGET}', false)")
def soft_delete_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.expr("CASE WHEN event_type = 'error' THEN ts + INTERVAL 2 DAY WHEN event_type = 'view' THEN TIMESTAMP_NTZ '1970-01-01 00:00:00' END")
    return not_deleted(_events(spark, sf_dir).select("event_id", d.alias("deactivated_at")), F.lit(TARGET))


@query(
    """SELECT user_id, CAST(ts AS DATE) AS day, CAST(date_diff('minute', min(ts), max(ts)) AS BIGINT) AS minutes, count(*) AS n FROM events
    GROUP BY ALL HAVING count(*) >= 2"""
)
def session_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _events(spark, sf_dir).groupBy("user_id", F.to_date("ts").alias("day")).agg(date_diff("minute", F.min("ts"), F.max("ts")).alias("minutes"), F.count(F.lit(1)).alias("n"))
    return g.where("n >= 2")


@query(
    """SELECT d.day, count(e.event_id) AS n_before, round(coalesce(sum(e.value), 0), 2) AS total FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) d
    LEFT JOIN events e ON CAST(e.ts AS DATE) <= d.day GROUP BY ALL"""
)
def range_join_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots x events with ts <= snapshot as a running sum over days: linear instead of a range join."""
    from pyspark.sql import Window

    days = _events(spark, sf_dir).groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    w = Window.orderBy("day")
    return days.select("day", F.sum("n").over(w).alias("n_before"), F.round(F.sum("v").over(w), 2).alias("total"))


@query(
    """WITH d AS (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY))::DATE AS day),
    t AS (SELECT DISTINCT event_type FROM events)
    SELECT t.event_type, d.day, count(e.event_id) AS n FROM d CROSS JOIN t LEFT JOIN events e ON e.event_type = t.event_type AND CAST(e.ts AS DATE) = d.day GROUP BY ALL"""
)
def cross_join_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    counts = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    every = e.select("event_type").distinct().select("event_type", F.explode(F.expr("sequence(DATE '2024-01-01', DATE '2024-01-30')")).alias("day"))
    return every.join(counts, ["event_type", "day"], "left").select("event_type", "day", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@query(
    f"""SELECT coalesce(a.user_id, b.user_id) AS user_id, round(coalesce(a.v, 0), 2) AS first_half, round(coalesce(b.v, 0), 2) AS second_half
    FROM (SELECT user_id, sum(value) AS v FROM events WHERE ts < TIMESTAMP '{SNAP}' AND event_type = 'purchase' GROUP BY 1) a
    FULL JOIN (SELECT user_id, sum(value) AS v FROM events WHERE ts >= TIMESTAMP '{SNAP}' AND event_type = 'error' GROUP BY 1) b USING (user_id)"""
)
def full_outer_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    a = e.where((F.col("ts") < F.lit(SNAP)) & (F.col("event_type") == "purchase")).groupBy("user_id").agg(F.sum("value").alias("a"))
    b = e.where((F.col("ts") >= F.lit(SNAP)) & (F.col("event_type") == "error")).groupBy("user_id").agg(F.sum("value").alias("b"))
    return a.join(b, "user_id", "full").select("user_id", F.round(F.coalesce("a", F.lit(0.0)), 2).alias("first_half"), F.round(F.coalesce("b", F.lit(0.0)), 2).alias("second_half"))


@query(f"SELECT event_id, greatest(ts, TIMESTAMP '{SNAP}') AS changed_at, CAST(floor(epoch(TIMESTAMP '{AS_OF}')) - floor(epoch(ts)) AS BIGINT) AS age FROM events WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY ORDER BY ts DESC, event_id LIMIT 25")
def recent_changes_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).where(F.col("ts") > F.lit(AS_OF - dt.timedelta(days=7))).orderBy(F.desc("ts"), "event_id").limit(25)
    return e.select("event_id", F.greatest("ts", F.lit(SNAP).cast("timestamp_ntz")).alias("changed_at"), seconds_between(F.col("ts"), F.lit(AS_OF)).alias("age"))

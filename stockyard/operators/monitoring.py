"""Monitoring of snapshots and events."""

from __future__ import annotations

import time

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import date_diff, seconds_between


def health(events: DataFrame, ts: str, key: str) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("n_events"), F.countDistinct(key).alias("n_keys"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def snapshot_status(rows: DataFrame, stamp: str, key: str, quantity: str, top: int) -> DataFrame:
    """Per snapshot the rows, keys and quantities, the latest `top`."""
    out = rows.groupBy(stamp).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("n_keys"), F.round(F.sum(quantity), 2).alias("total"), F.round(F.sum(F.abs(quantity)), 2).alias("total_abs"))
    return out.orderBy(F.desc(stamp)).limit(top)


def freshness(events: DataFrame, key: str, ts: str, as_of: dt.datetime) -> DataFrame:
    return events.groupBy(key).agg(F.max(ts).alias("last_ts")).withColumn("seconds_behind", seconds_between(F.col("last_ts"), F.lit(as_of)))


def gaps(stamps: DataFrame, stamp: str, unit: str = "hour") -> DataFrame:
    """Distinct times with the boundaries since the one before; null for the first. One row per time, so one task orders them."""
    w = Window.orderBy(stamp)
    return stamps.select(stamp).distinct().withColumn("gap", date_diff(unit, F.lag(stamp).over(w), F.col(stamp)))


def top_movers(events: DataFrame, key: str, quantity: str, top: int) -> DataFrame:
    return events.groupBy(key).agg(F.round(F.sum(F.abs(quantity)), 2).alias("moved"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("moved"), key).limit(top)


def missing_days(events: DataFrame, ts: str, *keys: str) -> DataFrame:
    """Days between the first and the last event that have none; with keys, per key (null is a key)."""
    days = events.select(*keys, F.to_date(ts).alias("day")).distinct()
    every = days.groupBy(*keys).agg(F.min("day").alias("a"), F.max("day").alias("b")).select(*keys, F.explode(F.sequence("a", "b")).alias("day"))
    same = [F.col(f"every.{c}").eqNullSafe(F.col(f"days.{c}")) for c in (*keys, "day")]
    return every.alias("every").join(days.alias("days"), same, "left_anti")


def probe(spark, runs: dict, repeat: int = 3) -> DataFrame:
    """Time queries: name, rows, and the best and worst seconds of some runs. runs: name -> function that gives a DataFrame."""
    found = []
    for name, run in runs.items():
        took, rows = [], 0
        for _ in range(repeat):
            began = time.perf_counter()
            rows = run().count()
            took.append(time.perf_counter() - began)
        found.append((name, rows, min(took), max(took)))
    return spark.createDataFrame(found, "name string, n_rows bigint, best_s double, worst_s double")

"""Queries of streams whose rows come in several deliveries, with a stop in between, and of stored tables that are rewritten.

A delivery is a folder's next files, written from the given tables. Each query ends on what the same rows give as a batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json_text
from ..functions.defaults import fill_defaults, override_if_active
from ..functions.times import year_month
from ..sources import tables
from ..sources.shared import shared_path
from ..sources.tables import read_table
from ..streaming import control, keyed_log, ttl_join, upserts
from .stock import _VERSION, SNAP

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(oracle: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, oracle
        return f

    return add


#: A file of a delivery is this many Parquet files: they are written and read side by side, in the same micro-batches.
SPREAD = 12


def deliver(rows: DataFrame, path: str, files: int) -> None:
    rows.repartition(files * SPREAD).write.mode("append").parquet(path)


def _version(alias: str = "") -> str:
    return ", ".join(f"{alias}{c} DESC" for c in _VERSION.split(", "))


_NO_TAX = "CASE WHEN l_returnflag = 'R' AND l_quantity > 48 THEN NULL ELSE l_tax END"


@query(
    f"""SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_tax, 'table' AS held_in FROM lineitem WHERE {_NO_TAX} IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m') ORDER BY {_version()}) = 1)
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, NULL, 'quarantine' FROM lineitem WHERE {_NO_TAX} IS NULL"""
)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of lines, upserted by key into months over two deliveries and a restart; rows without a tax go to quarantine."""
    path = shared_path(spark, "stream-upsert")
    lines = read_table(spark, sf_dir, "lineitem").withColumn("l_tax", F.expr(_NO_TAX)).withColumn("__op", F.lit("c"))
    keys, version = ["l_orderkey", "l_linenumber"], _VERSION.split(", ")
    for k, part in enumerate((F.col("l_linenumber") <= 3, F.col("l_linenumber") > 3)):
        deliver(lines.where(part), f"{path}/topic", 2 + k)
        stream = upserts.change_stream(spark, f"{path}/topic", lines.schema, 2 * SPREAD)
        upserts.upsert_by_month(stream, f"{path}/table", keys, version, "l_shipdate", f"{path}/checkpoint", [*keys, "l_tax"], f"{path}/quarantine").awaitTermination()
    columns = [*keys, "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_tax"]
    good = tables.read_by_month(spark, f"{path}/table", "l_shipdate").select(*columns, F.lit("table").alias("held_in"))
    return good.unionByName(spark.read.parquet(f"{path}/quarantine").select(*columns, F.lit("quarantine").alias("held_in")))


@query(
    """SELECT c_custkey, c_name, o.last_order, o.total FROM customer LEFT JOIN
    (SELECT o_custkey, max(o_orderkey) AS last_order, arg_max(o_totalprice, o_orderkey) AS total FROM orders GROUP BY 1) o ON o.o_custkey = c_custkey WHERE c_custkey IS NOT NULL"""
)
def stream_ttl_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers left join their latest order, both sides as streams with state; open orders come after a restart and replace what stood there."""
    path = shared_path(spark, "ttl-join")
    customer, orders = (read_table(spark, sf_dir, t) for t in ("customer", "orders"))
    left = customer.select("c_custkey", "c_name", F.lit(-1).cast("bigint").alias("v"))
    left, orders = left.where("c_custkey IS NOT NULL"), orders.where("o_custkey IS NOT NULL AND o_orderkey IS NOT NULL")
    right = orders.select("o_custkey", "o_orderkey", "o_totalprice")
    done = F.col("o_orderstatus") == "F"
    deliver(left, f"{path}/left", 1)
    for part in (orders.where(done), orders.where(F.coalesce(~done, F.lit(True)))):
        deliver(part.select(*right.columns), f"{path}/right", 2)
        sides = [
            ttl_join.tagged(upserts.change_stream(spark, f"{path}/left", left.schema), "left", "c_custkey", "v"),
            ttl_join.tagged(upserts.change_stream(spark, f"{path}/right", right.schema), "right", "o_custkey", "o_orderkey"),
        ]
        with ttl_join.state_in_rocksdb(spark):
            started = keyed_log.append(ttl_join.left_join_with_ttl(*sides, ttl_ms=86_400_000), path, f"{path}/checkpoint", single=True)
        started.awaitTermination()
    pairs = keyed_log.latest(spark, path, ["key"])
    mine, theirs = F.from_json("left_row", left.schema), F.from_json("right_row", right.schema)
    return pairs.select(mine["c_custkey"].alias("c_custkey"), mine["c_name"].alias("c_name"), theirs["o_orderkey"].alias("last_order"), theirs["o_totalprice"].alias("total"))


_LATE = f"event_type = 'view' AND ts < TIMESTAMP '{SNAP}' - INTERVAL 3 DAY"


@query(f"SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, date_trunc('hour', ts)::TIMESTAMP + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events WHERE NOT ({_LATE}) GROUP BY ALL")
def stream_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows with a watermark of one day: views that come after the later events, three days old and more, are late and change nothing."""
    path = shared_path(spark, "watermark")
    events = read_table(spark, sf_dir, "events").select("ts", "event_type", "value")
    late, early = F.expr(_LATE.replace("TIMESTAMP", "TIMESTAMP_NTZ")), F.col("ts") < F.lit(SNAP)
    for part in (events.where(early & ~late), events.where(~early), events.where(late)):
        deliver(part, f"{path}/topic", 2)
        stream = upserts.change_stream(spark, f"{path}/topic", events.schema)
        windows = upserts.tumbling(stream, "ts", ["event_type"], "1 hour", [F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")], late="1 day")
        keyed_log.append(windows, path, f"{path}/checkpoint").awaitTermination()
    return keyed_log.latest(spark, path, ["window_start", "window_end", "event_type"]).withColumn("total", F.round("total", 2))


def _refused(what: str, act: Callable) -> None:
    try:
        act()
    except control.Refused:
        return
    raise AssertionError(f"{what} was not refused")


@query("SELECT user_id, event_type, count(*) AS n, round(sum(value), 2) AS total, max(ts) AS last_ts FROM events GROUP BY ALL")
def stream_pause_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per user and type over a pause: a second start and a changed job are refused, the resumed query goes on from its state."""
    path = shared_path(spark, "pause-resume")
    events = read_table(spark, sf_dir, "events").select("user_id", "event_type", "value", "ts")

    def begin(checkpoint: str):
        stream = upserts.change_stream(spark, f"{path}/topic", events.schema, 2 * SPREAD)
        totals = stream.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.max("ts").alias("last_ts"))
        return keyed_log.append(totals, path, checkpoint, bounded=False, seconds=1)

    registry, job = control.Registry(spark, f"{path}/jobs"), control.Job("totals", f"{path}/checkpoint", begin, "count, sum and last time by user and type")
    early = F.col("ts") < F.lit(SNAP)
    deliver(events.where(early), f"{path}/topic", 3)
    running = registry.start(job)
    running.processAllAvailable()
    _refused("a second start", lambda: registry.start(job))
    registry.pause(job, running)
    _refused("a start of a paused job", lambda: registry.start(job))
    _refused("a changed job", lambda: registry.resume(control.Job(job.name, job.checkpoint, begin, "other")))
    deliver(events.where(F.coalesce(~early, F.lit(True))), f"{path}/topic", 3)
    running = registry.resume(job)
    running.processAllAvailable()
    registry.pause(job, running)
    return keyed_log.latest(spark, path, ["user_id", "event_type"]).withColumn("total", F.round("total", 2))


@query(
    f"""WITH v AS (SELECT *, 1 AS v FROM lineitem UNION ALL SELECT * REPLACE (0.0 AS l_quantity), 2 FROM lineitem WHERE l_returnflag = 'R'),
    t AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m') ORDER BY v DESC, {_version()}) = 1)
    SELECT strftime(l_shipdate, '%Y%m') AS ym, l_suppkey, count(*) AS n, sum(l_quantity) AS quantity, round(sum(l_extendedprice), 2) AS price FROM t
    WHERE l_shipdate > TIMESTAMP '1996-03-15' AND l_shipdate <= TIMESTAMP '1999-10-20' GROUP BY ALL"""
)
def table_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by month with superseded lines is compacted to the latest per key, in sorted files, and read back for a range that prunes months."""
    import datetime as dt

    path = shared_path(spark, "compaction")
    lines = read_table(spark, sf_dir, "lineitem")
    tables.write_by_month(lines.withColumn("v", F.lit(1)), path, "l_shipdate", ["l_suppkey", "l_partkey"])
    tables.write_by_month(lines.where("l_returnflag = 'R'").withColumn("l_quantity", F.lit(0.0)).withColumn("v", F.lit(2)), path, "l_shipdate", ["l_suppkey", "l_partkey"])
    tables.compact(spark, path, ["l_orderkey", "l_linenumber"], ["v", *_VERSION.split(", ")], files_per_month=2)
    kept = tables.read_by_month(spark, path, "l_shipdate", dt.datetime(1996, 3, 15), dt.datetime(1999, 10, 20))
    return kept.groupBy(year_month(F.col("l_shipdate")).alias("ym"), "l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


_DOC = """CASE event_type WHEN 'error' THEN '{' || props WHEN 'view' THEN '{"ok":true,"own":' || props || '}' WHEN 'purchase' THEN '[' || props || ']' WHEN 'click' THEN '{"ok":false}' ELSE '7' END"""


@query(
    f"""SELECT event_id, json_valid(doc) AS valid, CASE json_type(CASE WHEN json_valid(doc) THEN doc END) WHEN 'OBJECT' THEN 'Object' WHEN 'ARRAY' THEN 'Array' WHEN 'UBIGINT' THEN 'Value' END AS kind,
    coalesce(json_extract_string(CASE WHEN json_valid(doc) THEN doc END, '$.ok') = 'true', false) AS ok, coalesce(json_extract_string(CASE WHEN json_valid(doc) THEN doc END, '$.own.k'), '') AS own,
    CASE WHEN event_type = 'view' AND user_id > 10 AND value <> 0 THEN value ELSE 1.5 END AS rate, CASE WHEN event_type = 'purchase' THEN 2 ELSE 0 END AS n_tags FROM (SELECT *, {_DOC} AS doc FROM events)"""
)
def json_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a text is JSON and of which kind, members with defaults, an override that counts only while active, empty arrays for missing ones."""
    df = read_table(spark, sf_dir, "events").withColumn("doc", F.expr(_DOC))
    df = fill_defaults(df.withColumn("tags", F.when(F.col("event_type") == "purchase", F.array("event_type", "props"))), ["tags"])
    doc, active = F.col("doc"), (F.col("event_type") == "view") & (F.col("user_id") > 10)
    return df.select(
        "event_id", json_text.is_valid(doc).alias("valid"), json_text.kind(doc).alias("kind"), json_text.extract_bool(doc, "ok").alias("ok"), json_text.extract_string(doc, "own.k").alias("own"),
        override_if_active(active, F.col("value"), F.lit(1.5), T.DoubleType()).alias("rate"), F.size("tags").alias("n_tags"),
    )

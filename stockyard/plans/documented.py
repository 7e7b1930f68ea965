"""The reports of `operators.reports` on the enriched tables, positions, bins and area mappings, each with SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reports, snapshots
from ..sources.tables import read_table
from . import enrichments, retail
from .stock import AS_OF, SIGNED, TARGET, _events, stored_snapshots

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(oracle: str):
    def add(f):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, oracle
        return f

    return add


_PICKS = f"WITH p AS ({enrichments.ORACLE['pick_drop_enriched']})"
_WORK = f"WITH p AS ({enrichments.ORACLE['workstation_enriched']})"
_BINS = f"WITH b AS ({retail.ORACLE['bin_master_join']})"


@query(
    f"""{_PICKS} SELECT worker_code, worker_name, count(*) AS n, sum(picked_qty) AS quantity, count(DISTINCT CAST(picked_at AS DATE)) AS days, round(sum(picked_qty) / count(*), 4) AS per_event,
    round(count(*) / count(DISTINCT CAST(picked_at AS DATE)), 4) AS per_day FROM p WHERE picked_at > TIMESTAMP '1970-01-01' GROUP BY 1, 2 HAVING count(*) >= 10"""
)
def report_worker_productivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.productivity(enrichments.pick_drop_enriched(spark, sf_dir, {"worker_code", "worker_name"}), ["worker_code", "worker_name"], "picked_at", "picked_qty")


@query(
    f"""{_PICKS} SELECT picked_sku_id, sku_brand, count(*) AS n, sum(picked_qty) AS quantity, count(DISTINCT worker_name) AS n_others FROM p WHERE picked_qty > 0
    GROUP BY 1, 2 ORDER BY n DESC, picked_sku_id, sku_brand LIMIT 50"""
)
def report_sku_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top list: the 50 most picked SKUs."""
    return reports.frequency(enrichments.pick_drop_enriched(spark, sf_dir, {"sku_brand", "worker_name"}), ["picked_sku_id", "sku_brand"], "picked_qty", "worker_name", 50)


@query(
    f"""{_PICKS} SELECT CAST(month(picked_at) AS INTEGER) AS part, count(*) AS n, round(avg(date_diff('second', dropped_hu_created_at, picked_at)), 2) AS mean_seconds FROM p
    WHERE picked_at > TIMESTAMP '1970-01-01' AND dropped_hu_created_at > TIMESTAMP '1970-01-01' GROUP BY 1"""
)
def report_pick_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.timing(enrichments.pick_drop_enriched(spark, sf_dir, {"dropped_hu_created_at"}), F.month("picked_at"), "dropped_hu_created_at", "picked_at")


@query(
    f"""{_PICKS} SELECT sku_brand, sku_tag1, count(*) AS n, sum(picked_qty) AS quantity, count(DISTINCT picked_sku_id) AS items, round(sum(picked_qty * sku_l0_weight), 2) AS weight FROM p
    WHERE picked_qty > 0 AND sku_l0_weight > 0 GROUP BY 1, 2"""
)
def report_brand_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.loads(enrichments.pick_drop_enriched(spark, sf_dir, {"sku_brand", "sku_tag1", "sku_l0_weight"}), ["sku_brand", "sku_tag1"], "picked_qty", "sku_l0_weight", "picked_sku_id")


@query(
    f"""{_WORK} SELECT hu_id, hu_state, count(*) AS n, min(event_timestamp) AS first, max(event_timestamp) AS last, count(DISTINCT sku_id) AS items,
    date_diff('minute', min(event_timestamp), max(event_timestamp)) AS minutes FROM p GROUP BY 1, 2 HAVING count(*) >= 5"""
)
def report_work_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sessions(enrichments.workstation_enriched(spark, sf_dir, {"hu_state"}), ["hu_id", "hu_state"], "event_timestamp", "sku_id")


@query(
    f"""{_WORK} SELECT hu_id, hu_code, count(*) AS n, count(DISTINCT bin_id) AS n_places, min(event_timestamp) AS first, max(event_timestamp) AS last,
    array_to_string(list_sort(list_distinct(list(CAST(bin_id AS VARCHAR)))), ' -> ') AS path FROM p WHERE hu_code <> '' GROUP BY 1, 2 HAVING count(*) >= 3"""
)
def report_unit_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.movements(enrichments.workstation_enriched(spark, sf_dir, {"hu_code"}).where("hu_code <> ''"), ["hu_id", "hu_code"], "bin_id", "event_timestamp", 3)


def _position(spark: SparkSession, sf_dir: str, at: dt.datetime) -> DataFrame:
    return stored_snapshots(spark, sf_dir).position(snapshots.reader(_events(spark, sf_dir), "ts"), at)


def _position_sql(at: dt.datetime) -> str:
    return f"SELECT user_id, event_type, sum({SIGNED}) AS quantity, max(ts) AS last_ts, arg_max(props, (ts, event_id)) AS props FROM events WHERE ts <= TIMESTAMP '{at}' GROUP BY ALL HAVING abs(sum({SIGNED})) > 1e-9"


_WEEK_BEFORE = TARGET - dt.timedelta(days=7)
_ONE = "SELECT '{}' AS period, count(*) AS positions, round(coalesce(sum(quantity), 0.0), 2) AS quantity, count(DISTINCT user_id) AS items FROM ({}) WHERE quantity > 0"


@query(f"{_ONE.format('now', _position_sql(TARGET))} UNION ALL {_ONE.format('week before', _position_sql(_WEEK_BEFORE))}")
def report_stock_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two positions, each from its own stored snapshot."""
    return reports.compared({"now": _position(spark, sf_dir, TARGET), "week before": _position(spark, sf_dir, _WEEK_BEFORE)}, "quantity", "user_id")


@query(
    f"""SELECT user_id, props, count(*) AS positions, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS places, min(last_ts) AS first_change, max(last_ts) AS last_change, round(sum(quantity), 2) AS quantity
    FROM ({_position_sql(TARGET)}) WHERE quantity > 0 GROUP BY 1, 2 HAVING sum(quantity) > 100"""
)
def report_batch_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.spread(_position(spark, sf_dir, TARGET), ["user_id", "props"], "quantity", "event_type", "last_ts", 100)


def _mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as mappings of areas: a row ties an area (one per customer) of a site to a location, with two switches and times of its life."""
    customer, orders = read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "orders")
    life = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("created"), F.max("o_orderdate").alias("updated"), F.max(F.when(F.col("o_totalprice") > 400000, F.col("o_orderdate"))).alias("ended"))
    return customer.join(life, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_nationkey").alias("site"), F.col("c_custkey").alias("area"), F.col("c_mktsegment").alias("quality"), F.substring("c_name", -1, 1).alias("location"),
        (F.col("c_acctbal") > 3000).alias("visible"), (F.col("c_acctbal") < 6000).alias("feeds"), "created", "updated", "ended",
    )


_MAP = """WITH m AS (SELECT c_nationkey AS site, c_custkey AS area, c_mktsegment AS quality, right(c_name, 1) AS location, c_acctbal > 3000 AS visible, c_acctbal < 6000 AS feeds, created, updated, ended FROM customer
    JOIN (SELECT o_custkey, min(o_orderdate) AS created, max(o_orderdate) AS updated, max(CASE WHEN o_totalprice > 400000 THEN o_orderdate END) AS ended FROM orders GROUP BY 1) ON o_custkey = c_custkey)"""


@query(
    f"""{_MAP} SELECT site, quality, count(*) AS n, count(*) FILTER (visible) AS n_visible, count(*) FILTER (feeds) AS n_feeding, round(avg(CASE WHEN visible THEN 1.0 ELSE 0.0 END), 4) AS visible_rate,
    round(avg(CASE WHEN feeds THEN 1.0 ELSE 0.0 END), 4) AS feeding_rate, count(DISTINCT area) AS n_area, count(DISTINCT location) AS n_location, string_agg(DISTINCT location, ', ' ORDER BY location) AS location_list FROM m WHERE ended IS NULL GROUP BY 1, 2"""
)
def report_mapping_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.mapping_summary(_mappings(spark, sf_dir).where("ended IS NULL"), ["site", "quality"], "visible", "feeds", ["area", "location"], "location")


@query(
    f"""{_MAP}, s AS (SELECT CASE WHEN visible AND feeds THEN 'full' WHEN visible THEN 'visible only' WHEN feeds THEN 'feed only' ELSE 'none' END AS status FROM m)
    SELECT status, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percent FROM s GROUP BY 1"""
)
def report_mapping_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.share(_mappings(spark, sf_dir).withColumn("status", reports.mapping_status("visible", "feeds")), "status")


_NOW, _SINCE = "1999-01-01", "1998-06-01"


@query(
    f"""{_MAP} SELECT site, area, created, updated, ended, CASE WHEN ended IS NOT NULL THEN 'ended' WHEN updated > created THEN 'updated' ELSE 'created' END AS change,
    date_diff('day', coalesce(updated, created), TIMESTAMP '{_NOW}') AS age_days, greatest(created, updated, coalesce(ended, TIMESTAMP '1970-01-01')) AS touched FROM m
    WHERE greatest(created, updated, coalesce(ended, TIMESTAMP '1970-01-01')) >= TIMESTAMP '{_SINCE}'"""
)
def report_mapping_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    now, since = (F.lit(t).cast("timestamp_ntz") for t in (_NOW, _SINCE))
    return reports.changes(_mappings(spark, sf_dir), "created", "updated", "ended", since, now).select("site", "area", "created", "updated", "ended", "change", "age_days", "touched")


@query(
    f"""{_MAP} SELECT area, location, visible, round(sum(o_totalprice), 2) AS quantity, count(*) AS positions FROM (SELECT c_nationkey AS site, o_custkey AS area, o_totalprice FROM orders LEFT JOIN customer ON c_custkey = o_custkey) o
    LEFT JOIN (SELECT * FROM m WHERE ended IS NULL) USING (site, area) GROUP BY 1, 2, 3"""
)
def report_stock_by_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer")
    stock = orders.join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey", "left").select(F.col("c_nationkey").alias("site"), F.col("o_custkey").alias("area"), "o_totalprice")
    return reports.stock_by_mapping(stock, _mappings(spark, sf_dir), ["site", "area"], ["location", "visible"], "ended", "o_totalprice")


@query(
    f"""{_BINS} SELECT area, zone, bin_mapping, count(*) AS bins, count(*) FILTER (quantity IS NOT NULL) AS occupied, sum(quantity) AS capacity, min(quantity) AS least, max(quantity) AS most,
    round(count(*) FILTER (quantity IS NOT NULL) * 100.0 / count(*), 2) AS rate FROM b GROUP BY 1, 2, 3"""
)
def report_zone_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.occupancy(retail.bin_master_join(spark, sf_dir), ["area", "zone", "bin_mapping"], F.col("quantity").isNotNull(), "quantity")


@query(f"SELECT user_id, count(*) AS n, count(DISTINCT event_type) AS n_places, min(ts) AS first, max(ts) AS last, array_to_string(list_sort(list_distinct(list(event_type))), ' -> ') AS path FROM events WHERE ts <= TIMESTAMP '{AS_OF}' GROUP BY 1 HAVING count(*) >= 10")
def report_user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.movements(read_table(spark, sf_dir, "events").where(F.col("ts") <= F.lit(AS_OF)), ["user_id"], "event_type", "ts", 10)

"""Queries of streams, stored snapshots, table layouts and JSON merges; each stream's result equals the batch it stands for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json_text
from ..functions.times import add_days, parse_lenient
from ..operators import backfill, enrich, monitoring, snapshots
from ..sources import lifecycle, storage, tables
from ..sources.shared import shared_path
from ..sources.tables import read_table
from ..streaming import enrichment, keyed_log, sink, upserts
from .stock import ATTRS, KEYS, SIGNED, SNAP, TARGET, _events, stored_snapshots

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
CELLS = ("l_quantity", "l_extendedprice", "l_discount")


def query(oracle: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = oracle
        return f

    return add


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's files as they come. The pattern stands for a single file as well as for a folder of files."""
    schema = read_table(spark, sf_dir, name).schema
    return upserts.change_stream(spark, f"{sf_dir}/{name}.parque[t]", schema, 8)


_PIVOT = ", ".join(f'max(CASE WHEN l_linenumber = {k} THEN {a} END) AS "{k}_{a}"' for k in range(1, 5) for a in CELLS)


@query(f"SELECT l_partkey, {_PIVOT}, min(l_shipdate) AS created_at, max(l_shipdate) AS updated_at FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_partkey")
def stream_uom_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as they come, one row per part with a cell per line number: changed parts go to a log, which is read as the latest per part."""
    path = shared_path(spark, "uom-pivot")
    pivot = keyed_log.pivot(_stream(spark, sf_dir, "lineitem"), "l_partkey", "l_linenumber", list(CELLS), (1, 2, 3, 4), "l_shipdate", "l_shipdate", F.col("l_returnflag") != "R")
    keyed_log.append(pivot, path, f"{path}/checkpoint").awaitTermination()
    return keyed_log.latest(spark, path, ["l_partkey"])


@query(
    """SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) = 1"""
)
def stream_latest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The continuous latest row per part and supplier, whole rows by one max_by in update mode."""
    path = shared_path(spark, "latest-view")
    columns = ["l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"]
    view = upserts.latest_view(_stream(spark, sf_dir, "lineitem").select(*columns), ["l_partkey", "l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"])
    keyed_log.append(view, path, f"{path}/checkpoint").awaitTermination()
    keyed_log.compact(spark, path, ["l_partkey", "l_suppkey"])
    return keyed_log.latest(spark, path, ["l_partkey", "l_suppkey"])


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, coalesce(o_custkey, 0) AS custkey, coalesce(o_orderpriority, '') AS priority, coalesce(p_name, '') AS part, coalesce(p_brand, '') AS brand,
    coalesce(CASE WHEN s_acctbal <> 0 THEN s_acctbal END, coalesce(p_retailprice, 0.0)) AS price, coalesce(s_name, '') AS supplier, coalesce(s_nationkey, 0) AS supp_nation, coalesce(n_name, '') AS nation, coalesce(c_name, '') AS customer
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 1000) s ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN customer ON o_custkey = c_custkey"""
)
def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines enriched by five joins per micro-batch, a supplier's balance over the part's price; what finds no part waits and is tried again."""
    path = shared_path(spark, "stream-enrich")

    def dimensions() -> list[enrich.Dimension]:
        orders, part, supplier, nation, customer = (read_table(spark, sf_dir, t) for t in ("orders", "part", "supplier", "nation", "customer"))
        return [
            enrich.Dimension(orders, {"l_orderkey": "o_orderkey"}, {"o_custkey": "custkey", "o_orderpriority": "priority"}),
            enrich.Dimension(part, {"l_partkey": "p_partkey"}, {"p_name": "part", "p_brand": "brand", "p_retailprice": "price"}),
            enrich.Dimension(supplier, {"l_suppkey": "s_suppkey"}, {"s_name": "supplier", "s_nationkey": "supp_nation"}, where="s_acctbal > 1000", overrides={"s_acctbal": "price"}),
            enrich.Dimension(nation, {"supp_nation": "n_nationkey"}, {"n_name": "nation"}),
            enrich.Dimension(customer, {"custkey": "c_custkey"}, {"c_name": "customer"}),
        ]

    lines = _stream(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    enrichment.start(lines, dimensions, path, f"{path}/checkpoint", ["part", "priority"]).awaitTermination()
    return enrichment.latest(spark, path, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])


@query(
    """WITH j AS (SELECT event_type, CASE WHEN event_id % 50 = 0 THEN 'malformed' WHEN event_id % 50 = 1 THEN 'no user_id' WHEN value < 1 THEN 'too small' WHEN event_type = 'error' AND value > 99 THEN 'too large' END AS reason, value FROM events)
    SELECT CASE WHEN reason = 'malformed' THEN '' ELSE event_type END AS event_type, coalesce(reason, '') AS reason, count(*) AS n, round(sum(CASE WHEN reason = 'malformed' THEN 0 ELSE value END), 2) AS total FROM j GROUP BY 1, 2"""
)
def stream_sink_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON text of a topic, some cut short and some without a user: good rows to the table, rejects with a reason to the dead letters."""
    path, batching = shared_path(spark, "sink"), sink.Batching(rows=200_000, files=8)
    events = _stream(spark, sf_dir, "events")
    user = F.when(F.col("event_id") % 50 != 1, F.col("user_id"))
    text = F.to_json(F.struct("event_id", user.alias("user_id"), "event_type", "value", F.lit("c").alias("__op")))
    topic = events.select(F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("{"), text)).otherwise(text).alias("value"))
    rows = sink.decoded(topic, "event_id bigint, user_id bigint, event_type string, value double, __op string")
    rules = {"too small": F.col("value") < 1, "too large": (F.col("event_type") == "error") & (F.col("value") > 99)}
    sink.start(rows, f"{path}/table", f"{path}/dead", f"{path}/checkpoint", ["user_id"], rules, 0.2, batching).awaitTermination()
    good = spark.read.parquet(f"{path}/table").select("event_type", F.lit("").alias("reason"), "value")
    dead = spark.read.parquet(f"{path}/dead").select(F.coalesce("event_type", F.lit("")).alias("event_type"), F.col("_reason").alias("reason"), F.coalesce("value", F.lit(0.0)).alias("value"))
    return good.unionByName(dead).groupBy("event_type", "reason").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


_DUE = "SELECT unnest(generate_series(date_trunc('day', min(ts)), max(ts), INTERVAL 168 HOUR)) AS snapshot_ts FROM events"


@query(
    f"""WITH due AS ({_DUE}) SELECT snapshot_ts, user_id, event_type, round(sum({SIGNED}), 2) AS quantity, count(*) AS event_count, max(ts) AS last_ts, arg_max(event_id, (ts, event_id)) AS last_id,
    arg_max(props, (ts, event_id)) AS props FROM due JOIN events ON ts <= snapshot_ts GROUP BY snapshot_ts, user_id, event_type HAVING abs(sum({SIGNED})) > 1e-9"""
)
def snapshot_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly snapshots, each from the one before and the week's events; a second run of the loop finds nothing to do."""
    events = _events(spark, sf_dir)
    store = snapshots.SnapshotStore(spark, shared_path(spark, "snapshots"), snapshots.Measure(KEYS, "qty", "ts", "event_id", ATTRS))
    due = store.due(events, 168)
    read = snapshots.reader(events, "ts")
    store.build(read, due)
    if store.build(read, due):
        raise AssertionError("a second run built snapshots again")
    return store.all().withColumn("quantity", F.round("quantity", 2))


@query(
    f"""WITH due AS (SELECT snapshot_ts, lag(snapshot_ts) OVER (ORDER BY snapshot_ts) AS base_ts, row_number() OVER (ORDER BY snapshot_ts) AS k FROM ({_DUE}))
    SELECT snapshot_ts, base_ts, (SELECT count(*) FROM events WHERE ts <= snapshot_ts AND (base_ts IS NULL OR ts > base_ts)) AS n_events, k > 2 AS missing, CASE WHEN k > 2 THEN CAST((k - 3) // 2 + 1 AS INTEGER) END AS batch FROM due"""
)
def snapshot_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the loop would build when the first two snapshots are there, two to a batch."""
    events = _events(spark, sf_dir)
    store = snapshots.SnapshotStore(spark, shared_path(spark, "dry-run"), snapshots.Measure(KEYS, "qty", "ts", "event_id", ATTRS))
    due = store.due(events, 168)
    store.build(snapshots.reader(events, "ts"), due, most=2)
    return store.plan(events, due, batch=2)


@query(
    """SELECT o_orderkey, o_custkey, o_orderpriority, count(l_linenumber) AS n_lines, round(coalesce(sum(l_quantity), 0), 2) AS quantity, round(coalesce(sum(l_extendedprice), 0), 2) AS price
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey, o_orderpriority"""
)
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines in buckets of the order: joined and counted by order without a shuffle."""
    orders, lines = bucketed_facts(spark, sf_dir)
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    out = joined.groupBy("o_orderkey", "o_custkey", "o_orderpriority")
    return out.agg(F.count("l_linenumber").alias("n_lines"), F.round(F.coalesce(F.sum("l_quantity"), F.lit(0.0)), 2).alias("quantity"), F.round(F.coalesce(F.sum("l_extendedprice"), F.lit(0.0)), 2).alias("price"))


def bucketed_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two fact tables in buckets of their join key. Sizes of buckets, not their number, should stay the same as tables grow."""
    buckets, base = int(spark.conf.get("spark.sql.shuffle.partitions")), shared_path(spark, "bucketed")
    name = base.rsplit("-", 1)[1]
    orders = lifecycle.write_bucketed(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), f"orders_{name}", f"{base}/orders", ["o_orderkey"], buckets)
    lines = lifecycle.write_bucketed(read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), f"lines_{name}", f"{base}/lines", ["l_orderkey"], buckets)
    return orders, lines


@query(
    """SELECT strftime(o_orderdate, '%Y%m') AS ym, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders, (SELECT max(o_orderdate) AS hi FROM orders)
    WHERE date_trunc('month', o_orderdate) > date_trunc('month', hi) - INTERVAL 36 MONTH GROUP BY 1"""
)
def partition_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month, of which the last 36 months stay."""
    path, orders = shared_path(spark, "retention"), read_table(spark, sf_dir, "orders")
    tables.write_by_month(orders, path, "o_orderdate", ["o_orderkey"])
    lifecycle.expire_months(spark, path, 36, orders.agg(F.max("o_orderdate")).first()[0].date())
    kept = spark.read.option("basePath", path).parquet(path)
    return kept.groupBy(F.col("ym").cast("string").alias("ym")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


_BASE = """'{"t":"' || event_type || '","n":{"v":' || CAST(value AS VARCHAR) || ',"u":' || user_id || ',"d":{"x":' || event_id || ',"y":[1,{"q":null}]}},"p":' || props || ',"z":null}'"""
_PATCH = """CASE event_id % 5 WHEN 0 THEN '{"n":{"u":null,"d":{"x":null,"w":true}}}' WHEN 1 THEN '{"p":{"k":"text","more":{"a":1}},"t":null}'
    WHEN 2 THEN '{"n":7,"new":{"deep":{"er":{"k":' || user_id || '}}}}' WHEN 3 THEN props ELSE '{"t":{"was":"text"},"n":{"d":[1,2]}}' END"""
_PATHS = {"t": "$.t", "was": "$.t.was", "n_v": "$.n.v", "n_u": "$.n.u", "d_x": "$.n.d.x", "d_w": "$.n.d.w", "d_q": "$.n.d.y[0]", "p_k": "$.p.k", "p_a": "$.p.more.a", "deep": "$.new.deep.er.k", "k": "$.k"}


@query(f"WITH m AS (SELECT event_id, json_merge_patch(({_BASE})::JSON, ({_PATCH})::JSON) AS j FROM events) SELECT event_id, " + ", ".join(f"json_extract_string(j, '{p}') AS {c}" for c, p in _PATHS.items()).replace("json_extract_string(j, '$.n.v')", "CAST(json_extract_string(j, '$.n.v') AS DOUBLE)") + ", json_type(j, '$.n') = 'OBJECT' AS n_object, CAST(len(json_keys(j)) AS INTEGER) AS n_members FROM m")
def json_merge_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents patched at several depths: members replaced, deleted, added, objects over values and values over objects."""
    e = read_table(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    base = F.concat(F.lit('{"t":"'), "event_type", F.lit('","n":{"v":'), F.col("value").cast("string"), F.lit(',"u":'), F.col("user_id").cast("string"), F.lit(',"d":{"x":'), number, F.lit(',"y":[1,{"q":null}]}},"p":'), "props", F.lit(',"z":null}'))
    deep = F.concat(F.lit('{"n":7,"new":{"deep":{"er":{"k":'), F.col("user_id").cast("string"), F.lit("}}}}"))
    k = F.col("event_id") % 5
    patch = (
        F.when(k == 0, '{"n":{"u":null,"d":{"x":null,"w":true}}}').when(k == 1, '{"p":{"k":"text","more":{"a":1}},"t":null}')
        .when(k == 2, deep).when(k == 3, F.col("props")).otherwise('{"t":{"was":"text"},"n":{"d":[1,2]}}')
    )
    merged = e.select("event_id", json_text.merge_patch(base, patch).alias("j"))
    shape = json_text.kind(F.get_json_object("j", "$.n"))
    return merged.select("event_id", *[F.get_json_object("j", p).cast("double" if c == "n_v" else "string").alias(c) for c, p in _PATHS.items()], (shape == "Object").alias("n_object"), F.size(F.json_object_keys("j")).alias("n_members"))


@query(
    """SELECT event_id, json_extract_string(j, '$.ABC') AS abc, json_extract_string(j, '$.x') AS x, json_extract_string(j, '$.k') AS k FROM (SELECT event_id, json_merge_patch(
      (CASE WHEN event_id % 2 = 0 THEN '{"ABC":"' || event_type || '","x":"1"}' ELSE '{}' END)::JSON, (CASE WHEN event_id % 3 = 0 THEN '{"ABC":"own"}' WHEN event_id % 3 = 1 THEN props ELSE '{}' END)::JSON) AS j FROM events)"""
)
def combined_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product's classifications (arrays of type and value, or 'null') with the own ones merged over them."""
    e = read_table(spark, sf_dir, "events")
    product = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('[{"type":"ABC","value":"'), "event_type", F.lit('"},{"type":"x","value":"1"}]'))).otherwise("null")
    own = F.when(F.col("event_id") % 3 == 0, '[{"type":"ABC","value":"old"},{"type":"ABC","value":"own"}]').when(F.col("event_id") % 3 == 1, F.col("props")).otherwise("")
    merged = e.select("event_id", json_text.combined_classification(product, own).alias("j"))
    return merged.select("event_id", *[F.get_json_object("j", f"$.{n}").alias(c) for c, n in (("abc", "ABC"), ("x", "x"), ("k", "k"))])


@query(
    " UNION ALL ".join(f"SELECT 'default' AS database, '{c}' AS column_name, count(*) AS n_values, count(*) - count({c}) AS n_nulls, true AS is_compressed FROM lineitem" for c in ("l_orderkey", "l_quantity", "l_shipdate", "l_returnflag"))
)
def storage_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values, nulls and bytes of columns, from the footers of the table's files."""
    found = storage.usage(storage.footers(spark, f"{sf_dir}/lineitem.parquet")).where(F.col("column").isin("l_orderkey", "l_quantity", "l_shipdate", "l_returnflag"))
    return found.select(F.current_database().alias("database"), F.col("column").alias("column_name"), "n_values", "n_nulls", (F.col("compressed") > 0).alias("is_compressed"))


@query("SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, count(*) AS n, round(sum(o_totalprice), 2) AS total, min(o_orderdate) + INTERVAL 30 DAY AS first_due FROM orders GROUP BY 1")
def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    months = orders.groupBy(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month"))
    return months.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), add_days(F.min("o_orderdate"), 30).alias("first_due"))


@query(
    """SELECT event_id, CASE event_id % 6 WHEN 5 THEN NULL WHEN 1 THEN date_trunc('day', ts) WHEN 2 THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END AS parsed FROM events"""
)
def lenient_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written in several layouts, one of them no time at all."""
    events, k = read_table(spark, sf_dir, "events"), F.col("event_id") % 6
    written = lambda layout: F.date_format("ts", layout)
    text = (
        F.when(k == 0, written("yyyy-MM-dd HH:mm:ss")).when(k == 1, written("dd.MM.yyyy")).when(k == 2, written("yyyyMMdd"))
        .when(k == 3, F.concat(written("yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).when(k == 4, F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")).otherwise("soon")
    )
    return events.select("event_id", parse_lenient(text).alias("parsed"))


@query(
    """SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS nations, string_agg(CASE WHEN n_name < 'J' THEN n_name END, ', ' ORDER BY n_name) AS early, count(*) AS n FROM nation GROUP BY n_regionkey"""
)
def string_agg_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain and conditional string aggregation, in order."""
    nation = read_table(spark, sf_dir, "nation")
    joined = lambda c: F.nullif(F.array_join(F.array_sort(F.collect_list(c)), ", "), F.lit(""))
    return nation.groupBy("n_regionkey").agg(joined(F.col("n_name")).alias("nations"), joined(F.when(F.col("n_name") < "J", F.col("n_name"))).alias("early"), F.count(F.lit(1)).alias("n"))


_PROBED = {"at_snapshot": SNAP, "a_week_later": TARGET}


@query(" UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n_rows, true AS timed FROM (SELECT user_id, event_type FROM events WHERE ts <= TIMESTAMP '{at}' GROUP BY ALL HAVING abs(sum({SIGNED})) > 1e-9)" for name, at in _PROBED.items()))
def position_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times positions right at a stored snapshot and a week after it."""
    store, read = stored_snapshots(spark, sf_dir), snapshots.reader(_events(spark, sf_dir), "ts")
    found = monitoring.probe(spark, {name: lambda at=at: store.position(read, at) for name, at in _PROBED.items()})
    return found.select("name", "n_rows", (F.col("best_s") > 0).alias("timed"))


@query(
    """SELECT strftime(l_shipdate, '%Y') || '12' AS ym, CASE WHEN year(l_shipdate) < 1994 THEN count(*) ELSE 0 END AS before, count(*) AS staging, count(*) AS after FROM lineitem WHERE month(l_shipdate) = 12 GROUP BY year(l_shipdate), strftime(l_shipdate, '%Y')"""
)
def backfill_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Decembers of all years backfilled over those that were enriched before: counts of each month before and after."""
    path, lines, part = shared_path(spark, "backfill"), read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part")
    december = lines.where(F.month("l_shipdate") == 12)
    star = lambda rows: enrich.enrich(rows, [enrich.Dimension(part, {"l_partkey": "p_partkey"}, {"p_name": "part", "p_brand": "brand"})])
    backfill.backfill(spark, december.where(F.year("l_shipdate") < 1994), "l_shipdate", f"{path}/table", star, f"{path}/first", months_per_job=12)
    return backfill.backfill(spark, december, "l_shipdate", f"{path}/table", star, f"{path}/second", months_per_job=12)


@query(
    """SELECT o_orderkey, o_custkey, l_linenumber, l_partkey, p_name, s_name FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
    WHERE o_totalprice > 400000 AND o_orderpriority = '1-URGENT'"""
)
def debug_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some orders with all that hangs on them; the filter reaches the orders' scan before any join."""
    orders, lines, part, supplier = (read_table(spark, sf_dir, t) for t in ("orders", "lineitem", "part", "supplier"))
    found = orders.where("o_totalprice > 400000 AND o_orderpriority = '1-URGENT'")
    out = found.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(part, F.col("p_partkey") == F.col("l_partkey"), "left").join(supplier, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    return out.select("o_orderkey", "o_custkey", "l_linenumber", "l_partkey", "p_name", "s_name")

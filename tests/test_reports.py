"""Reports on rows with sentinels, nulls, ties and without any row."""

import datetime as dt

from pyspark.sql import functions as F

from stockyard.operators import reports
from stockyard.streaming import keyed_log, upserts

EPOCH, DAY = dt.datetime(1970, 1, 1), dt.datetime(2024, 3, 1, 23, 59, 30)
EVENTS = "worker string, item bigint, qty double, start timestamp_ntz, done timestamp_ntz"


def events(spark):
    hour = dt.timedelta(hours=1)
    rows = [("a", 1, 2.0, DAY, DAY + hour), ("a", 2, 4.0, DAY - 24 * hour, DAY), ("a", 1, 0.0, EPOCH, DAY), ("b", 2, 1.0, DAY, EPOCH), ("b", 3, 1.0, DAY, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, EVENTS)


def test_productivity_leaves_sentinels_out(spark):
    got = reports.productivity(events(spark), ["worker"], "done", "qty", 2).collect()
    assert [(r.worker, r.n, r.quantity, r.days, r.per_event, r.per_day) for r in got] == [("a", 3, 6.0, 2, 2.0, 1.5)]


def test_frequency_breaks_ties_by_item(spark):
    got = reports.frequency(events(spark), ["item"], "qty", "worker", 2).collect()
    assert [(r.item, r.n, r.n_others) for r in got] == [(2, 2, 2), (1, 1, 1)]
    assert reports.frequency(events(spark).where("false"), ["item"], "qty", "worker", 2).count() == 0


def test_timing_and_sessions(spark):
    got = reports.timing(events(spark), F.hour("done"), "start", "done").collect()
    assert {(r.part, r.n, r.mean_seconds) for r in got} == {(0, 1, 3600.0), (23, 1, 86400.0)}
    (one,) = reports.sessions(events(spark).where("worker = 'b' OR item = 2"), ["item"], "start", "worker", 2).collect()
    assert (one.item, one.n, one.items, one.minutes) == (2, 2, 2, 1440)


def test_compared_gives_a_row_for_an_empty_period(spark):
    rows = events(spark)
    got = {r.period: (r.positions, r.quantity, r["items"]) for r in reports.compared({"now": rows, "then": rows.where("false")}, "qty", "item").collect()}
    assert got == {"now": (4, 8.0, 3), "then": (0, 0.0, 0)}


def test_mapping_status_counts_a_missing_switch_as_off(spark):
    rows = spark.createDataFrame([(True, True), (True, None), (None, True), (False, False)], "v boolean, f boolean")
    assert [r.s for r in rows.select(reports.mapping_status("v", "f").alias("s")).collect()] == ["full", "visible only", "feed only", "none"]
    shares = {r.v: r.percent for r in reports.share(rows, "v").collect()}
    assert shares == {True: 50.0, None: 25.0, False: 25.0}


def test_changes_and_stock_of_mappings(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    rows = [("s", 1, "x", t(1), t(9), None), ("s", 2, "y", t(8), t(8), None), ("s", 3, "z", t(1), t(2), t(9)), ("s", 4, "w", t(1), t(2), None)]
    mappings = spark.createDataFrame(rows, "site string, area int, loc string, created timestamp_ntz, updated timestamp_ntz, ended timestamp_ntz")
    since, now = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-05", "2024-01-10"))
    assert {(r.area, r.change, r.age_days) for r in reports.changes(mappings, "created", "updated", "ended", since, now).collect()} == {(1, "updated", 1), (2, "created", 2), (3, "ended", 8)}
    stock = spark.createDataFrame([("s", 1, 5.0), ("s", 1, 1.0), ("s", 3, 2.0), (None, None, 4.0)], "site string, area int, qty double")
    got = {(r.area, r["loc"], r.quantity, r.positions) for r in reports.stock_by_mapping(stock, mappings, ["site", "area"], ["loc"], "ended", "qty").collect()}
    assert got == {(1, "x", 6.0, 2), (3, None, 2.0, 1), (None, None, 4.0, 1)}


def test_a_single_batch_takes_all_files_at_once(spark, tmp_path):
    rows = spark.range(40).select((F.col("id") % 4).alias("k"), "id")
    rows.repartition(6).write.parquet(str(tmp_path / "in"))
    counts = upserts.change_stream(spark, str(tmp_path / "in"), rows.schema, 1).groupBy("k").count()
    keyed_log.append(counts, f"file:{tmp_path}/out", f"file:{tmp_path}/cp", single=True).awaitTermination()
    assert {(r.k, r["count"], r._batch) for r in keyed_log._rows(spark, f"file:{tmp_path}/out")[0].collect()} == {(k, 10, 0) for k in range(4)}

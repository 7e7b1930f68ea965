import datetime as dt
import time
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import functions as F

from stockyard.sources import tables
from stockyard.streaming import ttl_join, upserts

SCHEMA = "id string, v int, ts timestamp_ntz, note string"


def _rows(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_month_partitions_prune_and_bound(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [dt.datetime(2024, m, 15) for m in (1, 2, 3)]
    tables.write_by_month(_rows(spark, *((f"k{d.month}", 1, d, "") for d in days)), path, "ts", ["id", "ts"])
    df = tables.read_by_month(spark, path, "ts", days[0], days[1])
    assert [r.id for r in df.collect()] == ["k2"]
    assert "PartitionFilters: [isnotnull" in df._jdf.queryExecution().toString()


def test_upsert_stream_keeps_latest_and_quarantines(spark, tmp_path):
    src, out, bad = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "bad")
    jan = dt.datetime(2024, 1, 1)
    _rows(spark, ("a", 1, jan, "old"), ("b", 1, jan, "b")).write.mode("append").parquet(src)
    stream = lambda: upserts.upsert_by_month(upserts.change_stream(spark, src, spark.read.parquet(src).schema), out, ["id"], [F.col("v")], "ts", str(tmp_path / "cp"), required=["id", "ts"], quarantine=bad)
    stream().awaitTermination()
    _rows(spark, ("a", 2, jan, "new"), (None, 1, jan, "lost")).write.mode("append").parquet(src)
    stream().awaitTermination()
    assert sorted((r.id, r.v, r.note) for r in spark.read.parquet(out).collect()) == [("a", 2, "new"), ("b", 1, "b")]
    assert [r.note for r in spark.read.parquet(bad).collect()] == ["lost"]
    tables.compact(spark, out, ["id"], [F.col("v")])
    assert spark.read.parquet(out).count() == 2


def test_enriched_stream_and_router(spark, tmp_path):
    src = str(tmp_path / "src")
    _rows(spark, ("a", 1, dt.datetime(2024, 1, 1), "x"), ("b", 2, dt.datetime(2024, 1, 1), "y")).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    upserts.enriched_stream(stream, lambda b: b.withColumn("more", F.upper("note")), str(tmp_path / "e"), str(tmp_path / "c1")).awaitTermination()
    assert sorted(r.more for r in spark.read.parquet(str(tmp_path / "e")).collect()) == ["X", "Y"]
    upserts.route(stream, "note", {"x": str(tmp_path / "x")}, str(tmp_path / "c2"), str(tmp_path / "rest")).awaitTermination()
    assert [r.id for r in spark.read.parquet(str(tmp_path / "x")).collect()] == ["a"]
    assert [r.id for r in spark.read.parquet(str(tmp_path / "rest")).collect()] == ["b"]


def test_tumbling_stream_equals_batch(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    aggs = [F.count(F.lit(1)).alias("n")]
    events.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    q = upserts.tumbling(stream, "ts", ["event_type"], "1 day", aggs).writeStream.format("memory").queryName("tumbled").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = upserts.tumbling(events, "ts", ["event_type"], "1 day", aggs)
    assert sorted(map(str, spark.table("tumbled").collect())) == sorted(map(str, batch.collect()))


def test_left_join_with_ttl(spark, tmp_path):
    left = spark.createDataFrame([("k1", 1, "l1"), ("k2", 1, "l2"), ("k1", 2, "l1b")], "k string, v bigint, x string")
    right = spark.createDataFrame([("k1", 5, "r1"), ("k3", 1, "r3")], "k string, v bigint, y string")
    both = []
    for side, df in (("left", left), ("right", right)):
        path = str(tmp_path / side)
        df.write.parquet(path)
        both.append(ttl_join.tagged(spark.readStream.schema(df.schema).parquet(path), side, "k", "v"))
    # State with a time to live keeps a query busy with empty batches, so it is stopped when its rows are there.
    q = ttl_join.left_join_with_ttl(*both, ttl_ms=3_600_000).writeStream.format("memory").queryName("ttl").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()
    until = time.time() + 60
    while time.time() < until and q.isActive and spark.table("ttl").select("key").distinct().count() < 2:
        time.sleep(0.5)
    q.stop()
    last = {r.key: r for r in spark.table("ttl").orderBy("version").collect()}
    assert set(last) == {"k1", "k2"}
    assert '"l1b"' in last["k1"].left_row and '"r1"' in last["k1"].right_row and last["k2"].right_row is None


class _Kept:
    """A value of the state store that counts its calls."""

    def __init__(self):
        self.row, self.calls = None, 0

    def exists(self):
        self.calls += 1
        return self.row is not None

    def get(self):
        self.calls += 1
        return self.row

    def update(self, row):
        self.calls += 1
        self.row = row


def test_ttl_state_is_called_per_bucket_and_expires_per_key():
    kept = {"left": _Kept(), "right": _Kept()}
    pairs = ttl_join.LatestPairs(1000)
    pairs.init(SimpleNamespace(getValueState=lambda name, schema, ttlDurationMs: kept[name]))

    def arrive(now, *rows):
        for s in kept.values():
            s.calls = 0
        frames = [pd.DataFrame([r], columns=["side", "key", "version", "payload"]) for r in rows]
        out = [r for f in pairs.handleInputRows((0,), iter(frames), SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now)) for r in f.itertuples(index=False)]
        assert all(s.calls <= 2 for s in kept.values())
        return {r.key: (r.version, r.left_row, r.right_row) for r in out}

    many = {f"k{i}": (1, f"l{i}", None) for i in range(500)}
    assert arrive(0, *(("left", k, v, x) for k, (v, x, _) in many.items())) == many
    assert arrive(600, ("left", "k1", 3, "new"), ("left", "k2", 0, "stale"), ("right", "k1", 2, "r"), ("right", "gone", 1, "r")) == {"k1": (3, "new", "r"), "k2": (1, "l2", None)}
    assert arrive(1000, ("right", "k1", 9, "r9"), ("right", "k2", 9, "r9")) == {"k1": (9, "new", "r9")}  # k2 was not renewed by k1, nor by an older version
    assert arrive(1999, ("left", "k2", 1, "back")) == {"k2": (9, "back", "r9")}
    assert arrive(2000, ("left", "k2", 1, "late")) == {"k2": (1, "late", None)}


def test_the_store_of_the_session_comes_back(spark):
    key = ttl_join.PROVIDER
    before = spark.conf.get(key)
    for own in ("org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider", None):
        spark.conf.set(key, own) if own else spark.conf.unset(key)
        was = spark.conf.get(key, None)
        with ttl_join.state_in_rocksdb(spark):
            assert spark.conf.get(key).endswith("RocksDBStateStoreProvider")
        assert spark.conf.get(key, None) == was
    spark.conf.set(key, before)


def test_sinks_and_catalog(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\"b"), (2, None)], "id int, s string")
    assert [r.value for r in tables.as_json_lines(df).collect()] == ['{"id":1,"s":"a\\"b"}', '{"id":2}']
    tables.write_tsv(df.limit(1), str(tmp_path / "tsv"))
    assert [r.value for r in spark.read.text(str(tmp_path / "tsv")).collect()] == ['1\ta"b']
    df.createOrReplaceTempView("cat_view")
    assert ("cat_view", "id") in {(r.table, r.column) for r in tables.catalog(spark).collect()}
    assert tables.without_tombstones(df, "s").count() == 1
    assert tables.without_cdc_columns(df.withColumn("__op", F.lit("u"))).columns == ["id", "s"]

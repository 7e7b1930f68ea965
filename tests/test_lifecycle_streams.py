"""Streams over several micro-batches and restarts, stored snapshots, table lifecycle, limits and the JSON merge."""

import datetime as dt
import json
import random
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from stockyard.functions import json_text, times
from stockyard.operators import backfill, enrich, limits, position, snapshots
from stockyard.plans import enrichments
from stockyard.sources import lifecycle, storage, tables
from stockyard.sources.shared import Files
from stockyard.streaming import control, enrichment, keyed_log, sink, upserts


def rows_of(df):
    return sorted(map(str, df.collect()))


def merged(base, patch):
    """RFC 7396 on Python values."""
    if not isinstance(patch, dict):
        return patch
    out = dict(base) if isinstance(base, dict) else {}
    for k, v in patch.items():
        if v is None:
            out.pop(k, None)
        else:
            out[k] = merged(out.get(k), v)
    return out


def test_merge_patch_is_rfc_7396(spark):
    rng = random.Random(1)

    def value(depth):
        if depth and rng.random() < 0.6:
            return {rng.choice('abcd"é'): value(depth - 1) for _ in range(rng.randint(0, 4))}
        return rng.choice([1, 2.5, "s", "1", None, True, [1, {"q": None}], -3, 'q"x\\'])

    pairs = [(json.dumps(value(4)), json.dumps(value(4))) for _ in range(200)]
    pairs += [('{"a":1}', None), (None, '{"c":"3"}'), ("", "{}"), ("[", '{"a":{"b":null}}'), ('{"a":1,"o":{"x":1,"y":2}}', '{"o":{"x":null}}')]
    found = spark.createDataFrame(pairs, "b string, p string").select("b", "p", json_text.merge_patch(F.col("b"), F.col("p")).alias("m")).collect()

    def loaded(text):
        try:
            return json.loads(text)
        except (TypeError, ValueError):
            return {}

    for r in found:
        assert repr(json.loads(r.m)) == repr(sort(merged(loaded(r.b), loaded(r.p)))), (r.b, r.p)
    assert found[-1].m == '{"a":1,"o":{"y":2}}'


def sort(v):
    if isinstance(v, dict):
        return {k: sort(v[k]) for k in sorted(v)}
    return [sort(x) for x in v] if isinstance(v, list) else v


def test_merge_patch_depth(spark):
    nest = lambda n: '{"a":' * n + "1" + "}" * n
    merge = lambda n: spark.range(1).select(json_text.merge_patch(F.lit(nest(n)), F.lit(nest(n))).alias("m")).first().m
    assert merge(json_text.MERGE_DEPTH) == nest(json_text.MERGE_DEPTH)
    with pytest.raises(Exception, match="nested deeper"):
        merge(json_text.MERGE_DEPTH + 1)


MEASURE = snapshots.Measure(["wh", "item"], "qty", "ts", "id", ["note"])


def stock_events(spark, hours=range(60)):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    rows = [(k, 1 + k % 2, "ab"[k % 3 == 0], float((k * 7) % 5 - 2), t(k), f"n{k}") for k in hours]
    # a key that sums to zero before the second snapshot and comes back after it, and an event that is given twice
    rows += [(900, 9, "z", 5.0, t(1), "in"), (901, 9, "z", -5.0, t(2), "out"), (902, 9, "z", 7.0, t(50), "back"), rows[0]]
    return spark.createDataFrame(rows, "id bigint, wh bigint, item string, qty double, ts timestamp_ntz, note string")


def direct(events, at):
    out = position.build_snapshot(events, at, MEASURE.keys, MEASURE.quantity, MEASURE.ts, MEASURE.event_id, MEASURE.attrs)
    return rows_of(out.select(*MEASURE.keys, "quantity", "event_count", "last_ts", "last_id", "note"))


def test_snapshot_loop_equals_direct_builds(spark, tmp_path):
    events = stock_events(spark)
    store = snapshots.SnapshotStore(spark, f"file:{tmp_path}/snap", MEASURE)
    read = snapshots.reader(events, "ts")
    due = store.due(events, 24)
    assert due == [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    plan = {r.snapshot_ts: r for r in store.plan(events, due, batch=2).collect()}
    assert [plan[d].n_events for d in due] == [2, 26, 24] and [plan[d].batch for d in due] == [1, 1, 2] and store.times() == []
    assert store.build(read, due, most=2) == due[:2]
    assert [r.missing for r in store.plan(events, due).orderBy("snapshot_ts").collect()] == [False, False, True]
    assert store.build(read, due) == due[2:] and store.build(read, due) == []
    stored = store.all()
    for at in due:
        assert rows_of(stored.where(F.col("snapshot_ts") == F.lit(at)).select(*MEASURE.keys, "quantity", "event_count", "last_ts", "last_id", "note")) == direct(events, at)
    for h in (0, 30, 47, 55, 70):  # the zero key counts its three events again at 50
        at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
        assert rows_of(store.position(read, at).select(*MEASURE.keys, "quantity", "event_count", "last_ts", "last_id", "note")) == direct(events, at), h


def test_snapshot_build_survives_crashes_and_late_events(spark, tmp_path, monkeypatch):
    events = stock_events(spark)
    path = f"file:{tmp_path}/snap"
    store, due = snapshots.SnapshotStore(spark, path, MEASURE), [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    read = snapshots.reader(events, "ts")
    store.build(read, due[:1])
    real = Files.create
    monkeypatch.setattr(Files, "create", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.build(read, due)
    monkeypatch.setattr(Files, "create", real)
    assert store.times() == due[:1]  # the data of the second is there, but not committed
    other = snapshots.SnapshotStore(spark, path, MEASURE)
    assert other.build(read, due) == due[1:]
    assert not store._build(read, due[1])  # another builder's commit of that time holds
    late = events.unionByName(stock_events(spark, range(20, 22)).where("id = 20").withColumn("id", F.lit(999).cast("bigint")))
    assert store.invalidate(due[1]) == due[1:]
    again = snapshots.reader(late, "ts")
    assert store.build(again, due) == due[1:]
    assert rows_of(store.position(again, due[2]).select(*MEASURE.keys, "quantity", "event_count", "last_ts", "last_id", "note")) == direct(late, due[2])
    assert "PushedFilters" in store.position(again, due[2])._jdf.queryExecution().toString()


LINES = "sku string, level string, units int, name string, created timestamp_ntz, updated timestamp_ntz, active boolean"


def uoms(spark, n, seed):
    rng = random.Random(seed)
    t = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randint(0, 9999))
    return spark.createDataFrame([(f"s{rng.randint(0, 9)}", rng.choice(["L0", "L1", "L2"]), rng.choice([None, 1, 2, 30]), rng.choice("xyz"), t(), t(), rng.random() < 0.9) for _ in range(n)], LINES)


def test_stream_pivot_over_batches_and_restart(spark, tmp_path):
    src, out = f"file:{tmp_path}/src", f"file:{tmp_path}/out"
    view = lambda df: keyed_log.pivot(df, "sku", "level", ["units", "name"], ("L0", "L1"), "created", "updated", F.col("active"))
    run = lambda: keyed_log.append(view(upserts.change_stream(spark, src, uoms(spark, 1, 0).schema, 1)), out, f"{tmp_path}/cp").awaitTermination()
    for seed in (1, 2):
        uoms(spark, 40, seed).coalesce(1).write.mode("append").parquet(src)
    run()
    assert len(Files(spark).folders(f"{out}/log")) >= 2  # a micro-batch for each file
    assert rows_of(keyed_log.latest(spark, out, ["sku"])) == rows_of(view(spark.read.parquet(src)))
    keyed_log.compact(spark, out, ["sku"])
    assert Files(spark).folders(f"{out}/log") == []
    uoms(spark, 40, 3).coalesce(1).write.mode("append").parquet(src)
    run()  # a new query on the same checkpoint
    assert rows_of(keyed_log.latest(spark, out, ["sku"])) == rows_of(view(spark.read.parquet(src)))
    keyed_log.compact(spark, out, ["sku"])
    keyed_log.compact(spark, out, ["sku"])
    assert rows_of(keyed_log.latest(spark, out, ["sku"])) == rows_of(view(spark.read.parquet(src)))


def test_stream_enrichment_sees_changes_and_repairs_late_rows(spark, tmp_path):
    src, out, dims = f"file:{tmp_path}/src", f"file:{tmp_path}/out", f"{tmp_path}/dim"
    schema = "id bigint, sku string, site bigint, worker string, hu string"
    event = lambda *rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    def put(name, ddl, *rows):
        spark.createDataFrame(rows, ddl).write.mode("overwrite").parquet(f"{dims}/{name}")

    def tables():
        read = lambda n: spark.read.parquet(f"{dims}/{n}")
        return [
            enrich.Dimension(read("sku"), {"sku": "id"}, {"name": "sku_name", "units": "sku_units", "cat": "cat"}, version=("v",)),
            enrich.Dimension(read("own"), {"sku": "sku", "site": "node"}, {}, where="active", overrides={"units": "sku_units"}),
            enrich.Dimension(read("worker"), {"worker": "id"}, {"name": "worker_name"}),
            enrich.Dimension(read("hu"), {"hu": "id"}, {"kind": "hu_kind"}),
            enrich.Dimension(read("cat"), {"cat": "id"}, {"name": "cat_name"}),
        ]

    run = lambda: enrichment.start(upserts.change_stream(spark, src, spark.createDataFrame([], schema).schema, 1), tables, out, f"{tmp_path}/cp", ["sku_name", "worker_name"]).awaitTermination()
    put("sku", "id string, name string, units int, cat string, v int", ("a", "old", 1, "c", 1), ("a", "A", 2, "c", 2))
    put("own", "sku string, node bigint, units int, active boolean", ("a", 5, 50, True), ("a", 6, 60, False))
    put("worker", "id string, name string", ("w", "W"))
    put("hu", "id string, kind string", ("h", "box"))
    put("cat", "id string, name string", ("c", "C"))
    event((1, "a", 5, "w", "h"), (2, "b", 5, "w", None))
    run()
    first = {r.id: r for r in enrichment.latest(spark, out, ["id"]).collect()}
    assert (first[1].sku_name, first[1].sku_units, first[1].cat_name, first[1].hu_kind) == ("A", 50, "C", "box") and first[2].sku_name == ""
    put("sku", "id string, name string, units int, cat string, v int", ("a", "A", 2, "c", 2), ("b", "B", 3, "c", 1))  # b came late
    event((3, "a", 6, "x", None))
    run()
    batch = lambda: rows_of(enrich.enrich(spark.read.parquet(src), tables()))
    assert rows_of(enrichment.latest(spark, out, ["id"])) == batch()
    put("worker", "id string, name string", ("w", "W"), ("x", "X"))
    enrichment.repair(spark, out, tables, ["sku_name", "worker_name"], ["id", "sku", "site", "worker", "hu"])
    assert rows_of(enrichment.latest(spark, out, ["id"])) == batch()
    event((4, "b", 5, "x", "h"))
    run()
    assert rows_of(enrichment.latest(spark, out, ["id"])) == batch()
    pending = Files(spark).folders(f"{out}/pending")[-1]
    assert spark.read.parquet(f"{out}/pending/{pending}").count() == 0


def test_enrichment_takes_the_latest_duplicate(spark):
    events = spark.createDataFrame([(1, "a")], "id int, k string")
    dim = spark.createDataFrame([("a", "x", 2), ("a", "z", 1), ("a", "y", 2)], "k string, name string, v int")
    assert enrich.enrich(events, [enrich.Dimension(dim, {"k": "k"}, {"name": "n"}, version=("v",))]).first().n == "y"
    assert enrich.enrich(events, [enrich.Dimension(dim, {"k": "k"}, {"name": "n"})]).first().n == "z"


def test_sink_dead_letters_and_reject_ratio(spark, tmp_path):
    src, out, dead = f"{tmp_path}/src", f"{tmp_path}/out", f"{tmp_path}/dead"
    put = lambda name, *lines: (tmp_path / "src").mkdir(exist_ok=True) or (tmp_path / "src" / name).write_text("\n".join(lines))
    batching = sink.Batching(rows=3, files=1)

    def run(ratio):
        rows = sink.decoded(sink.source(spark, src, "", batching, "text"), "id bigint, v struct<string: string, long: bigint>, __op string")
        sink.start(rows, out, dead, f"{tmp_path}/cp", ["id"], {"negative": F.col("id") < 0}, ratio, batching).awaitTermination()

    good = [json.dumps({"id": k, "v": {"string": "s"} if k % 2 else {"long": k}, "__op": "u"}) for k in range(8)]
    put("1.json", *good, "{oops", json.dumps({"v": None}), json.dumps({"id": -1}))
    run(0.3)
    table = spark.read.parquet(out)
    assert sorted((r.id, r.v) for r in table.collect()) == [(k, "s" if k % 2 else str(k)) for k in range(8)] and "__op" not in table.columns
    assert max(r["count"] for r in table.groupBy(F.input_file_name()).count().collect()) <= 3
    assert sorted(r._reason for r in spark.read.parquet(dead).collect()) == ["malformed", "negative", "no id"]
    put("2.json", *good[:2], "{oops", "[")
    with pytest.raises(StreamingQueryException, match="2 of 4 rows are rejected"):
        run(0.3)
    assert spark.read.parquet(out).count() == 8 and spark.read.parquet(dead).where("_failed").count() == 2
    run(0.5)  # the same batch again, with more allowed
    assert spark.read.parquet(out).count() == 10 and spark.read.parquet(dead).where("_failed").count() == 0
    put("3.json", *good[:1])
    run(0.0)
    assert spark.read.parquet(out).count() == 11


def test_unions_are_unwrapped(spark):
    df = spark.createDataFrame([((1, None), (None, 2.5), ("x", None), (7, 8))], "a struct<int: int, long: bigint>, b struct<member0: bigint, member1: double>, c struct<string: string, long: bigint>, d struct<x: int, y: int>")
    out = sink.unwrapped(df)
    assert dict(out.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d": "struct<x:int,y:int>"} and tuple(out.first())[:3] == (1, 2.5, "x")


def test_pause_resume_and_refusals(spark, tmp_path):
    src, out = f"file:{tmp_path}/src", f"file:{tmp_path}/out"
    for seed in range(6):
        uoms(spark, 20, seed).coalesce(1).write.mode("append").parquet(src)
    view = lambda df: keyed_log.pivot(df, "sku", "level", ["units"], ("L0", "L1"), "created", "updated")
    begin = lambda cp: keyed_log.append(view(upserts.change_stream(spark, src, uoms(spark, 1, 0).schema, 1)), out, cp, bounded=False, seconds=0)
    registry = control.Registry(spark, f"file:{tmp_path}/jobs")
    job = control.Job("pivot", f"file:{tmp_path}/cp", begin, "pivot of L0 and L1")
    with pytest.raises(control.Refused, match="never started"):
        registry.resume(job)
    query = registry.start(job)
    with pytest.raises(control.Refused, match="is running"):
        registry.start(job)
    with pytest.raises(control.Refused, match="uses the checkpoint"):
        registry.start(control.Job("other", job.checkpoint, begin, "x"))
    while registry.committed(job.checkpoint) is None:
        time.sleep(0.1)
    seen = registry.pause(job, query)
    assert not query.isActive and seen == registry.committed(job.checkpoint)
    assert [tuple(r) for r in registry.status().collect()] == [("pivot", "paused", job.checkpoint, seen, False)]
    with pytest.raises(control.Refused, match="resume it"):
        registry.start(job)
    with pytest.raises(control.Refused, match="has changed"):
        registry.resume(control.Job("pivot", job.checkpoint, begin, "pivot of L0"))
    with pytest.raises(control.Refused, match="no checkpoint"):
        registry.resume(job, f"file:{tmp_path}/nowhere")
    query = registry.resume(job)
    query.processAllAvailable()
    last = registry.pause(job, query)
    assert last >= 5 and rows_of(keyed_log.latest(spark, out, ["sku"])) == rows_of(view(spark.read.parquet(src)))


def test_retention_by_month(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame([(f"{y}{m:02d}", y) for y in (2021, 2022, 2023, 2024) for m in (1, 6, 12)], "ym string, v int").write.partitionBy("ym").parquet(path)
    (tmp_path / "t" / "ym=other").mkdir()
    day = dt.date(2024, 12, 31)
    assert lifecycle.expire_months(spark, path, 36, day, dry_run=True) == ["202101", "202106", "202112"]
    assert spark.read.parquet(f"{path}/ym=202101").count() == 1
    assert lifecycle.expire_months(spark, path, 36, day) == ["202101", "202106", "202112"] and lifecycle.expire_months(spark, path, 36, day) == []
    assert Files(spark).folders(path) == [*(f"ym={y}{m:02d}" for y in (2022, 2023, 2024) for m in (1, 6, 12)), "ym=other"]


@pytest.mark.parametrize("crash", ["copy", "verify", "away", "swap", None])
def test_migration_survives_a_crash_after_each_step(spark, tmp_path, crash):
    path = f"file:{tmp_path}/t"
    spark.createDataFrame([(k, f"p{k % 3}", None if k % 4 else "x") for k in range(50)], "id bigint, part string, note string").write.parquet(path)
    want = rows_of(spark.read.parquet(path))
    rewrite = lambda df, to: df.repartition("part").write.partitionBy("part").parquet(to)
    if crash:
        assert lifecycle.migrate(spark, path, rewrite, stop_after=crash) == crash
        there = [p for p in (path, f"{path}__old") if Files(spark).exists(p)]
        assert rows_of(spark.read.parquet(there[0]).select("id", "part", "note")) == want
    assert lifecycle.migrate(spark, path, rewrite) == "done"
    assert Files(spark).folders(path) == ["part=p0", "part=p1", "part=p2"] and rows_of(spark.read.parquet(path).select("id", "part", "note")) == want
    assert not Files(spark).exists(f"{path}__old") and not Files(spark).exists(f"{path}__new")


def test_migration_refuses_a_wrong_copy(spark, tmp_path):
    path = f"file:{tmp_path}/t"
    spark.range(10).write.parquet(path)
    with pytest.raises(ValueError, match="differs"):
        lifecycle.migrate(spark, path, lambda df, to: df.where("id <> 3").write.parquet(to))
    assert spark.read.parquet(path).count() == 10


def test_bucketed_join_has_no_shuffle(spark, sf_dir):
    from stockyard.plans import streams

    orders, lines = streams.bucketed_facts(spark, sf_dir)
    joined = orders.hint("merge").join(lines, orders.o_orderkey == lines.l_orderkey, "left").groupBy("o_orderkey").count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_limits_cancel_one_class_only(spark):
    governor = limits.Governor(spark)
    slow, calm = limits.UserClass("slow", 2, 1, 100), limits.UserClass("calm", 60, 2, 2)
    nap = F.udf(lambda k: time.sleep(20) or k, "long")
    with ThreadPoolExecutor(3) as pool:
        first = pool.submit(governor.run, slow, lambda s: s.range(2).select(nap("id")).collect())
        time.sleep(0.5)
        with pytest.raises(limits.OverLimit, match="1 runs at once"):
            governor.run(slow, lambda s: s.range(1).count())
        assert governor.run(calm, lambda s: s.range(100).count()) == 100
        with pytest.raises(limits.OverLimit, match="2 s are over"):
            first.result()
    assert governor.run(calm, lambda s: s.range(7).count()) == 7
    with pytest.raises(limits.OverLimit, match="runs an hour"):
        governor.run(calm, lambda s: s.range(1).count())
    assert governor.run(slow, lambda s: s.range(1).count()) == 1


def test_footers_equal_those_read_directly(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "t")
    spark.range(5000).select("id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("name "), F.col("id").cast("string"))).alias("name")).repartition(3).write.partitionBy().parquet(path)
    got = {(r.file.rsplit("/", 1)[1], r.row_group, r.column): (r.codec, r.n_values, r.n_nulls, r.compressed, r.uncompressed) for r in storage.footers(spark, path, 1).collect()}
    want = {}
    for f in (tmp_path / "t").glob("*.parquet"):
        meta = pq.read_metadata(f)
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                x = meta.row_group(g).column(c)
                want[f.name, g, x.path_in_schema] = (x.compression, x.num_values, x.statistics.null_count, x.total_compressed_size, x.total_uncompressed_size)
    assert got == want and len(got) == 6
    by = {r.column: r for r in storage.usage(storage.footers(spark, path)).collect()}
    assert by["name"].n_nulls == 1000 and by["id"].n_values == 5000 and by["id"].n_files == 3 and by["name"].ratio > 0
    monkey = storage.OPENED
    try:
        storage.OPENED = ()  # a store that only Spark reads
        assert storage.footers(spark, path).count() == 6
    finally:
        storage.OPENED = monkey


def test_merge_recovers_months_of_a_run_that_died(spark, tmp_path, monkeypatch):
    path, jan = f"{tmp_path}/t", dt.datetime(2024, 1, 5)
    rows = lambda *x: spark.createDataFrame(x, "id string, v int, ts timestamp_ntz")
    merge = lambda new: tables.merge_by_month(spark, path, new, ["id"], [F.col("v")], "ts")
    merge(rows(("a", 1, jan), ("b", 1, jan)))
    real = tables._put_in_place
    monkeypatch.setattr(tables, "_put_in_place", lambda s, p, side: None)
    merge(rows(("a", 2, jan), ("c", 1, jan)))  # dies after the side path is complete
    monkeypatch.setattr(tables, "_put_in_place", real)
    Files(spark).delete(f"{path}/ym=202401")  # and in the midst of the overwrite
    merge(rows(("d", 1, jan)))
    assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [("a", 2), ("b", 1), ("c", 1), ("d", 1)]
    assert not Files(spark).exists(f"{path}__merge")


def test_merge_moves_months_and_goes_on_after_a_crash(spark, tmp_path, monkeypatch):
    path, jan, feb = f"{tmp_path}/t", dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5)
    rows = lambda *x: spark.createDataFrame(x, "id string, v int, ts timestamp_ntz")
    merge = lambda new: tables.merge_by_month(spark, path, new, ["id"], [F.col("v")], "ts")
    merge(rows(("a", 1, jan), ("b", 1, feb), ("n", 1, None)))
    real, moved = Files.rename, []

    def rename(self, at, to):
        if moved:
            raise OSError("lost")
        moved.append(to)
        real(self, at, to)

    with monkeypatch.context() as m:
        m.setattr(Files, "rename", rename)
        with pytest.raises(OSError):
            merge(rows(("a", 2, jan), ("b", 2, feb), ("m", 1, None)))
    merge(rows(("c", 1, jan)))
    assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [("a", 2), ("b", 2), ("c", 1), ("m", 1), ("n", 1)]
    assert not Files(spark).exists(f"{path}__merge")


def test_lenient_times(spark):
    texts = ["2024-02-29T01:02:03Z", "2024-02-29 01:02:03.500", " 2024-02-29 ", "29.02.2024", "20240229010203", "1709168523", "1709168523000", "2024-02-30", "", None, "soon"]
    got = [r.t for r in spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, x string").select("k", times.parse_lenient(F.col("x")).alias("t")).orderBy("k").collect()]
    whole, day = dt.datetime(2024, 2, 29, 1, 2, 3), dt.datetime(2024, 2, 29)
    assert got == [whole, whole.replace(microsecond=500000), day, day, whole, whole, whole, None, None, None, None]
    assert spark.range(1).select(times.add_days(F.lit(day), 1).alias("t")).first().t == dt.datetime(2024, 3, 1)


def test_pick_drop_on_reference_columns(spark):
    staging = spark.createDataFrame([(5, 1, "s1", "w1", "h1", None, None, "t0"), (6, 2, "s1", None, None, 3, None, None), (5, 3, "s9", "w9", "h9", 1, None, None)], "wh_id bigint, pick_item_id bigint, picked_sku_id string, picked_by_worker_id string, dropped_inner_hu_id string, qty int, picked_at timestamp_ntz, pd_previous_task_id string")
    workers = spark.createDataFrame([("w1", "c", "Wo", "1", True, True)], "id string, code string, name string, phone string, supervisor boolean, active boolean")
    units = spark.createDataFrame([("h1", "H", "k1", "open", "{}", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)), ("h1", "OLD", "k0", "open", "{}", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))], "id string, code string, kindId string, state string, attrs string, createdAt timestamp_ntz, updatedAt timestamp_ntz")
    master = spark.createDataFrame([("s1", 7, "B", "sku", 3, 1.5, '{"ABC":"A","d":{"x":1}}')], "id string, principal_id bigint, brand string, name string, l0_units int, l2_weight double, classifications string")
    own = spark.createDataFrame([("s1", 5, True, 8, "", 4, 0.0, '{"d":{"y":2}}'), ("s1", 6, False, 9, "no", 9, 9.0, "null")], "sku_id string, node_id bigint, active boolean, principal_id bigint, name string, l0_units int, l2_weight double, classifications string")
    got = {r.pick_item_id: r for r in enrichments.pick_drop(staging, workers, units, master, own).collect()}
    a, b, c = got[1], got[2], got[3]
    assert (a.principal_id, a.sku_name, a.sku_l0_units, a.sku_l2_weight, a.sku_combined_classification) == (8, "sku", 4, 1.5, '{"ABC":"A","d":{"x":1,"y":2}}')
    assert (a.worker_name, a.dropped_hu_code, a.dropped_hu_kind_id, a.drop_item_previous_task_id, a.qty, a.picked_at) == ("Wo", "H", "k1", "t0", 0, dt.datetime(1970, 1, 1))
    assert (b.principal_id, b.sku_name, b.sku_l0_units, b.sku_combined_classification) == (7, "sku", 3, '{"ABC":"A","d":{"x":1}}')
    assert (c.sku_name, c.worker_supervisor, c.dropped_hu_created_at, c.sku_combined_classification) == ("", False, dt.datetime(1970, 1, 1), "{}")
    assert len(enrichments.sku_open()) == 12 + 10 + 4 * 9


def test_backfill_goes_on_after_a_crash(spark, tmp_path):
    rows = spark.createDataFrame([(k, dt.datetime(2024, 1 + k % 3, 5)) for k in range(30)], "id int, ts timestamp_ntz")
    path, commits = f"file:{tmp_path}/t", f"file:{tmp_path}/c"
    seen = []

    def star(df):
        seen.append(df.first().ts.month)
        if len(seen) == 2:
            raise OSError("lost")
        return df.withColumn("more", F.lit(1))

    with pytest.raises(OSError):
        backfill.backfill(spark, rows, "ts", path, star, commits)
    report = backfill.backfill(spark, rows, "ts", path, star, commits)
    assert seen == [1, 2, 2, 3] and sorted(map(tuple, report.collect())) == [(f"20240{m}", 0, 10, 10) for m in (1, 2, 3)]
    assert spark.read.parquet(path).where("more = 1").count() == 30
    with pytest.raises(backfill.WrongCount):
        backfill.backfill(spark, rows, "ts", path, lambda df: df.limit(3), f"{commits}2")
    assert spark.read.parquet(path).count() == 30
    again = backfill.backfill(spark, rows, "ts", path, star, f"{commits}3", ["202402"])
    assert [tuple(r) for r in again.collect()] == [("202402", 10, 10, 10)] and spark.read.parquet(path).count() == 30


def test_backfill_enriches_months_together(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(k, dt.datetime(2024, 1 + k % 5, 5)) for k in range(50)], "id int, ts timestamp_ntz")
    path, commits, seen = f"file:{tmp_path}/t", f"file:{tmp_path}/c", []

    def star(df):
        seen.append(sorted({r.ts.month for r in df.collect()}))
        return df.withColumn("more", F.lit(1))

    real = Files.rename

    def rename(self, at, to):
        if to.endswith("202402") and len(seen) == 1:
            raise OSError("lost")
        real(self, at, to)

    monkeypatch.setattr(Files, "rename", rename)
    months = [f"20240{m}" for m in range(1, 7)]
    with pytest.raises(OSError):
        backfill.backfill(spark, rows, "ts", path, star, commits, months, months_per_job=4)
    report = backfill.backfill(spark, rows, "ts", path, star, commits, months, months_per_job=4)
    assert seen == [[1, 2, 3, 4], [2, 3, 4, 5], []]  # January was done; June has no rows
    assert [tuple(r) for r in report.collect()] == [*((ym, 0, 10, 10) for ym in months[:5]), (months[5], 0, 0, 0)]
    assert spark.read.parquet(path).where("more = 1").count() == 50
    with pytest.raises(backfill.WrongCount):
        backfill.backfill(spark, rows, "ts", path, lambda df: df.where("id <> 7"), f"{commits}2", months_per_job=5)
    assert spark.read.parquet(path).where("id = 7").count() == 1


def test_windows_close_by_watermark(spark, tmp_path):
    """Rows later than the watermark allows don't change a window; rows within it do."""
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    schema = "k string, ts timestamp_ntz"
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)

    def put(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        windows = upserts.tumbling(upserts.change_stream(spark, src, spark.createDataFrame([], schema).schema, 1), "ts", ["k"], "1 day", [F.count(F.lit(1)).alias("n")], late="2 days")
        keyed_log.append(windows, out, f"{tmp_path}/cp", mode="append").awaitTermination()

    put(("a", day(1)), ("a", day(1, 5)))
    run()
    put(("a", day(2)), ("a", day(1, 7)))  # the second is late, but within two days
    run()
    put(("a", day(9)))
    run()
    put(("a", day(1, 9)), ("a", day(10)), ("a", day(20)))  # the first is too late
    run()
    put(("a", day(21)))
    run()
    got = {(r.window_start, r.n) for r in keyed_log.latest(spark, out, ["k", "window_start"]).collect()}
    assert {(day(1), 3), (day(2), 1), (day(9), 1), (day(10), 1)} <= got and all(n == 3 for w, n in got if w == day(1))


def test_text_sinks_of_streams(spark, tmp_path):
    src = f"{tmp_path}/src"
    spark.createDataFrame([(1, 'a"b'), (2, None)], "id int, s string").write.parquet(src)
    stream = lambda: upserts.change_stream(spark, src, spark.read.parquet(src).schema)
    for kind, want in (("json", ['{"id":1,"s":"a\\"b"}', '{"id":2}']), ("tsv", ['1\ta"b', "2\t"])):
        upserts.text_sink(stream(), f"{tmp_path}/{kind}", f"{tmp_path}/cp-{kind}", kind).awaitTermination()
        assert sorted(r.value for r in spark.read.text(f"{tmp_path}/{kind}").collect()) == want
    with pytest.raises(ValueError, match="no text sink"):
        upserts.text_sink(stream(), src, src, "xml")

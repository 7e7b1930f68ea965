import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.functions import json_text, times
from stockyard.functions.defaults import fill_defaults, greatest_or, override
from stockyard.operators import enrich, masters, position, staging
from stockyard.operators.dedup import latest_by_key, not_deleted


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_date_diff_counts_boundaries(spark):
    a, b = dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1)
    assert value(spark, times.date_diff("minute", F.lit(a), F.lit(b))) == 1
    assert value(spark, times.date_diff("hour", F.lit(a), F.lit(b))) == 0
    assert value(spark, times.date_diff("day", F.lit(b), F.lit(b - dt.timedelta(days=1, minutes=2)))) == -2


def test_json(spark):
    merge = lambda a, b: value(spark, json_text.merge_flat(F.lit(a), F.lit(b)))
    assert merge('{"a":"1","b":"2"}', '{"b":null,"c":"3"}') == '{"a":"1","c":"3"}'
    assert merge(None, '{"c":"3"}') == '{"c":"3"}'
    assert merge('{"a":"1"}', None) == '{"a":"1"}'
    normal = lambda d: value(spark, json_text.normalize_classification(F.lit(d)))
    assert normal('[{"type":"x","value":"1"},{"type":"y","value":"2"},{"type":"x","value":"3"}]') == '{"y":"2","x":"3"}'
    assert [normal(d) for d in ('{"a":1}', "null", "", "[", None)] == ['{"a":1}', "{}", "{}", "{}", "{}"]
    assert value(spark, json_text.extract_bool(F.lit('{"a":true}'), "a")) is True
    assert value(spark, json_text.extract_bool(F.lit("{}"), "a")) is False
    assert value(spark, json_text.extract_string(F.lit("{}"), "a")) == ""
    assert [value(spark, json_text.kind(F.lit(d))) for d in ("[1]", "{}", "null", "3", "[")] == ["Array", "Object", "Null", "Value", None]


def test_sentinels(spark):
    df = spark.createDataFrame([(None, None, None)], "a string, b bigint, c timestamp")
    assert tuple(fill_defaults(df).first()) == ("", 0, dt.datetime(1970, 1, 1))
    assert value(spark, override(F.lit("x"), F.lit("m"), T.StringType())) == "x"
    assert value(spark, override(F.lit(""), F.lit("m"), T.StringType())) == "m"
    assert value(spark, override(F.lit(None).cast("string"), F.lit("m"), T.StringType())) == "m"
    late = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    assert value(spark, greatest_or("1970-01-01 00:00:00", late, F.lit(None).cast("timestamp_ntz"))) == dt.datetime(2024, 1, 1)


def test_latest_by_key_takes_one_whole_row(spark):
    df = spark.createDataFrame([("k", 1, "a", None), ("k", 2, None, "b"), ("j", 1, "c", "d"), ("k", 2, None, "b")], "id string, v int, x string, y string")
    assert sorted(map(tuple, latest_by_key(df, ["id"], ["v", "x", "y"]).collect())) == [("j", 1, "c", "d"), ("k", 2, None, "b")]


def test_not_deleted(spark):
    epoch, day = dt.datetime(1970, 1, 1), dt.datetime(2024, 1, 5)
    df = spark.createDataFrame([(1, epoch), (2, day), (3, None), (4, day + dt.timedelta(days=2))], "id int, deactivated_at timestamp")
    assert sorted(r.id for r in not_deleted(df, F.lit(day)).collect()) == [1, 3, 4]


def test_sizes_of_large_ids_equal_the_sql(spark, tmp_path):
    import duckdb

    from stockyard.plans import retail

    spark.range(0, 7_000_000, 99_991).selectExpr("id AS event_id").write.parquet(f"{tmp_path}/events.parquet")
    got = retail.date_and_size_functions(spark, str(tmp_path)).select("event_id", "size").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(f"SELECT event_id, size FROM ({retail.ORACLE['date_and_size_functions']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    assert value(spark, times.readable_size(F.lit(3 << 30))) == "3.00 GiB"


def test_products_of_skus_and_sites_are_not_shuffled(spark):
    node = spark.createDataFrame([(1, 2, 5.0, "own", True), (1, 3, None, None, None), (2, 1, 0.0, "", True), (9, 1, 1.0, "x", True), (3, 2, 7.0, "late", True)], "sku_id bigint, node_id bigint, size double, name string, active boolean")
    master = spark.createDataFrame([(1, "a", 1.0, "one", True), (2, "a", 2.0, "two", False), (3, "b", 3.0, "three", False)], "sku_id bigint, product_id string, size double, name string, active boolean")
    pnode = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("a", 4, None)], "product_id string, node_id bigint, active boolean")
    sites = spark.createDataFrame([(1,), (2,), (3,)], "node_id bigint")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        every = masters.sku_combined_everywhere(master, node, sites, ["size", "name"])
        assert sorted(map(tuple, every.collect())) == [(1, 1, 1.0, "one", False), (1, 2, 2.0, "two", True), (2, 1, 5.0, "own", True), (2, 3, 7.0, "late", True), (3, 1, 1.0, "one", False)]
        both = masters.sku_overrides(node, pnode, master, {"size": T.DoubleType(), "name": T.StringType()})
        assert sorted((r.sku_id, r.node_id, r.size, r.name, r.active, r.level) for r in both.collect()) == [
            (1, 1, 1.0, "one", True, "product"), (1, 2, 5.0, "own", True, "sku"), (1, 3, 1.0, "one", True, "sku"), (1, 4, 1.0, "one", True, "product"),
            (2, 1, 0.0, "", True, "sku"), (2, 2, 2.0, "two", False, "product"), (2, 4, 2.0, "two", False, "product"), (3, 2, 7.0, "late", True, "sku"),
        ]
        for df in (every, both):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert "LeftAnti" not in plan and "rightHint=(strategy=broadcast)" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_pairs_of_skus_and_sites_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(masters, "BLOCK", 2, raising=False)
    skus = [(k, "ab"[k % 2], float(k), f"n{k}", k % 3 > 0) for k in range(7)]
    master = spark.createDataFrame([*skus, (None, "a", 9.0, "no id", True), (8, None, 8.0, "no product", True)], "sku_id bigint, product_id string, size double, name string, active boolean")
    node = spark.createDataFrame([(k, s, 5.0, "own", True) for k in range(7) for s in range(k)] + [(1, None, 5.0, "no site", True)], "sku_id bigint, node_id bigint, size double, name string, active boolean")
    sites = [(s,) for s in range(5)]
    got = masters.sku_combined_everywhere(master, node, spark.createDataFrame([*sites, (None,)], "node_id bigint"), ["size", "name"]).collect()
    want = [(s, k, *((5.0, "own", True) if k is not None and s is not None and s < k < 7 else (size, name, False))) for k, _, size, name, active in [*skus, (None, "a", 9.0, "no id", True), (8, None, 8.0, "no product", True)] for (s,) in [*sites, (None,)] if active or k is not None and s is not None and s < k < 7]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    pnode = spark.createDataFrame([(p, s, s % 2 == 0) for p in "ab" for s in (*range(5), 9, 9)] + [("a", None, True), (None, 1, True), ("c", 1, True)], "product_id string, node_id bigint, active boolean")
    rest = masters.sku_overrides(node, pnode, master, {"size": T.DoubleType(), "name": T.StringType()}).where("level = 'product'").collect()
    want = [(k, s, size, name, s % 2 == 0 if s is not None else True) for k, p, size, name, _ in [*skus, (None, "a", 9.0, "no id", True)] for s in (*range(5), 9, 9, *([None] if p == "a" else [])) if k is None or s is None or s >= k]
    assert sorted(map(str, ((r.sku_id, r.node_id, r.size, r.name, r.active) for r in rest))) == sorted(map(str, want))


def test_written_pairs_of_skus_and_sites_stay_small(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(masters, "PARTS", 4, raising=False)
    master = spark.range(400).selectExpr("id AS sku_id", "concat('name ', id % 90) AS name", "CAST(id % 50 AS double) AS size", "true AS active")
    node = spark.range(400).selectExpr("id AS sku_id", "id * 37 % 3000 AS node_id", "'own' AS name", "1.0D AS size", "true AS active")
    every = masters.sku_combined_everywhere(master, node, spark.range(3000).select(F.xxhash64("id").alias("node_id")).unionByName(node.select("node_id").distinct()), ["size", "name"])
    every.write.parquet(f"{tmp_path}/every")
    files = list((tmp_path / "every").glob("*.parquet"))
    assert len(files) > 3 and sum(f.stat().st_size for f in files) < 1.0 * spark.read.parquet(f"{tmp_path}/every").count()


def test_overrides_of_products_are_dealt_evenly_and_written_small(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(masters, "PARTS", 8, raising=False)
    master = spark.range(400).selectExpr("id AS sku_id", "'p' AS product_id", "concat('name ', id % 90) AS name", "CAST(id % 50 AS double) AS size", "true AS active")
    node = spark.range(400).selectExpr("id AS sku_id", "id * 37 % 3000 AS node_id", "'own' AS name", "1.0D AS size", "true AS active")
    pnode = spark.range(3000).selectExpr("'p' AS product_id", "id AS node_id", "id % 2 = 0 AS active")
    masters.sku_overrides(node, pnode, master, {"size": T.DoubleType(), "name": T.StringType()}).write.parquet(f"{tmp_path}/all")
    rows = spark.read.parquet(f"{tmp_path}/all")
    assert rows.count() == 400 * 3000
    of_task = [r["count"] for r in rows.groupBy(F.input_file_name()).count().collect()]
    assert len([n for n in of_task if n > 1000]) > 3
    assert sum(f.stat().st_size for f in (tmp_path / "all").glob("*.parquet")) < 1.0 * 400 * 3000


def _events(spark, rows):
    return spark.createDataFrame(rows, "id bigint, wh bigint, item string, qty double, ts timestamp_ntz, note string")


def test_position_equals_direct_sum_at_any_snapshot(spark):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    events = _events(spark, [(k, 1 + k % 2, "ab"[k % 3 == 0], float((k * 7) % 5 - 2), t(k), f"n{k}") for k in range(40)] + [(3, 2, "b", -1.0, t(3), "n3")])
    args = (["wh", "item"], "qty", "ts", "id", ["note"])
    direct = position.build_snapshot(events, t(30), *args).drop("snapshot_ts")
    for at in (t(-1), t(0), t(10), t(29), t(30)):
        snapshot = position.build_snapshot(events, at, *args)
        got = position.position_at_time(snapshot, events, t(30), *args).drop("query_time", "base_snapshot_time")
        assert sorted(map(str, got.collect())) == sorted(map(str, direct.collect())), at


def test_snapshot_drops_zero_and_keeps_negative(spark):
    now = dt.datetime(2024, 1, 1)
    events = _events(spark, [(1, 1, "a", 2.0, now, ""), (2, 1, "a", -2.0, now, ""), (3, 1, "b", -1.0, now, "")])
    rows = position.build_snapshot(events, now, ["wh", "item"], "qty", "ts", "id", ["note"]).collect()
    assert [(r["item"], r["quantity"]) for r in rows] == [("b", -1.0)]


def test_snapshot_is_appended_once(spark, tmp_path):
    now = dt.datetime(2024, 1, 1)
    snap = position.build_snapshot(_events(spark, [(1, 1, "a", 2.0, now, "")]), now, ["wh", "item"], "qty", "ts", "id", ["note"])
    path = str(tmp_path / "snap")
    assert position.append_snapshot(spark, path, snap, now)
    assert not position.append_snapshot(spark, path, snap, now)
    assert spark.read.parquet(path).count() == 1


def test_enrichment_never_multiplies_rows_and_fills_defaults(spark):
    events = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30)], "id int, k string, site int")
    dim = spark.createDataFrame([("a", "x", True), ("a", "y", True), ("b", "z", False)], "k string, name string, active boolean")
    out = enrich.enrich(events, [enrich.Dimension(dim, {"k": "k"}, {"name": "dim_name"}, where="active")])
    rows = {r.id: r.dim_name for r in out.collect()}
    assert rows[1] in ("x", "y") and rows[2] == rows[3] == ""


def test_enrichment_overrides(spark):
    events = spark.createDataFrame([(1, "s", 5), (2, "s", 6)], "id int, sku string, site int")
    master = spark.createDataFrame([("s", "master", 3)], "sku string, name string, size int")
    own = spark.createDataFrame([("s", 5, "own", 0)], "sku string, node int, name string, size int")
    out = enrich.enrich(events, [enrich.Dimension(master, {"sku": "sku"}, {"name": "sku_name", "size": "sku_size"}), enrich.Dimension(own, {"sku": "sku", "site": "node"}, {}, overrides={"name": "sku_name", "size": "sku_size"})])
    assert sorted((r.id, r.sku_name, r.sku_size) for r in out.collect()) == [(1, "own", 3), (2, "master", 3)]


def test_workstation_union(spark):
    now = dt.datetime(2024, 1, 1)
    receive = spark.createDataFrame([Row(id="r", whId=1, skuId="s", taskId="t", sessionId="e", batch="b", receivedAt=None, createdAt=now, receivedBy="u", huId="h", huCode="hc", stagingBinId="bin", receivedQty=1, overallQty=2, damagedQty=3, price=4.0, reason="why", subReason="more", deactivatedAt=None)], "id string, whId bigint, skuId string, taskId string, sessionId string, batch string, receivedAt timestamp, createdAt timestamp, receivedBy string, huId string, huCode string, stagingBinId string, receivedQty int, overallQty int, damagedQty int, price double, reason string, subReason string, deactivatedAt timestamp")
    load = spark.createDataFrame([("l", 1, "s", "t", "e", "b", now, now, "u", "h", "hc", "bin", 5, 6, "K")], "id string, whId bigint, skuId string, taskId string, sessionId string, batch string, loadedAt timestamp, createdAt timestamp, loadedBy string, huId string, huCode string, binId string, loadedQty int, qty int, classificationType string")
    rows = {r.event_type: r for r in staging.workstation_events({"inb_receive_item": receive, "ob_load_item": load}).collect()}
    assert rows["RECEIVING"].event_timestamp == now and rows["RECEIVING"].tertiary_quantity == 3
    assert rows["LOADING"].tertiary_quantity == 0 and rows["LOADING"].price is None and rows["LOADING"].status_or_bucket == "K"


def test_combined_view_as_function_and_dataframe(spark):
    master = spark.createDataFrame([(1, "m1", 2, True), (2, "m2", 3, False), (3, "m3", 4, False)], "sku_id bigint, name string, size bigint, active boolean")
    own = spark.createDataFrame([(1, 7, "", 9, True), (2, 7, "o2", 0, True), (3, 7, "o3", 5, False)], "sku_id bigint, node_id bigint, name string, size bigint, active boolean")
    want = [(1, "m1", 9, True), (2, "o2", 3, True)]
    got = masters.sku_combined(master, own, 7, ["name", "size"]).select("sku_id", "name", "size", "has_override")
    assert sorted(map(tuple, got.collect())) == want
    master.createOrReplaceTempView("t_master")
    own.createOrReplaceTempView("t_own")
    masters.register_combined(spark, "t_combined", "t_master", "t_own", ["name", "size"])
    assert sorted(map(tuple, spark.sql("SELECT * FROM t_combined(7)").collect())) == want


def test_events_move_once_for_a_unit_and_its_kind(spark):
    from stockyard.plans import enrichments

    events = spark.createDataFrame([(1, 1, 1, 2), (2, 1, 2, 1), (1, 2, 3, None), (1, 9, None, 3)], "wh_id bigint, sku_id bigint, hu_id bigint, outer_hu_id bigint").withColumn("effective_storage_id", F.col("wh_id"))
    units = spark.createDataFrame([(1, "x", 7), (2, "y", 8), (3, "z", None)], "id bigint, state string, kindId bigint")
    kinds = spark.createDataFrame([(7, "seven"), (0, "none")], "id bigint, name string")
    bins = spark.createDataFrame([(1, "b1")], "bin_id bigint, code string")
    master = spark.createDataFrame([(1, "one", '{"a":1,"b":{"c":2}}'), (2, "two", "[1]")], "id bigint, name string, classifications string")
    own = spark.createDataFrame([(1, 1, True, "own", '{"b":{"c":null,"d":3}}'), (2, 1, True, "", "broken"), (9, 1, True, "new", '{"n":1,"m":null}')], "sku_id bigint, node_id bigint, active boolean, name string, classifications string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = enrichments.inventory(events, units, kinds, bins, master, own)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {(r.wh_id, r.sku_id): (r.hu_state, r.hu_kind_name, r.outer_hu_kind_name, r.sku_name, r.sku_combined_classification) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {
        (1, 1): ("x", "seven", "", "own", '{"a":1,"b":{"d":3}}'), (2, 1): ("y", "", "seven", "one", '{"a":1,"b":{"c":2}}'),
        (1, 2): ("z", "", "", "two", "{}"), (1, 9): ("", "", "", "new", '{"n":1}'),
    }
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert moves and not any("hu_kind_id" in line for line in moves)


def _moves(df):
    """Keys by which the events move, from the last move to the first: the exchanges on the left sides of the joins."""
    node, keys = df._jdf.queryExecution().executedPlan(), []
    node = node.initialPlan()
    while node.children().size():
        if node.nodeName() == "Exchange":
            keys.append(node.outputPartitioning().expressions().size())
        node = node.children().head()
    return keys


def test_events_move_once_for_what_hangs_on_their_order(spark, sf_dir):
    from stockyard.plans import enrichments

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _moves(enrichments.pick_drop_enriched(spark, sf_dir)) == [1, 2, 1]  # SKU, SKU and site, order
        assert _moves(enrichments.inventory_enriched(spark, sf_dir)) == [1, 1, 2]  # SKU, order, SKU and site
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_an_override_may_come_before_what_it_overrides(spark):
    events = spark.createDataFrame([(1, "s", 5), (2, "s", 6), (3, "t", 5)], "id int, sku string, site int")
    master = enrich.Dimension(spark.createDataFrame([("s", "master", 3, '{"a":1}')], "sku string, name string, size int, j string"), {"sku": "sku"}, {"name": "sku_name", "size": "sku_size", "j": "sku_j"})
    own = enrich.Dimension(spark.createDataFrame([("s", 5, "own", 0, '{"b":2}'), ("t", 5, "alone", 7, '{"c":3}')], "sku string, node int, name string, size int, j string"), {"sku": "sku", "site": "node"}, {}, overrides={"name": "sku_name", "size": "sku_size"}, merges={"j": "sku_j"})
    want = [(1, "own", 3, '{"a":1,"b":2}'), (2, "master", 3, '{"a":1}'), (3, "alone", 7, '{"c":3}')]
    for dimensions in ([master, own], [own, master]):
        out = enrich.enrich(events, dimensions)
        assert out.columns == ["id", "sku", "site", "sku_name", "sku_size", "sku_j"]
        assert sorted((r.id, r.sku_name, r.sku_size, r.sku_j) for r in out.collect()) == want


def test_outer_units_of_unknown_units_are_found(spark):
    from stockyard.plans import enrichments

    events = spark.createDataFrame([(1, 1, 1, 2), (1, 1, 2, 3), (1, 1, 3, 4), (1, 1, None, None)], "wh_id bigint, sku_id bigint, hu_id bigint, outer_hu_id bigint").withColumn("effective_storage_id", F.col("wh_id"))
    units = spark.createDataFrame([(2, "old", 7, 1), (2, "new", 8, 2), (3, "z", None, 1)], "id bigint, state string, kindId bigint, updatedAt bigint")
    kinds = spark.createDataFrame([(7, "seven"), (8, "eight"), (0, "none")], "id bigint, name string")
    bins = spark.createDataFrame([(1, "b1")], "bin_id bigint, code string")
    master = spark.createDataFrame([(1, "one")], "id bigint, name string")
    own = spark.createDataFrame([(1, 1, False, "own")], "sku_id bigint, node_id bigint, active boolean, name string")
    plain, once = enrichments.inventory(events, units, kinds, bins, master, own), enrichments.inventory(events, units, kinds, bins, master, own, inner=F.col("id") - 1, few_bins=True)
    assert once.columns == plain.columns
    got = sorted(map(str, once.collect()))
    assert got == sorted(map(str, plain.collect()))
    rows = {r.hu_id: (r.hu_state, r.hu_kind_name, r.outer_hu_state, r.outer_hu_kind_name) for r in once.collect()}
    assert rows == {1: ("", "", "new", "eight"), 2: ("new", "eight", "z", ""), 3: ("z", "", "", ""), None: ("", "", "", "")}


def test_reports_join_only_the_dimensions_they_use(spark, sf_dir):
    from stockyard.plans import documented

    for name, files in (("report_worker_productivity", {"lineitem", "orders", "customer"}), ("report_unit_movements", {"lineitem", "orders"}), ("report_work_sessions", {"lineitem", "orders"})):
        read = {f.rsplit("/", 1)[1] for f in documented.QUERIES[name](spark, sf_dir).inputFiles()}
        assert read == {f"{f}.parquet" for f in files}

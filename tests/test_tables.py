import random

import pytest
from pyspark.sql import functions as F

from shoalgrid.operators import columns as c
from shoalgrid.operators import select as s
from shoalgrid.operators import state as st
from shoalgrid.operators.ordering import rank_by_position, with_previous
from shoalgrid.operators.skew import lookup
from shoalgrid.plans import exchange as ex
from shoalgrid.plans import maintain as m
from shoalgrid.plans.catalogue import collections
from shoalgrid.session import scratch_path
from shoalgrid.sinks import writers as w
from shoalgrid.sources import catalogue as cat
from shoalgrid.sources import features as src


def tuples(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_lookup_with_a_hot_key_and_nulls(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
        right = spark.range(0, 3000, 2).select(F.col("id").cast("string").alias("k"), "id").unionByName(spark.sql("SELECT 'hot' AS k, -1L AS id"))
        ones = right.groupBy("k").agg(F.max("id").alias("v"))
        got = lookup(left, ones, ["k"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(k") >= 3  # the grouped side is shuffled again for the join
        values = dict(tuples(got, "id", "v"))
        assert len(values) == 3000
        assert all(values[i] == (-1 if i % 3 == 0 else i if i % 3 == 1 and i % 2 == 0 else None) for i in range(3000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rank_and_previous_in_blocks(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aab"), p, rng.randrange(9)) for p in rng.sample(range(1000), 300)]
    df = spark.createDataFrame(rows, "k string, pos long, v long")
    want_rank, want_prev = {}, {}
    for k in "ab":
        group = sorted(r for r in rows if r[0] == k)
        group.sort(key=lambda r: r[1])
        for i, r in enumerate(group):
            want_rank[k, r[1]] = i + 1
            want_prev[k, r[1]] = group[i - 1][2] if i else None
    assert {(k, p): n for k, p, n in tuples(rank_by_position(df, ["k"], "pos", "n", block=10), "k", "pos", "n")} == want_rank
    assert {(k, p): n for k, p, n in tuples(with_previous(df, ["k"], "pos", "v", "n", block=10), "k", "pos", "n")} == want_prev


def test_tree_of_four_depths(spark):
    doc = """{"layerCatalog":{"children":[{"name":"lot","children":[{"displayName":"one","id":1},
      {"displayName":"A","children":[{"displayName":"two","id":2},{"displayName":"B","children":[{"displayName":"three","id":"3"},
      {"displayName":"C","children":[{"displayName":"four","id":4}]}]}]},{"displayName":"lost"}]},{"name":"bare"}]}}"""
    tree = cat.flatten_layer_tree(spark.createDataFrame([(0, doc), (1, "broken")], "d long, j string"), "j", "d")
    assert tuples(cat.with_id(tree).orderBy("pos"), "pos", "id", "thematic_lot", "subtheme", "subsubtheme") == [
        (0, "1", "lot", "one", ""), (1, "2", "lot", "A", "two"), (2, "3", "lot", "A", "B"), (3, "4", "lot", "A", "B")]
    assert tuples(cat.without_id(tree), "pos", "subtheme") == [(4, "lost")]


def test_repeated_ids_and_any_depth(spark):
    chain = '{"displayName":"d","children":[' * 30 + '{"displayName":"leaf","id":"deep"}' + "]}" * 30
    doc = f'''{{"layerCatalog":{{"children":[{{"name":"lot","children":[{{"displayName":"x","id":"a","name":"first"}},{{"displayName":"y","id":"b"}},
      {{"displayName":"z","id":"a","name":"last"}},{chain}]}}]}}}}'''
    tree = cat.flatten_layer_tree(spark.createDataFrame([(3, doc), (4, doc)], "d long, j string"), "j", "d").where("pos < 4l << 32")
    assert tuples(tree.orderBy("pos"), "pos", "id", "subtheme", "name") == [
        ((3 << 32), "a", "z", "last"), ((3 << 32) + 1, "b", "y", None), ((3 << 32) + 3, "deep", "d", None)]


def test_saved_catalogue_in_both_forms(spark):
    docs = [(0, '[{"id": 7, "name": "a"}]'), (1, '{"8": {"name": "b", "id": 1}}')]
    read = cat.read_catalog(spark.createDataFrame(docs, "d long, j string"), "j", "d")
    assert sorted(tuples(read, "id", "name")) == [("7", "a"), ("8", "b")]


def test_state_reuse(spark):
    layers = spark.createDataFrame([(0, "1", "u"), (1, "2", "u"), (2, "3", "moved"), (3, "4", "z"), (4, "5", "")], "pos long, id string, download_url string")
    previous = spark.createDataFrame([("1", "u", "s3/1"), ("3", "v", "s3/3"), ("4", "z", "s3/4")], "id string, download_url string, native_asset string")
    again = spark.createDataFrame([("4",)], "id string")
    attached = st.reuse_previous_asset(st.attach_previous(layers, st.forget(previous, again)))
    assert dict(tuples(attached, "id", "reused_asset")) == {"1": "s3/1", "2": None, "3": None, "4": None, "5": None}
    shared = st.reuse_asset_by_url(attached.withColumnRenamed("reused_asset", "native_asset"))
    assert dict(tuples(shared, "id", "shared_asset")) == {"1": "s3/1", "2": "s3/1", "3": None, "4": None, "5": None}


def test_columns(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a long, b string, lat double")
    assert c.apply_mapping(df, {"a": "z", "no": "n"}).columns == ["z", "b", "lat"]
    assert c.check_mapping(df, {"a": "z", "no": "n"}) == ({"a": "z"}, ["no"])
    assert c.missing_columns(c.apply_mapping(df, {"a": "z"}), {"a": "z", "no": "n"}) == ["no"]
    assert c.align_coordinates(df).columns == ["a", "b", "latitude"]
    with pytest.raises(ValueError):
        c.project_mapped(df, {"no": "n"}, keep=())
    with pytest.raises(ValueError):
        c.require_filled(df.withColumn("b", F.lit(None)), ["a", "b"])
    with pytest.raises(ValueError):
        c.require_filled(df, ["id"])


def test_type_alignment(spark):
    df = spark.sql("""SELECT 1L AS big, 2 AS whole, CAST(3 AS SHORT) AS small, 1.5D AS real, CAST(1.50 AS DECIMAL(5,2)) AS exact, true AS flag, DATE'2020-01-02' AS day,
      TIMESTAMP'2020-01-02 03:04:05.678' AS at, 'x' AS word, array(1) AS list, X'01' AS geometry""")
    aligned = c.align_types(df)
    assert dict(aligned.dtypes) == {"big": "float", "whole": "float", "small": "smallint", "real": "float", "exact": "string", "flag": "boolean", "day": "string",
                                    "at": "timestamp", "word": "string", "list": "string", "geometry": "binary"}
    row = aligned.first()
    assert (row["exact"], row["day"], row["at"].microsecond, row["list"]) == ("1.50", "2020-01-02", 0, "[1]")


def test_dropped_geometries_are_counted(spark):
    df = spark.createDataFrame([(1, bytearray(b"x")), (2, None), (3, None)], "feature_id long, geometry binary")
    kept, seen = c.drop_null_geometries(df)
    assert kept.count() == 1
    assert seen.get == {"rows": 3, "null_rows": 2}


def test_selection_takes_lists_and_dicts(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, lot string")
    assert s.select_layers(df, {"id": [1, 2], "lot": ["b"]}).count() == 1
    assert s.select_layers(df, [{"id": ["1"]}]).count() == 1
    assert s.select_layers(df, []).count() == 2


def test_product_choice(spark):
    layers = spark.createDataFrame([("1", "A.gdb_zones"), ("2", "b.shp"), ("3", "c.shp")], "id string, native_data_product string")
    files = spark.createDataFrame([("1", "t/A.gdb", 0), ("2", "t/x/b.shp", 1), ("2", "t/y/b.shp", 0), ("3", "t/c.txt", 0)], "id string, path string, pos long")
    got = tuples(s.choose_products(layers, files).orderBy("id"), "id", "path", "product_layer")
    assert got == [("1", "t/A.gdb", "zones"), ("2", "t/y/b.shp", None)]


UPDATES = [  # insert, update, same, blank, twice
    (0, 1, "p1", "new", "a"), (1, 1, None, "old", "b"), (2, 1, None, "kept", "k"), (3, 1, None, "blank", ""), (4, 2, "p2", "twice", "x"), (5, 2, "p3", "twice", "y")]


def store(spark):
    attributes = spark.createDataFrame([(1, "old", "o", 1, 0), (1, "kept", "k", 1, 0), (9, "else", "e", 1, 0)], "gislayer_fk long, name string, name_custom string, show int, export_stac int")
    metadata = spark.createDataFrame([(1, "product_info", "p1"), (3, "product_info", "p9"), (2, "download_url", "u")], "fk_gislayer_id long, metadata_type string, metadata_value string")
    updates = spark.createDataFrame(UPDATES, "pos long, id long, data_product string, native_variable string, arco_variable string")
    return attributes, metadata, updates


def test_upserts(spark):
    attributes, metadata, updates = store(spark)
    after = m.upsert_variables(attributes, updates)
    assert sorted(tuples(after, "gislayer_fk", "name", "name_custom", "show", "export_stac", "action")) == [
        (1, "kept", "k", 1, 0, "same"), (1, "new", "a", 0, 1, "insert"), (1, "old", "b", 1, 1, "update"), (2, "twice", "y", 0, 1, "insert"), (9, "else", "e", 1, 0, "keep")]
    again = m.upsert_variables(after.drop("action"), updates)
    assert {r["action"] for r in again.collect()} == {"same", "keep"}
    products = m.upsert_product(metadata, updates, "product_info")
    assert sorted(tuples(products, "fk_gislayer_id", "metadata_value", "action")) == [(1, "p1", "same"), (2, "p3", "insert"), (2, "u", "keep"), (3, "p9", "keep")]


def test_a_layer_without_a_complete_line_is_not_touched(spark):
    attributes, metadata, _ = store(spark)
    lines = [(0, 3, "p1", None, "b"), (1, 3, None, "old", "b"), (2, 4, "p1", "n", None)]
    updates = spark.createDataFrame(lines, "pos long, id long, data_product string, native_variable string, arco_variable string")
    assert {r["action"] for r in m.upsert_product(metadata, updates, "product_info").collect()} == {"keep"}
    assert {r["action"] for r in m.upsert_variables(attributes, updates).collect()} == {"keep"}


def test_nothing_converted_is_kept_without_asset_or_mapping(spark):
    map_type = "map<string,string>"
    layers = spark.createDataFrame([("1", None, {"a": "b"}, True), ("2", "n", None, True), ("3", "n", {"a": "b"}, False), ("4", "n", {"a": "b"}, True)],
                                   f"id string, native_asset string, native_arco_mapping {map_type}, to_convert boolean")
    state = layers.drop("to_convert").withColumn("converted_arco_assets", F.array(F.lit("x.zarr")))
    out = st.reuse_converted_assets(st.attach_previous(layers, state))
    assert sorted(tuples(out, "id", "converted_arco_assets")) == [("1", []), ("2", []), ("3", []), ("4", ["x.zarr"])]


def test_collection_facts_come_from_the_first_item_made(spark):
    fields = "family string, collection string, place long, variable string, layer_providers array<struct<name:string,role:string>>, extent struct<west:double,south:double,east:double,north:double>, start long, end long"
    box = (0.0, 0.0, 1.0, 1.0)
    first = ("f", "c", 1, "Depth", [("A", "x"), ("B", "y"), ("A", "z"), (None, "n"), (None, "m")], box, 1, 2)
    later = ("f", "c", 2, "depth", [("C", "x")], (2.0, 2.0, 3.0, 3.0), 5, 6)
    made = spark.createDataFrame([later, first], fields)
    row = collections(spark.createDataFrame([later], fields), made).first()
    assert (row["title"], [tuple(p) for p in row["providers"]]) == ("Depth", [("A", "x"), ("B", "y"), (None, "n")])
    assert (row["west"], row["start"], row["items"]) == (2.0, 5, 1)


def test_audit_follows_the_lines(spark):
    _, _, updates = store(spark)
    current = spark.createDataFrame([(1, "data_product", "p0")], "id long, field string, value string")
    changes = m.audit(updates, ["data_product"], current)
    assert sorted(tuples(changes, "pos", "old_value", "new_value", "action")) == [(0, "p0", "p1", "update"), (4, None, "p2", "insert"), (5, "p2", "p3", "update")]
    wide = m.audit_wide(changes, ["data_product"])
    assert sorted(tuples(wide, "pos", "data_product_old", "data_product_new")) == [(0, "p0", "p1"), (4, None, "p2"), (5, "p2", "p3")]


def test_sync_plan(spark):
    here = spark.createDataFrame([("a", 5), ("b", 1), ("c", 1)], "key string, modified long")
    there = spark.createDataFrame([("a", 3), ("b", 2), ("d", 1)], "key string, modified long")
    assert dict(tuples(ex.sync_plan(here, there), "key", "action")) == {"a": "upload", "b": "keep", "c": "upload", "d": "delete"}


def test_numbered_read_is_stable(spark):
    path = scratch_path(spark, "numbered")
    spark.range(1000).repartition(5).write.parquet(path)
    first = dict(tuples(src.read_numbered(spark, path), "feature_id", "id"))
    assert sorted(first) == list(range(1000))
    assert dict(tuples(src.read_numbered(spark, path), "feature_id", "id")) == first


def test_records_and_manifest_of_a_folder(spark):
    path = scratch_path(spark, "records")
    spark.createDataFrame([("<a>1\n</a>",), ("<b/>",)], "value string").repartition(2).write.text(path)
    records = src.read_records(spark, path)
    assert records.filter("xml LIKE '%<%'").count() >= 1 and records.columns == ["uri", "xml"]
    files = src.read_manifest(spark, path)
    assert files.columns == ["path", "modified", "size"] and files.count() >= 1


def test_bundled_records_are_few_files_and_read_back(spark):
    path = scratch_path(spark, "bundles")
    rows = [(f"u{i}", f"<a>\n{i}</a>") for i in range(500)] + [("twice", "<b/>"), ("twice", "<b/>"), ("empty", None), ("odd", "<a>\x1e</a>")]
    w.write_records(spark.createDataFrame(rows, "u string, x string"), path, "u", "x")
    records = src.read_records(spark, path, bundled=True)
    assert dict(tuples(records, "uri", "xml")) == {**{u: f"{x}\n" for u, x in rows[:500]}, "twice": "<b/>\n<b/>\n", "empty": "\n", "odd": "<a>\x1f</a>\n"}
    assert records.count() == 503 and len(records.inputFiles()) <= 4


def test_records_query_does_not_make_a_file_per_record(spark, tmp_path):
    import contract
    from shoalgrid.session import job_folder

    spark.sql("SELECT id AS c_custkey, concat('C', id) AS c_name, 0 AS c_nationkey, 1D AS c_acctbal, 'M' AS c_mktsegment FROM range(300)").write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("SELECT 0 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql("SELECT 0 AS r_regionkey, 'R' AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    with job_folder(spark) as folder:
        rows = contract.QUERIES["s8_read_records"](spark, str(tmp_path))
        assert sorted(tuples(rows, "id", "is_broken")) == sorted((str(i), i % 7 == 0) for i in range(300))
        assert src.read_manifest(spark, folder).count() < 50


def test_costly_rows_of_one_part_are_dealt_out(spark):
    from shoalgrid.functions.records import record_facts

    records = spark.range(0, 400, 1, 1).selectExpr("id", "concat('<a>', id, '</a>') AS xml", "map('k', id) AS m")
    parts = record_facts(records, "xml").groupBy(F.spark_partition_id().alias("p")).count()
    found = [n for _, n in tuples(parts, "p", "count")]
    assert sum(found) == 400 and len(found) == 4 and max(found) < 200


def test_tree_and_issue_tables_keep_their_parts(spark):
    docs = [(i, '{"layerCatalog":{"children":[{"name":"lot","children":[{"id":"a"},{"id":"b"},{"name":"none"}]}]}}') for i in range(200)]
    tree = cat.flatten_layer_tree(spark.createDataFrame(docs, "d long, j string").coalesce(1), "j", "d")
    assert tree.count() == 600 and tree.select("pos").distinct().count() == 600
    plan = tree._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") >= 3


def test_compact_copy_of_a_small_table_is_one_file(spark):
    path = scratch_path(spark, "compact")
    w.write_compact(spark.range(0, 100, 1, 7), path)
    stored = spark.read.parquet(path)
    assert len(stored.inputFiles()) == 1 and stored.count() == 100


def test_repeated_backup_and_snapshot_leave_one_copy(spark):
    path, layers = scratch_path(spark, "again"), spark.range(5)
    for day in ("a", "b", "a"):
        w.write_backup(layers, f"{path}/b", day)
        w.write_snapshot(layers, f"{path}/s", day)
    assert spark.read.parquet(f"{path}/b").count() == 10 and spark.read.json(f"{path}/s").count() == 10


def test_report_is_csv_with_header(spark):
    path = scratch_path(spark, "report")
    w.write_report(spark.createDataFrame([("a,b", ""), ('q"x', None)], "x string, y string"), path, single_file=True)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert lines[0] == "x,y" and lines[1] == '"a,b",'


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from shoalgrid import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Cluster:
        conf = Conf()

    with pytest.raises(ValueError):
        session.shared_dir(Cluster())


def test_features_subset_is_pushed_to_the_scan(spark):
    path = scratch_path(spark, "pushed")
    spark.range(10).selectExpr("id AS feature_id", "id * 1D AS xmin", "id * 1D AS xmax", "0D AS ymin", "1D AS ymax", "'k' AS kind", "'long text' AS note").write.parquet(path)
    subset = s.feature_subset(src.read_features(spark, path), "kind", ["k"], (2.0, 0.0, 4.0, 1.0)).select("feature_id")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = subset._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert subset.count() == 3
    assert "LessThanOrEqual(xmin,4.0)" in plan and "note" not in plan.split("ReadSchema:")[1]

"""K1-K9: what was written is read back."""

from pyspark.sql import functions as F

from contract.geo import BURN_SQL, CATEGORY_SQL, part_bounds, part_cells, part_polygons
from contract.registry import made, query, table
from shoalgrid.operators import grid as g
from shoalgrid.session import scratch_path
from shoalgrid.sinks import writers as w


@query("k1_write_features", "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def k1(spark, sf):
    path = scratch_path(spark, "k1")
    w.write_features(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag"), path, ["l_returnflag"])
    return spark.read.parquet(path)


@query("k2_write_geo_features", """SELECT 'geometry' AS geometry_column, 'WKB' AS encoding, 'EPSG:4326' AS crs, 'EPSG:3035' AS source_crs,
 (SELECT count(*) FROM part) AS features, (SELECT max(x2) FROM corners) AS xmax""", ("corners",))
def k2(spark, sf):
    path = scratch_path(spark, "k2")
    w.write_geo_features(part_polygons(spark, sf), path, "EPSG:3035")
    facts = spark.read.parquet(path).agg(F.count("geometry").alias("features"), F.max("xmax").alias("xmax"))
    geo = spark.read.parquet(f"{path}_geo")
    return facts.withColumns({c: geo.select(c).scalar() for c in geo.columns})


@query("k3_write_compact", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def k3(spark, sf):
    path = scratch_path(spark, "k3")
    w.write_compact(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), path)
    return spark.read.parquet(path)


@query("k4_write_renamed", "SELECT p_partkey, p_name AS product_name, p_brand, p_retailprice AS price FROM part")
def k4(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    mapping = {"p_name": "product_name", "p_retailprice": "price", "p_absent": "absent"}
    return spark.read.parquet(w.write_renamed(parts, scratch_path(spark, "k4"), "parts", mapping))


@query("k5_write_grid", f"""{BURN_SQL},{CATEGORY_SQL}
SELECT 'price' AS variable, row, col, round(price::DOUBLE, 3) AS value FROM cells JOIN corners USING (feature_id)
UNION ALL SELECT c.variable, row, col, code::DOUBLE FROM cells JOIN labels_ l USING (feature_id) JOIN categories c ON c.variable = l.variable AND c.label = l.label""", ("corners",))
def k5(spark, sf):
    path = scratch_path(spark, "k5")
    features = part_bounds(spark, sf)
    coded = g.encode_features(features, ["brand", "kind"], g.category_codes(features, ["brand", "kind"]))
    cells = g.cell_attributes(part_cells(spark, sf), coded, ["brand", "kind", "price"])
    w.write_grid(g.grid_values(cells, ["brand", "kind", "price"]), path)
    opened = g.open_chunks(spark.read.parquet(path))
    return opened.select(
        "variable", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"),
        F.round(F.col("value").cast("double"), 3).alias("value"),
    )


@query("k6_write_snapshots", """SELECT s.snapshot, thematic_lot, count(*) AS layers FROM layers, (VALUES ('start'), ('end')) s(snapshot)
 WHERE s.snapshot = 'start' OR in_stac = 'yes' GROUP BY ALL""", ("layers",))
def k6(spark, sf):
    path, layers = scratch_path(spark, "k6"), made(spark, sf, "layers")
    for _ in range(2):  # a repeated run leaves one copy
        w.write_snapshot(layers, path, "start")
    w.write_snapshot(layers.filter("in_stac = 'yes'"), path, "end")
    return spark.read.schema("id string, thematic_lot string, snapshot string").json(path).groupBy("snapshot", "thematic_lot").agg(
        F.count(F.lit(1)).alias("layers")
    )


@query("k7_write_documents", "SELECT subtheme AS family, c_mktsegment AS collection, id, name FROM layers JOIN customer ON pos = c_custkey", ("layers",))
def k7(spark, sf):
    path = scratch_path(spark, "k7")
    layers = made(spark, sf, "layers").join(table(spark, sf, "customer"), F.col("pos") == F.col("c_custkey"))
    w.write_documents(layers.select(F.col("subtheme").alias("family"), F.col("c_mktsegment").alias("collection"), "id", "name"), path, ["family", "collection"])
    doc = F.from_json("value", "id string, name string")
    return spark.read.text(path).select("family", "collection", doc["id"].alias("id"), doc["name"].alias("name"))


@query("k8_write_report", "SELECT id, name, subsubtheme, download_url FROM layers", ("layers",))
def k8(spark, sf):
    path = scratch_path(spark, "k8")
    w.write_report(made(spark, sf, "layers").select("id", "name", "subsubtheme", "download_url"), path)
    return spark.read.csv(path, header=True).fillna("")


@query("k9_write_backup", "SELECT d.snapshot_date, id, download_url FROM layers, (VALUES ('2024-05-01'), ('2024-06-01')) d(snapshot_date)", ("layers",))
def k9(spark, sf):
    path, layers = scratch_path(spark, "k9"), made(spark, sf, "layers").select("id", "download_url")
    for day in ("2024-05-01", "2024-06-01", "2024-05-01"):  # a repeated day leaves one copy
        w.write_backup(layers, path, day)
    return spark.read.parquet(path).select(F.col("snapshot_date").cast("string").alias("snapshot_date"), "id", "download_url")

"""A1-A18."""

from pyspark.sql import functions as F

from contract.geo import BURN_SQL, part_bounds, part_spec
from contract.registry import INPUTS, made, query, table
from contract.q_catalogue import ITEMS_SQL, items
from contract.q_select import coded_grid, mixed_geometries
from shoalgrid.operators import columns as c
from shoalgrid.operators import extents as x
from shoalgrid.operators import grid as g
from shoalgrid.operators import select as s
from shoalgrid.plans import catalogue as cat
from shoalgrid.plans import reports as rp


@query("a1_total_bounds", "SELECT min(least(x1, x4)) AS xmin, min(y1) AS ymin, max(x2) AS xmax, max(y3) AS ymax FROM corners", ("corners",))
def a1(spark, sf):
    return x.total_bounds(part_bounds(spark, sf))


def clock(df):
    return df.select(*[
        F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n) if n in ("start", "end") else F.col(n) for n in df.columns
    ])


@query("a2_table_time_extent", """SELECT strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S') AS "start", strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS "end" FROM lineitem""")
def a2(spark, sf):
    return clock(x.table_time_extent(table(spark, sf, "lineitem")))


@query("a3_grid_time_extent", """SELECT variable, strftime(min(time), '%Y-%m-%d %H:%M:%S') AS "start", strftime(max(time), '%Y-%m-%d %H:%M:%S') AS "end" FROM readings GROUP BY variable""", ("readings",))
def a3(spark, sf):
    return clock(x.grid_time_extent(made(spark, sf, "readings"), ["variable"]))


@query("a4_grid_space_extent", "SELECT min(longitude) AS west, min(latitude) AS south, max(longitude) AS east, max(latitude) AS north FROM readings", ("readings",))
def a4(spark, sf):
    return x.grid_space_extent(made(spark, sf, "readings"))


@query("a5_variable_extent", f"""{BURN_SQL} SELECT v.variable, round(y0, 4) AS geospatial_lat_min, round(y1, 4) AS geospatial_lat_max,
 round(x0, 4) AS geospatial_lon_min, round(x1, 4) AS geospatial_lon_max FROM s, (VALUES ('price'), ('kind')) v(variable)""", ("corners",))
def a5(spark, sf):
    return x.variable_extent(coded_grid(spark, sf)[0], part_spec(spark, sf))


@query("a6_frame_attributes", f"""{BURN_SQL} SELECT 4326 AS epsg, least((round(y1, 4) - round(y0, 4)) / height, (round(x1, 4) - round(x0, 4)) / width) AS resolution,
 round(y0, 4) AS geospatial_latitude_min, round(y1, 4) AS geospatial_latitude_max, round(x0, 4) AS geospatial_longitude_min, round(x1, 4) AS geospatial_longitude_max, 'parts' AS title FROM s""", ("corners",))
def a6_frame(spark, sf):
    return x.dataset_attributes(coded_grid(spark, sf)[0], "parts", "lot", "asset", "2024-05-01", part_spec(spark, sf)).drop("history", "comment", "sources")


@query("a6_axis_statistics", """SELECT 4326 AS epsg, least(la, lo) AS resolution, geospatial_latitude_min, geospatial_latitude_max, geospatial_longitude_min, geospatial_longitude_max,
 'readings' AS title, 'Converted on 2024-05-01' AS history, 'Converted from data product asset on 2024-05-01' AS comment, 'lot' AS sources FROM (
 SELECT (max(latitude) - min(latitude)) / count(DISTINCT latitude) AS la, (max(longitude) - min(longitude)) / count(DISTINCT longitude) AS lo,
 min(latitude) AS geospatial_latitude_min, max(latitude) AS geospatial_latitude_max, min(longitude) AS geospatial_longitude_min, max(longitude) AS geospatial_longitude_max FROM readings)""", ("readings",))
def a6(spark, sf):
    return x.dataset_attributes(made(spark, sf, "readings"), "readings", "lot", "asset", "2024-05-01")


@query("a7_collection_extents", f"""{ITEMS_SQL} SELECT family, collection, min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north,
 min(start_day) AS "start", max(end_day) AS "end", count(*) AS items FROM items_ GROUP BY family, collection""", ("cat_layers", "names"))
def a7(spark, sf):
    return clock(cat.collection_extents(items(spark, sf)))


@query("a8_conservation", """SELECT count(*) AS rows_before, count(kind) AS rows_after, count(*) - count(kind) AS rows_dropped, TRUE AS is_kept FROM corners""", ("corners",))
def a8(spark, sf):
    features = part_bounds(spark, sf)
    kept, _ = c.drop_null_geometries(features, "kind")
    return x.conservation(features, kept, features.filter("kind IS NULL"))


@query("a9_geometry_kinds", """SELECT CASE WHEN size < 10 THEN 'Point' WHEN size < 20 THEN 'LineString' ELSE 'Polygon' END AS geom_type, count(*) AS rows,
 CASE WHEN size < 20 THEN count(*) ELSE 0 END AS dropped_rows FROM corners GROUP BY size < 20, 1""", ("corners",))
def a9(spark, sf):
    return s.geometry_kinds(mixed_geometries(spark, sf))


INPUTS["asset_columns"] = """
SELECT cast(o_custkey AS string) AS id, o_orderkey % 3 AS asset_pos, o_orderkey AS col_pos,
 CASE o_orderpriority WHEN '5-LOW' THEN 'geometry' WHEN '2-HIGH' THEN 'datetime' ELSE o_orderpriority END AS name FROM @orders"""


@query("a10_asset_variables", """SELECT id, name, asset_pos, col_pos FROM asset_columns WHERE name NOT IN ('geometry', 'datetime')
 QUALIFY row_number() OVER (PARTITION BY id, name ORDER BY asset_pos, col_pos) = 1""", ("asset_columns",))
def a10(spark, sf):
    return x.asset_variables(made(spark, sf, "asset_columns"))


INPUTS["info"] = """
SELECT 'ds' || cast(user_id AS string) AS dataset, event_id AS pos, CASE WHEN event_id % 9 = 0 THEN 'time' ELSE 'NC_GLOBAL' END AS scope,
 CASE event_type WHEN 'click' THEN 'geospatial_lon_min' WHEN 'view' THEN 'time_coverage_start' WHEN 'error' THEN 'geospatial_lat_max' ELSE 'other' END AS attribute,
 'v' || cast(event_id AS string) AS value FROM @events"""


@query("a11_global_attributes", """SELECT dataset, arg_max(value, pos) FILTER (WHERE attribute = 'geospatial_lon_min') AS geospatial_lon_min,
 arg_max(value, pos) FILTER (WHERE attribute = 'geospatial_lat_max') AS geospatial_lat_max, arg_max(value, pos) FILTER (WHERE attribute = 'time_coverage_start') AS time_coverage_start
 FROM info WHERE scope = 'NC_GLOBAL' AND attribute <> 'other' GROUP BY dataset""", ("info",))
def a11(spark, sf):
    return x.global_attributes(made(spark, sf, "info"), ["geospatial_lon_min", "geospatial_lat_max", "time_coverage_start"])


@query("a12_metadata_columns", """SELECT id, coalesce(arg_max(metadata_value, pos) FILTER (WHERE metadata_type = 'download_url'), '') AS download_url,
 coalesce(arg_max(metadata_value, pos) FILTER (WHERE metadata_type = 'geonetwork_uri'), '') AS geonetwork_uri,
 coalesce(arg_max(metadata_value, pos) FILTER (WHERE metadata_type = 'product_info'), '') AS native_data_product FROM metadata_rows GROUP BY id""", ("metadata_rows",))
def a12(spark, sf):
    types = {"download_url": "download_url", "geonetwork_uri": "geonetwork_uri", "product_info": "native_data_product"}
    return x.metadata_columns(made(spark, sf, "metadata_rows"), types)


INPUTS["labelled"] = """
SELECT o_orderkey AS feature_id, CASE WHEN o_totalprice > 400000e0 THEN 'nan' ELSE 'customer ' || cast(o_custkey AS string) END AS label_a, o_orderpriority AS label_b FROM @orders"""


@query("a13_category_codes", """WITH v AS (SELECT 'label_a' AS variable, CASE WHEN label_a = 'nan' THEN 'None' ELSE label_a END AS label, feature_id FROM labelled
 UNION ALL SELECT 'label_b', label_b, feature_id FROM labelled), f AS (SELECT variable, label, min(feature_id) AS first FROM v GROUP BY ALL)
SELECT variable, label, row_number() OVER (PARTITION BY variable ORDER BY first) AS code FROM f""", ("labelled",))
def a13(spark, sf):
    return g.category_codes(made(spark, sf, "labelled"), ["label_a", "label_b"])


@query("a14_item_assets", f"""{ITEMS_SQL} SELECT family, collection, item_id, u.kind AS asset_kind, u.href FROM (SELECT *, unnest([
  {{'kind': 'csv', 'href': download_url}}, {{'kind': CASE WHEN suffix(native_asset, '.zip') THEN 'zip' ELSE 'parquet' END,
    'href': CASE WHEN kind = 'converted' AND suffix(native_asset, '.parquet') THEN 'https://s3.example.org/c' || id || '.parquet' ELSE native_asset END}},
  {{'kind': CASE WHEN kind = 'converted' AND suffix(native_asset, '.zip') THEN 'parquet' END, 'href': 'https://s3.example.org/c' || id || '.parquet'}},
  {{'kind': CASE WHEN kind = 'converted' THEN 'zarr' END, 'href': 'https://s3.example.org/c' || id || '.zarr'}}]) AS u FROM items_) WHERE u.kind IS NOT NULL""", ("cat_layers", "names"))
def a14(spark, sf):
    return cat.item_assets(items(spark, sf)).select("family", "collection", "item_id", "asset_kind", "href")


INPUTS["parties"] = """
SELECT o_custkey AS id, o_orderkey AS pos, o_orderpriority AS name, 'role ' || o_orderstatus AS role FROM @orders"""


@query("a15_unique_providers", """SELECT id, p.name AS provider, arg_min(p.role, pos * 2 + p.at) AS role FROM (SELECT id, pos, unnest([{'name': name, 'role': role, 'at': 0}, {'name': role, 'role': 'second', 'at': 1}]) AS p FROM parties) GROUP BY ALL""", ("parties",))
def a15(spark, sf):
    def party(name, role):
        return F.struct(name.alias("name"), role.alias("role"))

    lists = F.array(party(F.col("name"), F.col("role")), party(F.col("role"), F.lit("second")))
    rows = made(spark, sf, "parties").withColumn("providers", lists)
    return cat.unique_providers(rows, ["id"], "providers", "pos")


@query("a16_last_writer", "SELECT user_id AS row, hour(ts) AS col, max(event_id) AS feature_id FROM events GROUP BY ALL")
def a16(spark, sf):
    cells = table(spark, sf, "events").selectExpr("user_id AS row", "cast(hour(ts) AS long) AS col", "event_id AS feature_id")
    return g.last_writer(cells)


@query("a17_distinct_collections", f"""{ITEMS_SQL} SELECT family, collection, arg_min(variable, (pos, item_pos)) AS title, count(*) AS items FROM items_ GROUP BY ALL""", ("cat_layers", "names"))
def a17(spark, sf):
    return cat.collections(items(spark, sf)).select("family", "collection", "title", "items")


@query("a18_run_counters", "SELECT count(*) AS layers, count(*) FILTER (WHERE coalesce(in_stac, 'no') <> 'yes') AS to_process, count(*) FILTER (WHERE in_stac = 'yes') AS published FROM layers", ("layers",))
def a18(spark, sf):
    return rp.run_counters(made(spark, sf, "layers"))


HARVEST_SQL = """WITH n AS (SELECT n_nationkey AS k, n_name AS id FROM nation),
 c AS (SELECT DISTINCT c_nationkey AS k FROM customer),
 o AS (SELECT DISTINCT c_nationkey AS k FROM orders JOIN customer ON o_custkey = c_custkey),
 cols0(col_pos, name) AS (VALUES (0, 'c_custkey'), (1, 'c_name'), (2, 'c_acctbal'), (3, 'c_mktsegment')),
 cols1(col_pos, name) AS (VALUES (0, 'o_orderkey'), (1, 'o_orderstatus'), (2, 'o_totalprice'), (3, 'o_orderdate'))
SELECT id, 0::BIGINT AS asset_pos, col_pos::BIGINT AS col_pos, name, 'parquet' AS kind, false AS failed FROM n JOIN c USING (k) CROSS JOIN cols0
UNION ALL SELECT id, 1::BIGINT, col_pos::BIGINT, name, 'csv', false FROM n JOIN o USING (k) CROSS JOIN cols1
UNION ALL SELECT id, 0::BIGINT, NULL::BIGINT, NULL, NULL, true FROM n WHERE k NOT IN (SELECT k FROM c)
UNION ALL SELECT id, 1::BIGINT, NULL::BIGINT, NULL, NULL, true FROM n WHERE k NOT IN (SELECT k FROM o)
UNION ALL SELECT id, 2::BIGINT, NULL::BIGINT, NULL, NULL, true FROM n"""


@query("a10_harvest_schemas", HARVEST_SQL)
def a10_harvest(spark, sf):
    """Assets written per nation (Parquet of its customers, CSV of their orders, one missing), then their
    schemas harvested from footers and header lines only."""
    from shoalgrid.session import scratch_path
    from shoalgrid.sources.assets import harvest_schemas

    base = scratch_path(spark, "assets")
    customer, orders, nation = (table(spark, sf, t) for t in ("customer", "orders", "nation"))
    customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", F.col("c_nationkey").alias("nation")) \
        .write.partitionBy("nation").parquet(f"{base}/customers")
    orders.join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey") \
        .select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", F.col("c_nationkey").alias("nation")) \
        .write.partitionBy("nation").option("header", True).csv(f"{base}/orders")
    folder = F.concat(F.lit("/nation="), F.col("n_nationkey").cast("string"))
    assets = nation.select(F.col("n_name").alias("id"), F.explode(F.array(
        F.struct(F.lit(0).alias("asset_pos"), F.concat(F.lit(f"{base}/customers"), folder).alias("path")),
        F.struct(F.lit(1).alias("asset_pos"), F.concat(F.lit(f"{base}/orders"), folder).alias("path")),
        F.struct(F.lit(2).alias("asset_pos"), F.concat(F.lit(f"{base}/missing"), folder).alias("path")))).alias("a")).select("id", "a.*")
    return harvest_schemas(assets).select("id", "asset_pos", "col_pos", "name", "kind", F.col("error").isNotNull().alias("failed"))

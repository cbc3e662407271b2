"""P1-P17, O1-O3, W-free limits."""

from pyspark.sql import functions as F

from contract.geo import BURN_SQL, CATEGORY_SQL, part_bounds, part_cells, part_polygons, part_spec
from contract.registry import INPUTS, made, query, table
from shoalgrid.functions.text import first_download
from shoalgrid.operators import columns as c
from shoalgrid.operators import grid as g
from shoalgrid.operators import select as s
from shoalgrid.session import scratch_path
from shoalgrid.sinks.writers import write_grid
from shoalgrid.sources.features import read_chunks

MAPPING = {"l_quantity": "quantity", "l_extendedprice": "price", "l_absent": "absent"}


@query("p1_apply_mapping", "SELECT l_orderkey, l_quantity AS quantity, l_extendedprice AS price, l_tax FROM lineitem")
def p1(spark, sf):
    return c.apply_mapping(table(spark, sf, "lineitem"), MAPPING).select("l_orderkey", "quantity", "price", "l_tax")


@query("p1_rename_grid_variables", "SELECT event_id, CASE variable WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' ELSE variable END AS variable FROM readings", ("readings",))
def p1_grid(spark, sf):
    return c.rename_grid_variables(made(spark, sf, "readings").select("event_id", "variable"), {"click": "clicks", "view": "views", "none": "x"})


@query("p2_project_mapped", "SELECT brand AS maker, price AS cost, 141 + 9 - 141 + 4 + 80 + 4 + 64 AS geometry_bytes FROM corners", ("corners",))
def p2(spark, sf):
    picked = c.project_mapped(part_polygons(spark, sf), {"brand": "maker", "price": "cost"})
    return picked.select("maker", "cost", F.length("geometry").alias("geometry_bytes"))


@query("p3_check_mapping", """SELECT sum(l_quantity)::BIGINT AS quantity_sum, 'l_absent' AS missing FROM lineitem""")
def p3(spark, sf):
    lines = table(spark, sf, "lineitem")
    fitting, missing = c.check_mapping(lines, MAPPING)
    renamed = c.project_mapped(lines, fitting, keep=())
    return renamed.agg(F.sum("quantity").cast("long").alias("quantity_sum")).withColumn("missing", F.lit(",".join(missing)))


@query("p4_align_coordinates", "SELECT event_id, latitude, longitude FROM readings", ("readings",))
def p4(spark, sf):
    short = made(spark, sf, "readings").select("event_id", F.col("latitude").alias("lat"), F.col("longitude").alias("x"))
    return c.align_coordinates(short)


@query("p5_select_layers", "SELECT id, thematic_lot, subtheme FROM layers WHERE thematic_lot IN ('ASIA', 'EUROPE') AND nationkey IN (2, 3, 8, 13)", ("layers",))
def p5(spark, sf):
    picked = s.select_layers(made(spark, sf, "layers"), [{"thematic_lot": ["ASIA", "EUROPE"]}, {"nationkey": [2, 3, 8, 13]}])
    return picked.select("id", "thematic_lot", "subtheme")


@query("p6_omit_lots", "SELECT id, thematic_lot FROM layers WHERE thematic_lot NOT IN ('AFRICA', 'AMERICA')", ("layers",))
def p6(spark, sf):
    return s.omit_lots(made(spark, sf, "layers"), ["AFRICA", "AMERICA"]).select("id", "thematic_lot")


def some_null_polygons(spark, sf):
    return part_polygons(spark, sf).withColumn("geometry", F.when(F.col("kind").isNotNull(), F.col("geometry")))


@query("p7_drop_null_geometries", "SELECT feature_id, brand FROM corners WHERE kind IS NOT NULL", ("corners",))
def p7(spark, sf):
    kept, _ = c.drop_null_geometries(some_null_polygons(spark, sf))
    return kept.select("feature_id", "brand")


def mixed_geometries(spark, sf):
    """Polygons, with points and lines for two of the kinds: both byte orders, and type codes with Z, M or SRID."""
    point = F.unhex(F.lit("0101000000" + "00" * 16))
    line = F.unhex(F.lit("000000000200000000"))
    # polygon headers: ISO Z, M and ZM, flagged Z with SRID, and big-endian ones
    heads = ["01EB030000", "01D3070000", "01BB0B0000", "01030000A0E6100000", "00000003EB", "0080000003", "01030000C0"]
    empty = F.element_at(F.array(*[F.unhex(F.lit(h + "00000000")) for h in heads]), (F.col("feature_id") % len(heads) + 1).cast("int"))
    return part_polygons(spark, sf).withColumn(
        "geometry", F.when(F.col("size") < 10, point).when(F.col("size") < 20, line).when(F.col("size") < 35, empty).otherwise(F.col("geometry"))
    )


@query("p8_polygons_only", "SELECT feature_id, size FROM corners WHERE size >= 20", ("corners",))
def p8(spark, sf):
    return s.polygons_only(mixed_geometries(spark, sf)).select("feature_id", "size")


@query("p9_align_types", """SELECT l_orderkey::FLOAT::DOUBLE AS l_orderkey, l_linenumber::FLOAT::DOUBLE AS l_linenumber,
 round(l_extendedprice::FLOAT::DOUBLE, 2) AS l_extendedprice, l_returnflag, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM lineitem""")
def p9(spark, sf):
    aligned = c.align_types(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"))
    return aligned.select(
        F.col("l_orderkey").cast("double").alias("l_orderkey"), F.col("l_linenumber").cast("double").alias("l_linenumber"),
        F.round(F.col("l_extendedprice").cast("double"), 2).alias("l_extendedprice"), "l_returnflag",
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("l_shipdate"),
    )


@query("p10_resume", "SELECT id, in_stac FROM layers WHERE coalesce(in_stac, 'no') <> 'yes'", ("layers",))
def p10(spark, sf):
    return s.not_yet_published(made(spark, sf, "layers")).select("id", "in_stac")


@query("p11_downloadable", """SELECT id, download_url FROM layers WHERE suffix(download_url, '.zip') OR suffix(download_url, '.nc')
 OR suffix(download_url, '.csv') OR suffix(download_url, '.parquet') OR contains(download_url, 'parquet/')""", ("layers",))
def p11(spark, sf):
    return s.downloadable(made(spark, sf, "layers"), "download_url").select("id", "download_url")


@query("p12_require_filled", """SELECT 'id' AS column_name, count(*) FILTER (WHERE id IS NULL) AS null_rows FROM layers
 UNION ALL SELECT 'native_asset', count(*) FILTER (WHERE native_asset IS NULL) FROM layers""", ("layers",))
def p12(spark, sf):
    layers = made(spark, sf, "layers").select("id", "thematic_lot", "native_asset")
    return c.null_report(c.require_filled(layers, ["id", "thematic_lot"]), ["id", "native_asset"])


@query("p13_feature_subset", """SELECT feature_id, brand FROM corners WHERE brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4')
 AND least(x1, x4) <= 60e0 AND x2 >= -20e0 AND y1 <= 50e0 AND y3 >= -30e0""", ("corners",))
def p13(spark, sf):
    brands = [f"Brand#{i}" for i in (1, 2, 3, 4)]
    return s.feature_subset(part_bounds(spark, sf), "brand", brands, (-20.0, -30.0, 60.0, 50.0)).select("feature_id", "brand")


def coded_grid(spark, sf):
    features, spec = part_bounds(spark, sf), part_spec(spark, sf)
    codes = g.category_codes(features, ["brand", "kind"])
    coded = g.encode_features(features, ["kind"], codes)
    cells = g.label_cells(g.cell_attributes(part_cells(spark, sf, spec), coded, ["kind", "price"]), spec)
    return g.grid_values(cells, ["kind", "price"]), codes


LABELLED = """
places AS (SELECT cells.*, round(x0 + col * ((x1 - x0) / (width - 1)), 4) AS longitude, round(y0 + row * ((y1 - y0) / (height - 1)), 4) AS latitude FROM cells, s)"""


@query("p14_grid_subset", f"""{BURN_SQL},{CATEGORY_SQL},{LABELLED}
SELECT 'price' AS variable, row::BIGINT AS row, col::BIGINT AS col, round(price, 3) AS value FROM places JOIN corners USING (feature_id)
 WHERE latitude BETWEEN -40 AND 40 AND longitude BETWEEN -60 AND 100 AND price > 950
UNION ALL SELECT 'kind', row, col, CASE WHEN l.label = 'None' THEN code::DOUBLE END FROM places JOIN labels_ l USING (feature_id)
 JOIN categories k ON k.variable = l.variable AND k.label = l.label WHERE l.variable = 'kind' AND latitude BETWEEN -40 AND 40 AND longitude BETWEEN -60 AND 100""", ("corners",))
def p14(spark, sf):
    grid, codes = coded_grid(spark, sf)
    inside = s.grid_subset(grid, lat=(-40.0, 40.0), lon=(-60.0, 100.0))
    prices = s.grid_subset(inside.filter("variable = 'price'"), above=950.0)
    kinds = s.category_mask(inside.filter("variable = 'kind'"), codes, "None")
    return prices.unionByName(kinds).select(
        "variable", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"),
        F.round(F.col("value").cast("double"), 3).alias("value"),
    )


@query("p14_chunk_window", f"""{BURN_SQL} SELECT row::BIGINT AS row, col::BIGINT AS col, round(price, 3) AS value FROM cells JOIN corners USING (feature_id)
 WHERE row BETWEEN 70 AND 190 AND col BETWEEN 130 AND 401""", ("corners",))
def p14_window(spark, sf):
    path = scratch_path(spark, "window")
    grid, _ = coded_grid(spark, sf)
    write_grid(grid, path, size=50)
    cells = read_chunks(spark, path, ["price"], (70, 190), (130, 401), 50)
    return cells.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.round(F.col("value").cast("double"), 3).alias("value"))


@query("p15_convertible", "SELECT id, native_data_product IS NOT NULL AS to_convert FROM layers", ("layers",))
def p15(spark, sf):
    return s.convertible(made(spark, sf, "layers").withColumnRenamed("native_data_product", "attributes")).select("id", "to_convert")


@query("p16_probe", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey LIMIT 10")
def p16(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return s.first_rows(lines.orderBy("l_orderkey", "l_linenumber", "l_partkey"))


INPUTS["packages"] = """
SELECT cast(o_custkey AS string) AS id, o_orderkey AS pos, 'pack/' || o_orderstatus || cast(o_orderkey % 3 AS string) || CASE o_orderkey % 4
 WHEN 0 THEN '.gdb' WHEN 1 THEN '.txt' ELSE '.shp' END AS path FROM @orders"""
INPUTS["wanted"] = """
SELECT id, CASE pos % 3 WHEN 0 THEN 'F1.gdb_zones' WHEN 1 THEN 'O2.shp' ELSE 'P0.gdb' END AS native_data_product FROM (""" + INPUTS["layers"] + ") l"


@query("p17_convertible_files", "SELECT id, pos, path FROM packages WHERE NOT suffix(path, '.txt')", ("packages",))
def p17_files(spark, sf):
    return s.convertible_files(made(spark, sf, "packages"))


@query("p17_choose_products", """SELECT w.id, w.p AS product, w.l AS product_layer, arg_min(path, pos) AS path FROM
 (SELECT id, CASE WHEN contains(native_data_product, '.gdb_') THEN split_part(native_data_product, '_', 1) ELSE native_data_product END AS p,
  CASE WHEN contains(native_data_product, '.gdb_') THEN split_part(native_data_product, '_', 2) END AS l FROM wanted) w
 JOIN packages k ON w.id = k.id AND k.path = 'pack/' || w.p WHERE NOT suffix(path, '.txt') GROUP BY ALL""", ("packages", "wanted"))
def p17(spark, sf):
    return s.choose_products(made(spark, sf, "wanted"), made(spark, sf, "packages"))


@query("o1_sort_by_latitude", f"{BURN_SQL},{LABELLED} SELECT row::BIGINT AS row, col::BIGINT AS col, latitude FROM places ORDER BY latitude, longitude", ("corners",))
def o1(spark, sf):
    spec = part_spec(spark, sf)
    placed = g.label_cells(part_cells(spark, sf, spec), spec).orderBy("latitude", "longitude")
    return placed.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "latitude")


@query("o2_first_rows", "SELECT event_id, user_id, value FROM events ORDER BY event_id LIMIT 10")
def o2(spark, sf):
    return s.first_rows(table(spark, sf, "events").select("event_id", "user_id", "value").orderBy("event_id"))


@query("o3_first_download", """SELECT id, CASE WHEN NOT suffix(download_url, '.html') THEN download_url WHEN native_asset IS NOT NULL THEN native_asset END AS link FROM layers""", ("layers",))
def o3(spark, sf):
    assets = F.filter(F.array(F.lit("https://example.org/info"), F.col("native_asset")), lambda a: a.isNotNull())
    return made(spark, sf, "layers").select("id", first_download(F.col("download_url"), assets).alias("link"))

"""G1-G9."""

from pyspark.sql import functions as F

from contract.geo import BURN_SQL, CATEGORY_SQL, part_bounds, part_cells, part_polygons, part_spec
from contract.q_select import LABELLED, coded_grid
from contract.registry import made, query
from shoalgrid.operators import grid as g
from shoalgrid.operators.geometry import polygon_edges
from shoalgrid.operators.select import polygons_only

_PAIRS = [(1, 2), (2, 3), (3, 4), (4, 1), (5, 6), (6, 7), (7, 5)]
_EDGES = " UNION ALL ".join(f"SELECT feature_id, 0 AS part, x{a} AS ax, y{a} AS ay, x{b} AS bx, y{b} AS by FROM corners" for a, b in _PAIRS)


@query("g1_polygon_edges", _EDGES.replace(" AS by ", ' AS "by" '), ("corners",))
def g1(spark, sf):
    return polygon_edges(polygons_only(part_polygons(spark, sf)))


@query("g2_grid_spec", f"{BURN_SQL} SELECT x0, y0, x1, y1, width, height, px, py FROM s", ("corners",))
def g2(spark, sf):
    spec = part_spec(spark, sf)
    return part_bounds(spark, sf).agg(F.min("xmin").alias("x0"), F.min("ymin").alias("y0")).select(
        "x0", "y0", F.lit(spec.x1).alias("x1"), F.lit(spec.y1).alias("y1"), F.lit(spec.width).cast("long").alias("width"),
        F.lit(spec.height).cast("long").alias("height"), F.lit(spec.px).alias("px"), F.lit(spec.py).alias("py"),
    )


@query("g3_burn_polygons", f"{BURN_SQL} SELECT row::BIGINT AS row, col::BIGINT AS col, feature_id FROM cells", ("corners",))
def g3(spark, sf):
    cells = part_cells(spark, sf)
    return cells.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "feature_id")


@query("g4_label_cells", f"{BURN_SQL},{LABELLED} SELECT row::BIGINT AS row, col::BIGINT AS col, latitude, longitude FROM places", ("corners",))
def g4(spark, sf):
    spec = part_spec(spark, sf)
    placed = g.label_cells(part_cells(spark, sf, spec), spec)
    return placed.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "latitude", "longitude")


@query("g5_grid_chunks", f"""{BURN_SQL}, p AS (SELECT row // 50 AS chunk_row, col // 50 AS chunk_col, row % 50 * 50 + col % 50 AS place, price FROM cells JOIN corners USING (feature_id))
SELECT 'price' AS variable, chunk_row::BIGINT AS chunk_row, chunk_col::BIGINT AS chunk_col, 2500::BIGINT AS cells, count(*) AS filled, min(place)::BIGINT AS first_at, sum((place * round(price::FLOAT::DOUBLE))::BIGINT)::BIGINT AS place_sum FROM p GROUP BY ALL""", ("corners",))
def g5(spark, sf):
    cells = g.cell_attributes(part_cells(spark, sf), part_bounds(spark, sf), ["price"])
    chunks = g.grid_chunks(g.grid_values(cells, ["price"]), 50)
    opened = chunks.select("*", F.posexplode("values").alias("at", "value")).groupBy("variable", "chunk_row", "chunk_col")
    return opened.agg(
        F.count(F.lit(1)).alias("cells"), F.count("value").alias("filled"),
        F.min(F.when(F.col("value").isNotNull(), F.col("at"))).cast("long").alias("first_at"),
        F.sum((F.col("at") * F.round(F.col("value").cast("double"))).cast("long")).alias("place_sum"),
    ).withColumn("chunk_row", F.col("chunk_row").cast("long")).withColumn("chunk_col", F.col("chunk_col").cast("long"))


@query("g6_grid_values", f"""{BURN_SQL},{CATEGORY_SQL} SELECT 'price' AS variable, row::BIGINT AS row, col::BIGINT AS col, round(price, 3) AS value FROM cells JOIN corners USING (feature_id)
UNION ALL SELECT 'kind', row, col, code::DOUBLE FROM cells JOIN labels_ l USING (feature_id) JOIN categories k ON k.variable = l.variable AND k.label = l.label WHERE l.variable = 'kind'""", ("corners",))
def g6(spark, sf):
    return coded_grid(spark, sf)[0].select(
        "variable", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.round(F.col("value").cast("double"), 3).alias("value")
    )


@query("g7_decode_categories", f"""{BURN_SQL},{CATEGORY_SQL} SELECT row::BIGINT AS row, col::BIGINT AS col, label FROM cells JOIN labels_ USING (feature_id) WHERE variable = 'kind'""", ("corners",))
def g7(spark, sf):
    grid, codes = coded_grid(spark, sf)
    decoded = g.decode_categories(grid.filter("variable = 'kind'"), codes)
    return decoded.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "label")


@query("g8_crs_attributes", "SELECT DISTINCT variable, 'EPSG:4326' AS crs, 'EPSG:3035' AS source_crs FROM readings", ("readings",))
def g8(spark, sf):
    return g.crs_attributes(made(spark, sf, "readings"), "EPSG:3035")


@query("g9_band_table", "SELECT user_id % 3 AS band, count(*) AS cells, count(CASE WHEN value > 5 THEN 1 END) AS filled, min(variable) AS description, 'depth' AS variable FROM readings GROUP BY 1", ("readings",))
def g9(spark, sf):
    raster = made(spark, sf, "readings").select(
        (F.col("user_id") % 3).alias("band"), F.when(F.col("value") > 5, F.col("value")).alias("value"), F.col("variable").alias("description")
    )
    return g.band_table(raster, {"band_1": "depth"})

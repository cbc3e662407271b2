"""The whole jobs, end to end."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.geo import BURN_SQL, CATEGORY_SQL, part_polygons, part_spec
from contract.q_select import LABELLED, coded_grid
from contract.registry import INPUTS, made, query
from contract import q_sources  # noqa: F401  (inputs)
from shoalgrid.functions.extents import rectangle, time_pair
from shoalgrid.functions.records import record_facts
from shoalgrid.operators import state as st
from shoalgrid.plans import catalogue as cat
from shoalgrid.plans.run import (
    RunSettings, build_catalogue, complete_layers, convert_features, grid_features, publish_grid, stage, table_to_store,
)
from shoalgrid.session import scratch_path
from shoalgrid.sources.features import read_cube
from shoalgrid.sources.catalogue import flatten_layer_tree, with_id, without_id

SETTINGS = RunSettings(run_year=2024, record_host="https://g.example.org")
_FIELDS = """id string, name string, metadataSources array<struct<metadata_type:string,metadata_value:string>>,
 temporalDatesExtent string, bbox array<struct<west:double,south:double,east:double,north:double>>,
 responsibleParties array<struct<name:string,role:string>>, attributes map<string,struct<name_custom:string,description:string>>"""

# One tree per layer, with everything the run reads.
INPUTS["run_trees"] = ("""
SELECT pos, '{"layerCatalog":{"children":[{"name":"' || thematic_lot || '","children":[{"displayName":"' || subtheme || '","children":[{"displayName":"' || subsubtheme
 || '","children":[{"id":"' || id || '","name":"' || name || '","metadataSources":[{"metadata_type":"download_url","metadata_value":"' || download_url
 || '"},{"metadata_type":"geonetwork_uri","metadata_value":"u' || id || '"}],"temporalDatesExtent":"' || CASE WHEN balance > 5000e0 THEN '2001-02-03/2005-06-07' WHEN balance > 2000e0 THEN '2011' ELSE 'n/a' END || '"'
 || CASE WHEN balance > 0e0 THEN ',"bbox":[{"west":1.5,"south":2.5,"east":3.5,"north":4.5}],"attributes":{"DEPTH":{"name_custom":"Depth m","description":"deep"},"ZONE":{"description":""}}' ELSE '' END
 || '},{"name":"no id"}]}]}]}]}}' AS json FROM (""" + INPUTS["layers"] + ") l")

_LAST = "prev AS (SELECT id, arg_max(download_url, pos) AS download_url, arg_max(struct_pack(a := native_asset), pos).a AS native_asset FROM state_rows GROUP BY id)"
RUN_SQL = f"""
WITH {_LAST}, best AS (SELECT standard_name, arg_min(convention, file) AS convention FROM names GROUP BY standard_name),
l2 AS (SELECT l.id, l.pos, l.name, lower(subtheme) AS family, subsubtheme, balance, CASE WHEN p.download_url = l.download_url THEN p.native_asset END AS own, l.download_url,
 p.native_asset AS prev_asset FROM layers l LEFT JOIN prev p ON l.id = p.id AND l.pos % 9 <> 0),
l3 AS (SELECT *, coalesce(own, first_value(own IGNORE NULLS) OVER (PARTITION BY download_url ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS native_asset FROM l2),
l4 AS (SELECT *, CASE WHEN pos % 11 = 0 THEN '1999-05-06' WHEN balance > 5000 THEN '2001-02-03' WHEN pos % 3 > 0 AND pos % 7 > 0 THEN CASE WHEN pos % 4 = 0 THEN (1950 + pos % 60) || '-01-01' ELSE least((1950 + pos % 60) || '-01-01', '2015-06-01') END ELSE '1900-01-01' END AS d0,
 CASE WHEN pos % 11 = 0 THEN '2003-04-05' WHEN balance > 5000 THEN '2005-06-07' WHEN pos % 3 > 0 AND pos % 7 > 0 THEN CASE WHEN pos % 4 = 0 THEN '2024-12-31' ELSE greatest((1950 + pos % 60) || '-01-01', '2015-06-01') END
   WHEN balance > 2000 THEN '2011-01-01' ELSE '2024-12-31' END AS d1,
 CASE WHEN balance > 0 THEN '1.5_2.5_3.5_4.5' WHEN pos % 11 = 0 THEN '10.0_20.0_30.0_40.0' WHEN pos % 5 > 0 AND pos % 7 > 0 THEN (pos % 170) || '.5_-' || (pos % 80) || '.25_175.0_80.0' ELSE '-180.0_-90.0_180.0_90.0' END AS box,
 balance > 0 AND prev_asset IS NOT DISTINCT FROM native_asset AND prev_asset IS NOT NULL AS is_converted FROM l3 WHERE native_asset IS NOT NULL),
r AS (SELECT *, 'native' AS kind, subsubtheme AS variable, replace(lower(name), '#', '') AS item_id FROM l4 WHERE subsubtheme <> ''
 UNION ALL SELECT *, 'converted', 'depth_m', 'depth_m_' || d0 || 'T00:00:00Z_' || d1 || 'T00:00:00Z_' || box FROM l4 WHERE is_converted AND subsubtheme <> ''
 UNION ALL SELECT *, 'converted', 'zone', 'zone_' || d0 || 'T00:00:00Z_' || d1 || 'T00:00:00Z_' || box FROM l4 WHERE is_converted AND subsubtheme <> ''),
out AS (SELECT r.*, coalesce(convention, 'local') || '-' || lower(variable) AS collection FROM r LEFT JOIN best ON standard_name = lower(variable)
 QUALIFY row_number() OVER (PARTITION BY family, collection, item_id ORDER BY pos DESC) = 1)
SELECT kind, id, family, collection, item_id FROM out
UNION ALL SELECT 'status', id, CASE WHEN n > 0 THEN 'yes' ELSE 'no' END, NULL, n::VARCHAR FROM (SELECT l.id, (SELECT count(*) FROM r WHERE r.id = l.id) AS n FROM layers l)
UNION ALL SELECT DISTINCT 'family', NULL, lower(subtheme), NULL, NULL FROM layers
UNION ALL SELECT DISTINCT 'collection', NULL, family, collection, NULL FROM out
UNION ALL SELECT 'name', NULL, NULL, convention, standard_name FROM names UNION ALL SELECT DISTINCT 'name', NULL, NULL, 'local', lower(variable) FROM r WHERE lower(variable) NOT IN (SELECT standard_name FROM names)"""


def run_layers(spark, sf):
    """Completed layers and the rejects of the tree."""
    tree = stage(flatten_layer_tree(made(spark, sf, "run_trees"), "json", "pos", _FIELDS), "tree")
    links = F.array(*[F.concat(F.lit("https://s3.example.org/c"), "id", F.lit(x)) for x in (".parquet", ".zarr", ".csv")])
    mapping = F.create_map(F.lit("ZONE"), F.lit("zone"), F.lit("DEPTH"), F.lit("depth_m"))
    previous = st.newest_rows(made(spark, sf, "state_rows"), ["id"], "pos").withColumns({
        "native_arco_mapping": mapping, "converted_arco_assets": F.when(F.col("native_asset").isNotNull(), links),
    })
    records = record_facts(made(spark, sf, "records"), "xml").select("id", "box", "period", "organisation", "constraints")
    layers = made(spark, sf, "layers")
    again = layers.where("pos % 9 = 0").select("id")
    day = lambda text: F.lit(text).cast("timestamp")
    extents = layers.where("pos % 11 = 0").select("id").withColumns({
        "grid_time": time_pair(day("1999-05-06"), day("2003-04-05")), "table_time": time_pair(day("1990-01-01"), day("1991-01-01")),
        "grid_box": rectangle(*[F.lit(float(v)) for v in (10, 20, 30, 40)]),
    })
    return complete_layers(with_id(tree), previous, again, records, extents, SETTINGS), without_id(tree)


@query("run_catalogue", RUN_SQL, ("layers", "names", "state_rows"))
def run_catalogue(spark, sf):
    layers, rejects = run_layers(spark, sf)
    layers = stage(layers, "layers")
    found = cat.mapped_variables(layers.filter(F.size("converted_arco_assets") > 0)).select("id", F.col("variable").alias("name"))
    tables = build_catalogue(layers, found, made(spark, sf, "names"), rejects, SETTINGS)
    none = F.lit(None).cast("string")

    def shown(name, kind, **columns):
        own = {"id": none, "family": none, "collection": none, "item_id": none, **columns}
        return tables[name].select(F.lit(kind).alias("kind"), *[v.alias(k) for k, v in own.items()])

    return reduce(DataFrame.unionByName, [
        tables["items"].select("kind", "id", "family", "collection", "item_id"),
        shown("status", "status", id=F.col("id"), family=F.col("in_stac"), item_id=F.col("items").cast("string")),
        shown("families", "family", family=F.col("family")),
        shown("collections", "collection", family=F.col("family"), collection=F.col("collection")),
        shown("standard_names", "name", collection=F.col("convention"), item_id=F.col("standard_name")),
    ])


@query("run_feature_grid", f"""{BURN_SQL},{CATEGORY_SQL}
SELECT 'cost' AS variable, row::BIGINT AS row, col::BIGINT AS col, round(price::DOUBLE, 3) AS value FROM cells JOIN corners USING (feature_id)
UNION ALL SELECT 'maker', row, col, code::DOUBLE FROM cells JOIN labels_ l USING (feature_id) JOIN categories c ON c.variable = l.variable AND c.label = l.label WHERE l.variable = 'brand'""", ("corners",))
def run_feature_grid(spark, sf):
    features, _ = convert_features(part_polygons(spark, sf), {"price": "cost", "brand": "maker", "absent": "x"})
    grid, _, _ = grid_features(features, ["cost"], ["maker"], 0.5)
    return grid.select(
        "variable", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"),
        F.round(F.col("value").cast("double"), 3).alias("value"),
    )


INPUTS["daily"] = """
SELECT latitude AS lat, longitude AS lon, date_trunc('day', time) AS time, max(value) AS READING, count(*) AS hits FROM (""" + INPUTS["readings"] + """) r
GROUP BY latitude, longitude, date_trunc('day', time)"""


@query("run_table_to_cube", """WITH d AS (SELECT lat AS latitude, lon AS longitude, time, READING AS reading, hits FROM daily)
SELECT a.latitude, o.longitude, strftime(t.time, '%Y-%m-%d') AS day, reading, coalesce(hits, 0) AS hits FROM (SELECT DISTINCT latitude FROM d) a CROSS JOIN (SELECT DISTINCT longitude FROM d) o
 CROSS JOIN (SELECT DISTINCT time FROM d) t LEFT JOIN d ON d.latitude = a.latitude AND d.longitude = o.longitude AND d.time = t.time""", ("daily",))
def run_table_to_cube(spark, sf):
    path = scratch_path(spark, "cube")
    table_to_store(made(spark, sf, "daily"), {"READING": "reading"}, path)
    cube = read_cube(spark, path, dense=True)
    return cube.select("latitude", "longitude", F.date_format("time", "yyyy-MM-dd").alias("day"), "reading", F.coalesce("hits", F.lit(0)).alias("hits"))


@query("run_publish_grid", f"""{BURN_SQL},{CATEGORY_SQL},{LABELLED} SELECT v.variable, 'EPSG:4326' AS crs, 'EPSG:3035' AS source_crs, (SELECT round(y0, 4) FROM s) AS geospatial_lat_min, (SELECT round(x1, 4) FROM s) AS geospatial_lon_max,
 (SELECT count(*) FROM cells) AS filled, CASE v.variable WHEN 'sort' THEN (SELECT count(*) FROM categories WHERE variable = 'kind') ELSE 0 END AS codes, 'parts' AS title
 FROM (VALUES ('price'), ('sort')) v(variable)""", ("corners",))
def run_publish_grid(spark, sf):
    grid, codes = coded_grid(spark, sf)
    path = scratch_path(spark, "published")
    publish_grid(grid, path, {"kind": "sort"}, "parts", "lot", "asset", "2024-05-01", "EPSG:3035", codes, spec=part_spec(spark, sf))
    filled = spark.read.parquet(path).select("variable", F.size(F.filter("values", lambda v: v.isNotNull())).alias("n"))
    counted = filled.groupBy("variable").agg(F.sum("n").alias("filled"))
    named = spark.read.parquet(f"{path}_categories").groupBy("variable").agg(F.count(F.lit(1)).alias("codes"))
    title = spark.read.parquet(f"{path}_attributes").select("title").scalar()
    return spark.read.parquet(f"{path}_variables").join(counted, "variable").join(named, "variable", "left").select(
        "variable", "crs", "source_crs", "geospatial_lat_min", "geospatial_lon_max", "filled",
        F.coalesce("codes", F.lit(0)).alias("codes"), title.alias("title"),
    )

"""C1-C10 on layers made of the customers."""

from pyspark.sql import functions as F

from contract.registry import INPUTS, made, query
from contract import q_sources  # noqa: F401  (inputs)
from shoalgrid.functions.extents import provider, rectangle, time_pair
from shoalgrid.functions.text import description_map, name_mapping
from shoalgrid.plans import catalogue as cat
from shoalgrid.plans.run import stage
from shoalgrid.plans import reports as rp
from shoalgrid.session import scratch_path
from shoalgrid.sinks.writers import write_documents
from shoalgrid.sources.catalogue import flatten_layer_tree, without_id

_CONV = "native_asset IS NOT NULL AND balance > 1500e0"
INPUTS["cat_layers"] = f"""
SELECT l.*, west + 10.5e0 AS east, south + 20.25e0 AS north, cast(1980 + pos % 40 AS int) AS start_year, cast(2000 + pos % 20 AS int) AS end_year,
 {_CONV} AS is_converted, 'Depth m ' || cast(pos % 5 AS string) AS custom_a FROM ({INPUTS['layers']}) l"""


def cat_layers(spark, sf):
    """Layers with all the columns the catalogue plans read."""
    base = made(spark, sf, "cat_layers")

    def attribute(custom, description):
        return F.struct(custom.alias("name_custom"), description.alias("description"))

    attributes = F.map_from_arrays(
        F.array(F.lit("DEPTH"), F.lit("ZONE"), F.lit("gone")),
        F.array(
            attribute(F.col("custom_a"), F.lit("deep")),
            attribute(F.lit(None).cast("string"), F.lit("")),
            attribute(F.lit("lost"), F.lit("")),
        ),
    )
    home = F.concat(F.lit("https://s3.example.org/c"), "id")
    converted = F.when(F.col("is_converted"), F.array(F.concat(home, F.lit(".parquet")), F.concat(home, F.lit(".zarr"))))
    return (
        base.withColumn("attributes", F.when(F.col("is_converted"), attributes))
        .withColumn("native_arco_mapping", name_mapping(F.col("attributes")))
        .withColumn("arco_variable_description", description_map(F.col("attributes")))
        .withColumn("converted_arco_assets", F.coalesce(converted, F.array().cast("array<string>")))
        .withColumn("assets", F.array(F.lit("https://example.org/old.csv"), F.lit("https://example.org/unknown.bin"), F.regexp_replace("download_url", r"\.[a-z]+/?$", ".csv")))
        .withColumn("download_url", F.regexp_replace("download_url", r"\.[a-z]+/?$", ".csv"))
        .withColumn("provider", F.array(provider(F.col("thematic_lot"), F.lit("owner"))))
        .withColumn("data_rights", F.lit("CC-BY-4.0"))
        .withColumn("time", time_pair(F.make_timestamp("start_year", F.lit(1), F.lit(1), F.lit(5), F.lit(0), F.lit(0)), F.make_timestamp("end_year", F.lit(12), F.lit(31), F.lit(23), F.lit(59), F.lit(59))))
        .withColumn("extent", rectangle(*[F.col(c) for c in ("west", "south", "east", "north")]))
    )


def asset_variables(spark, sf):
    """Variables found in the converted assets: all mapped ones but ``lost``."""
    mapped = cat.mapped_variables(cat_layers(spark, sf))
    return mapped.filter("variable <> 'lost'").select("id", F.col("variable").alias("name"))


def made_items(spark, sf):
    layers, names = cat_layers(spark, sf), made(spark, sf, "names")
    native = cat.native_items(layers, names, "local")
    return native.unionByName(cat.converted_items(layers, asset_variables(spark, sf), names, "local"))


def items(spark, sf):
    return cat.newest_items(stage(made_items(spark, sf), "items"))


# The same rows put together by hand: one native item per layer, two converted ones.
ITEMS_SQL = """
WITH best AS (SELECT standard_name, arg_min(convention, file) AS convention FROM names GROUP BY standard_name),
base AS (SELECT *, regexp_replace(download_url, '\\.[a-z]+/?$', '.csv') AS csv_url, lower(subtheme) AS family, start_year || '-01-01' AS d0, end_year || '-12-31' AS d1,
  west || '_' || south || '_' || east || '_' || north AS box FROM cat_layers WHERE native_asset IS NOT NULL),
rows_ AS (
 SELECT *, 0 AS item_pos, 'native' AS kind, subsubtheme AS variable, NULL AS native_variable, replace(lower(name), '#', '') AS item_id FROM base WHERE subsubtheme <> ''
 UNION ALL SELECT *, 1, 'converted', 'depth_m_' || pos % 5, 'DEPTH', 'depth_m_' || pos % 5 || '_' || d0 || 'T00:00:00Z_' || d1 || 'T00:00:00Z_' || box FROM base WHERE is_converted AND subsubtheme <> ''
 UNION ALL SELECT *, 2, 'converted', 'zone', 'ZONE', 'zone_' || d0 || 'T00:00:00Z_' || d1 || 'T00:00:00Z_' || box FROM base WHERE is_converted AND subsubtheme <> ''),
made_ AS (SELECT r.* EXCLUDE (download_url), csv_url AS download_url, coalesce(convention, 'local') || '-' || lower(variable) AS collection, d0 || ' 00:00:00' AS start_day, d1 || ' 00:00:00' AS end_day
 FROM rows_ r LEFT JOIN best ON standard_name = lower(variable)),
items_ AS (SELECT * FROM made_ QUALIFY row_number() OVER (PARTITION BY family, collection, item_id ORDER BY pos DESC, item_pos DESC) = 1)"""


@query("c1_families", """SELECT lower(subtheme) AS family, min(pos) AS first_pos, lower(subtheme) AS title, 'Variable Family ' || lower(subtheme) AS description FROM cat_layers GROUP BY ALL""", ("cat_layers",))
def c1(spark, sf):
    return cat.families(cat_layers(spark, sf))


@query("c2_collections", f"""{ITEMS_SQL}, f AS (SELECT family, collection, arg_min(variable, (pos, item_pos)) AS title, arg_min(thematic_lot, (pos, item_pos)) AS provider FROM made_ GROUP BY ALL)
SELECT f.*, 'A collection of ' || title || ' data' AS description, 'CC-BY-4.0+' AS licence, min(west) AS west, max(north) AS north, count(*) AS items FROM f JOIN items_ USING (family, collection) GROUP BY ALL""", ("cat_layers", "names"))
def c2(spark, sf):
    every = made_items(spark, sf)
    every = stage(every.withColumn("layer_providers", F.concat("layer_providers", "layer_providers")), "items")  # each name twice
    return cat.collections(cat.newest_items(every), every).select(
        "family", "collection", "title", F.array_join(F.transform("providers", lambda p: p["name"]), ",").alias("provider"), "description", "licence", "west", "north", "items"
    )


_ITEM_COLUMNS = "id, family, collection, variable, item_id, upper(substr(item_id, 1, 1)) || lower(substr(replace(item_id, '_', ' '), 2)) AS title, start_day AS \"start\", end_day AS \"end\""


def item_view(df, *more):
    return df.select(
        *more, "id", "family", "collection", "variable", "item_id", "title",
        *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("start", "end")],
    )


@query("c3_native_items", f"{ITEMS_SQL} SELECT {_ITEM_COLUMNS} FROM items_ WHERE kind = 'native'", ("cat_layers", "names"))
def c3(spark, sf):
    return item_view(cat.newest_items(cat.native_items(cat_layers(spark, sf), made(spark, sf, "names"), "local")))


@query("c4_converted_items", f"{ITEMS_SQL} SELECT {_ITEM_COLUMNS}, native_variable FROM items_ WHERE kind = 'converted'", ("cat_layers", "names"))
def c4(spark, sf):
    found = cat.newest_items(cat.converted_items(cat_layers(spark, sf), asset_variables(spark, sf), made(spark, sf, "names"), "local"))
    return item_view(found, "native_variable")


@query("c5_item_assets", f"""{ITEMS_SQL} SELECT item_id, collection, (2 + CASE WHEN kind = 'native' THEN 0 WHEN suffix(native_asset, '.zip') THEN 2 ELSE 1 END)::BIGINT AS assets,
 CASE WHEN kind = 'converted' THEN 'application/vnd+zarr' END AS grid_media FROM items_""", ("cat_layers", "names"))
def c5(spark, sf):
    return cat.item_assets(items(spark, sf)).groupBy("family", "collection", "item_id").agg(
        F.count(F.lit(1)).alias("assets"), F.max(F.when(F.col("asset_kind") == "zarr", F.col("media"))).alias("grid_media")
    ).drop("family")


@query("c6_layer_status", f"""{ITEMS_SQL} SELECT l.id, l.pos, CASE WHEN count(i.id) > 0 THEN 'yes' ELSE 'no' END AS in_stac, count(i.id) AS items
 FROM cat_layers l LEFT JOIN made_ i ON l.id = i.id GROUP BY l.id, l.pos""", ("cat_layers", "names"))
def c6(spark, sf):
    return cat.layer_status(cat_layers(spark, sf), made_items(spark, sf))


@query("c7_attribute_table", f"""{ITEMS_SQL}, rows2 AS (SELECT id, pos, name, coalesce(native_data_product, '') AS data_product, is_converted, unnest(CASE WHEN is_converted THEN
  [{{'n': 'DEPTH', 'v': 'depth_m_' || pos % 5}}, {{'n': 'ZONE', 'v': 'zone'}}, {{'n': 'gone', 'v': 'lost'}}] ELSE [{{'n': '', 'v': ''}}] END) AS a FROM cat_layers)
SELECT r.id, r.name AS collection_item, data_product, a.n AS updated_native_variable, a.v AS updated_arco_variable, coalesce(r.is_converted, FALSE) AND a.v <> 'lost' AS in_arco, i.id IS NOT NULL AS in_stac
 FROM rows2 r LEFT JOIN made_ i ON r.id = i.id AND i.kind = 'converted' AND i.variable = a.v""", ("cat_layers", "names"))
def c7(spark, sf):
    published = cat.variables_published(made_items(spark, sf))
    return rp.attribute_table(cat_layers(spark, sf), asset_variables(spark, sf), published).select(
        "id", "collection_item", "data_product", "updated_native_variable", "updated_arco_variable", "in_arco", "in_stac"
    )


@query("c8_portal_table", """SELECT l.id, thematic_lot, name AS title, subtheme, subsubtheme, coalesce(arg_max(metadata_value, m.pos), '') AS download_url FROM layers l
 LEFT JOIN metadata_rows m ON l.id = m.id AND metadata_type = 'download_url' WHERE thematic_lot NOT IN ('AFRICA', 'ASIA') GROUP BY ALL""", ("layers", "metadata_rows"))
def c8(spark, sf):
    return rp.portal_table(made(spark, sf, "layers"), made(spark, sf, "metadata_rows"), ["AFRICA", "ASIA"])


@query("c9_transformation_table", f"""{ITEMS_SQL} SELECT l.id, l.thematic_lot, l.name AS title, coalesce(l.native_asset, '') AS native_asset, l.subtheme AS family, l.subsubtheme AS collection,
 CASE WHEN count(i.id) > 0 THEN 'yes' ELSE 'no' END AS in_stac FROM cat_layers l LEFT JOIN made_ i ON l.id = i.id GROUP BY ALL""", ("cat_layers", "names"))
def c9(spark, sf):
    layers = cat_layers(spark, sf)
    status = cat.layer_status(layers, made_items(spark, sf)).select("id", "in_stac")
    run = layers.drop("in_stac").join(status, "id")
    portal = rp.portal_table(made(spark, sf, "layers"), made(spark, sf, "metadata_rows"), [])
    return rp.transformation_table(portal, run).select("id", "thematic_lot", "title", "native_asset", "family", "collection", "in_stac")


@query("c10_issues", """SELECT 'tree' AS stage, NULL AS id, 'no_id' AS code, 'no id' AS detail FROM layers
UNION ALL SELECT 'tree', id, 'no_subsubtheme', name FROM cat_layers WHERE subsubtheme = ''
UNION ALL SELECT 'items', id, 'no_native_asset', name FROM cat_layers WHERE native_asset IS NULL
UNION ALL SELECT 'assets', id, 'unknown_kind', 'https://example.org/unknown.bin' FROM cat_layers
UNION ALL SELECT 'items', id, 'variable_not_in_assets', 'lost' FROM cat_layers WHERE is_converted""", ("cat_layers", "layers"))
def c10(spark, sf):
    layers = cat_layers(spark, sf)
    rejects = without_id(flatten_layer_tree(made(spark, sf, "trees"), "json", "pos"))
    missing = cat.variables_missing(cat.mapped_variables(layers), asset_variables(spark, sf))
    return cat.issues(layers, rejects, missing)


_DOCS = """, fam AS (SELECT DISTINCT lower(subtheme) AS family FROM cat_layers), col AS (SELECT DISTINCT family, collection FROM items_)"""


@query("k7_catalogue_links", f"""{ITEMS_SQL}{_DOCS}
SELECT 'root' AS kind, NULL AS family, NULL AS collection, 'sea_data' AS id, 'root' AS rel, 'catalog.json' AS href
UNION ALL SELECT 'root', NULL, NULL, 'sea_data', 'child', family || '/catalog.json' FROM fam
UNION ALL SELECT 'family', family, NULL, family, unnest(['root', 'parent']), 'catalog.json' FROM fam
UNION ALL SELECT 'family', family, NULL, family, 'child', family || '/' || collection || '/collection.json' FROM col
UNION ALL SELECT 'collection', family, collection, collection, 'root', 'catalog.json' FROM col
UNION ALL SELECT 'collection', family, collection, collection, 'parent', family || '/catalog.json' FROM col
UNION ALL SELECT 'collection', family, collection, collection, 'item', family || '/' || collection || '/' || item_id || '/' || item_id || '.json' FROM items_
UNION ALL SELECT 'item', family, collection, item_id, 'root', 'catalog.json' FROM items_
UNION ALL SELECT 'item', family, collection, item_id, unnest(['parent', 'collection']), family || '/' || collection || '/collection.json' FROM items_""", ("cat_layers", "names"))
def k7_links(spark, sf):
    found = stage(items(spark, sf), "newest")
    return cat.catalogue_links(cat.families(cat_layers(spark, sf)), cat.collections(found), found, "Sea Data")


@query("k7_item_documents", f"""{ITEMS_SQL} SELECT family, collection, item_id AS id, 4326 AS epsg, west, north, native_variable,
 CASE WHEN variable = 'zone' THEN 'mud=2,sand=1' END AS encoding, kind = 'converted' AS has_cube, CASE WHEN kind = 'converted' THEN 'https://s3.example.org/c' || id || '.zarr' END AS zarr FROM items_""", ("cat_layers", "names"))
def k7_items(spark, sf):
    found = stage(items(spark, sf), "newest")
    found = found.withColumn("converted_arco_assets", F.array(F.concat(F.lit("https://s3.example.org/c"), "id", F.lit(".zarr"))))
    codes = found.where("variable = 'zone'").select("id", "variable").distinct().select("*", F.explode(F.array(
        *[F.struct(F.lit(k).alias("label"), F.lit(v).cast("long").alias("code")) for k, v in (("sand", 1), ("mud", 2))])).alias("x")).select("id", "variable", "x.*")
    path = scratch_path(spark, "documents")
    write_documents(cat.item_documents(found, cat.item_assets(found), codes), path, ["family", "collection"])
    doc = F.from_json("value", """id string, bbox array<double>, stac_extensions array<string>, assets map<string,struct<href:string>>,
      properties struct<`proj:epsg`:int,native_variable:string,categorical_encoding:map<string,long>>""")
    read = spark.read.text(path).select("family", "collection", doc.alias("d"))
    entries = F.transform(F.map_entries("d.properties.categorical_encoding"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return read.select(
        "family", "collection", "d.id", F.col("d.properties.`proj:epsg`").alias("epsg"), F.col("d.bbox")[0].alias("west"), F.col("d.bbox")[3].alias("north"),
        "d.properties.native_variable", F.array_join(F.array_sort(entries), ",").alias("encoding"),
        F.exists("d.stac_extensions", lambda x: x.contains("datacube")).alias("has_cube"), F.try_element_at("d.assets", F.lit("zarr"))["href"].alias("zarr"))


@query("k7_collection_documents", f"""{ITEMS_SQL}, f AS (SELECT family, collection, arg_min(variable, (pos, item_pos)) AS title FROM items_ GROUP BY ALL)
SELECT 'Collection' AS type, collection AS id, title, min(west) AS west, min(start_day) AS "start" FROM f JOIN items_ USING (family, collection) GROUP BY family, collection, title
UNION ALL SELECT 'Catalog', lower(subtheme), lower(subtheme), NULL, NULL FROM cat_layers GROUP BY ALL UNION ALL SELECT 'Catalog', 'sea_data', 'Sea Data', NULL, NULL""", ("cat_layers", "names"))
def k7_collections(spark, sf):
    made_ = cat.collection_documents(cat.collections(items(spark, sf))).select(
        "type", "id", "title", F.col("extent.spatial")[0][0].alias("west"), F.date_format(F.col("extent.temporal")[0][0], "yyyy-MM-dd HH:mm:ss").alias("start"))
    tops = cat.family_documents(cat.families(cat_layers(spark, sf)), "Sea Data")
    return made_.unionByName(tops.select("type", "id", "title", F.lit(None).cast("double").alias("west"), F.lit(None).cast("string").alias("start")))

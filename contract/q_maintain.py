"""M1-M8: customers as the store, orders as the lines of the update file."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.registry import INPUTS, made, query, table
from contract import q_functions, q_joins, q_sources  # noqa: F401  (inputs)
from shoalgrid.plans import exchange as ex
from shoalgrid.plans import maintain as m
from shoalgrid.sources import catalogue as cat

INPUTS["updates"] = """
SELECT o_orderkey AS pos, o_custkey AS id, CASE WHEN o_orderkey % 4 <> 1 THEN o_orderpriority END AS family, CASE WHEN o_orderkey % 3 = 0 THEN 'col ' || o_orderstatus END AS collection,
 CASE WHEN o_orderkey % 5 = 0 THEN 'title ' || cast(o_orderkey AS string) END AS title, CASE WHEN o_orderstatus <> 'P' THEN 'https://new/' || cast(o_orderkey % 50 AS string) END AS download_url,
 CASE WHEN o_orderkey % 6 < 4 THEN 'product ' || cast(o_custkey % 10 + o_orderkey % 2 AS string) END AS data_product,
 'NAT_' || cast(o_orderkey % 4 AS string) AS native_variable, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'var_' || cast(o_orderkey % 3 AS string) END AS arco_variable FROM @orders"""
INPUTS["metadata"] = """
SELECT c_custkey AS fk_gislayer_id, 'download_url' AS metadata_type, 'https://old/' || cast(c_custkey AS string) AS metadata_value FROM @customer
UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN 'product_info' ELSE 'other' END, 'product ' || cast(c_custkey % 10 AS string) FROM @customer"""
INPUTS["attributes"] = """
SELECT c_custkey AS gislayer_fk, 'NAT_0' AS name, 'var_' || cast(c_custkey % 3 AS string) AS name_custom, 1 AS visible, 0 AS export_stac FROM @customer
UNION ALL SELECT c_custkey, 'NAT_2', CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'var_0' END, 1, 0 FROM @customer"""


@query("m1_set_layer_names", """WITH n AS (SELECT id, arg_max(family, pos) FILTER (WHERE family IS NOT NULL) AS family, arg_max(collection, pos) FILTER (WHERE collection IS NOT NULL) AS collection, arg_max(title, pos) FILTER (WHERE title IS NOT NULL) AS title FROM updates GROUP BY id)
SELECT fk_gislayer_id, fk_layercollection_id, CASE WHEN fk_layercollection_id = 170 THEN coalesce(family, sub_theme_title) ELSE sub_theme_title END AS sub_theme_title,
 CASE WHEN fk_layercollection_id = 170 THEN coalesce(collection, sub_sub_theme_title) ELSE sub_sub_theme_title END AS sub_sub_theme_title, CASE WHEN fk_layercollection_id = 170 THEN coalesce(title, layer_title) ELSE layer_title END AS layer_title
 FROM items LEFT JOIN n ON fk_gislayer_id = id""", ("items", "updates"))
def m1(spark, sf):
    return m.set_layer_names(made(spark, sf, "items"), made(spark, sf, "updates"), 170).select(
        "fk_gislayer_id", "fk_layercollection_id", "sub_theme_title", "sub_sub_theme_title", "layer_title"
    )


@query("m2_set_download_url", """WITH n AS (SELECT id, arg_max(download_url, pos) AS v FROM updates WHERE download_url IS NOT NULL GROUP BY id)
SELECT fk_gislayer_id, metadata_type, CASE WHEN metadata_type = 'download_url' THEN coalesce(v, metadata_value) ELSE metadata_value END AS metadata_value FROM metadata LEFT JOIN n ON id = fk_gislayer_id""", ("metadata", "updates"))
def m2(spark, sf):
    return m.set_download_url(made(spark, sf, "metadata"), made(spark, sf, "updates"))


_COMPLETE = "data_product IS NOT NULL AND native_variable IS NOT NULL AND arco_variable IS NOT NULL"


@query("m3_upsert_product", f"""WITH n AS (SELECT id, arg_max(data_product, pos) AS v FROM updates WHERE {_COMPLETE} GROUP BY id)
SELECT fk_gislayer_id, metadata_type, metadata_value AS old_value, CASE WHEN metadata_type = 'product_info' THEN coalesce(v, metadata_value) ELSE metadata_value END AS metadata_value,
 CASE WHEN v IS NULL OR metadata_type <> 'product_info' THEN 'keep' WHEN v = metadata_value THEN 'same' ELSE 'update' END AS action FROM metadata LEFT JOIN n ON id = fk_gislayer_id
UNION ALL SELECT id, 'product_info', NULL, v, 'insert' FROM n WHERE id NOT IN (SELECT fk_gislayer_id FROM metadata WHERE metadata_type = 'product_info')""", ("metadata", "updates"))
def m3(spark, sf):
    return m.upsert_product(made(spark, sf, "metadata"), made(spark, sf, "updates"), "product_info")


@query("m4_upsert_variables", f"""WITH n AS (SELECT id, native_variable, arg_max(arco_variable, pos) AS v FROM updates WHERE coalesce(arco_variable, '') <> '' AND id IN (SELECT id FROM updates WHERE {_COMPLETE}) GROUP BY ALL)
SELECT coalesce(gislayer_fk, id) AS gislayer_fk, coalesce(name, native_variable) AS name, coalesce(v, name_custom) AS name_custom,
 CASE WHEN v IS NOT NULL AND coalesce(name_custom, '') = '' THEN 0 ELSE visible END AS "show", CASE WHEN v IS NOT NULL AND v IS DISTINCT FROM name_custom THEN 1 ELSE export_stac END AS export_stac,
 CASE WHEN v IS NULL THEN 'keep' WHEN coalesce(name_custom, '') = '' THEN 'insert' WHEN v = name_custom THEN 'same' ELSE 'update' END AS action
 FROM attributes FULL JOIN n ON gislayer_fk = id AND name = native_variable""", ("attributes", "updates"))
def m4(spark, sf):
    return m.upsert_variables(made(spark, sf, "attributes").withColumnRenamed("visible", "show"), made(spark, sf, "updates"))


AUDITED = ["family", "title", "download_url"]
AUDIT_SQL = """WITH v AS (SELECT id, pos, unnest([{'f': 'family', 'v': family}, {'f': 'title', 'v': title}, {'f': 'download_url', 'v': download_url}]) AS x FROM updates),
l AS (SELECT id, pos, x.f AS field, x.v AS new_value, lag(x.v) OVER (PARTITION BY id, x.f ORDER BY pos) AS before FROM v WHERE x.v IS NOT NULL),
a AS (SELECT l.id, l.pos, l.field, coalesce(before, CASE field WHEN 'family' THEN c_mktsegment WHEN 'download_url' THEN 'https://old/' || c_custkey END) AS old_value, new_value FROM l JOIN customer ON id = c_custkey)"""


def changes(spark, sf):
    cust = table(spark, sf, "customer")
    current = cust.select(F.col("c_custkey").alias("id"), F.lit("family").alias("field"), F.col("c_mktsegment").alias("value")).unionByName(
        cust.select(F.col("c_custkey").alias("id"), F.lit("download_url").alias("field"), F.concat(F.lit("https://old/"), "c_custkey").alias("value"))
    )
    return m.audit(made(spark, sf, "updates"), AUDITED, current)


@query("m5_audit", f"""{AUDIT_SQL} SELECT *, CASE WHEN old_value IS NULL THEN 'insert' WHEN old_value = new_value THEN 'same' ELSE 'update' END AS action FROM a""", ("updates",))
def m5(spark, sf):
    return changes(spark, sf)


@query("m5_audit_wide", f"""{AUDIT_SQL} SELECT id, pos, max(old_value) FILTER (WHERE field = 'family') AS family_old, max(new_value) FILTER (WHERE field = 'family') AS family_new,
 max(old_value) FILTER (WHERE field = 'title') AS title_old, max(new_value) FILTER (WHERE field = 'title') AS title_new,
 max(old_value) FILTER (WHERE field = 'download_url') AS download_url_old, max(new_value) FILTER (WHERE field = 'download_url') AS download_url_new FROM a GROUP BY ALL""", ("updates",))
def m5_wide(spark, sf):
    return m.audit_wide(changes(spark, sf), AUDITED)


@query("m6_lookups", """SELECT 'url' AS lookup, fk_gislayer_id AS id, metadata_value AS value FROM metadata WHERE metadata_type = 'download_url'
UNION ALL SELECT 'product', fk_gislayer_id, metadata_value FROM metadata WHERE metadata_type = 'product_info'
UNION ALL SELECT 'variable', gislayer_fk, name_custom || ':' || export_stac FROM attributes WHERE name = 'NAT_2'
UNION ALL SELECT 'variables', gislayer_fk, name FROM attributes
UNION ALL SELECT 'theme', id, name FROM themes WHERE name = 'NATION_3'
UNION ALL SELECT 'layers', fk_gislayer_id, layer_title FROM items WHERE fk_layercollection_id = 170 AND fk_layertheme_id = 3""", ("attributes", "items", "metadata", "themes"))
def m6(spark, sf):
    meta, attributes, items, themes = (made(spark, sf, n) for n in ("metadata", "attributes", "items", "themes"))

    def row(kind, df, key, value):
        return df.select(F.lit(kind).alias("lookup"), F.col(key).cast("long").alias("id"), value.alias("value"))

    parts = [
        row("url", m.layer_metadata(meta, "download_url"), "fk_gislayer_id", F.col("metadata_value")),
        row("product", m.layer_metadata(meta, "product_info"), "fk_gislayer_id", F.col("metadata_value")),
        row("variable", m.layer_variables(attributes, "NAT_2"), "gislayer_fk", F.concat_ws(":", "name_custom", "export_stac")),
        row("variables", m.layer_variables(attributes), "gislayer_fk", F.col("name")),
        row("theme", m.id_by_name(themes, "NATION_3", 170), "id", F.lit("NATION_3")),
        row("layers", m.layers_of_theme(items, 170, 3), "id", F.col("collection_item")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


INPUTS["entries"] = """
SELECT p_partkey AS pos, 'Ocean ' || p_name AS title, 'lay' || cast(p_partkey AS string) AS layer, 'https://u' AS url, 'https://g' AS url_index, '2000' AS start_text, '2010' AS end_text,
 cast(p_size AS double) AS west, p_brand AS brand FROM @part"""


@query("m7_fan_out", """WITH e AS (SELECT *, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY pos) AS id FROM entries)
SELECT id, layer AS layer_name, '2000/2010' AS temporal_dates_extent, west, 'https://u/' || brand AS download_url, split_part(title, ' ', 2) AS sub_theme_title,
 'Ocean ' || split_part(title, ' ', 2) AS sub_sub_theme_title, 2::BIGINT AS variables, 'resourceProvider' AS role FROM e""", ("entries",))
def m7(spark, sf):
    entries = made(spark, sf, "entries").select(
        "pos", "title", "layer", "url", "url_index", F.col("start_text").alias("start"), F.col("end_text").alias("end"),
        "west", F.col("west").alias("east"), F.col("west").alias("north"), F.col("west").alias("south"),
        F.concat(F.lit("https://u/"), "brand").alias("download_url"), F.array(F.lit("temp"), F.lit("salt")).alias("variables"),
    )
    layers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    t = m.fan_out(entries, layers, 171, 1148, "import", 1, ("Provider", "resourceProvider"))
    counted = t["gislayer_attribute"].groupBy("gislayer_fk").agg(F.count(F.lit(1)).alias("variables"))
    return (
        t["gislayer"].select("id", "layer_name", "temporal_dates_extent")
        .join(t["gislayer_bbox"].select(F.col("gislayer_fk").alias("id"), "west"), "id")
        .join(t["metadata"].select(F.col("fk_gislayer_id").alias("id"), F.col("metadata_value").alias("download_url")), "id")
        .join(t["layercollectionitem"].select(F.col("fk_gislayer_id").alias("id"), "sub_theme_title", "sub_sub_theme_title"), "id")
        .join(counted.select(F.col("gislayer_fk").alias("id"), "variables"), "id")
        .join(t["gislayer_responsible_party"].select(F.col("gislayer_id").alias("id"), "role"), "id")
    )


INPUTS["info_docs"] = """
SELECT 'ds' || cast(s_suppkey AS string) AS dataset, CASE WHEN s_acctbal < 2000e0 THEN NULL ELSE '{"table":{"rows":[["attribute","NC_GLOBAL","geospatial_lon_min","double","' || cast(s_nationkey AS string)
 || '"],["attribute","time","geospatial_lon_min","double","999"],["attribute","NC_GLOBAL","time_coverage_start","String","2000-01-01"]' || CASE WHEN s_suppkey % 4 = 2 THEN '' ELSE ',["attribute","NC_GLOBAL","time_coverage_end","String","2010-01-01"]' END || ']}}' END AS json FROM @supplier"""
INPUTS["folder_pages"] = """
SELECT 'ds' || cast(s_suppkey AS string) AS dataset, '<tr><td><img class="B" alt="[BIN]"></td><td><a href="f' || cast(s_suppkey AS string) || '.nc">x</a></td></tr>' AS html FROM @supplier"""


@query("m8_harvest", """SELECT 'ds' || s_suppkey AS dataset, 'Sea ' || s_name || ' layer' AS title, s_nationkey::VARCHAR AS west, NULL::VARCHAR AS east, '2000-01-01' AS "start",
 CASE WHEN s_suppkey % 4 <> 2 THEN '2010-01-01' END AS "end", 'temp_' || s_suppkey || ',salt' AS variables, 'https://h/dir/f' || s_suppkey || '.nc' AS download_url FROM supplier WHERE s_acctbal >= 2000""")
def m8(spark, sf):
    index = cat.harvest_index(made(spark, sf, "index_docs"), "json")
    info = cat.info_rows(made(spark, sf, "info_docs"), "json", "dataset")
    found = ex.harvest(index, info, made(spark, sf, "descriptors"), made(spark, sf, "folder_pages"))
    return found.select("dataset", "title", "west", "east", "start", "end", F.array_join("variables", ",").alias("variables"), "download_url")


@query("run_updates", f"""WITH n2 AS (SELECT id, arg_max(download_url, pos) AS v FROM updates WHERE download_url IS NOT NULL GROUP BY id),
n3 AS (SELECT id, arg_max(data_product, pos) AS v FROM updates WHERE {_COMPLETE} GROUP BY id),
n1 AS (SELECT id, arg_max(title, pos) AS v FROM updates WHERE title IS NOT NULL GROUP BY id),
n4 AS (SELECT id, native_variable, arg_max(arco_variable, pos) AS v FROM updates WHERE coalesce(arco_variable, '') <> '' AND id IN (SELECT id FROM n3) GROUP BY ALL),
lines AS (SELECT id, pos, CASE WHEN {_COMPLETE} THEN data_product END AS v FROM updates),
chain AS (SELECT id, pos, v, lag(v) OVER (PARTITION BY id ORDER BY pos) AS before FROM lines WHERE v IS NOT NULL),
own AS (SELECT fk_gislayer_id AS id, metadata_value AS v FROM metadata WHERE metadata_type = 'product_info')
SELECT 'metadata' AS tbl, fk_gislayer_id AS id, metadata_type AS key, CASE metadata_type WHEN 'download_url' THEN coalesce(n2.v, metadata_value) WHEN 'product_info' THEN coalesce(n3.v, metadata_value) ELSE metadata_value END AS value
 FROM metadata LEFT JOIN n2 ON n2.id = fk_gislayer_id LEFT JOIN n3 ON n3.id = fk_gislayer_id
UNION ALL SELECT 'metadata', id, 'product_info', v FROM n3 WHERE id NOT IN (SELECT id FROM own)
UNION ALL SELECT 'item', fk_gislayer_id, fk_layercollection_id::VARCHAR, CASE WHEN fk_layercollection_id = 170 THEN coalesce(v, layer_title) ELSE layer_title END FROM items LEFT JOIN n1 ON id = fk_gislayer_id
UNION ALL SELECT 'attribute', coalesce(gislayer_fk, id), coalesce(name, native_variable), coalesce(v, name_custom) FROM attributes FULL JOIN n4 ON gislayer_fk = id AND name = native_variable
UNION ALL SELECT 'pair', n4.id, native_variable, coalesce(name_custom, '-') || '>' || v FROM n4 LEFT JOIN attributes ON gislayer_fk = id AND name = native_variable
UNION ALL SELECT 'product', chain.id, pos::VARCHAR, coalesce(before, own.v, '-') || '>' || chain.v FROM chain LEFT JOIN own ON own.id = chain.id""", ("attributes", "items", "metadata", "updates"))
def run_updates(spark, sf):
    stored = made(spark, sf, "attributes").withColumnRenamed("visible", "show")
    t = m.run_updates(made(spark, sf, "items"), made(spark, sf, "metadata"), stored, made(spark, sf, "updates"), 170, "product_info")
    change = F.concat(F.coalesce("old_value", F.lit("-")), F.lit(">"), "new_value")

    def row(df, name, key, at, value):
        return df.select(F.lit(name).alias("tbl"), F.col(key).cast("long").alias("id"), at.cast("string").alias("key"), value.alias("value"))

    parts = [
        row(t["metadata"], "metadata", "fk_gislayer_id", F.col("metadata_type"), F.col("metadata_value")),
        row(t["items"], "item", "fk_gislayer_id", F.col("fk_layercollection_id"), F.col("layer_title")),
        row(t["attributes"], "attribute", "gislayer_fk", F.col("name"), F.col("name_custom")),
        row(t["audit_variables"], "pair", "id", F.col("native_variable"), change),
        row(t["audit"].where("field = 'data_product'"), "product", "id", F.col("pos"), change),
    ]
    return reduce(DataFrame.unionByName, parts)

"""J1-J16, W1-W3, U1-U4."""

from pyspark.sql import functions as F

from contract.geo import BURN_SQL, CATEGORY_SQL, part_bounds, part_cells
from contract.registry import INPUTS, made, query, table
from contract import q_sources  # noqa: F401  (inputs)
from shoalgrid.operators import grid as g
from shoalgrid.operators import state as st
from shoalgrid.plans import catalogue as cat
from shoalgrid.plans import exchange as ex
from shoalgrid.plans import maintain as m
from shoalgrid.plans import reports as rp

LAST = "prev AS (SELECT id, arg_max(download_url, pos) AS download_url, arg_max(struct_pack(a := native_asset), pos).a AS native_asset, max(pos) AS pos FROM state_rows GROUP BY id)"


def previous(spark, sf):
    return st.newest_rows(made(spark, sf, "state_rows"), ["id"], "pos")


@query("j1_attach_previous", f"WITH {LAST} SELECT l.id, p.download_url AS prev_download_url, p.native_asset AS prev_native_asset FROM layers l LEFT JOIN prev p ON l.id = p.id", ("layers", "state_rows"))
def j1(spark, sf):
    return st.attach_previous(made(spark, sf, "layers"), previous(spark, sf)).select("id", "prev_download_url", "prev_native_asset")


@query("j2_reuse_previous_asset", f"""WITH {LAST} SELECT l.id, CASE WHEN p.download_url = l.download_url THEN p.native_asset END AS reused_asset
 FROM layers l LEFT JOIN prev p ON l.id = p.id""", ("layers", "state_rows"))
def j2(spark, sf):
    return st.reuse_previous_asset(st.attach_previous(made(spark, sf, "layers"), previous(spark, sf))).select("id", "reused_asset")


SHARED = "SELECT id, download_url, first_value(native_asset IGNORE NULLS) OVER (PARTITION BY download_url ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS shared_asset FROM layers"


@query("j3_reuse_asset_by_url", SHARED, ("layers",))
def j3(spark, sf):
    return st.reuse_asset_by_url(made(spark, sf, "layers")).select("id", "download_url", "shared_asset")


INPUTS["mapped_layers"] = f"""
SELECT pos, id, native_asset, CASE WHEN pos % 8 = 0 THEN 'Zone' ELSE 'zone' END AS arco_a, 'Depth' AS arco_b FROM ({INPUTS['layers']}) l"""
INPUTS["mapped_state"] = f"""
SELECT id, native_asset, 'Depth' AS arco_b, 'zone' AS arco_a, pos % 12 = 4 AS bare FROM ({INPUTS['layers']}) l"""


@query("j4_reuse_converted_assets", """SELECT l.id, CASE WHEN l.native_asset = s.native_asset AND l.arco_a = s.arco_a AND NOT s.bare
 THEN 'https://s3.example.org/' || l.id || '.zarr,https://s3.example.org/' || l.id || '.parquet' ELSE '' END AS converted
 FROM mapped_layers l LEFT JOIN mapped_state s ON l.id = s.id""", ("mapped_layers", "mapped_state"))
def j4(spark, sf):
    layers = made(spark, sf, "mapped_layers").withColumn("native_arco_mapping", F.create_map(F.lit("A"), "arco_a", F.lit("B"), "arco_b"))
    base = F.concat(F.lit("https://s3.example.org/"), "id")
    links = F.array(*[F.concat(base, F.lit(e)) for e in (".zarr", ".csv", ".parquet")])
    state = made(spark, sf, "mapped_state").select(
        "id", "native_asset", F.create_map(F.lit("B"), "arco_b", F.lit("A"), "arco_a").alias("native_arco_mapping"),
        F.when(~F.col("bare"), links).alias("converted_arco_assets"),
    )
    out = st.reuse_converted_assets(st.attach_previous(layers, state))
    return out.select("id", F.coalesce(F.array_join("converted_arco_assets", ","), F.lit("")).alias("converted"))


@query("j5_forget", "SELECT pos, id, status FROM state_rows WHERE id NOT IN (SELECT id FROM layers WHERE in_stac = 'no')", ("layers", "state_rows"))
def j5(spark, sf):
    again = made(spark, sf, "layers").filter("in_stac = 'no'")
    return st.forget(made(spark, sf, "state_rows"), again).select("pos", "id", "status")


PORTAL = """portal AS (SELECT l.id, thematic_lot, name AS title, subtheme, subsubtheme,
  coalesce((SELECT arg_max(metadata_value, m.pos) FROM metadata_rows m WHERE m.id = l.id AND metadata_type = 'download_url'), '') AS download_url
  FROM layers l WHERE thematic_lot NOT IN ('AFRICA'))"""


def portal(spark, sf):
    return rp.portal_table(made(spark, sf, "layers"), made(spark, sf, "metadata_rows"), ["AFRICA"])


def run_layers(spark, sf):
    """What a run over the flagged layers leaves."""
    return made(spark, sf, "layers").filter("in_stac IS NOT NULL")


@query("j6_transformation", f"""WITH {PORTAL} SELECT p.id, p.download_url, coalesce(l.native_asset, CASE WHEN l.id IS NOT NULL THEN '' END) AS native_asset,
 l.subtheme AS family, l.name AS collection_item, l.in_stac FROM portal p LEFT JOIN (SELECT * FROM layers WHERE in_stac IS NOT NULL) l ON p.id = l.id""", ("layers", "metadata_rows"))
def j6(spark, sf):
    table_ = rp.transformation_table(portal(spark, sf), run_layers(spark, sf))
    return table_.select("id", "download_url", "native_asset", "family", "collection_item", "in_stac")


INPUTS["layer_variables"] = " UNION ALL ".join(
    f"""SELECT id, pos, native_asset, balance > {n} * 2000e0 AS in_asset, 'NAT_{n}' AS native_variable,
 'var_' || cast((pos % 5) * 10 + {n} AS string) AS variable FROM ({INPUTS['layers']}) l{n}""" for n in range(3)
)


@query("j7_attribute_flags", """SELECT v.id, v.native_variable, v.variable, in_asset AS in_arco, in_asset AND coalesce(suffix(native_asset, '.parquet'), FALSE) AS in_stac FROM layer_variables v""", ("layer_variables",))
def j7(spark, sf):
    mapped = made(spark, sf, "layer_variables")
    present = mapped.filter("in_asset")
    published = present.filter("native_asset LIKE '%.parquet'")
    flags = rp.attribute_flags(mapped, present.select("id", F.col("variable").alias("name")), published)
    return flags.select("id", "native_variable", "variable", "in_arco", "in_stac")


@query("j8_name_convention", """WITH best AS (SELECT standard_name, arg_min(convention, file) AS convention FROM names GROUP BY standard_name)
SELECT id, lower(subsubtheme) AS standard_name, coalesce(convention, 'local') AS convention, coalesce(convention, 'local') || '-' || lower(subsubtheme) AS collection
 FROM layers LEFT JOIN best ON standard_name = lower(subsubtheme)""", ("layers", "names"))
def j8(spark, sf):
    rows = cat.with_collection(made(spark, sf, "layers"), made(spark, sf, "names"), "local", "subsubtheme")
    return rows.select("id", "standard_name", "convention", "collection")


INPUTS["items"] = """
SELECT c_custkey AS fk_gislayer_id, 170 + c_custkey % 2 AS fk_layercollection_id, c_nationkey AS fk_layertheme_id, c_name AS layer_title,
 c_mktsegment AS sub_theme_title, 'old ' || c_mktsegment AS sub_sub_theme_title, 0 AS advanced_filter FROM @customer"""
INPUTS["themes"] = "SELECT n_nationkey AS id, 170 AS fk_layercollection_id, n_name AS name FROM @nation WHERE n_regionkey <> 1"


@query("j9_layer_themes", "SELECT fk_gislayer_id, sub_theme_title, sub_sub_theme_title, layer_title FROM items JOIN themes t ON fk_layertheme_id = t.id WHERE items.fk_layercollection_id = 170", ("items", "themes"))
def j9(spark, sf):
    return m.layer_themes(made(spark, sf, "items"), made(spark, sf, "themes"), 170)


@query("j10_match_features", "SELECT resto_id, product_id, collection FROM features WHERE product_id IN (SELECT 'p' || c_custkey FROM customer WHERE c_acctbal > 0)", ("features",))
def j10(spark, sf):
    items = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.concat(F.lit("p"), "c_custkey").alias("item_id"))
    return ex.match_features(items, made(spark, sf, "features")).select("resto_id", "product_id", "collection")


INPUTS["local_files"] = """
SELECT source || '/' || lang || '/' || cast(d.doc_id AS string) AS key, d.n_chars % 100 AS modified FROM @documents d"""
INPUTS["remote_files"] = """
SELECT source || '/' || lang || '/' || cast(d.doc_id + CASE WHEN l.toxic = 1 THEN 100000000 ELSE 0 END AS string) AS key, 50 + l.quality AS modified
FROM @documents d JOIN @labels l ON d.doc_id = l.doc_id"""


@query("j11_sync_plan", """SELECT coalesce(a.key, b.key) AS key, CASE WHEN a.key IS NULL THEN 'delete' WHEN b.key IS NULL THEN 'upload' WHEN a.modified > b.modified THEN 'upload' ELSE 'keep' END AS action
 FROM local_files a FULL JOIN remote_files b ON a.key = b.key""", ("local_files", "remote_files"))
def j11(spark, sf):
    return ex.sync_plan(made(spark, sf, "local_files"), made(spark, sf, "remote_files")).select("key", "action")


@query("j12_variables_in_assets", "SELECT id, variable, in_asset AS present FROM layer_variables", ("layer_variables",))
def j12(spark, sf):
    mapped = made(spark, sf, "layer_variables")
    assets = mapped.filter("in_asset").select("id", F.col("variable").alias("name"))
    there = cat.variables_in_assets(mapped, assets).withColumn("present", F.lit(True))
    return there.unionByName(cat.variables_missing(mapped, assets).withColumn("present", F.lit(False))).select("id", "variable", "present")


INPUTS["spots"] = """
SELECT latitude, longitude, variable, max(value) AS value FROM (""" + INPUTS["readings"] + """) r GROUP BY latitude, longitude, variable"""


KINDS = ["click", "view", "error", "signup", "purchase"]


@query("j13_merge_grids", """SELECT latitude, longitude, max(value) FILTER (WHERE variable = 'click') AS click, max(value) FILTER (WHERE variable = 'view') AS view,
 max(value) FILTER (WHERE variable = 'error') AS error, max(value) FILTER (WHERE variable = 'signup') AS signup, max(value) FILTER (WHERE variable = 'purchase') AS purchase FROM spots GROUP BY ALL""", ("spots",))
def j13(spark, sf):
    spots = made(spark, sf, "spots")
    grids = [spots.filter(F.col("variable") == v) for v in KINDS]
    clash = grids[0].withColumn("value", F.col("value") + 1)
    return g.merge_grids([*grids, clash], ["latitude", "longitude"], KINDS)


INPUTS["hourly"] = "SELECT user_id, hour, max(value) AS value FROM (SELECT user_id, cast(hour(ts) AS bigint) AS hour, value FROM @events) e GROUP BY user_id, hour"


@query("j14_dense_cube", """SELECT u.user_id, h.hour, value FROM (SELECT DISTINCT user_id FROM hourly) u CROSS JOIN (SELECT DISTINCT hour FROM hourly) h
 LEFT JOIN hourly r ON r.user_id = u.user_id AND r.hour = h.hour""", ("hourly",))
def j14(spark, sf):
    return g.dense_cube(made(spark, sf, "hourly"), ["user_id", "hour"], ["value"])


@query("j15_cell_attributes", f"{BURN_SQL} SELECT row::BIGINT AS row, col::BIGINT AS col, feature_id, brand, price FROM cells JOIN corners USING (feature_id)", ("corners",))
def j15(spark, sf):
    cells = g.cell_attributes(part_cells(spark, sf), part_bounds(spark, sf), ["brand", "price"])
    return cells.withColumn("row", F.col("row").cast("long")).withColumn("col", F.col("col").cast("long"))


def store(spark, sf):
    cust = table(spark, sf, "customer")
    orders = table(spark, sf, "orders")
    return {
        "gislayer": cust.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("user_id_created")),
        "gislayer_bbox": cust.select(F.col("c_custkey").alias("gislayer_fk")),
        "metadata": orders.select(F.col("o_custkey").alias("fk_gislayer_id"), "o_orderkey"),
        "gislayer_attribute": orders.select(F.col("o_custkey").alias("gislayer_fk"), "o_orderpriority"),
        "gislayer_responsible_party": cust.select(F.col("c_custkey").alias("gislayer_id")),
        "layercollectionitem": made(spark, sf, "items"),
    }


@query("j16_delete_user_layers", """WITH kept AS (SELECT c_custkey FROM customer WHERE c_nationkey <> 3), n AS (SELECT count(*) AS rows FROM kept),
 o AS (SELECT count(*) AS rows FROM orders WHERE o_custkey IN (SELECT c_custkey FROM kept))
SELECT t.table_name, n.rows FROM (VALUES ('gislayer'), ('gislayer_bbox'), ('gislayer_responsible_party'), ('layercollectionitem')) t(table_name), n
UNION ALL SELECT t.table_name, o.rows FROM (VALUES ('metadata'), ('gislayer_attribute')) t(table_name), o""")
def j16(spark, sf):
    return m.table_sizes(m.delete_user_layers(store(spark, sf), 3))


@query("w1_first_asset_per_url", f"SELECT DISTINCT download_url, shared_asset FROM ({SHARED}) s WHERE shared_asset IS NOT NULL", ("layers",))
def w1(spark, sf):
    shared = st.reuse_asset_by_url(made(spark, sf, "layers"))
    return shared.filter("shared_asset IS NOT NULL").select("download_url", "shared_asset").distinct()


@query("w2_newest_rows", "SELECT id, pos, status FROM state_rows QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos DESC) = 1", ("state_rows",))
def w2(spark, sf):
    return previous(spark, sf).select("id", "pos", "status")


@query("w3_dense_codes", f"WITH {CATEGORY_SQL} SELECT * FROM categories", ("corners",))
def w3(spark, sf):
    return g.category_codes(part_bounds(spark, sf), ["brand", "kind"])


@query("u1_union", "SELECT event_id, variable, value FROM readings", ("readings",))
def u1(spark, sf):
    r = made(spark, sf, "readings")
    north, south = r.filter("latitude > 44"), r.filter("latitude <= 44")
    return north.select("event_id", "variable", "value").unionByName(south.select("value", "variable", "event_id"))


@query("u2_only_remote", "SELECT key FROM remote_files EXCEPT SELECT key FROM local_files", ("local_files", "remote_files"))
def u2(spark, sf):
    return ex.only_remote(made(spark, sf, "local_files"), made(spark, sf, "remote_files"))


@query("u3_extend_names", """SELECT convention, standard_name, description, canonical_units, amip, grib, variable_family, file FROM names UNION ALL
SELECT 'local', lower(subsubtheme), '', '', '', '', lower(arg_min(subtheme, pos)), 'local_standard_names.json' FROM layers
 WHERE lower(subsubtheme) NOT IN (SELECT standard_name FROM names) GROUP BY lower(subsubtheme)""", ("layers", "names"))
def u3(spark, sf):
    rows = made(spark, sf, "layers").select("pos", F.col("subsubtheme").alias("variable"), F.lower("subtheme").alias("family"))
    return cat.extend_names(made(spark, sf, "names"), rows, "local")


@query("u4_all_assets", "SELECT id, concat_ws(',', 'info', native_asset, 'c.zarr') AS links FROM layers", ("layers",))
def u4(spark, sf):
    layers = made(spark, sf, "layers").withColumn("assets", F.array(F.lit("info"))).withColumn("converted_arco_assets", F.array(F.lit("c.zarr")))
    return st.all_assets(layers).select("id", F.array_join("all_assets", ",").alias("links"))

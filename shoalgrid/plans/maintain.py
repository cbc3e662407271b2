"""Audited upserts on the maintenance tables. Each takes a table and gives its next version.

``updates`` has one row per line of the update file: id, pos (line order) and new values. Blank
values change nothing and the last line wins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalgrid.functions.text import title_words
from shoalgrid.operators.ordering import rank_by_position, with_previous
from shoalgrid.operators.skew import lookup

DOWNLOAD = "download_url"
# Columns of an item by update field.
ITEM_FIELDS = {"family": "sub_theme_title", "collection": "sub_sub_theme_title", "title": "layer_title"}


def _last(value: Column) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), F.col("pos")))


def final_values(updates: DataFrame, fields: list[str]) -> DataFrame:
    """Last given value of each field per layer."""
    return updates.groupBy("id").agg(*[_last(F.col(f)).alias(f) for f in fields])


def set_layer_names(items: DataFrame, updates: DataFrame, collection: int) -> DataFrame:
    """Family, collection and title of the layers in one layer collection."""
    new = final_values(updates, list(ITEM_FIELDS)).withColumnsRenamed(
        {"id": "fk_gislayer_id", **{f: f"__{f}" for f in ITEM_FIELDS}}
    )
    here = F.col("fk_layercollection_id") == collection
    out = lookup(items, new, ["fk_gislayer_id"])
    for field, column in ITEM_FIELDS.items():
        out = out.withColumn(column, F.coalesce(F.when(here, F.col(f"__{field}")), F.col(column)))
    return out.select(*items.columns)


def set_download_url(metadata: DataFrame, updates: DataFrame) -> DataFrame:
    """New download links on existing rows; nothing is inserted."""
    new = final_values(updates, [DOWNLOAD]).withColumnsRenamed({"id": "fk_gislayer_id", DOWNLOAD: "__new"})
    value = F.when(F.col("metadata_type") == DOWNLOAD, F.col("__new"))
    return (
        lookup(metadata, new, ["fk_gislayer_id"])
        .withColumn("metadata_value", F.coalesce(value, F.col("metadata_value")))
        .select(*metadata.columns)
    )


def _action(old: Column, new: Column, missing: Column) -> Column:
    return (
        F.when(new.isNull(), F.lit("keep")).when(missing, F.lit("insert"))
        .when(old.eqNullSafe(new), F.lit("same")).otherwise(F.lit("update"))
    )


def complete_lines(updates: DataFrame) -> DataFrame:
    """Lines that name a product, a native and a standard variable; only these open a layer for M3 and M4."""
    return updates.filter(F.col("data_product").isNotNull() & F.col("native_variable").isNotNull() & F.col("arco_variable").isNotNull())


def upsert_product(metadata: DataFrame, updates: DataFrame, product_type: str) -> DataFrame:
    """All metadata rows after the updates, product rows inserted where missing, with the action taken on each."""
    new = final_values(complete_lines(updates), ["data_product"]).select(
        F.col("id").alias("fk_gislayer_id"), F.col("data_product").alias("__new")
    )
    is_product = F.col("metadata_type") == product_type
    value = F.when(is_product, F.col("__new"))
    kept = lookup(metadata, new, ["fk_gislayer_id"]).select(
        "fk_gislayer_id", "metadata_type", F.col("metadata_value").alias("old_value"),
        F.coalesce(value, "metadata_value").alias("metadata_value"), _action(F.col("metadata_value"), value, F.lit(False)).alias("action"),
    )
    inserted = new.join(metadata.filter(is_product).select("fk_gislayer_id").distinct(), "fk_gislayer_id", "left_anti").select(
        "fk_gislayer_id", F.lit(product_type).alias("metadata_type"), F.lit(None).cast("string").alias("old_value"),
        F.col("__new").alias("metadata_value"), F.lit("insert").alias("action"),
    )
    return kept.unionByName(inserted)


def _variable_rows(attributes: DataFrame, updates: DataFrame) -> DataFrame:
    """Stored and new variable pairs side by side, with ``__old``, ``__new`` and the action."""
    usable = updates.join(complete_lines(updates).select("id").distinct(), "id", "left_semi").filter(
        F.col("native_variable").isNotNull() & (F.coalesce("arco_variable", F.lit("")) != "")
    )
    new = usable.groupBy(F.col("id").alias("gislayer_fk"), F.col("native_variable").alias("name")).agg(
        F.max_by("arco_variable", "pos").alias("__new")
    )
    old = attributes.withColumnRenamed("name_custom", "__old")
    action = _action(F.col("__old"), F.col("__new"), F.coalesce("__old", F.lit("")) == "")
    return old.join(new, ["gislayer_fk", "name"], "full_outer").withColumn("action", action)


def upsert_variables(attributes: DataFrame, updates: DataFrame) -> DataFrame:
    """Variable pairs after the updates, with the action taken; blank names are skipped.

    All lines of a layer count if one of them is complete (see ``complete_lines``).
    """
    changed = F.col("action").isin("insert", "update")
    return _variable_rows(attributes, updates).select(
        "gislayer_fk", "name", F.coalesce("__new", "__old").alias("name_custom"),
        F.when(F.col("action") == "insert", F.lit(0)).otherwise(F.col("show")).alias("show"),
        F.when(changed, F.lit(1)).otherwise(F.col("export_stac")).alias("export_stac"),
        "action",
    )


def audit_variables(attributes: DataFrame, updates: DataFrame) -> DataFrame:
    """Old and new standard name of every native variable that the updates name: id, native_variable, old_value, new_value, action."""
    return _variable_rows(attributes, updates).filter("action <> 'keep'").select(
        F.col("gislayer_fk").alias("id"), F.col("name").alias("native_variable"), F.col("__old").alias("old_value"),
        F.col("__new").alias("new_value"), "action",
    )


def audit(updates: DataFrame, fields: list[str], current: DataFrame) -> DataFrame:
    """Old and new value of every change, line by line: id, pos, field, old_value, new_value, action.

    ``current``: id, field, value. The old value of a line is what the line before it left.
    """
    long = (
        updates.select("id", "pos", *fields).unpivot(["id", "pos"], fields, "field", "new_value")
        .filter(F.col("new_value").isNotNull())
    )
    chained = with_previous(long, ["id", "field"], "pos", "new_value", "__before")
    stored = current.select("id", "field", F.col("value").alias("__stored"))
    old = F.coalesce(F.col("__before"), F.col("__stored"))
    return lookup(chained, stored, ["id", "field"]).select(
        "id", "pos", "field", old.alias("old_value"), "new_value",
        _action(old, F.col("new_value"), old.isNull()).alias("action"),
    )


def audit_wide(changes: DataFrame, fields: list[str]) -> DataFrame:
    """One row per line of the update file with ``<field>_old`` and ``<field>_new`` columns."""
    def pick(field, value):
        return F.max(F.when(F.col("field") == field, F.col(value)))

    columns = [pick(f, f"{side}_value").alias(f"{f}_{side}") for f in fields for side in ("old", "new")]
    return changes.groupBy("id", "pos").agg(*columns)


def run_updates(
    items: DataFrame, metadata: DataFrame, attributes: DataFrame, updates: DataFrame, collection: int, product_type: str
) -> dict[str, DataFrame]:
    """One update file applied: the next version of the three tables, and what changed.

    ``audit`` has the old and new value of each field line by line, ``audit_variables`` those of the variable pairs.
    """
    first = final_values(updates, [DOWNLOAD, *ITEM_FIELDS]).select("id")  # layers the file names
    stored_items = items.filter(F.col("fk_layercollection_id") == collection).join(
        first.withColumnRenamed("id", "fk_gislayer_id"), "fk_gislayer_id", "left_semi")
    kinds = {DOWNLOAD: DOWNLOAD, product_type: "data_product"}
    current = stored_items.select(F.col("fk_gislayer_id").alias("id"), *[F.col(c).alias(f) for f, c in ITEM_FIELDS.items()]).unpivot(
        "id", list(ITEM_FIELDS), "field", "value"
    ).unionByName(metadata.filter(F.col("metadata_type").isin(list(kinds))).select(
        F.col("fk_gislayer_id").alias("id"), F.when(F.col("metadata_type") == DOWNLOAD, F.lit(DOWNLOAD)).otherwise("data_product").alias("field"),
        F.col("metadata_value").alias("value")))
    lines = updates.withColumn("data_product", F.when(F.col("native_variable").isNotNull() & F.col("arco_variable").isNotNull(), F.col("data_product")))
    return {
        "items": set_layer_names(items, updates, collection),
        "metadata": upsert_product(set_download_url(metadata, updates), updates, product_type).select(*metadata.columns),
        "attributes": upsert_variables(attributes, updates).select(*attributes.columns),
        "audit": audit(lines, [*ITEM_FIELDS, DOWNLOAD, "data_product"], current),
        "audit_variables": audit_variables(attributes, updates),
    }


def layer_metadata(metadata: DataFrame, kind: str) -> DataFrame:
    """Value of one metadata type per layer (download link, product)."""
    return metadata.filter(F.col("metadata_type") == kind).select("fk_gislayer_id", "metadata_value")


def id_by_name(table: DataFrame, name: str, parent: int | None = None) -> DataFrame:
    """Id of a layer collection by name, or of a theme inside a collection."""
    hit = table.filter(F.col("name") == name)
    return (hit if parent is None else hit.filter(F.col("fk_layercollection_id") == parent)).select("id")


def layer_variables(attributes: DataFrame, native: str | None = None) -> DataFrame:
    """Variables of every layer with their standard name and export flag; one of them on request."""
    hit = attributes if native is None else attributes.filter(F.col("name") == native)
    return hit.select("gislayer_fk", "name", "name_custom", "export_stac")


def layers_of_theme(items: DataFrame, collection: int, theme: int) -> DataFrame:
    here = (F.col("fk_layercollection_id") == collection) & (F.col("fk_layertheme_id") == theme)
    return items.filter(here).select(
        F.col("fk_gislayer_id").alias("id"), F.col("sub_theme_title").alias("variable_family"),
        F.col("sub_sub_theme_title").alias("collection"), F.col("layer_title").alias("collection_item"),
    )


def layer_themes(items: DataFrame, themes: DataFrame, collection: int) -> DataFrame:
    """Family, collection and title of the layers of one collection whose theme exists."""
    known = themes.select(F.col("id").alias("fk_layertheme_id"))
    return items.filter(F.col("fk_layercollection_id") == collection).join(known, "fk_layertheme_id").select(
        "fk_gislayer_id", "sub_theme_title", "sub_sub_theme_title", "layer_title"
    )


def fan_out(
    entries: DataFrame, layers: DataFrame, collection: int, theme: int, user: str, user_id: int, party: tuple[str, str],
    created: str | None = None,
) -> dict[str, DataFrame]:
    """New layers as rows of the six maintenance tables; ids go on from the highest one in use.

    ``entries``: pos, title, layer, url, url_index, start, end, west, east, north, south, download_url, variables.
    """
    top = layers.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m"))
    numbered = rank_by_position(entries, [], "pos", "__n").withColumn("id", F.col("__n") + top.scalar())
    words = title_words(F.col("title"))
    return {
        "gislayer": numbered.select(
            "id", F.col("title").alias("default_title"), F.lit("url").alias("server_type"), F.col("layer").alias("layer_name"),
            F.col("url").alias("url_server"), F.concat_ws("/", "start", "end").alias("temporal_dates_extent"),
            F.lit(user).alias("user_name_created"), F.lit(user_id).alias("user_id_created"), F.col("url_index").alias("url_index"),
            F.lit(created).cast("timestamp").alias("date_created"),
        ),
        "gislayer_bbox": numbered.select(F.col("id").alias("gislayer_fk"), "west", "east", "north", "south"),
        "metadata": numbered.select(
            F.col("id").alias("fk_gislayer_id"), F.lit(DOWNLOAD).alias("metadata_type"), F.col("download_url").alias("metadata_value")
        ),
        "gislayer_attribute": numbered.select(
            F.col("id").alias("gislayer_fk"), F.explode("variables").alias("name")
        ).select("gislayer_fk", "name", F.col("name").alias("name_custom"), F.lit(0).alias("show")),
        "gislayer_responsible_party": numbered.select(
            F.col("id").alias("gislayer_id"), F.lit(party[0]).alias("name"), F.lit(party[1]).alias("role")
        ),
        "layercollectionitem": numbered.select(
            F.col("id").alias("fk_gislayer_id"), F.lit(collection).alias("fk_layercollection_id"),
            F.lit(theme).alias("fk_layertheme_id"), F.col("title").alias("layer_title"),
            words["theme"].alias("sub_theme_title"), words["collection"].alias("sub_sub_theme_title"),
            F.lit(0).alias("advanced_filter"),
        ),
    }


# The column that names the layer in each maintenance table.
LAYER_KEYS = {
    "gislayer_bbox": "gislayer_fk", "metadata": "fk_gislayer_id", "gislayer_attribute": "gislayer_fk",
    "gislayer_responsible_party": "gislayer_id", "layercollectionitem": "fk_gislayer_id", "gislayer": "id",
}


def delete_user_layers(tables: dict[str, DataFrame], user_id: int) -> dict[str, DataFrame]:
    """All tables without the layers a user created."""
    doomed = tables["gislayer"].filter(F.col("user_id_created") == user_id).select(F.col("id").alias("__doomed"))
    return {
        name: table.join(doomed, F.col(LAYER_KEYS[name]) == F.col("__doomed"), "left_anti")
        for name, table in tables.items()
    }


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [t.agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(n)) for n, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)

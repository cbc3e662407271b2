"""Catalogue tables: families, collections, items, item assets, status and issues.

Layers come with these columns where a plan needs them: id, pos, name, thematic_lot, subtheme,
subsubtheme, native_asset, assets, converted_arco_assets, attributes, native_arco_mapping,
arco_variable_description, provider, data_rights, time (start, end), extent (west .. north).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalgrid.functions.extents import (
    converted_item_id, day_start, footprint, item_providers, native_item_id,
)
from shoalgrid.functions.text import extension_links, item_title, media_type, native_of, slug
from shoalgrid.operators.skew import deal_by, lookup
from shoalgrid.operators.state import newest_rows

# Fixed value: licence text of a collection.
COLLECTION_LICENCE = "CC-BY-4.0+"


def families(layers: DataFrame) -> DataFrame:
    """One family per slug of the subtheme, at the place of its first layer."""
    return (
        layers.groupBy(slug(F.col("subtheme")).alias("family")).agg(F.min("pos").alias("first_pos"))
        .withColumn("title", F.col("family"))
        .withColumn("description", F.concat(F.lit("Variable Family "), F.col("family")))
    )


def name_conventions(names: DataFrame) -> DataFrame:
    """Convention per standard name; of several files the one with the lowest name."""
    return names.groupBy("standard_name").agg(F.min_by("convention", "file").alias("convention"))


def with_collection(rows: DataFrame, names: DataFrame, fallback: str, variable: str = "variable") -> DataFrame:
    """Add ``standard_name``, ``convention`` and ``collection`` of each row's variable."""
    found = lookup(rows.withColumn("standard_name", slug(F.col(variable))), name_conventions(names), ["standard_name"])
    return found.withColumn("convention", F.coalesce("convention", F.lit(fallback))).withColumn(
        "collection", F.concat_ws("-", "convention", "standard_name")
    )


def extend_names(names: DataFrame, rows: DataFrame, fallback: str) -> DataFrame:
    """Vocabulary with the unknown names of ``rows`` (pos, variable, family) added, once each; other fields stay, or start empty."""
    wanted = rows.groupBy(slug(F.col("variable")).alias("standard_name")).agg(
        F.min_by("family", "pos").alias("variable_family")
    )
    given = {
        "convention": F.lit(fallback), "standard_name": F.col("standard_name"), "variable_family": F.col("variable_family"),
        "file": F.lit(f"{fallback}_standard_names.json"),
    }
    empty = {"aliases": F.array().cast("array<string>")}
    new = wanted.join(names.select("standard_name").distinct(), "standard_name", "left_anti").select(
        *[given.get(n, empty.get(n, F.lit(""))).alias(n) for n in names.columns]
    )
    return names.unionByName(new)


def mapped_variables(layers: DataFrame) -> DataFrame:
    """Layers with one row per entry of their name mapping: native_variable, variable, map_pos."""
    return layers.select("*", F.posexplode("native_arco_mapping").alias("map_pos", "native_variable", "variable"))


def variables_in_assets(mapped: DataFrame, asset_variables: DataFrame) -> DataFrame:
    """Mapped variables that exist in the converted assets of their layer."""
    return deal_by(mapped, "id", "variable").join(_variable_keys(asset_variables), ["id", "variable"], "left_semi")


def variables_missing(mapped: DataFrame, asset_variables: DataFrame) -> DataFrame:
    return deal_by(mapped, "id", "variable").join(_variable_keys(asset_variables), ["id", "variable"], "left_anti")


def _variable_keys(asset_variables: DataFrame) -> DataFrame:
    return deal_by(asset_variables.select("id", F.col("name").alias("variable")), "id", "variable").distinct()


def _ready(layers: DataFrame) -> DataFrame:
    """Layers that can be catalogued; without a native item there are no converted ones either."""
    return layers.filter(F.col("native_asset").isNotNull() & (F.coalesce("subsubtheme", F.lit("")) != ""))


def native_items(layers: DataFrame, names: DataFrame, fallback: str) -> DataFrame:
    """One native item per layer that has a native asset and a subsubtheme."""
    ready = _ready(layers)
    rows = (
        ready.withColumn("kind", F.lit("native"))
        .withColumn("variable", F.col("subsubtheme"))
        .withColumn("native_variable", F.lit(None).cast("string"))
        .withColumn("item_id", native_item_id(F.col("name")))
        .withColumn("item_pos", F.lit(0))
        .withColumn("layer_providers", F.col("provider"))
    )
    return _finish(with_collection(rows, names, fallback))


def converted_items(
    layers: DataFrame, asset_variables: DataFrame, names: DataFrame, fallback: str
) -> DataFrame:
    """One item per layer and mapped variable that is present in the converted assets."""
    ready = _ready(layers).filter(F.size("converted_arco_assets") > 0)
    mapped = variables_in_assets(mapped_variables(ready).filter(F.col("variable") != ""), asset_variables)
    described = F.when(
        F.map_contains_key("attributes", F.col("variable")),
        F.try_element_at("arco_variable_description", F.col("variable")),
    )
    rows = (
        mapped.withColumn("kind", F.lit("converted"))
        .withColumn("native_variable", native_of(F.col("native_arco_mapping"), F.col("variable")))
        .withColumn(
            "item_id",
            converted_item_id(
                F.col("variable"), day_start(F.col("time.start")), day_start(F.col("time.end")), F.col("extent"), described
            ),
        )
        .withColumn("item_pos", F.col("map_pos") + 1)
        # the native item comes first and has added the lot to the layer's providers
        .withColumn("layer_providers", item_providers(F.col("provider"), F.col("thematic_lot")))
    )
    return _finish(with_collection(rows, names, fallback))


def _finish(rows: DataFrame) -> DataFrame:
    return rows.select(
        "kind", "id", "pos", F.col("thematic_lot").alias("lot"), slug(F.col("subtheme")).alias("family"), "collection", "variable",
        "native_variable", "item_id", item_title(F.col("item_id")).alias("title"),
        day_start(F.col("time.start")).alias("start"), day_start(F.col("time.end")).alias("end"), "extent",
        item_providers(F.col("provider"), F.col("thematic_lot")).alias("providers"),
        "layer_providers", "data_rights", F.struct("pos", "item_pos").alias("place"),
        "assets", "native_asset", "converted_arco_assets",
    )


def newest_items(items: DataFrame) -> DataFrame:
    """The newest item of each (family, collection, item_id), in order of layer and variable."""
    return newest_rows(items, ["family", "collection", "item_id"], "place")


def item_assets(items: DataFrame) -> DataFrame:
    """One asset per kind and item: assets, native asset, then converted ones; the last wins."""
    keys = ["family", "collection", "item_id"]
    empty = F.array().cast("array<string>")
    converted = F.when(F.col("kind") == "converted", F.coalesce("converted_arco_assets", empty)).otherwise(empty)
    links = F.concat(F.coalesce("assets", empty), F.array("native_asset"), converted)
    rows = items.select(*keys, F.posexplode(links).alias("at", "href")).withColumn("m", media_type(F.col("href")))
    return (
        rows.filter(F.col("m").isNotNull())
        .groupBy(*keys, F.col("m.kind").alias("asset_kind"))
        .agg(F.max_by(F.struct("href", "m.title", "m.media", "m.role"), "at").alias("a"))
        .select(*keys, "asset_kind", "a.href", "a.title", "a.media", "a.role")
    )


_HULL = {
    "west": (F.min, "extent.west"), "south": (F.min, "extent.south"), "east": (F.max, "extent.east"),
    "north": (F.max, "extent.north"), "start": (F.min, "start"), "end": (F.max, "end"),
}


def _hull() -> list[Column]:
    return [fn(column).alias(name) for name, (fn, column) in _HULL.items()] + [F.count(F.lit(1)).alias("items")]


def collection_extents(items: DataFrame) -> DataFrame:
    """Hull of the items of each collection in space and time."""
    return items.groupBy("family", "collection").agg(*_hull())


def unique_providers(rows: DataFrame, keys: list[str], providers: str, pos: str) -> DataFrame:
    """Providers by name, the first role in order of (pos, place in the list) wins."""
    long = rows.select(*keys, pos, F.posexplode(providers).alias("at", "p"))
    return long.groupBy(*keys, F.col("p.name").alias("provider")).agg(
        F.min_by("p.role", F.struct(pos, "at")).alias("role")
    )


def _once_by_name(providers: Column) -> Column:
    """Providers in their order, the first of each name."""
    names = F.transform(providers, lambda p: F.coalesce(p["name"], F.lit("")))
    return F.filter(providers, lambda p, i: F.array_position(names, F.coalesce(p["name"], F.lit(""))) == i + 1)


def collections(items: DataFrame, made: DataFrame | None = None) -> DataFrame:
    """Collections with the facts of the first item ever made for them and the hull of the items they hold.

    ``made``: all items, before newer ones replaced others of the same name; ``items`` if it is left out.
    """
    place = F.min("place").alias("place")
    facts = items if made is None else made
    keys = ["family", "collection"]
    first = facts.join(facts.groupBy(*keys).agg(place), [*keys, "place"]).select(*keys, F.struct("variable", "layer_providers").alias("f")).dropDuplicates(keys)
    return items.groupBy(*keys).agg(*_hull()).join(first, keys).select(
        "family", "collection", F.col("f.variable").alias("title"),
        F.concat(F.lit("A collection of "), F.col("f.variable"), F.lit(" data")).alias("description"),
        F.lit(COLLECTION_LICENCE).alias("licence"), _once_by_name(F.col("f.layer_providers")).alias("providers"), *_HULL, "items",
    )


def item_documents(items: DataFrame, assets: DataFrame, codes: DataFrame | None = None, epsg: int = 4326) -> DataFrame:
    """Items as documents: geometry, bbox, properties, extensions and assets by kind (see ``item_assets``).

    ``codes`` (id, variable, label, code) gives converted items the encoding of their categories; an
    array per item of bounded size, as kinds and labels of one variable are few.
    """
    e, keys = F.col("extent"), ["family", "collection", "item_id"]
    asset = F.struct("asset_kind", F.struct("href", "title", F.col("media").alias("type"), "role").alias("asset"))
    kinds = assets.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(asset))).alias("item_assets"))
    full = items.drop("assets").join(kinds, keys, "left")
    if codes is not None:
        encoding = F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "code")))).alias("encoding")
        full = full.join(codes.groupBy("id", "variable").agg(encoding), ["id", "variable"], "left")
        full = full.withColumn("encoding", F.when(F.col("kind") == "converted", F.col("encoding")))
    else:
        full = full.withColumn("encoding", F.lit(None).cast("map<string,long>"))
    asset_kinds = F.coalesce(F.map_keys("item_assets"), F.array().cast("array<string>"))
    return full.select(
        "family", "collection", F.lit("Feature").alias("type"), extension_links(F.lit(epsg is not None), asset_kinds).alias("stac_extensions"),
        F.col("item_id").alias("id"), footprint(e).alias("geometry"), F.array(e["west"], e["south"], e["east"], e["north"]).alias("bbox"),
        F.struct(
            F.col("start").alias("start_datetime"), F.col("end").alias("end_datetime"),
            F.col("providers").alias("provider"), F.col("data_rights"), F.lit(epsg).alias("proj:epsg"), F.col("title"),
            F.col("native_variable"), F.col("encoding").alias("categorical_encoding"),
        ).alias("properties"),
        F.col("item_assets").alias("assets"),
    )


def collection_documents(collections_: DataFrame) -> DataFrame:
    """Collections as documents with their extent; their items are in ``catalogue_links``."""
    box = F.array("west", "south", "east", "north")
    return collections_.select(
        "family", "collection", F.lit("Collection").alias("type"), F.col("collection").alias("id"), "title", "description",
        F.col("licence").alias("license"), "providers",
        F.struct(F.array(box).alias("spatial"), F.array(F.array("start", "end")).alias("temporal")).alias("extent"),
    )


def family_documents(families_: DataFrame, title: str) -> DataFrame:
    """The root document (with a null family) and one document per family."""
    root = families_.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("family"), F.lit("Catalog").alias("type"), slug(F.lit(title)).alias("id"), F.lit(title).alias("title"),
        F.lit(f"STAC Catalog for {title}").alias("description"))
    return root.unionByName(families_.select("family", F.lit("Catalog").alias("type"), F.col("family").alias("id"), "title", "description"))


def catalogue_links(families_: DataFrame, collections_: DataFrame, items: DataFrame, title: str) -> DataFrame:
    """Links of all documents, one row each: kind, family, collection, id, rel, href relative to the root.

    A collection may hold any number of items, so its links are rows, not a list in its document.
    """
    root = F.lit("catalog.json")
    family = F.concat_ws("/", "family", F.lit("catalog.json"))
    collection = F.concat_ws("/", "family", "collection", F.lit("collection.json"))
    item = F.concat(F.concat_ws("/", "family", "collection", "item_id", "item_id"), F.lit(".json"))
    none = F.lit(None).cast("string")

    def of(df, kind, f, c, i, links):
        pairs = F.array(*[F.struct(F.lit(rel).alias("rel"), href.alias("href")) for rel, href in links])
        return df.select(F.lit(kind).alias("kind"), f.alias("family"), c.alias("collection"), i.alias("id"), F.explode(pairs).alias("l")).select(
            "kind", "family", "collection", "id", "l.rel", "l.href")

    f, c = F.col("family"), F.col("collection")
    top = slug(F.lit(title))
    rows = [
        of(families_.sparkSession.range(1), "root", none, none, top, [("root", root)]),
        of(families_, "root", none, none, top, [("child", family)]),
        of(families_, "family", f, none, f, [("root", root), ("parent", root)]),
        of(collections_, "family", f, none, f, [("child", collection)]),
        of(collections_, "collection", f, c, c, [("root", root), ("parent", family)]),
        of(items, "collection", f, c, c, [("item", item)]),
        of(items, "item", f, c, F.col("item_id"), [("root", root), ("parent", collection), ("collection", collection)]),
    ]
    return reduce(DataFrame.unionByName, rows)


def layer_status(layers: DataFrame, items: DataFrame) -> DataFrame:
    """in_stac yes/no per layer, with the number of items made from it (before newer ones replace them)."""
    made = items.groupBy("id").agg(F.count(F.lit(1)).alias("items"))
    return layers.select("id", "pos").join(made, "id", "left").select(
        "id", "pos", F.when(F.col("items").isNotNull(), "yes").otherwise("no").alias("in_stac"),
        F.coalesce("items", F.lit(0)).cast("long").alias("items"),
    )


def variables_published(items: DataFrame) -> DataFrame:
    """Layer, variable and item name of every converted item, in long form."""
    return items.filter(F.col("kind") == "converted").select("id", "variable", "item_id").distinct()


def issues(layers: DataFrame, rejects: DataFrame, mapped_missing: DataFrame) -> DataFrame:
    """What could not be catalogued: stage, id, code, detail."""
    def of(df: DataFrame, stage: str, code: str, detail: Column) -> DataFrame:
        return df.select(
            F.lit(stage).alias("stage"), F.col("id").cast("string").alias("id"), F.lit(code).alias("code"), detail.alias("detail")
        )

    def blank(name):
        return F.coalesce(F.col(name), F.lit("")) == ""

    links = layers.select(
        "id", F.explode(F.concat(F.coalesce("assets", F.array().cast("array<string>")), F.array("native_asset"))).alias("href")
    ).filter(F.col("href").isNotNull() & media_type(F.col("href")).isNull())
    return (
        of(rejects, "tree", "no_id", F.col("name"))
        .unionByName(of(layers.filter(blank("subtheme")), "tree", "no_subtheme", F.col("name")))
        .unionByName(of(layers.filter(blank("subsubtheme")), "tree", "no_subsubtheme", F.col("name")))
        .unionByName(of(layers.filter(F.col("native_asset").isNull()), "items", "no_native_asset", F.col("name")))
        .unionByName(of(links, "assets", "unknown_kind", F.col("href")))
        .unionByName(of(mapped_missing, "items", "variable_not_in_assets", F.col("variable")))
    )

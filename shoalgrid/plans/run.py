"""Whole jobs: from layer rows to a catalogue, and from features to tables and grids.

Intermediate tables that several results need are written once to the shared folder and read back,
so a lost executor repeats one stage and nothing upstream is worked out twice.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalgrid.functions import extents as e
from shoalgrid.functions import text as t
from shoalgrid.operators import columns as c
from shoalgrid.operators import grid as g
from shoalgrid.operators import select as s
from shoalgrid.operators import state as st
from shoalgrid.operators import extents as x
from shoalgrid.operators.geometry import polygon_edges, with_bounds
from shoalgrid.plans import catalogue as cat
from shoalgrid.plans import reports as rp
from shoalgrid.session import scratch_path
from shoalgrid.sinks.writers import write_cube, write_grid

NO_LINKS = "array<string>"


@dataclass(frozen=True)
class RunSettings:
    """Job arguments: site words and switches."""

    run_year: int
    record_host: str
    record_catalogue: str = ""  # address before /csw; the record host if empty
    product_type: str = "product_info"
    fallback_convention: str = "local"
    select: list[dict[str, list]] = field(default_factory=list)
    download_pieces: tuple[str, ...] = ()
    convert: bool = True
    with_map_links: bool = False  # the links are not tried out, so they are added on request only


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and go on from the copy."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _map_links(df: DataFrame, settings: RunSettings):
    """WMS link kept from the previous state, else made from the layer's map properties on request."""
    kept = t.kept_map_link(F.col("prev_assets")) if "prev_assets" in df.columns else F.lit(None).cast("string")
    if not settings.with_map_links or "properties" not in df.columns:
        return kept
    p = F.col("properties")
    world = F.array(*[F.lit(v) for v in ("-180", "-90", "180", "90")])
    extent = F.coalesce(F.transform(p["extent"], t.number_text), world)
    return F.coalesce(kept, t.map_link(p["url"], p["params"]["LAYERS"], p["params"]["VERSION"], extent, p["params"]["TIME"]))


def complete_layers(
    layers: DataFrame, previous: DataFrame, forget_ids: DataFrame, records: DataFrame, data_extents: DataFrame,
    settings: RunSettings,
) -> DataFrame:
    """Layers with assets, mapping, providers, time and space extent.

    ``layers``: id, pos, name, thematic_lot, subtheme, subsubtheme, metadataSources, temporalDatesExtent, bbox,
    responsibleParties, attributes, and properties if there are map links. ``previous``: id, download_url, native_asset,
    native_arco_mapping, converted_arco_assets, and assets if known; one row per id. ``records``: id, box, period,
    organisation, constraints, and csw_links if known. ``data_extents``: id, grid_time, table_time, grid_box of the
    layer's own data.
    """
    sources, none = F.col("metadataSources"), F.array().cast(NO_LINKS)
    based = (
        s.select_layers(layers, settings.select)
        .withColumn("download_url", t.source_value(sources, "download_url"))
        .withColumn("geonetwork_uri", t.source_value(sources, "geonetwork_uri"))
        .withColumn("native_data_product", F.nullif(t.source_value(sources, settings.product_type), F.lit("")))
    )
    facts = records.withColumnRenamed("box", "record_box")
    attached = st.attach_previous(based, st.forget(previous, forget_ids)).join(facts, "id", "left")
    own_links = F.when(
        F.col("geonetwork_uri") != "", t.record_links(F.col("geonetwork_uri"), settings.record_host, settings.record_catalogue or settings.record_host)
    ).otherwise(none)
    csw_links = F.coalesce("csw_links", none) if "csw_links" in records.columns else none

    def filled(link):
        return F.filter(F.array(link), lambda a: a.isNotNull())

    linked = attached.withColumn("assets", F.concat(own_links, filled(_map_links(attached, settings)), csw_links))
    reused = st.reuse_previous_asset(linked).withColumnRenamed("reused_asset", "native_asset")
    fetched = t.first_download(F.col("download_url"), F.col("assets"), settings.download_pieces)
    with_asset = (
        st.reuse_asset_by_url(reused)
        .withColumn("native_asset", F.coalesce("native_asset", "shared_asset", t.open_store(F.col("download_url"))))
        .withColumn("to_fetch", F.when(F.col("native_asset").isNull(), fetched))
        .withColumn("assets", F.concat("assets", filled(F.col("native_asset"))))
        .drop("shared_asset")
    )
    mapped = s.convertible(with_asset, settings.convert)
    mapped = mapped.withColumn(
        "native_arco_mapping", F.when(F.col("to_convert"), t.name_mapping(F.col("attributes")))
    ).withColumn("arco_variable_description", F.when(F.col("to_convert"), t.description_map(F.col("attributes"))))
    full = st.reuse_converted_assets(mapped).join(data_extents, "id", "left")
    times = [F.col("grid_time"), F.col("table_time"), e.text_extent(F.col("temporalDatesExtent")), F.col("period")]
    no_extent = F.array().cast("array<double>")
    return (
        full.withColumn("provider", e.provider_cascade(F.col("responsibleParties"), F.col("organisation"), F.col("thematic_lot")))
        .withColumn("data_rights", e.rights_cascade(F.col("responsibleParties"), F.col("constraints")))
        .withColumn("time", e.time_cascade(times, settings.run_year))
        .withColumn("extent", e.space_cascade(no_extent, F.col("bbox"), F.col("grid_box"), F.col("record_box")))
        .drop(*[name for name in facts.columns if name not in ("id", "doi")], "grid_time", "table_time", "grid_box")
        .drop(*[f"prev_{name}" for name in previous.columns if name != "id"])
    )


def build_catalogue(
    layers: DataFrame, asset_columns: DataFrame, names: DataFrame, rejects: DataFrame, settings: RunSettings
) -> dict[str, DataFrame]:
    """Catalogue tables of completed layers (a stored table, see ``stage``); items are written once and shared."""
    fallback = settings.fallback_convention
    made = cat.native_items(layers, names, fallback).unionByName(
        cat.converted_items(layers, asset_columns, names, fallback)
    )
    made = stage(made, "items")
    items = stage(cat.newest_items(made), "newest_items")
    missing = cat.variables_missing(
        cat.mapped_variables(layers.filter(F.size("converted_arco_assets") > 0)), asset_columns
    )
    return {
        "families": cat.families(layers),
        "collections": cat.collections(items, made),
        "items": items,
        "item_assets": cat.item_assets(items),
        "status": cat.layer_status(layers, made),
        "attribute_table": rp.attribute_table(layers, asset_columns, cat.variables_published(made)),
        "standard_names": cat.extend_names(names, made, fallback),
        "issues": cat.issues(layers, rejects, missing),
    }


def convert_features(features: DataFrame, mapping: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Renamed and aligned features with bounds, and the rows dropped for want of a geometry."""
    fitting, _ = c.check_mapping(features, mapping)
    renamed = c.apply_mapping(features, fitting)
    kept, _ = c.drop_null_geometries(renamed)
    return with_bounds(c.align_types(kept)), renamed.filter(F.col("geometry").isNull())


def grid_features(
    features: DataFrame, numbers: list[str], texts: list[str], resolution: float = g.RESOLUTION
) -> tuple[DataFrame, DataFrame, g.GridSpec]:
    """Long grid and category codes of polygon features; one burn serves all variables.

    The polygons are staged, as bounds, codes, attributes and edges are read from them one after another.
    """
    polygons = stage(s.polygons_only(features), "polygons")
    spec = g.grid_spec(x.total_bounds(polygons), resolution)
    codes = stage(g.category_codes(polygons, texts), "categories") if texts else None
    coded = g.encode_features(polygons.drop("geometry"), texts, codes) if texts else polygons.drop("geometry")
    cells = g.burn_cells(g.burn_spans(polygon_edges(polygons), spec))
    valued = g.cell_attributes(g.label_cells(cells, spec), coded, [*numbers, *texts])
    return g.grid_values(valued, [*numbers, *texts]), codes, spec


def _cube_axes(rows: DataFrame, mapping: dict[str, str]) -> tuple[DataFrame, list[str]]:
    named = c.align_coordinates(c.apply_mapping(rows, mapping))
    axes = ["latitude", "longitude"]
    if "time" in named.columns:
        axes += ["depth", "time"] if "depth" in named.columns else ["time"]
        named = named.withColumn("time", F.col("time").cast("timestamp"))
    elif "depth" in named.columns:
        axes += ["depth"]
    return named, axes


def table_to_cube(rows: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Dense cube of a table of readings, one row per coordinate combination.

    Axes are latitude and longitude, then time if there is one, and depth if there are both.
    """
    named, axes = _cube_axes(rows, mapping)
    return g.dense_cube(named, axes, [n for n in named.columns if n not in axes])


def table_to_store(rows: DataFrame, mapping: dict[str, str], path: str, edges: dict[str, int] | None = None):
    """Chunk store of a table of readings under standard names: latitude, longitude, then depth and time
    where there are such columns; every other column a variable. Returns the cube's shape."""
    named, axes = _cube_axes(rows, mapping)
    return write_cube(named, path, axes, [n for n in named.columns if n not in axes], edges)


def publish_grid(
    grid: DataFrame, path: str, mapping: dict[str, str], title: str, source: str, native_asset: str, run_date: str,
    source_crs: str, categories: DataFrame | None = None, size: int = g.TILE, spec: g.GridSpec | None = None,
) -> None:
    """Grid store under standard names with its tables beside it.

    ``<path>`` holds the chunks, ``<path>_attributes`` one row for the dataset, ``<path>_variables`` extent and CRS per
    variable, ``<path>_categories`` the codes. ``grid``: row, col, latitude, longitude, variable, value; of a burnt
    grid give the frame too, as its axes reach beyond the covered cells.
    """
    named = stage(c.rename_grid_variables(grid, mapping), "grid")
    write_grid(named, path, x.dataset_attributes(named, title, source, native_asset, run_date, spec), size)
    variables = x.variable_extent(named, spec)
    variables.join(g.crs_attributes(variables, source_crs), "variable").write.parquet(f"{path}_variables")
    if categories is not None:
        c.rename_grid_variables(categories, mapping).write.parquet(f"{path}_categories")

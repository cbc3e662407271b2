"""Row selection for layers, features and grids."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalgrid.functions.text import is_convertible, is_download, is_packaged_product, split_product
from shoalgrid.operators.skew import lookup

# WKB type codes (1 point .. 7 collection) by name.
WKB_KINDS = {
    1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint",
    5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection",
}


def select_layers(df: DataFrame, criteria: list[dict[str, list]] | dict[str, list]) -> DataFrame:
    """Layers that meet every ``trait in values``; values are compared as text."""
    traits = [criteria] if isinstance(criteria, dict) else criteria
    for trait in traits:
        for name, values in trait.items():
            df = df.filter(F.col(name).cast("string").isin([str(v) for v in values]))
    return df


def omit_lots(df: DataFrame, lots: list[str]) -> DataFrame:
    return df.filter(F.col("thematic_lot").isNull() | ~F.col("thematic_lot").isin(lots))


def geometry_kind(geometry: Column) -> Column:
    """Name of the geometry type in the WKB header, in either byte order, with or without Z, M or SRID.

    Extra dimensions come as thousands (ISO) or as the highest bits of the code; both are taken off.
    """
    head = F.hex(F.substring(geometry, 1, 5))
    code = F.substring(head, 3, 8)
    turned = F.concat(*[F.substring(head, i, 2) for i in (9, 7, 5, 3)])
    number = F.conv(F.when(head.startswith("01"), turned).when(head.startswith("00"), code), 16, 10).cast("long")
    plain = number.bitwiseAND(F.lit(0x0FFFFFFF))
    kind = F.when(plain < 4000, plain % 1000)
    out = F.lit(None).cast("string")
    for known, name in WKB_KINDS.items():
        out = F.when((F.length(head) == 10) & (kind == known), F.lit(name)).otherwise(out)
    return out


def polygons_only(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    return df.filter(geometry_kind(F.col(geometry)).isin("Polygon", "MultiPolygon"))


def geometry_kinds(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Rows per geometry type, with the rows the polygon filter drops."""
    kind = geometry_kind(F.col(geometry))
    dropped = ~F.coalesce(F.col("geom_type").isin("Polygon", "MultiPolygon"), F.lit(False))
    return (
        df.groupBy(kind.alias("geom_type")).agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("dropped_rows", F.when(dropped, F.col("rows")).otherwise(F.lit(0)))
    )


def not_yet_published(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce(F.col("in_stac"), F.lit("no")) != "yes")


def downloadable(df: DataFrame, url: str, extra_pieces: tuple[str, ...] = ()) -> DataFrame:
    return df.filter(is_download(F.col(url), extra_pieces))


def feature_subset(
    df: DataFrame, attribute: str | None = None, values: list | None = None,
    box: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Features with an attribute among ``values`` whose bounds touch ``box`` (x0, y0, x1, y1).

    Works on the stored ``xmin..ymax`` columns, so Parquet row groups outside are skipped.
    """
    tests = []
    if attribute is not None:
        tests.append(F.col(attribute).isin(values))
    if box is not None:
        x0, y0, x1, y1 = box
        tests += [F.col("xmin") <= x1, F.col("xmax") >= x0, F.col("ymin") <= y1, F.col("ymax") >= y0]
    return df.filter(reduce(and_, tests)) if tests else df


def grid_subset(
    grid: DataFrame, lat: tuple[float, float] | None = None, lon: tuple[float, float] | None = None,
    above: float | None = None,
) -> DataFrame:
    """Cells inside a latitude/longitude slice, both ends included, and above a value."""
    if lat:
        grid = grid.filter(F.col("latitude").between(*lat))
    if lon:
        grid = grid.filter(F.col("longitude").between(*lon))
    if above is not None:
        grid = grid.filter(F.col("value") > above)
    return grid


def category_mask(grid: DataFrame, categories: DataFrame, label: str) -> DataFrame:
    """Grid cells of one label; the other cells of that variable keep their place with a null value."""
    wanted = categories.filter(F.col("label") == label).select("variable", F.col("code").alias("__code"))
    return (
        lookup(grid, wanted, ["variable"], "inner")
        .withColumn("value", F.when(F.col("value") == F.col("__code"), F.col("value")))
        .drop("__code")
    )


def convertible(df: DataFrame, convert: bool = True) -> DataFrame:
    """Flag layers that go to conversion: switched on and attributes present."""
    return df.withColumn("to_convert", F.lit(convert) & F.col("attributes").isNotNull())


def first_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """The readability probe: the first rows a reader gets."""
    return df.limit(n)


def convertible_files(manifest: DataFrame) -> DataFrame:
    """Fetched files that can be converted without opening a package."""
    return manifest.filter(is_convertible(F.col("path")))


def choose_products(layers: DataFrame, manifest: DataFrame) -> DataFrame:
    """Match each layer's named product with the convertible files of its package, by exact name.

    ``layers``: id, native_data_product. ``manifest``: id, path, pos. The first file of a name wins.
    """
    files = (
        manifest.filter(is_packaged_product(F.col("path")))
        .withColumn("product", F.substring_index("path", "/", -1))
        .groupBy("id", "product")
        .agg(F.min_by("path", "pos").alias("path"))
    )
    split = split_product(F.col("native_data_product"))
    named = layers.select("id", split["product"].alias("product"), split["layer"].alias("product_layer"))
    return named.join(files, ["id", "product"])

"""Polygons to grids: a scanline written as joins and aggregates, categories, chunks, cubes."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalgrid.functions.text import clean_category
from shoalgrid.operators.ordering import rank_by_position
from shoalgrid.operators.skew import lookup

# Default cell size and tile edge.
RESOLUTION = 0.01
TILE = 200
# Rows of a long edge that are opened together.
STRETCH = 1024


@dataclass(frozen=True)
class GridSpec:
    """Frame of a grid; rows are counted from the south, columns from the west."""

    x0: float
    y0: float
    x1: float
    y1: float
    width: int
    height: int

    @property
    def axes(self) -> dict[str, tuple[float, float, int]]:
        """Least and greatest label and number of labels of both axes, as ``label_cells`` gives them."""
        ends = {"latitude": (self.y0, self.y1, self.height), "longitude": (self.x0, self.x1, self.width)}
        return {k: (round(low, 4), round(high if n > 1 else low, 4), n) for k, (low, high, n) in ends.items()}

    @property
    def px(self) -> float:
        return (self.x1 - self.x0) / self.width

    @property
    def py(self) -> float:
        return (self.y1 - self.y0) / self.height


def grid_spec(bounds: DataFrame, resolution: float = RESOLUTION) -> GridSpec:
    """Frame from a one-row table of bounds: four numbers come to the driver, nothing else."""
    x0, y0, x1, y1 = bounds.select("xmin", "ymin", "xmax", "ymax").first()
    if x0 is None:
        raise ValueError("no polygons to grid")
    return GridSpec(
        x0, y0, x1, y1, max(1, math.ceil((x1 - x0) / resolution)), max(1, math.ceil((y1 - y0) / resolution))
    )


def _first_centre(value: Column, origin: float, size: float) -> Column:
    """Index of the first cell whose centre is at or after ``value``."""
    return F.ceil((value - origin) / F.lit(size) - 0.5)


def burn_spans(edges: DataFrame, spec: GridSpec) -> DataFrame:
    """Column spans inside each polygon per row: feature_id, row, first_col, last_col.

    Every edge marks, for the rows whose centre it passes, the first column behind the crossing.
    Marks are counted per (feature, part, row, column) before anything is gathered; only odd counts
    matter, so a row of one polygon gathers at most one mark per grid column however many edges it has.
    Long edges are cut into stretches of rows, and these are dealt out anew before any row is opened: the
    task that decoded a large polygon keeps none of this work.
    """
    low = F.greatest(_first_centre(F.least("ay", "by"), spec.y0, spec.py), F.lit(0))
    high = F.least(_first_centre(F.greatest("ay", "by"), spec.y0, spec.py) - 1, F.lit(spec.height - 1))
    passed = (
        edges.filter(F.col("ay") != F.col("by"))
        .withColumn("__low", low)
        .withColumn("__high", high)
        .filter(F.col("__low") <= F.col("__high"))
        .withColumn("__low", F.explode(F.sequence("__low", "__high", F.lit(STRETCH).cast("long"))))
        .hint("rebalance")
        .withColumn("row", F.explode(F.sequence("__low", F.least(F.col("__low") + (STRETCH - 1), "__high"))))
    )
    centre = F.lit(spec.y0) + (F.col("row") + 0.5) * F.lit(spec.py)
    x = F.col("ax") + (centre - F.col("ay")) * (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))
    col = F.greatest(F.least(_first_centre(x, spec.x0, spec.px), F.lit(spec.width)), F.lit(0))
    marks = (
        passed.select("feature_id", "part", "row", col.cast("int").alias("col"))
        .groupBy("feature_id", "part", "row", "col")
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") % 2 == 1)
    )
    pairs = marks.groupBy("feature_id", "part", "row").agg(F.sort_array(F.collect_list("col")).alias("__cols"))
    span = F.explode(F.sequence(F.lit(1), F.size("__cols") - 1, F.lit(2)))
    return (
        pairs.filter(F.size("__cols") > 1)
        .withColumn("__i", span)
        .select(
            "feature_id",
            F.col("row").cast("int").alias("row"),
            F.element_at("__cols", F.col("__i")).alias("first_col"),
            (F.element_at("__cols", F.col("__i") + 1) - 1).alias("last_col"),
        )
    )


def burn_cells(spans: DataFrame, tile: int = TILE) -> DataFrame:
    """Winning feature per cell: the highest feature_id whose span covers it.

    Spans are cut at tile borders and made distinct first, so one (row, tile) holds at most
    ``tile * (tile + 1) / 2`` of them however many polygons lie on top of each other; only then
    are they opened to cells.
    """
    size = F.lit(tile)
    tiles = F.sequence((F.col("first_col") / size).cast("int"), (F.col("last_col") / size).cast("int"))
    cut = (
        spans.withColumn("__tile", F.explode(tiles))
        .withColumn("__from", F.greatest("first_col", F.col("__tile") * tile))
        .withColumn("__to", F.least("last_col", F.col("__tile") * tile + (tile - 1)))
        .groupBy("row", "__from", "__to")
        .agg(F.max("feature_id").alias("feature_id"))
    )
    return (
        cut.select("row", F.explode(F.sequence("__from", "__to")).alias("col"), "feature_id")
        .groupBy("row", "col")
        .agg(F.max("feature_id").alias("feature_id"))
    )


def last_writer(cells: DataFrame) -> DataFrame:
    """Highest feature_id per cell of an already opened cell table."""
    return cells.groupBy("row", "col").agg(F.max("feature_id").alias("feature_id"))


def label_cells(cells: DataFrame, spec: GridSpec) -> DataFrame:
    """Coordinates of the cells: evenly spaced from min to max by count, four decimals."""
    def axis(index, low, high, count):
        if count == 1:
            return F.lit(round(low, 4))
        return F.round(F.lit(low) + index * F.lit((high - low) / (count - 1)), 4)

    return cells.withColumn("latitude", axis(F.col("row"), spec.y0, spec.y1, spec.height)).withColumn(
        "longitude", axis(F.col("col"), spec.x0, spec.x1, spec.width)
    )


def cell_attributes(cells: DataFrame, features: DataFrame, names: list[str]) -> DataFrame:
    """Attributes of the winning feature on every cell; one burn serves all variables."""
    return lookup(cells, features.select("feature_id", *names), ["feature_id"])


def category_codes(features: DataFrame, names: list[str]) -> DataFrame:
    """Codes 1, 2, .. per text variable in order of first sight: variable, label, code."""
    long = features.select(
        "feature_id", F.explode(F.array(*[
            F.struct(F.lit(n).alias("variable"), clean_category(F.col(n)).alias("label")) for n in names
        ])).alias("v")
    )
    firsts = long.groupBy("v.variable", "v.label").agg(F.min("feature_id").alias("__first"))
    return rank_by_position(firsts, ["variable"], "__first", "code").select("variable", "label", "code")


def encode_features(features: DataFrame, texts: list[str], categories: DataFrame) -> DataFrame:
    """Features with the text variables as category codes.

    Codes are looked up once per feature, before the features meet the far more numerous cells.
    """
    for name in texts:
        codes = categories.filter(F.col("variable") == name).select(
            F.col("label").alias("__label"), F.col("code").cast("float").alias("__code")
        )
        labelled = features.withColumn("__label", clean_category(F.col(name))).drop(name)
        features = lookup(labelled, codes, ["__label"]).drop("__label").withColumnRenamed("__code", name)
    return features


def grid_values(cells: DataFrame, names: list[str]) -> DataFrame:
    """Long grid ``row, col, variable, value`` (float) of cells with their attributes."""
    keep = ["row", "col", *[c for c in ("latitude", "longitude") if c in cells.columns]]
    return cells.select(*keep, *[F.col(n).cast("float").alias(n) for n in names]).unpivot(
        keep, names, "variable", "value"
    )


def decode_categories(grid: DataFrame, categories: DataFrame) -> DataFrame:
    """Labels back on a coded grid."""
    codes = categories.select("variable", F.col("code").cast("float").alias("value"), "label")
    return lookup(grid, codes, ["variable", "value"])


def _layers(grid: DataFrame) -> list[str]:
    return [c for c in ("time", "depth") if c in grid.columns]


def grid_chunks(grid: DataFrame, size: int = TILE) -> DataFrame:
    """Square chunks as float arrays in row order, missing cells null; one per time and depth, if any.

    ``grid`` has one value per cell, so a chunk gathers at most ``size * size`` of them; of several the
    greatest counts.
    """
    n = size * size
    keys = ["variable", *_layers(grid)]
    place = (F.col("row") % size) * size + F.col("col") % size
    gathered = grid.groupBy(
        *keys,
        F.floor(F.col("row") / size).cast("int").alias("chunk_row"),
        F.floor(F.col("col") / size).cast("int").alias("chunk_col"),
    ).agg(F.sort_array(F.collect_list(F.struct(place.alias("at"), F.col("value").alias("value")))).alias("__cells"))
    cells = F.col("__cells")

    def gap(count):
        return F.array_repeat(F.lit(None).cast("float"), count)

    def filled(cell, i):
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(cells, i - 1)["at"])
        value = F.when(F.get(cells, i + 1)["at"] == cell["at"], F.array().cast("array<float>")).otherwise(F.array(cell["value"].cast("float")))
        return F.concat(gap((cell["at"] - before - 1).cast("int")), value)

    tail = gap((F.lit(n - 1) - F.element_at(cells, -1)["at"]).cast("int"))
    return gathered.select(
        *keys, "chunk_row", "chunk_col", F.concat(F.flatten(F.transform(cells, filled)), tail).alias("values")
    )


def open_chunks(chunks: DataFrame, size: int = TILE) -> DataFrame:
    """The long grid behind chunks, empty cells left out."""
    keys = ["variable", *_layers(chunks)]
    return chunks.select(*keys, "chunk_row", "chunk_col", F.posexplode("values").alias("at", "value")).filter(
        F.col("value").isNotNull()
    ).select(
        *keys,
        (F.col("chunk_row") * size + F.floor(F.col("at") / size).cast("int")).alias("row"),
        (F.col("chunk_col") * size + F.col("at") % size).alias("col"),
        "value",
    )


def merge_grids(grids: list[DataFrame], coords: list[str], variables: list[str]) -> DataFrame:
    """Variable grids side by side on their coordinates, outer; the first grid wins a clash."""
    tagged = [
        g.select(*coords, "variable", "value").withColumn("__source", F.lit(i)) for i, g in enumerate(grids)
    ]
    every = reduce(DataFrame.unionByName, tagged)
    return every.groupBy(*coords).pivot("variable", variables).agg(F.min_by("value", "__source"))


def dense_index(df: DataFrame, name: str, index: str, blocks: int = 4096) -> DataFrame:
    """Distinct values of a column with numbers 0, 1, .. ; hash blocks keep every task small."""
    from pyspark.sql import Window as W

    values = df.select(name).distinct().withColumn("__block", F.pmod(F.xxhash64(name), F.lit(blocks)))
    before = W.partitionBy(F.lit(0)).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        values.groupBy("__block").agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    )
    inside = F.row_number().over(W.partitionBy("__block").orderBy(name)) - 1
    return values.withColumn("__i", inside).join(starts, "__block").select(
        name, (F.col("__start") + F.col("__i")).alias(index)
    )


def dense_cube(readings: DataFrame, dims: list[str], values: list[str]) -> DataFrame:
    """Every combination of the coordinates, with null where there is no reading.

    The cube is made as chunks of cells (``operators.cube``): each axis numbered once, one hash aggregate
    per cell, one row per chunk, then chunks opened in their tasks; absent chunks come from a range over
    the chunk grid, so no range of cells is shuffled. Readings without one of the coordinates have no
    place in it and are left out; of several readings of one place the one with the greatest values, in
    their order, counts.
    """
    from shoalgrid.operators.cube import cube_chunks, cube_spec, open_cube

    spec = cube_spec(readings, dims, values)
    return open_cube(cube_chunks(readings, spec), spec, dense=True)


def crs_attributes(variables: DataFrame, source_crs: str, stored_crs: str = "EPSG:4326") -> DataFrame:
    """CRS texts per variable: the stored label and, beside it, the source's own text."""
    return variables.select("variable").distinct().select(
        "variable", F.lit(stored_crs).alias("crs"), F.lit(source_crs).alias("source_crs")
    )


def band_table(raster: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Bands of a long raster: cells and filled cells per band, named after the first mapped variable."""
    name = next(iter(mapping.values()))
    return (
        raster.groupBy("band")
        .agg(F.count(F.lit(1)).alias("cells"), F.count("value").alias("filled"), F.min("description").alias("description"))
        .withColumn("variable", F.lit(name))
    )

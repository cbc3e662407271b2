"""Extents and small statistics over features, grids and items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoalgrid.operators.grid import GridSpec


def total_bounds(features: DataFrame) -> DataFrame:
    """One row: the hull of the stored feature bounds."""
    return features.agg(
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
    )


def first_time_column(df: DataFrame) -> str | None:
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return field.name
    return None


def table_time_extent(df: DataFrame) -> DataFrame:
    """Earliest and latest value of the first time column of a table."""
    name = first_time_column(df)
    if name is None:
        raise ValueError("the table has no time column")
    return df.agg(F.min(name).alias("start"), F.max(name).alias("end"))


def grid_time_extent(grid: DataFrame, by: list[str] | None = None) -> DataFrame:
    return grid.groupBy(*(by or [])).agg(F.min("time").alias("start"), F.max("time").alias("end"))


def grid_space_extent(grid: DataFrame, by: list[str] | None = None, spec: GridSpec | None = None) -> DataFrame:
    """Coordinate range, to four decimals; of a burnt grid from its frame, as it holds covered cells only."""
    if spec is not None:
        (south, north, _), (west, east, _) = spec.axes["latitude"], spec.axes["longitude"]
        named = grid.select(*by).distinct() if by else grid.sparkSession.range(1)
        return named.select(*(by or []), *[F.lit(v).alias(n) for n, v in (("west", west), ("south", south), ("east", east), ("north", north))])
    return grid.groupBy(*(by or [])).agg(
        F.round(F.min("longitude"), 4).alias("west"), F.round(F.min("latitude"), 4).alias("south"),
        F.round(F.max("longitude"), 4).alias("east"), F.round(F.max("latitude"), 4).alias("north"),
    )


def variable_extent(grid: DataFrame, spec: GridSpec | None = None) -> DataFrame:
    """Coordinate range of each variable, empty cells included: of a burnt grid give the frame."""
    if spec is not None:
        (south, north, _), (west, east, _) = spec.axes["latitude"], spec.axes["longitude"]
        ends = {"geospatial_lat_min": south, "geospatial_lat_max": north, "geospatial_lon_min": west, "geospatial_lon_max": east}
        return grid.select("variable").distinct().select("variable", *[F.lit(v).alias(n) for n, v in ends.items()])
    return grid.groupBy("variable").agg(
        F.min("latitude").alias("geospatial_lat_min"), F.max("latitude").alias("geospatial_lat_max"),
        F.min("longitude").alias("geospatial_lon_min"), F.max("longitude").alias("geospatial_lon_max"),
    )


def axis_statistics(grid: DataFrame, spec: GridSpec | None = None) -> DataFrame:
    """Min, max and step of both axes; step = (max - min) / number of coordinates.

    The coordinates of an axis are made distinct one axis at a time, so no rows are multiplied. The axes of
    a burnt grid are those of its frame and need no look at the cells.
    """
    def axis(name):
        if spec is not None:
            low, high, n = spec.axes[name]
            return grid.sparkSession.range(1).select(
                F.lit(name).alias("axis"), F.lit(low).alias("min"), F.lit(high).alias("max"), F.lit(n).cast("long").alias("n"))
        return grid.select(name).distinct().agg(
            F.lit(name).alias("axis"), F.min(name).alias("min"), F.max(name).alias("max"),
            F.count(name).alias("n"),
        )

    return axis("latitude").unionByName(axis("longitude")).withColumn(
        "step", (F.col("max") - F.col("min")) / F.col("n")
    )


def dataset_attributes(
    grid: DataFrame, title: str, source: str, native_asset: str, run_date: str, spec: GridSpec | None = None
) -> DataFrame:
    """One row of dataset attributes; the resolution is the smaller step."""
    stats = axis_statistics(grid, spec)

    def pick(name, value):
        return F.max(F.when(F.col("axis") == name, F.col(value)))

    return stats.agg(
        F.lit(4326).alias("epsg"),
        F.min("step").alias("resolution"),
        pick("latitude", "min").alias("geospatial_latitude_min"),
        pick("latitude", "max").alias("geospatial_latitude_max"),
        pick("longitude", "min").alias("geospatial_longitude_min"),
        pick("longitude", "max").alias("geospatial_longitude_max"),
        F.lit(title).alias("title"),
        F.lit(f"Converted on {run_date}").alias("history"),
        F.lit(f"Converted from data product {native_asset} on {run_date}").alias("comment"),
        F.lit(source).alias("sources"),
    )


def asset_variables(columns: DataFrame, skip: tuple[str, ...] = ("geometry", "datetime")) -> DataFrame:
    """Distinct variables of a layer's converted assets with the place of their first sight.

    ``columns``: id, asset_pos, col_pos, name.
    """
    first = F.min(F.struct("asset_pos", "col_pos"))
    return (
        columns.filter(~F.col("name").isin(list(skip)))
        .groupBy("id", "name")
        .agg(first.alias("at"))
        .select("id", "name", "at.asset_pos", "at.col_pos")
    )


def global_attributes(rows: DataFrame, wanted: list[str], scope: str = "NC_GLOBAL") -> DataFrame:
    """One row per dataset with the wanted global attributes as columns; the last value wins.

    ``rows``: dataset, pos, scope, attribute, value.
    """
    kept = rows.filter((F.col("scope") == scope) & F.col("attribute").isin(wanted))
    return kept.groupBy("dataset").agg(*[
        F.max_by(F.when(F.col("attribute") == w, F.col("value")), F.when(F.col("attribute") == w, F.col("pos"))).alias(w)
        for w in wanted
    ])


def metadata_columns(sources: DataFrame, types: dict[str, str]) -> DataFrame:
    """Metadata sources (id, pos, metadata_type, metadata_value) as columns; last wins, '' if absent.

    ``types``: metadata type -> column name.
    """
    return sources.groupBy("id").agg(*[
        F.coalesce(
            F.max_by(
                F.when(F.col("metadata_type") == t, F.col("metadata_value")),
                F.when(F.col("metadata_type") == t, F.col("pos")),
            ),
            F.lit(""),
        ).alias(name)
        for t, name in types.items()
    ])


def conservation(before: DataFrame, after: DataFrame, dropped: DataFrame) -> DataFrame:
    """Counts of the three tables and whether ``before = after + dropped``; each counted where it lies."""
    def counted(df, stage):
        return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("stage", F.lit(stage))

    def of(stage):
        return F.sum(F.when(F.col("stage") == stage, F.col("rows")))

    every = counted(before, "before").unionByName(counted(after, "after")).unionByName(counted(dropped, "dropped"))
    return every.agg(
        of("before").alias("rows_before"), of("after").alias("rows_after"), of("dropped").alias("rows_dropped")
    ).withColumn("is_kept", F.col("rows_before") == F.col("rows_after") + F.col("rows_dropped"))

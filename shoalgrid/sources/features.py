"""Feature tables, grids, file lists and maintenance tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoalgrid.operators.columns import require_filled
from shoalgrid.operators.geometry import with_bounds
from shoalgrid.operators.cube import open_cube, read_cube_spec
from shoalgrid.operators.grid import TILE, open_chunks
from shoalgrid.operators.ordering import ingest_positions

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def read_features_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV features; whole numbers are read as double because any of them may be missing."""
    fields = T.StructType.fromDDL(schema).fields
    loose = T.StructType([
        T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, _WHOLE) else f.dataType) for f in fields
    ])
    return spark.read.csv(path, header=True, schema=loose)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_numbered(spark: SparkSession, path: str, name: str = "feature_id") -> DataFrame:
    """Parquet features with a stable number from file name and row in file, for first ingest."""
    table = spark.read.parquet(path)
    placed = table.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    return ingest_positions(placed, "__file", "__row", name).drop("__file", "__row")


def read_geo_features(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Features with a WKB geometry column; a column subset is pruned in the scan."""
    table = spark.read.parquet(path)
    return table.select(*[c for c in (columns or table.columns) if c != "geometry"], "geometry")


def profile_features(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One row: features, bounds and the column list with types."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    bounded = df if "xmin" in df.columns else with_bounds(df, geometry)
    return bounded.agg(
        F.count(F.lit(1)).alias("features"),
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
    ).withColumn("columns", F.lit(columns))


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    """Long grid table: coordinates, variable, value."""
    return spark.read.parquet(path)


def read_chunks(
    spark: SparkSession, path: str, variables: list[str] | None = None, rows: tuple[int, int] | None = None,
    cols: tuple[int, int] | None = None, size: int = TILE,
) -> DataFrame:
    """Cells of a chunk store inside a window of rows and columns, both ends included.

    Variables are folders and chunk numbers are columns, so only the chunks of the window are read.
    """
    chunks = spark.read.parquet(path)
    if variables is not None:
        chunks = chunks.filter(F.col("variable").isin(variables))
    windows = [(name, ends) for name, ends in (("row", rows), ("col", cols)) if ends]
    for name, (low, high) in windows:
        chunks = chunks.filter(F.col(f"chunk_{name}").between(low // size, high // size))
    cells = open_chunks(chunks, size)
    for name, ends in windows:
        cells = cells.filter(F.col(name).between(*ends))
    return cells


def read_cube(
    spark: SparkSession, path: str, variables: list[str] | None = None, windows: dict[str, tuple[int, int]] | None = None,
    dense: bool = False,
) -> DataFrame:
    """Cells of an n-dimensional chunk store: axis values and variables.

    Only the named variables' columns are read, and only chunks of the windows (ranges of axis numbers,
    both ends included). ``dense``: every combination of the axis values, null where nothing was read.
    """
    spec = read_cube_spec(spark, path)
    if variables is not None:
        spec.variables = [v for v in spec.variables if v in variables]
    chunks = spark.read.parquet(path).select(*[f"chunk_{a}" for a in spec.axes], *spec.variables)
    return open_cube(chunks, spec, dense, windows)


#: Parts the documents of a bundle; XML holds no such character.
RECORD_END = "\x1e"


def read_records(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    """XML documents of a folder, one row each: uri, xml.

    ``bundled``: a file holds many documents, each below a line with its uri (see ``write_records``); else
    a file is a document and its path the uri.
    """
    if bundled:
        head = F.split("value", "\n", 2)
        return spark.read.text(path, lineSep=RECORD_END).select(head[0].alias("uri"), head[1].alias("xml"))
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("uri"), F.col("value").alias("xml"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder: path, modified, size. The contents are never read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    )


def read_store(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A maintenance table by name."""
    return spark.read.parquet(f"{folder}/{name}")


def read_updates(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Update file; ``id`` and ``thematic_lot`` must be filled in every row."""
    return require_filled(spark.read.csv(path, header=True, schema=schema), ["id", "thematic_lot"])

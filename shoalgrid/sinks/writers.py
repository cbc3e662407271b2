"""Tables, grids, documents and reports on storage. Every writer makes a new dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from shoalgrid.operators.columns import apply_mapping
from shoalgrid.operators.cube import CubeSpec, cube_chunks, cube_spec
from shoalgrid.operators.geometry import with_bounds
from shoalgrid.operators.grid import TILE, grid_chunks
from shoalgrid.sources.features import RECORD_END


def balanced(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of one folder together, so that a folder gets few files; large folders are split evenly."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_features(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    if partition_by:
        writer = balanced(df, partition_by).write.partitionBy(*partition_by)
    else:
        writer = df.write
    writer.option("compression", "snappy").parquet(path)


def write_geo_features(df: DataFrame, path: str, source_crs: str, geometry: str = "geometry") -> None:
    """Features with WKB geometry and bounds, and a one-row ``<path>_geo`` table of the CRS labels.

    Rows are sorted by their bounds inside each partition, so row groups cover small boxes.
    """
    bounded = df if "xmin" in df.columns else with_bounds(df, geometry)
    note = {"encoding": "WKB", "crs": "EPSG:4326", "source_crs": source_crs}
    labelled = bounded.withColumn(geometry, F.col(geometry).alias(geometry, metadata=note))
    labelled.sortWithinPartitions("xmin", "ymin").write.option("compression", "snappy").parquet(path)
    geo = df.sparkSession.range(1).select(
        F.lit(geometry).alias("geometry_column"), *[F.lit(v).alias(k) for k, v in note.items()]
    )
    geo.write.parquet(f"{path}_geo")


def write_records(records: DataFrame, path: str, uri: str, xml: str) -> None:
    """XML documents as text bundles: many to a file, each below a line with its uri, for ``read_records``.

    A file for each would take a few calls to the store per document. Texts of one uri are one
    document, a line each as in a file of their own. A uri has no line end. A U+001E, which XML forbids,
    becomes U+001F, which it forbids too, so a broken text stays broken.
    """
    line = F.concat(F.coalesce(F.translate(xml, RECORD_END, "\x1f"), F.lit("")), F.lit("\n"))
    documents = records.groupBy(F.col(uri).alias("uri")).agg(F.concat_ws("", F.collect_list(line)).alias("xml"))
    documents.select(F.concat("uri", F.lit("\n"), "xml").alias("value")).write.text(path, lineSep=RECORD_END)


def write_compact(df: DataFrame, path: str) -> None:
    """Copy in as few files as the advisory partition size allows: one for a small table, even ones for a large one."""
    df.hint("rebalance").write.option("compression", "snappy").parquet(path)


def write_renamed(df: DataFrame, folder: str, title: str, mapping: dict[str, str], ending: str = "_renamed") -> str:
    """Copy with standard names as ``<folder>/<title><ending>.parquet``; no shuffle."""
    path = f"{folder}/{title}{ending}.parquet"
    apply_mapping(df, mapping).write.option("compression", "snappy").parquet(path)
    return path


def write_grid(grid: DataFrame, path: str, attributes: DataFrame | None = None, size: int = TILE) -> None:
    """Grid store: chunk arrays by variable, with the dataset attributes beside them."""
    balanced(grid_chunks(grid, size), ["variable"]).write.partitionBy("variable").option("compression", "snappy").parquet(path)
    if attributes is not None:
        attributes.write.parquet(f"{path}_attributes")


def write_cube(readings: DataFrame, path: str, axes: list[str], variables: list[str], edges: dict[str, int] | None = None) -> CubeSpec:
    """Chunk store at ``path``: chunk rows sorted by key (so windows skip row groups), axes beside it.

    ``<path>_axis_<name>``: the numbered axis; ``<path>_shape``: axis, position, length and chunk edge.
    """
    spec = cube_spec(readings, axes, variables, edges)
    keys = [f"chunk_{a}" for a in axes]
    cube_chunks(readings, spec).repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(path)
    for a in axes:
        spec.indexes[a].write.parquet(f"{path}_axis_{a}")
    spark = readings.sparkSession
    spark.createDataFrame([(a, k, s, e) for k, (a, s, e) in enumerate(zip(axes, spec.sizes, spec.edges))],
                          "axis string, position int, size long, edge int").write.parquet(f"{path}_shape")
    return spec


def write_snapshot(layers: DataFrame, path: str, snapshot: str) -> None:
    """State of the layers as JSON lines below ``snapshot=<name>``; a repeated run replaces that folder only."""
    _replacing(layers.withColumn("snapshot", F.lit(snapshot)), "snapshot").json(path)


def write_documents(df: DataFrame, path: str, hierarchy: list[str]) -> None:
    """One JSON document per row in text files laid out by the hierarchy columns."""
    body = [c for c in df.columns if c not in hierarchy]
    documents = df.select(*hierarchy, F.to_json(F.struct(*body)).alias("value"))
    balanced(documents, hierarchy).write.partitionBy(*hierarchy).text(path)


def write_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV report with a header; one file only on request, for reports known to be small."""
    (df.coalesce(1) if single_file else df).write.csv(path, header=True, quoteAll=False, emptyValue="")


def write_backup(df: DataFrame, path: str, snapshot_date: str) -> None:
    """Dated copy of a published table; a repeated run replaces the copy of that day only."""
    _replacing(df.withColumn("snapshot_date", F.lit(snapshot_date)), "snapshot_date").parquet(path)


def _replacing(df: DataFrame, folder: str) -> DataFrameWriter:
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(folder)

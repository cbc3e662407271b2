"""Schemas of stored assets, harvested in tasks: file footers, header lines and store folders only.

A table of asset paths (``id``, ``asset_pos``, ``path``) becomes one row per column of each asset:
``id, asset_pos, col_pos, name, kind, error``. Paths are dealt out over tasks by a hash, so a layer with
many assets, or many layers, spread evenly; each task opens its paths through the file system of
their scheme (local, HDFS, object stores) and reads no data pages:

- a Parquet file: its footer; a Parquet folder: the footer of its first data file in name order,
  then the partition columns of its ``name=value`` folders in the order of nesting;
- a grid store (folders ``variable=<name>``): the variables, in name order;
- a cube store (a Parquet folder with a ``<path>_shape`` table beside it): its columns but chunk keys;
- a Zarr-like folder (``.zgroup`` or ``.zmetadata``): the sub-folders that hold ``.zarray``, in name order;
- a CSV file, or a folder of them: the names of the (first) header line.

An asset without columns gives no row.

An asset that can't be read gives one row with null ``col_pos`` and ``name``, its kind if known, and
the error text: a broken file never ends the job. A null path is such a row too. Other columns of the
table are carried by nothing; repeated rows give repeated rows.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OUT = "id string, asset_pos long, col_pos long, name string, kind string, error string"


def _filesystem(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _children(filesystem, folder: str):
    from pyarrow import fs

    return sorted(filesystem.get_file_info(fs.FileSelector(folder, recursive=False)), key=lambda i: i.base_name)


def _is_data(info) -> bool:
    return _is_data_name(info.base_name)


def _file_names(filesystem, where: str) -> tuple[str, list[str]]:
    import pyarrow.parquet as pq

    if where.lower().endswith((".csv", ".csv.gz", ".txt")):
        with filesystem.open_input_stream(where, compression="detect") as handle:
            line = io.TextIOWrapper(handle, encoding="utf-8", newline="").readline()
        return "csv", next(csv.reader([line.rstrip("\r\n")]), [])
    with filesystem.open_input_file(where) as handle:
        return "parquet", pq.read_schema(handle).names


def _folder_names(filesystem, folder: str) -> tuple[str, list[str]]:
    from pyarrow import fs

    partitions: list[str] = []
    while True:
        entries = [e for e in _children(filesystem, folder) if _is_data(e)]
        files = [e for e in entries if e.type == fs.FileType.File]
        if files:
            kind, names = _file_names(filesystem, files[0].path)
            return kind, [*names, *partitions]
        nested = [e for e in entries if e.type == fs.FileType.Directory and "=" in e.base_name]
        if not nested:
            raise ValueError("no data file")
        partitions.append(nested[0].base_name.split("=", 1)[0])
        folder = nested[0].path


def schema_of(path: str) -> tuple[str, list[str]]:
    """Kind and column names of one asset, read from footers, a header line or folder names."""
    from pyarrow import fs

    filesystem, where = _filesystem(path)
    info = filesystem.get_file_info(where)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return _file_names(filesystem, where)
    entries = _children(filesystem, where)
    names = [e.base_name for e in entries]
    if ".zgroup" in names or ".zmetadata" in names:
        arrays = [e for e in entries if e.type == fs.FileType.Directory and
                  filesystem.get_file_info(f"{e.path}/.zarray").type == fs.FileType.File]
        return "zarr", [e.base_name for e in arrays]
    data = [n for n in names if _is_data_name(n)]
    if data and all(n.startswith("variable=") for n in data):
        return "grid", [n.split("=", 1)[1] for n in data]
    if filesystem.get_file_info(f"{where.rstrip('/')}_shape").type == fs.FileType.Directory:
        return "cube", [c for c in _folder_names(filesystem, where)[1] if not c.startswith("chunk_")]
    return _folder_names(filesystem, where)


def _is_data_name(name: str) -> bool:
    return name[:1] not in ("_", ".")


def _harvest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {k: [] for k in ("id", "asset_pos", "col_pos", "name", "kind", "error")}
        for key, pos, path in zip(*(batch.column(c).to_pylist() for c in ("id", "asset_pos", "path"))):
            try:
                if path is None:
                    raise ValueError("no path")
                kind, names = schema_of(path)
                rows = [(k, n, kind, None) for k, n in enumerate(names)]
            except Exception as failure:  # noqa: BLE001  (an unreadable asset is a row, not a failed job)
                rows = [(None, None, None, f"{type(failure).__name__}: {failure}"[:500])]
            for col_pos, name, kind, error in rows:
                for k, v in zip(out, (key, pos, col_pos, name, kind, error)):
                    out[k].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("id", pa.string()), ("asset_pos", pa.int64()), ("col_pos", pa.int64()),
                                                                ("name", pa.string()), ("kind", pa.string()), ("error", pa.string())]))


def harvest_schemas(assets: DataFrame) -> DataFrame:
    """One row per column of each asset of ``assets`` (id, asset_pos, path); see the module."""
    paths = assets.select(F.col("id").cast("string").alias("id"), F.col("asset_pos").cast("long").alias("asset_pos"),
                          F.col("path").cast("string").alias("path"))
    return paths.repartition(F.xxhash64("path", "id", "asset_pos")).mapInArrow(_harvest, _OUT)

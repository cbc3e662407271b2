"""WKB in and out. The only Python code that touches rows; Arrow batches, one pass, no state."""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EDGE_FIELDS = "part int, ax double, ay double, bx double, by double"
_FLUSH = 1 << 16
_BOUNDS = T.StructType([T.StructField(n, T.DoubleType()) for n in ("xmin", "ymin", "xmax", "ymax")])


def _header(buf: bytes, at: int) -> tuple[str, int, int, int]:
    order = "<" if buf[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", buf, at + 1)
    # Z, M and SRID as flag bits of the code, or Z and M as thousands
    flags, plain = code >> 28, code & 0x0FFFFFFF
    extra = {0: 0, 1: 1, 2: 1, 3: 2}[plain // 1000] or (flags >> 3 & 1) + (flags >> 2 & 1)
    return order, plain % 1000, 2 + extra, at + (9 if flags & 2 else 5)


def _points(buf: bytes, at: int, order: str, dims: int, count: int) -> tuple[np.ndarray, int]:
    flat = np.frombuffer(buf, dtype=order + "f8", count=count * dims, offset=at)
    return flat.reshape(count, dims)[:, :2], at + 8 * count * dims


def _walk(buf: bytes, at: int, found: list, part: int) -> int:
    """Collect (part, kind, points) of a geometry and return the position after it."""
    order, kind, dims, at = _header(buf, at)
    if kind == 1:
        points, at = _points(buf, at, order, dims, 1)
        found.append((part, kind, points))
        return at
    (count,) = struct.unpack_from(order + "I", buf, at)
    at += 4
    if kind == 2:
        points, at = _points(buf, at, order, dims, count)
        found.append((part, kind, points))
    elif kind == 3:
        for _ in range(count):
            (size,) = struct.unpack_from(order + "I", buf, at)
            points, at = _points(buf, at + 4, order, dims, size)
            found.append((part, kind, points))
    else:
        for number in range(count):
            at = _walk(buf, at, found, number)
    return at


def _pieces(buf: bytes) -> list:
    found: list = []
    _walk(buf, 0, found, 0)
    return found


def polygon_edges(df: DataFrame, key: str = "feature_id", geometry: str = "geometry") -> DataFrame:
    """Edges of every ring: key, part (number of the polygon in a MultiPolygon), ax, ay, bx, by.

    Edges are written in batches of bounded size, so a huge polygon never becomes one value.
    """
    source = df.select(key, geometry)
    key_type = source.schema[key].dataType.simpleString()
    names = ["part", "ax", "ay", "bx", "by"]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            keys, blobs = batch.column(0), batch.column(1)
            rows, columns, size = [], [], 0
            for i in range(batch.num_rows):
                if not blobs[i].is_valid:
                    continue
                for part, kind, ring in _pieces(blobs[i].as_py()):
                    if kind != 3:
                        continue
                    for start in range(0, len(ring) - 1, _FLUSH):
                        line = ring[start : start + _FLUSH + 1]
                        n = len(line) - 1
                        rows.append(np.full(n, i))
                        columns.append((np.full(n, part, "i4"), line[:-1], line[1:]))
                        size += n
                        if size >= _FLUSH:
                            yield _edge_batch(keys, rows, columns, key, names)
                            rows, columns, size = [], [], 0
            if size:
                yield _edge_batch(keys, rows, columns, key, names)

    return source.mapInArrow(batches, f"{key} {key_type}, {EDGE_FIELDS}")


def _edge_batch(keys, rows, columns, key, names) -> pa.RecordBatch:
    parts = np.concatenate([c[0] for c in columns])
    first = np.concatenate([c[1] for c in columns]).astype("f8")
    last = np.concatenate([c[2] for c in columns]).astype("f8")
    values = [parts, first[:, 0], first[:, 1], last[:, 0], last[:, 1]]
    taken = keys.take(pa.array(np.concatenate(rows)))
    return pa.RecordBatch.from_arrays([taken, *[pa.array(v) for v in values]], [key, *names])


@F.arrow_udf(_BOUNDS)
def geometry_bounds(geometry: pa.Array) -> pa.Array:
    """Bounds of a WKB geometry of any kind; null for null or empty."""
    out = []
    for blob in geometry:
        points = [p for _, _, p in _pieces(blob.as_py())] if blob.is_valid else []
        points = [p for p in points if len(p)]
        if not points:
            out.append(None)
            continue
        every = np.concatenate(points)
        (x0, y0), (x1, y1) = every.min(axis=0), every.max(axis=0)
        out.append({"xmin": float(x0), "ymin": float(y0), "xmax": float(x1), "ymax": float(y1)})
    kind = pa.struct([(n, pa.float64()) for n in ("xmin", "ymin", "xmax", "ymax")])
    return pa.array(out, kind)


@F.arrow_udf(T.BinaryType())
def rings_to_wkb(rings: pa.Array) -> pa.Array:
    """Rings (``array<array<struct<x,y>>>``) of one polygon as little-endian WKB."""
    out = []
    for row in rings:
        if not row.is_valid:
            out.append(None)
            continue
        body = [struct.pack("<BII", 1, 3, len(row.values))]
        for ring in row.values:
            points = ring.values
            flat = np.column_stack([points.field(0).to_numpy(), points.field(1).to_numpy()]).astype("<f8")
            body.append(struct.pack("<I", len(flat)) + flat.tobytes())
        out.append(b"".join(body))
    return pa.array(out, pa.binary())


def with_bounds(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Add ``xmin, ymin, xmax, ymax`` so that readers can skip row groups outside a box."""
    bounded = df.withColumn("__b", geometry_bounds(F.col(geometry)))
    return bounded.select(*df.columns, *[F.col(f"__b.{n}").alias(n) for n in ("xmin", "ymin", "xmax", "ymax")])


def ring_edges(rings: Column) -> Column:
    """Edges of rings that are already columns, without leaving the JVM."""
    def edges(ring):
        starts = F.slice(ring, 1, F.size(ring) - 1)
        return F.transform(
            starts,
            lambda p, i: F.struct(
                p["x"].alias("ax"), p["y"].alias("ay"), ring[i + 1]["x"].alias("bx"), ring[i + 1]["y"].alias("by")
            ),
        )

    return F.flatten(F.transform(rings, edges))

"""Helpers shared by the corpus operators: staging, digests and text in Arrow batches.

Columns are taken out of the caller's table by name at the start of an operator, so extra columns
never meet the operators' own ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalgrid.session import scratch_path

#: Bytes that part words, as of ``[\x20\x09-\x0D]``.
SPACES = b" \t\n\x0b\x0c\r"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and go on from the copy: a lost executor repeats one stage only."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    """The text, empty if null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def digest_of(text: Column) -> Column:
    """SHA-256 of the UTF-8 text in lower-case hex."""
    return F.sha2(text.cast("binary"), 256)


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of an Arrow column, without a decoded copy."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    for a, b in zip(ends, ends[1:]):
        yield bytes(view[a:b])


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)) if batch.num_rows else np.zeros(0)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


#: Bytes of one Arrow batch: keeps the buffers of JVM and Python worker small beside the heap.
BATCH_BYTES = "8m"


def map_arrow(df: DataFrame, step, schema) -> DataFrame:
    """``mapInArrow`` in batches of bounded bytes, however long the texts; a setting of the session's own is kept."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key).lower() in ("64m", "64mb", "67108864b", "67108864"):
        conf.set(key, BATCH_BYTES)
    return df.mapInArrow(step, schema)

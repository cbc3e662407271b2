"""Tables of readings as n-dimensional chunk stores, and dense cubes opened from them.

Each axis is numbered once: its distinct values are range-sorted, every sorted part counts its rows and
a value's number is its part's start plus its place in the part; the numbered axis is staged and
serves writing and reading alike. A reading's cell is its axis numbers; a chunk key is each number
divided by the axis' chunk edge, and a place inside the chunk is the remainders in mixed radix (last
axis fastest). Several readings of one cell are made one by a hash aggregate (the greatest values, in
their order, win) before the cells of a chunk are gathered, so a chunk holds at most the product of
the edges. A chunk is one row with a dense array per variable, gaps null inside it; a chunk without
readings has no row at all, nor has an empty cell one of its own.

Reading a store back opens chunks where they are: each chunk row is exploded in its task into its
cells, and the axis values come from one small row per chunk and axis (the axis values of that slice).
A dense cube, every combination of the axis values, adds the keys of absent chunks by a range over the
chunk grid (the product divided by the chunk volume), never a range over cells.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoalgrid.operators.skew import lookup
from shoalgrid.session import scratch_path

# Chunk edges of the usual axes, and of any other.
EDGES = {"latitude": 32, "longitude": 32, "depth": 8, "time": 16}
EDGE = 64


def _stage(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def number_axis(readings: DataFrame, name: str) -> DataFrame:
    """(value, index) of the distinct non-null values of one axis, numbered 0, 1, .. in order; staged."""
    ordered = _stage(readings.select(F.col(name).alias("value")).where("value is not null").distinct()
                     .orderBy("value").withColumn("row", F.monotonically_increasing_id()), f"axis-{name}")
    part, place = F.shiftright("row", 33), F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))  # one row per sorted part
    starts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("start"))
    numbered = ordered.withColumn("part", part).join(F.broadcast(starts), "part").select("value", (F.col("start") + place).alias("index"))
    return _stage(numbered, f"axis-{name}-numbered")


@dataclass
class CubeSpec:
    """Axes in order, their lengths and chunk edges, the variables, and each axis numbered."""

    axes: list[str]
    sizes: list[int]
    edges: list[int]
    variables: list[str]
    indexes: dict[str, DataFrame] = field(repr=False, default_factory=dict)

    @property
    def volume(self) -> int:
        return math.prod(self.edges)

    @property
    def strides(self) -> list[int]:
        return [math.prod(self.edges[k + 1:]) for k in range(len(self.axes))]

    @property
    def chunk_counts(self) -> list[int]:
        return [max(1, -(-s // e)) for s, e in zip(self.sizes, self.edges)]


def _key(axis: str) -> str:
    return f"chunk_{axis}"


def cube_spec(readings: DataFrame, axes: list[str], variables: list[str], edges: dict[str, int] | None = None) -> CubeSpec:
    """Number every axis once (staged) and take the lengths from the numbered tables.

    Only readings with all coordinates count: the others have no place in the cube.
    """
    edges = {**EDGES, **(edges or {})}
    placed = readings.dropna(subset=axes)
    indexes = {a: number_axis(placed, a) for a in axes}
    sizes = [int(indexes[a].agg(F.coalesce(F.max("index") + 1, F.lit(0))).first()[0]) for a in axes]
    return CubeSpec(axes, sizes, [edges.get(a, EDGE) for a in axes], variables, indexes)


def cube_chunks(readings: DataFrame, spec: CubeSpec) -> DataFrame:
    """One row per chunk holding readings: chunk keys and a dense array per variable (gaps null)."""
    coded = readings.dropna(subset=spec.axes).select(*spec.axes, *spec.variables)
    for a in spec.axes:
        coded = lookup(coded, spec.indexes[a].withColumnRenamed("value", a).withColumnRenamed("index", f"__i_{a}"), [a], "inner").drop(a)
    keys = [F.floor(F.col(f"__i_{a}") / e).cast("long").alias(_key(a)) for a, e in zip(spec.axes, spec.edges)]
    place = reduce(lambda acc, t: acc + (F.col(f"__i_{t[0]}") % t[1]) * t[2],
                   zip(spec.axes, spec.edges, spec.strides), F.lit(0).cast("long")).cast("int")
    cells = coded.groupBy(*keys, place.alias("__at")).agg(F.max(F.struct(*spec.variables)).alias("__v"))
    gathered = cells.groupBy(*[_key(a) for a in spec.axes]).agg(
        F.map_from_entries(F.collect_list(F.struct("__at", "__v"))).alias("__cells"))
    every = F.sequence(F.lit(0), F.lit(spec.volume - 1))

    def dense(v: str):
        return F.transform(every, lambda p: F.try_element_at(F.col("__cells"), p)[v]).alias(v)

    return gathered.select(*[_key(a) for a in spec.axes], *[dense(v) for v in spec.variables])


def chunk_grid(spark: SparkSession, spec: CubeSpec) -> DataFrame:
    """Keys of every chunk of the grid: a range over chunks, decoded in mixed radix."""
    counts = spec.chunk_counts
    total = math.prod(counts) if all(spec.sizes) else 0
    grid = spark.range(total)
    step = 1
    for a, n in reversed(list(zip(spec.axes, counts))):
        grid = grid.withColumn(_key(a), F.floor(F.col("id") / step).cast("long") % F.lit(n))
        step *= n
    return grid.drop("id")


def open_cube(chunks: DataFrame, spec: CubeSpec, dense: bool = False, windows: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Cells of chunks: axis values and variables. ``dense``: every combination, absent chunks too.

    ``windows`` keeps cells whose axis numbers lie in the given ranges, both ends included; chunks
    outside them are never opened (the filter on chunk keys reaches the scan).
    """
    windows = windows or {}
    keys = [_key(a) for a in spec.axes]
    for a, (low, high) in windows.items():
        e = spec.edges[spec.axes.index(a)]
        chunks = chunks.where(F.col(_key(a)).between(low // e, high // e))
    if dense:
        grid = chunk_grid(chunks.sparkSession, spec)
        for a, (low, high) in windows.items():
            e = spec.edges[spec.axes.index(a)]
            grid = grid.where(F.col(_key(a)).between(low // e, high // e))
        chunks = grid.join(chunks, keys, "left")
    for a, e in zip(spec.axes, spec.edges):
        slices = spec.indexes[a].groupBy(F.floor(F.col("index") / e).cast("long").alias(_key(a))).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("index", "value"))), lambda s: s["value"]).alias(f"__s_{a}"))
        chunks = chunks.join(slices, _key(a))
    at = F.col("__at")
    local = {a: F.floor(at / stride).cast("int") % e for a, e, stride in zip(spec.axes, spec.edges, spec.strides)}
    opened = chunks.select(*keys, *[f"__s_{a}" for a in spec.axes], *spec.variables,
                           F.explode(F.sequence(F.lit(0), F.lit(spec.volume - 1))).alias("__at"))
    inside = reduce(lambda acc, a: acc & (local[a] < F.size(f"__s_{a}")), spec.axes, F.lit(True))
    cells = opened.where(inside).select(
        *[(F.col(_key(a)) * e + local[a]).alias(f"__i_{a}") for a, e in zip(spec.axes, spec.edges)],
        *[F.get(F.col(f"__s_{a}"), local[a]).alias(a) for a in spec.axes],
        *[F.try_element_at(F.col(v), at + 1).alias(v) for v in spec.variables])
    for a, (low, high) in windows.items():
        cells = cells.where(F.col(f"__i_{a}").between(low, high))
    if not dense:
        filled = reduce(lambda acc, v: acc | F.col(v).isNotNull(), spec.variables, F.lit(False))
        cells = cells.where(filled)
    return cells.select(*spec.axes, *spec.variables)


def read_cube_spec(spark: SparkSession, path: str) -> CubeSpec:
    """The shape of a stored cube (one row per axis) with its numbered axes."""
    shape = sorted(spark.read.parquet(f"{path}_shape").collect(), key=lambda r: r.position)
    axes = [r.axis for r in shape]
    keys = {_key(a) for a in axes}
    variables = [c for c in spark.read.parquet(path).columns if c not in keys]
    indexes = {a: spark.read.parquet(f"{path}_axis_{a}") for a in axes}
    return CubeSpec(axes, [r.size for r in shape], [r.edge for r in shape], variables, indexes)

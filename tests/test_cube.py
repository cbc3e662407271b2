"""Chunk stores of readings with up to four axes, read back sparse, dense and by windows."""

import datetime as dt
import itertools
import random

from pyspark.sql import functions as F

from shoalgrid.operators import cube
from shoalgrid.plans.run import table_to_store
from shoalgrid.sinks.writers import write_cube
from shoalgrid.sources.features import read_cube

EDGES = {"latitude": 3, "longitude": 2, "depth": 2, "time": 3}


def readings(seed=0, n=400):
    rng = random.Random(seed)
    lats, lons = [round(-10 + 0.5 * k, 2) for k in range(7)], [round(100 + 0.25 * k, 2) for k in range(5)]
    depths, days = [0.0, 5.0, 10.0], [dt.datetime(2024, 1, 1) + dt.timedelta(days=k) for k in range(8)]
    rows = [(rng.choice(lats), rng.choice(lons), rng.choice(depths), rng.choice(days), rng.random(), rng.randint(0, 9)) for _ in range(n)]
    rows += [(None, 100.0, 0.0, days[0], 1.0, 1), (lats[0], lons[0], None, days[0], 2.0, 2)]  # no place in the cube
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "lat double, lon double, depth double, time timestamp, value double, hits long")


def expected(rows):
    kept = [r for r in rows if None not in r[:4]]
    axes = [sorted({r[k] for r in kept}) for k in range(4)]
    best = {}
    for r in kept:
        best[r[:4]] = max(best.get(r[:4], (float("-inf"), -1)), (r[4], r[5]))
    return axes, best


def test_store_dense_sparse_and_windows(spark, tmp_path):
    rows = readings()
    path = str(tmp_path / "cube")
    spec = table_to_store(frame(spark, rows), {"value": "reading"}, path, EDGES)
    axes, best = expected(rows)
    assert spec.axes == ["latitude", "longitude", "depth", "time"] and spec.sizes == [len(a) for a in axes]
    dense = {tuple(r[:4]): (r["reading"], r["hits"]) for r in read_cube(spark, path, dense=True).collect()}
    assert len(dense) == len(list(itertools.product(*axes)))
    assert dense == {k: best.get(k, (None, None)) for k in itertools.product(*axes)}
    sparse = {tuple(r[:4]): (r["reading"], r["hits"]) for r in read_cube(spark, path).collect()}
    assert sparse == best
    # Windows of axis numbers, both ends included; one variable only.
    window = read_cube(spark, path, ["hits"], {"latitude": (2, 4), "time": (5, 7)}, dense=True)
    assert window.columns == ["latitude", "longitude", "depth", "time", "hits"]
    got = {tuple(r[:4]): r["hits"] for r in window.collect()}
    want = {k: best.get(k, (None, None))[1] for k in itertools.product(axes[0][2:5], axes[1], axes[2], axes[3][5:8])}
    assert got == want


def test_no_row_for_empty_chunks_or_cells(spark, tmp_path):
    rows = [(0.0, 0.0, 0.0, dt.datetime(2024, 1, 1), 1.0, 1), (9.0, 9.0, 9.0, dt.datetime(2024, 1, 9), 2.0, 2)]
    rows += [(float(k), float(k), float(k), dt.datetime(2024, 1, 1 + k), None, None) for k in range(1, 9)]
    path = str(tmp_path / "cube")
    write_cube(frame(spark, rows).where("value is not null or lat in (3.0)"), path, ["lat", "lon", "depth", "time"], ["value", "hits"], {"lat": 2, "lon": 2, "depth": 2, "time": 2})
    stored = spark.read.parquet(path)
    # Axes of three values in chunks of two: the first two readings share a chunk, so two chunks of 16 places.
    assert stored.count() == 2
    assert {len(r["value"]) for r in stored.collect()} == {16}
    assert read_cube(spark, path, dense=True).count() == 3 ** 4
    assert read_cube(spark, path).count() == 2


def test_dense_cube_plan_has_no_range_of_cells(spark):
    rows = readings(1, 300)
    df = frame(spark, rows).select(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "depth", "time", "value", "hits")
    spec = cube.cube_spec(df, ["latitude", "longitude", "depth", "time"], ["value", "hits"])
    out = cube.open_cube(cube.cube_chunks(df, spec), spec, dense=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    total = 1
    for n in spec.chunk_counts:
        total *= n
    assert f"Range (0, {total}," in plan
    axes, best = expected(rows)
    got = {tuple(r[:4]): (r["value"], r["hits"]) for r in out.collect()}
    assert got == {k: best.get(k, (None, None)) for k in itertools.product(*axes)}


def test_empty_readings(spark, tmp_path):
    path = str(tmp_path / "cube")
    write_cube(frame(spark, []), path, ["lat", "lon"], ["value"])
    assert read_cube(spark, path, dense=True).count() == 0
    assert read_cube(spark, path).count() == 0

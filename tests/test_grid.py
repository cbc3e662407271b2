import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoalgrid.operators import grid as g
from shoalgrid.operators.extents import total_bounds
from shoalgrid.operators.geometry import geometry_bounds, polygon_edges, rings_to_wkb, with_bounds
from shoalgrid.operators.extents import axis_statistics, grid_space_extent, variable_extent
from shoalgrid.operators.select import geometry_kind, geometry_kinds, polygons_only
from shoalgrid.plans.run import convert_features, grid_features


def polygon_bytes(rings, order="<"):
    out = struct.pack(order + "BII", order == "<", 3, len(rings))
    for ring in rings:
        out += struct.pack(order + "I", len(ring)) + b"".join(struct.pack(order + "dd", *p) for p in ring)
    return out


def multi_bytes(polygons, order="<"):
    return struct.pack(order + "BII", order == "<", 6, len(polygons)) + b"".join(polygon_bytes(p, order) for p in polygons)


def star(rng, cx, cy, size, corners):
    angles = sorted(rng.uniform(0, 2 * np.pi) for _ in range(corners))
    reach = [size * rng.uniform(0.4, 1) for _ in angles]
    ring = [(float(cx + np.cos(a) * r), float(cy + np.sin(a) * r)) for a, r in zip(angles, reach)]
    return ring + ring[:1]


def inside(rings, x, y):
    hit = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (ay <= y) != (by <= y) and ax + (y - ay) * (bx - ax) / (by - ay) <= x:
                hit = not hit
    return hit


def brute(features, spec):
    cells = {}
    for fid, parts in sorted(features.items()):
        for row in range(spec.height):
            for col in range(spec.width):
                x, y = spec.x0 + (col + 0.5) * spec.px, spec.y0 + (row + 0.5) * spec.py
                if any(inside(p, x, y) for p in parts):
                    cells[row, col] = fid
    return cells


@pytest.mark.parametrize("seed, tile", [(1, 200), (2, 7), (3, 1)])
def test_burn_equals_brute_force(spark, seed, tile):
    rng = random.Random(seed)
    features, rows = {}, []
    for fid in range(18):
        cx, cy = rng.uniform(0, 40), rng.uniform(0, 30)
        outer = star(rng, cx, cy, rng.uniform(2, 12), rng.choice([3, 5, 60]))
        hole = star(rng, cx, cy, 0.8, 4)
        parts = [[outer, hole]]
        if fid % 3 == 0:  # overlapping parts of one MultiPolygon
            parts.append([star(rng, cx + 1, cy, 4, 6)])
        features[fid] = parts
        order = "<" if fid % 2 else ">"
        rows.append((fid, multi_bytes(parts, order) if len(parts) > 1 else polygon_bytes(parts[0], order)))
    df = spark.createDataFrame([(f, bytearray(b)) for f, b in rows], "feature_id long, geometry binary")
    spec = g.grid_spec(total_bounds(with_bounds(df)), 0.7)
    got = {(r["row"], r["col"]): r["feature_id"] for r in g.burn_cells(g.burn_spans(polygon_edges(df), spec), tile).collect()}
    assert got == brute(features, spec)


def test_many_edges_in_one_row_gather_few_marks(spark):
    """A comb with thousands of teeth inside one row of cells: marks cancel by parity."""
    teeth = [(x / 1000, 0.1 if x % 2 else 0.9) for x in range(0, 4001)]
    ring = [(0.0, -1.0), *teeth, (4.0, -1.0), (0.0, -1.0)]
    df = spark.createDataFrame([(1, bytearray(polygon_bytes([ring])))], "feature_id long, geometry binary")
    spec = g.GridSpec(0.0, -1.0, 4.0, 1.0, 4, 2)
    got = {(r["row"], r["col"]) for r in g.burn_cells(g.burn_spans(polygon_edges(df), spec)).collect()}
    want = brute({1: [[ring]]}, spec)
    assert got == set(want)


def test_wkb_round_trip_and_bounds(spark):
    rng = random.Random(5)
    shapes = [[star(rng, 0, 0, 5, 9), star(rng, 0, 0, 1, 3)] for _ in range(10)]
    rings = [[[{"x": x, "y": y} for x, y in ring] for ring in s] for s in shapes]
    df = spark.createDataFrame(list(enumerate(rings)), "feature_id long, rings array<array<struct<x:double,y:double>>>")
    coded = df.withColumn("geometry", rings_to_wkb("rings"))
    assert [bytes(r["geometry"]) for r in coded.orderBy("feature_id").collect()] == [polygon_bytes(s) for s in shapes]
    edges = {(r["feature_id"], r["ax"], r["ay"], r["bx"], r["by"]) for r in polygon_edges(coded).collect()}
    assert edges == {(i, *a, *b) for i, s in enumerate(shapes) for ring in s for a, b in zip(ring, ring[1:])}
    first = coded.filter("feature_id = 0").select(geometry_bounds("geometry").alias("b")).first()["b"]
    points = [p for ring in shapes[0] for p in ring]
    assert first["xmin"] == min(p[0] for p in points) and first["ymax"] == max(p[1] for p in points)


def test_geometry_kinds(spark):
    point = struct.pack("<BIdd", 1, 1, 1.0, 2.0)
    line = struct.pack(">BIIdddd", 0, 2, 2, 0.0, 0.0, 1.0, 3.0)
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    blobs = [point, line, polygon_bytes([square], ">"), multi_bytes([[square]]), None]
    df = spark.createDataFrame([(i, bytearray(b) if b else None) for i, b in enumerate(blobs)], "feature_id long, geometry binary")
    kinds = [r["k"] for r in df.orderBy("feature_id").select(geometry_kind(F.col("geometry")).alias("k")).collect()]
    assert kinds == ["Point", "LineString", "Polygon", "MultiPolygon", None]
    assert polygons_only(df).count() == 2
    assert {(r["geom_type"], r["dropped_rows"]) for r in geometry_kinds(df).collect()} == {
        ("Point", 1), ("LineString", 1), ("Polygon", 0), ("MultiPolygon", 0), (None, 1)}
    assert with_bounds(df).filter("feature_id = 1").select("xmax", "ymax").first() == (1.0, 3.0)


def test_more_dimensions_and_srid(spark):
    """ISO and flagged codes in both byte orders: one square each, read as in two dimensions."""
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    flat = {(*a, *b) for a, b in zip(square, square[1:])}
    blobs = []
    for order in "<>":
        for code, dims, srid in ((1003, 3, 0), (2003, 3, 0), (3003, 4, 0), (0x80000003, 3, 0), (0x40000003, 3, 0), (0xC0000003, 4, 0), (0x20000003, 2, 1), (0xA0000003, 3, 1)):
            head = struct.pack(order + "BI", order == "<", code) + (struct.pack(order + "I", 4326) if srid else b"")
            body = b"".join(struct.pack(order + f"{dims}d", *p, *[7.0] * (dims - 2)) for p in square)
            blobs.append(head + struct.pack(order + "II", 1, len(square)) + body)
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(blobs)], "feature_id long, geometry binary")
    assert polygons_only(df).count() == len(blobs)
    assert {r["geom_type"] for r in geometry_kinds(df).collect()} == {"Polygon"}
    edges = polygon_edges(df).collect()
    assert {(r["ax"], r["ay"], r["bx"], r["by"]) for r in edges} == flat and len(edges) == 4 * len(blobs)
    assert with_bounds(df).filter("xmax = 2 and ymin = 0").count() == len(blobs)


def square_at(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]


def test_features_to_grid(spark):
    """Square with a hole, a square on top, a null geometry; blank categories share one code."""
    rows = [
        (0, bytearray(polygon_bytes([square_at(0.0, 0.0, 8.0), square_at(2.0, 2.0, 2.0)])), "sand", 1.5),
        (1, bytearray(polygon_bytes([square_at(5.0, 5.0, 3.0)])), " ", 2.5),
        (2, bytearray(polygon_bytes([square_at(0.0, 6.0, 2.0)])), None, None),
        (3, None, "mud", 9.0),
    ]
    df = spark.createDataFrame(rows, "feature_id long, geometry binary, KIND string, depth double")
    features, dropped = convert_features(df, {"KIND": "kind", "NONE": "none"})
    assert dropped.count() == 1
    assert dict(features.dtypes)["depth"] == "float"
    grid, codes, spec = grid_features(features, ["depth"], ["kind"], 1.0)
    assert (spec.width, spec.height) == (8, 8)
    assert {(r["label"], r["code"]) for r in codes.collect()} == {("sand", 1), ("None", 2)}
    values = {(r["variable"], r["row"], r["col"]): r["value"] for r in grid.collect()}
    assert values["depth", 0, 0] == 1.5 and values["depth", 6, 6] == 2.5 and values["depth", 7, 0] is None
    assert values["kind", 6, 6] == 2.0 and values["kind", 7, 0] == 2.0
    assert ("kind", 2, 2) not in values and len(values) == 2 * 60


def test_codes_follow_first_sight_with_tiny_blocks(spark, monkeypatch):
    from shoalgrid.operators import ordering

    labels = [f"l{(i * 7) % 23}" for i in range(200)]
    df = spark.createDataFrame([(i * 3, x) for i, x in enumerate(labels)], "feature_id long, kind string")
    firsts = df.groupBy("kind").agg(F.min("feature_id").alias("at")).withColumn("v", F.lit("k"))
    got = {r["kind"]: r["n"] for r in ordering.rank_by_position(firsts, ["v"], "at", "n", block=5).collect()}
    assert got == {x: i + 1 for i, x in enumerate(dict.fromkeys(labels))}
    codes = {r["label"]: r["code"] for r in g.category_codes(df, ["kind"]).collect()}
    assert codes == got


def test_chunks_round_trip(spark):
    rng = random.Random(4)
    cells = {(rng.randrange(23), rng.randrange(17)): float(i) for i in range(90)}
    df = spark.createDataFrame([("v", r, c, x) for (r, c), x in cells.items()], "variable string, row int, col int, value float")
    chunks = g.grid_chunks(df, 5)
    assert {len(r["values"]) for r in chunks.collect()} == {25}
    assert {(r["row"], r["col"]): r["value"] for r in g.open_chunks(chunks, 5).collect()} == cells


def test_chunks_keep_times_apart_and_windows_read_few(spark):
    from shoalgrid.session import scratch_path
    from shoalgrid.sinks.writers import write_grid
    from shoalgrid.sources.features import read_chunks

    df = spark.createDataFrame([("v", t, r, c, float(t * 100 + r * 10 + c)) for t in (1, 2) for r in range(9) for c in range(9)],
                               "variable string, time long, row int, col int, value float")
    path = scratch_path(spark, "cube")
    write_grid(df, path, size=3)
    assert spark.read.parquet(path).count() == 18
    window = read_chunks(spark, path, ["v"], (2, 4), (0, 3), 3)
    assert {(r["time"], r["row"], r["col"]): r["value"] for r in window.collect()} == {
        (t, r, c): float(t * 100 + r * 10 + c) for t in (1, 2) for r in (2, 3, 4) for c in range(4)}


def test_dense_cube_of_three_axes(spark):
    rng = random.Random(9)
    spots = {(rng.randrange(6) * 10, f"d{rng.randrange(4)}", rng.randrange(5) / 2): float(i) for i in range(30)}
    df = spark.createDataFrame([(*k, v) for k, v in spots.items()], "a long, b string, c double, v double")
    got = {(r["a"], r["b"], r["c"]): r["v"] for r in g.dense_cube(df, ["a", "b", "c"], ["v"]).collect()}
    axes = [sorted({k[i] for k in spots}) for i in range(3)]
    assert got == {(a, b, c): spots.get((a, b, c)) for a in axes[0] for b in axes[1] for c in axes[2]}


def test_two_values_of_one_place(spark):
    cells = spark.createDataFrame([("v", 0, 0, 1.0), ("v", 0, 0, 3.0), ("v", 0, 0, 2.0), ("v", 1, 1, 9.0)], "variable string, row int, col int, value float")
    assert [r["values"] for r in g.grid_chunks(cells, 2).collect()] == [[3.0, None, None, 9.0]]
    rows = spark.createDataFrame([(1, 1, 5.0), (1, 1, 7.0), (2, 2, 1.0), (None, 2, 8.0), (3, None, 8.0)], "a long, b long, v double")
    got = {(r["a"], r["b"]): r["v"] for r in g.dense_cube(rows, ["a", "b"], ["v"]).collect()}
    assert got == {(1, 1): 7.0, (1, 2): None, (2, 1): None, (2, 2): 1.0}


def test_labels_and_empty_input(spark):
    spec = g.GridSpec(0.0, 10.0, 3.0, 14.0, 4, 1)
    df = spark.createDataFrame([(0, 0), (0, 3)], "row int, col int")
    assert [(r["latitude"], r["longitude"]) for r in g.label_cells(df, spec).orderBy("col").collect()] == [(10.0, 0.0), (10.0, 3.0)]
    empty = spark.createDataFrame([], "feature_id long, geometry binary")
    with pytest.raises(ValueError):
        g.grid_spec(total_bounds(with_bounds(empty)))


def test_extents_of_a_burnt_grid_come_from_its_frame(spark):
    """Two small polygons in opposite corners: most rows and columns hold no cell."""
    rows = [(0, bytearray(polygon_bytes([square_at(0.0, 0.0, 2.0)])), 1.0), (1, bytearray(polygon_bytes([square_at(22.0, 22.0, 2.0)])), 2.0)]
    features, _ = convert_features(spark.createDataFrame(rows, "feature_id long, geometry binary, depth double"), {"depth": "depth"})
    grid, _, spec = grid_features(features, ["depth"], [], 1.0)
    assert tuple(variable_extent(grid, spec).first()) == ("depth", 0.0, 24.0, 0.0, 24.0)
    assert tuple(grid_space_extent(grid, spec=spec).first()) == (0.0, 0.0, 24.0, 24.0)
    assert {(r["axis"], r["n"], r["step"]) for r in axis_statistics(grid, spec).collect()} == {("latitude", 24, 1.0), ("longitude", 24, 1.0)}

"""Schema harvest of stored assets: footers, headers and store folders, broken assets as rows."""

import datetime as dt

from shoalgrid.operators.cube import EDGES  # noqa: F401  (the cube store's module)
from shoalgrid.sinks.writers import write_cube, write_grid
from shoalgrid.sources.assets import harvest_schemas


def test_kinds_of_assets(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([(1, "a", 2.5, "x"), (2, "b", 3.5, "y")], "k long, name string, value double, part string")
    df.write.parquet(f"{base}/plain")
    df.write.partitionBy("part").parquet(f"{base}/parted")
    df.coalesce(1).write.option("header", True).csv(f"{base}/table_csv")
    (tmp_path / "one.csv").write_text('id,"a, b",c\n1,2,3\n')
    grid = spark.createDataFrame([("t", 0, 0, 1.0), ("s", 1, 1, 2.0)], "variable string, row int, col int, value float")
    write_grid(grid, f"{base}/grid", size=2)
    readings = spark.createDataFrame([(0.0, 1.0, dt.datetime(2024, 1, 1), 3.0, 1)], "latitude double, longitude double, time timestamp, sst double, hits long")
    write_cube(readings, f"{base}/cube", ["latitude", "longitude", "time"], ["sst", "hits"])
    zarr = tmp_path / "store.zarr"
    for name in ("temp", "salt"):
        (zarr / name).mkdir(parents=True)
        (zarr / name / ".zarray").write_text("{}")
    (zarr / "notes").mkdir()
    (zarr / ".zgroup").write_text("{}")
    (tmp_path / "broken.parquet").write_bytes(b"not parquet at all")
    assets = [("L1", 0, f"{base}/plain"), ("L1", 1, f"file://{base}/parted"), ("L2", 0, f"{base}/table_csv"), ("L2", 1, f"{base}/one.csv"),
              ("L3", 0, f"{base}/grid"), ("L3", 1, f"{base}/cube"), ("L3", 2, str(zarr)), ("L4", 0, f"{base}/broken.parquet"),
              ("L4", 1, f"{base}/missing"), ("L4", 2, None)]
    table = spark.createDataFrame([(*a, "extra") for a in assets], "id string, asset_pos int, path string, name string")
    rows = harvest_schemas(table).collect()
    got = {}
    for r in rows:
        got.setdefault((r.id, r.asset_pos), []).append((r.col_pos, r.name, r.kind, r.error is not None))
    cols = lambda kind, names: sorted((k, n, kind, False) for k, n in enumerate(names))
    assert sorted(got[("L1", 0)]) == cols("parquet", ["k", "name", "value", "part"])
    assert sorted(got[("L1", 1)]) == cols("parquet", ["k", "name", "value", "part"])
    assert sorted(got[("L2", 0)]) == cols("csv", ["k", "name", "value", "part"])
    assert sorted(got[("L2", 1)]) == cols("csv", ["id", "a, b", "c"])
    assert sorted(got[("L3", 0)]) == cols("grid", ["s", "t"])
    assert sorted(got[("L3", 1)]) == cols("cube", ["sst", "hits"])
    assert sorted(got[("L3", 2)]) == cols("zarr", ["salt", "temp"])
    for key in (("L4", 0), ("L4", 1), ("L4", 2)):
        assert got[key] == [(None, None, None, True)]
    assert len(rows) == 4 + 4 + 4 + 3 + 2 + 2 + 2 + 3


def test_no_assets(spark):
    assert harvest_schemas(spark.createDataFrame([], "id string, asset_pos int, path string")).collect() == []

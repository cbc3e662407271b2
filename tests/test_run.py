"""A small catalogue run with every fallback, twice."""

import datetime as dt

from pyspark.sql import functions as F

from shoalgrid.functions.extents import time_pair
from shoalgrid.functions.records import record_link_lists, record_links
from shoalgrid.plans.run import RunSettings, build_catalogue, complete_layers, stage

SETTINGS = RunSettings(run_year=2024, record_host="https://records", select=[{"thematic_lot": ["Physics", "Biology"]}], with_map_links=True)
LAYERS = """id string, pos long, name string, thematic_lot string, subtheme string, subsubtheme string,
 metadataSources array<struct<metadata_type:string,metadata_value:string>>, temporalDatesExtent string,
 bbox array<struct<west:double,south:double,east:double,north:double>>, responsibleParties array<struct<name:string,role:string>>,
 attributes map<string,struct<name_custom:string,description:string>>"""
PREVIOUS = "id string, download_url string, native_asset string, native_arco_mapping map<string,string>, converted_arco_assets array<string>"
BOX = "struct<west:double,south:double,east:double,north:double>"
TIME = "struct<start:timestamp,end:timestamp>"


def sources(url, record=None):
    return [("download_url", "replaced"), ("download_url", url)] + ([("geonetwork_uri", record)] if record else [])


def inputs(spark):
    attributes = {"DEPTH": ("Water Depth", "deep"), "NOTE": (None, "")}
    layers = [
        ("1", 0, "Wind Farms", "Physics", "Sea Use", "Energy", sources("u.zip", "r1"), "2010,2012", [(1.0, 2.0, 3.0, 4.0)], [("Org", "owner")], attributes),
        ("2", 1, "Wind Farms 2", "Physics", "Sea Use", "Energy", sources("u.zip"), None, None, None, None),
        ("3", 2, "Birds", "Biology", "Life", "", sources("b.csv", "r3"), "2015", None, [], None),
        ("4", 3, "Fish", "Biology", "Life", "Stock", sources("f.html", "r4"), "unknown", None, None, attributes),
        ("5", 4, "Other", "Chemistry", "X", "Y", sources("x.zip"), None, None, None, None),
    ]
    previous = [
        ("1", "u.zip", "https://s3/a.parquet", {"NOTE": "note", "DEPTH": "water_depth"}, ["https://s3/a.zarr", "https://s3/a.txt"]),
        ("4", "f.html", "https://s3/f.nc", {}, ["https://s3/f.zarr"]), ("3", "b.csv", "https://s3/b.csv", None, None),
    ]
    none = "CAST(NULL AS string)"
    records = spark.createDataFrame([("3", (5.0, 6.0, 7.0, 8.0), (None, None), "Bird Org", "terms"), ("4", None, (dt.datetime(1990, 1, 1), None), None, None)],
                                    f"id string, box {BOX}, period {TIME}, organisation string, constraints string")
    extents = spark.createDataFrame([("4", None, (dt.datetime(2000, 1, 1), dt.datetime(2001, 1, 1)), (9.0, 9.0, 10.0, 10.0))], f"id string, grid_time {TIME}, table_time {TIME}, grid_box {BOX}")
    again = spark.sql(f"SELECT {none} AS id WHERE false").union(spark.createDataFrame([("3",)], "id string"))
    xml = """<r xmlns:d="http://d"><d:URI description="Digital Object Identifier (DOI)">https://doi/10.1/ab</d:URI><d:URI description="plot">p.png</d:URI></r>"""
    links = record_link_lists(record_links(spark.createDataFrame([("4", "Fish", xml)], "id string, name string, xml string"), "xml", "name"), "id")
    table = spark.createDataFrame(layers, LAYERS).withColumn("properties", F.when(F.col("id") == "2", F.struct(
        F.lit("https://m/wms").alias("url"), F.create_map(F.lit("LAYERS"), F.lit("wind"), F.lit("VERSION"), F.lit("1.1.1")).alias("params"), F.lit(None).cast("array<double>").alias("extent"))))
    state = spark.createDataFrame(previous, PREVIOUS).withColumn("assets", F.array(F.lit("old.csv"), F.concat(F.lit("https://m/wms?SERVICE=WMS&REQUEST=GetMap&LAYERS="), "id")))
    return table, state, again, records.join(links, "id", "left"), extents


def run(spark):
    layers = stage(complete_layers(*inputs(spark), SETTINGS), "layers")
    names = spark.createDataFrame([("cf", "energy", "fam", "cf.json")], "convention string, standard_name string, variable_family string, file string")
    found = spark.createDataFrame([("1", "water_depth")], "id string, name string")
    rejects = spark.createDataFrame([(None, "lost")], "id string, name string")
    return layers, build_catalogue(layers, found, names, rejects, SETTINGS)


def test_catalogue_run(spark):
    layers, tables = run(spark)
    by_id = {r["id"]: r for r in layers.collect()}
    assert sorted(by_id) == ["1", "2", "3", "4"]
    one, two, three, four = (by_id[i] for i in "1234")
    assert (one["native_asset"], two["native_asset"]) == ("https://s3/a.parquet", "https://s3/a.parquet")
    assert three["native_asset"] is None and three["to_fetch"] == "b.csv"  # to be made again
    assert four["native_asset"] == "https://s3/f.nc" and four["converted_arco_assets"] == []  # mapping changed
    assert one["converted_arco_assets"] == ["https://s3/a.zarr"]
    assert [a.split("/")[2] for a in one["assets"]] == ["records", "records", "m", "s3"]
    assert two["assets"][0] == "https://m/wms?SERVICE=WMS&REQUEST=GetMap&LAYERS=wind&VERSION=1.1.1&CRS=CRS:84&BBOX=-180,-90,180,90&WIDTH=800&HEIGHT=600&FORMAT=image/png"
    assert four["assets"][2:] == ["https://m/wms?SERVICE=WMS&REQUEST=GetMap&LAYERS=4", "https://doi/10.1/ab", "p.png", "https://s3/f.nc"] and four["doi"] == "10.1/ab"
    assert [p["name"] for p in one["provider"]] == ["Org"] and [p["name"] for p in two["provider"]] == ["Physics"]
    assert [p["name"] for p in three["provider"]] == ["Bird Org"] and (three["data_rights"], one["data_rights"]) == ("terms", "CC-BY-4.0")
    assert [r["extent"]["west"] for r in (one, two, three, four)] == [1.0, -180.0, 5.0, 9.0]
    years = [(r["time"]["start"].year, r["time"]["end"].year) for r in (one, two, three, four)]
    assert years == [(2010, 2012), (1900, 2024), (1900, 2024), (2000, 2001)]  # the record of 3 has an empty period

    items = {(r["collection"], r["item_id"], r["kind"]) for r in tables["items"].collect()}
    assert items == {
        ("cf-energy", "wind_farms", "native"), ("cf-energy", "wind_farms_2", "native"), ("local-stock", "fish", "native"),
        ("local-water_depth", "water_depth_2010-01-01T00:00:00Z_2012-01-01T00:00:00Z_1.0_2.0_3.0_4.0", "converted"),
    }
    assert {(r["id"], r["in_stac"], r["items"]) for r in tables["status"].collect()} == {("1", "yes", 2), ("2", "yes", 1), ("3", "no", 0), ("4", "yes", 1)}
    energy = tables["collections"].filter("collection = 'cf-energy'").first()
    assert (energy["items"], energy["west"], energy["start"].year, energy["end"].year) == (2, -180.0, 1900, 2024)
    assert [p["name"] for p in energy["providers"]] == ["Org"]
    depth = tables["collections"].filter("title = 'water_depth'").first()
    assert [p["name"] for p in depth["providers"]] == ["Org", "Physics"]
    kinds = {r["asset_kind"]: r["href"] for r in tables["item_assets"].filter("collection = 'local-water_depth'").collect()}
    assert kinds["zarr"] == "https://s3/a.zarr" and kinds["parquet"] == "https://s3/a.parquet" and "xml" in kinds and "csw" in kinds
    rows = {(r["id"], r["updated_arco_variable"], r["in_arco"], r["in_stac"]) for r in tables["attribute_table"].collect()}
    assert rows == {("1", "water_depth", True, True), ("1", "note", False, False), ("2", "", False, False), ("3", "", False, False), ("4", "water_depth", False, False), ("4", "note", False, False)}
    codes = {(r["id"], r["code"]) for r in tables["issues"].collect()}
    assert codes == {(None, "no_id"), ("3", "no_subsubtheme"), ("3", "no_native_asset"), ("1", "variable_not_in_assets"), ("4", "unknown_kind")}  # the DOI page
    assert {r["standard_name"] for r in tables["standard_names"].collect()} == {"energy", "stock", "water_depth"}


def test_a_second_run_gives_equal_tables(spark):
    (_, first), (_, second) = run(spark), run(spark)
    for name in first:
        flat = [F.to_json(F.struct(*first[name].columns)).alias("row")]
        a, b = first[name].select(*flat), second[name].select(*flat)
        assert a.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_open_pairs_cast(spark):
    assert spark.range(1).select(time_pair(F.lit(None), F.lit("2020-01-01")).alias("t")).first()["t"]["end"].year == 2020


def test_staged_tables_go_with_their_job(spark):
    from pathlib import Path

    from shoalgrid.plans.run import stage
    from shoalgrid.session import job_folder, scratch_path

    with job_folder(spark) as folder:
        assert stage(spark.range(3), "x").count() == 3 and len(list(Path(folder).iterdir())) == 1
    assert not Path(folder).exists() and "/job-" not in scratch_path(spark, "y")

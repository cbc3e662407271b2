import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoalgrid.functions import extents as e
from shoalgrid.functions import text as t
from shoalgrid.functions.records import record_facts, record_links


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def each(spark, texts, fn):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    return [r["v"] for r in df.select("i", fn(F.col("x")).alias("v")).orderBy("i").collect()]


def test_slug(spark):
    cases = {
        "km² per m³": "km_2_per_m_3", "½ mile": "½_mile", "x____y": "x__y", " ..A/b - c": "a_b_c", "Température °C": "température_c",
        "a b c": "a_b_c", "ét": "et", "tail. . ": "tail", "v1.5 (x)": "v1.5_x", "": "",
    }
    assert dict(zip(cases, each(spark, list(cases), t.slug))) == cases


def test_slug_of_a_slug_is_the_same(spark):
    texts = ["Wind Farm-Power (MW)", "Sea/Bed 2.0", "Ocean  Colour"]
    once = each(spark, texts, t.slug)
    assert each(spark, once, t.slug) == once


DATES = {
    "2023-12-31": (None, "2023-12-31"), "05-06-2023": (None, "2023-06-05"), "12-31-2023": (None, "2023-12-31"), "2023": (None, "2023-01-01"),
    "May 2023": (None, "2023-05-01"), "2021-2023": ("2021-01-01", "2023-01-01"), "2010,2012": ("2010-01-01", "2012-01-01"),
    "2021-01-01/2021-12-31": ("2021-01-01", "2021-12-31"), "1850": (None, None), "": (None, None), None: (None, None), "2019,later": ("2019-01-01", None),
    "1900-01-01": (None, None), "2023.7.4": (None, "2023-07-04"),
}


def test_text_extent(spark):
    cases = DATES
    got = each(spark, list(cases), e.text_extent)
    seen = [tuple(x.strftime("%Y-%m-%d") if x else None for x in (g or (None, None))) for g in got]
    assert dict(zip(cases, seen)) == cases


def test_record_dates(spark):
    cases = {"2015": "2015-01-01T00:00:00Z", "2015-06": "2015-06-01T00:00:00Z", "2015-06-07": "2015-06-07T00:00:00Z", "2015-06-07T01:02:03.5Z": "2015-06-07T01:02:03Z",
             "2015-06-07T01:02:03-03:00": "2015-06-07T04:02:03Z", "now": None}
    assert dict(zip(cases, each(spark, list(cases), lambda x: e.stamp(e.record_date(x))))) == cases


@pytest.mark.parametrize("given, expected", [
    ([("2001-01-01", "2002-01-01"), ("1990-01-01", "1991-01-01")], (2001, 2002)),
    ([(None, "2002-01-01"), ("1990-01-01", None)], (1990, 2024)),  # a later source replaces both ends
    ([(None, "2002-01-01"), None], (1900, 2002)),
    ([("2030-01-01", None)], (2024, 2030)),  # ends are put in order
    ([None], (1900, 2024)),
])
def test_time_cascade(spark, given, expected):
    none = F.lit(None).cast("struct<start:timestamp,end:timestamp>")
    columns = [e.time_pair(F.lit(g[0]), F.lit(g[1])) if g else none for g in given]
    got = one(spark, e.time_cascade(columns, 2024))
    assert (got["start"].year, got["end"].year) == expected


def test_links(spark):
    kinds = {"a.zarr/": "zarr", "a.geoparquet": "geoparquet", "http://x/wms?SERVICE=WMS&REQUEST=GetMap&l": "wms", "http://x/formatters/xml": "xml",
             "http://x/csw?request=G": "csw", "a.bin": None, "x.tif": "geotiff"}
    assert dict(zip(kinds, each(spark, list(kinds), lambda u: t.media_type(u)["kind"]))) == kinds
    names = {"https://h/a/b.zip?x#y": "b.zip", "https://h": "", "https://h/w?typeName=ns:lay&outputFormat=SHAPE-ZIP": "lay.zip", "https://h/w?outputFormat=SHAPE-ZIP": "None.zip"}
    assert dict(zip(names, each(spark, list(names), t.link_name))) == names
    usable = {"a.zip": True, "a.parquet/": True, "x/parquet/part": True, "a.html": False, "a.zipx": False}
    assert dict(zip(usable, each(spark, list(usable), t.is_download))) == usable


def test_number_text(spark):
    numbers = [-180.0, 0.0, 12345678.5, 1e7, 0.0005, -0.00012, 3.25, 90.0, 123456789012.0, 0.00001, -1.5e-05, 1e16, 2.5e20, 1e-100, 1.25e-7]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i int, n double")
    got = [r["v"] for r in df.select("i", t.number_text(F.col("n")).alias("v")).orderBy("i").collect()]
    assert got == [repr(n) for n in numbers]


def test_descriptions_keep_the_last_of_equal_names(spark):
    attributes = F.create_map(
        F.lit("A"), F.struct(F.lit("same").alias("name_custom"), F.lit("first").alias("description")),
        F.lit("B"), F.struct(F.lit("Same").alias("name_custom"), F.lit("second").alias("description")),
        F.lit("C"), F.struct(F.lit(None).cast("string").alias("name_custom"), F.lit("").alias("description")),
    )
    assert one(spark, t.description_map(attributes)) == {"same": "second"}
    assert one(spark, t.name_mapping(attributes)) == {"A": "same", "B": "same", "C": "c"}


def test_number_grid_names_and_directory_links(spark):
    dds = "Dataset { GRID { ARRAY: Float32 t[a];\n MAPS: b; } temp; Float64 c; } x;"
    assert one(spark, t.grid_names(F.lit(dds))) == ["temp"]
    page = '<tr><td><img src="x" class="B" alt="[BIN]"></td><td> <a href="one.nc">1</a></td></tr>'
    assert one(spark, t.first_binary_link(F.lit(page))) == "one.nc"
    bare = page.replace('<a href="one.nc">1</a>', "none") + page.replace("one", "two")
    assert one(spark, t.first_binary_link(F.lit(bare))) is None
    assert one(spark, t.first_binary_link(F.lit("<html></html>"))) is None


RECORD = """<?xml version="1.0"?><m:MD xmlns:m="http://m" xmlns:g="http://gml"><m:CI_ResponsibleParty><m:organisationName>
<m:CharacterString>Org</m:CharacterString></m:organisationName></m:CI_ResponsibleParty>
<m:EX_GeographicBoundingBox><m:westBoundLongitude><m:Decimal> -5.5 </m:Decimal></m:westBoundLongitude><m:eastBoundLongitude><m:Decimal>6</m:Decimal></m:eastBoundLongitude>
<m:southBoundLatitude><m:Decimal>7</m:Decimal></m:southBoundLatitude><m:northBoundLatitude><m:Decimal>8</m:Decimal></m:northBoundLatitude></m:EX_GeographicBoundingBox>
<g:TimePeriod><g:beginPosition>2001</g:beginPosition><g:endPosition/></g:TimePeriod><g:TimePeriod><g:beginPosition>1999</g:beginPosition></g:TimePeriod></m:MD>"""


def test_records(spark):
    rows = [("a", RECORD), ("b", "<open>"), ("c", None), ("d", "<empty/>")]
    facts = {r["id"]: r for r in record_facts(spark.createDataFrame(rows, "id string, xml string"), "xml").collect()}
    a = facts["a"]
    assert (a["box"]["west"], a["box"]["north"], a["organisation"], a["constraints"]) == (-5.5, 8.0, "Org", None)
    assert (a["period"]["start"], a["period"]["end"]) == (dt.datetime(2001, 1, 1), None)
    assert [facts[k]["is_broken"] for k in "abcd"] == [False, True, False, False]
    assert facts["d"]["box"] is None and facts["d"]["period"] is None


def test_record_links_with_missing_attributes(spark):
    xml = """<r xmlns:d="http://d" xmlns:x="http://x"><d:URI protocol="P" description="one">l1</d:URI><d:URI x:type="q" description="two">l2</d:URI>
    <d:URI>l3</d:URI><d:URI description="one">l4</d:URI><d:URI description="none"/></r>"""
    got = record_links(spark.createDataFrame([("a", "Layer", xml), ("b", "Layer", "<r>")], "id string, name string, xml string"), "xml", "name")
    rows = [(r["description"], r["link"], r["protocol"], r["link_pos"]) for r in got.orderBy("link_pos").collect()]
    assert rows == [("one", "l4", "HTTP", 0), ("two", "l2", "HTTP", 1), ("Layer data product", "l3", "HTTP", 2)]

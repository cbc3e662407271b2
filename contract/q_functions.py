"""F1-F29."""

from pyspark.sql import functions as F

from contract.registry import INPUTS, made, query, table
from contract import q_sources  # noqa: F401  (inputs)
from contract.q_catalogue import cat_layers
from shoalgrid.functions import extents as e
from shoalgrid.functions import text as t
from shoalgrid.functions.records import record_facts, record_links


def slug_sql(text):
    steps = [(r"^[.\s]+", ""), (r"[.\s]+$", ""), ("/", "_"), (r"[-\s]+", "_"), ("__", "_"), (r"[^\p{L}\p{N}_\s.-]", ""), ("²", "_2"), ("³", "_3")]
    for pattern, new in steps:
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return f"lower({text})"


INPUTS["texts"] = """
SELECT 'd' AS src, doc_id AS key, text FROM @documents
UNION ALL SELECT 'p', p_partkey, ' ..' || p_name || ' ½-mile km² per m³ A/b - c____x. ' || p_brand FROM @part"""


@query("f1_slug", f"SELECT src, key, {slug_sql('text')} AS slug FROM texts", ("texts",))
def f1(spark, sf):
    return made(spark, sf, "texts").select("src", "key", t.slug(F.col("text")).alias("slug"))


_Y, _M, _D = "cast(year(o_orderdate) AS string)", "cast(month(o_orderdate) AS string)", "cast(day(o_orderdate) AS string)"
_MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
_NAME = "CASE month(o_orderdate) " + " ".join(f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(_MONTHS)) + " END"
_PAD = "lpad(" + _M + ", 2, '0') || '-' || lpad(" + _D + ", 2, '0')"
_FORMS = [
    f"{_Y} || '-' || {_PAD}", f"{_D} || '-' || {_M} || '-' || {_Y}", f"{_M} || '-' || {_D} || '-' || {_Y}",
    f"{_Y} || '/' || {_M} || '/' || {_D}", f"{_D} || '/' || {_M} || '/' || {_Y}", f"{_M} || '/' || {_D} || '/' || {_Y}",
    f"{_Y} || '.' || {_M} || '.' || {_D}", f"{_D} || '.' || {_M} || '.' || {_Y}", f"{_Y} || '-' || {_M}", f"{_Y} || '/' || {_M}",
    f"{_NAME} || ' ' || {_Y}", f"substr({_NAME}, 1, 3) || ' ' || {_Y}", _Y,
    "'unknown'", "''", "'1850'", f"'  ' || {_Y} || '-' || {_PAD} || ' '", "cast(NULL AS string)", "'1900-01-01'",
]
INPUTS["date_texts"] = (
    "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, o_orderkey % 19 AS form, CASE o_orderkey % 19 "
    + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(_FORMS)) + " END AS text FROM @orders"
)
_END = """CASE WHEN form IN (0, 1, 3, 4, 6, 7, 16) THEN make_date(y, m, d) WHEN form IN (2, 5) THEN CASE WHEN d <= 12 THEN make_date(y, d, m) ELSE make_date(y, m, d) END
 WHEN form IN (8, 9, 10, 11) THEN make_date(y, m, 1) WHEN form = 12 THEN make_date(y, 1, 1) END"""


@query("f2_single_date", f"SELECT o_orderkey, strftime({_END}, '%Y-%m-%d') AS end_date FROM date_texts", ("date_texts",))
def f2(spark, sf):
    found = e.single_date(F.col("text"))
    return made(spark, sf, "date_texts").select("o_orderkey", F.date_format(found, "yyyy-MM-dd").alias("end_date"))


_RANGES = [
    f"{_Y} || '-' || cast(year(o_orderdate) + 3 AS string)", f"{_Y} || ',' || cast(year(o_orderdate) + 3 AS string)",
    f"{_Y} || '-' || {_PAD} || '/' || cast(year(o_orderdate) + 3 AS string) || '-12-31'",
    f"{_Y} || '-' || {_PAD} || ', ' || cast(year(o_orderdate) + 3 AS string) || '-12-31'",
    f"{_Y} || '/' || {_M} || '/' || {_D} || ' - ' || cast(year(o_orderdate) + 3 AS string) || '/12/31'",
    f"{_Y} || ',' || 'later'", "'first,' || " + _Y, f"{_Y} || '-' || {_PAD}", "cast(NULL AS string)",
]
INPUTS["range_texts"] = (
    "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, o_orderkey % 9 AS form, CASE o_orderkey % 9 "
    + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(_RANGES)) + " END AS text FROM @orders"
)


def days(extent):
    return [F.date_format(extent[k], "yyyy-MM-dd").alias(k) for k in ("start", "end")]


@query("f3_date_range", """SELECT o_orderkey, strftime(CASE WHEN form IN (0, 1, 5) THEN make_date(y, 1, 1) WHEN form IN (2, 3, 4) THEN make_date(y, m, d) END, '%Y-%m-%d') AS "start",
 strftime(CASE WHEN form IN (0, 1) THEN make_date(y + 3, 1, 1) WHEN form IN (2, 3, 4) THEN make_date(y + 3, 12, 31) END, '%Y-%m-%d') AS "end" FROM range_texts""", ("range_texts",))
def f3(spark, sf):
    return made(spark, sf, "range_texts").select("o_orderkey", *days(e.date_range(F.col("text"))))


_STAMPS = [
    _Y, f"{_Y} || '-' || lpad({_M}, 2, '0')", f"{_Y} || '-' || {_PAD}", f"{_Y} || '-' || {_PAD} || 'T10:20:30'",
    f"{_Y} || '-' || {_PAD} || 'T10:20:30.123Z'", f"{_Y} || '-' || {_PAD} || 'T10:20:30+02:00'", f"{_Y} || '-' || {_PAD} || 'T10:20:30Z'", "'soon'", "cast(NULL AS string)",
]
INPUTS["record_texts"] = (
    "SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, o_orderkey % 9 AS form, CASE o_orderkey % 9 "
    + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(_STAMPS)) + " END AS text FROM @orders"
)


@query("f4_record_date", """SELECT o_orderkey, CASE form WHEN 0 THEN strftime(make_date(y, 1, 1), '%Y-%m-%dT00:00:00Z') WHEN 1 THEN strftime(make_date(y, m, 1), '%Y-%m-%dT00:00:00Z')
 WHEN 2 THEN strftime(make_date(y, m, d), '%Y-%m-%dT00:00:00Z') WHEN 3 THEN strftime(make_date(y, m, d), '%Y-%m-%dT10:20:30Z') WHEN 4 THEN strftime(make_date(y, m, d), '%Y-%m-%dT10:20:30Z')
 WHEN 5 THEN strftime(make_date(y, m, d), '%Y-%m-%dT08:20:30Z') WHEN 6 THEN strftime(make_date(y, m, d), '%Y-%m-%dT10:20:30Z') END AS stamp FROM record_texts""", ("record_texts",))
def f4(spark, sf):
    return made(spark, sf, "record_texts").select("o_orderkey", e.stamp(e.record_date(F.col("text"))).alias("stamp"))


@query("f5_close_extent", """WITH t AS (SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END, TIMESTAMP '1900-01-01') AS a,
 coalesce(CASE WHEN o_orderkey % 5 > 0 THEN TIMESTAMP '1999-06-30 12:00:00' END, TIMESTAMP '2024-12-31 23:59:59') AS b FROM orders)
SELECT o_orderkey, strftime(least(a, b), '%Y-%m-%dT%H:%M:%SZ') AS "start", strftime(greatest(a, b), '%Y-%m-%dT%H:%M:%SZ') AS "end" FROM t""")
def f5(spark, sf):
    given = e.time_pair(
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderdate")),
        F.when(F.col("o_orderkey") % 5 > 0, F.lit("1999-06-30 12:00:00").cast("timestamp")),
    )
    closed = e.close_extent(given, 2024)
    return table(spark, sf, "orders").select("o_orderkey", *[e.stamp(closed[k]).alias(k) for k in ("start", "end")])


@query("f6_time_cascade", f"""WITH t AS (SELECT o_orderkey, form, y, m, d, {_END} AS one FROM date_texts), c AS (SELECT *,
 CASE WHEN o_orderkey % 7 = 0 THEN TIMESTAMP '2001-01-01' WHEN o_orderkey % 4 = 1 THEN make_date(1990 + o_orderkey % 20, 1, 1)::TIMESTAMP END AS s,
 CASE WHEN o_orderkey % 7 = 0 THEN TIMESTAMP '2002-01-01' WHEN o_orderkey % 4 = 1 THEN CASE WHEN o_orderkey % 8 = 1 THEN TIMESTAMP '2015-06-01' END ELSE one::TIMESTAMP END AS e FROM t),
 f AS (SELECT *, coalesce(s, TIMESTAMP '1900-01-01') AS s1, coalesce(e, TIMESTAMP '2024-12-31 23:59:59') AS e1 FROM c)
SELECT o_orderkey, strftime(least(s1, e1), '%Y-%m-%dT%H:%M:%SZ') AS "start", strftime(greatest(s1, e1), '%Y-%m-%dT%H:%M:%SZ') AS "end" FROM f""", ("date_texts",))
def f6(spark, sf):
    key = F.col("o_orderkey")
    grid = F.when(key % 7 == 0, e.time_pair(F.lit("2001-01-01"), F.lit("2002-01-01")))
    begin = e.record_date((F.lit(1990) + key % 20).cast("string"))
    record = F.when(key % 4 == 1, e.time_pair(begin, F.when(key % 8 == 1, e.record_date(F.lit("2015-06")))))
    extent = e.time_cascade([grid, e.text_extent(F.col("text")), record], 2024)
    return made(spark, sf, "date_texts").select("o_orderkey", *[e.stamp(extent[k]).alias(k) for k in ("start", "end")])


@query("f7_day_start", "SELECT event_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS day FROM events")
def f7(spark, sf):
    return table(spark, sf, "events").select("event_id", F.date_format(e.day_start(F.col("ts")), "yyyy-MM-dd HH:mm:ss").alias("day"))


@query("f8_space_cascade", """SELECT id, CASE WHEN pos % 5 = 0 THEN west WHEN pos % 5 = 1 THEN west + 1 WHEN pos % 5 = 2 THEN 1 WHEN pos % 5 = 3 THEN 2 ELSE -180 END::DOUBLE AS west,
 CASE WHEN pos % 5 = 0 THEN south WHEN pos % 5 = 1 THEN south WHEN pos % 5 = 2 THEN 10 WHEN pos % 5 = 3 THEN 20 ELSE 90 END::DOUBLE AS north FROM layers""", ("layers",))
def f8(spark, sf):
    kind = F.col("pos") % 5
    w, s = F.col("west"), F.col("south")
    given = F.when(kind == 0, F.array(w, s, w, s)).otherwise(F.array(w))
    box = F.struct((w + 1).alias("west"), s.alias("south"), w.alias("east"), s.alias("north"))
    boxes = F.when(kind == 1, F.array(box, box)).otherwise(F.slice(F.array(box), 1, 0))
    grid = F.when(kind == 2, e.rectangle(F.lit(1), F.lit(1), F.lit(10), F.lit(10)))
    record = F.when(kind <= 3, e.rectangle(F.lit(2), F.lit(2), F.lit(20), F.lit(20)))
    extent = e.space_cascade(given, boxes, grid, record)
    return made(spark, sf, "layers").select("id", extent["west"].alias("west"), extent["north"].alias("north"))


@query("f9_providers", """SELECT id, CASE WHEN pos % 3 = 0 THEN 'party:owner' || CASE WHEN pos % 2 = 0 THEN '' ELSE ';' || thematic_lot || ':provider' END
  WHEN pos % 3 = 1 THEN 'org ' || id || ':provider;' || thematic_lot || ':provider' ELSE thematic_lot || ':provider' END
  || CASE WHEN pos % 3 = 0 AND pos % 2 = 0 THEN ';' || thematic_lot || ':user' ELSE '' END AS providers,
 CASE WHEN pos % 3 = 1 THEN 'own terms' ELSE 'CC-BY-4.0' END AS rights FROM layers""", ("layers",))
def f9(spark, sf):
    lot, kind = F.col("thematic_lot"), F.col("pos") % 3
    party = e.provider(F.lit("party"), F.lit("owner"))
    parties = F.when(kind == 0, F.when(F.col("pos") % 2 == 0, F.array(party, e.provider(lot, F.lit("user")))).otherwise(F.array(party)))
    organisation = F.when(kind == 1, F.concat(F.lit("org "), "id"))
    people = e.item_providers(e.provider_cascade(parties, organisation, lot), lot)
    text = F.array_join(F.transform(people, lambda p: F.concat_ws(":", p["name"], p["role"])), ";")
    rights = e.rights_cascade(parties, F.when(kind <= 1, F.lit("own terms")))
    return made(spark, sf, "layers").select("id", text.alias("providers"), rights.alias("rights"))


@query("f10_map_link", """SELECT id, CASE WHEN pos % 4 > 0 THEN download_url || '?SERVICE=WMS&REQUEST=GetMap&LAYERS=' || subtheme || '&VERSION=1.3.0&CRS=CRS:84&BBOX=-180,-90,180,90&WIDTH=800&HEIGHT=600&FORMAT=image/png'
 || CASE WHEN native_data_product IS NOT NULL THEN '&time=' || native_data_product ELSE '' END END AS link FROM layers""", ("layers",))
def f10(spark, sf):
    base = F.when(F.col("pos") % 4 == 0, F.concat("download_url", F.lit("?GetLegendGraphic"))).otherwise(F.col("download_url"))
    world = F.array(*[F.lit(v) for v in ("-180", "-90", "180", "90")])
    link = t.map_link(base, F.col("subtheme"), F.lit("1.3.0"), world, F.col("native_data_product"))
    return made(spark, sf, "layers").select("id", link.alias("link"))


@query("f11_record_links", """SELECT id, 'https://g.example.org/srv/api/records/' || id || '/formatters/xml' AS xml_link,
 'https://c.example.org/srv/en/csw?request=GetRecordById&service=CSW&version=2.0.2&elementSetName=full&id=' || id AS csw_link FROM layers""", ("layers",))
def f11(spark, sf):
    links = t.record_links(F.col("id"), "https://g.example.org", "https://c.example.org/srv/en")
    return made(spark, sf, "layers").select("id", links[0].alias("xml_link"), links[1].alias("csw_link"))


_ENDS = ["", ".zarr", ".zarr/", ".nc", ".zip", ".tif", ".tiff", ".parquet", ".parquet/", ".geoparquet", ".geoparquet/", ".csv", ".json", ".html", ".png", ".jpg",
         "/wms?SERVICE=WMS&REQUEST=GetMap&x", "/formatters/xml", "/csw?request=GetRecordById"]
INPUTS["links"] = "SELECT page_id, url || CASE page_id % 19 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_ENDS)) + " END AS url FROM @pages"
_KINDS = [("zarr", "zarr", "data"), ("zarr/", "zarr", "data"), ("nc", "netcdf", "data"), ("zip", "zip", "data"), ("tif", "geotiff", "data"), ("tiff", "geotiff", "data"),
          ("parquet", "parquet", "data"), ("parquet/", "parquet", "data"), ("geoparquet", "geoparquet", "data"), ("geoparquet/", "geoparquet", "data"), ("csv", "csv", "data"),
          ("json", "json", "metadata"), ("html", "html", "metadata"), ("png", "png", "thumbnail"), ("jpg", "jpg", "thumbnail")]
_KIND_SQL = " ".join(f"WHEN suffix(url, '.{s}') THEN '{k}/{r}'" for s, k, r in _KINDS) + """ WHEN contains(url, 'wms?SERVICE=WMS&REQUEST=GetMap') THEN 'wms/service'
 WHEN contains(url, 'xml') THEN 'xml/metadata' WHEN contains(url, 'csw?request') THEN 'csw/metadata'"""


@query("f12_media_type", f"SELECT page_id, url, CASE {_KIND_SQL} END AS kind FROM links", ("links",))
def f12(spark, sf):
    media = t.media_type(F.col("url"))
    return made(spark, sf, "links").select("page_id", "url", F.concat(media["kind"], F.lit("/"), media["role"]).alias("kind"))


@query("f13_store_kind", """SELECT page_id, suffix(url, '.zarr') OR suffix(url, '.zarr/') AS is_grid, suffix(rtrim(url, '/'), '.parquet') OR suffix(rtrim(url, '/'), '.geoparquet') AS is_table,
 suffix(rtrim(url, '/'), '.parquet') AS is_geo_candidate FROM links""", ("links",))
def f13(spark, sf):
    url = F.col("url")
    return made(spark, sf, "links").select(
        "page_id", t.is_grid_store(url).alias("is_grid"), t.is_table_store(url).alias("is_table"), t.is_geo_candidate(url).alias("is_geo_candidate")
    )


INPUTS["wfs_links"] = """
SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN 'https://h.example.org/wfs?service=WFS&typeName=ws%3Alayer_' || cast(page_id AS string) || '&outputFormat=SHAPE-ZIP' ELSE url END AS link,
 'https://s3.example.org/bucket/' || cast(page_id AS string) || '/a b.parquet?x=1' AS store_url, 'attachment; filename="f' || cast(page_id AS string) || '.zip"' AS header FROM @pages"""


@query("f14_link_name", r"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'layer_' || page_id || '.zip' ELSE split_part(split_part(split_part(url, '#', 1), '?', 1), '/', -1) END AS name,
 's3://bucket/' || page_id || '/a b.parquet' AS uri, 'https://s3.example.org' AS endpoint, 'f' || page_id || '.zip' AS file FROM wfs_links""", ("wfs_links",))
def f14(spark, sf):
    address = t.store_address(F.col("store_url"))
    return made(spark, sf, "wfs_links").select(
        "page_id", t.link_name(F.col("link")).alias("name"), address["uri"].alias("uri"), address["endpoint"].alias("endpoint"),
        t.disposition_name(F.col("header")).alias("file"),
    )


@query("f15_split_product", """SELECT id, CASE WHEN pos % 2 = 0 THEN native_data_product || '.gdb' ELSE native_data_product END AS product,
 CASE WHEN pos % 2 = 0 AND native_data_product IS NOT NULL THEN subtheme END AS layer FROM layers""", ("layers",))
def f15(spark, sf):
    named = F.when(F.col("pos") % 2 == 0, F.concat("native_data_product", F.lit(".gdb_"), "subtheme")).otherwise(F.col("native_data_product"))
    parts = t.split_product(named)
    return made(spark, sf, "layers").select("id", parts["product"].alias("product"), parts["layer"].alias("layer"))


@query("f16_name_mapping", """SELECT id, 'DEPTH=depth_m_' || pos % 5 || ',ZONE=zone,gone=lost' AS mapping, 'depth_m_' || pos % 5 || '=deep' AS descriptions FROM cat_layers WHERE is_converted""", ("cat_layers",))
def f16(spark, sf):
    def text(m):
        return F.array_join(F.transform(F.sort_array(F.map_entries(m)), lambda x: F.concat_ws("=", x["key"], x["value"])), ",")

    return cat_layers(spark, sf).filter("is_converted").select(
        "id", text(F.col("native_arco_mapping")).alias("mapping"), text(F.col("arco_variable_description")).alias("descriptions")
    )


@query("f17_item_id", """SELECT id, replace(lower(name), '#', '') AS native_id, 'zone_' || CASE WHEN pos % 2 = 0 THEN '' ELSE 'deep zone_' END
 || CASE WHEN pos % 2 = 0 THEN start_year || '-01-01T00:00:00Z_' || end_year || '-12-31T00:00:00Z_' ELSE '' END || west || '_' || south || '_' || east || '_' || north
 || CASE WHEN pos % 2 = 0 THEN '' ELSE '_' || start_year || '-01-01 00:00:00+00:00_' || end_year || '-12-31 00:00:00+00:00' END AS converted_id,
 'Customer' || lpad(id, 9, '0') AS title FROM cat_layers""", ("cat_layers",))
def f17(spark, sf):
    start, end = e.day_start(F.col("time.start")), e.day_start(F.col("time.end"))
    described = F.when(F.col("pos") % 2 != 0, F.lit("deep zone"))
    return cat_layers(spark, sf).select(
        "id", e.native_item_id(F.col("name")).alias("native_id"),
        e.converted_item_id(F.lit("zone"), start, end, F.col("extent"), described).alias("converted_id"),
        t.item_title(e.native_item_id(F.col("name"))).alias("title"),
    )


@query("f18_footprint", """SELECT id, 'Polygon' AS type, 5 AS points, west || ',' || south || ';' || west || ',' || north || ';' || east || ',' || north || ';' || east || ',' || south || ';' || west || ',' || south AS ring FROM cat_layers""", ("cat_layers",))
def f18(spark, sf):
    shape = e.footprint(F.col("extent"))
    ring = shape["coordinates"][0]
    text = F.array_join(F.transform(ring, lambda p: F.array_join(F.transform(p, t.number_text), ",")), ";")
    return cat_layers(spark, sf).select("id", shape["type"].alias("type"), F.size(ring).alias("points"), text.alias("ring"))


@query("f19_extension_links", """SELECT id, CASE WHEN pos % 2 = 0 THEN 'https://stac-extensions.github.io/projection/v1.1.0/schema.json' ELSE '' END
 || CASE WHEN pos % 2 = 0 AND pos % 3 = 0 THEN ',' ELSE '' END || CASE WHEN pos % 3 = 0 THEN 'https://stac-extensions.github.io/datacube/v1.0.0/schema.json' ELSE '' END AS links FROM layers""", ("layers",))
def f19(spark, sf):
    kinds = F.when(F.col("pos") % 3 == 0, F.array(F.lit("zip"), F.lit("zarr"))).otherwise(F.array(F.lit("zip")))
    return made(spark, sf, "layers").select("id", F.array_join(t.extension_links(F.col("pos") % 2 == 0, kinds), ",").alias("links"))


@query("f20_clean_category", "SELECT feature_id, CASE WHEN kind IS NULL OR kind IN (' ', 'nan', '') THEN 'None' ELSE kind END AS kind FROM corners", ("corners",))
def f20(spark, sf):
    return made(spark, sf, "corners").select("feature_id", t.clean_category(F.col("kind")).alias("kind"))


@query("f21_doi", "SELECT page_id, list_aggregate(string_split(url, '/')[-2:], 'string_agg', '/') AS doi FROM pages")
def f21(spark, sf):
    return table(spark, sf, "pages").select("page_id", t.doi_of(F.col("url")).alias("doi"))


@query("f22_record_facts", """SELECT id, CASE WHEN pos % 5 > 0 AND pos % 7 > 0 THEN pos % 170 + 0.5e0 END AS west, CASE WHEN pos % 5 > 0 AND pos % 7 > 0 THEN -(pos % 80 + 0.25e0) END AS south,
 CASE WHEN pos % 3 > 0 AND pos % 7 > 0 THEN (1950 + pos % 60) || '-01-01T00:00:00Z' END AS begin_stamp, CASE WHEN pos % 3 > 0 AND pos % 4 > 0 AND pos % 7 > 0 THEN '2015-06-01T00:00:00Z' END AS end_stamp,
 CASE WHEN pos % 7 > 0 THEN 'org ' || id END AS organisation, CASE WHEN pos % 6 = 0 AND pos % 7 > 0 THEN 'terms ' || id END AS constraints FROM layers""", ("layers",))
def f22(spark, sf):
    return record_facts(made(spark, sf, "records"), "xml").select(
        "id", F.col("box.west").alias("west"), F.col("box.south").alias("south"), e.stamp(F.col("period.start")).alias("begin_stamp"),
        e.stamp(F.col("period.end")).alias("end_stamp"), "organisation", "constraints",
    )


INPUTS["csw_records"] = f"""
SELECT id, name, '<csw:Response xmlns:csw="http://c" xmlns:dc="http://d"><csw:Record><dc:title>t</dc:title>'
 || '<dc:URI protocol="WWW:LINK" description="Digital Object Identifier (DOI)">https://doi.example.org/10.5/' || id || '</dc:URI>'
 || '<dc:URI description="data"> https://a/' || id || ' </dc:URI><dc:URI description="empty"></dc:URI><dc:URI>https://b/' || id || '</dc:URI>'
 || '<dc:URI protocol="FTP" description="data">https://c/' || id || '?x=1&amp;y=2</dc:URI></csw:Record></csw:Response>' AS xml FROM ({INPUTS['layers']}) l"""


@query("f22_record_links", """SELECT id, u.d AS description, u.l AS link, u.p AS protocol FROM (SELECT id, unnest([{'d': 'Digital Object Identifier (DOI)', 'l': 'https://doi.example.org/10.5/' || id, 'p': 'WWW:LINK'},
 {'d': 'data', 'l': 'https://c/' || id || '?x=1&y=2', 'p': 'FTP'}, {'d': name || ' data product', 'l': 'https://b/' || id, 'p': 'HTTP'}]) AS u FROM layers)""", ("layers",))
def f22_links(spark, sf):
    return record_links(made(spark, sf, "csw_records"), "xml", "name").select("id", "description", "link", "protocol")


INPUTS["descriptors"] = """
SELECT 'ds' || cast(s_suppkey AS string) AS dataset, 'Dataset { GRID { ARRAY: Float32 a[time]; MAPS: Float64 time[time]; } temp_' || cast(s_suppkey AS string)
 || '; Float64 depth; GRID{ ARRAY: x; } salt; } ds;' AS dds FROM @supplier"""


@query("f23_grid_names", "SELECT 'ds' || s_suppkey AS dataset, 'temp_' || s_suppkey || ',salt' AS names FROM supplier")
def f23(spark, sf):
    return made(spark, sf, "descriptors").select("dataset", F.array_join(t.grid_names(F.col("dds")), ",").alias("names"))


INPUTS["directories"] = """
SELECT page_id, CASE WHEN page_id % 4 = 0 THEN html ELSE html || '<table><tr><td><img class="D" alt="[DIR]"></td><td><a href="up/">up</a></td></tr><tr><td><img class="B" alt="[BIN]" src="b.gif"></td><td><a href="file'
 || cast(page_id AS string) || '.nc">f</a></td></tr><tr><td><img alt="[BIN]" class="B"></td><td><a href="later.nc">l</a></td></tr></table>' END AS html FROM @pages"""


@query("f24_first_binary_link", "SELECT page_id, CASE WHEN page_id % 4 > 0 THEN 'file' || page_id || '.nc' END AS link FROM pages")
def f24(spark, sf):
    return made(spark, sf, "directories").select("page_id", t.first_binary_link(F.col("html")).alias("link"))


@query("f25_title_words", """SELECT p_partkey, split_part(p_name, ' ', 2) AS theme, p_name AS collection FROM part""")
def f25(spark, sf):
    words = t.title_words(F.concat(F.lit(" "), "p_name", F.lit("  "), "p_brand"))
    return table(spark, sf, "part").select("p_partkey", words["theme"].alias("theme"), words["collection"].alias("collection"))


@query("f26_rewrite_links", "SELECT id, 'parent=https://api.example.org/' || subtheme AS links FROM layers", ("layers",))
def f26(spark, sf):
    def link(rel, href):
        return F.struct(F.lit(rel).alias("rel"), href.alias("href"))

    links = F.array(link("self", F.col("name")), link("parent", F.col("id")), link("root", F.col("id")))
    new = t.rewrite_links(links, "parent", F.concat(F.lit("https://api.example.org/"), "subtheme"))
    return made(spark, sf, "layers").select("id", F.array_join(F.transform(new, lambda x: F.concat_ws("=", x["rel"], x["href"])), ",").alias("links"))


@query("f27_storage_key", f"SELECT id, {slug_sql('thematic_lot')} || '/' || id || '/' || name AS key FROM layers", ("layers",))
def f27(spark, sf):
    return made(spark, sf, "layers").select("id", t.storage_key(F.col("thematic_lot"), F.col("id"), F.col("name")).alias("key"))


@query("f28_collection_id", f"SELECT p_partkey, 'cf-' || {slug_sql('p_name')} AS collection FROM part")
def f28(spark, sf):
    return table(spark, sf, "part").select("p_partkey", t.collection_id(F.lit("cf"), F.col("p_name")).alias("collection"))


@query("f29_native_of", "SELECT id, 'DEPTH' AS depth, 'ZONE' AS zone, NULL::VARCHAR AS none FROM cat_layers WHERE is_converted", ("cat_layers",))
def f29(spark, sf):
    mapping = F.col("native_arco_mapping")
    names = {"depth": F.concat(F.lit("depth_m_"), F.col("pos") % 5), "zone": F.lit("zone"), "none": F.lit("nothing")}
    return cat_layers(spark, sf).filter("is_converted").select("id", *[t.native_of(mapping, v).alias(k) for k, v in names.items()])

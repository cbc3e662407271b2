"""Text and link expressions on columns. Everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Asset kinds by link suffix, first match wins.
MEDIA_BY_SUFFIX = [
    (".zarr", "zarr", "Zarr", "application/vnd+zarr", "data"),
    (".zarr/", "zarr", "Zarr", "application/vnd+zarr", "data"),
    (".nc", "netcdf", "NetCDF", "application/vnd+netcdf", "data"),
    (".zip", "zip", "Zip", "application/zip", "data"),
    (".tif", "geotiff", "GeoTIFF", "image/tiff; application=geotiff", "data"),
    (".tiff", "geotiff", "GeoTIFF", "image/tiff; application=geotiff", "data"),
    (".parquet", "parquet", "Parquet", "application/vnd+parquet", "data"),
    (".parquet/", "parquet", "Parquet", "application/vnd+parquet", "data"),
    (".geoparquet", "geoparquet", "GeoParquet", "application/vnd+parquet", "data"),
    (".geoparquet/", "geoparquet", "GeoParquet", "application/vnd+parquet", "data"),
    (".csv", "csv", "CSV", "text/csv", "data"),
    (".json", "json", "JSON", "application/json", "metadata"),
    (".html", "html", "HTML", "text/html", "metadata"),
    (".png", "png", "PNG", "image/png", "thumbnail"),
    (".jpg", "jpg", "JPEG", "image/jpeg", "thumbnail"),
]
# Asset kinds by a piece of the link, tried after the suffixes.
MEDIA_BY_PIECE = [
    ("wms?SERVICE=WMS&REQUEST=GetMap", "wms", "Web Map Service (WMS)", "OGC:WMS", "service"),
    ("xml", "xml", "XML", "application/xml", "metadata"),
    ("csw?request", "csw", "CSW", "application/csw", "metadata"),
]
# Links that lead to a downloadable product.
DOWNLOAD_SUFFIXES = [".zip", ".nc", ".parquet", ".csv", ".parquet/", ".geoparquet/"]
DOWNLOAD_PIECES = ["parquet/", "geoparquet/"]
# File types and link pieces the converters take.
CONVERTIBLE_SUFFIXES = [".nc", ".shp", ".gdb", ".tif", ".csv", ".parquet", ".zarr"]
CONVERTIBLE_PIECES = [".zarr/", ".parquet/"]
# File types looked for inside a package.
PACKAGED_SUFFIXES = [".shp", ".gdb", ".tif", ".csv", ".nc", ".parquet"]
# Texts that stand for "no category".
BLANK_CATEGORIES = [" ", "nan", ""]
# Characters that count as white space in names.
SPACES = (
    " \t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Schema links of the item extensions.
PROJECTION_EXTENSION = "https://stac-extensions.github.io/projection/v1.1.0/schema.json"
DATACUBE_EXTENSION = "https://stac-extensions.github.io/datacube/v1.0.0/schema.json"


def _quote(text: str) -> str:
    return "".join("\\" + ch if ch in r"\.[]{}()*+-?^$|&/" else ch for ch in text)


def slug(text: Column) -> Column:
    """Lower-case name made of letters, digits, ``_`` and ``.``.

    ``½`` and other number signs stay, combining marks go, and ``__`` is halved once only.
    """
    trimmed = F.replace(F.btrim(text, F.lit("." + SPACES)), F.lit("/"), F.lit("_"))
    joined = F.replace(F.regexp_replace(trimmed, r"(?U)[-\s\x1c-\x1f]+", "_"), F.lit("__"), F.lit("_"))
    kept = F.regexp_replace(joined, r"[^\p{L}\p{N}_.-]", "")
    squares = F.replace(kept, F.lit("²"), F.lit("_2"))
    return F.lower(F.replace(squares, F.lit("³"), F.lit("_3")))


def storage_key(lot: Column, layer_id: Column, name: Column) -> Column:
    return F.concat_ws("/", slug(lot), layer_id, name)


def collection_id(convention: Column, variable: Column) -> Column:
    return F.concat_ws("-", convention, slug(variable))


def record_links(record_id: Column, records: str, catalogue: str) -> Column:
    """The XML link of a metadata record below one address, and its CSW link below another."""
    return F.array(
        F.concat(F.lit(f"{records}/srv/api/records/"), record_id, F.lit("/formatters/xml")),
        F.concat(
            F.lit(f"{catalogue}/csw?request=GetRecordById&service=CSW&version=2.0.2&elementSetName=full&id="),
            record_id,
        ),
    )


def map_link(url: Column, layers: Column, version: Column, extent: Column, time: Column) -> Column:
    """WMS GetMap link; null for legend links. ``extent`` is an array of four texts."""
    link = F.concat(
        url, F.lit("?SERVICE=WMS&REQUEST=GetMap&LAYERS="), layers, F.lit("&VERSION="), version,
        F.lit("&CRS=CRS:84&BBOX="), F.concat_ws(",", extent),
        F.lit("&WIDTH=800&HEIGHT=600&FORMAT=image/png"),
    )
    timed = F.when(F.coalesce(time, F.lit("")) != "", F.concat(link, F.lit("&time="), time)).otherwise(link)
    return F.when(~F.contains(url, F.lit("GetLegendGraphic")), timed)


def kept_map_link(assets: Column) -> Column:
    """First WMS link among the assets of the previous state."""
    hits = F.filter(assets, lambda a: F.contains(a, F.lit("wms?SERVICE=WMS&REQUEST=GetMap&LAYER")))
    return F.try_element_at(hits, F.lit(1))


def open_store(url: Column) -> Column:
    """The link itself if it is a table or grid store that can be read in place."""
    return F.when(F.contains(url, F.lit("https://s3.")) & (is_grid_store(url) | is_table_store(url)), url)


def source_value(sources: Column, kind: str) -> Column:
    """Value of the last metadata source of a kind, '' if there is none."""
    hits = F.filter(sources, lambda s: s["metadata_type"] == kind)
    return F.coalesce(F.try_element_at(hits, F.lit(-1))["metadata_value"], F.lit(""))


def media_type(url: Column) -> Column:
    """Struct ``kind, title, media, role`` of a link, null if the kind is unknown."""
    def entry(row):
        return F.struct(*[F.lit(v).alias(n) for n, v in zip(("kind", "title", "media", "role"), row[1:])])

    out = F.lit(None)
    for row in reversed(MEDIA_BY_PIECE):
        out = F.when(F.contains(url, F.lit(row[0])), entry(row)).otherwise(out)
    for row in reversed(MEDIA_BY_SUFFIX):
        out = F.when(F.endswith(url, F.lit(row[0])), entry(row)).otherwise(out)
    return out


def is_download(url: Column, extra_pieces: tuple[str, ...] = ()) -> Column:
    ends = "|".join(_quote(s) for s in DOWNLOAD_SUFFIXES)
    pieces = "|".join(_quote(s) for s in [*DOWNLOAD_PIECES, *extra_pieces])
    return url.rlike(f"(?:{ends})\\z|{pieces}")


def first_download(url: Column, assets: Column, extra_pieces: tuple[str, ...] = ()) -> Column:
    """First usable link: the download link, then the assets in their order."""
    links = F.filter(F.concat(F.array(url), assets), lambda u: is_download(u, extra_pieces))
    return F.try_element_at(links, F.lit(1))


def is_grid_store(url: Column) -> Column:
    return url.rlike(r"\.zarr/?$")


def is_table_store(url: Column) -> Column:
    return url.rlike(r"\.(parquet|geoparquet)/?$")


def is_geo_candidate(url: Column) -> Column:
    return url.rlike(r"\.parquet/?$")


def is_packaged_product(path: Column) -> Column:
    return path.rlike(f"(?:{'|'.join(_quote(s) for s in PACKAGED_SUFFIXES)})\\z")


def is_convertible(path: Column) -> Column:
    """Whether a fetched product can be converted as it is (packages are opened first)."""
    ends = "|".join(_quote(s) for s in CONVERTIBLE_SUFFIXES)
    pieces = "|".join(_quote(s) for s in CONVERTIBLE_PIECES)
    return path.rlike(f"(?:{ends})\\z|{pieces}")


def disposition_name(header: Column) -> Column:
    """File name in a Content-Disposition header."""
    return F.nullif(F.regexp_extract(header, 'filename="(.+)"', 1), F.lit(""))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def wfs_layer(url: Column) -> Column:
    """Layer name in a WFS link, without its work space."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    raw = F.nullif(F.regexp_extract(query, r"(?:^|&)typeName=([^&]+)", 1), F.lit(""))
    return F.substring_index(F.coalesce(F.try_url_decode(raw), raw), ":", -1)


def link_name(url: Column) -> Column:
    """File name a link stands for; WFS shape exports are named after their layer."""
    base = F.substring_index(F.regexp_replace(url_path(url), r";[^/]*$", ""), "/", -1)
    shape = F.concat(F.coalesce(wfs_layer(url), F.lit("None")), F.lit(".zip"))
    return F.when(F.contains(url, F.lit("outputFormat=SHAPE-ZIP")), shape).otherwise(base)


def store_address(url: Column) -> Column:
    """``https://host/bucket/key`` as struct ``endpoint, uri`` with ``uri = s3://bucket/key``."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.struct(
        F.concat(F.lit("https://"), host).alias("endpoint"),
        F.concat(F.lit("s3://"), F.regexp_replace(url_path(url), "^/+", "")).alias("uri"),
    )


def split_product(product: Column) -> Column:
    """``X.gdb_L`` as struct ``product = X.gdb, layer = L``; other names have no layer."""
    parts = F.split(product, r"\.gdb_", 2)
    has_layer = F.contains(product, F.lit(".gdb_"))
    return F.struct(
        F.when(has_layer, F.concat(parts[0], F.lit(".gdb"))).otherwise(product).alias("product"),
        F.when(has_layer, F.try_element_at(parts, F.lit(2))).alias("layer"),
    )


def name_mapping(attributes: Column) -> Column:
    """Native variable -> standard name."""
    return F.transform_values(attributes, lambda k, v: slug(F.coalesce(v["name_custom"], k)))


def description_map(attributes: Column) -> Column:
    """Standard name -> description, blank descriptions left out, last one wins."""
    entries = F.transform(
        F.filter(F.map_entries(attributes), lambda e: F.coalesce(e["value"]["description"], F.lit("")) != ""),
        lambda e: F.struct(
            slug(F.coalesce(e["value"]["name_custom"], e["key"])).alias("key"),
            e["value"]["description"].alias("value"),
        ),
    )

    def is_last(e, i):
        later = F.slice(entries, i + 2, F.size(entries))
        return ~F.exists(later, lambda x: x["key"] == e["key"])

    return F.map_from_entries(F.filter(entries, is_last))


def native_of(mapping: Column, variable: Column) -> Column:
    """First native variable that maps to a standard name."""
    hits = F.map_keys(F.map_filter(mapping, lambda _k, v: v == variable))
    return F.try_element_at(hits, F.lit(1))


def clean_category(value: Column) -> Column:
    """Text category with every blank form as ``None`` (the word)."""
    return F.when(value.isNull() | value.isin(BLANK_CATEGORIES), F.lit("None")).otherwise(value)


def doi_of(link: Column) -> Column:
    """Last two path parts of a DOI link."""
    parts = F.split(link, "/")
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), "/")


def grid_names(dds: Column) -> Column:
    """Variables declared as GRID in a dataset descriptor."""
    return F.regexp_extract_all(dds, F.lit(r"(?s)GRID\s*\{.*?\} (\w+);"), 1)


def first_binary_link(html: Column) -> Column:
    """Link behind the first ``[BIN]`` picture of a directory page, null if there is none."""
    picture = r"(?s)<img\b(?=[^>]*\bclass=\"B\")(?=[^>]*\balt=\"\[BIN\]\")[^>]*>(.*)"
    next_cell = F.split_part(F.regexp_extract(html, picture, 1), F.lit("</td>"), F.lit(2))
    link = r"(?s)^\s*<td\b.*?<a\b[^>]*\bhref=\"([^\"]*)\""
    return F.nullif(F.regexp_extract(next_cell, link, 1), F.lit(""))


def title_words(title: Column) -> Column:
    """Struct ``theme`` (second word) and ``collection`` (first two words) of a title."""
    words = F.filter(F.split(title, r"\s+"), lambda w: w != "")
    return F.struct(
        F.try_element_at(words, F.lit(2)).alias("theme"),
        F.array_join(F.slice(words, 1, 2), " ").alias("collection"),
    )


def rewrite_links(links: Column, rel: str, href: Column) -> Column:
    """Keep the links of one relation and point them to ``href``."""
    kept = F.filter(links, lambda x: x["rel"] == rel)
    return F.transform(kept, lambda x: x.withField("href", href))


def number_text(value: Column) -> Column:
    """Double as text: plain digits from 1e-4 up to 1e16, at least one decimal; beyond that like 1e-05 and 1.5e+16."""
    plain = value.cast("string")
    size = F.abs(value)
    wide = F.regexp_replace(value.cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1")
    small = F.regexp_replace(
        F.regexp_replace(plain, r"^(-?)(\d)\.(\d+)E-4$", "$10.000$2$3"), r"^(-?0\.000\d+?)0+$", "$1"
    )
    power = F.regexp_extract(plain, r"E-?(\d+)$", 1)
    short = F.concat(
        F.regexp_replace(F.regexp_extract(plain, r"^(.*)E", 1), r"\.0$", ""), F.when(plain.contains("E-"), "e-").otherwise("e+"),
        F.when(F.length(power) < 2, F.lpad(power, 2, "0")).otherwise(power),
    )
    return (
        F.when(plain.contains("E") & ((size < 1e-4) | (size >= 1e16)), short)
        .when((size >= 1e7) & (size < 1e16), wide)
        .when((size >= 1e-4) & (size < 1e-3), small)
        .otherwise(plain)
    )


def item_title(item_id: Column) -> Column:
    spaced = F.translate(item_id, "_", " ")
    return F.concat(F.upper(F.substring(spaced, 1, 1)), F.lower(F.substr(spaced, F.lit(2))))


def extension_links(has_epsg: Column, asset_kinds: Column) -> Column:
    found = F.array(
        F.when(has_epsg, F.lit(PROJECTION_EXTENSION)),
        F.when(F.array_contains(asset_kinds, "zarr"), F.lit(DATACUBE_EXTENSION)),
    )
    return F.filter(found, lambda x: x.isNotNull())

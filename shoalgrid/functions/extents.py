"""Time and space extents, providers and item names as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoalgrid.functions.text import number_text, slug

# Date forms of a single date, tried in this order.
SINGLE_DATE_FORMS = [
    "yyyy-M-d", "d-M-yyyy", "M-d-yyyy",
    "yyyy/M/d", "d/M/yyyy", "M/d/yyyy",
    "yyyy.M.d", "d.M.yyyy",
    "yyyy-M", "yyyy/M", "MMMM yyyy", "MMM yyyy", "yyyy",
]
# Date forms of either end of a range, month before day where both read.
RANGE_DATE_FORMS = [
    "yyyy-M-d'T'HH:mm:ss", "yyyy-M-d HH:mm:ss", "yyyy-M-d",
    "yyyy/M/d", "M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy",
    "yyyy.M.d", "d.M.yyyy", "yyyy-M", "yyyy/M",
    "MMMM yyyy", "MMM yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyy",
]
# Forms of a record date after padding.
RECORD_DATE_FORMS = ["yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss"]
# The default licence and the world rectangle.
DEFAULT_RIGHTS = "CC-BY-4.0"
WORLD = (-180.0, -90.0, 180.0, 90.0)

STAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _shape(form: str) -> str:
    """Pattern of the texts a date form can read, so that others are not even tried."""
    pieces = re.findall(r"'[^']*'|y+|M+|d+|H+|m+|s+|X+|.", form)
    known = {"yyyy": r"\d{4}", "MMMM": "[A-Za-z]+", "MMM": "[A-Za-z]+", "XXX": r"(?:Z|[+-]\d\d:\d\d)"}
    digits = {"M": r"\d{1,2}", "d": r"\d{1,2}", "MM": r"\d\d", "dd": r"\d\d", "HH": r"\d\d", "mm": r"\d\d", "ss": r"\d\d"}
    return "^" + "".join({**known, **digits}.get(p) or re.escape(p.strip("'")) for p in pieces) + r"\z"


def _first_parse(text: Column, forms: list[str]) -> Column:
    return F.coalesce(*[F.when(text.rlike(_shape(f)), F.try_to_timestamp(text, F.lit(f))) for f in forms])


def time_pair(start: Column, end: Column) -> Column:
    return F.struct(start.cast("timestamp").alias("start"), end.cast("timestamp").alias("end"))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def single_date(text: Column) -> Column:
    """A text that is one date after 1900-01-01, else null."""
    earliest = F.lit("1900-01-01").cast("timestamp")
    found = _let(F.trim(text), lambda t: _first_parse(t, SINGLE_DATE_FORMS))
    return _let(found, lambda d: F.when(d > earliest, d))


def date_range(text: Column) -> Column:
    """Struct start, end of ``a SEP b``; SEP is the first of ``, / -`` that occurs exactly once."""
    separator = F.coalesce(*[
        F.when(F.regexp_count(text, F.lit(s)) == 1, F.lit(s)) for s in (",", "/", "-")
    ])

    def ends(halves):
        parsed = F.transform(halves, lambda h: _first_parse(F.trim(h), RANGE_DATE_FORMS))
        return _let(parsed, lambda p: F.when(p[0].isNotNull(), time_pair(p[0], p[1])))

    return _let(F.split(text, separator), ends)


def text_extent(text: Column) -> Column:
    """Extent in a date text: one date is an end without a start, otherwise a range."""
    return _let(
        single_date(text), lambda d: F.when(d.isNotNull(), time_pair(F.lit(None), d)).otherwise(date_range(text))
    )


def record_date(text: Column) -> Column:
    """Date of a metadata record: year, month or day padded, fraction dropped, in UTC."""
    padded = (
        F.when(F.length(text) == 4, F.concat(text, F.lit("-01-01T00:00:00")))
        .when(F.length(text) == 7, F.concat(text, F.lit("-01T00:00:00")))
        .when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00")))
        .otherwise(text)
    )
    return _let(F.split_part(padded, F.lit("."), F.lit(1)), lambda t: _first_parse(t, RECORD_DATE_FORMS))


def close_extent(extent: Column, run_year: int) -> Column:
    """Fill missing ends and put them in order."""
    first, last = (F.lit(v).cast("timestamp") for v in ("1900-01-01", f"{run_year:04d}-12-31 23:59:59"))

    def closed(pair):
        return time_pair(F.coalesce(pair["start"], first), F.coalesce(pair["end"], last))

    def ordered(pair):
        return time_pair(F.least(pair["start"], pair["end"]), F.greatest(pair["start"], pair["end"]))

    return _let(_let(extent, closed), ordered)


def time_cascade(candidates: list[Column], run_year: int) -> Column:
    """Take extents in the order given; a later one replaces both ends while one end is open.

    So the first extent with two ends counts, or else the last one there is.
    """
    def settle(found):
        whole = F.filter(found, lambda c: c["start"].isNotNull() & c["end"].isNotNull())
        partial = F.filter(found, lambda c: c.isNotNull())
        empty = time_pair(F.lit(None), F.lit(None))
        return F.coalesce(F.get(whole, F.lit(0)), F.try_element_at(partial, F.lit(-1)), empty)

    return close_extent(_let(F.array(*candidates), settle), run_year)


def stamp(time: Column) -> Column:
    return F.date_format(time, STAMP)


def day_start(time: Column) -> Column:
    return F.date_trunc("day", time)


def rectangle(west: Column, south: Column, east: Column, north: Column) -> Column:
    ends = zip(("west", "south", "east", "north"), (west, south, east, north))
    return F.struct(*[c.cast("double").alias(n) for n, c in ends])


def space_cascade(existing: Column, boxes: Column, grid: Column, record: Column) -> Column:
    """Extent from: four given numbers, first box, grid, record, world."""
    given = F.when(F.size(existing) == 4, rectangle(existing[0], existing[1], existing[2], existing[3]))
    box = F.try_element_at(boxes, F.lit(1))
    from_box = F.when(box.isNotNull(), rectangle(box["west"], box["south"], box["east"], box["north"]))
    return F.coalesce(given, from_box, grid, record, rectangle(*[F.lit(v) for v in WORLD]))


def provider(name: Column, role: Column) -> Column:
    return F.struct(name.alias("name"), role.alias("role"))


def provider_cascade(parties: Column, organisation: Column, lot: Column) -> Column:
    """Providers from the layer's parties, the record's organisation, or the lot."""
    one = F.array(provider(F.coalesce(organisation, lot), F.lit("provider")))
    return F.when(F.coalesce(F.size(parties), F.lit(0)) > 0, parties).otherwise(one)


def rights_cascade(parties: Column, constraints: Column) -> Column:
    """Licence text; the record's constraints count only for layers without parties."""
    has_parties = F.coalesce(F.size(parties), F.lit(0)) > 0
    return F.when(has_parties, F.lit(DEFAULT_RIGHTS)).otherwise(F.coalesce(constraints, F.lit(DEFAULT_RIGHTS)))


def item_providers(providers: Column, lot: Column) -> Column:
    """Providers with the lot appended unless one of their fields already names it."""
    named = F.exists(providers, lambda p: (p["name"] == lot) | (p["role"] == lot))
    field = lot.isin("name", "role") & (F.size(providers) > 0)
    return F.when(named | field, providers).otherwise(
        F.concat(providers, F.array(provider(lot, F.lit("provider"))))
    )


def box_text(extent: Column) -> Column:
    return F.concat_ws("_", *[number_text(extent[k]) for k in ("west", "south", "east", "north")])


def native_item_id(name: Column) -> Column:
    return slug(name)


def converted_item_id(variable: Column, start: Column, end: Column, extent: Column, described: Column) -> Column:
    """Item name of a converted variable; ``described`` is null unless the long form applies."""
    plain = F.concat_ws("_", variable, stamp(start), stamp(end), box_text(extent))
    clock = "yyyy-MM-dd HH:mm:ss'+00:00'"
    long = F.concat_ws(
        "_", variable, described, box_text(extent), F.date_format(start, clock), F.date_format(end, clock)
    )
    return F.when(described.isNotNull(), long).otherwise(plain)


def footprint(extent: Column) -> Column:
    """GeoJSON polygon of a rectangle: five points, closed."""
    w, s, e, n = (extent[k] for k in ("west", "south", "east", "north"))
    ring = F.array(F.array(w, s), F.array(w, n), F.array(e, n), F.array(e, s), F.array(w, s))
    return F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))

"""Values out of XML metadata records, by XPath expressions that run inside Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalgrid.functions.extents import record_date, rectangle, time_pair
from shoalgrid.functions.text import doi_of
from shoalgrid.operators.skew import deal_out

_MARK = "STRING_BROKEN"
_URI_SCHEMA = "struct<URI:array<struct<_VALUE:string,_protocol:string,_description:string>>>"


def _path(*names: str) -> str:
    """XPath that ignores name spaces: the first name anywhere, the others below it."""
    return "//" + "//".join(f"*[local-name()='{n}']" for n in names)


def well_formed(xml: Column) -> Column:
    """The text if it is well-formed XML, else null (XPath on broken text would end the job)."""
    probe = F.from_xml(
        xml,
        f"struct<{_MARK}:string>",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _MARK},
    )
    return F.when(probe.isNotNull() & probe[_MARK].isNull(), xml)


# A private-use character parts the values of one look into a record; it is blanked in the values.
_PART = "\ue000"


def _side(side: str, axis: str) -> str:
    return _path("EX_GeographicBoundingBox", f"{side}Bound{axis}", "Decimal")


_PERIOD = f"({_path('TimePeriod')})[1]"
_PATHS = {
    "west": _side("west", "Longitude"), "south": _side("south", "Latitude"),
    "east": _side("east", "Longitude"), "north": _side("north", "Latitude"),
    "period": f"name({_PERIOD})",
    "begin": _PERIOD + "/*[local-name()='beginPosition']", "end": _PERIOD + "/*[local-name()='endPosition']",
    "organisation": f"({_path('CI_ResponsibleParty')})[1]//*[local-name()='organisationName']/*[local-name()='CharacterString']",
    "constraints": _path("otherConstraints") + "/*[local-name()='CharacterString']",
}


def record_facts(records: DataFrame, xml: str) -> DataFrame:
    """Add box, period, organisation and constraints of each record; nulls for broken records.

    The values come out of two XPath expressions, so a record is not read once per value. Records are
    dealt out first, as reading one takes far longer than its bytes let expect.
    """
    def look(names):
        paths = [p if p.startswith("name(") else f"({p})[1]" for p in map(_PATHS.get, names)]
        joined = f", '{_PART}', ".join(f"translate({p}, '{_PART}', ' ')" for p in paths)
        return F.split(F.xpath_string("__xml", F.lit(f"concat({joined})")), _PART)

    names = list(_PATHS)
    found = deal_out(records).withColumn("__xml", well_formed(F.col(xml))).withColumn(
        "__v", F.concat(look(names[:4]), look(names[4:]))
    )
    v = {n: F.nullif(F.get("__v", F.lit(i)), F.lit("")) for i, n in enumerate(_PATHS)}
    sides = [F.trim(v[n]).try_cast("double") for n in ("west", "south", "east", "north")]
    period = time_pair(record_date(v["begin"]), record_date(v["end"]))
    return (
        found.withColumn("is_broken", F.col(xml).isNotNull() & F.col("__xml").isNull())
        .withColumn("box", F.when(sides[0].isNotNull(), rectangle(*sides)))
        .withColumn("period", F.when(v["period"].isNotNull(), period))
        .withColumn("organisation", v["organisation"])
        .withColumn("constraints", v["constraints"])
        .drop("__xml", "__v")
    )


def record_links(records: DataFrame, xml: str, layer_name: str, row_tag: str = "URI") -> DataFrame:
    """One row per link of a CSW record: one link per description, the last one wins.

    The place of a description is that of its first link, as in a name-keyed table.
    """
    wrapped = F.concat(
        F.lit("<links>"),
        F.array_join(
            F.regexp_extract_all(
                F.regexp_replace(
                    F.regexp_replace(F.col("__xml"), r"<(/?)[A-Za-z0-9]+:URI\b", "<$1URI"),
                    r'(<URI\b[^>]*?\s)[A-Za-z0-9]+:(?=[A-Za-z]+=)', "$1",
                ),
                F.lit(r"(?s)(<URI\b[^>]*?(?:/>|>.*?</URI>))"),
                1,
            ),
            "",
        ),
        F.lit("</links>"),
    )
    parsed = F.from_xml(wrapped, _URI_SCHEMA, {"ignoreNamespace": "true"})
    links = F.filter(parsed["URI"], lambda u: F.coalesce(u["_VALUE"], F.lit("")) != "")
    fallback = F.concat(F.col(layer_name), F.lit(" data product"))
    named = F.transform(
        links,
        lambda u, i: F.struct(
            F.coalesce(u["_description"], fallback).alias("description"),
            F.trim(u["_VALUE"]).alias("link"),
            F.coalesce(u["_protocol"], F.lit("HTTP")).alias("protocol"),
            i.alias("at"),
        ),
    )
    keys = [c for c in records.columns if c != xml]
    rows = deal_out(records).withColumn("__xml", well_formed(F.col(xml))).withColumn("__links", named)
    return (
        rows.select(*keys, F.explode("__links").alias("u"))
        .groupBy(*keys, F.col("u.description").alias("description"))
        .agg(
            F.max_by("u.link", "u.at").alias("link"),
            F.max_by("u.protocol", "u.at").alias("protocol"),
            F.min("u.at").alias("link_pos"),
        )
    )


def record_link_lists(links: DataFrame, key: str) -> DataFrame:
    """Links of each record in document order, and its DOI. A record's links all come from one document."""
    doi = F.max(F.when(F.col("description") == "Digital Object Identifier (DOI)", doi_of(F.col("link"))))
    ordered = F.array_sort(F.collect_list(F.struct("link_pos", "link")))
    return links.groupBy(key).agg(F.transform(ordered, lambda x: x["link"]).alias("csw_links"), doi.alias("doi"))

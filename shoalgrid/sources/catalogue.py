"""Layer trees, saved catalogues, vocabularies and other JSON documents as tables.

Documents come as one row each (``spark.read.text(path, wholetext=True)`` or a column of a table).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoalgrid.operators.skew import deal_by, sort_in_parts
from shoalgrid.session import scratch_path

# Fields of a vocabulary entry besides its convention.
NAME_FIELDS = ["standard_name", "description", "canonical_units", "amip", "grib", "aliases", "variable_family"]

LAYER_FIELDS = """id string, name string, defaultTitle string,
 metadataSources array<struct<metadata_type:string,metadata_value:string>>,
 temporalDatesExtent string"""


def _split(fields: str) -> list[str]:
    out, level, start = [], 0, 0
    for i, ch in enumerate(fields):
        level += (ch == "<") - (ch == ">")
        if ch == "," and level == 0:
            out.append(fields[start:i])
            start = i + 1
    return [f for f in [*out, fields[start:]] if f.strip()]


# Levels of a tree that are opened together; deeper ones follow in further rounds.
LEVELS = 4


def _node_type(fields: str, levels: int) -> str:
    """A node with ``levels`` levels below and including it as structs, and what is deeper as JSON text."""
    own = "displayName:string," + ", ".join(f.strip().replace(" ", ":", 1) for f in _split(fields))
    node = f"struct<{own},children:array<string>>"
    for _ in range(levels - 1):
        node = f"struct<{own},children:array<{node}>>"
    return node


def _open_nodes(nodes: Column, names: list[str], depth: int, levels: int, path: Column, sub: Column, subsub: Column) -> Column:
    """Leaves among some levels of nodes, and the nodes of the last level with their ``below``; in tree order."""
    def one(node: Column, at: Column) -> Column:
        own = F.coalesce(node["displayName"], F.lit(""))
        s, ss = (own if depth == 1 else sub), (own if depth == 2 else subsub)
        place, below = F.concat(path, F.array(at)), node["children"]

        def row(rest):
            return F.array(F.struct(
                place.alias("path"), s.alias("subtheme"), ss.alias("subsubtheme"), *[node[n].alias(n) for n in names], rest.alias("__below")))

        if levels == 1:
            return row(below)
        deeper = _open_nodes(below, names, depth + 1, levels - 1, place, s, ss)
        return F.when(below.isNull(), row(F.lit(None).cast("array<string>"))).otherwise(deeper)

    return F.flatten(F.transform(nodes, one))


def flatten_layer_tree(documents: DataFrame, json: str, doc_pos: str, leaf_fields: str = LAYER_FIELDS) -> DataFrame:
    """One row per layer of a tree of any depth, in tree order, with the names of its lot and first two levels.

    A layer right below its lot has its own name as subtheme; one level down, as subsubtheme.
    ``pos`` = document number and place in the document. Layers without id keep a null id; of layers of
    a document with the same id the last one counts, at the place of the first. The tree is opened some
    levels at a time, and what is left below becomes rows of their own, until nothing is left.
    """
    names = [f.strip().split(" ", 1)[0] for f in _split(leaf_fields)]
    node = _node_type(leaf_fields, LEVELS)
    trees = F.from_json(F.col(json), "struct<layerCatalog:struct<children:array<string>>>")["layerCatalog"]["children"]
    lots = documents.select(F.col(doc_pos).cast("long").alias("doc"), F.posexplode(trees).alias("at", "lot")).hint("rebalance")
    level = lots.select("doc", F.array("at").alias("path"), F.from_json("lot", f"struct<name:string,children:array<{node}>>").alias("lot")).select(
        "doc", "path", F.coalesce("lot.name", F.lit("")).alias("thematic_lot"), F.lit("").alias("subtheme"), F.lit("").alias("subsubtheme"),
        F.col("lot.children").alias("nodes"))
    depth, found = 1, []
    while True:
        opened = _open_nodes(F.col("nodes"), names, depth, LEVELS, F.col("path"), F.col("subtheme"), F.col("subsubtheme"))
        rows = _staged(level.select("doc", "thematic_lot", F.explode(opened).alias("x")).select("doc", "thematic_lot", "x.*"), f"tree-{depth}")
        found.append(rows.where("__below is null").drop("__below"))
        rest = rows.where("__below is not null")
        if rest.isEmpty():
            break
        nodes = F.from_json(F.concat(F.lit("["), F.array_join("__below", ","), F.lit("]")), f"array<{node}>")
        level = rest.select("doc", "path", "thematic_lot", "subtheme", "subsubtheme", nodes.alias("nodes"))
        depth += LEVELS
    leaves = _numbered(reduce(DataFrame.unionByName, found))
    # of equal ids the last one, at the place of the first
    places = deal_by(leaves.where("id is not null").select("doc", "id", "pos"), "doc", "id").groupBy("doc", "id").agg(F.min("pos").alias("first"), F.max("pos").alias("pos"))
    last = deal_by(leaves, "doc", "pos").join(deal_by(places.select("doc", "pos", "first"), "doc", "pos"), ["doc", "pos"], "left").where("id is null or first is not null")
    return last.select(F.coalesce("first", "pos").alias("pos"), "thematic_lot", "subtheme", "subsubtheme", *names)


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _numbered(leaves: DataFrame) -> DataFrame:
    """``pos`` from the place of ``path`` within its document: a global sort, then counts per sorted part."""
    ordered = _staged(sort_in_parts(leaves, "doc", "path").withColumn("row", F.monotonically_increasing_id()), "leaves")
    part, place = F.shiftright("row", 33), F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row per sorted part
    starts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("start"))
    ranked = ordered.withColumn("part", part).join(starts, "part").withColumn("rank", F.col("start") + place)
    heads = deal_by(ranked.select("doc", "rank"), "doc").groupBy("doc").agg(F.min("rank").alias("head"))
    return deal_by(ranked, "doc").join(heads, "doc").withColumn("pos", F.shiftleft("doc", 32) + F.col("rank") - F.col("head")).drop("path", "row", "part", "start", "rank", "head")


def with_id(layers: DataFrame) -> DataFrame:
    return layers.filter(F.col("id").isNotNull())


def without_id(layers: DataFrame) -> DataFrame:
    """The rejects of the tree: layers that carry no id."""
    return layers.filter(F.col("id").isNull())


def read_catalog(documents: DataFrame, json: str, doc_pos: str, fields: str = LAYER_FIELDS) -> DataFrame:
    """A saved catalogue in list form or in id-keyed form as the same table; ids become text."""
    entry = "struct<" + ", ".join(f.strip().replace(" ", ":", 1) for f in _split(fields)) + ">"
    is_list = F.col(json).rlike(r"^\s*\[")
    as_list = F.from_json(F.when(is_list, F.col(json)), f"array<{entry}>")
    keyed = F.map_entries(F.from_json(F.when(~is_list, F.col(json)), f"map<string,{entry}>"))
    as_keyed = F.transform(keyed, lambda e: e["value"].withField("id", e["key"]))
    return documents.select(doc_pos, F.posexplode(F.coalesce(as_list, as_keyed)).alias("__at", "layer")).select(
        (F.shiftleft(F.col(doc_pos).cast("long"), 32) + F.col("__at")).alias("pos"), "layer.*"
    )


def read_standard_names(documents: DataFrame, json: str, file: str) -> DataFrame:
    """Vocabulary files: convention (key without its ending), all fields of the entries, file."""
    item = "struct<" + ",".join(f"{f}:{'array<string>' if f == 'aliases' else 'string'}" for f in NAME_FIELDS) + ">"
    return documents.select(
        file, F.explode(F.from_json(F.col(json), f"map<string,array<{item}>>")).alias("key", "names")
    ).select(
        F.regexp_replace("key", "_standard_names", "").alias("convention"), F.explode("names").alias("n"), file
    ).select("convention", *[f"n.{f}" for f in NAME_FIELDS], file)


def harvest_index(documents: DataFrame, json: str) -> DataFrame:
    """Dataset index: named columns out of positional rows, without the row that lists all datasets."""
    rows = F.from_json(F.col(json), "struct<table:struct<rows:array<array<string>>>>")["table"]["rows"]
    # Places of the columns in an index row.
    places = {"url_index": 0, "url": 4, "directory": 5, "title": 6, "info_url": 10, "dataset": 15}
    return (
        documents.select(F.explode(rows).alias("r"))
        .select(*[F.get("r", F.lit(i)).alias(n) for n, i in places.items()])
        .filter(~F.col("dataset").eqNullSafe("allDatasets"))
    )


def info_rows(documents: DataFrame, json: str, dataset: str) -> DataFrame:
    """Attribute rows of a dataset description: dataset, pos, scope, attribute, value."""
    rows = F.from_json(F.col(json), "struct<table:struct<rows:array<array<string>>>>")["table"]["rows"]
    return documents.select(dataset, F.posexplode(rows).alias("pos", "r")).select(
        F.col(dataset).alias("dataset"), "pos",
        F.get("r", F.lit(1)).alias("scope"), F.get("r", F.lit(2)).alias("attribute"), F.get("r", F.lit(4)).alias("value"),
    )


def parse_feature_pages(pages: DataFrame, json: str) -> DataFrame:
    """Published features on all pages of a search: resto_id, product_id, collection."""
    feature = "struct<id:string,collection:string,properties:struct<productIdentifier:string>>"
    return pages.select(
        F.explode(F.from_json(F.col(json), f"struct<features:array<{feature}>>")["features"]).alias("f")
    ).select(
        F.col("f.id").alias("resto_id"), F.col("f.properties.productIdentifier").alias("product_id"), "f.collection"
    )

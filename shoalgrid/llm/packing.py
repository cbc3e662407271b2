"""Best-fit packing of documents into bins of fixed capacity, under conflicts.

A document takes its words plus one end mark. Documents longer than the capacity are cut into full
pieces and a rest; nothing is dropped. Two pieces in one bin may not come from the same source or from
the same duplicate cluster (by default: equal text). Bins are kept in order of their free space and
carry a bitmap of sources and one of clusters; an item goes to the first bin from its own size upwards
that shares no bit with it, so to the tightest compatible one, or opens a new bin. Large items go first.

Spark deals the pieces evenly, by a hash, to groups of about ``GROUP`` pieces, which are packed at the
same time; a hot source or cluster is spread over all of them. Only sizes and keys travel, not texts.
The number of groups grows with the number of pieces, so the memory of a group does not.

Defined cases: a null or empty text takes one place; a null source conflicts with nothing; rows with a
null or repeated id are pieces like any other; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoalgrid.llm.common import stage, text_of
from shoalgrid.llm.lines import WORD

CAPACITY = 2048
#: Pieces packed together, on average.
GROUP = 8192


def best_fit(items: list[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """(bin, start in the bin) of each item (size, source, cluster), in the order given; null keys conflict with nothing."""
    source_bit, cluster_bit = {}, {}
    seen = set()
    for _, _, cluster in items:  # a cluster needs a bit only if it comes up again
        if cluster in seen:
            cluster_bit.setdefault(cluster, 1 << len(cluster_bit))
        seen.add(cluster)
    cluster_bit.pop(None, None)
    free: list[tuple[int, int]] = []
    sources, clusters, filled, out = [], [], [], []
    for size, source, cluster in items:
        s = 0 if source is None else source_bit.setdefault(source, 1 << len(source_bit))
        c = cluster_bit.get(cluster, 0)
        at = bisect_left(free, (size, -1))
        while at < len(free):
            number = free[at][1]
            if not (sources[number] & s or clusters[number] & c):
                break
            at += 1
        if at < len(free):
            del free[at]
        else:
            number = len(filled)
            sources.append(0)
            clusters.append(0)
            filled.append(0)
        out.append((number, filled[number]))
        sources[number] |= s
        clusters[number] |= c
        filled[number] += size
        if filled[number] < capacity:
            insort(free, (capacity - filled[number], number))
    return out


def pieces(docs: DataFrame, capacity: int, id_column: str, text_column: str, source_column: str, cluster_column: str | None) -> DataFrame:
    """(doc_id, piece, start, size, source, cluster): each document in pieces of at most the capacity."""
    cluster = F.xxhash64(text_of(text_column)) if cluster_column is None else F.xxhash64(cluster_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).cast("string").alias("source"), cluster.alias("cluster"),
        (F.regexp_count(text_of(text_column), F.lit(WORD)) + 1).cast("long").alias("n"))
    cut = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / capacity))).alias("piece"))
    start = F.col("piece") * capacity
    return cut.select("doc_id", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(capacity)).alias("size"), "source", "cluster")


def pack(docs: DataFrame, capacity: int = CAPACITY, group: int = GROUP, id_column: str = "doc_id", text_column: str = "text",
         source_column: str = "source", cluster_column: str | None = None) -> DataFrame:
    """(doc_id, piece, start, size, source, cluster, bin, bin_start): where each piece of each document goes."""
    items = stage(pieces(docs, capacity, id_column, text_column, source_column, cluster_column), "pieces")
    groups = -(-items.count() // group) or 1
    # pieces of one document and equal rows are dealt to different groups as it falls, each by its own number
    dealt = items.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    names = items.columns

    def step(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("cluster", "ascending")])
        part = table.column("part")[0].as_py()
        placed = best_fit(list(zip(*(table.column(c).to_pylist() for c in ("size", "source", "cluster")))), capacity)
        return pa.table({
            **{c: table.column(c) for c in names},
            "bin": pa.array([(part << 24) + b for b, _ in placed], pa.int64()), "bin_start": pa.array([s for _, s in placed], pa.int64())})

    schema = T.StructType([*items.schema.fields, T.StructField("bin", T.LongType()), T.StructField("bin_start", T.LongType())])
    return dealt.groupBy("part").applyInArrow(step, schema)

"""Approximate nearest neighbours by largest inner product, with cross-polytope hashing.

A fast pseudo-rotation (three rounds of random signs and a Hadamard transform) turns each vector; the
signed axis nearest to it is its bucket, one bucket per table. For inner products all vectors are first
scaled to norm 1 or less and given one more coordinate that fills them up to a unit vector, so that the
nearest unit vector has the largest inner product; with unit vectors that coordinate is zero. A query
looks into its best buckets over all tables (multiprobe): ``probes`` per table on average, and on until
the buckets hold ``least`` vectors per table. Candidates are ranked by exact inner products.

Equal vectors are put together first: a class keeps its ``k + 1`` least ids, as no other can be among
the nearest of a query. Buckets are cut into pieces of about ``PIECE`` classes and queries into blocks of
about ``BLOCK``, so one bucket with many members, or one vector with many copies, is spread over tasks;
each block is a matrix product and passes on the best few per query.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do those of another
dimension than most (ties: the smaller one) and rows without an id. Rows with equal id and vector are
one row. Fewer than ``k`` others: all that were found. An empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoalgrid.llm.common import map_arrow, stage
from shoalgrid.operators.skew import lookup

TABLES = 16
PROBES = 8
LEAST = 1000
PIECE = 4096
BLOCK = 1024
SEED = 5
#: Kept per query and block beyond k, so that rounding in the matrix product decides nothing.
_SPARE = 5


def rotations(dimension: int, tables: int, seed: int = SEED) -> np.ndarray:
    """Signs of the three rounds of each table; the dimension is filled up to a power of two."""
    width = 1 << max(dimension - 1, 0).bit_length()
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), (tables, 3, width))


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotate(vectors: np.ndarray, signs: np.ndarray) -> np.ndarray:
    x = np.zeros((len(vectors), signs.shape[1]))
    x[:, : vectors.shape[1]] = vectors
    for s in signs:
        x = _hadamard(x * s)
    return x


def unit(vectors: np.ndarray, norm: float, query: bool) -> np.ndarray:
    """Unit vectors with one more coordinate: for queries zero, for others what is missing to ``norm``."""
    if query:
        return np.c_[vectors / np.linalg.norm(vectors, axis=1, keepdims=True), np.zeros(len(vectors))]
    scaled = vectors / norm
    return np.c_[scaled, np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))]


def _matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    return np.asarray(pa.compute.list_flatten(column), dtype=np.float64).reshape(-1, dimension)


def _buckets(dimension: int, signs: np.ndarray, norm: float) -> Callable:
    """(slot, cid) of each class: its bucket in each table."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, cid = unit(_matrix(batch.column("v"), dimension), norm, False), np.asarray(batch.column("cid"))
            slots = []
            for t, s in enumerate(signs):
                turned = rotate(vectors, s)
                axis = np.abs(turned).argmax(axis=1)
                slots.append(2 * (t * s.shape[1] + axis) + (turned[np.arange(len(axis)), axis] < 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(slots).astype(np.int64)), pa.array(np.tile(cid, len(signs)))], names=["slot", "cid"])

    return step


def _probes(dimension: int, signs: np.ndarray, sizes: np.ndarray, probes: int, least: int) -> Callable:
    """(slot, cid) of each query: the buckets it looks into, best first over all tables."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, cid = unit(_matrix(batch.column("v"), dimension), 1.0, True), np.asarray(batch.column("cid"))
            for first in range(0, len(cid), 512):
                own = vectors[first: first + 512]
                turned = [rotate(own, s) for s in signs]
                nearness = np.concatenate([np.stack([x, -x], axis=2).reshape(len(own), -1) for x in turned], axis=1)
                order = np.argsort(-nearness, axis=1, kind="stable")
                held = np.cumsum(sizes[order], axis=1)
                count = np.maximum(probes * len(signs), (held < least * len(signs)).sum(axis=1) + 1)
                taken = np.arange(order.shape[1])[None, :] < count[:, None]
                taken &= sizes[order] > 0
                row, place = np.nonzero(taken)
                yield pa.RecordBatch.from_arrays([pa.array(order[row, place].astype(np.int64)), pa.array(cid[first: first + 512][row])], names=["slot", "cid"])

    return step


def _nearest(dimension: int, k: int) -> Callable:
    """Of one piece of a bucket and one block of queries: the best classes of each query by exact inner product."""
    def step(queries: pa.Table, classes: pa.Table) -> pa.Table:
        empty = pa.table({"qid": pa.array([], pa.int64()), "cid": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not len(queries) or not len(classes):
            return empty
        q, c = _matrix(queries.column("v"), dimension), _matrix(classes.column("v"), dimension)
        low = np.asarray(classes.column("low"))
        keep = min(k + 1 + _SPARE, len(c))
        scores = q @ c.T
        by_id = np.argsort(low, kind="stable")  # ties go to the smaller id
        best = by_id[np.argsort(-scores[:, by_id], axis=1, kind="stable")[:, :keep]]
        row = np.repeat(np.arange(len(q)), keep)
        exact = (q[row] * c[best.ravel()]).sum(axis=1)  # the same sum whatever the block
        return pa.table({
            "qid": pa.array(np.asarray(queries.column("cid"))[row]), "cid": pa.array(np.asarray(classes.column("cid"))[best.ravel()]), "score": pa.array(exact)})

    return step


def usable(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Distinct (vec_id, v) that take part, ``v`` an array of doubles."""
    v = F.transform(vector_column, lambda x: x.cast("double"))
    good = rows.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull()).select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return good.where(finite & F.exists("v", lambda x: x != 0)).distinct()


def neighbours(rows: DataFrame, every: int = 20, k: int = 20, tables: int = TABLES, probes: int = PROBES, least: int = LEAST,
               id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row whose id is divisible by ``every``."""
    members = stage(usable(rows, id_column, vector_column), "vectors")
    sizes = members.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    dimension = sizes["d"] if sizes else 1
    members = members.where(F.size("v") == dimension)
    # the least ids of each class; the window keeps k + 1 rows a class in every task before the shuffle
    ranked = members.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    classes = ranked.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = stage(classes.select(F.monotonically_increasing_id().alias("cid"), "v", "ids", F.col("ids")[0].alias("low")), "classes")
    asked = lookup(members.where(F.col("vec_id") % every == 0), classes.select("v", "cid"), ["v"], "inner").select("vec_id", F.col("cid").alias("qid"))
    asked = stage(asked, "asked")
    asking = asked.select(F.col("qid").alias("cid")).distinct()
    query_vectors = stage(classes.join(asking, "cid").select("cid", "v"), "queries")
    norm = classes.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda t, x: t + x * x)))).first()[0] or 1.0

    signs = rotations(dimension + 1, tables)
    homes = stage(map_arrow(classes.select("cid", "v"), _buckets(dimension, signs, norm), "slot long, cid long"), "homes")
    fill = homes.groupBy("slot").agg(F.count("*").alias("n"))
    held = np.zeros(2 * tables * signs.shape[2], dtype=np.int64)
    for slot, n in fill.collect():  # one row per bucket: twice the dimension in each table
        held[slot] = n
    looks = stage(map_arrow(query_vectors, _probes(dimension, signs, held, probes, least), "slot long, cid long"), "looks")
    # pieces of a bucket meet blocks of its queries
    cuts = fill.join(looks.groupBy("slot").agg(F.count("*").alias("m")), "slot").select(
        "slot", F.ceil(F.col("n") / PIECE).alias("pieces"), F.ceil(F.col("m") / BLOCK).alias("blocks"))
    cuts = stage(cuts, "cuts")
    spread = lambda at, mine, others: [F.pmod(F.xxhash64("cid", F.lit(3)), mine).alias(at), F.explode(F.sequence(F.lit(0).cast("long"), others - 1))]
    piece, block = spread("piece", F.col("pieces"), F.col("blocks"))
    right = lookup(homes, cuts, ["slot"], "inner").select("slot", "cid", piece, block.alias("block"))
    block, piece = spread("block", F.col("blocks"), F.col("pieces"))
    left = lookup(looks, cuts, ["slot"], "inner").select("slot", "cid", block, piece.alias("piece"))
    right = lookup(right, classes.select("cid", "v", "low"), ["cid"], "inner").select("slot", "piece", "block", "cid", "v", "low")
    left = lookup(left, query_vectors, ["cid"], "inner").select("slot", "piece", "block", "cid", "v")
    keys = ["slot", "piece", "block"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_nearest(dimension, k), "qid long, cid long, score double")

    best = pairs.groupBy("qid", "cid").agg(F.max("score").alias("score"))
    best = lookup(best, classes.select("cid", "low", "ids"), ["cid"], "inner")
    first = best.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "low"))).where(F.col("r") <= k + 1)
    ids = first.select("qid", "score", F.explode("ids").alias("vec_id"))
    top = ids.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
    lists = top.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found"))
    own = lookup(asked, lists, ["qid"], "inner")
    out = own.withColumnRenamed("vec_id", "query_id")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return out.select("query_id", F.posexplode(others).alias("p", "x")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")

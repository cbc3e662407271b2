"""SimHash near-duplicates: fingerprints that share an anchor of a covering code are compared.

The anchors are the words of the Hamming code on bits 0 to 62: every 63-bit string is within radius 1
of one of them. Two fingerprints at most ``max_bits`` apart have a point between them that is within
half of ``max_bits`` (rounded up) of both, and the anchor of that point is within radius 1 of it. So it
is enough to copy each fingerprint to every anchor within 1 + ceil(max_bits / 2): every pair meets at
one. (With one-sided copies the reach is 1 + max_bits: about 650 anchors a fingerprint for two bits,
not 32, for the same pairs.) The top bit is not in the code; it only counts when pairs are compared.

A group at one anchor holds distinct fingerprints within the reach, so its size is bounded by the code
(4,034 for two bits), not by the data. Within it links are found by breadth-first search, which gives
one link per member instead of all pairs.

Defined cases: a null or empty text has fingerprint zero, which links like any other; rows with equal
fingerprints are one class before any comparison; rows with a null id get the component of their
fingerprint, but never name it unless all ids in it are null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoalgrid.llm.common import chunks, digest_of, map_arrow, stage, text_of, texts_of
from shoalgrid.llm.graph import components
from shoalgrid.operators.skew import lookup

SEED = 42
CODE_BITS = 63
RADIUS = 1


def fingerprint(text: bytes, words: int = 3) -> int:
    """64 bits; each is set if it is set in over half of the hashes of the word shingles."""
    found = text.lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) < words:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    else:
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[words - 1:].tolist())], dtype=np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_bits = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, sha, fp) of every row; ``fp`` is the fingerprint as a signed long."""
    rows = docs.select(F.col(id_column).alias("doc_id"), digest_of(text_of(text_column)).alias("sha"), text_of(text_column).alias("text"))
    kinds = T.StructType([*rows.schema.fields[:2], T.StructField("fp", T.LongType())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = np.array([fingerprint(t, words) for t in texts_of(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["doc_id", "sha", "fp"])

    return map_arrow(rows, step, kinds)


def anchor_masks(reach: int) -> list[np.ndarray]:
    """By syndrome: the bit patterns of weight up to ``reach`` that lead to a word of the Hamming code."""
    found: list[list[int]] = [[] for _ in range(CODE_BITS + 1)]
    for weight in range(reach + 1):
        for places in combinations(range(CODE_BITS), weight):
            syndrome = mask = 0
            for p in places:
                syndrome ^= p + 1
                mask |= 1 << p
            found[syndrome].append(mask)
    return [np.array(x, dtype=np.uint64) for x in found]


def syndromes(prints: np.ndarray) -> np.ndarray:
    """XOR of the numbers (from 1) of the set bits among the 63 bits of the code."""
    out = np.zeros(len(prints), dtype=np.int64)
    for p in range(CODE_BITS):
        out ^= np.where((prints >> np.uint64(p)) & np.uint64(1), p + 1, 0)
    return out


def _to_anchors(reach: int) -> Callable:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = anchor_masks(reach)
        for batch in batches:
            prints = np.asarray(batch.column("fp")).view(np.uint64)
            syndrome = syndromes(prints)
            for s in np.unique(syndrome).tolist():
                own = prints[syndrome == s]
                anchors = ((own & np.uint64((1 << CODE_BITS) - 1))[:, None] ^ masks[s][None, :]).ravel()
                for a in range(0, len(anchors), 1 << 18):
                    b = min(a + (1 << 18), len(anchors))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchors[a:b].view(np.int64)), pa.array(np.repeat(own, len(masks[s]))[a:b].view(np.int64))], names=["anchor", "fp"])

    return step


def group_links(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a search over one group; they join exactly what its links of ``max_bits`` or fewer join."""
    links, rest = [], np.arange(len(prints))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(prints[rest] ^ prints[at]) <= max_bits
            for other in rest[near].tolist():
                links.append((at, other))
                queue.append(other)
            rest = rest[~near]
    return links


def _to_links(max_bits: int) -> Callable:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.asarray(batch.column("fps").offsets) - np.asarray(batch.column("fps").offsets)[0]
            every = np.asarray(batch.column("fps").flatten()).view(np.uint64)
            a, b = [], []
            for x, y in zip(ends.tolist(), ends[1:].tolist()):
                own = every[x:y]
                for i, j in group_links(own, max_bits):
                    a.append(own[i])
                    b.append(own[j])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (a, b)], names=["a", "b"])

    return step


def linked_prints(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``; they join what all close pairs join."""
    reach = RADIUS + (max_bits + 1) // 2
    at = map_arrow(prints.select("fp"), _to_anchors(reach), "anchor long, fp long")
    groups = at.groupBy("anchor").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")
    return map_arrow(groups, _to_links(max_bits), "a long, b long").distinct()


def _with_components(rows: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Staged rows and (fp, root): the class of fingerprints reachable from each other."""
    rows = stage(rows, "fingerprints")
    prints = stage(rows.select("fp").distinct(), "prints")
    found = components(linked_prints(prints, max_bits))
    return rows, prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per input row; the component is named by its least id."""
    rows, classes = _with_components(fingerprints(docs, words, id_column, text_column), max_bits)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = classes.join(least, "fp")
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    of = lookup(classes, named, ["root"]).select("fp", "component_id")
    return lookup(rows, of, ["fp"]).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows of ``docs``, one per group of near-duplicates: the least id (nulls last), then the least digest of the text."""
    rows, classes = _with_components(fingerprints(docs, words, id_column, text_column), max_bits)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha")
    first = rows.groupBy("fp").agg(F.min(rank).alias("first"))
    best = classes.join(first, "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.sha")
    best = best.select(F.struct("doc_id", "sha").alias("__kept"))
    copies = rows.groupBy(F.struct("doc_id", "sha").alias("__kept")).agg((F.count("*") > 1).alias("__copies"))
    best = stage(best.join(copies, "__kept"), "kept")  # one row per group, told if its row is repeated
    key = F.struct(F.col(id_column).alias("doc_id"), digest_of(text_of(text_column)).alias("sha"))
    kept = docs.withColumn("__kept", key).join(best, "__kept")
    single, repeated = kept.where(~F.col("__copies")), kept.where("__copies").dropDuplicates(["__kept"])
    return single.unionByName(repeated).drop("__kept", "__copies")

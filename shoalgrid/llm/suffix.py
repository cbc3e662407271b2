"""Removal of byte strings that occur more than once, by window-minimum anchors with hashed prefixes.

This stands in place of distributed prefix doubling: each round hashes raw prefixes, no ranks are paired
at offsets and nothing is sorted. The cost of prefix doubling over all positions is not measured.

A full suffix array holds one row per byte. Here only *anchors* get a row: positions that a rule on
the bytes around them picks, so equal strings have equal anchors. A position ``p`` belongs to the
first least 8-byte hash in its window of ``w`` positions. All positions of one anchor form a run, and
two equal strings of ``length`` bytes start at the same distance before anchors whose next
``length - w + 1`` bytes are equal. So anchors are ranked by that prefix; what is unique drops out.
What is left is ranked again over longer prefixes, with ``w`` going down to 1, where the prefix is the
whole string and the answer exact:

* the rank of an anchor is unique: none of its strings repeats, the anchor drops out;
* the whole stretch of bytes under its run is found twice: all its strings repeat;
* else its run goes on to the next, longer prefix.

Ranks are names of prefixes (two 64-bit hashes, 128 bits in all), not places in a sorted list: only
equality counts here. Copies of a whole text are put together first and carry a weight of two.

Defined cases: a null text is empty; a null or repeated ``doc_id`` gives one row per input row; texts
shorter than ``length`` keep all bytes; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalgrid.llm.common import chunks, digest_of, map_arrow, stage, text_of, texts_of
from shoalgrid.operators.skew import lookup
from shoalgrid.session import scratch_path

#: Window of each round; the prefix that is ranked has ``length - window + 1`` bytes.
WINDOWS = (256, 64, 16, 1)
GRAM = 8
#: Starts of strings handled at once, so that positions fit the low bits of the window minimum.
STRETCH = 1 << 22
_LOW = np.uint64((1 << 24) - 1)

ANCHORS = "hm long, t long, key binary, lo long, hi long, w int"


def _gram_hashes(data: bytes, count: int) -> np.ndarray:
    """A mixed hash of the 8 bytes from each of ``count`` positions."""
    out = np.empty(count, dtype=np.uint64)
    for j in range(min(GRAM, count)):
        words = (len(data) - j) // 8
        here = np.frombuffer(data, dtype="<u8", count=words, offset=j)
        part = out[j::GRAM]
        part[:] = here[: len(part)]
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def anchor_runs(data: bytes, starts: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last start of each run, for the starts ``0 .. starts - 1`` of ``data``."""
    if window == 1:
        place = np.arange(starts)
        return place, place, place
    least = (_gram_hashes(data, starts + window - 1) & ~_LOW) | np.arange(starts + window - 1, dtype=np.uint64)
    step = 1
    while step < window:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    anchor = (least & _LOW).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    return anchor[first], first, np.r_[first[1:], starts] - 1


def _anchor_batches(length: int, window: int) -> Callable:
    """Arrow step: (key, text, w, ranges of starts) to anchors with the names of prefix and stretch."""
    prefix = length - window + 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[list] = [[] for _ in range(6)]

        def flush():
            hm, t, key, lo, hi, w = names
            batch = pa.RecordBatch.from_arrays([
                pa.array(np.array(hm, dtype=np.uint64).view(np.int64)), pa.array(np.array(t, dtype=np.uint64).view(np.int64)),
                pa.array(key, pa.binary()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(w, pa.int32()),
            ], names=["hm", "t", "key", "lo", "hi", "w"])
            for x in names:
                x.clear()
            return batch

        for batch in chunks(batches, "text"):
            keys, ranges = batch.column("key").to_pylist(), batch.column("ranges").to_pylist()
            for key, text, own in zip(keys, texts_of(batch.column("text")), ranges):
                for r in own:
                    for begin in range(r["lo"], r["hi"] + 1, STRETCH):
                        starts = min(STRETCH, r["hi"] + 1 - begin)
                        data = text[begin: begin + starts - 1 + length]
                        anchor, first, last = anchor_runs(data, starts, window)
                        for a, p, q in zip(anchor.tolist(), first.tolist(), last.tolist()):
                            names[0].append(xxhash.xxh64_intdigest(data[a: a + prefix]))
                            names[1].append(xxhash.xxh64_intdigest(data[p: q + length], 1 + ((a - p) << 16) + (q - p)))
                        n = len(anchor)
                        names[2] += [key] * n
                        names[3] += (first + begin).tolist()
                        names[4] += (last + begin).tolist()
                        names[5] += [r["w"]] * n
                        if len(names[0]) >= 50_000:
                            yield flush()
            if names[0]:
                yield flush()

    return rows


def _distinct_texts(docs: DataFrame, text_column: str) -> tuple[DataFrame, str]:
    """One row per text (key, sha, text, copies) and the name of its table, in buckets by key: joins on it move no text."""
    spark = docs.sparkSession
    text = text_of(text_column)
    sha = digest_of(text)
    rows = docs.select(F.unhex(F.substring(sha, 1, 32)).alias("key"), sha.alias("sha"), text.alias("text"))
    once = rows.groupBy("key").agg(F.first("sha").alias("sha"), F.first("text").alias("text"), F.count("*").alias("copies"))
    name = f"texts_{uuid.uuid4().hex}"
    # as many buckets as shuffle partitions: each task of the grouping writes whole buckets
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    once.write.bucketBy(buckets, "key").option("path", scratch_path(spark, name)).saveAsTable(name)
    return spark.table(name), name


def repeated_spans(texts: DataFrame, length: int) -> DataFrame:
    """(key, a, b) of stretches of repeated strings in texts of which there is one copy."""
    whole = F.array(F.struct(F.lit(0).cast("long").alias("lo"), (F.octet_length("text") - length).cast("long").alias("hi"),
                             F.when(F.col("copies") > 1, 2).otherwise(1).alias("w")))
    todo = texts.where(F.octet_length("text") >= length).select("key", "text", whole.alias("ranges"))
    found = None
    windows = [w for w in WINDOWS if w == 1 or w + GRAM - 1 <= length]
    for window in windows:
        anchors = stage(map_arrow(todo, _anchor_batches(length, window), ANCHORS), f"anchors-{window}")
        ranks = anchors.groupBy("hm").agg(F.sum("w").alias("n"), (F.min("t") != F.max("t")).alias("several")).where("n > 1").drop("n")
        live = stage(lookup(anchors, ranks, ["hm"], "inner"), f"live-{window}")
        classes = live.groupBy("hm", "t").agg(
            F.sum("w").alias("n"), F.min(F.struct("key", "lo", "hi")).alias("first"), F.first("several").alias("several"),
        )
        twice = lookup(live.where("w = 1"), classes.where("n > 1").select("hm", "t"), ["hm", "t"], "inner")
        spans = twice.select("key", F.col("lo").alias("a"), (F.col("hi") + length).alias("b"))
        found = spans if found is None else found.unionByName(spans)
        if window > 1:
            rest = classes.where("several").select("first.*", F.when(F.col("n") > 1, 2).otherwise(1).alias("w"))
            ranges = rest.groupBy("key").agg(F.collect_list(F.struct("lo", "hi", "w")).alias("ranges"))
            todo = texts.select("key", "text").join(ranges, "key").select("key", "text", "ranges")
    return found


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        out = []
        for key, text, spans in zip(batch.column("key").to_pylist(), texts_of(batch.column("text")), batch.column("spans").to_pylist()):
            kept, removed, runs, end = hashlib.sha256(), 0, 0, -1
            for a, b in sorted((s["a"], s["b"]) for s in spans):
                if a > end:
                    kept.update(text[max(end, 0): a])
                    runs += 1
                    removed += b - a
                    end = b
                elif b > end:
                    removed += b - end
                    end = b
            kept.update(text[max(end, 0):])
            out.append((key, removed, runs, kept.hexdigest()))
        key, removed, runs, sha = zip(*out)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.binary()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string())],
            names=["key", "n_removed", "n_spans", "kept_sha256"])


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The bytes outside the spans, in order."""
    out, end = [], 0
    for a, b in sorted(spans):
        if a > end:
            out.append(text[end:a])
        end = max(end, b)
    return b"".join([*out, text[end:]])


def remove_repeats(docs: DataFrame, length: int = 400, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per input row: id, bytes, bytes and runs removed, SHA-256 of what is left, and the removed runs.

    A byte goes if a string of ``length`` bytes over it also starts anywhere else.
    """
    texts, name = _distinct_texts(docs, text_column)
    spans = stage(repeated_spans(texts, length), "spans")
    own = spans.groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    cut = map_arrow(
        texts.select("key", "text").join(own, "key").select("key", "text", "spans"), _cut, "key binary, n_removed long, n_spans long, kept_sha256 string")
    copied = texts.where((F.col("copies") > 1) & (F.octet_length("text") >= length)).select(
        "key", F.octet_length("text").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(hashlib.sha256().hexdigest()).alias("kept_sha256"))
    changed = stage(cut.unionByName(copied), "removed")
    docs.sparkSession.sql(f"DROP TABLE {name}")  # its files are staged ones
    text = text_of(text_column)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), digest_of(text).alias("sha"))
    rows = rows.withColumn("key", F.unhex(F.substring("sha", 1, 32)))
    zero = F.lit(0).cast("long")
    return lookup(rows, changed, ["key"]).select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"))

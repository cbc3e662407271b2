"""Exact Jaccard join of word 5-shingle sets as a metric-space join: pivots, Voronoi regions, windows.

Jaccard distance ``d = 1 - |A n B| / |A u B|`` is a metric, and two documents link when ``d <= 0.2``
(``100 * |A n B| >= 80 * |A u B|``). A region picks pivots among its members; each member's home is its
nearest pivot (ties: the smaller pivot). By the triangle inequality, if ``x`` and ``y`` link and ``y``'s
home is ``p``, then ``d(x, p) <= d(x, q) + 2 * 0.2`` for ``x``'s own home ``q``; so every member is copied
into each region within that window of its home, and a link is found in the home region of either end.
A copy also needs ``d(x, p) <= r + 0.2``, where ``r`` is the largest distance of a member at home by
``p`` (its radius), again by the triangle inequality; so members far from all pivots go only to regions
as wide, and a region without members at home takes no copies.
Regions larger than ``LEAF`` are split again the same way (up to ``LEVELS`` times), with the home flag
carried down, so a pair is only looked for where its home end lives. A member within 0.2 of a pivot
links with the pivot itself (a document too): such links are emitted, and two members in the same
pivot's ball need no test, as they already share a component. A pivot within the window (0.4) of a lesser
one is dropped, so a large group of near copies has few pivots and is not copied into the region of each. In the leaves, whatever their size, pairs of one
region meet at a shingle among the ``n - ceil(0.8 n) + 1`` first of both, with the region's rarest
shingles first (the prefix lemma holds in any order that both share), and are tested exactly by their set
intersection. Only components are asked for, so a large group of near copies need not meet in pairs: in
``ROUNDS`` rounds each member is tested against at most ``REPS`` others, each drawn for one shingle from all
that hold it, and members found connected get one label; shingles whose holders have one label drop out.
Whatever pairs of two labels are left meet after that, so no link between components is lost: with ``i``
shared shingles needed, at places up to ``n - i + 1`` of both, and with bitmaps (parities of ``BITS``
classes of shingles) that differ in no more bits than the sets may in shingles.

Exact steps come first, each in linear work: equal sets are one node, named by a hash of the set
(its documents are linked); a set of ``n`` shingles that links with another shares ``ceil(0.8 n)`` of
them with it, so one with more than ``n - ceil(0.8 n)`` shingles that no other set holds links with
nothing. This is first counted on the shingles whose hash lies in the lowest ``SLICE`` of the hash range
(the same part of every set, so a shared shingle is in the slices of both, and no link is lost); only
slices are staged, and the whole sets of the remaining candidates are made again from one document of
each. Among these, the rule is counted on all shingles, and in the order of the hashes two sets with
``J >= 0.8`` share a shingle among the first ``n - ceil(0.8 n) + 1`` of each. Pivots are chosen among sets of
at most ``PIVOT_MAX`` shingles by a hash, about ``PIVOTS`` per region, so the pivot table is bounded.

Shingles are the distinct space-joined 5-word runs of lower-cased (A-Z only) words ``[^\\x20\\x09-\\x0D]+``,
held as XXH64 values (a collision of two distinct shingles is taken as equality). Fewer than five
words: the whole sequence is one shingle. No words (null or empty text): an empty set, linked with
nothing, its own component. Rows with a null doc_id get a null component and link with nothing.
Repeated rows are documents of their own each (equal sets, so linked); rows of one doc_id with other
texts are judged each on its own text. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoalgrid.llm import graph
from shoalgrid.llm.common import chunks, map_arrow, stage, text_of, texts_of
from shoalgrid.operators.skew import lookup
from shoalgrid.session import scratch_path

WORDS = 5
#: A link needs ``100 * |A n B| >= SIMILARITY * |A u B|``.
SIMILARITY = 80
LEAF = 512
LEVELS = 1
PIVOTS = 64
PIVOT_MAX = 4096
#: Part of the hash range, from its low end, that the first rule counts on. More leaves fewer candidates, and more rows to count.
SLICE = 0.3
#: Window of the triangle inequality, 2 * (1 - 0.8), with room for rounding (it only adds copies).
WINDOW = 0.4 + 1e-9
#: Distance of a link, with the same room: a pivot's region takes members within its radius plus this.
REACH = 0.2 + 1e-9
#: Members this far or more from every pivot of a region are at home in its far region instead.
FAR = 0.6
#: Candidates (sid, doc_id) counted up to this many are broadcast, 32 MB at most; beyond it both sides are shuffled.
BROADCAST_ROWS = 2_000_000
#: Rounds of the two exact rules among the remaining candidates, until none drops out.
NARROWING = 4
#: Rounds of tests against drawn holders of a shingle before the pairs of two labels meet, and tests of a member in each.
ROUNDS = 2
REPS = 8
#: Bits of a set's bitmap, a power of two and a multiple of 64.
BITS = 512
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct XXH64 values (as signed longs) of the shingles of one UTF-8 text."""
    found = text.translate(_LOWER).split()  # bytes.split() parts on exactly [\x20\x09-\x0D]
    if not found:
        return np.zeros(0, dtype=np.int64)
    if len(found) < words:
        runs = [b" ".join(found)]
    else:
        runs = [b" ".join(found[i:i + words]) for i in range(len(found) - words + 1)]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(r) for r in runs), dtype=np.uint64, count=len(runs)).view(np.int64))


def prefix_length(n: int) -> int:
    """Least hashes of a set of ``n`` that must hold a shared shingle of any set it links with."""
    return n - (SIMILARITY * n + 99) // 100 + 1 if n else 0


def in_slice(hashes: np.ndarray) -> np.ndarray:
    """The hashes (sorted, signed) in the lowest ``SLICE`` of the hash range."""
    return hashes[:np.searchsorted(hashes, int(SLICE * 2 ** 64) - 2 ** 63)]


def _sets(words: int, whole: bool):
    """(doc_id, n, sid, s): the set's size, its name (XXH64 of size and hashes), and all hashes or the slice."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = [shingle_hashes(t, words) for t in texts_of(batch.column("text"))]
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            names = [np.uint64(xxhash.xxh64_intdigest(x.tobytes(), seed=len(x))).view(np.int64) if len(x) else None for x in found]
            kept = found if whole else [in_slice(x) for x in found]
            offsets = np.zeros(len(kept) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in kept], out=offsets[1:])
            flat = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(names, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))],
                ["doc_id", "n", "sid", "s"])
    return step


_SETS = "doc_id long, n long, sid long, s array<long>"


def _able(alone: Column) -> Column:
    """May a set of ``n`` shingles link, of which ``alone`` are in no other set."""
    return (F.col("n") - alone) * 100 >= F.col("n") * SIMILARITY


def _links(a: Column, b: Column) -> Column:
    """Exact test of two sets given their sizes ``a``, ``b`` and the intersection in column ``i``."""
    return F.col("i") * 100 >= (a + b - F.col("i")) * SIMILARITY


def candidates(slices: DataFrame) -> DataFrame:
    """(sid, doc_id) of each set that may link, with its least doc_id.

    A shingle of a slice is alone if no slice of another set holds it, so no other set does; the least and
    greatest set names holding it are equal then. Copies of a document name the same set.
    """
    per_shingle = slices.select("sid", F.explode("s").alias("h")).groupBy("h").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi"))
    alone = per_shingle.where("lo = hi").groupBy(F.col("lo").alias("sid")).agg(F.count("*").alias("alone"))
    # One slice per name: a set's rows hold equal sizes and slices.
    sets = slices.groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"))
    return sets.join(alone, "sid", "left").where(_able(F.coalesce("alone", F.lit(0)))).select("sid", "doc_id")


def narrowed(members: DataFrame) -> DataFrame:
    """Members (sid, s, n) that may still link with another member, by both exact rules among them.

    A set keeps its place if at least 80 % of its shingles are in other members, and if its prefix shares
    a shingle with the prefix of another member; both ends of a link meet both rules by each other. One
    aggregate by shingle serves both rules.
    """
    p = F.col("n") - F.floor((F.col("n") * SIMILARITY + 99) / 100) + 1
    spread = members.select("sid", F.posexplode("s").alias("at", "h"), "n").select("sid", "h", (F.col("at") < p).alias("head"))
    per_shingle = spread.groupBy("h").agg(
        F.min("sid").alias("lo"), F.max("sid").alias("hi"),
        F.min(F.when(F.col("head"), F.col("sid"))).alias("head_lo"), F.max(F.when(F.col("head"), F.col("sid"))).alias("head_hi"))
    alone = per_shingle.where("lo = hi").groupBy(F.col("lo").alias("sid")).agg(F.count("*").alias("alone"))
    head_shared = per_shingle.where("head_lo != head_hi").select("h")
    meeting = spread.where("head").join(head_shared, "h", "left_semi").select("sid").distinct()
    sizes = members.select("sid", "n")
    kept = (sizes.join(alone, "sid", "left").withColumn("alone", F.coalesce("alone", F.lit(0)))
            .where(_able(F.col("alone"))).select("sid")
            .join(meeting, "sid", "left_semi"))
    kept = stage(kept, "kept-sets")
    # Only set names travel; the sets themselves are filtered where they lie when the names are few.
    return members.join(F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept, "sid", "left_semi")


def staged(df: DataFrame, label: str, made: list[str]) -> DataFrame:
    """Stage a table and note its folder in ``made``, so that it can go once its successor is written."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark, made: list[str]) -> None:
    """Delete staged folders that nothing will read again."""
    jvm = spark.sparkContext._jvm
    for path in made:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    made.clear()


def release(spark) -> None:
    """Let Spark's cleaner delete the shuffle files of stages whose plans nothing holds any more."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _pivots(members: DataFrame, level: int) -> DataFrame:
    """About PIVOTS home members of every region of at most PIVOT_MAX shingles, and the home member of
    least hash whatever its size, so a region with members at home always has a pivot."""
    u = F.xxhash64("sid", F.lit(level)).cast("double") / float(2 ** 64) + 0.5
    homes = members.where("home").withColumn("u", u)
    counts = homes.groupBy("region").agg(F.count_if(F.col("n") <= PIVOT_MAX).alias("able"), F.min_by("sid", "u").alias("least"))
    chosen = homes.join(counts, "region").where(
        ((F.col("n") <= PIVOT_MAX) & (F.col("u") * F.col("able") < PIVOTS)) | (F.col("sid") == F.col("least")))
    return chosen.select("region", F.col("sid").alias("psid"), F.col("n").alias("pn"), F.col("s").alias("ps"))


def _apart(pivots: DataFrame) -> DataFrame:
    """Pivots without those within WINDOW of a lesser one, so that a large group of near copies has few; the least of a region stays."""
    lesser = pivots.select("region", F.col("psid").alias("qsid"), F.col("pn").alias("qn"), F.col("ps").alias("qs"))
    near = (pivots.join(lesser, "region").where("qsid < psid").withColumn("i", F.size(F.array_intersect("ps", "qs")))
            .where(1 - F.col("i") / (F.col("pn") + F.col("qn") - F.col("i")) <= WINDOW))
    return pivots.join(near.select("region", "psid").distinct(), ["region", "psid"], "left_anti").select(pivots.columns)


def split(members: DataFrame, level: int, made: list[str]) -> DataFrame:
    """Members of the next level: each in the regions of the pivots within both windows of the module.

    Its staged helpers are noted in ``made``; they may go once the result is staged.
    """
    pivots = staged(_apart(staged(_pivots(members, level), "drawn-pivots", made)), "pivots", made)
    spread = pivots.select("region", "psid", F.explode("ps").alias("h"))
    shared = (members.select("region", "sid", F.explode("s").alias("h")).join(spread, ["region", "h"])
              .groupBy("region", "sid", "psid").agg(F.count("*").alias("i")))
    # Every member against every pivot of its region (about PIVOTS each), without its set; no overlap is distance 1.
    slim = members.select("region", "sid", "n", "home")
    each = staged(slim.join(pivots.drop("ps"), "region").join(shared, ["region", "sid", "psid"], "left")
                 .withColumn("i", F.coalesce("i", F.lit(0)))
                 .withColumn("d", 1 - F.col("i") / (F.col("n") + F.col("pn") - F.col("i")))
                 .withColumn("ball", _links(F.col("n"), F.col("pn"))), "distances", made)
    nearest = staged(each.groupBy("region", "sid").agg(F.min(F.struct("d", "psid")).alias("best")), "nearest", made)
    near = F.col("best.d") < FAR
    placed = each.join(nearest, ["region", "sid"])
    # A pivot's radius: farthest member that is home there; a region without one has no pair to find.
    radius = (placed.where(F.col("home") & near & (F.col("psid") == F.col("best.psid")))
              .groupBy("region", "psid").agg(F.max("d").alias("radius")))
    kept = (placed.join(radius, ["region", "psid"])
            .where(F.col("d") <= F.col("best.d") + WINDOW)
            .where(F.col("d") <= F.col("radius") + REACH)
            .select("region", "sid", F.xxhash64("region", "psid").alias("child"),
                    (F.col("home") & near & (F.col("psid") == F.col("best.psid"))).alias("home"),
                    F.when(F.col("ball"), F.array("psid")).otherwise(F.array().cast("array<long>")).alias("ball")))
    # The far region: at home whoever is FAR or more from every pivot, copied whoever is FAR - 0.2 or more.
    far = (each.select("region", "sid", "home").distinct().join(nearest, ["region", "sid"])
           .where(F.col("best.d") >= FAR - REACH)
           .select("region", "sid", F.xxhash64("region", F.lit(-1)).alias("child"), (F.col("home") & ~near).alias("home"),
                   F.array().cast("array<long>").alias("ball")))
    return kept.unionByName(far).join(members.select("region", "sid", "s", "n", "balls"), ["region", "sid"]).select(
        F.col("child").alias("region"), "sid", "s", "n", "home", F.concat("balls", "ball").alias("balls"))


def _ball_links(members: DataFrame) -> DataFrame:
    """Links of members to the pivots whose balls hold them."""
    return members.select(F.col("sid").alias("a"), F.explode("balls").alias("b")).where("a != b")


def _rare_prefixes(leaves: DataFrame) -> DataFrame:
    """(region, h, sid, n, place, home, label): of each member the first shingles, rarest of the region first, that a link must share.

    A shingle that no other member of the region holds takes a place of the prefix but meets nothing, so
    it has no row; nor has one whose holders are all in one pivot's ball. The label is the first ball, or the set itself.
    """
    label = F.coalesce(F.try_element_at("balls", F.lit(1)), "sid")
    spread = leaves.select("region", "sid", "n", label.alias("label"), F.explode("s").alias("h"))
    held = spread.groupBy("region", "h").agg(F.count("*").alias("holders"), (F.min("label") != F.max("label")).alias("mixed")).where("holders > 1")
    of_set = Window.partitionBy("region", "sid")
    ranked = (lookup(spread, held, ["region", "h"], "inner")
              .withColumn("shared", F.count("*").over(of_set))
              .withColumn("place", F.row_number().over(of_set.orderBy("holders", "h")) + F.col("n") - F.col("shared")))
    first = F.col("n") - F.floor((F.col("n") * SIMILARITY + 99) / 100) + 1
    return (ranked.where((F.col("place") <= first) & F.col("mixed")).select("region", "h", "sid", "n", "place", "label")
            .join(leaves.select("region", "sid", "home"), ["region", "sid"]))


_BITMAP = [f"q{k}" for k in range(BITS // 64)]


def _with_bitmaps(sets: DataFrame) -> DataFrame:
    """(sid, n, s) and the bitmap in columns of 64 bits: bit ``k`` says if an odd number of hashes is ``k`` modulo ``BITS``."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("s")
            rows = np.repeat(np.arange(len(lists)), np.asarray(pa.compute.list_value_length(lists)))
            held = np.bincount(rows * BITS + (np.asarray(lists.flatten()) & (BITS - 1)), minlength=len(lists) * BITS) & 1
            words = np.packbits(held.astype(np.uint8)).view(np.int64).reshape(len(lists), len(_BITMAP))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(words[:, k].copy()) for k in range(len(_BITMAP)))], ["sid", "n", "s", *_BITMAP])
    return map_arrow(sets.select("sid", "n", "s"), step, ", ".join(["sid long, n long, s array<long>", *(f"{q} long" for q in _BITMAP)]))


def _bitmaps_allow() -> Column:
    """May sets of ``na`` and ``nb`` shingles link: a shingle of only one of them flips one bit, so no more bits differ than such shingles."""
    flipped = reduce(Column.__add__, [F.bit_count(F.col(f"{q}a").bitwiseXOR(F.col(f"{q}b"))) for q in _BITMAP])
    return flipped * (100 + SIMILARITY) <= (F.col("na") + F.col("nb")) * (100 - SIMILARITY)


def _named(df: DataFrame, end: str, columns: list[str], shared: list[str] | None = None) -> DataFrame:
    """One end of a pair: the set's name as ``<end>``, its columns with ``<end>`` behind their names, and the shared ones as they are."""
    return df.select(*(shared or []), F.col("sid").alias(end), *[F.col(c).alias(c + end) for c in columns])


def _exact(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by their set intersection."""
    return (pairs.join(_named(sets, "a", ["s", "n"]), "a").join(_named(sets, "b", ["s", "n"]), "b")
            .withColumn("i", F.size(F.array_intersect("sa", "sb")))
            .where(_links(F.col("na"), F.col("nb"))).select("a", "b"))


def mixed_rows(rows: DataFrame, *more: Column) -> DataFrame:
    """Rows of the shingles whose holders have two labels or more, with ``more`` aggregates of their shingle."""
    per_shingle = rows.groupBy("region", "h").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), *more).where("lo != hi").drop("lo", "hi")
    return lookup(rows, per_shingle, ["region", "h"], "inner")


def drawn_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """(a, b): each member with at most ``REPS`` members of other labels, each drawn by a hash among the holders of a shingle."""
    drawn = F.xxhash64("sid", "h", F.lit(turn))
    met = mixed_rows(rows, F.min_by("sid", drawn).alias("rep"), F.min_by("label", drawn).alias("rep_label")).where("label != rep_label")
    some = met.groupBy("sid").agg(*[F.min_by("rep", F.xxhash64("region", "h", "sid", F.lit(turn * REPS + k))).alias(f"r{k}") for k in range(REPS)])
    return (some.select("sid", F.explode(F.array(*[f"r{k}" for k in range(REPS)])).alias("rep"))
            .select(F.least("sid", "rep").alias("a"), F.greatest("sid", "rep").alias("b")).distinct())


def leaf_pairs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of two labels that meet in their rare prefixes and whose sizes, places and bitmaps allow a link."""
    rows = lookup(mixed_rows(rows), sets.select("sid", *_BITMAP), ["sid"], "inner")
    ends = ["n", "place", "home", "label", *_BITMAP]
    shared = ["region", "h"]
    met = _named(rows, "a", ends, shared).join(_named(rows.where("home"), "b", ends, shared), shared)
    shorter = (F.col("na") + F.col("nb")) * SIMILARITY  # a link shares at least this many shingles, times 100 + SIMILARITY
    return (met.where("a < b or (a != b and not homea)").where("labela != labelb")
            .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * SIMILARITY)
            .where(((F.col("na") - F.col("placea") + 1) * (100 + SIMILARITY) >= shorter) & ((F.col("nb") - F.col("placeb") + 1) * (100 + SIMILARITY) >= shorter))
            .where(_bitmaps_allow())
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def leaf_links(leaves: DataFrame) -> DataFrame:
    """Links (a, b) inside the leaves that, with those of the balls, connect whatever sets link there."""
    rows = stage(_rare_prefixes(leaves), "leaf-prefixes")
    if rows.isEmpty():
        return rows.select(F.col("sid").alias("a"), F.col("sid").alias("b"))
    sets = stage(_with_bitmaps(leaves.dropDuplicates(["sid"])), "leaf-sets")
    slim = sets.drop("s")
    known, found = _ball_links(leaves), []
    for turn in range(ROUNDS):
        drawn = drawn_pairs(rows, turn)
        able = (drawn.join(_named(slim, "a", ["n", *_BITMAP]), "a").join(_named(slim, "b", ["n", *_BITMAP]), "b")
                .where(_bitmaps_allow()).select("a", "b"))
        found.append(stage(_exact(able, sets), "drawn-links"))
        roots = graph.components(reduce(DataFrame.unionByName, found, known)).select(F.col("node").alias("sid"), "root")
        rows = stage(lookup(mixed_rows(rows).drop("label"), roots, ["sid"], "left")
                     .withColumn("label", F.coalesce("root", "sid")).drop("root"), "leaf-prefixes")
    pairs = stage(leaf_pairs(rows, sets), "leaf-pairs")
    return reduce(DataFrame.unionByName, found, _exact(pairs, sets))


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least doc_id reachable by links, itself included).

    A distinct set is a node named by the XXH64 of its size and shingles; its documents share it and so
    are linked. Links run between nodes; each component then takes the least doc_id of its documents.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"))
    spark = docs.sparkSession
    rows = stage(map_arrow(texts, _sets(words, whole=False), _SETS), "jaccard-slices")
    temps: list[str] = []
    able = staged(candidates(rows.where("doc_id is not null and n > 0")), "jaccard-candidates", temps)
    release(spark)
    # Whole sets only of the candidates: one document of each, its text shingled again. The candidate
    # list is broadcast when counted below BROADCAST_ROWS (16 bytes a row), so texts are not shuffled.
    small = able.count() <= BROADCAST_ROWS
    ids = F.broadcast(able) if small else able
    chosen = texts.join(ids.select("doc_id"), "doc_id", "left_semi")
    whole = map_arrow(chosen, _sets(words, whole=True), _SETS).join(ids, ["sid", "doc_id"], "left_semi")
    held: list[str] = []
    sets = staged(whole.select("sid", "s", "n"), "jaccard-sets", held)
    drop(spark, temps)
    release(spark)
    seen = sets.count()
    for _ in range(NARROWING):
        newer: list[str] = []
        fewer = staged(narrowed(sets), "jaccard-narrowed", newer)
        release(spark)
        left = fewer.count()
        drop(spark, held)
        sets, held, done = fewer, newer, left == seen
        seen = left
        if done:
            break
    # A text repeated under one doc_id gave its set more than once.
    level_made: list[str] = []
    members = staged(sets.dropDuplicates(["sid"]).select(
        F.lit(0).cast("long").alias("region"), "sid", "s", "n", F.lit(True).alias("home"), F.array().cast("array<long>").alias("balls")),
        "members", level_made)
    drop(spark, held)
    links = []
    for level in range(LEVELS + 1):
        sizes = members.groupBy("region").agg(F.count("*").alias("rows"))
        last = level == LEVELS
        leaf = members if last else members.join(sizes.where(F.col("rows") <= LEAF).select("region"), "region")
        links.append(stage(leaf_links(leaf), "leaf-links"))
        big = sizes.where(F.col("rows") > LEAF).select("region")
        if last or big.isEmpty():
            break
        helpers: list[str] = []
        next_made: list[str] = []
        members = staged(split(members.join(big, "region"), level, helpers), f"level-{level}", next_made)
        links.append(stage(_ball_links(members), "ball-links"))
        drop(spark, helpers)
        drop(spark, level_made)
        level_made = next_made
        release(spark)
    drop(spark, level_made)
    edges = stage(reduce(DataFrame.unionByName, links), "jaccard-links")
    roots = graph.components(edges.distinct()).select(F.col("node").alias("sid"), "root")
    per_doc = lookup(rows.select("doc_id", "n", "sid"), roots, ["sid"], "left")
    per_doc = per_doc.withColumn("group", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "sid")))
    least = per_doc.where(F.col("group").isNotNull()).groupBy("group").agg(F.min("doc_id").alias("least"))
    per_doc = lookup(per_doc, least, ["group"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return per_doc.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))

"""Jaccard join of 5-word shingle sets against all pairs tested in Python and union-find."""

import random
import re

from shoalgrid.llm import jaccard


def shingles(text):
    if text is None:
        return set()
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if w]
    if not words:
        return set()
    if len(words) < 5:
        return {" ".join(words)}
    return {" ".join(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    named = [(i, s) for i, s in sets if i is not None]
    for a, (i, s) in enumerate(named):
        find(i)
        for j, t in named[a + 1:]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                ri, rj = find(i), find(j)
                parent[max(ri, rj)] = min(ri, rj)
    groups = {}
    for i, _ in named:
        groups.setdefault(find(i), []).append(i)
    least = {r: min(v) for r, v in groups.items()}
    return sorted(((i, len(s), least[find(i)] if i is not None else None) for i, s in sets), key=lambda r: (r[0] is None, r[0] or 0))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, component_id string, n_shingles int")


def run(spark, rows):
    return sorted((tuple(r) for r in jaccard.jaccard_components(frame(spark, rows)).collect()), key=lambda r: (r[0] is None, r[0] or 0))


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)]
    rows, i = [], 0
    for _ in range(n):
        base = [rng.choice(vocab) for _ in range(rng.randint(20, 60))]
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 6))):  # near copies, some beyond the threshold
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            if rng.random() < 0.2:
                copy = [w.upper() if rng.random() < 0.5 else w for w in copy]
            rows.append((i, "\t".join(copy) if rng.random() < 0.3 else " ".join(copy)))
            i += 1
    return rows


def test_against_all_pairs(spark):
    rows = corpus(1, 90)
    rows += [(1000, None), (1001, ""), (1002, "   "), (1003, "a b"), (1004, "A B"), (1005, "a b c"), (None, "a b"), (1006, "x " * 3000), (1007, "x " * 2)]
    rows += [(1008, rows[0][1]), (1008, rows[0][1])]  # repeated rows
    assert run(spark, rows) == brute(rows)


def test_recursion_against_all_pairs(spark, monkeypatch):
    # Small leaves and few pivots force several levels of regions.
    monkeypatch.setattr(jaccard, "LEAF", 8)
    monkeypatch.setattr(jaccard, "PIVOTS", 3)
    rows = corpus(2, 120)
    assert run(spark, rows) == brute(rows)


def test_empty_and_unlinked(spark):
    assert run(spark, []) == []
    rows = [(1, "one two three four five six"), (2, "seven eight nine ten eleven twelve"), (3, None)]
    assert run(spark, rows) == brute(rows)


def test_far_regions_and_large_sets(spark, monkeypatch):
    # Pivots of a few shingles only: the largest sets can be the sole pivot of their region.
    monkeypatch.setattr(jaccard, "LEAF", 4)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    monkeypatch.setattr(jaccard, "PIVOT_MAX", 10)
    rows = corpus(5, 80) + [(5000 + k, " ".join(f"u{k}x{j}" for j in range(40))) for k in range(20)]
    assert run(spark, rows) == brute(rows)


def test_shared_passages_leave_no_candidates(spark):
    # A fifth of each text is shared, so prefixes meet, but no two texts link.
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(i, passage + " " + " ".join(f"d{i}x{k}" for k in range(240))) for i in range(60)]
    slices = jaccard.map_arrow(frame(spark, rows).select("doc_id", "text"), jaccard._sets(5, whole=False), jaccard._SETS)
    assert jaccard.candidates(slices).count() <= 6
    rows += [(100 + i, t.replace("x7 ", "y7 ")) for i, t in rows[:9]]
    assert run(spark, rows) == brute(rows)


def test_near_copies_are_copied_once_and_not_paired(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PIVOTS", 8)
    base = [f"w{k}" for k in range(200)]
    rows = [(i, " ".join([*base[:i], f"u{i}", *base[i + 1:]])) for i in range(100)]
    members = (jaccard.map_arrow(frame(spark, rows).select("doc_id", "text"), jaccard._sets(5, whole=True), jaccard._SETS)
               .selectExpr("0L as region", "sid", "s", "n", "true as home", "cast(array() as array<long>) as balls"))
    made = []
    parts = jaccard.staged(jaccard.split(members, 0, made), "parts", made)
    assert parts.count() == 100
    assert jaccard.leaf_links(parts).count() == 0  # all in one ball
    monkeypatch.setattr(jaccard, "LEAF", 8)
    assert run(spark, rows) == brute(rows)


def near_copies(seed, n, words, changes):
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(words)]
    rows = []
    for i in range(n):
        copy = list(base)
        for at in rng.sample(range(words), rng.choice(changes)):
            copy[at] = f"u{i}x{at}"
        rows.append((i, " ".join(copy)))
    return rows


def test_large_group_of_near_copies_meets_in_few_pairs(spark, monkeypatch):
    # One group, no pivots: about half of its pairs link, and there are 300 * 299 / 2 of them.
    met = []
    real = jaccard.stage
    monkeypatch.setattr(jaccard, "stage", lambda df, label: met.append((label, real(df, label))) or met[-1][1])
    rows = near_copies(7, 300, 150, (1, 2, 3))
    assert run(spark, rows) == brute(rows)
    tested = sum(df.count() for label, df in met if label == "leaf-pairs")
    assert 0 < len([label for label, _ in met if label == "leaf-pairs"]) and tested < 3000


def test_links_left_after_the_rounds(spark, monkeypatch):
    # One test a member draws little: the pairs of two labels must find the rest.
    monkeypatch.setattr(jaccard, "REPS", 1)
    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    rows = near_copies(8, 80, 60, (0, 1, 2, 3)) + [(1000 + i, t) for i, t in corpus(9, 40)]
    assert run(spark, rows) == brute(rows)


def test_bitmaps_allow_every_link(spark):
    rows = near_copies(10, 60, 90, (0, 1, 2, 3, 4))
    sets = (jaccard.map_arrow(frame(spark, rows).select("doc_id", "text"), jaccard._sets(5, whole=True), jaccard._SETS).drop("sid").withColumnRenamed("doc_id", "sid"))
    made = jaccard._with_bitmaps(sets)
    ends = ["n", "s", *jaccard._BITMAP]
    pairs = jaccard._named(made, "a", ends).join(jaccard._named(made, "b", ends)).withColumn("i", jaccard.F.size(jaccard.F.array_intersect("sa", "sb")))
    links = pairs.where(jaccard._links(jaccard.F.col("na"), jaccard.F.col("nb")))
    assert links.count() > 60
    assert links.where(jaccard._bitmaps_allow()).count() == links.count()
    assert pairs.where(jaccard._bitmaps_allow()).count() < pairs.count()

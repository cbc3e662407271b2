"""Centroid clustering against a plain loop over the contract: argmin distances, exact floor means."""

import hashlib
import math
import random

from shoalgrid.llm import centroids


def brute(rows, k=8, rounds=10, dim=64):
    kept = []
    for i, v in rows:
        if v is None or len(v) != dim or any(x is None or not math.isfinite(x) or abs(float(x) * 1024) >= centroids.BOUND for x in v):
            continue
        kept.append((i, [math.floor(float(x) * 1024) for x in v]))
    seeds = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cents = [list(v) for _, v in seeds]

    def near(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
        best = min(range(len(cents)), key=lambda j: (d[j], j))
        return best, d[best]

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[0], []).append(v)
        for c, vs in groups.items():
            cents[c] = [sum(col) // len(vs) for col in zip(*vs)]
    out = [(i, *near(v)) for i, v in kept]
    per = {}
    for _, c, d in out:
        per[c] = per.get(c, 0) + d
    total = sum(per.values())
    digest = lambda c: hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()
    return [(i, c, d, per[c], total, digest(c)) for i, c, d in out]


def rows_of(spark, rows, extra=False):
    if extra:
        return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, distance int")
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


def test_against_plain_loop_with_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0.3 * (i % 3), 0.2) for _ in range(64)]) for i in range(300)]
    rows += [(i, list(rows[i - 300][1])) for i in range(300, 340)]  # equal vectors, other ids
    rows += [(7, list(rows[7][1]))]  # a repeated row
    rows += [(900, None), (901, [1.0] * 63), (902, [float("nan")] + [0.0] * 63), (903, [None] + [0.0] * 63),
             (904, [float("inf")] + [0.0] * 63), (905, [1e30] + [0.0] * 63), (None, [0.5] * 64), (906, [])]
    found = sorted((tuple(r) for r in centroids.cluster(rows_of(spark, rows, extra=True)).collect()), key=key)
    want = sorted(brute([(i, None if v is None else [None if x is None else float(__import__("numpy").float32(x)) for x in v]) for i, v in rows]), key=key)
    assert found == want


def test_ties_and_few_vectors(spark):
    # Two vectors only: two centroids; a vector halfway between equal centroids goes to the smaller number.
    rows = [(1, [0.0] * 64), (2, [0.0] * 64), (3, [1.0] * 64)]
    found = sorted(tuple(r) for r in centroids.cluster(rows_of(spark, rows)).collect())
    assert found == sorted(brute(rows))
    assert {r[1] for r in found if r[0] in (1, 2)} == {min(r[1] for r in found if r[0] in (1, 2))}


def test_empty_table(spark):
    assert centroids.cluster(rows_of(spark, [])).collect() == []
    assert centroids.cluster(rows_of(spark, [(1, None), (2, [1.0])])).collect() == []


def test_tournament_matches_argmin():
    import numpy as np
    rng = np.random.default_rng(1)
    cents = rng.integers(-3, 4, (8, 64))
    cents[5] = cents[2]
    vectors = rng.integers(-3, 4, (2000, 64))
    winner, distance = centroids.tournament(vectors, cents)
    d = ((vectors[:, None, :] - cents[None, :, :]) ** 2).sum(axis=2)
    assert (winner == d.argmin(axis=1)).all()
    assert (distance == d.min(axis=1)).all()

"""Nearest neighbours against all inner products; language-model scores against direct counts."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shoalgrid.llm import ann, lm


def nearest(rows, every, k):
    vectors = {(i, tuple(np.float32(v).astype(float))) for i, v in rows if i is not None and v is not None and len(v) == 3 and None not in v}
    vectors = [(i, np.array(v)) for i, v in vectors if np.isfinite(v).all() and np.any(v)]
    out = []
    for i, v in vectors:
        if i % every == 0:
            best = sorted((-float((v * w).sum()), j) for j, w in vectors if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def test_small_table_with_copies_and_odd_vectors(spark):
    rng = random.Random(0)
    rows = [(i, [rng.choice((-1.0, 0.5, 2.0)) for _ in range(3)]) for i in range(120)] + [(i, [0.3, 0.4, 0.5]) for i in range(120, 260)]
    rows += [(300, None), (320, [0.0, 0.0, 0.0]), (340, [1.0, None, 2.0]), (360, [float("nan"), 1.0, 1.0]), (380, [float("inf"), 1.0, 1.0]), (400, [1.0, 2.0]), (420, []),
             (None, [1.0, 1.0, 1.0]), (440, [9.0, 9.0, 9.0]), (440, [9.0, 9.0, 9.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(map(tuple, ann.neighbours(table).collect()))
    want = nearest(rows, 20, 20)
    assert [r[:3] for r in found] == [r[:3] for r in want]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in want], abs=1e-12)


def test_few_vectors_and_none(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0], "a"), (20, [2.0, 1.0], "b"), (7, [-1.0, 0.0], "c")], "vec_id long, embedding array<float>, slot string")
    found = sorted(tuple(r)[:3] for r in ann.neighbours(table).collect())
    assert found == [(0, 1, 20), (0, 2, 7), (20, 1, 0), (20, 2, 7)]
    assert ann.neighbours(table.limit(0)).collect() == []
    assert ann.neighbours(table.where("vec_id = 7")).collect() == []


def test_recall_where_not_all_buckets_are_read(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    got = defaultdict(set)
    for r in ann.neighbours(table, every=10, least=100).collect():
        got[r["query_id"]].add(r["vec_id"])
    recall = []
    for q in np.flatnonzero(ids % 10 == 0):
        order = [j for j in np.lexsort((ids, -(x @ x[q]))) if j != q][:20]
        recall.append(len(got[ids[q]] & set(ids[order].tolist())) / 20)
    assert np.mean(recall) >= 0.95


def test_rotation_keeps_length():
    x = np.random.default_rng(0).normal(size=(5, 50))
    y = ann.rotate(x, ann.rotations(50, 1)[0])
    assert np.linalg.norm(y, axis=1) == pytest.approx(np.linalg.norm(x, axis=1))


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def base(rows):
    count = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(count.values()), len(count)
    return {(i, text): (held(i), len(tokens(text)), sum(count[t] > 0 for t in tokens(text)), n, sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens(text))) for i, text in rows}


def check(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lm.score_texts(docs, **more).collect()
    want = sorted(((i, *base(rows)[i, t]) for i, t in rows), key=repr)
    got = sorted((tuple(r)[:6] for r in found), key=repr)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)
    return found


def test_base_scores_with_words_beyond_the_head(spark):
    rng = random.Random(1)
    words = ["w%d" % int(rng.paretovariate(0.6)) for _ in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=40))) for i in range(80)] + [(None, "W1 only\tHere"), (500, None), (501, ""), (502, "É é"), (7, "w1"), (7, "w1"), (503, "new " * 3)]
    check(spark, rows, head=20, classes=12)
    check(spark, rows[:80], head=5000, classes=64)


def test_no_training_documents_and_empty(spark):
    rows = [(i, "a b") for i in range(200) if held(i)]
    check(spark, rows)
    assert lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").limit(0)).collect() == []


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    share = rng.dirichlet(np.ones(20))
    share[lm.BEGIN] = 0
    model = lm.Model.start(share / share.sum(), 8)
    c = np.array([i for i in range(20) if i != lm.BEGIN])
    a, b = np.full(len(c), 4), np.full(len(c), lm.BEGIN)
    assert (10 ** model.log10(a, b, c)).sum() == pytest.approx(1, abs=1e-5)


def test_model_learns_contexts_and_beats_unigrams_on_held_out_texts(spark):
    rng = random.Random(3)
    follow = {w: rng.sample(range(40), 3) for w in range(40)}

    def text():
        w, out = rng.randrange(40), []
        for _ in range(60):
            out.append(f"w{w}")
            w = rng.choice(follow[w])
        return " ".join(out)

    found = check(spark, [(i, text()) for i in range(1500)])
    rest = [r for r in found if r["held_out"]]
    n = sum(r["n_tokens"] for r in rest)
    assert sum(r["score"] for r in rest) / n > sum(r["base_score"] for r in rest) / n + 0.1


def test_scores_on_the_table_beat_unigrams(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rest = [r for r in lm.score_texts(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in rest) > sum(r["base_score"] for r in rest)


def test_scores_on_the_larger_table_beat_unigrams(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    rest = [r for r in lm.score_texts(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in rest) > sum(r["base_score"] for r in rest)


def test_parts_keep_the_counts_and_are_even(spark):
    grams = spark.createDataFrame([(5, 900), (6, 1), (7, 2), (8, 97)], "code long, n long")
    parts, mean = lm.dealt(grams)
    found = defaultdict(list)
    for code, n in parts.collect():
        found[code].append(n)
    assert {code: sum(n) for code, n in found.items()} == pytest.approx({5: 900, 6: 1, 7: 2, 8: 97})
    assert max(map(max, found.values())) <= 250 and mean == pytest.approx(1000 / sum(map(len, found.values())))

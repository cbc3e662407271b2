"""Removal of repeated byte strings against a count of every string."""

import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shoalgrid.llm import suffix as s


def expected(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, dtype=bool)
        for p in range(len(t) - length + 1):
            if count[t[p:p + length]] > 1:
                gone[p:p + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone[:-1].sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, length):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, s.remove_repeats(docs, length).collect()), key=repr) == expected(rows, length)


def test_planted_passages(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdeé ", k=7))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, other = text(90), text(60)
    rows = [(i, text(30) + passage[rng.randrange(200): 700 - rng.randrange(200)] + text(30)) for i in range(12)]
    rows += [(20, other + text(9) + other), (21, text(300)), (None, rows[3][1]), (22, rows[3][1]), (22, rows[3][1]), (23, None), (24, ""), (25, passage[:399])]
    for _ in range(8):  # near copies of a long text
        base = list(rows[13][1])
        base[rng.randrange(len(base))] = "#"
        rows.append((30 + len(rows), "".join(base)))
    check(spark, rows, 400)


def test_periodic_and_short_strings(spark):
    rows = [(1, "a" * 3000), (2, "ab" * 700), (3, "a" * 399), (4, "b" * 400), (5, "q" + "ab" * 700), (6, "xyz" * 300), (7, "xyz" * 300)]
    check(spark, rows, 400)
    check(spark, [(1, "abcabcab"), (2, "zabcaz"), (3, "")], 4)


def test_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows, 400)


def test_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "t" * 500, b"k", 3)], "doc_id long, text string, key binary, n int")
    assert s.remove_repeats(docs).count() == 1
    assert s.remove_repeats(docs.limit(0)).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=0, max_size=40), st.integers(0, 300), st.integers(1, 40))
def test_anchors_depend_on_the_window_only(middle, shift, repeat):
    data = (b"0123456789" * 40)[:shift] + (middle * repeat) + bytes(range(256)) * 2
    starts, window = len(data) - 400 + 1, 64
    if starts < 1:
        return
    anchor, first, last = s.anchor_runs(data, starts, window)
    of = np.repeat(anchor, last - first + 1)
    assert len(of) == starts and (of >= np.arange(starts)).all() and (of < np.arange(starts) + window).all()
    for p in range(0, starts, 37):
        alone = s.anchor_runs(data[p: p + 400], 1, window)[0][0]
        assert alone == of[p] - p


def test_bytes_outside_spans():
    assert s.without_spans(b"abcdefgh", [(1, 3), (2, 4), (6, 7)]) == b"aefh"

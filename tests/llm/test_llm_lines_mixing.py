"""Line dedup and source mixing: against direct versions and on odd tables (their SQL is checked with the queries)."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from shoalgrid.llm import lines, mixing


def without_later_copies(rows, min_lines, min_words):
    """(id, text) in order of input; rows of equal id are in order of input."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, gone = set(), {i: set() for i in order}
    for i in order:
        own = [(k, x) for k, x in enumerate((rows[i][1] or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)]
        for j in range(len(own)):
            for size in {1, min_lines}:
                run = own[j: j + size]
                if len(run) < size or size == 1 < min_lines and len(re.findall(r"[^\x20\x09-\x0D]+", run[0][1])) < min_words:
                    continue
                key = tuple(x for _, x in run)
                if key in seen:
                    gone[i] |= {k for k, _ in run}
                seen.add(key)
    return [(d, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])) for i, (d, t) in enumerate(rows)]


@pytest.mark.parametrize("min_lines", [1, 2, 3, 5])
def test_runs(spark, min_lines):
    rng = random.Random(min_lines)
    pool = [" ".join(rng.choices(["x", "yy", "é"], k=rng.choice((1, 3, 9)))) for _ in range(14)] + ["", "  "]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randrange(30)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, rows[0][1]), (None, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = lines.dedup_lines(docs, min_lines, 8).select("doc_id", "text").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(without_later_copies(rows, min_lines, 8), key=repr)


def test_repeated_rows_keep_the_first_and_all_columns_stay(spark):
    text = "one two three four five six seven eight\nshort"
    docs = spark.createDataFrame([(1, text, 7, "a"), (1, text, 8, "b")], "doc_id long, text string, row int, gone string").coalesce(1)
    found = lines.dedup_lines(docs)
    assert found.columns == [*docs.columns, "line_counts"]
    got = {r["gone"]: (r["text"], r["row"], r["line_counts"]["n_lines"], r["line_counts"]["n_removed"]) for r in found.collect()}
    assert got == {"a": (text, 7, 2, 0), "b": ("", 8, 2, 2)}
    assert lines.dedup_lines(docs.limit(0)).collect() == []


def copies(rows, weights, budget, seed=mixing.SEED):
    mass = Counter()
    for _, text, source in rows:
        mass[source] += len(text or "")
    share = {s: (1.0 if weights is None else weights.get(s, 0.0)) if m else 0.0 for s, m in mass.items()}
    goal = budget * sum(mass.values()) / (sum(share.values()) or 1)
    out = []
    for i, text, source in rows:
        rate = share[source] * goal / mass[source] if mass[source] else 1.0
        own = hashlib.md5((text or "").encode()).hexdigest()
        u = int(hashlib.md5(f"{seed}|{'' if i is None else i}|{own}".encode()).hexdigest()[:13], 16) / 2 ** 52
        n, below = 0, math.exp(-rate)
        while rate > 0 and below <= u:
            n += 1
            below += math.exp(n * math.log(rate) - rate - math.lgamma(n + 1))
        out += [(i, source, k) for k in range(1, n + 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("weights,budget", [(None, 1.0), ({"a": 3.0, "b": 1.0}, 2.0), ({"missing": 1.0}, 1.0), (None, 30.0)])
def test_copies_equal_direct_inversion(spark, weights, budget):
    rng = random.Random(4)
    rows = [(i, "t" * rng.randrange(50), rng.choice("aaaab")) for i in range(200)]
    rows += [(None, "nn", None), (7, "again", "a"), (7, "again", "a"), (900, None, "empty"), (901, "", "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs, weights, budget)
    assert found.columns == ["doc_id", "text", "source", "copy"]
    assert sorted(((r["doc_id"], r["source"], r["copy"]) for r in found.collect()), key=repr) == copies(rows, weights, budget)


def test_mass_comes_near_the_target_and_order_is_mixed(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").selectExpr("doc_id", "text", "case when doc_id % 3 = 0 then 'hot' else source end as source")
    found = mixing.mix(docs).selectExpr("doc_id", "source", "length(text) as n").collect()
    total = sum(r["n"] for r in found)
    mass = Counter()
    for r in found:
        mass[r["source"]] += r["n"]
    assert max(mass.values()) / total < 1.35 / len(mass) and min(mass.values()) / total > 0.65 / len(mass)
    ids = [r["doc_id"] for r in found]
    assert sum(a < b for a, b in zip(ids, ids[1:])) / len(ids) == pytest.approx(0.5, abs=0.03)


def test_empty_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "abc", "s", 5, 6)], "doc_id long, text string, source string, rate int, copies int")
    assert mixing.mix(docs.limit(0)).collect() == []
    assert mixing.mix(docs).columns == [*docs.columns, "copy"]
    clash = docs.withColumnRenamed("copies", "copy")
    assert mixing.mix(clash).columns == clash.columns and mixing.mix(clash, copy_column=None).first()["copy"] == 6
    assert lines.dedup_lines(docs.withColumnRenamed("rate", "line_counts")).columns == ["doc_id", "text", "source", "copies", "line_counts"]

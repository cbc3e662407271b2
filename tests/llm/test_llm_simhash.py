"""SimHash groups against all pairs, the covering code, and components against a plain search."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from shoalgrid.llm import graph
from shoalgrid.llm import simhash as s


def fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, bits):
    """Index of the group of each print, over all pairs."""
    group = list(range(len(prints)))
    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= bits and group[i] != group[j]:
            old = group[j]
            group = [group[i] if g == old else g for g in group]
    return group


def expected(rows, bits=2):
    prints = [fingerprint(t) for _, t in rows]
    group = groups(prints, bits)
    ids = {}
    for (i, _), g in zip(rows, group):
        ids.setdefault(g, []).append(i)
    least = {g: min((i for i in x if i is not None), default=None) for g, x in ids.items()}
    return sorted(((i, f"{p:016x}", least[g]) for (i, _), p, g in zip(rows, prints, group)), key=repr)


def test_near_pairs_meet_at_an_anchor():
    rng = random.Random(3)
    masks = s.anchor_masks(2)
    assert max(map(len, masks)) == 32

    def anchors(p):
        base = p & ((1 << 63) - 1)
        return {base ^ int(m) for m in masks[int(s.syndromes(np.array([p], dtype=np.uint64))[0])]}

    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for p in rng.sample(range(64), rng.choice((1, 2))):
            b ^= 1 << p
        assert anchors(a) & anchors(b)


def test_groups_equal_all_pairs(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefg", k=3)) for _ in range(40)]
    rows = []
    for i in range(60):
        text = " ".join(rng.choices(words, k=150))
        rows.append((len(rows), text))
        for _ in range(rng.randrange(4)):
            parts = text.split()
            parts[rng.randrange(150)] = rng.choice(words)
            text = " ".join(parts)
            rows.append((len(rows), text.upper() if rng.random() < 0.3 else text))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (None, rows[0][1]), (None, "only here"), (3, rows[3][1]), (1003, "one"), (1004, "One")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, s.near_duplicates(docs).collect()), key=repr)
    assert found == expected(rows)
    assert len({r[2] for r in found}) < len({r[1] for r in found})


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert sorted(map(tuple, s.near_duplicates(docs).collect()), key=repr) == expected([tuple(r) for r in docs.collect()])


def test_one_of_each_group_stays_with_its_columns(spark):
    rows = [(5, "a b c d e f", "x", 1), (2, "A b c d e f", "y", 2), (None, "a b c d e f", "z", 3), (9, "other words are here now", "u", 4), (9, "other words are here now", "u", 5),
            (None, "nobody has this id at all", None, 6), (None, "nobody has this id at all", None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, root int")
    kept = s.keep_one(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert sorted((r["doc_id"] or 0, r["fp"] or "") for r in found) == [(0, ""), (2, "y"), (9, "u")]
    assert s.keep_one(docs.limit(0)).count() == 0 and s.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_other_thresholds(bits):
    rng = random.Random(bits)
    prints = [rng.getrandbits(64) for _ in range(12)]
    prints += [p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for p in prints]
    links = s.group_links(np.array(prints, dtype=np.uint64), bits)
    want = groups(prints, bits)
    got = list(range(len(prints)))
    for a, b in links:
        got = [got[a] if g == got[b] else g for g in got]
    assert {frozenset(i for i, g in enumerate(got) if g == k) for k in got} == {frozenset(i for i, g in enumerate(want) if g == k) for k in want}


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(200, 260)] + [(0, i) for i in range(1, 100)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(5, None), (7, 7)]
    node = {x: x for a, b in links if b is not None for x in (a, b)}
    for _ in range(len(node)):
        before = dict(node)
        for a, b in links:
            if b is not None:
                node[a] = node[b] = min(node[a], node[b])
        if before == node:
            break
    found = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    alone = {x for x in node if all(x not in p or p[0] == p[1] for p in links)}
    assert found == {k: v for k, v in node.items() if k not in alone}

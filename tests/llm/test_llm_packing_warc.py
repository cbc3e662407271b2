"""Packing against a plain search over all bins; archives read back, in any split."""

import gzip
import hashlib
import io
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoalgrid.llm import packing, warc
from shoalgrid.session import scratch_path


def plain_best_fit(items, capacity):
    bins, out = [], []
    for size, source, cluster in items:
        fits = [(capacity - b["n"], i) for i, b in enumerate(bins)
                if capacity - b["n"] >= size and (source is None or source not in b["s"]) and (cluster is None or cluster not in b["c"])]
        at = min(fits)[1] if fits else len(bins)
        if at == len(bins):
            bins.append({"n": 0, "s": set(), "c": set()})
        out.append((at, bins[at]["n"]))
        bins[at]["n"] += size
        bins[at]["s"].add(source)
        bins[at]["c"].add(cluster)
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.sampled_from([None, "a", "b", "c"]), st.sampled_from([None, 1, 2, 3, 4, 5])), max_size=60))
def test_tightest_compatible_bin(items):
    assert packing.best_fit(items, 20) == plain_best_fit(items, 20)


@pytest.mark.parametrize("group", [8192, 100])
def test_every_token_is_packed_once_without_conflicts(spark, group):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id", "text", "case when doc_id % 3 = 0 then 'hot' else source end as source")
    docs = docs.unionByName(spark.createDataFrame([(None, None, None), (5000, "", "s"), (5000, "", "s"), (5001, "w " * 5000, "s")], docs.schema))
    rows = packing.pack(docs, group=group).collect()
    need = Counter({r["doc_id"]: 0 for r in docs.collect()})
    for r in docs.collect():
        need[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) + 1
    got, bins = Counter(), defaultdict(list)
    for r in rows:
        got[r["doc_id"]] += r["size"]
        bins[r["bin"]].append(r)
    assert got == need
    for own in bins.values():
        own.sort(key=lambda r: r["bin_start"])
        assert [r["bin_start"] for r in own] == [sum(x["size"] for x in own[:i]) for i in range(len(own))]
        assert sum(r["size"] for r in own) <= packing.CAPACITY
        sources = [r["source"] for r in own if r["source"] is not None]
        assert len(set(sources)) == len(sources) and len({r["cluster"] for r in own}) == len(own)
    assert packing.pack(docs.limit(0)).collect() == []


PAGES = [(1, "https://x.org/a b\r\nX: y", "h" * 1000), (5, "https://x.org/é", "h" * 1000), (3, None, "h" * 1000), (4, "u", "h" * 999), (6, "u", "h" * 999), (7, "u", None), (8, "u", ""),
         (None, "u", "n" * 2000), (None, "u", "n" * 2000), (9, "u", "WARC/1.1\r\n\r\n é" * 3000), (10, "u", "r" * 1200), (10, "u", "r" * 1200), (2, "u", "r" * 1200)]


def facts(pages):
    best = {}
    for i, _, html in pages:
        if len((html or "").encode()) >= 1000:
            best[html] = max([x for x in (best.get(html), i) if x is not None], default=None)
    out = []
    for i, _, html in pages:
        data, keeper = (html or "").encode(), best.get(html)
        again = keeper is not None and i != keeper
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", keeper if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split", [37, 4096, 8 << 20])
def test_round_trip_in_any_split(spark, split):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    written = warc.write_warc(pages, path).collect()
    assert sum(r["records"] for r in written) == len(PAGES)
    records = warc.read_warc(spark, path, split)
    assert sorted(map(tuple, warc.page_facts(records).collect()), key=repr) == facts(PAGES)
    rows = records.collect()
    assert all((r["payload"] == b"") or r["record_type"] == "response" for r in rows)
    assert sorted(r["payload"].decode() for r in rows if r["record_type"] == "response" and r["page_id"] == 9) == [PAGES[9][2]]
    for f in Path(path).glob("*.warc.gz"):  # plain gzip reads the members one after another
        data = gzip.decompress(f.read_bytes())
        assert data.count(b"WARC-Record-ID: ") == sum(r["path"].endswith(f.name) for r in rows)
        assert b"\nX: y" not in data


def test_false_magic_and_broken_members():
    good = [warc.record(i, "u", bytes([65 + i]) * 50, hashlib.sha1(bytes([65 + i]) * 50).hexdigest(), None) for i in range(3)]
    other = gzip.compress(b"not an archive")
    data = warc.MAGIC + b"junk" + good[0] + other + good[1][:-20] + warc.MAGIC + good[2]
    for split in (1, 7, 100, len(data)):
        found = [p["payload"][:1] for a in range(0, len(data), split) for _, p in warc.records_in(io.BytesIO(data), len(data), a, min(a + split, len(data)))]
        assert found == [b"A", b"C"]


def test_empty_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string, digest string")
    path = scratch_path(spark, "warc-empty")
    warc.write_warc(pages, path)
    Path(path).mkdir(parents=True, exist_ok=True)
    assert warc.page_facts(warc.read_warc(spark, path)).collect() == []

"""Quality rules against direct counts, the learnt verdict on held-out labels, and odd tables."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoalgrid.llm import quality as q

SF = "/root/testdata/sf0.01"


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t#| \x00", max_size=60), min_size=1, max_size=6))
def test_base_counts_equal_direct_ones(texts):
    found = q.judge([t.encode() for t in texts], None, 0.5)
    assert list(zip(*[found[f].tolist() for f in q.FIELDS])) == [counts(t) for t in texts]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = q.quality_rows(docs, labels).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = counts(texts[r["doc_id"]])
        assert tuple(r[f] for f in q.FIELDS) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["probability"] >= q.THRESHOLD)
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in rows if r["kept"])


def test_verdict_on_labels_that_were_not_learnt(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    learnt = {r["doc_id"] for r in q.labelled_sample(docs, labels, q.SAMPLE, "doc_id", "text", "quality").select("doc_id").collect()}
    assert len(learnt) == q.SAMPLE
    verdict = {r["doc_id"]: r for r in q.quality_rows(docs, labels).collect()}
    rest = [r for r in labels.collect() if r["doc_id"] not in learnt]
    good = [verdict[r["doc_id"]] for r in rest if r["quality"] == 1 and not verdict[r["doc_id"]]["base_failed"]]
    bad = [verdict[r["doc_id"]] for r in rest if r["quality"] == 0]
    assert np.mean([r["kept"] for r in good]) > 0.995
    assert np.mean([not r["kept"] for r in bad]) > 0.97


def test_features_and_scores_agree():
    batch = q.Batch([b"One two three one two.", b"", "äöü ab".encode(), b"x"])
    weights = np.random.default_rng(0).normal(size=(1 + len(q.GRAMS)) << q.BITS).astype(np.float32)
    want = [float((weights[i] * v).sum()) for i, v in batch.features()]
    assert batch.scores(weights) == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_odd_tables(spark):
    schema = "doc_id long, text string, batch int, kept string"
    rows = [(1, None, 1, "a"), (1, "", 2, "b"), (None, "w " * 12, 3, "c"), (2, "x" * 300_000, 4, None), (1, None, 1, "a")]
    docs = spark.createDataFrame(rows, schema)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = sorted(map(tuple, q.quality_rows(docs, none).select("doc_id", "n_words", "base_failed", "kept", "probability").collect()), key=repr)
    assert found == sorted([(1, 0, True, False, None), (1, 0, True, False, None), (1, 0, True, False, None), (2, 1, True, False, None), (None, 12, True, False, None)], key=repr)
    assert q.keep_good(docs, none).columns == docs.columns
    assert q.quality_rows(docs.limit(0), none).count() == 0
    nulls = spark.createDataFrame([(None, 1), (1, None), (1, 0), (1, 1)], "doc_id long, quality int")
    assert q.quality_rows(docs, nulls).count() == 5


def test_five_byte_grams_and_few_bad_texts_kept_at_one_half(spark):
    (bucket, value), = q.Batch([b"abcde"]).features()
    assert np.bincount(bucket >> q.BITS).tolist() == [1, 3, 2, 1]
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    learnt = {r["doc_id"] for r in q.labelled_sample(docs, labels, q.SAMPLE, "doc_id", "text", "quality").select("doc_id").collect()}
    kept = {r["doc_id"]: r["kept"] for r in q.quality_rows(docs, labels, threshold=0.5).collect()}
    bad = [kept[r["doc_id"]] for r in labels.collect() if r["quality"] == 0 and r["doc_id"] not in learnt]
    assert np.mean(bad) < 0.02


def test_pieces_of_the_fit_do_not_change_it(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["good", "words", "here"] if i % 3 else ["bad", "junk", "here"], 30)).encode() for i in range(40)]
    buckets, amounts = zip(*q.Batch(texts).features())
    labels = np.array([int(i % 3 > 0) for i in range(40)])
    whole = q.fit(labels, buckets, amounts)
    monkeypatch.setattr(q, "_PIECE", 100)
    parts = q.fit(labels, buckets, amounts)
    assert parts[0] == pytest.approx(whole[0], abs=1e-3) and parts[1:] == pytest.approx(whole[1:], rel=1e-2)


def test_sample_features_take_little_memory_and_stay_those_of_the_batch():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(3)
    texts = ["".join(chr(c) for c in rng.integers(97, 123, 3000)) + " \u00e9 word " * (i % 5) for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts), pa.array([1] * 300)], ["doc_id", "text", "label"])
    want = q.Batch([t.encode() for t in texts]).features()
    tracemalloc.start()
    found = 0
    for part in q._sample_features(iter([batch])):
        for row in part.to_pylist():
            bucket, value = want[int(row["doc_id"])]
            assert row["buckets"] == bucket.tobytes() and row["amounts"] == value.tobytes()
            found += 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 300
    assert peak < 60e6  # 230 MB over the whole batch

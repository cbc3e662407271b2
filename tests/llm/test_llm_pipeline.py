"""The pipeline stage by stage against plain versions of each, and its registration."""

from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from shoalgrid.llm import packing, quality
from shoalgrid.llm.common import stage
from test_llm_lines_mixing import copies, without_later_copies
from test_llm_simhash import fingerprint, groups

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_each_stage_on_what_the_one_before_it_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fields = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    verdict = {r["doc_id"]: r["kept"] for r in quality.quality_rows(docs, labels).collect()}
    steps = dict(pipeline.STAGES)

    good = stage(steps["quality rules"](spark, docs, SF), "good")
    assert good.columns == fields and rows(good, "doc_id") == sorted(((i,) for i, k in verdict.items() if k), key=repr)

    cut = stage(steps["line dedup"](spark, good, SF), "cut")
    want = without_later_copies([(r["doc_id"], r["text"]) for r in good.collect()], 2, 8)
    assert cut.columns == fields and rows(cut, "doc_id", "text") == sorted(want, key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())
    assert rows(cut, "text") != rows(good, "text")

    one = stage(steps["simhash near-dedup"](spark, cut, SF), "one")
    own = sorted((r["doc_id"], r["text"]) for r in cut.collect())
    group = groups([fingerprint(t) for _, t in own], 2)
    least = {}
    for (i, _), g in zip(own, group):
        least.setdefault(g, i)
    assert one.columns == fields and rows(one, "doc_id") == sorted(((i,) for i in least.values()), key=repr)

    mixed = stage(steps["source mixing"](spark, one, SF), "mixed")
    made = copies([(r["doc_id"], r["text"], r["source"]) for r in one.collect()], None, 1.0)
    assert mixed.columns == fields and Counter(r["doc_id"] for r in mixed.collect()) == Counter(i for i, _, _ in made)

    packed = steps["best-fit packing"](spark, mixed, SF).collect()
    bins = defaultdict(list)
    for r in packed:
        bins[r["bin"]].append(r)
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in mixed.collect())
    assert all(sum(r["size"] for r in b) <= packing.CAPACITY and len({r["source"] for r in b}) == len(b) == len({r["cluster"] for r in b}) for b in bins.values())
    assert len(packed) == pipeline.run(spark, SF).count()


def test_empty_and_odd_documents(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    text = " ".join(f"word{i} is here" for i in range(30))
    odd = [(None, text, "en", None, None), (1, None, None, None, 0), (2, "", "en", "s", 0), (3, text, "en", "s", len(text)), (3, text, "en", "s", len(text)), (4, "Other " * 3 + text * 2, "de", "t", 9)]
    for data in (odd, []):
        docs = spark.createDataFrame(data, schema)
        for number, (_, step) in enumerate(pipeline.STAGES, 1):
            out = step(spark, docs, SF)
            assert number == len(pipeline.STAGES) or out.columns == schema.names
            docs = out if number == len(pipeline.STAGES) else stage(out, "odd")
        assert (docs.count() > 0) == bool(data)


def test_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(entry.oracle_sql()) <= names


def test_queries_equal_their_sql(spark):
    from check import compare, connect

    from shoalgrid.llm.queries import ORACLES, QUERIES

    con = connect("/root/testdata/sf0.01")
    for name, sql in ORACLES.items():
        assert compare(spark, con, "/root/testdata/sf0.01", QUERIES[name], sql) == "", name

"""One query per corpus operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shoalgrid.llm import align, ann, centroids, jaccard, lines, lm, mixing, packing, pii, quality, simhash, suffix, warc
from shoalgrid.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op9_suffix_array_dedup")
def op9(spark, sf):
    return suffix.remove_repeats(table(spark, sf, "documents"))


@query("op6_simhash")
def op6(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query("op1_quality_rules")
def op1(spark, sf):
    return quality.quality_rows(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op7_pii")
def op7(spark, sf):
    return pii.personal_data(table(spark, sf, "documents"))


@query("op8_lm_scoring")
def op8(spark, sf):
    return lm.score_texts(table(spark, sf, "documents"))


@query("op4_line_dedup", lines.SQL)
def op4(spark, sf):
    return lines.dedup_lines(table(spark, sf, "documents")).select("doc_id", "text", "line_counts.n_lines", "line_counts.n_removed")


@query("op10_source_mixing", mixing.SQL)
def op10(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


@query("op5_best_fit_packing")
def op5(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


@query("op3_warc", warc.SQL)
def op3(spark, sf):
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf, "pages"), path)
    return warc.page_facts(warc.read_warc(spark, path))


@query("op2_nearest_neighbours")
def op2(spark, sf):
    return ann.neighbours(table(spark, sf, "embeddings"))


@query("op13_centroid_clustering")
def op13(spark, sf):
    return centroids.cluster(table(spark, sf, "embeddings"))


@query("op12_ngram_jaccard_join")
def op12(spark, sf):
    return jaccard.jaccard_components(table(spark, sf, "documents"))


@query("op11_cross_tokenizer_alignment")
def op11(spark, sf):
    return align.align(table(spark, sf, "documents"))

"""Corpus pipeline: documents become packed training sequences, stage by stage.

Quality rules drop bad documents, line dedup cuts later copies of repeated line runs out of the texts (and corrects n_chars),
one document of each group of near-duplicates stays, sources are replicated to equal shares, and what is
left is packed into bins. Each stage gets what the one before it wrote and returns the columns of
``documents``, but for the last one, which returns the places of the pieces of each document.

Nulls, empty texts and repeated rows are treated as the operators say; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalgrid.llm import lines, mixing, packing, quality, simhash
from shoalgrid.llm.common import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(docs, counts_column="__line_counts")
    return cut.withColumn("n_chars", F.when(F.col("__line_counts.n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, words=3, max_bits=2)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, copy_column=None)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("source mixing", source_mixing),
    ("best-fit packing", packing_stage),
]

#: None: the learnt quality rules and the packing are not expressible in SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, step) in enumerate(STAGES, 1):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stage(docs, name.replace(" ", "-"))
    return docs

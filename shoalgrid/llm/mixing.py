"""Mixing sources to target weights by Poisson replication. DataFrame functions only.

The repetition rate of a source is its target share of the mass (code points) over its own mass. Each
document's number of copies is the inverse of the Poisson distribution with this mean at a uniform number
made from a hash of seed, id and text. Documents are exploded by that number and dealt out again by a
hash of document and copy: to random partitions, in random order within them.

The table of rates has one row per source. It is written first, so its size is known from its files and
Spark sends it to all tasks only below its broadcast limit; beyond it the join is a shuffle whose hot
keys adaptive execution splits.

Defined cases: a null source is a source of its own; a null text has no mass, a null id hashes as empty;
without weights all sources get the same share; a source that is missing from the given weights gets
none; sources without any mass get rate 1, as they cost nothing; repeated rows get equal numbers of
copies; an empty table gives an empty result; other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoalgrid.llm.common import stage

SEED = 17


def _uniform(*parts) -> Column:
    """Number in [0, 1) from the first 52 bits of the MD5 of the parts, joined by bars."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_steps(rates: DataFrame) -> DataFrame:
    """(source, steps) of (source, rate): the distribution function at 0, 1, ... until it is 1 in double precision.

    As long as the rate, so in all no longer than the copies to be made; rate 0 gives [1].
    """
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 40).cast("int")
    every = rates.select("source", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    up_to = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    log_factorial = F.sum(F.log(F.greatest("k", F.lit(1)).cast("double"))).over(up_to)
    term = F.when(F.col("rate") > 0, F.exp(F.col("k") * F.log("rate") - F.col("rate") - log_factorial)).otherwise((F.col("k") == 0).cast("double"))
    below = every.withColumn("term", term).withColumn("below", F.sum("term").over(up_to))
    listed = below.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("k", "below"))).alias("steps"))
    return listed.select("source", F.transform("steps", lambda x: x["below"]).alias("steps"))


def source_rates(docs: DataFrame, weights: dict[str, float] | None, budget: float, source_column: str, text_column: str) -> DataFrame:
    """(source, rate): the mean number of copies of each source's documents."""
    mass = docs.groupBy(F.col(source_column).alias("source")).agg(F.coalesce(F.sum(F.length(text_column)), F.lit(0)).alias("mass"))
    if weights is None:
        share = F.lit(1.0)
    else:
        share = F.lit(0.0)
        for name, w in weights.items():
            share = F.when(F.col("source") == F.lit(name), float(w)).otherwise(share)
    own = stage(mass.withColumn("share", F.when(F.col("mass") > 0, share).otherwise(0.0)), "mass")
    total = own.agg(F.coalesce(F.sum("share"), F.lit(0.0)), F.coalesce(F.sum("mass"), F.lit(0))).first()
    goal = budget * float(total[1]) / (total[0] or 1.0)
    return own.select("source", F.when(F.col("mass") > 0, F.col("share") * goal / F.col("mass")).otherwise(1.0).alias("rate"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, budget: float = 1.0, seed: int = SEED, id_column: str = "doc_id",
        source_column: str = "source", text_column: str = "text", copy_column: str | None = "copy") -> DataFrame:
    """Copies of the documents in random order, numbered from 1 in ``copy_column`` (None: not numbered).

    ``budget`` is the mass wanted over the mass given. A column of the documents that has the name of ``copy_column`` is replaced.
    """
    rates = source_rates(docs, weights, budget, source_column, text_column)
    steps = stage(poisson_steps(rates).select(F.struct("source").alias("__source"), F.col("steps").alias("__steps")), "steps")
    key = [F.lit(str(seed)), F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_column), F.lit("")).cast("binary"))]
    packed = docs.select(F.struct("*").alias("__doc"), F.struct(F.col(source_column).alias("source")).alias("__source"), F.concat_ws("|", *key).alias("__key"))
    found = packed.join(steps, "__source")
    copies = F.size(F.filter("__steps", lambda c: c <= _uniform("__key")))
    dealt = found.where(copies > 0).select("__doc", "__key", F.explode(F.sequence(F.lit(1), copies)).alias("__copy"))
    order = F.md5(F.concat_ws("|", "__key", F.col("__copy").cast("string")).cast("binary"))
    shuffled = dealt.withColumn("__order", order).repartition("__order").sortWithinPartitions("__order")
    own = [F.col("__doc")[c].alias(c) for c in docs.columns if c != copy_column]
    return shuffled.select(*own, *([F.col("__copy").alias(copy_column)] if copy_column else []))


#: The same rows over ``documents`` with equal weights, in DuckDB's SQL.
SQL = """
WITH m AS (SELECT source, coalesce(sum(length(text)), 0) AS mass FROM documents GROUP BY source),
g AS (SELECT sum(mass) / greatest(count(*) FILTER (WHERE mass > 0), 1) AS goal FROM m),
r AS (SELECT source, CASE WHEN mass > 0 THEN goal::DOUBLE / mass ELSE 1 END AS rate FROM m, g),
k AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT + 1)) AS k FROM r),
c AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS below FROM k),
a AS (SELECT source, list(below ORDER BY k) AS steps FROM c GROUP BY source),
u AS (SELECT d.*, ('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u FROM documents d),
n AS (SELECT u.*, len(list_filter(a.steps, lambda x: x <= u.u)) AS n FROM u JOIN a ON u.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, n + 1))::INTEGER AS copy FROM n"""

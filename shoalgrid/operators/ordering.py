"""Row numbers and previous rows inside groups of any size.

A group is cut into blocks of positions, so no task ever holds more than a block of rows of one
group (or the list of block counts of one group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoalgrid.operators.skew import lookup

BLOCK = 1 << 20


def rank_by_position(df: DataFrame, group: list[str], pos: str, name: str, block: int = BLOCK) -> DataFrame:
    """Number the rows of each group from 1 by the unique whole number ``pos``."""
    keys = [*group, "__block"]
    cut = df.withColumn("__block", F.call_function("div", F.col(pos), F.lit(block)))
    before = W.partitionBy(*(group or [F.lit(0)])).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    inside = F.row_number().over(W.partitionBy(*keys).orderBy(pos))
    return (
        cut.withColumn("__inside", inside)
        .join(offsets, keys)
        .withColumn(name, F.col("__before") + F.col("__inside"))
        .drop("__block", "__inside", "__before")
    )


def with_previous(df: DataFrame, group: list[str], pos: str, value: str, name: str, block: int = BLOCK) -> DataFrame:
    """Add the value of the row before, in order of ``pos`` inside the group; null for the first.

    Group columns must not be null. The pairs meet by an equi-join on (group, row number).
    """
    ranked = rank_by_position(df, group, pos, "__rank", block)
    shifted = ranked.select(*group, (F.col("__rank") + 1).alias("__rank"), F.col(value).alias(name))
    return ranked.join(shifted, [*group, "__rank"], "left").drop("__rank")


def ingest_positions(df: DataFrame, path: str, row: str, name: str) -> DataFrame:
    """Stable row positions from (file, row in file): files in name order, rows in file order.

    Only one count per file is gathered; the rows themselves are not sorted, and not shuffled either
    while the list of files is small enough to be broadcast.
    """
    before = W.partitionBy(F.lit(0)).orderBy(path).rowsBetween(W.unboundedPreceding, -1)
    starts = (
        df.groupBy(path)
        .agg((F.max(row) + 1).alias("__n"))
        .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    return lookup(df, starts, [path], "inner").withColumn(name, F.col("__start") + F.col(row)).drop("__start")

"""Look-up joins that stay balanced when one key holds a large share of the rows, and rows dealt out for costly work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``left``, whose keys may be badly skewed, to ``right`` with one row per key.

    Adaptive execution splits a skewed partition of the left side over many tasks, but only if
    both sides come straight out of a shuffle made for the join. A right side that was just grouped
    by the key would skip that shuffle and lose the split. Joining on the keys and on a hash of them
    gives both sides a shuffle of their own; small right sides are still broadcast by size.
    """
    both = [*keys, "__h"]
    hashed = F.xxhash64(*keys)
    return left.withColumn("__h", hashed).join(right.withColumn("__h", hashed), both, how).drop("__h")


def _parts(df: DataFrame) -> int:
    """A few parts per core, and no more than the session wants."""
    spark = df.sparkSession
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(24, 3 * spark.sparkContext.defaultParallelism))


def deal_out(rows: DataFrame) -> DataFrame:
    """Rows spread evenly for costly work on each of them, as a small file of many rows comes to one task.

    Dealt by a hash of whole rows, which needs no sort; adaptive execution would join parts by their bytes,
    which say little about the work in them.
    """
    hashed = [F.col(f"`{name}`") for name, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    return rows.repartition(_parts(rows), F.xxhash64(*hashed)) if hashed else rows.repartition(_parts(rows))


def deal_by(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys to a few parts per core, for a join or grouping by these keys.

    Adaptive execution joins the parts of its own shuffles until there is one per core or fewer, so that one
    task would sort or hold several times as much.
    """
    return rows.repartition(_parts(rows), *keys)


def sort_in_parts(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows in order over a few parts per core; see ``deal_by``."""
    return rows.repartitionByRange(_parts(rows), *keys).sortWithinPartitions(*keys)

"""Registry of queries and the inputs they share.

An input is one SELECT over the driver's tables, written so that Spark and DuckDB both read it;
``@name`` stands for a table. The operator under test is never part of an input.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
INPUTS: dict[str, str] = {}


def query(name: str, sql: str | None = None, inputs: tuple[str, ...] = ()):
    """Register a query; ``sql`` may use the named inputs as tables."""
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = with_inputs(sql, inputs)
        return fn
    return register


def with_inputs(sql: str, names: tuple[str, ...]) -> str:
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({re.sub(r'@(\w+)', r'\1', INPUTS[n])})" for n in names)
    joiner = ",\n" if sql.lstrip().upper().startswith("WITH ") else "\n"
    body = sql.lstrip()[5:] if joiner == ",\n" else sql
    return f"WITH {ctes}{joiner}{body}"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def made(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Input as DataFrame; its tables come in as views named after the folder."""
    text = INPUTS[name]
    tag = re.sub(r"\W", "_", sf)
    for t in set(re.findall(r"@(\w+)", text)):
        table(spark, sf, t).createOrReplaceTempView(f"{t}{tag}")
    return spark.sql(re.sub(r"@(\w+)", lambda m: m.group(1) + tag, text))


_KEY = "cast(c.c_custkey AS string)"
INPUTS["layers"] = f"""
SELECT c.c_custkey AS pos, {_KEY} AS id, c.c_name AS name, r.r_name AS thematic_lot, n.n_name AS subtheme,
  CASE WHEN c.c_custkey % 11 = 0 THEN '' ELSE c.c_mktsegment END AS subsubtheme,
  'https://files.example.org/d' || cast(c.c_custkey % 97 AS string) || CASE c.c_custkey % 5
     WHEN 0 THEN '.zip' WHEN 1 THEN '.nc' WHEN 2 THEN '.parquet/' WHEN 3 THEN '.csv' ELSE '.html' END AS download_url,
  CASE c.c_custkey % 4 WHEN 0 THEN 'https://s3.example.org/store/' || {_KEY} || '.parquet'
     WHEN 1 THEN 'https://s3.example.org/store/' || {_KEY} || '.zip' END AS native_asset,
  CASE c.c_custkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END AS in_stac,
  CASE WHEN c.c_custkey % 6 <> 0 THEN 'product ' || {_KEY} END AS native_data_product,
  cast(c.c_custkey % 340 AS double) - 170e0 AS west, cast(c.c_custkey % 160 AS double) / 2e0 - 80e0 AS south,
  c.c_acctbal AS balance, c.c_nationkey AS nationkey
FROM @customer c JOIN @nation n ON c.c_nationkey = n.n_nationkey JOIN @region r ON n.n_regionkey = r.r_regionkey"""

INPUTS["state_rows"] = """
SELECT o_orderkey AS pos, cast(o_custkey AS string) AS id,
  CASE WHEN o_orderstatus = 'F' THEN 'https://files.example.org/moved' ELSE
   'https://files.example.org/d' || cast(o_custkey % 97 AS string) || CASE o_custkey % 5
     WHEN 0 THEN '.zip' WHEN 1 THEN '.nc' WHEN 2 THEN '.parquet/' WHEN 3 THEN '.csv' ELSE '.html' END END AS download_url,
  CASE WHEN o_orderpriority <> '5-LOW' THEN 'https://s3.example.org/prev/' || cast(o_orderkey AS string) || '.parquet' END AS native_asset,
  o_orderstatus AS status
FROM @orders"""

# Four kinds of metadata rows per layer, with repeated kinds, from the orders of a customer.
INPUTS["metadata_rows"] = """
SELECT cast(o_custkey AS string) AS id, o_orderkey AS pos,
  CASE o_orderkey % 4 WHEN 0 THEN 'download_url' WHEN 1 THEN 'geonetwork_uri' WHEN 2 THEN 'product_info' ELSE 'other' END AS metadata_type,
  'v' || cast(o_orderkey AS string) || o_orderstatus AS metadata_value
FROM @orders"""

_X = {
    "x1": "cx - w", "y1": "cy - h", "x2": "cx + w", "y2": "cy - h * 0.5e0",
    "x3": "cx + w * 0.7e0", "y3": "cy + h", "x4": "cx - w * 0.6e0", "y4": "cy + h * 0.8e0",
    "x5": "cx - w * 0.2e0", "y5": "cy - h * 0.1e0", "x6": "cx + w * 0.3e0", "y6": "cy", "x7": "cx", "y7": "cy + h * 0.4e0",
}
# One four-cornered polygon with a three-cornered hole per part.
INPUTS["corners"] = (
    "SELECT feature_id, brand, kind, size, price, " + ", ".join(f"{v} AS {k}" for k, v in _X.items())
    + """ FROM (SELECT p_partkey AS feature_id, p_brand AS brand, p_size AS size, p_retailprice AS price,
  CASE p_size % 9 WHEN 0 THEN ' ' WHEN 1 THEN 'nan' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE p_type END AS kind,
  cast(p_partkey * 7919 % 3499 AS double) / 10e0 - 172.3e0 AS cx,
  cast(p_partkey * 104729 % 1693 AS double) / 10e0 - 83.7e0 AS cy,
  1.37e0 + cast(p_size AS double) / 10e0 AS w, 0.93e0 + cast(p_size AS double) / 14e0 AS h FROM @part) p"""
)
INPUTS["readings"] = """
SELECT event_id, user_id, event_type AS variable, value, ts AS time,
  cast(user_id % 37 AS double) * 0.25e0 + 40e0 AS latitude, cast(user_id % 53 AS double) * 0.5e0 - 10e0 AS longitude
FROM @events"""

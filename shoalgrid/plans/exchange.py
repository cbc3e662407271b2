"""Exchange with other stores: harvest of dataset pages, sync plan, published features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalgrid.functions.text import first_binary_link, grid_names
from shoalgrid.operators.extents import global_attributes
from shoalgrid.operators.skew import lookup

# Global attributes a harvest reads and the columns they become.
GLOBALS = {
    "geospatial_lon_min": "west", "geospatial_lon_max": "east", "geospatial_lat_min": "south",
    "geospatial_lat_max": "north", "time_coverage_start": "start", "time_coverage_end": "end",
}


def harvest(index: DataFrame, info: DataFrame, descriptors: DataFrame, directories: DataFrame) -> DataFrame:
    """One row per dataset of the index that has an info document.

    ``info``: dataset, pos, scope, attribute, value. ``descriptors``: dataset, dds.
    ``directories``: dataset, html. A missing attribute stays null.
    """
    facts = global_attributes(info, list(GLOBALS)).withColumnsRenamed(GLOBALS)
    known = info.select("dataset").distinct()
    variables = descriptors.select("dataset", grid_names(F.col("dds")).alias("variables"))
    links = directories.select("dataset", first_binary_link(F.col("html")).alias("__href"))
    return (
        index.join(known, "dataset")
        .join(facts, "dataset", "left")
        .join(variables, "dataset", "left")
        .join(links, "dataset", "left")
        .withColumn("download_url", F.concat("directory", "__href"))
        .drop("__href")
    )


def sync_plan(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Action per key: upload if new or newer here, delete if only there, else keep.

    Both sides: key, modified.
    """
    here = local.select("key", F.col("modified").alias("local_modified"))
    there = remote.select("key", F.col("modified").alias("remote_modified"))
    action = (
        F.when(F.col("local_modified").isNull(), "delete")
        .when(F.col("remote_modified").isNull(), "upload")
        .when(F.col("local_modified") > F.col("remote_modified"), "upload")
        .otherwise("keep")
    )
    return here.join(there, "key", "full_outer").withColumn("action", action)


def only_remote(local: DataFrame, remote: DataFrame) -> DataFrame:
    return remote.join(local.select("key"), "key", "left_anti").select("key")


def match_features(items: DataFrame, features: DataFrame) -> DataFrame:
    """Published features whose product id is the id of a local item."""
    local = items.select(F.col("item_id").alias("product_id")).distinct()
    return lookup(features, local, ["product_id"], "left_semi")

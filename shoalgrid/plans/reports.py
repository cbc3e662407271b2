"""Reports over the layers: attribute table, portal table, transformation table, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalgrid.operators.extents import metadata_columns
from shoalgrid.operators.select import omit_lots
from shoalgrid.plans.catalogue import mapped_variables

_BASE = {
    "id": "id", "subtheme": "variable_family", "subsubtheme": "collection", "name": "collection_item",
    "download_url": "download_url", "native_asset": "native_asset_url", "native_data_product": "data_product",
}


def attribute_flags(mapped: DataFrame, asset_variables: DataFrame, published: DataFrame) -> DataFrame:
    """Flags per (layer, variable): present in the converted assets, present in the catalogue."""
    in_assets = asset_variables.select("id", F.col("name").alias("variable")).distinct().withColumn("__a", F.lit(True))
    in_catalogue = published.select("id", "variable").distinct().withColumn("__c", F.lit(True))
    return (
        mapped.join(in_assets, ["id", "variable"], "left")
        .join(in_catalogue, ["id", "variable"], "left")
        .withColumn("in_arco", F.col("__a").isNotNull())
        .withColumn("in_stac", F.col("__c").isNotNull())
        .drop("__a", "__c")
    )


def attribute_table(layers: DataFrame, asset_variables: DataFrame, published: DataFrame) -> DataFrame:
    """Layer x mapped variable with its flags; one blank row for layers without a mapping."""
    base = [F.coalesce(F.col(k), F.lit("")).alias(v) for k, v in _BASE.items()]
    flagged = attribute_flags(
        mapped_variables(layers.filter(F.col("native_arco_mapping").isNotNull())), asset_variables, published
    ).select(
        *base, F.col("native_variable").alias("updated_native_variable"),
        F.col("variable").alias("updated_arco_variable"), "in_arco", "in_stac",
    )
    blank = layers.filter(F.col("native_arco_mapping").isNull()).select(
        *base, F.lit("").alias("updated_native_variable"), F.lit("").alias("updated_arco_variable"),
        F.lit(False).alias("in_arco"), F.lit(False).alias("in_stac"),
    )
    return flagged.unionByName(blank)


def portal_table(layers: DataFrame, sources: DataFrame, omitted: list[str]) -> DataFrame:
    """Portal layers outside the omitted lots, with their download link."""
    links = metadata_columns(sources, {"download_url": "download_url"})
    return omit_lots(layers.drop("download_url"), omitted).join(links, "id", "left").select(
        "id", F.coalesce("thematic_lot", F.lit("")).alias("thematic_lot"), F.coalesce("name", F.lit("")).alias("title"),
        F.coalesce("subtheme", F.lit("")).alias("subtheme"), F.coalesce("subsubtheme", F.lit("")).alias("subsubtheme"),
        F.coalesce("download_url", F.lit("")).alias("download_url"),
    )


def transformation_table(portal: DataFrame, layers: DataFrame) -> DataFrame:
    """Portal layers with what the run made of them; nulls for layers it did not see."""
    made = layers.select(
        "id", F.coalesce("native_asset", F.lit("")).alias("native_asset"), F.col("subtheme").alias("family"),
        F.col("subsubtheme").alias("collection"), F.col("name").alias("collection_item"),
        F.coalesce("in_stac", F.lit("")).alias("in_stac"),
    )
    return portal.join(made, "id", "left")


def run_counters(layers: DataFrame) -> DataFrame:
    """Layers in the catalogue, layers to process, layers published."""
    done = F.coalesce(F.col("in_stac"), F.lit("no")) == "yes"
    return layers.agg(
        F.count(F.lit(1)).alias("layers"), F.count_if(~done).alias("to_process"), F.count_if(done).alias("published")
    )

"""Reuse of earlier results: joins of the current layers with the previous state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalgrid.operators.skew import lookup


def newest_rows(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """The last row per key by ``pos`` (a number or a struct, different in all rows of a key).

    Only keys and places are aggregated; whole rows are picked by a join on them.
    """
    last = df.groupBy(*keys).agg(F.max(pos).alias("__pos")).select(*[F.col(k).alias(f"__{k}") for k in keys], "__pos")
    same = [df[k].eqNullSafe(last[f"__{k}"]) for k in keys]
    return df.join(last, [*same, df[pos].eqNullSafe(last["__pos"])], "left_semi")


def forget(previous: DataFrame, ids: DataFrame) -> DataFrame:
    """Leave out the layers that must be made again; comes before the state is attached."""
    return previous.join(ids.select("id"), "id", "left_anti")


def attach_previous(layers: DataFrame, previous: DataFrame) -> DataFrame:
    """Previous state as columns ``prev_*``; one row per layer."""
    renamed = previous.select("id", *[F.col(c).alias(f"prev_{c}") for c in previous.columns if c != "id"])
    return layers.join(renamed, "id", "left")


def reuse_previous_asset(attached: DataFrame) -> DataFrame:
    """Take the previous native asset when the download link is unchanged."""
    same = F.col("prev_download_url").eqNullSafe(F.col("download_url"))
    return attached.withColumn("reused_asset", F.when(same, F.col("prev_native_asset")))


def reuse_asset_by_url(layers: DataFrame) -> DataFrame:
    """Give every layer the first native asset (in layer order) among those with its download link."""
    firsts = (
        layers.filter(F.col("native_asset").isNotNull() & F.col("download_url").isNotNull())
        .groupBy("download_url")
        .agg(F.min_by("native_asset", "pos").alias("shared_asset"))
    )
    return lookup(layers, firsts, ["download_url"])


def reuse_converted_assets(attached: DataFrame) -> DataFrame:
    """Converted links of the previous state for layers with equal native asset and equal mapping.

    Maps have no equality, so their sorted entries are compared. A layer without native asset or mapping, or one that
    is not ``to_convert`` (if there is such a column), keeps none.
    """
    def entries(name):
        return F.sort_array(F.map_entries(F.col(name)))

    same = (F.col("prev_native_asset") == F.col("native_asset")) & (entries("prev_native_arco_mapping") == entries("native_arco_mapping"))
    if "to_convert" in attached.columns:
        same = same & F.col("to_convert")
    kept = F.filter(
        F.col("prev_converted_arco_assets"), lambda a: F.contains(a, F.lit(".zarr")) | F.contains(a, F.lit(".parquet"))
    )
    none = F.array().cast("array<string>")
    return attached.withColumn("converted_arco_assets", F.coalesce(F.when(same, kept), none))


def all_assets(layers: DataFrame, with_converted: bool = True) -> DataFrame:
    """Asset links in the order assets, native asset, converted assets; null links left out."""
    empty = F.array().cast("array<string>")
    parts = [F.coalesce("assets", empty), F.filter(F.array("native_asset"), lambda a: a.isNotNull())]
    if with_converted:
        parts.append(F.coalesce("converted_arco_assets", empty))
    return layers.withColumn("all_assets", F.concat(*parts))

"""Renames, checks and type alignment of feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Coordinate names that are brought to one form.
COORDINATE_ALIASES = {"lat": "latitude", "lon": "longitude", "y": "latitude", "x": "longitude"}

_NUMBER = (T.IntegerType, T.LongType, T.DoubleType)
_SMALL = (T.ByteType, T.ShortType, T.FloatType, T.BooleanType)
_TIME = (T.TimestampType, T.TimestampNTZType)


def apply_mapping(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename native columns to standard names and keep the rest; renamed columns are left alone."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns and k != v})


def rename_grid_variables(grid: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Standard names in the ``variable`` column of a long grid; names without an entry stay."""
    if not mapping:
        return grid
    names = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return grid.withColumn("variable", F.coalesce(F.try_element_at(names, F.col("variable")), F.col("variable")))


def missing_columns(df: DataFrame, mapping: dict[str, str]) -> list[str]:
    """Mapped native columns that exist neither under their native nor under their standard name."""
    return [k for k, v in mapping.items() if k not in df.columns and v not in df.columns]


def check_mapping(df: DataFrame, mapping: dict[str, str]) -> tuple[dict[str, str], list[str]]:
    """The part of a mapping that fits the table, and the native names that do not."""
    missing = [k for k in mapping if k not in df.columns]
    return {k: v for k, v in mapping.items() if k not in missing}, missing


def project_mapped(df: DataFrame, mapping: dict[str, str], keep: tuple[str, ...] = ("geometry",)) -> DataFrame:
    """Only the mapped columns (renamed) and ``keep``; refuses a mapping that does not fit."""
    absent = [k for k in [*mapping, *keep] if k not in df.columns]
    if absent:
        raise ValueError(f"columns missing from the table: {absent}")
    return df.select(*[F.col(k).alias(v) for k, v in mapping.items()], *keep)


def align_coordinates(df: DataFrame) -> DataFrame:
    renames = {c: COORDINATE_ALIASES[c.lower()] for c in df.columns if c.lower() in COORDINATE_ALIASES}
    return df.withColumnsRenamed({k: v for k, v in renames.items() if v not in df.columns})


def align_types(df: DataFrame, keep: tuple[str, ...] = ("geometry", "feature_id")) -> DataFrame:
    """Float for numbers, whole seconds for times, text for what is neither; ``keep`` is untouched.

    Small numbers and flags stay as they are; dates and decimals become text.
    """
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name in keep or isinstance(field.dataType, _SMALL):
            pass
        elif isinstance(field.dataType, _NUMBER):
            column = column.cast("float")
        elif isinstance(field.dataType, _TIME):
            column = F.date_trunc("second", column)
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            column = F.to_json(column)
        else:
            column = column.cast("string")
        out.append(column.alias(field.name))
    return df.select(*out)


def drop_null_geometries(df: DataFrame, geometry: str = "geometry") -> tuple[DataFrame, Observation]:
    """Rows with a geometry; the observation counts all rows and the dropped ones on the way."""
    seen = Observation()
    watched = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(geometry).isNull()).alias("null_rows")
    )
    return watched.filter(F.col(geometry).isNotNull()), seen


def require_filled(df: DataFrame, names: list[str]) -> DataFrame:
    """Refuse a table in which a required column is missing or has nulls."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"required columns missing: {absent}")
    holes = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names]).first().asDict()
    bad = [n for n in names if holes[n]]
    if bad:
        raise ValueError(f"required columns with nulls: {bad}")
    return df


def null_report(df: DataFrame, names: list[str]) -> DataFrame:
    """One row per required column with its number of nulls."""
    counts = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
    return counts.unpivot([], names, "column_name", "null_rows")


def schema_facts(df: DataFrame, id_columns: list[str], counted: list[str]) -> DataFrame:
    """Per group: rows and rows with a value in each of ``counted``, in long form."""
    counts = df.groupBy(*id_columns).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(c) for c in counted]
    )
    return counts.unpivot([*id_columns, "rows"], counted, "column_name", "filled_rows")

"""Cleaning the raw table: types, duplicates, nulls, pseudonyms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platewise.constants import CRITICAL_COLUMNS, HOLE_COLUMNS
from platewise.functions.hashing import pseudonym
from platewise.functions.numeric import number
from platewise.schema import nan_to_null, with_hole_columns


def cast_timestamp(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Text to timestamp; text that is no timestamp becomes null."""
    kind = df.schema[column].dataType.typeName()
    if kind == "timestamp":
        return df
    value = F.col(column).cast("timestamp") if kind == "timestamp_ntz" else F.try_to_timestamp(F.col(column))
    return df.withColumn(column, value)


def latest_per_key(df: DataFrame, key: str = "simulation_id", order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """One row per key: the greatest by ``order``, ties settled by the remaining columns.

    Nulls sort lowest. A null key counts as one key. Spark plans ``row_number() = 1`` as a window group
    limit on both sides of the shuffle, so the copies of a hot key shrink to one row per task before it.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    newest = Window.partitionBy(key).orderBy(*[F.desc_nulls_last(c) for c in (*order, *rest)])
    return df.withColumn("_copy", F.row_number().over(newest)).filter("_copy = 1").drop("_copy")


def drop_null_critical(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    """Keep rows complete in every critical column (NaN counts as missing)."""
    return df.dropna(subset=list(columns))


def pseudonymize(df: DataFrame, column: str = "simulation_id") -> DataFrame:
    return df.withColumn(column, pseudonym(F.col(column)))


def clean(df: DataFrame) -> DataFrame:
    """NaN to null, cast, then one row per id, then drop incomplete rows, then hash ids.

    The order matters: an id whose latest copy is incomplete is lost even if an older copy was complete.
    """
    return df.transform(nan_to_null).transform(cast_timestamp).transform(latest_per_key).transform(drop_null_critical).transform(pseudonymize)


def upsert_latest(target: DataFrame, changes: DataFrame, key: str = "simulation_id") -> DataFrame:
    """Target with the changes merged in, newest row per key."""
    return latest_per_key(target.unionByName(changes, allowMissingColumns=True), key)


def coerce_optional(df: DataFrame) -> DataFrame:
    """Optional columns present, numeric (bad values and NaN null) and trimmed."""
    full = with_hole_columns(df)
    return full.withColumns(
        {c: number(F.col(c)) for c in HOLE_COLUMNS} | {"geometry_type": F.trim(F.col("geometry_type").cast("string"))}
    )

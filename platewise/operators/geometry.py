"""What hole a plate has: ambiguous rows, inferred type, flags, fills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.constants import DEFAULT_CENTER, DEFAULT_RADIUS, GEOMETRY_TYPES, MOVING_HOLE, WITH_HOLE, WITHOUT_HOLE
from platewise.functions.numeric import number
from platewise.schema import with_hole_columns


def has_geometry_signal() -> Column:
    """A type (even blank text), a radius or an x position. The y position is not looked at."""
    return (
        F.col("geometry_type").isNotNull()
        | number(F.col("hole_radius_ratio")).isNotNull()
        | number(F.col("hole_cx_ratio")).isNotNull()
    )


def resolve_ambiguous(df: DataFrame, keep: bool = False) -> DataFrame:
    """Drop rows without any geometry signal, or with ``keep`` label them plain plates."""
    full = with_hole_columns(df)
    if not keep:
        return full.filter(has_geometry_signal())
    label = F.when(has_geometry_signal(), F.col("geometry_type")).otherwise(F.lit(WITHOUT_HOLE))
    return full.withColumn("geometry_type", label)


def is_moving() -> Column:
    return F.col("hole_cx_ratio").isNotNull() & F.col("hole_cy_ratio").isNotNull()


def is_hole() -> Column:
    return F.coalesce(F.col("hole_radius_ratio") > 0, F.lit(False))


def infer_geometry(df: DataFrame) -> DataFrame:
    """Replace a missing or unknown type by what the hole columns say."""
    known = F.coalesce(F.col("geometry_type").isin(*GEOMETRY_TYPES), F.lit(False))
    inferred = F.when(is_moving(), MOVING_HOLE).when(is_hole(), WITH_HOLE).otherwise(WITHOUT_HOLE)
    return df.withColumn("geometry_type", F.when(known, F.col("geometry_type")).otherwise(inferred))


def add_hole_flags(df: DataFrame) -> DataFrame:
    """0/1 flags; must come before the fills."""
    return df.withColumns({"has_hole": is_hole().cast("int"), "has_moving_hole": is_moving().cast("int")})


def fill_hole_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "hole_radius_ratio": F.coalesce("hole_radius_ratio", F.lit(DEFAULT_RADIUS)),
            "hole_cx_ratio": F.coalesce("hole_cx_ratio", F.lit(DEFAULT_CENTER)),
            "hole_cy_ratio": F.coalesce("hole_cy_ratio", F.lit(DEFAULT_CENTER)),
        }
    )


def hole_inside_plate(df: DataFrame, flag: str | None = None) -> DataFrame:
    """Keep rows whose hole lies inside the plate, or add the answer as a column."""
    length, height = F.col("length_m"), F.col("height_m")
    shorter = F.least(length, height)
    radius = F.col("hole_radius_ratio") * shorter
    cx, cy = F.col("hole_cx_ratio") * length, F.col("hole_cy_ratio") * height
    inside = (
        (radius > 0)
        & (radius < F.lit(0.5) * shorter)
        & (radius < cx)
        & (cx < length - radius)
        & (radius < cy)
        & (cy < height - radius)
    )
    inside = F.coalesce(inside, F.lit(False))
    return df.filter(inside) if flag is None else df.withColumn(flag, inside)

"""Parameter sweeps: grid values are exploded next to each base case, so nothing is joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.constants import (
    MATERIAL_RANGES,
    MODULUS_SWEEP_POINTS,
    REFERENCE_KT,
    SURFACE_RADIUS,
    SURFACE_TRACTION_MPA,
    SWEEP_RANGES,
    WITHOUT_HOLE,
)
from platewise.functions.numeric import linspace, lookup


def sweep_values(parameter: str) -> Column:
    """The grid of a parameter; the modulus follows the range of the row's material."""
    if parameter == "young_modulus_pa":
        material = F.col("material_category")
        ends = [lookup(material, {m: p["young_modulus_pa"][k] for m, p in MATERIAL_RANGES.items()}) for k in (0, 1)]
        return linspace(ends[0], ends[1], MODULUS_SWEEP_POINTS)
    low, high, points = SWEEP_RANGES[parameter]
    return linspace(low, high, points)


def sweep_1d(df: DataFrame, parameter: str, values: Column | None = None) -> DataFrame:
    """Each base case repeated with every grid value of one parameter, plus the Kt = 3 reference line.

    A radius sweep leaves plain plates out.
    """
    base = df.filter(F.col("geometry_type") != WITHOUT_HOLE) if parameter == "hole_radius_ratio" else df
    return (
        base.select("*", F.posexplode(sweep_values(parameter) if values is None else values).alias("point", "_value"))
        .withColumn(parameter, F.col("_value"))
        .drop("_value")
        .withColumn("reference_von_mises_pa", F.col("traction_pa") * REFERENCE_KT)
    )


def response_surface(df: DataFrame) -> DataFrame:
    """Each base case on the traction x radius grid."""
    traction = linspace(*SURFACE_TRACTION_MPA)
    return (
        df.select("*", F.posexplode(traction).alias("traction_point", "_t"))
        .select("*", F.posexplode(linspace(*SURFACE_RADIUS)).alias("radius_point", "_r"))
        .withColumns({"traction_pa": F.col("_t") * 1e6, "hole_radius_ratio": F.col("_r")})
        .drop("_t", "_r")
    )


def surface_matrix(surface: DataFrame, value: str, points: int = SURFACE_RADIUS[2]) -> DataFrame:
    """The surface with one row per traction and one column per radius."""
    return surface.groupBy("traction_point").pivot("radius_point", list(range(points))).agg(F.max(value))


def linspace_grid(df: DataFrame, low: Column, high: Column, points: int) -> DataFrame:
    return df.select("*", F.posexplode(linspace(low, high, points)).alias("point", "value"))

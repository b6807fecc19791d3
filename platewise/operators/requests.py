"""Prediction requests as a table: parse, validate, split into accepted and rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.constants import GEOMETRY_TYPES, MOVING_HOLE, WITH_HOLE, WITHOUT_HOLE
from platewise.schema import REQUEST_SCHEMA, nan_to_null

# Mesh used when a request leaves it out.
DEFAULT_MESH = (120, 24)


def parse_cases(df: DataFrame, json_column: str = "json") -> DataFrame:
    """JSON cases to typed request rows; text that is no JSON object gives nulls."""
    others = [c for c in df.columns if c != json_column]
    return nan_to_null(df.select(*others, F.from_json(json_column, REQUEST_SCHEMA).alias("_r")).select(*others, "_r.*"))


def _reasons() -> dict[str, Column]:
    """Reason -> condition under which a request is refused."""
    col = F.col
    geometry, radius, cx, cy = col("geometry_type"), col("hole_radius_ratio"), col("hole_cx_ratio"), col("hole_cy_ratio")

    def unless(ok: Column) -> Column:
        return ~F.coalesce(ok, F.lit(False))

    def outside(c: Column, high: float) -> Column:
        return c.isNotNull() & ~((c > 0) & (c < high))

    return {
        "geometry_type": unless(geometry.isin(*GEOMETRY_TYPES)),
        "length_m": unless(col("length_m") > 0),
        "height_m": unless(col("height_m") > 0),
        "young_modulus_pa": unless(col("young_modulus_pa") > 0),
        "poisson_ratio": unless((col("poisson_ratio") > 0) & (col("poisson_ratio") < 0.5)),
        "traction_pa": unless(col("traction_pa") >= 0),
        "material_category": unless(F.trim("material_category") != ""),
        "dimension_category": unless(F.trim("dimension_category") != ""),
        "hole_radius_ratio": outside(radius, 0.5),
        "hole_cx_ratio": outside(cx, 1),
        "hole_cy_ratio": outside(cy, 1),
        "mesh_nx": col("mesh_nx") < 8,
        "mesh_ny": col("mesh_ny") < 4,
        "radius_required": geometry.isin(WITH_HOLE, MOVING_HOLE) & radius.isNull(),
        "center_required": (geometry == MOVING_HOLE) & (cx.isNull() | cy.isNull()),
        "radius_forbidden": (geometry == WITHOUT_HOLE) & radius.isNotNull(),
    }


def validate_requests(df: DataFrame) -> DataFrame:
    """Add ``reasons`` (array, empty when accepted); NaN is null; fill the mesh and trim categories."""
    filled = nan_to_null(df).withColumns(
        {
            "mesh_nx": F.coalesce("mesh_nx", F.lit(DEFAULT_MESH[0])),
            "mesh_ny": F.coalesce("mesh_ny", F.lit(DEFAULT_MESH[1])),
            "material_category": F.trim("material_category"),
            "dimension_category": F.trim("dimension_category"),
        }
    )
    flagged = [F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in _reasons().items()]
    return filled.withColumn("reasons", F.array_compact(F.array(*flagged)))


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.size("reasons") == 0).drop("reasons")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.size("reasons") > 0)

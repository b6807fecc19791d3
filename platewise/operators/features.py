"""Physics feature columns: one narrow projection, staged so that each level reads the level below."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.constants import (
    EPS,
    FEATURE_INPUT_COLUMNS,
    KT_BOUNDS,
    KT_COEFFICIENTS,
    MAX_D_OVER_W,
    MESH_COLUMNS,
    METADATA_COLUMNS,
    MODULUS_FLOOR,
    NET_SECTION_FLOOR,
    SOURCE_COLUMNS,
    TARGETS,
    TRACTION_FLOOR,
)
from platewise.functions.numeric import bound, log10_floor, polynomial
from platewise.operators.clean import coerce_optional
from platewise.operators.geometry import add_hole_flags, fill_hole_defaults, infer_geometry
from platewise.schema import require_columns


def prepare_holes(df: DataFrame) -> DataFrame:
    """Coerce, infer the type, flag, then fill."""
    return df.transform(coerce_optional).transform(infer_geometry).transform(add_hole_flags).transform(fill_hole_defaults)


def geometry_features(df: DataFrame) -> DataFrame:
    length, height = F.col("length_m"), F.col("height_m")
    return df.withColumns(
        {
            "area_m2": length * height,
            "aspect_ratio": length / (height + EPS),
            "radius_abs": F.col("hole_radius_ratio") * F.least(length, height),
        }
    ).withColumn("d_over_W", bound(F.lit(2.0) * F.col("radius_abs") / (height + EPS), 0.0, MAX_D_OVER_W))


def stress_features(df: DataFrame) -> DataFrame:
    """Needs the geometry features and the hole flag."""
    with_hole = bound(polynomial(F.col("d_over_W"), KT_COEFFICIENTS), *KT_BOUNDS)
    return (
        df.withColumns(
            {
                "Kt_theory": F.when(F.col("has_hole") == 1, with_hole).otherwise(F.lit(1.0)),
                "net_section_ratio": bound(F.lit(1.0) - F.col("d_over_W"), NET_SECTION_FLOOR, 1.0),
            }
        )
        .withColumn("sigma_net", F.col("traction_pa") / (F.col("net_section_ratio") + EPS))
        .withColumn("stress_amp_proxy", F.col("Kt_theory") * F.col("sigma_net"))
    )


def strain_features(df: DataFrame) -> DataFrame:
    nu = F.col("poisson_ratio")
    return df.withColumn("epsilon", F.col("traction_pa") / (F.col("young_modulus_pa") + EPS)).withColumns(
        {
            "delta_theory": F.col("epsilon") * F.col("length_m"),
            "biaxial_factor": F.lit(1.0) - nu * nu,
            "traction_over_E": F.col("epsilon"),
        }
    )


def ligament_features(df: DataFrame) -> DataFrame:
    """Material left around the hole. Radius and centre are subtracted as the plain ratios they are."""
    r, cx, cy = F.col("hole_radius_ratio"), F.col("hole_cx_ratio"), F.col("hole_cy_ratio")
    sides = {
        "lig_left": bound(cx - r, lower=0.0),
        "lig_right": bound(F.lit(1.0) - cx - r, lower=0.0),
        "lig_bottom": bound(cy - r, lower=0.0),
        "lig_top": bound(F.lit(1.0) - cy - r, lower=0.0),
        "eccentricity_x": F.abs(cx - 0.5),
        "eccentricity_y": F.abs(cy - 0.5),
    }
    ex, ey = F.col("eccentricity_x"), F.col("eccentricity_y")
    return (
        df.withColumns(sides)
        .withColumns(
            {
                "lig_min": F.least("lig_left", "lig_right", "lig_bottom", "lig_top"),
                "eccentricity": F.sqrt(ex * ex + ey * ey),
            }
        )
        .withColumn("edge_ratio", r / (F.col("lig_min") + EPS))
    )


# Logarithm column -> (input column, floor).
LOG_FEATURES = {
    "logE": ("young_modulus_pa", MODULUS_FLOOR),
    "logS": ("traction_pa", TRACTION_FLOOR),
    "log_epsilon": ("epsilon", EPS),
    "log_delta_th": ("delta_theory", EPS),
    "log_sigma_net": ("sigma_net", EPS),
    "log_Kt": ("Kt_theory", 1.0),
    "log_lig_min": ("lig_min", EPS),
    "log_edge_ratio": ("edge_ratio", EPS),
}


def log_features(df: DataFrame) -> DataFrame:
    return df.withColumns({name: log10_floor(F.col(c), floor) for name, (c, floor) in LOG_FEATURES.items()})


def engineer_features(df: DataFrame, require_targets: bool = True) -> DataFrame:
    """All 31 derived columns. Narrow: no shuffle, columns nobody reads are pruned with their inputs."""
    required = [c for c in FEATURE_INPUT_COLUMNS if require_targets or c not in TARGETS]
    return (
        require_columns(df, required)
        .transform(prepare_holes)
        .transform(geometry_features)
        .transform(stress_features)
        .transform(strain_features)
        .transform(ligament_features)
        .transform(log_features)
    )


def feature_columns(columns: Iterable[str], training: bool = False) -> list[str]:
    """Model inputs by exclusion, in table order; training also leaves out where a row came from."""
    excluded = {*TARGETS, *METADATA_COLUMNS, *MESH_COLUMNS, *(SOURCE_COLUMNS if training else ())}
    return [c for c in columns if c not in excluded]

"""Target scaling, analytic estimates, proxy responses and safety."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.constants import (
    DEFAULT_TRAINED_MAX_MPA,
    EPS,
    ESTIMATE_NET_SECTION_FLOOR,
    KT_COEFFICIENTS,
    MAX_D_OVER_W,
    NORMALIZE_BY,
    SAFETY_BANDS,
    TARGETS,
    TRACTION_TRAINED_MAX_MPA,
    YIELD_MPA,
)
from platewise.functions.numeric import clip, log10_floor, lookup, polynomial


def normalizer(target: str) -> Column:
    return clip(F.col(NORMALIZE_BY[target]), lower=EPS)


def log_targets(df: DataFrame, targets=TARGETS) -> DataFrame:
    """``log_<target>``: log10 of the target over its physical reference."""
    present = [t for t in targets if t in df.columns]
    return df.withColumns({f"log_{t}": log10_floor(F.col(t) / normalizer(t), EPS) for t in present})


def denormalize(prediction: Column, target: str) -> Column:
    """Physical value of a prediction made in normalised log space."""
    return F.pow(F.lit(10.0), prediction) * normalizer(target)


def analytic_estimate(df: DataFrame) -> DataFrame:
    """Hand-calculation check: ``est_displacement_m``, ``est_von_mises_pa``, ``est_kt``.

    Differs from the features on purpose: no epsilon, another net-section floor, no upper bound on Kt.
    A zero modulus or height gives null.
    """
    length, height, traction = F.col("length_m"), F.col("height_m"), F.col("traction_pa")
    r = F.coalesce("hole_radius_ratio", F.lit(0.0))
    share = F.least(F.try_divide(F.lit(2.0) * r * F.least(length, height), height), F.lit(MAX_D_OVER_W))
    return (
        df.withColumn("_d", F.when(r > 0, share).otherwise(F.lit(0.0)))
        .withColumns(
            {
                "est_displacement_m": F.try_divide(traction, F.col("young_modulus_pa")) * length,
                "est_kt": F.when(r > 0, F.greatest(polynomial(F.col("_d"), KT_COEFFICIENTS), F.lit(1.0))).otherwise(1.0),
                "_net": F.greatest(F.lit(1.0) - F.col("_d"), F.lit(ESTIMATE_NET_SECTION_FLOOR)),
            }
        )
        .withColumn("est_von_mises_pa", F.col("est_kt") * (traction / F.col("_net")))
        .drop("_d", "_net")
    )


def safety_assessment(
    df: DataFrame, displacement: str = "max_displacement_m", stress: str = "max_von_mises_pa"
) -> DataFrame:
    """Safety factor and band, regime, amplification, model-to-estimate ratio, display units."""
    low, high = SAFETY_BANDS
    yield_pa = F.col("yield_pa")
    vm, traction = F.col(stress), F.col("traction_pa")
    return (
        analytic_estimate(df)
        .withColumn("yield_pa", lookup(F.col("material_category"), YIELD_MPA) * 1e6)
        .withColumn("safety_factor", F.when(vm > 0, yield_pa / vm).when(vm.isNotNull(), F.lit(float("inf"))))
        .withColumns(
            {
                "safety_band": F.when(F.col("safety_factor") >= high, "green")
                .when(F.col("safety_factor") >= low, "orange")
                .when(F.col("safety_factor").isNotNull(), "red"),
                "regime": F.when(vm < yield_pa, "elastic").when(vm >= yield_pa, "plastic"),
                "amplification": F.try_divide(vm, traction),
                "displacement_ratio": F.when(
                    F.col("est_displacement_m") > 0, F.col(displacement) / F.col("est_displacement_m")
                ),
                "displacement_mm": F.col(displacement) * 1e3,
                "von_mises_mpa": vm / 1e6,
            }
        )
    )


def extrapolation_flag(df: DataFrame) -> DataFrame:
    """1 where traction is above what the material was trained on."""
    limit = lookup(F.col("material_category"), TRACTION_TRAINED_MAX_MPA, DEFAULT_TRAINED_MAX_MPA)
    return df.withColumns(
        {"trained_max_mpa": limit, "is_extrapolated": (F.col("traction_pa") / 1e6 > limit).cast("int")}
    )

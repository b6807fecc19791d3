"""Row rules, contract checks and table audits: each audit is one pass over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.constants import CRITICAL_COLUMNS, GEOMETRY_TYPES, MOVING_HOLE, REQUIRED_COLUMNS, WITH_HOLE, WITHOUT_HOLE
from platewise.operators.clean import coerce_optional
from platewise.schema import nan_to_null, require_columns


def _between(c: Column, low: float, high: float) -> Column:
    return (c > low) & (c < high)


def _blank(c: Column) -> Column:
    return F.trim(c) == ""


def quality_rules() -> dict[str, Column]:
    """Rule name -> condition a good row meets. A comparison with null fails a required-value rule."""
    col = F.col
    radius, cx, cy, geometry = col("hole_radius_ratio"), col("hole_cx_ratio"), col("hole_cy_ratio"), col("geometry_type")
    required = {
        "length_m": col("length_m") > 0,
        "height_m": col("height_m") > 0,
        "young_modulus_pa": col("young_modulus_pa") > 0,
        "poisson_ratio": _between(col("poisson_ratio"), 0, 0.5),
        "traction_pa": col("traction_pa") >= 0,
        "mesh_nx": col("mesh_nx") >= 8,
        "mesh_ny": col("mesh_ny") >= 4,
        "max_displacement_m": col("max_displacement_m") >= 0,
        "max_von_mises_pa": col("max_von_mises_pa") >= 0,
    }
    violations = {
        "material_category_blank": _blank(col("material_category")),
        "dimension_category_blank": _blank(col("dimension_category")),
        "hole_radius_range": radius.isNotNull() & ~_between(radius, 0, 0.5),
        "hole_cx_range": cx.isNotNull() & ~_between(cx, 0, 1),
        "hole_cy_range": cy.isNotNull() & ~_between(cy, 0, 1),
        "geometry_type_known": (geometry != "") & ~geometry.isin(*GEOMETRY_TYPES),
        "with_hole_radius": (geometry == WITH_HOLE) & radius.isNull(),
        "with_hole_center": (geometry == WITH_HOLE) & (cx.isNotNull() | cy.isNotNull()),
        "without_hole_columns": (geometry == WITHOUT_HOLE) & (radius.isNotNull() | cx.isNotNull() | cy.isNotNull()),
        "moving_radius": (geometry == MOVING_HOLE) & radius.isNull(),
        "moving_center": (geometry == MOVING_HOLE) & (cx.isNull() | cy.isNull()),
    }
    good = {name: F.coalesce(rule, F.lit(False)) for name, rule in required.items()}
    return good | {name: ~F.coalesce(bad, F.lit(False)) for name, bad in violations.items()}


def rule_violations(df: DataFrame) -> DataFrame:
    """``(rule, n_violations)`` for every rule, from one aggregate."""
    rules = quality_rules()
    counts = coerce_optional(nan_to_null(df)).agg(*[F.count_if(~ok).alias(name) for name, ok in rules.items()])
    return counts.unpivot([], list(rules), "rule", "n_violations")


def rows_with_violations(df: DataFrame) -> DataFrame:
    """Rows that break a rule, with the names of the rules broken."""
    broken = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in quality_rules().items()]))
    return coerce_optional(nan_to_null(df)).withColumn("broken_rules", broken).filter(F.size("broken_rules") > 0)


def assert_rules(df: DataFrame) -> None:
    """Raise with the broken rules and their row counts."""
    broken = {r["rule"]: r["n_violations"] for r in rule_violations(df).filter("n_violations > 0").collect()}
    if broken:
        raise ValueError(f"quality rules broken: {broken}")


def required_audit(df: DataFrame, key: str = "simulation_id") -> DataFrame:
    """One row: total, rows with a null or NaN in a required column, surplus rows per key.

    Keys are counted per key first, so a hot key is one partial count per task.
    """
    required = [c for c in REQUIRED_COLUMNS if c in df.columns]
    df = nan_to_null(df)
    any_null = F.lit(False)
    for c in required:
        any_null = any_null | F.col(c).isNull()
    per_key = df.groupBy(key).agg(F.count("*").alias("n"), F.count_if(any_null).alias("bad"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("n_null_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicate_rows"),
    )


def duplicate_audit(df: DataFrame, key: str = "simulation_id") -> DataFrame:
    """Rows, distinct keys (a null key is one) and the difference."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_distinct"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
    )


def null_counts(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    """``(column, n_null)`` in one pass; NaN counts as null in floating columns."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}

    def missing(c: str) -> Column:
        return F.col(c).isNull() | F.isnan(c) if c in floats else F.col(c).isNull()

    one_row = df.agg(*[F.count_if(missing(c)).alias(c) for c in columns])
    return one_row.unpivot([], list(columns), "column", "n_null")


def warehouse_quality(df: DataFrame) -> DataFrame:
    """Rows, duplicates and critical nulls (or NaN) of the warehouse as one row, from one shuffle on the key."""
    df = nan_to_null(df)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in CRITICAL_COLUMNS]
    per_key = df.groupBy("simulation_id").agg(F.count("*").alias("n"), *nulls)
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
        *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(f"null_{c}") for c in CRITICAL_COLUMNS],
    )


def assert_warehouse(df: DataFrame) -> dict[str, int]:
    """Raise when the warehouse has duplicates or critical nulls; else return the counts."""
    counts = warehouse_quality(df).first().asDict()
    if counts["n_duplicates"]:
        raise ValueError(f"warehouse has {counts['n_duplicates']} duplicate rows on simulation_id")
    nulls = {k[5:]: v for k, v in counts.items() if k.startswith("null_") and v}
    if nulls:
        raise ValueError(f"warehouse has nulls in critical columns: {nulls}")
    return counts


def distinct_geometry(df: DataFrame) -> DataFrame:
    """Non-blank geometry names after trimming."""
    name = F.trim("geometry_type").alias("geometry_type")
    return df.select(name).filter(F.col("geometry_type") != "").distinct()


def validation_summary(df: DataFrame, path_column: Column | None = None) -> DataFrame:
    """One row: rows, files, geometry names in order, greatest stress and displacement.

    The name list holds distinct names only; it is as long as the vocabulary, not as the table.
    """
    files = F.col("_metadata.file_path") if path_column is None else path_column
    geometry = F.trim("geometry_type")
    per_file = df.groupBy(files.alias("_file"), F.when(geometry != "", geometry).alias("_geometry")).agg(
        F.count("*").alias("n"),
        F.max("max_von_mises_pa").alias("vm"),
        F.max("max_displacement_m").alias("disp"),
    )
    return per_file.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_distinct("_file").alias("n_files"),
        F.array_join(F.sort_array(F.collect_set("_geometry")), ",").alias("geometry_types"),
        F.max("vm").alias("max_vm"),
        F.max("disp").alias("max_disp"),
    )


def validate_table(df: DataFrame) -> None:
    """Contract checks that raise: columns, nulls, duplicates, rules."""
    require_columns(df, REQUIRED_COLUMNS)
    audit = required_audit(df).first()
    if audit["n_null_rows"]:
        raise ValueError("null values in required columns")
    if audit["n_duplicate_rows"]:
        raise ValueError("duplicate simulation_id")
    assert_rules(df)

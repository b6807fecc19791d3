"""The plate table contract and the request contract."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.constants import HOLE_COLUMNS

RAW_SCHEMA = T.StructType(
    [
        T.StructField("simulation_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("material_category", T.StringType()),
        T.StructField("dimension_category", T.StringType()),
        T.StructField("length_m", T.DoubleType()),
        T.StructField("height_m", T.DoubleType()),
        T.StructField("young_modulus_pa", T.DoubleType()),
        T.StructField("poisson_ratio", T.DoubleType()),
        T.StructField("traction_pa", T.DoubleType()),
        T.StructField("mesh_nx", T.IntegerType()),
        T.StructField("mesh_ny", T.IntegerType()),
        T.StructField("geometry_type", T.StringType()),
        T.StructField("hole_radius_ratio", T.DoubleType()),
        T.StructField("hole_cx_ratio", T.DoubleType()),
        T.StructField("hole_cy_ratio", T.DoubleType()),
        T.StructField("max_displacement_m", T.DoubleType()),
        T.StructField("max_von_mises_pa", T.DoubleType()),
        T.StructField("solver_name", T.StringType()),
        T.StructField("solver_version", T.StringType()),
        T.StructField("data_version", T.StringType()),
    ]
)

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("geometry_type", T.StringType()),
        T.StructField("length_m", T.DoubleType()),
        T.StructField("height_m", T.DoubleType()),
        T.StructField("young_modulus_pa", T.DoubleType()),
        T.StructField("poisson_ratio", T.DoubleType()),
        T.StructField("traction_pa", T.DoubleType()),
        T.StructField("material_category", T.StringType()),
        T.StructField("dimension_category", T.StringType()),
        T.StructField("hole_radius_ratio", T.DoubleType()),
        T.StructField("hole_cx_ratio", T.DoubleType()),
        T.StructField("hole_cy_ratio", T.DoubleType()),
        T.StructField("mesh_nx", T.IntegerType()),
        T.StructField("mesh_ny", T.IntegerType()),
    ]
)


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Raise when columns are missing; otherwise hand the frame on."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes null: readers and checks know one kind of missing value."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def conform(df: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Add absent columns as null, cast what is there (bad values become null) and put columns in order."""
    have = set(df.columns)

    def column(field: T.StructField):
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if df.schema[field.name].dataType == field.dataType:
            return F.col(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    extra = [F.col(c) for c in df.columns if c not in set(schema.names)]
    return df.select(*[column(f) for f in schema.fields], *extra)


def with_hole_columns(df: DataFrame) -> DataFrame:
    """Add the optional columns where a source lacks them."""
    absent = {c: F.lit(None).cast("double") for c in HOLE_COLUMNS if c not in df.columns}
    if "geometry_type" not in df.columns:
        absent["geometry_type"] = F.lit(None).cast("string")
    return df.withColumns(absent) if absent else df

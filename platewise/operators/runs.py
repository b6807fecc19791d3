"""Training-run records as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.constants import RUN_R2_THRESHOLD

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("start_ms", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("metrics", T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.DoubleType())]))),
        T.StructField("params", T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))),
    ]
)
# Output column -> metric key of a run.
RUN_METRICS = {
    "r2_displacement": "max.displacement.m_test_r2_orig",
    "r2_von_mises": "max.von.mises.pa_test_r2_orig",
    "rmse_displacement": "max.displacement.m_test_rmse_orig",
}


def run_table(runs: DataFrame) -> DataFrame:
    """Key-value lists to columns; ``below_threshold`` marks runs with a score under 0.95."""
    return (
        runs.withColumns({"_m": F.map_from_entries("metrics"), "_p": F.map_from_entries("params")})
        .select(
            F.substring("run_id", 1, 8).alias("run_id"),
            "status",
            F.timestamp_millis("start_ms").alias("start_time"),
            *[F.try_element_at("_m", F.lit(key)).alias(name) for name, key in RUN_METRICS.items()],
            F.coalesce(F.try_element_at("_p", F.lit("n_trials")), F.lit("?")).alias("n_trials"),
        )
        .withColumn(
            "below_threshold",
            ((F.col("r2_displacement") < RUN_R2_THRESHOLD) | (F.col("r2_von_mises") < RUN_R2_THRESHOLD)).cast("int"),
        )
    )


def latest_runs(runs: DataFrame, n: int = 10, start: str = "start_time", tie: str = "run_id") -> DataFrame:
    """The newest ``n`` runs (a distributed top-n)."""
    return runs.orderBy(F.desc(start), F.desc(tie)).limit(n)


def latest_version(versions: DataFrame, by: str = "name", version: str = "version") -> DataFrame:
    """Newest version per name and how many there are; version strings sort by time."""
    return versions.groupBy(by).agg(F.max(version).alias("latest_version"), F.count_distinct(version).alias("n_versions"))


def append_run(runs: DataFrame, path: str) -> str:
    runs.write.mode("append").parquet(path)
    return path

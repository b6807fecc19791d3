"""Warehouse to feature store with splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from platewise.operators.features import engineer_features, feature_columns
from platewise.operators.geometry import resolve_ambiguous
from platewise.operators.split import assert_split, split_table
from platewise.sinks.tables import write_partitioned


def features_with_split(df: DataFrame, keep_ambiguous: bool = False, strategy: str = "hash", **options) -> DataFrame:
    """Resolve ambiguous rows, add the features, assign splits: narrow under the hash strategy."""
    return df.transform(resolve_ambiguous, keep_ambiguous).transform(engineer_features).transform(
        split_table, strategy, **options
    )


def feature_list(df: DataFrame, training: bool = False) -> DataFrame:
    """The model's feature names in order, as a table."""
    names = [c for c in feature_columns(df.columns, training) if c != "split"]
    return df.sparkSession.createDataFrame(list(enumerate(names)), "position int, feature string")


def build_feature_store(spark: SparkSession, source: DataFrame, path: str, **options) -> dict[str, int]:
    """Write ``features/`` (one folder per split) and ``feature_columns/``; raise on an empty split."""
    store = features_with_split(source, **options)
    write_partitioned(store, f"{path}/features", "split")
    feature_list(store).coalesce(1).write.mode("overwrite").parquet(f"{path}/feature_columns")
    return assert_split(spark.read.parquet(f"{path}/features").select("split"))

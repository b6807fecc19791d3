"""Writers. Each returns the path written, so that readers start from stored data, not from lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.constants import CHUNK_ROWS, METRIC_NAMES
from platewise.functions.naming import date_partition


def write_warehouse(df: DataFrame, path: str, lookup: str = "simulation_id") -> str:
    """Replace the warehouse table. Row groups carry a bloom filter of the ``lookup`` column, sized by its values.

    Hashed ids are spread evenly, so their least and greatest value tell nothing about a row group; the filter does.
    """
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if lookup in df.columns:
        writer = (
            writer.option(f"parquet.bloom.filter.enabled#{lookup}", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .option(f"parquet.enable.dictionary#{lookup}", "false")
        )
    writer.parquet(path)
    return path


def write_dated_chunks(df: DataFrame, path: str, date: Column | None = None, chunk_rows: int = CHUNK_ROWS) -> str:
    """``date=YYYY-MM-DD`` folders whose files hold at most ``chunk_rows`` rows; no shuffle is added."""
    if chunk_rows <= 0:
        raise ValueError("chunk_rows must be positive")
    day = date_partition(F.col("timestamp") if date is None else date)
    (
        df.withColumn("date", day)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", chunk_rows)
        .partitionBy("date")
        .parquet(path)
    )
    return path


def write_partitioned(df: DataFrame, path: str, *by: str) -> str:
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*by).parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def nested_metrics(metrics: DataFrame) -> DataFrame:
    """One JSON document per target, ``{split: {metric: value}}``, from tidy metric rows."""
    splits = F.sort_array(F.collect_list(F.struct("split", F.struct(*METRIC_NAMES).alias("metrics"))))
    return metrics.groupBy("target").agg(F.to_json(F.map_from_entries(splits)).alias("json"))


def write_metrics(metrics: DataFrame, path: str) -> tuple[str, str]:
    """Tidy CSV and nested JSON of the same rows."""
    json_path = f"{path}/nested"
    nested_metrics(metrics).select(
        F.concat(F.lit('{"'), "target", F.lit('": '), "json", F.lit("}")).alias("value")
    ).write.mode("overwrite").text(json_path)
    return write_csv(metrics, f"{path}/tidy"), json_path

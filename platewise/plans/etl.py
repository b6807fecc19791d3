"""Raw lake to warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from platewise.operators.clean import clean
from platewise.operators.eda import rows_by_source
from platewise.operators.quality import assert_warehouse, validate_table, validation_summary
from platewise.sinks.tables import write_warehouse
from platewise.sources.lake import scan_prefer_parquet, scan_raw, scan_table


def run_etl(spark: SparkSession, raw_path: str, warehouse_path: str, raw_root: str | None = None) -> dict:
    """Scan, clean, write, then check what was written. Row counts are observed while writing, so the
    lineage runs once."""
    before, after = Observation("raw"), Observation("clean")
    raw = scan_raw(spark, raw_path, raw_root).observe(before, F.count(F.lit(1)).alias("n"))
    cleaned = clean(raw).observe(after, F.count(F.lit(1)).alias("n"))
    write_warehouse(cleaned, warehouse_path)
    warehouse = scan_table(spark, warehouse_path)
    counts = assert_warehouse(warehouse)
    return {"rows_read": before.get["n"], "rows_written": after.get["n"], **counts}


def validate_folder(spark: SparkSession, path: str) -> DataFrame:
    """Check the contract of a folder (raises) and summarise it."""
    df = scan_prefer_parquet(spark, path)
    validate_table(df)
    return validation_summary(df)

"""Parquet/CSV/JSON sources. All return lazy DataFrames; paths may be local, hdfs:// or s3a://."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.constants import METRIC_NAMES
from platewise.schema import RAW_SCHEMA, nan_to_null

# Fixed value: the folder right below the raw root (a folder or bucket whose name starts with raw) names the source.
SOURCE_PATTERN = r"[/\\]raw[^/\\]*[/\\]([^/\\]+)[/\\]"


def source_of_path(path_column, raw_root: str | None = None):
    """Source folder in a file path; with ``raw_root`` any folder can be the root."""
    pattern = SOURCE_PATTERN if raw_root is None else rf"{re.escape(raw_root.rstrip('/'))}/([^/\\]+)[/\\]"
    return F.regexp_extract(path_column, pattern, 1)


def scan_raw(spark: SparkSession, raw_path: str, raw_root: str | None = None, partitioned: bool = False) -> DataFrame:
    """All raw Parquet files below a path, schemas merged, each row tagged with its source folder.

    ``partitioned=True`` reads ``date=`` folders as a partition column, so that filters on it skip files.
    """
    reader = spark.read.option("mergeSchema", "true")
    if not partitioned:
        reader = reader.option("recursiveFileLookup", "true")
        return nan_to_null(reader.parquet(raw_path).withColumn("source", source_of_path(F.col("_metadata.file_path"), raw_root)))
    folders = _source_folders(spark, raw_path)
    if not folders:
        raise FileNotFoundError(f"no source folders in {raw_path}")
    return nan_to_null(union_sources(*[reader.parquet(path).withColumn("source", F.lit(name)) for name, path in folders]))


def _source_folders(spark: SparkSession, raw_path: str) -> list[tuple[str, str]]:
    """Names and paths of the folders right below the raw root: one per source, listed on the driver."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(raw_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted((s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(root) if s.isDirectory())


def _has_files(spark: SparkSession, path: str, suffix: str) -> bool:
    """Whether any file below ``path`` ends in ``suffix``; stops at the first hit."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return False
    files = fs.listFiles(root, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(suffix):
            return True
    return False


def scan_prefer_parquet(spark: SparkSession, path: str, csv_schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Parquet files of a folder; CSV files only when it holds no Parquet; an error when it holds neither."""
    if _has_files(spark, path, ".parquet"):
        reader = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
        return nan_to_null(reader.option("pathGlobFilter", "*.parquet").parquet(path))
    if _has_files(spark, path, ".csv"):
        reader = spark.read.option("header", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
        return nan_to_null(reader.schema(csv_schema).csv(path))
    raise FileNotFoundError(f"no parquet or csv files in {path}")


def union_sources(*frames: DataFrame) -> DataFrame:
    """Stack sources whose columns differ; columns a source lacks become null."""
    if not frames:
        raise ValueError("no sources to union")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def scan_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Warehouse or split by path. A missing path is an error when the plan is made, not at run time."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def register_view(df: DataFrame, name: str = "warehouse") -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def scan_metrics(
    spark: SparkSession, path: str, fmt: str = "csv", split: str | None = None, multiline: bool = False
) -> DataFrame:
    """Tidy metric rows from CSV, or from nested JSON ``{target: {split: {metric: value}}}``.

    JSON is one document per line, or with ``multiline`` one document per file.
    """
    metrics = list(METRIC_NAMES)
    if fmt == "csv":
        schema = T.StructType(
            [T.StructField("target", T.StringType()), T.StructField("split", T.StringType())]
            + [T.StructField(m, T.DoubleType()) for m in metrics]
        )
        out = spark.read.option("header", "true").schema(schema).csv(path)
    else:
        nested = "map<string,map<string,map<string,double>>>"
        text = spark.read.text(path, wholetext=multiline)
        out = (
            text.select(F.explode(F.from_json("value", nested)).alias("target", "splits"))
            .select("target", F.explode("splits").alias("split", "m"))
            .select("target", "split", *[F.col("m")[m].alias(m) for m in metrics])
        )
    return out.filter(F.col("split") == split) if split else out


def is_folder(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Streaming file source over a folder of Parquet files, or over one named file of a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if is_folder(spark, path):
        return reader.option("recursiveFileLookup", "true").parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)

"""Checksum manifests against what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the digest a manifest carries for a file that was absent when it was made.
ABSENT = "MISSING"


def make_manifest(wanted: DataFrame, checksums: DataFrame, path: str = "path") -> DataFrame:
    """``(path, sha256)`` of the wanted files; absent ones are recorded as missing."""
    found = checksums.select(path, "sha256")
    return wanted.select(path).join(found, path, "left").select(path, F.coalesce("sha256", F.lit(ABSENT)).alias("sha256"))


def reconcile_checksums(manifest: DataFrame, checksums: DataFrame, path: str = "path") -> DataFrame:
    """``(path, expected, actual, status)``: OK, MISSING, CHECKSUM_MISMATCH or SKIP."""
    actual = checksums.select(path, F.col("sha256").alias("actual"))
    expected = F.col("expected")
    status = (
        F.when(expected == ABSENT, "SKIP")
        .when(F.col("actual").isNull(), "MISSING")
        .when(F.col("actual") != expected, "CHECKSUM_MISMATCH")
        .otherwise("OK")
    )
    return (
        manifest.select(path, F.col("sha256").alias("expected"))
        .join(actual, path, "left")
        .select(path, "expected", "actual", status.alias("status"))
    )


def manifest_lines(manifest: DataFrame, path: str = "path") -> DataFrame:
    """Two-space text lines that ``sha256sum -c`` reads."""
    return manifest.select(F.concat_ws("  ", "sha256", path).alias("value"))


def parse_manifest_lines(lines: DataFrame) -> DataFrame:
    """Text lines back to ``(path, sha256)``; blank and malformed lines are skipped."""
    parts = F.split(F.trim("value"), "  ", 2)
    return lines.select(parts.alias("_p")).filter(F.size("_p") == 2).select(
        F.col("_p")[1].alias("path"), F.col("_p")[0].alias("sha256")
    )

"""Broadcast only what has been counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 10_000


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """A join side, broadcast when it is proven to have at most ``max_rows`` rows.

    At most ``max_rows + 1`` rows reach the driver. A larger side is handed back as it is: the join is
    then an ordinary shuffle join whose skewed partitions adaptive execution splits.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when the source has fewer splits than that; a large table is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

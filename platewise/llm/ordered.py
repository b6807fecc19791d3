"""Global positions in a sort order, without a task that sees all rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.stored import stored

_ROW_BITS = 33  # monotonically_increasing_id: the partition above, the row in it below


def numbered(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """The rows, stored in order, with ``name``: 0, 1, 2, ... in the given order.

    Ranges of about equal numbers of rows are sorted on their own; a row's position is that in its range after the
    sizes of the ranges before it. Equal rows are told apart by where they are read, so that a range can be cut
    within them. Only the sizes of the ranges, one number per partition, come to the driver. ``df`` is read twice
    (sample, then exchange); store it first if that is dear.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = df.withColumn("_row", F.monotonically_increasing_id())
    by = [*order, F.col("_row")]
    ranged = marked.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    kept = stored(ranged.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_row", _ROW_BITS).cast("int")
    sizes = sorted(kept.groupBy(part.alias("part")).count().collect())
    before = accumulate((n for _, n in sizes), initial=0)
    first = spark.createDataFrame([(p, n) for (p, _), n in zip(sizes, before)], "_part int, _first long")
    within = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    rows = kept.withColumn("_part", part).join(F.broadcast(first), "_part")  # a row per partition
    return rows.withColumn(name, F.col("_first") + within).drop("_row", "_part", "_first")

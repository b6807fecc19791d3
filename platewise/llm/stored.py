"""Tables kept between the steps of a job, and connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from platewise.session import new_path


def stored(df: DataFrame, name: str, watch: Observation | None = None, **watched: Column) -> DataFrame:
    """The table written to the shared folder and read back: no lineage, whole after the loss of any executor.

    With ``watch``, the named aggregates are observed while the table is written. ``discard`` removes it once a later
    step has replaced it.
    """
    path = new_path(df.sparkSession, name)
    seen = df.observe(watch, *[c.alias(n) for n, c in watched.items()]) if watch else df
    seen.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` wrote. No table that reads them may be used any more."""
    for table in tables:
        spark, path = table.sparkSession, table.stored_at
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node``, ``component`` (smallest node reachable) for edges ``a``, ``b`` of integers.

    Alternating stars: each node links its larger neighbours to the smallest one it knows, then its smaller ones,
    until all edges point at the smallest node. Sums and joins only; a node with many edges is split by the join.
    """
    first = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, mark = _edges(first)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(low.select("a", F.col("m").alias("b")))
        last, before = now, mark
        now, mark = _edges(small.distinct())
        discard(last)
        if before == mark:
            break
    return now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node").unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _edges(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The stored edges, and their number and sum of hashes, which are observed while they are written."""
    watch = Observation()
    sums = {"n": F.count(F.lit(1)), "h": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))}
    table = stored(edges, "edges", watch, **sums)
    return table, tuple(watch.get[k] for k in sums)

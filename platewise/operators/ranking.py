"""Positions, cuts and top-n without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.operators.sizing import small_side


# Offsets are two short keys and a count, so this many rows are a few megabytes.
_OFFSET_ROWS = 100_000
# Default of spark.sql.optimizer.windowGroupLimitThreshold.
_GROUP_LIMIT = 1000


def first_n_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None, salts: int = 64
) -> DataFrame:
    """The first ``n`` rows of every group.

    Up to ``_GROUP_LIMIT`` rows Spark cuts every group inside each task before the shuffle (window group
    limit). For more, each group is first cut in ``salts`` slices, so that a group holding a third of the
    table is sorted by many tasks; the second window sees at most ``salts * n`` rows per group.
    """
    final = Window.partitionBy(*by).orderBy(*order)
    name = rank or "_rank"
    if n > _GROUP_LIMIT:
        local = Window.partitionBy(*by, "_salt").orderBy(*order)
        sliced = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
        df = sliced.withColumn("_n", F.row_number().over(local)).filter(F.col("_n") <= n).drop("_n", "_salt")
    out = df.withColumn(name, F.row_number().over(final)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def group_index(df: DataFrame, by: Sequence[str], digest: Column, out: str = "index", digits: int = 3) -> DataFrame:
    """Zero-based position of every row in its group, in the order of a hex digest.

    Digests are uniform, so their leading digits cut every group, however large, into even slices. Rows are
    numbered inside a slice and shifted by the sizes of the slices before it (``16**digits`` per group).
    The digest must be unique inside a group for the result to be unique.
    """
    keyed = df.withColumns({"_digest": digest}).withColumn("_slice", F.substring("_digest", 1, digits))
    sizes = keyed.groupBy(*by, "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*by, "_slice").orderBy("_digest")
    numbered = keyed.withColumn("_pos", F.row_number().over(inside))
    left, right = numbered.alias("l"), small_side(offsets, _OFFSET_ROWS).alias("r")
    same = F.col("l._slice") == F.col("r._slice")
    for c in by:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return left.join(right, same).select("l.*", (F.col("r._before") + F.col("l._pos") - 1).alias(out)).drop(
        "_digest", "_slice", "_pos"
    )


def cut_digests(df: DataFrame, digest: Column, cuts: dict[str, Column], digits: int = 4) -> DataFrame:
    """``(name, digest)`` of the rows at given zero-based positions in digest order.

    ``cuts`` maps a name to a position, written in terms of the column ``total`` (the row count). Only the
    leading digits are counted over the whole table; full digests are sorted in the one slice per cut that
    holds the position. A position past the end gives no row.
    """
    keyed = df.select(digest.alias("_digest")).withColumn("_slice", F.substring("_digest", 1, digits))
    sizes = keyed.groupBy("_slice").agg(F.count("*").alias("_n"))
    # At most 16**digits rows, whatever the table size.
    running = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    placed = sizes.select(
        "_slice", (F.sum("_n").over(running) - F.col("_n")).alias("_before"), "_n", F.sum("_n").over(everything).alias("total")
    )
    wanted = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), v.cast("long").alias("pos")) for k, v in cuts.items()]))
    slices = (
        placed.withColumn("_cut", wanted)
        .filter((F.col("_cut.pos") >= F.col("_before")) & (F.col("_cut.pos") < F.col("_before") + F.col("_n")))
        .select("_slice", F.col("_cut.name").alias("name"), (F.col("_cut.pos") - F.col("_before") + 1).alias("_need"))
    )
    # One row per cut, so the broadcast is bounded by len(cuts).
    inside = Window.partitionBy("name").orderBy("_digest")
    return (
        keyed.join(F.broadcast(slices), "_slice")
        .withColumn("_pos", F.row_number().over(inside))
        .filter(F.col("_pos") == F.col("_need"))
        .select("name", F.col("_digest").alias("digest"))
    )


def _edges_below(value: Column, edges: Sequence[float]) -> Column:
    """How many of the sorted edges lie below the value: a binary search as nested CASE expressions."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value > F.lit(float(edges[middle])), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(edges))


def value_positions(df: DataFrame, value: str, by: Sequence[str] = (), slices: int = 256) -> DataFrame:
    """``(by..., value, n, before, total)`` per distinct value: its count, the rows below it, all rows.

    Equal values are counted first (a value held by a third of the rows is one row from there on). Distinct
    values are cut into ``slices`` ranges at approximate quantiles; the quantiles decide only how even the
    slices are, the counts are exact.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    probabilities = [i / slices for i in range(1, slices)]
    # ``slices - 1`` numbers; fixed on the driver so that both uses below cut at the same places.
    bounds = counted.agg(F.percentile_approx(value, probabilities, 1000)).first()[0] or []
    bounds = sorted(set(bounds))
    slot = _edges_below(F.col(value).cast("double"), bounds)
    sliced = counted.withColumn("_slice", slot)
    sizes = sliced.groupBy(*by, "_slice").agg(F.sum("n").alias("_n"))
    ordered = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*by)
    offsets = sizes.select(
        *by, "_slice", (F.sum("_n").over(ordered) - F.col("_n")).alias("_before"), F.sum("_n").over(whole).alias("total")
    )
    inside = Window.partitionBy(*by, "_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = sliced.withColumn("_upto", F.sum("n").over(inside))
    return numbered.join(offsets, [*by, "_slice"]).select(
        *by, value, "n", (F.col("_before") + F.col("_upto") - F.col("n")).alias("before"), "total"
    )


def fixed_size_sample(df: DataFrame, digest: Column, n: int) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer) in the order of a seeded digest: a distributed top-n, not a sort."""
    return df.orderBy(digest).limit(n)


def vocabulary_index(df: DataFrame, columns: Sequence[str], out: str = "index") -> DataFrame:
    """``(column, category, index)``: distinct values of text columns, numbered in order inside a column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("category")) for c in columns]))
    distinct = df.select(pairs.alias("_p")).select("_p.*").distinct()
    return distinct.withColumn(out, F.row_number().over(Window.partitionBy("column").orderBy("category")) - 1)


def encode_ordinal(df: DataFrame, vocabulary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categories by their index; a category the vocabulary lacks becomes -1."""
    side = small_side(vocabulary)
    for c in columns:
        names = side.filter(F.col("column") == c).select(F.col("category").alias("_category"), F.col("index").alias("_index"))
        key = F.coalesce(F.col(c).cast("string"), F.lit("None"))
        order = df.columns
        df = (
            df.join(names, key == F.col("_category"), "left")
            .withColumn(c, F.coalesce("_index", F.lit(-1)).cast("double"))
            .select(*order)
        )
    return df

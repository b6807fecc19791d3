"""Exact quantiles with bounded memory per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.operators.sizing import small_side

ACCURACY = 10_000
# Equal parts of a bracket's range; each is sorted on its own.
SLICES = 256


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (), accuracy: int = ACCURACY
) -> DataFrame:
    """``(by..., column, prob, quantile)``: linearly interpolated quantiles, equal to a full sort.

    ``percentile`` keeps every distinct value of a group in one task. Here a first pass finds, with the
    fixed-size sketch of ``percentile_approx``, a bracket that must hold each quantile; a second pass
    counts the rows below each bracket and the distinct values inside. Only the bracketed values, about
    ``20 / accuracy`` of a large group, are sorted, in slices. Small groups are bracketed whole. A quantile the
    bracket missed would fail the job, not give a wrong number.
    """
    probs = sorted(probabilities)
    names = [f"_c{i}" for i in range(len(columns))]
    table = df.select(*by, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(n) for c, n in zip(columns, names)])

    margin = 10.0 / accuracy
    edges = [e for p in probs for e in (max(p - margin, 0.0), min(p + margin, 1.0))]
    sketch = [
        F.struct(
            F.lit(label).alias("column"),
            F.count(n).alias("total"),
            F.percentile_approx(n, edges, accuracy).alias("edges"),
            F.min(n).alias("low"),
            F.max(n).alias("high"),
        ).alias(n)
        for label, n in zip(columns, names)
    ]
    brackets = (
        table.groupBy(*by)
        .agg(*sketch)
        .select(*by, F.explode(F.array(*names)).alias("_s"))
        .select(*by, "_s.*")
        .filter("total > 0")
    )
    # Below this many rows the margin would be less than a few ranks: take the whole range.
    whole = F.col("total") <= 5 * accuracy
    lows, highs = [], []
    for i in range(len(probs)):
        lows.append(F.when(whole, F.col("low")).otherwise(F.col("edges")[2 * i]))
        highs.append(F.when(whole, F.col("high")).otherwise(F.col("edges")[2 * i + 1]))
    brackets = brackets.select(*by, "column", "total", F.array(*lows).alias("lows"), F.array(*highs).alias("highs"))

    pairs = F.explode(F.array(*[F.struct(F.lit(label).alias("column"), F.col(n).alias("value")) for label, n in zip(columns, names)]))
    long = table.select(*by, pairs.alias("_p")).select(*by, "_p.*").filter(F.col("value").isNotNull())
    side = small_side(brackets).alias("b")
    same = F.col("l.column") == F.col("b.column")
    for c in by:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"b.{c}"))
    placed = long.alias("l").join(side, same).select("l.*", "b.total", "b.lows", "b.highs")

    # Segments in value order: 0 = below bracket 0, 1 = in bracket 0, 2 = between brackets 0 and 1, ...
    v, segment = F.col("value"), F
    for i in range(len(probs)):
        segment = segment.when(v < F.col("lows")[i], 2 * i).when(v <= F.col("highs")[i], 2 * i + 1)
    segment = segment.otherwise(2 * len(probs))
    # A bracket is cut into slices of its range, so that no task sorts all of its values: a value's rank is the number
    # of rows in the slices before, from a table of one row per slice, and its place within the slice.
    bracket = F.floor((F.col("_segment") - 1) / 2).cast("int")
    low, width = F.get("lows", bracket), F.get("highs", bracket) - F.get("lows", bracket)
    inside = F.least(F.floor((v - low) / width * SLICES), F.lit(SLICES - 1)).cast("int")
    slice_ = F.when((F.col("_segment") % 2 == 1) & (width > 0), inside).otherwise(F.lit(0))
    keys = [*by, "column"]
    counted = (
        placed.withColumn("_segment", segment)
        .withColumn("_slice", slice_)
        .groupBy(*keys, "total", "_segment", "_slice", F.when(F.col("_segment") % 2 == 1, v).alias("value"))
        .agg(F.count("*").alias("n"))
    )
    before = Window.partitionBy(*keys).orderBy("_segment", "_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = counted.groupBy(*keys, "_segment", "_slice").agg(F.sum("n").alias("_rows"))
    slices = slices.select(*keys, "_segment", "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    same = (F.col("c._segment") == F.col("s._segment")) & (F.col("c._slice") == F.col("s._slice"))
    for c in keys:
        same = same & F.col(f"c.{c}").eqNullSafe(F.col(f"s.{c}"))
    order = Window.partitionBy(*keys, "_segment", "_slice").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.alias("c").join(slices.alias("s"), same).select("c.*", "s._before")
    ranked = ranked.withColumn("_upto", F.col("_before") + F.sum("n").over(order))

    def at(rank: Column) -> Column:
        hit = (rank >= F.col("_upto") - F.col("n")) & (rank < F.col("_upto"))
        value = F.when(F.col("_segment") % 2 == 1, v).otherwise(
            F.raise_error(F.lit("quantile outside its bracket: raise the accuracy")).cast("double")
        )
        return F.max(F.when(hit, value))

    span = F.col("total") - 1
    wanted = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * span
        low, high = F.floor(position), F.ceil(position)
        wanted += [at(low).alias(f"_lo{i}"), at(high).alias(f"_hi{i}"), F.max(position - low).alias(f"_f{i}")]
    found = ranked.groupBy(*by, "column").agg(*wanted)
    answers = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(float(p)).alias("prob"),
                    (F.col(f"_lo{i}") + F.col(f"_f{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias("quantile"),
                )
                for i, p in enumerate(probs)
            ]
        )
    )
    return found.select(*by, "column", answers.alias("_a")).select(*by, "column", "_a.*")


def quantile_columns(df: DataFrame, columns: Sequence[str], named: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """One row per group and column with a named column per quantile."""
    long = exact_quantiles(df, columns, list(named.values()), by)
    return long.groupBy(*by, "column").agg(
        *[F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(n) for n, p in named.items()]
    )

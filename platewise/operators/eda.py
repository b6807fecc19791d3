"""Exploration aggregates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.constants import CHUNK_STAT_COLUMNS, NUMERIC_COLUMNS, TARGETS
from platewise.operators.quantiles import quantile_columns
from platewise.operators.sizing import small_side

TUKEY = 1.5


def rows_by_source(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source")


class Measure(NamedTuple):
    """A statistic of a column, rounded."""

    statistic: Callable[[str], Column]
    column: str
    digits: int


# What the warehouse reports show of each group.
STRESS_AND_DISPLACEMENT = {
    "n_simulations": Measure(F.count, "*", 0),
    "mean_von_mises_pa": Measure(F.avg, "max_von_mises_pa", 2),
    "max_von_mises_pa": Measure(F.max, "max_von_mises_pa", 2),
    "mean_displacement_m": Measure(F.avg, "max_displacement_m", 8),
}
STRESS_RANGE = {
    "min_von_mises_pa": Measure(F.min, "max_von_mises_pa", 2),
    "max_von_mises_pa": Measure(F.max, "max_von_mises_pa", 2),
    "std_von_mises_pa": Measure(F.stddev, "max_von_mises_pa", 2),
}
STRESS_SPREAD = {
    "n_simulations": Measure(F.count, "*", 0),
    "mean_von_mises_pa": Measure(F.avg, "max_von_mises_pa", 2),
    "std_von_mises_pa": Measure(F.stddev, "max_von_mises_pa", 2),
    "mean_displacement_m": Measure(F.avg, "max_displacement_m", 8),
}


def group_report(df: DataFrame, measures: Mapping[str, Measure], order: str, by: str = "source") -> DataFrame:
    """One row per group with the given measures, greatest ``order`` first; ties go by the group."""
    columns = [F.round(m.statistic(m.column), m.digits).alias(name) for name, m in measures.items()]
    return df.groupBy(by).agg(*columns).orderBy(F.desc(order), by)


def describe_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """``(column, count, mean, std, min, q25, q50, q75, max)``."""
    stats = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev(c).alias("std"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
        ).alias(c)
        for c in columns
    ]
    moments = df.agg(*stats).select(F.explode(F.array(*columns)).alias("_s")).select("_s.*")
    quartiles = quantile_columns(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    # One row per column on both sides.
    return moments.join(F.broadcast(quartiles), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with nulls: count and percent to one decimal, worst first."""
    columns = list(columns or df.columns)
    one_row = df.agg(F.count("*").alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (
        one_row.unpivot("_total", columns, "column", "n_null")
        .filter("n_null > 0")
        .select("column", "n_null", F.round(F.col("n_null") / F.col("_total") * 100, 1).alias("pct"))
        .orderBy(F.desc("pct"), "column")
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Rows outside the Tukey fences per column, with their percent of all rows."""
    fences = quantile_columns(df, columns, {"q1": 0.25, "q3": 0.75}).select(
        "column",
        "q1",
        "q3",
        (F.col("q1") - TUKEY * (F.col("q3") - F.col("q1"))).alias("low"),
        (F.col("q3") + TUKEY * (F.col("q3") - F.col("q1"))).alias("high"),
    )
    # As many rows as columns: fetched, they become constants of a single counting pass.
    limits = {r["column"]: r for r in fences.collect()}
    counted = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(limits[c]["q1"]).alias("q1"),
            F.lit(limits[c]["q3"]).alias("q3"),
            F.count_if((F.col(c) < limits[c]["low"]) | (F.col(c) > limits[c]["high"])).alias("n_outliers"),
            F.count("*").alias("n_rows"),
        ).alias(c)
        for c in columns
        if c in limits
    ]
    return (
        df.agg(*counted)
        .select(F.explode(F.array(*[c for c in columns if c in limits])).alias("_s"))
        .select("_s.*")
        .withColumn("pct", F.round(F.col("n_outliers") / F.col("n_rows") * 100, 1))
        .drop("n_rows")
    )


def _correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], names: tuple[str, str]) -> DataFrame:
    """``(name0, name1, r)`` per pair, in one pass.

    Pairs are laid out as rows inside each task and shrink to one row per pair before the shuffle: one small
    compiled aggregate instead of a method with dozens of them.
    """
    laid = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias(names[0]),
                    F.lit(b).alias(names[1]),
                    F.col(a).cast("double").alias("x"),
                    F.col(b).cast("double").alias("y"),
                )
                for a, b in pairs
            ]
        )
    )
    return df.select(laid.alias("_p")).groupBy(*[F.col(f"_p.{n}").alias(n) for n in names]).agg(F.corr("_p.x", "_p.y").alias("r"))


def pearson_matrix(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """``(a, b, r)`` for every ordered pair; each unordered pair is computed once."""
    half = _correlations(df, [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]], ("a", "b"))
    mirrored = F.explode(F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r")))
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], "a string, b string, r double")
    return half.select(mirrored.alias("_m")).select("_m.*").unionByName(diagonal)


def target_correlations(
    df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS, targets: Sequence[str] = TARGETS
) -> DataFrame:
    """``(column, target, r)`` of each other column with each target, strongest first, in one pass."""
    pairs = [(c, t) for t in targets for c in columns if c != t]
    found = _correlations(df, pairs, ("column", "target"))
    return found.filter(F.col("r").isNotNull()).orderBy("target", F.desc("r"))


def log_correlation(df: DataFrame, x: Column, y: Column) -> DataFrame:
    """Pearson correlation of log10 values; pairs where either is not positive are left out."""
    both = (x > 0) & (y > 0)
    return df.filter(both).agg(F.corr(F.log10(x), F.log10(y)).alias("r_log"), F.count("*").alias("n"))


def histogram(df: DataFrame, column: str, bins: int = 50, density: bool = False) -> DataFrame:
    """Equal-width bins ``(bin, low, high, n)``; the last bin includes the maximum; empty bins are kept."""
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    ends = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n")).alias("e")).scalar()
    # A constant column is one unit wide around its value.
    flat = ends["low"] == ends["high"]
    low = F.when(flat, ends["low"] - 0.5).otherwise(ends["low"])
    high = F.when(flat, ends["high"] + 0.5).otherwise(ends["high"])
    width = (high - low) / F.lit(float(bins))
    counts = values.select(
        F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).cast("int").alias("bin")
    ).groupBy("bin").agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = (
        every.join(F.broadcast(counts), "bin", "left")  # at most ``bins`` rows
        .select(
            "bin",
            (low + F.col("bin") * width).alias("low"),
            (low + (F.col("bin") + 1) * width).alias("high"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        .filter(ends["n"] > 0)
    )
    return out.withColumn("density", F.col("n") / (ends["n"] * width)) if density else out


def box_numbers(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and outlier count per group."""
    quartiles = quantile_columns(df, [column], {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=[by]).drop("column")
    fenced = quartiles.select(
        F.col(by).alias("_by"),
        "q1",
        "median",
        "q3",
        (F.col("q1") - TUKEY * (F.col("q3") - F.col("q1"))).alias("_low"),
        (F.col("q3") + TUKEY * (F.col("q3") - F.col("q1"))).alias("_high"),
    )
    v = F.col(column)
    inside = (v >= F.col("_low")) & (v <= F.col("_high"))
    return (
        df.select(by, column)
        .filter(v.isNotNull())
        .join(small_side(fenced), F.col(by).eqNullSafe(F.col("_by")))
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
            F.count("*").alias("n"),
        )
    )


def chunk_stats(df: DataFrame, chunk: Sequence[str], columns: Sequence[str] = CHUNK_STAT_COLUMNS) -> DataFrame:
    """``(chunk..., column, min, max, mean, std)`` of whichever statistic columns the table has."""
    present = [c for c in columns if c in df.columns]
    stats = [
        F.struct(
            F.lit(c).alias("column"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
            F.avg(c).alias("mean"),
            F.stddev(c).alias("std"),
        ).alias(c)
        for c in present
    ]
    return (
        df.groupBy(*chunk)
        .agg(*stats)
        .select(*chunk, F.explode(F.array(*present)).alias("_s"))
        .select(*chunk, "_s.*")
    )


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``rows`` by the named ``values`` of ``columns``; absent pairs count 0."""
    return df.groupBy(rows).pivot(columns, list(values)).count().na.fill(0)


def material_envelope(df: DataFrame, by: str = "material_category", columns: Sequence[str] = NUMERIC_COLUMNS[:5]) -> DataFrame:
    """Smallest and greatest input per category."""
    bounds = [agg(c).alias(f"{name}_{c}") for c in columns for name, agg in (("min", F.min), ("max", F.max))]
    return df.groupBy(by).agg(*bounds)


def class_range_check(df: DataFrame, ranges: dict[str, dict[str, tuple[float, float]]], category: str) -> DataFrame:
    """Per category and property: rows inside and outside the range its class allows.

    The ranges are a constant dimension of a few rows, joined by equality; the range test runs per row.
    """
    rows = [(k, p, float(lo), float(hi)) for k, props in ranges.items() for p, (lo, hi) in props.items()]
    dimension = df.sparkSession.createDataFrame(rows, "category string, property string, low double, high double")
    properties = sorted({p for _, p, _, _ in rows})
    long = df.select(F.col(category).alias("category"), *properties).unpivot(["category"], properties, "property", "value")
    inside = (F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high"))
    return (
        long.join(F.broadcast(dimension), ["category", "property"])
        .groupBy("category", "property")
        .agg(F.count_if(inside).alias("n_inside"), F.count_if(~inside).alias("n_outside"))
    )

"""Request-log monitoring: the same window expressions serve batch tables and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.constants import ERROR_RATE_LIMIT
from platewise.operators.quantiles import quantile_columns
from platewise.session import new_path

# Fixed value: a server error is a status that starts with 5.
SERVER_ERROR = "5%"
UNITS = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600, "day": 86400, "days": 86400}


def seconds_of(duration: str) -> int:
    number, unit = duration.split()
    return int(number) * UNITS[unit]


def request_log(events: DataFrame) -> DataFrame:
    """``(event_id, ts, handler, status, duration_ms, job)`` from the event table."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("handler"),
        F.when(F.col("event_type") == "error", "500").otherwise("200").alias("status"),
        F.col("value").alias("duration_ms"),
        F.col("user_id").alias("job"),
    )


def request_rate(df: DataFrame, size: str = "1 minute") -> DataFrame:
    """Requests per minute in each window, to two decimals."""
    out = df.groupBy(F.window("ts", size).alias("_w")).agg(F.count("*").alias("n"))
    return out.select(
        F.col("_w.start").alias("window_start"), "n", F.round(F.col("n") / seconds_of(size) * 60, 2).alias("per_minute")
    )


def rate_by(df: DataFrame, by: str, size: str = "2 minutes", slide: str = "1 minute") -> DataFrame:
    """Requests per second by handler or status over sliding windows."""
    out = df.groupBy(F.window("ts", size, slide).alias("_w"), by).agg(F.count("*").alias("n"))
    return out.select(F.col("_w.start").alias("window_start"), by, "n", (F.col("n") / seconds_of(size)).alias("per_second"))


def error_percent(df: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Share of server errors per window, in percent."""
    out = df.groupBy(F.window("ts", size).alias("_w")).agg(
        F.count_if(F.col("status").like(SERVER_ERROR)).alias("n_errors"), F.count("*").alias("n")
    )
    return out.select(
        F.col("_w.start").alias("window_start"), "n_errors", "n", (F.col("n_errors") / F.col("n") * 100).alias("error_pct")
    )


def latency_quantiles(df: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Exact p50, p95 and p99 per window."""
    keyed = df.select(F.window("ts", size)["start"].alias("window_start"), "duration_ms")
    return quantile_columns(keyed, ["duration_ms"], {"p50": 0.5, "p95": 0.95, "p99": 0.99}, by=["window_start"]).drop("column")


def latency_summary(df: DataFrame) -> DataFrame:
    """Median, mean, P95 and maximum over the whole log."""
    quantiles = quantile_columns(df, ["duration_ms"], {"median_ms": 0.5, "p95_ms": 0.95})
    rest = df.agg(F.avg("duration_ms").alias("mean_ms"), F.max("duration_ms").alias("max_ms"), F.count("*").alias("n"))
    one = rest.select(F.struct("*").alias("r")).scalar()
    return quantiles.select(
        "median_ms", one["mean_ms"].alias("mean_ms"), "p95_ms", one["max_ms"].alias("max_ms"), one["n"].alias("n")
    )


def histogram_quantile(
    df: DataFrame, probability: float, bounds: Sequence[float], by: Sequence[str], value: str = "duration_ms"
) -> DataFrame:
    """Quantile read off cumulative ``le`` buckets, linear inside a bucket.

    All buckets are conditional counts of one aggregate. A rank past the last finite bucket gives that
    bucket's bound.
    """
    counts = df.groupBy(*by).agg(
        F.count(value).alias("n"), *[F.count_if(F.col(value) <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]
    )
    rank = F.lit(float(probability)) * F.col("n")
    quantile = F
    for i, upper in enumerate(bounds):
        lower = float(bounds[i - 1]) if i else 0.0
        below = F.col(f"le_{i - 1}") if i else F.lit(0)
        inside = (F.col(f"le_{i}") - below).cast("double")
        share = F.when(inside > 0, (rank - below) / inside).otherwise(F.lit(1.0))
        quantile = quantile.when(F.col(f"le_{i}") >= rank, F.lit(lower) + F.lit(float(upper) - lower) * share)
    return counts.filter("n > 0").select(*by, "n", quantile.otherwise(F.lit(float(bounds[-1]))).alias("quantile"))


def requests_total(df: DataFrame) -> DataFrame:
    return df.groupBy("handler").agg(F.count("*").alias("n"))


def held(series: DataFrame, breach: Column, size: str, hold: str, by: Sequence[str] = ()) -> DataFrame:
    """Alert episodes: runs of consecutive breaching windows at least ``hold`` long.

    ``series`` has one row per window, so it is as long as the time span, not as the log. A missing window
    ends a run (no data is fine).
    """
    step = seconds_of(size)
    number = F.floor(F.unix_seconds("window_start") / step)
    order = Window.partitionBy(*by).orderBy("_number")
    return (
        series.filter(F.coalesce(breach, F.lit(False)))
        .withColumn("_number", number)
        .withColumn("_island", F.col("_number") - F.row_number().over(order))
        .groupBy(*by, "_island")
        .agg(F.min("window_start").alias("started"), F.count("*").alias("n_windows"))
        .filter(F.col("n_windows") * step >= seconds_of(hold))
        .select(*by, "started", "n_windows")
    )


def alert_error_rate(
    df: DataFrame, size: str = "5 minutes", hold: str = "2 minutes", limit: float = ERROR_RATE_LIMIT
) -> DataFrame:
    """Episodes in which a handler's server errors per second stayed above the limit."""
    series = df.filter(F.col("status").like(SERVER_ERROR)).groupBy(F.window("ts", size).alias("_w"), "handler").agg(
        (F.count("*") / seconds_of(size)).alias("errors_per_second")
    )
    series = series.select(F.col("_w.start").alias("window_start"), "handler", "errors_per_second")
    return held(series, F.col("errors_per_second") > limit, size, hold, ["handler"])


def alert_latency(
    df: DataFrame,
    bounds: Sequence[float],
    limit: float,
    size: str = "5 minutes",
    hold: str = "3 minutes",
    probability: float = 0.99,
) -> DataFrame:
    """Episodes in which the bucketed latency quantile stayed above the limit (same unit as the log)."""
    keyed = df.select(F.window("ts", size)["start"].alias("window_start"), "duration_ms")
    series = histogram_quantile(keyed, probability, bounds, ["window_start"])
    return held(series, F.col("quantile") > limit, size, hold)


def uptime_last(df: DataFrame, size: str = "1 minute", by: str = "job") -> DataFrame:
    """Last up/down sample per job and window, from the job's first window to the end of the log.

    ``state`` is up, down or no_data; down and no_data are both alerting. Samples shrink to one row per job
    and window before the spine is laid.
    """
    step = seconds_of(size)
    up = F.when(F.col("status").like(SERVER_ERROR), 0).otherwise(1)
    last = df.groupBy(by, F.floor(F.unix_seconds("ts") / step).alias("w")).agg(
        F.max_by(up, F.struct("ts", "event_id")).alias("up")
    )
    end = last.agg(F.max("w")).scalar()
    spine = last.groupBy(by).agg(F.min("w").alias("first")).select(by, F.explode(F.sequence("first", end)).alias("w"))
    state = F.when(F.col("up").isNull(), "no_data").when(F.col("up") < 1, "down").otherwise("up")
    return spine.join(last, [by, "w"], "left").select(
        by, F.timestamp_seconds(F.col("w") * step).alias("window_start"), state.alias("state")
    )


def state_transitions(df: DataFrame, by: str = "job") -> DataFrame:
    """Samples whose up/down state differs from the job's sample before.

    The log is sorted by job and time into ranges of equal numbers of rows, stored, so that a job with a third of it is
    cut over many tasks. Inside a range the sample before is the row before; the first row of a range looks at the last
    one of the ranges before it, from a table with one row per range.
    """
    spark = df.sparkSession
    state = F.when(F.col("status").like(SERVER_ERROR), 0).otherwise(1)
    order = [F.col(by), F.col("ts"), F.col("event_id")]
    samples = df.select(by, "event_id", "ts", state.alias("up")).withColumn("_row", F.monotonically_increasing_id())
    path = new_path(spark, "samples")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    samples.repartitionByRange(parts, *order, "_row").withColumn("_part", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    ends = ranged.groupBy("_part").agg(F.max_by(F.struct(by, "up"), F.struct(*order, "_row")).alias("_end"))
    carried = ends.select("_part", F.lag("_end").over(Window.orderBy("_part")).alias("_carried"))
    inside = Window.partitionBy("_part").orderBy(*order, "_row")
    before = F.coalesce(F.lag(F.struct(by, "up")).over(inside).alias("_prev"), F.col("_carried"))
    return (
        ranged.join(F.broadcast(carried), "_part")
        .withColumn("_before", before)
        .withColumn("previous", F.when(F.col(f"_before.{by}") == F.col(by), F.col("_before.up")))
        .filter(F.col("up") != F.col("previous"))
        .select(by, "event_id", "ts", "previous", "up")
    )

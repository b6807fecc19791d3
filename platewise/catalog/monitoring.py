"""Request-log monitoring, run records and their streaming forms, on events and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.catalog.base import LOG, WAREHOUSE, log_rows, plates, query, rounded, stamp, table
from platewise.operators import monitor, runs
from platewise.operators.clean import clean
from platewise.session import new_path
from platewise.functions.naming import version_string
from platewise.sources.lake import stream_parquet
from platewise.streaming import jobs, ordered

_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S') AS window_start"
_HOUR, _DAY = "time_bucket(INTERVAL 1 HOUR, ts)", "time_bucket(INTERVAL 1 DAY, ts)"
# Bounds of the latency buckets in the log's unit.
BOUNDS = [10.0, 25.0, 50.0, 100.0, 200.0, 400.0]


def starts(df: DataFrame, column: str = "window_start") -> DataFrame:
    return df.withColumn(column, stamp(column))


# The log is sparse (about 14 requests an hour at the checked scale), so windows are hours and days.
@query("request_rate", f"WITH {LOG} SELECT {_STAMP.format(_HOUR)}, count(*) AS n, round(count(*) / 3600e0 * 60, 2) AS per_minute FROM log GROUP BY 1")
def request_rate(spark, sf):
    return starts(monitor.request_rate(log_rows(spark, sf), "1 hour"))


def _sliding(by: str) -> str:
    return f"""WITH {LOG}, spread AS (SELECT {_HOUR} - k * INTERVAL 1 HOUR AS w, {by} FROM log CROSS JOIN range(2) r(k))
    SELECT {_STAMP.format('w')}, {by}, count(*) AS n, count(*) / 7200e0 AS per_second FROM spread GROUP BY w, {by}"""


@query("rate_by_handler", _sliding("handler"))
def rate_by_handler(spark, sf):
    return starts(monitor.rate_by(log_rows(spark, sf), "handler", "2 hours", "1 hour"))


@query("rate_by_status", _sliding("status"))
def rate_by_status(spark, sf):
    return starts(monitor.rate_by(log_rows(spark, sf), "status", "2 hours", "1 hour"))


@query(
    "error_percent",
    f"""WITH {LOG} SELECT {_STAMP.format(_HOUR)}, sum(CASE WHEN status LIKE '5%' THEN 1 ELSE 0 END)::bigint AS n_errors, count(*) AS n,
    sum(CASE WHEN status LIKE '5%' THEN 1 ELSE 0 END)::double / count(*)::double * 100 AS error_pct FROM log GROUP BY {_HOUR}""",
)
def error_percent(spark, sf):
    return starts(monitor.error_percent(log_rows(spark, sf), "1 hour"))


@query(
    "latency_quantiles",
    f"""WITH {LOG} SELECT {_STAMP.format(_DAY)}, round(quantile_cont(duration_ms, 0.5), 6) AS p50, round(quantile_cont(duration_ms, 0.95), 6) AS p95,
    round(quantile_cont(duration_ms, 0.99), 6) AS p99 FROM log GROUP BY {_DAY}""",
)
def latency_quantiles(spark, sf):
    return rounded(starts(monitor.latency_quantiles(log_rows(spark, sf), "1 day")), 6, "p50", "p95", "p99")


@query(
    "latency_summary",
    f"""WITH {LOG} SELECT round(quantile_cont(duration_ms, 0.5), 6) AS median_ms, round(avg(duration_ms), 6) AS mean_ms,
    round(quantile_cont(duration_ms, 0.95), 6) AS p95_ms, max(duration_ms) AS max_ms, count(*) AS n FROM log""",
)
def latency_summary(spark, sf):
    return rounded(monitor.latency_summary(log_rows(spark, sf)), 6, "median_ms", "mean_ms", "p95_ms")


def _histogram_sql(probability: float) -> str:
    les = ", ".join(f"sum(CASE WHEN duration_ms <= {b!r}::double THEN 1 ELSE 0 END)::bigint AS le_{i}" for i, b in enumerate(BOUNDS))
    cases = []
    for i, upper in enumerate(BOUNDS):
        lower, below = (BOUNDS[i - 1], f"le_{i - 1}") if i else (0.0, "0")
        cases.append(
            f"WHEN le_{i} >= {probability}e0 * n THEN {lower!r}::double + ({upper - lower!r})::double * "
            f"(CASE WHEN le_{i} - {below} > 0 THEN ({probability}e0 * n - {below}) / (le_{i} - {below})::double ELSE 1e0 END)"
        )
    return f"""buckets AS (SELECT {_DAY} AS w, count(duration_ms) AS n, {les} FROM log GROUP BY 1),
    quantiles AS (SELECT w, n, CASE {' '.join(cases)} ELSE {BOUNDS[-1]!r}::double END AS quantile FROM buckets)"""


@query("histogram_quantile", f"WITH {LOG}, {_histogram_sql(0.95)} SELECT {_STAMP.format('w')}, n, round(quantile, 6) AS quantile FROM quantiles")
def histogram_quantile(spark, sf):
    rows = log_rows(spark, sf).select(F.window("ts", "1 day")["start"].alias("window_start"), "duration_ms")
    return rounded(starts(monitor.histogram_quantile(rows, 0.95, BOUNDS, ["window_start"])), 6, "quantile")


@query("requests_total", f"WITH {LOG} SELECT handler, count(*) AS n FROM log GROUP BY 1")
def requests_total(spark, sf):
    return monitor.requests_total(log_rows(spark, sf))


_ERROR_LIMIT = 0.0008  # errors per second; the log is sparse


@query(
    "alert_error_rate",
    f"""WITH {LOG}, series AS (SELECT {_HOUR} AS w, handler, count(*) / 3600e0 AS eps FROM log WHERE status LIKE '5%' GROUP BY 1, 2),
    breaching AS (SELECT *, epoch(w)::bigint // 3600 - row_number() OVER (PARTITION BY handler ORDER BY w) AS island FROM series WHERE eps > {_ERROR_LIMIT}e0),
    runs AS (SELECT handler, min(w) AS started, count(*) AS n_windows FROM breaching GROUP BY handler, island)
    SELECT handler, strftime(started, '%Y-%m-%d %H:%M:%S') AS started, n_windows FROM runs WHERE n_windows >= 2""",
)
def alert_error_rate(spark, sf):
    return starts(monitor.alert_error_rate(log_rows(spark, sf), "1 hour", "2 hours", _ERROR_LIMIT), "started")


@query(
    "alert_latency",
    f"""WITH {LOG}, {_histogram_sql(0.99)}, breaching AS (SELECT w, epoch(w)::bigint // 86400 - row_number() OVER (ORDER BY w) AS island FROM quantiles WHERE quantile > 230e0),
    runs AS (SELECT min(w) AS started, count(*) AS n_windows FROM breaching GROUP BY island)
    SELECT strftime(started, '%Y-%m-%d %H:%M:%S') AS started, n_windows FROM runs WHERE n_windows >= 2""",
)
def alert_latency(spark, sf):
    return starts(monitor.alert_latency(log_rows(spark, sf), BOUNDS, 230.0, "1 day", "2 days"), "started")


@query(
    "uptime_last",
    f"""WITH {LOG}, last_sample AS (SELECT job, w, up FROM (SELECT job, {_DAY} AS w, CASE WHEN status LIKE '5%' THEN 0 ELSE 1 END AS up,
      row_number() OVER (PARTITION BY job, {_DAY} ORDER BY ts DESC, event_id DESC) AS rn FROM log) WHERE rn = 1),
    spine AS (SELECT job, unnest(generate_series(min(w), (SELECT max(w) FROM last_sample), INTERVAL 1 DAY)) AS w FROM last_sample GROUP BY job)
    SELECT job, {_STAMP.format('s.w')}, CASE WHEN up IS NULL THEN 'no_data' WHEN up < 1 THEN 'down' ELSE 'up' END AS state
    FROM spine s LEFT JOIN last_sample l USING (job, w)""",
)
def uptime_last(spark, sf):
    return starts(monitor.uptime_last(log_rows(spark, sf), "1 day"))


@query(
    "state_transitions",
    f"""WITH {LOG}, samples AS (SELECT job, event_id, ts, CASE WHEN status LIKE '5%' THEN 0 ELSE 1 END AS up FROM log),
    lagged AS (SELECT *, lag(up) OVER (PARTITION BY job ORDER BY ts, event_id) AS previous FROM samples)
    SELECT job, event_id, previous, up FROM lagged WHERE up <> previous""",
)
def state_transitions(spark, sf):
    return monitor.state_transitions(log_rows(spark, sf)).select("job", "event_id", "previous", "up")


# --- run records: orders play training runs ------------------------------------------------------------------
def run_rows(spark, sf) -> DataFrame:
    score = F.col("o_totalprice") / 5e5
    metric = lambda key, value: F.struct(F.lit(key).alias("key"), value.alias("value"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("start_ms"),
        F.col("o_orderstatus").alias("status"),
        F.array(
            metric("max.displacement.m_test_r2_orig", score),
            metric("max.von.mises.pa_test_r2_orig", F.sqrt(score)),
        ).alias("metrics"),
        F.when(F.col("o_orderstatus") == "P", F.array(F.struct(F.lit("n_trials").alias("key"), F.lit("60").alias("value"))))
        .otherwise(F.array(F.struct(F.lit("seed").alias("key"), F.lit("42").alias("value"))))
        .alias("params"),
    )


_RUNS = """runs AS (SELECT substr(o_orderkey::varchar, 1, 8) AS run_id, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS start_time,
  o_totalprice / 5e5 AS r2_displacement, sqrt(o_totalprice / 5e5) AS r2_von_mises, CAST(NULL AS DOUBLE) AS rmse_displacement,
  CASE WHEN o_orderstatus = 'P' THEN '60' ELSE '?' END AS n_trials FROM orders)"""


@query(
    "run_table",
    f"WITH {_RUNS} SELECT *, CASE WHEN r2_displacement < 0.95e0 OR r2_von_mises < 0.95e0 THEN 1 ELSE 0 END AS below_threshold FROM runs",
)
def run_table(spark, sf):
    path = runs.append_run(run_rows(spark, sf), new_path(spark, "runs"))
    return starts(runs.run_table(spark.read.parquet(path)), "start_time")


@query("latest_run", f"WITH {_RUNS} SELECT run_id, start_time, r2_von_mises FROM runs ORDER BY start_time DESC, run_id DESC LIMIT 10")
def latest_run(spark, sf):
    newest = runs.latest_runs(runs.run_table(run_rows(spark, sf)))
    return starts(newest.select("run_id", "start_time", "r2_von_mises"), "start_time")


@query(
    "latest_version",
    """SELECT o_orderpriority AS name, max('v' || strftime(o_orderdate, '%Y%m%d_%H%M%S')) AS latest_version,
    count(DISTINCT 'v' || strftime(o_orderdate, '%Y%m%d_%H%M%S')) AS n_versions FROM orders GROUP BY 1""",
)
def latest_version(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("name"), version_string(F.col("o_orderdate")).alias("version")
    )
    return runs.latest_version(rows)


# --- streams: drained over the same tables, compared with the batch form -----------------------------------
def log_stream(spark, sf, files_per_trigger: int | None = None) -> DataFrame:
    schema = table(spark, sf, "events").schema
    return monitor.request_log(stream_parquet(spark, f"{sf}/events.parquet", schema, files_per_trigger))


# A window is closed once the watermark (newest event minus the delay) has passed its end.
_CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM log)"


@query(
    "stream_request_rate",
    f"""WITH {LOG} SELECT {_STAMP.format(_HOUR)}, count(*) AS n, sum(CASE WHEN status LIKE '5%' THEN 1 ELSE 0 END)::bigint AS n_errors
    FROM log GROUP BY {_HOUR} HAVING {_HOUR} + INTERVAL 1 HOUR <= {_CLOSED}""",
)
def stream_request_rate(spark, sf):
    out = new_path(spark, "stream")
    jobs.drain(jobs.stream_windows(log_stream(spark, sf), "1 hour", "1 hour"), out, new_path(spark, "state"))
    return starts(spark.read.parquet(out).select("window_start", "n", "n_errors"))


@query(
    "stream_rate_by_handler",
    f"""WITH {LOG} SELECT {_STAMP.format(_DAY)}, handler, count(*) AS n FROM log GROUP BY {_DAY}, handler HAVING {_DAY} + INTERVAL 1 DAY <= {_CLOSED}""",
)
def stream_rate_by_handler(spark, sf):
    out = new_path(spark, "stream")
    jobs.drain(jobs.stream_windows(log_stream(spark, sf), "1 day", "1 hour", ("handler",)), out, new_path(spark, "state"))
    return starts(spark.read.parquet(out).select("window_start", "handler", "n"))


@query(
    "stream_latency",
    f"""WITH {LOG} SELECT {_STAMP.format(_DAY)}, count(*) AS n, quantile_disc(duration_ms, 0.5) AS p50, quantile_disc(duration_ms, 0.95) AS p95,
    quantile_disc(duration_ms, 0.99) AS p99 FROM log GROUP BY {_DAY} HAVING {_DAY} + INTERVAL 1 DAY <= {_CLOSED}""",
)
def stream_latency(spark, sf):
    """Quantiles are those of a sketch, which are exact values of the log up to 10,000 rows a window."""
    out = new_path(spark, "stream")
    jobs.drain(jobs.stream_windows(log_stream(spark, sf), "1 day", "1 hour"), out, new_path(spark, "state"))
    return starts(spark.read.parquet(out).select("window_start", "n", "p50", "p95", "p99"))


@query(
    "stream_alerts",
    f"""WITH {LOG}, series AS (SELECT {_HOUR} AS w, handler, count(*) / 3600e0 AS eps FROM log WHERE status LIKE '5%' GROUP BY 1, 2
      HAVING {_HOUR} + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM log WHERE status LIKE '5%')),
    breaching AS (SELECT *, epoch(w)::bigint // 3600 - row_number() OVER (PARTITION BY handler ORDER BY w) AS island FROM series WHERE eps > {_ERROR_LIMIT}e0)
    SELECT handler, {_STAMP.format('w')}, row_number() OVER (PARTITION BY handler, island ORDER BY w) * 3600 AS held_s,
    CASE WHEN row_number() OVER (PARTITION BY handler, island ORDER BY w) >= 2 THEN 1 ELSE 0 END AS firing FROM breaching""",
)
def stream_alerts(spark, sf):
    windows, out = new_path(spark, "windows"), new_path(spark, "stream")
    jobs.drain(jobs.stream_error_windows(log_stream(spark, sf), "1 hour", "1 hour"), windows, new_path(spark, "state"))
    closed = stream_parquet(spark, windows, spark.read.parquet(windows).schema)
    jobs.drain(jobs.stream_held(closed, "1 hour", "2 hours", _ERROR_LIMIT), out, new_path(spark, "state"))
    return starts(spark.read.parquet(out).withColumn("firing", F.col("firing").cast("int")))


@query("stream_ingest", f"{WAREHOUSE} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, * EXCLUDE (ts) FROM clean")
def stream_ingest(spark, sf):
    """The batch cleaning's rows, all columns, from a stream of raw files."""
    lake, out = new_path(spark, "raw"), new_path(spark, "stream")
    rows = plates(spark, sf).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
    rows.write.parquet(lake)
    jobs.drain(jobs.stream_clean(stream_parquet(spark, lake, rows.schema)), out, new_path(spark, "state"))
    return jobs.newest_complete(spark.read.parquet(out)).withColumn("ts", stamp("timestamp")).drop("timestamp")


def _in_batches(spark, sf, step, size: str, delay: str = "1 hour", batches=None) -> tuple[str, str]:
    """The log in batches by time (or as given), each drained before the next comes; paths of output and state."""
    lake, out, state = new_path(spark, "log"), new_path(spark, "stream"), new_path(spark, "state")
    rows = log_rows(spark, sf).withColumnRenamed("status", "status_code")
    day = F.dayofmonth("ts")
    for batch in batches(rows) if batches else [rows.where((day >= a) & (day < a + 8)) for a in range(1, 32, 8)]:
        batch.write.mode("append").parquet(lake)
        ordered.drain_in_order(stream_parquet(spark, lake, rows.schema), out, state, delay, size, step)
    return out, state


# What is final: the log before the newest time less the delay, rounded down to a window.
_FINAL = "(SELECT time_bucket(INTERVAL 1 {0}, max(ts) - INTERVAL 1 HOUR) FROM log)"


@query(
    "stream_transitions",
    f"""WITH {LOG}, samples AS (SELECT job, event_id, ts, CASE WHEN status LIKE '5%' THEN 0 ELSE 1 END AS up FROM log WHERE ts < {_FINAL.format('HOUR')}),
    lagged AS (SELECT *, lag(up) OVER (PARTITION BY job ORDER BY ts, event_id) AS previous FROM samples)
    SELECT job, event_id, previous, up FROM lagged WHERE up <> previous""",
)
def stream_transitions(spark, sf):
    """The transitions of the batch query among final rows, from four batches."""
    out, _ = _in_batches(spark, sf, ordered.transitions(), "1 hour")
    return ordered.output(spark, out).select("job", "event_id", "previous", "up")


@query(
    "stream_uptime",
    f"""WITH {LOG}, last_sample AS (SELECT job, w, up FROM (SELECT job, {_DAY} AS w, CASE WHEN status LIKE '5%' THEN 0 ELSE 1 END AS up,
      row_number() OVER (PARTITION BY job, {_DAY} ORDER BY ts DESC, event_id DESC) AS rn FROM log WHERE ts < {_FINAL.format('DAY')}) WHERE rn = 1),
    spine AS (SELECT job, unnest(generate_series(min(w), {_FINAL.format('DAY')} - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS w FROM last_sample GROUP BY job)
    SELECT job, {_STAMP.format('s.w')}, CASE WHEN up IS NULL THEN 'no_data' WHEN up < 1 THEN 'down' ELSE 'up' END AS state
    FROM spine s LEFT JOIN last_sample l USING (job, w)""",
)
def stream_uptime(spark, sf):
    """States of closed windows; jobs that send nothing are reported as time goes on."""
    out, _ = _in_batches(spark, sf, ordered.uptime("1 day"), "1 day")
    return starts(ordered.output(spark, out))


@query(
    "stream_latency_alert",
    f"""WITH {LOG.replace('log AS', 'whole AS', 1)}, log AS (SELECT * FROM whole WHERE ts < {_FINAL.format('DAY').replace('log', 'whole')}), {_histogram_sql(0.99)},
    breaching AS (SELECT w, epoch(w)::bigint // 86400 - row_number() OVER (ORDER BY w) AS island FROM quantiles WHERE quantile > 230e0),
    runs AS (SELECT min(w) AS started, count(*) AS n_windows FROM breaching GROUP BY island)
    SELECT strftime(started, '%Y-%m-%d %H:%M:%S') AS started, n_windows FROM runs WHERE n_windows >= 2""",
)
def stream_latency_alert(spark, sf):
    """Episodes of the batch query over closed windows, held across batches."""
    out, state = _in_batches(spark, sf, ordered.latency_alert("1 day", "2 days", BOUNDS, 230.0), "1 day")
    return starts(ordered.latency_episodes(spark, out, state, "1 day", "2 days"), "started")


@query(
    "stream_late",
    f"""WITH {LOG}, ahead AS (SELECT ts + INTERVAL 60 DAY AS ts FROM log),
    first_mark AS (SELECT time_bucket(INTERVAL 1 HOUR, max(ts) - INTERVAL 1 HOUR) AS m FROM log),
    second_mark AS (SELECT time_bucket(INTERVAL 1 HOUR, max(ts) - INTERVAL 1 HOUR) AS m FROM ahead)
    SELECT handler, (SELECT count(*) FROM log b WHERE b.handler = a.handler AND b.ts < (SELECT m FROM second_mark))
      + (SELECT count(*) FROM log b WHERE b.handler = a.handler AND b.ts + INTERVAL 60 DAY < (SELECT m FROM first_mark)) AS n_late FROM log a GROUP BY handler""",
)
def stream_late(spark, sf):
    """Three batches: on time, far ahead, and late. The late rows fall behind the watermark; every one is counted."""
    ahead = lambda rows: rows.withColumn("ts", F.col("ts") + F.expr("INTERVAL 60 DAYS"))
    _, state = _in_batches(spark, sf, ordered.transitions(), "1 hour", batches=lambda rows: [rows, ahead(rows), rows])
    schema = log_rows(spark, sf).withColumnRenamed("status", "status_code").schema
    handlers = log_rows(spark, sf).select("handler").distinct()
    late = ordered.late_rows(spark, state, schema).groupBy("handler").agg(F.count("*").alias("n_late"))
    return handlers.join(late, "handler", "left").withColumn("n_late", F.coalesce("n_late", F.lit(0).cast("long")))

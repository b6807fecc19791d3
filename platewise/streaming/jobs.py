"""Streams over growing folders. Every job takes a checkpoint path in shared storage and an output path."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from platewise.models.regress import PlateModel, predict_cases
from platewise.operators.clean import cast_timestamp, drop_null_critical, latest_per_key, pseudonymize
from platewise.operators.monitor import SERVER_ERROR, seconds_of
from platewise.schema import nan_to_null


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Process everything that is there now, then stop; a later call goes on where this one ended."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def stream_clean(raw: DataFrame) -> DataFrame:
    """Streaming form of the cleaning job: every copy, cast and with hashed ids, for an append-only log.

    It keeps no state. ``newest_complete`` reads the log as the batch job would clean it: which copy is newest is
    decided over all of them, however late they come.
    """
    return raw.transform(nan_to_null).transform(cast_timestamp).transform(pseudonymize)


def newest_complete(log: DataFrame) -> DataFrame:
    """One row per id of an ingest log: the newest copy, if it is complete."""
    return log.transform(latest_per_key).transform(drop_null_critical)


def stream_predict(plate_model: PlateModel, cases: DataFrame) -> DataFrame:
    """Streaming form of batch prediction: a narrow, stateless projection."""
    return predict_cases(plate_model, cases)


def stream_windows(log: DataFrame, size: str, delay: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Requests, server errors and approximate latency quantiles per closed window."""
    wrong = F.col("status").like(SERVER_ERROR)
    aggregates = [
        F.count("*").alias("n"),
        F.count_if(wrong).alias("n_errors"),
        F.percentile_approx("duration_ms", [0.5, 0.95, 0.99], 10_000).alias("_q"),
    ]
    return (
        log.withWatermark("ts", delay)
        .groupBy(F.window("ts", size).alias("_w"), *by)
        .agg(*aggregates)
        .select(
            F.col("_w.start").alias("window_start"),
            *by,
            "n",
            "n_errors",
            *[F.col("_q")[i].alias(name) for i, name in enumerate(("p50", "p95", "p99"))],
        )
    )


ALERT_OUTPUT = "handler string, window_start timestamp, held_s long, firing boolean"
ALERT_STATE = "last_end long, held_s long"


def _hold_state(step: int, hold_s: int) -> Callable:
    """State per handler: the end of its last breaching window and how long the breach has lasted."""

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last_end, held_s = state.get if state.exists else (-1, 0)
        # A batch brings one row per closed window of the handler, never log rows.
        rows = pd.concat(list(batches)).sort_values("start_s")
        out = []
        for start, breach in zip(rows["start_s"], rows["breach"]):
            if not breach:
                held_s = 0
                continue
            held_s = held_s + step if start == last_end else step
            last_end = int(start) + step
            out.append((key[0], pd.Timestamp(int(start), unit="s"), held_s, held_s >= hold_s))
        state.update((last_end, held_s))
        yield pd.DataFrame(out, columns=["handler", "window_start", "held_s", "firing"])

    return advance


def stream_error_windows(log: DataFrame, size: str, delay: str) -> DataFrame:
    """First stage of the error alert: server errors per handler and closed window."""
    return (
        log.withWatermark("ts", delay)
        .filter(F.col("status").like(SERVER_ERROR))
        .groupBy(F.window("ts", size).alias("_w"), "handler")
        .agg(F.count("*").alias("n_errors"))
        .select("handler", F.unix_seconds(F.col("_w.start")).alias("start_s"), "n_errors")
    )


def stream_held(windows: DataFrame, size: str, hold: str, limit: float) -> DataFrame:
    """Second stage: breaching windows with the time the breach has been held, across micro-batches.

    It reads the table the first stage writes, so its state and its input are one row per window, however
    long the log is.
    """
    step = seconds_of(size)
    judged = windows.select("handler", "start_s", (F.col("n_errors") / step > limit).alias("breach"))
    return judged.groupBy("handler").applyInPandasWithState(
        _hold_state(step, seconds_of(hold)), ALERT_OUTPUT, ALERT_STATE, "append", GroupStateTimeout.NoTimeout
    )

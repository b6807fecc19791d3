"""Streams that need rows in the order of their times: closed behind a watermark, late rows kept apart, state in tables.

Every micro-batch cuts its rows and those still open at a watermark, the newest time less a delay, rounded down to a
window. Rows before it are final: no later row can come before them. Rows before the watermark of the batch before are
late and go to a side table, counted one by one. What a job has to remember goes to a small table. All tables of a
batch lie in folders of its number, so that a batch that runs again writes the same again. The work on final rows is
that of the batch operators, so a job with a third of the log is split as there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from platewise.operators.monitor import SERVER_ERROR, histogram_quantile, seconds_of, state_transitions

# Final rows, the carried table (None in the first batch) and the watermark in seconds, to output and next carried table.
Step = Callable[[DataFrame, DataFrame | None, int], tuple[DataFrame, DataFrame]]
_META = "watermark long"


def drain_in_order(stream: DataFrame, out: str, state: str, delay: str, size: str, step: Step) -> None:
    """Process everything that is there now, batch by batch; a later call goes on where this one ended."""
    wait, width = seconds_of(delay), seconds_of(size)

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema(_META).parquet(f"{state}/meta/{number - 1}").first().watermark if number else None
        newest = batch.agg(F.max(F.unix_seconds("ts"))).first()[0]
        cut = None if newest is None else (newest - wait) // width * width
        mark = before if cut is None else cut if before is None else max(before, cut)
        seconds = F.unix_seconds("ts")
        status = F.when(seconds < F.lit(before), "late").when(seconds < F.lit(mark), "final").otherwise("open")
        rows = batch.withColumn("status", F.coalesce(status, F.lit("open")))
        if number:
            held = spark.read.schema(batch.schema).parquet(f"{state}/rows/batch={number - 1}/status=open")
            rows = rows.unionByName(held.withColumn("status", F.when(seconds < F.lit(mark), "final").otherwise("open")))
        path = f"{state}/rows/batch={number}"
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("status").parquet(path)
        batch.limit(0).write.mode("append").parquet(f"{path}/status=open")  # can be read though no row is open
        final = spark.read.schema(rows.schema).parquet(path).where("status = 'final'").drop("status")
        carried = spark.read.parquet(f"{state}/carried/{number - 1}") if number else None
        made, keep = step(final, carried, 0 if mark is None else mark)
        made.write.mode("overwrite").parquet(f"{out}/{number}")
        keep.write.mode("overwrite").parquet(f"{state}/carried/{number}")
        spark.createDataFrame([(mark,)], _META).coalesce(1).write.mode("overwrite").parquet(f"{state}/meta/{number}")

    query = stream.writeStream.foreachBatch(process).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def output(spark: SparkSession, out: str) -> DataFrame:
    """All that the batches have given."""
    return spark.read.parquet(f"{out}/*")


def carried(spark: SparkSession, state: str, name: str = "carried") -> DataFrame:
    """What the last batch left to be remembered."""
    last = spark.read.schema(_META).parquet(f"{state}/meta/*").select(F.max(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).cast("int"))).first()[0]
    return spark.read.parquet(f"{state}/{name}/{last}")


def late_rows(spark: SparkSession, state: str, schema: StructType) -> DataFrame:
    """Every row that came after the watermark had passed it, with all its columns and the number of its ``batch``."""
    whole = StructType([*schema.fields, StructField("batch", IntegerType()), StructField("status", StringType())])
    return spark.read.schema(whole).parquet(f"{state}/rows").where("status = 'late'").drop("status")


def _up() -> Column:
    return F.when(F.col("status_code").like(SERVER_ERROR), 0).otherwise(1)


def transitions(by: str = "job") -> Step:
    """Samples whose state differs from the job's sample before, over all batches."""

    def step(final: DataFrame, before: DataFrame | None, mark: int) -> tuple[DataFrame, DataFrame]:
        rows = final.withColumnRenamed("status_code", "status").select(by, "event_id", "ts", "status")
        if before is not None:
            rows = rows.unionByName(before)
        newest = rows.groupBy(by).agg(F.max_by(F.struct("event_id", "ts", "status"), F.struct("ts", "event_id")).alias("s")).select(by, "s.*")
        return state_transitions(rows, by), newest

    return step


def uptime(size: str, by: str = "job") -> Step:
    """State of every job and closed window from the job's first on; a window without a sample is ``no_data``."""
    width = seconds_of(size)

    def step(final: DataFrame, before: DataFrame | None, mark: int) -> tuple[DataFrame, DataFrame]:
        last = final.groupBy(by, F.floor(F.unix_seconds("ts") / width).alias("w")).agg(F.max_by(_up(), F.struct("ts", "event_id")).alias("up"))
        first = last.groupBy(by).agg(F.min("w").alias("next"))
        if before is not None:  # jobs that sent nothing go on as well
            first = first.unionByName(before).groupBy(by).agg(F.min("next").alias("next"))
        end = mark // width
        spine = first.where(F.col("next") < end).select(by, F.explode(F.sequence(F.col("next"), F.lit(end - 1).cast("long"))).alias("w"))
        state = F.when(F.col("up").isNull(), "no_data").when(F.col("up") < 1, "down").otherwise("up")
        made = spine.join(last, [by, "w"], "left").select(by, F.timestamp_seconds(F.col("w") * width).alias("window_start"), state.alias("state"))
        return made, first.select(by, F.lit(end).cast("long").alias("next"))

    return step


def latency_alert(size: str, hold: str, bounds: Sequence[float], limit: float, probability: float = 0.99) -> Step:
    """Episodes in which the bucketed latency quantile of closed windows stayed above the limit; the open one is carried."""
    width = seconds_of(size)

    def step(final: DataFrame, before: DataFrame | None, mark: int) -> tuple[DataFrame, DataFrame]:
        keyed = final.select(F.floor(F.unix_seconds("ts") / width).alias("w"), "duration_ms")
        series = histogram_quantile(keyed, probability, bounds, ["w"]).where(F.col("quantile") > limit)
        runs = series.select(F.col("w").alias("first"), F.col("w").alias("last"))
        if before is not None:
            runs = runs.unionByName(before)
        # One row per breaching window of the batch, not per row of the log.
        order = Window.orderBy("first")
        new = F.coalesce((F.col("first") != F.lag("last").over(order) + 1).cast("int"), F.lit(1))
        runs = runs.withColumn("new", new).withColumn("run", F.sum("new").over(order))
        runs = runs.groupBy("run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")
        open_ = F.col("last") == mark // width - 1
        return _episodes(runs.where(~open_), width, hold), runs.where(open_)

    return step


def _episodes(runs: DataFrame, width: int, hold: str) -> DataFrame:
    n = F.col("last") - F.col("first") + 1
    return runs.where(n * width >= seconds_of(hold)).select(F.timestamp_seconds(F.col("first") * width).alias("started"), n.alias("n_windows"))


def latency_episodes(spark: SparkSession, out: str, state: str, size: str, hold: str) -> DataFrame:
    """Ended episodes, and the one that still goes on if it has been held long enough."""
    return output(spark, out).unionByName(_episodes(carried(spark, state), seconds_of(size), hold))

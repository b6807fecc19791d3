"""A training run from feature store to record: model, importances as CSV, scores, and one row that commits them."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.constants import METRIC_NAMES
from platewise.functions.naming import metric_name
from platewise.models.regress import DEFAULTS, PlateModel, evaluate, feature_importance, fit_plate_model, load_plate_model, tree_counts
from platewise.operators.runs import RUN_SCHEMA, append_run
from platewise.sources.files import dataset_fingerprint


def row_fingerprint(df: DataFrame) -> DataFrame:
    """One row: ``fingerprint`` and ``n_rows`` of a table, from the digests of its rows; the order of rows has no part in it."""
    digest = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    return dataset_fingerprint(df.select(digest.alias("sha256"))).withColumnRenamed("n_files", "n_rows")


def write_importances(model: PlateModel, path: str) -> None:
    """Two CSV files per target, by number of splits and by gain: ``feature,importance``, greatest first."""
    table = feature_importance(model)
    for target in model.models:
        for kind, column in (("split", "n_splits"), ("gain", "gain")):
            rows = table.where(F.col("target") == target).select("feature", F.col(column).alias("importance"))
            # A row per feature: one sorted file.
            rows.repartition(1).sortWithinPartitions(F.desc("importance"), "feature").write.mode("overwrite").csv(f"{path}/feature_importance_{kind}_{target}", header=True)


def run_record(model: PlateModel, store: DataFrame, run_id: str, start_ms: int, params: dict) -> DataFrame:
    """One row of the run table: observed counts, scores of every target and split, trees kept, parameters, fingerprint."""
    spark = store.sparkSession
    scores = evaluate(model, store).unpivot(["target", "split"], list(METRIC_NAMES), "metric", "value").where("split <> 'train'")
    sizes = store.groupBy("split").agg(F.count("*").cast("double").alias("value")).select(F.concat_ws("_", F.lit("n"), "split").alias("key"), "value")
    kept = tree_counts(model).select(metric_name(F.col("target"), F.lit("n"), F.lit("trees")).alias("key"), F.col("n_trees").cast("double").alias("value"))
    pairs = scores.select(metric_name(F.col("target"), F.col("split"), F.col("metric")).alias("key"), "value").unionByName(sizes).unionByName(kept)
    # Some dozens of pairs.
    metrics = pairs.agg(F.sort_array(F.collect_list(F.struct("key", "value"))).alias("metrics"))
    print_ = row_fingerprint(store).select(F.col("fingerprint"))
    named = [F.struct(F.lit(k).alias("key"), F.lit(str(v)).alias("value")) for k, v in sorted(params.items())]
    values = metrics.withColumn("fingerprint", print_.scalar())
    record = values.select(
        F.lit(run_id).alias("run_id"),
        F.lit(start_ms).cast("long").alias("start_ms"),
        F.lit("FINISHED").alias("status"),
        "metrics",
        F.array(*named, F.struct(F.lit("dataset_fingerprint").alias("key"), F.col("fingerprint").alias("value"))).alias("params"),
    )
    return spark.createDataFrame(record.collect(), RUN_SCHEMA)  # one row


def train_and_record(store: DataFrame, path: str, run_id: str, version: str = "v1", **params) -> PlateModel:
    """Fit, save ``model/<run>``, write ``importance/<run>``, then append the record to ``runs``.

    The record comes last: a run that is listed there has all of its parts.
    """
    start_ms = int(time.time() * 1000)
    model = fit_plate_model(store, version=version, **params)
    model.save(f"{path}/model/{run_id}")
    model = load_plate_model(store.sparkSession, f"{path}/model/{run_id}", tuple(model.models))
    write_importances(model, f"{path}/importance/{run_id}")
    append_run(run_record(model, store, run_id, start_ms, DEFAULTS | params | {"version": version}), f"{path}/runs")
    return model

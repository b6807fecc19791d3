"""Model jobs and streams on the smallest tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from platewise.catalog.base import log_rows
from platewise.catalog.learning import stored, plate_model
from platewise.models import regress
from platewise.operators import monitor
from platewise.operators.features import engineer_features
from platewise.sources.lake import stream_parquet
from platewise.streaming import jobs, ordered

SF = "/root/testdata/sf0.001"


def run(spark, name):
    return entry.queries()[name](spark, SF)


def test_plate_model_beats_the_mean(spark):
    rows = {(r["target"], r["split"]): r for r in run(spark, "gbt_train_score").collect()}
    assert set(s for _, s in rows) == {"train", "val", "test"}
    assert rows["max_von_mises_pa", "train"]["r2_log"] > 0.5
    assert rows["max_von_mises_pa", "test"]["r2_log"] > 0.0


def test_saved_plate_model_scores_the_same(spark, tmp_path):
    one = plate_model(spark, SF)
    two = regress.load_plate_model(spark, one.save(str(tmp_path / "m")))
    a = regress.evaluate(one, stored(spark, SF)).orderBy("target", "split").collect()
    b = regress.evaluate(two, stored(spark, SF)).orderBy("target", "split").collect()
    assert [tuple(r)[:2] for r in a] == [tuple(r)[:2] for r in b]
    assert [r["r2_log"] for r in a] == pytest.approx([r["r2_log"] for r in b])


def test_stream_and_batch_predictions_agree(spark):
    keys = ["simulation_id", "max_displacement_m", "max_von_mises_pa"]
    batch, stream = run(spark, "predict_batch").select(*keys), run(spark, "stream_predict").select(*keys)
    assert batch.count() > 0
    assert batch.exceptAll(stream).count() == 0 and stream.exceptAll(batch).count() == 0


def test_unknown_category_is_scored(spark, plate_rows):
    rows = engineer_features(plate_rows({"material_category": "wood"}))
    assert regress.score(plate_model(spark, SF), rows).first()["predicted_max_von_mises_pa"] > 0


def test_null_features_raise(spark):
    broken = stored(spark, SF).withColumn("length_m", F.when(F.col("simulation_id") > "8", F.col("length_m")))
    with pytest.raises(ValueError, match="null"):
        regress.fit_plate_model(broken)


def test_importance_and_monotone(spark):
    importance = run(spark, "feature_importance").filter("target = 'max_von_mises_pa'")
    assert importance.agg(F.sum("gain")).first()[0] == pytest.approx(1.0)
    assert importance.agg(F.sum("n_splits")).first()[0] > 0
    found = run(spark, "monotone_check").collect()
    assert len(found) == 16 and sum(r.n_violations for r in found) == 0  # training keeps the signs


def test_search_draws(spark):
    draws = regress.draw_parameters(50, seed=3)
    assert draws == regress.draw_parameters(50, seed=3)
    assert all(0.01 <= d["learning_rate"] <= 0.2 and 400 <= d["n_estimators"] <= 2000 and d["n_estimators"] % 100 == 0 for d in draws)
    assert all(set(d) == set(regress.SEARCH_SPACE) and 1e-8 <= d["reg_alpha"] <= 10 and 31 <= d["num_leaves"] <= 255 for d in draws)


def test_folds_cover_all_rows(spark):
    sizes = regress.with_fold(stored(spark, SF)).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in sizes) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("name", ["pca_fields", "kmeans_geometry", "field_classifier", "file_inventory", "qq_line", "field_store"])
def test_rows_only_queries(spark, name):
    assert run(spark, name).count() > 0


def _drained(spark, tmp_path, batches, step, size="1 hour", delay="1 hour"):
    lake, out, state = (str(tmp_path / n) for n in ("lake", "out", "state"))
    schema = "job string, event_id long, ts timestamp, status_code string, duration_ms double"
    for batch in batches:
        rows = [(j, i, pd.Timestamp(t, unit="s").to_pydatetime(), s, d) for j, i, t, s, d in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(lake)
        source = stream_parquet(spark, lake, spark.read.parquet(lake).schema)
        ordered.drain_in_order(source, out, state, delay, size, step)
    return out, state, spark.read.parquet(lake).schema


def test_rows_out_of_order_give_the_transitions_of_the_ordered_log(spark, tmp_path):
    rng = np.random.default_rng(4)
    times = np.sort(rng.integers(0, 40 * 3600, 400))
    rows = [(f"j{rng.integers(3)}", i, int(t), "500" if rng.random() < 0.3 else "200", 1.0) for i, t in enumerate(times)]
    early = sorted(rows, key=lambda r: r[2] + rng.integers(0, 3000))  # shuffled by less than the delay
    out, state, schema = _drained(spark, tmp_path, [early[:100], early[100:250], early[250:]], ordered.transitions())
    late = ordered.late_rows(spark, state, schema).count()
    end = (int(times.max()) - 3600) // 3600 * 3600
    want, last = [], {}
    for j, i, t, s, _ in sorted(rows, key=lambda r: (r[2], r[1])):
        up = 0 if s == "500" else 1
        if t < end:
            if last.get(j, up) != up:
                want.append((j, i, last[j], up))
            last[j] = up
    got = sorted(tuple(r) for r in ordered.output(spark, out).select("job", "event_id", "previous", "up").collect())
    assert late == 0 and got == sorted(want) and len(got) > 50


def test_late_rows_are_counted_one_by_one(spark, tmp_path):
    batches = [[("a", 1, 1000, "200", 1.0), ("a", 2, 9 * 3600, "200", 1.0)], [("b", 3, 2000, "200", 1.0), ("b", 4, 2000, "200", 1.0), ("b", 5, 8 * 3600 - 1, "200", 1.0), ("b", 6, 8 * 3600, "200", 1.0)]]
    out, state, schema = _drained(spark, tmp_path, batches, ordered.transitions())
    assert sorted((r.event_id, r.batch) for r in ordered.late_rows(spark, state, schema).collect()) == [(3, 1), (4, 1), (5, 1)]


def test_silent_jobs_are_reported_as_time_goes_on(spark, tmp_path):
    batches = [[("a", 1, 100, "200", 1.0), ("b", 2, 200, "500", 1.0), ("a", 3, 2 * 3600, "200", 1.0)], [("a", 4, 6 * 3600, "200", 1.0)]]
    out, _, _ = _drained(spark, tmp_path, batches, ordered.uptime("1 hour"))
    got = {(r.job, r.window_start.hour): r.state for r in ordered.output(spark, out).collect()}
    assert got == {("a", 0): "up", ("a", 1): "no_data", ("a", 2): "up", ("a", 3): "no_data", ("a", 4): "no_data", ("b", 0): "down"} | {("b", h): "no_data" for h in range(1, 5)}


def test_a_latency_breach_is_held_across_batches(spark, tmp_path):
    slow, fast = 500.0, 1.0
    hours = [slow, slow, fast, slow, slow, slow, fast, slow]
    rows = [("a", h, h * 3600, "200", d) for h, d in enumerate(hours)]
    step = ordered.latency_alert("1 hour", "2 hours", [10.0, 400.0], 300.0)
    out, state, _ = _drained(spark, tmp_path, [rows[:2], rows[2:5], rows[5:]], step)
    got = sorted((r.started.hour, r.n_windows) for r in ordered.latency_episodes(spark, out, state, "1 hour", "2 hours").collect())
    assert got == [(0, 2), (3, 3)]


def test_one_hot_job_is_cut_over_many_tasks(spark):
    rows = [("hot" if i % 2 else f"j{i % 7}", i, i * 60, "500" if (i // 3) % 2 else "200") for i in range(4000)]
    log = spark.createDataFrame(rows, "job string, event_id long, t long, status string").withColumn("ts", F.timestamp_seconds("t"))
    found = monitor.state_transitions(log)
    want, last = [], {}
    for j, i, _, s in rows:
        up = 0 if s == "500" else 1
        if last.get(j, up) != up:
            want.append((j, i, last[j], up))
        last[j] = up
    assert sorted(tuple(r) for r in found.select("job", "event_id", "previous", "up").collect()) == sorted(want)
    stored_parts = found.sparkSession.read.parquet(found.inputFiles()[0].rsplit("/", 1)[0]).where("job = 'hot'").groupBy("_part").count().collect()
    assert len(stored_parts) >= 2


def test_alert_state_survives_restarts(spark, tmp_path):
    """Windows arrive in three batches; the breach is held across them."""
    schema = "handler string, start_s long, n_errors long"
    windows, out, state = (str(tmp_path / n) for n in ("w", "o", "s"))
    for hour, errors in enumerate((10, 10, 1, 10)):
        spark.createDataFrame([("h", hour * 3600, errors)], schema).coalesce(1).write.mode("append").parquet(windows)
        source = stream_parquet(spark, windows, spark.read.parquet(windows).schema)
        jobs.drain(jobs.stream_held(source, "1 hour", "2 hours", 5 / 3600), out, state)
    got = [(r["held_s"], r["firing"]) for r in spark.read.parquet(out).orderBy("window_start").collect()]
    assert got == [(3600, False), (7200, True), (3600, False)]


def test_stream_windows_in_several_batches(spark, tmp_path):
    """The same log in one batch or in four gives the same closed windows."""
    path, log = str(tmp_path / "log"), log_rows(spark, SF)
    for low, high in ((1, 8), (8, 15), (15, 22), (22, 32)):
        day = F.dayofmonth("ts")
        log.filter((day >= low) & (day < high)).coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    results = []
    for files in (None, 1):
        out = str(tmp_path / f"o{files}")
        stream = jobs.stream_windows(stream_parquet(spark, path, schema, files), "1 day", "1 hour")
        jobs.drain(stream, out, str(tmp_path / f"s{files}"))
        closed = spark.read.schema("window_start timestamp, n long, n_errors long").parquet(out)
        results.append(sorted(map(tuple, closed.collect())))
    assert len(results[0]) > 20
    assert results[0] == results[1]

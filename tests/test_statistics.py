import numpy as np
import pytest
from pyspark.sql import functions as F

from platewise.operators import clusters, monitor
from platewise.operators.eda import box_numbers, class_range_check, crosstab, describe_numeric, histogram, iqr_outliers, null_audit, pearson_matrix
from platewise.operators.metrics import class_report, ks_normal, qq_line, r2, regression_metrics
from platewise.operators.quantiles import exact_quantiles
from platewise.operators.ranking import first_n_per_group, group_index, value_positions
from platewise.operators.sizing import small_side


@pytest.fixture(scope="module")
def skewed(spark):
    """120,000 rows: a third of them one value, one group far larger than the others."""
    u = F.rand(7)
    return spark.range(120_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.exp(F.randn(3))).alias("v"),
        F.when(u < 0.9, "hot").when(u < 0.97, "warm").alias("g"),
    ).persist()


@pytest.mark.parametrize("accuracy", [10_000, 2_000])
def test_exact_quantiles(skewed, accuracy):
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(skewed, ["v"], probs, accuracy=accuracy).collect()
    values = skewed.toPandas()["v"].to_numpy()
    assert {r["prob"]: r["quantile"] for r in got} == pytest.approx({p: np.quantile(values, p) for p in probs}, rel=1e-12)


def test_grouped_quantiles(skewed):
    pdf = skewed.toPandas()
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(skewed, ["v"], [0.1, 0.9], by=["g"]).collect()}
    for g in ("hot", "warm", None):
        rows = pdf[pdf["g"].isna()] if g is None else pdf[pdf["g"] == g]
        for p in (0.1, 0.9):
            assert got[g, p] == pytest.approx(np.quantile(rows["v"], p), rel=1e-12)


def test_quantiles_of_few_rows(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (4.0,), (2.0,)], "v double")
    assert [r["quantile"] for r in exact_quantiles(df, ["v"], [0.5]).collect()] == [2.0]
    assert exact_quantiles(df.filter("v > 9 AND v < 10"), ["v"], [0.5]).count() == 0


def test_value_positions(skewed):
    got = {r["v"]: r for r in value_positions(skewed, "v").collect()}
    values = np.sort(skewed.toPandas()["v"].to_numpy())
    assert got[5.0]["n"] == np.sum(values == 5.0) and got[5.0]["total"] == 120_000
    for v in list(got)[:200]:
        assert got[v]["before"] == np.searchsorted(values, v)


def test_group_index(skewed):
    rows = group_index(skewed, ["g"], F.sha2(F.col("id").cast("string"), 256)).toPandas()
    for _, part in rows.groupby("g", dropna=False):
        assert sorted(part["index"]) == list(range(len(part)))


@pytest.mark.parametrize("n", [3, 1500])
def test_first_n_per_group(skewed, n):
    got = first_n_per_group(skewed, ["g"], [F.col("id")], n).toPandas()
    pdf = skewed.toPandas().sort_values("id")
    for g, part in got.groupby("g", dropna=False):
        same = pdf[pdf["g"].isna()] if not isinstance(g, str) else pdf[pdf["g"] == g]
        assert sorted(part["id"]) == sorted(same["id"].head(n))


def test_small_side(spark):
    df = spark.range(50)
    assert "broadcast" in small_side(df, 100)._jdf.queryExecution().logical().toString().lower()
    assert small_side(df, 10) is df


def test_exploration(spark):
    df = spark.createDataFrame([("a", float(i), 2.0 * i) for i in range(10)] + [("a", 1000.0, None), ("b", 3.0, 1.0)], "g string, x double, y double")
    assert histogram(df, "x", 5).agg(F.sum("n")).first()[0] == 12
    assert histogram(df.filter("g = 'b'"), "x", 4).agg(F.sum("n")).first()[0] == 1
    assert histogram(df.filter("false"), "x", 4).count() == 0
    width = (1000.0 - 0.0) / 5
    assert histogram(df, "x", 5, density=True).agg(F.sum(F.col("density") * width)).first()[0] == pytest.approx(1.0)
    assert {r["column"]: r["n_outliers"] for r in iqr_outliers(df, ["x"]).collect()} == {"x": 1}
    box = {r["g"]: r for r in box_numbers(df, "x", "g").collect()}
    assert box["a"]["n_outliers"] == 1 and box["a"]["whisker_high"] == 9.0 and box["b"]["n_outliers"] == 0
    assert [(r["column"], r["pct"]) for r in null_audit(df).collect()] == [("y", 8.3)]
    r = {(x["a"], x["b"]): x["r"] for x in pearson_matrix(df.filter("x < 100 AND g = 'a'"), ["x", "y"]).collect()}
    assert r["x", "y"] == pytest.approx(1.0) and r["y", "x"] == r["x", "y"] and r["x", "x"] == 1.0
    assert describe_numeric(df, ["x", "y"]).filter("column = 'y'").first()["count"] == 11
    assert crosstab(df, "g", "y", []).count() == 2
    check = class_range_check(df, {"a": {"x": (0.0, 5.0)}}, "g").first()
    assert (check["n_inside"], check["n_outside"]) == (6, 5)


def test_scores(spark):
    df = spark.createDataFrame([("t", "test", y, y / 10) for y in (1.0, 2.0, 4.0)], "target string, split string, y_log double, z double")
    perfect = df.select("target", "split", "y_log", F.col("y_log").alias("pred_log"), F.pow(F.lit(10.0), "y_log").alias("y"), F.lit(1.0).alias("norm"))
    row = regression_metrics(perfect).first()
    assert row["r2_log"] == 1.0 and row["rmse_log"] == 0.0 and row["mape"] == pytest.approx(0.0, abs=1e-12)
    constant = df.select(F.lit(2.0).alias("t"), F.lit(2.0).alias("p"), F.lit(3.0).alias("q"))
    assert tuple(constant.agg(r2(F.col("t"), F.col("p")), r2(F.col("t"), F.col("q"))).first()) == (1.0, 0.0)


def test_class_report(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "label string, prediction string")
    rows = {r["class"]: r for r in class_report(df).collect()}
    assert rows["a"]["precision"] == 1.0 and rows["a"]["recall"] == 0.5
    assert rows["c"]["precision"] == 0.0 and rows["c"]["f1"] == 0.0
    assert rows["accuracy"]["f1"] == 0.5 and rows["weighted avg"]["support"] == 4
    assert rows["macro avg"]["recall"] == pytest.approx(0.5)


def test_normality(spark):
    normal = spark.range(4000).select((F.randn(11) * 2 + 1).alias("v")).persist()
    line = qq_line(normal, "v").first()
    assert line["slope"] == pytest.approx(2.0, rel=0.06) and line["r"] > 0.998
    ks = ks_normal(normal, "v").first()
    z = np.sort(normal.toPandas()["v"].to_numpy())
    z = (z - z.mean()) / z.std()
    from statistics import NormalDist

    cdf = np.array([NormalDist().cdf(x) for x in z])
    n = len(z)
    expected = max(np.max(np.arange(1, n + 1) / n - cdf), np.max(cdf - np.arange(n) / n))
    assert ks["statistic"] == pytest.approx(expected, abs=1e-6) and ks["p_value"] > 0.05
    uniform = spark.range(4000).select(F.rand(5).alias("v"))
    assert ks_normal(uniform, "v").first()["p_value"] < 0.01


def brute_dbscan(points, eps, min_points):
    xy = np.array([p[1:] for p in points])
    near = ((xy[:, None, :] - xy[None, :, :]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= min_points
    label = {}
    for i in np.flatnonzero(core):
        if i in label:
            continue
        stack, label[i] = [i], points[i][0]
        while stack:
            for j in np.flatnonzero(near[stack.pop()] & core):
                if j not in label:
                    label[j] = label[i]
                    stack.append(j)
    out = {}
    for i, p in enumerate(points):
        if core[i]:
            out[p[0]] = ("core", label[i])
        else:
            reach = [label[j] for j in np.flatnonzero(near[i] & core)]
            out[p[0]] = ("border", min(reach)) if reach else ("noise", None)
    return out


@pytest.mark.parametrize("direct", [1024, 1])
def test_dbscan(spark, monkeypatch, direct):
    """A third of the points are one point; two dense blobs lie about eps apart; the rest is scattered."""
    monkeypatch.setattr(clusters, "_DIRECT", direct)
    rng = np.random.default_rng(5)
    xy = np.vstack([
        np.full((120, 2), 0.25),
        rng.uniform(0, 0.05, (60, 2)) + [2.0, 2.0],
        rng.uniform(0, 0.05, (60, 2)) + [2.0 + 0.4, 2.0],
        rng.uniform(-3, 3, (120, 2)),
    ])
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(xy)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    got = {r["id"]: (r["kind"], r["cluster"]) for r in clusters.dbscan(df, "id", "x", "y", 0.4, 8).collect()}
    assert got == brute_dbscan(points, 0.4, 8)


def test_components_of_a_chain(spark):
    vertices = spark.range(64).select(F.col("id").alias("cell"))
    edges = spark.range(63).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).filter("a <> 40")
    labels = {r["cell"]: r["label"] for r in clusters.connected_components(vertices, edges).collect()}
    assert labels == {i: 0 if i <= 40 else 41 for i in range(64)}


def samples(spark, rows):
    return spark.createDataFrame(rows, "event_id long, ts string, handler string, status string, duration_ms double, job long").withColumn(
        "ts", F.to_timestamp("ts")
    )


def test_transitions_across_buckets(spark):
    log = samples(spark, [
        (1, "2026-01-01 23:00:00", "h", "200", 1.0, 1),
        (2, "2026-01-02 01:00:00", "h", "500", 1.0, 1),
        (3, "2026-01-05 01:00:00", "h", "500", 1.0, 1),
        (4, "2026-01-05 01:00:00", "h", "200", 1.0, 1),
        (5, "2026-01-03 00:00:00", "h", "500", 1.0, 2),
    ])
    got = [(r["event_id"], r["previous"], r["up"]) for r in monitor.state_transitions(log).orderBy("event_id").collect()]
    assert got == [(2, 1, 0), (4, 0, 1)]


def test_alert_must_hold(spark):
    hours = ["00", "01", "02", "04", "05"]
    log = samples(spark, [(i, f"2026-01-01 {h}:10:00", "h", "500", 1.0, 1) for i, h in enumerate(hours)])
    one = monitor.alert_error_rate(log, "1 hour", "3 hours", limit=0.0).collect()
    assert [(str(r["started"]), r["n_windows"]) for r in one] == [("2026-01-01 00:00:00", 3)]
    assert monitor.alert_error_rate(log, "1 hour", "4 hours", limit=0.0).count() == 0


def test_bucket_quantile(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.5, 1.5, 2.5, 9.0)], "duration_ms double")
    at = lambda p: monitor.histogram_quantile(df, p, [1.0, 2.0, 3.0], []).first()["quantile"]
    assert at(0.4) == 1.5 and at(0.99) == 3.0


def test_uptime_no_data(spark):
    log = samples(spark, [(1, "2026-01-01 00:00:10", "h", "200", 1.0, 1), (2, "2026-01-01 00:02:10", "h", "500", 1.0, 1)])
    assert [r["state"] for r in monitor.uptime_last(log).orderBy("window_start").collect()] == ["up", "no_data", "down"]

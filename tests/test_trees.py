"""Tree models: growth against a plain search, patience, signs, shards, search by rungs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from platewise.catalog import learning
from platewise.models import regress, trees

SF = "/root/testdata/sf0.001"
P = regress.DEFAULTS | {"per_node": 1.0, "seed": 1, "reg_alpha": 0.0, "reg_lambda": 0.0, "subsample": 1.0, "colsample": 1.0, "min_child_samples": 5}


def made(n=1500, seed=0):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 32, (5, n)).astype(np.uint8)
    y = np.sin(bins[0] / 6.0) + 0.05 * bins[1] * (bins[2] > 15) + rng.normal(0, 0.05, n)
    return bins, y


def test_first_cut_equals_a_plain_search():
    bins, y = made()
    tree, leaf = trees.grow(bins, y, np.ones(len(y), bool), P | {"max_depth": 1}, np.arange(5), np.zeros(5), np.random.default_rng(0))

    def cost(f, c):
        low = bins[f] <= c
        return sum(((part - part.mean()) ** 2).sum() for part in (y[low], y[~low])) if 5 <= low.sum() <= len(y) - 5 else np.inf

    f, c = min(((f, c) for f in range(5) for c in range(31)), key=lambda x: cost(*x))
    assert (tree.feature[0], tree.cut[0]) == (f, c)
    assert np.allclose(tree.value[leaf], np.where(bins[f] <= c, y[bins[f] <= c].mean(), y[bins[f] > c].mean()))


def test_leaves_rows_and_depth_are_bounded():
    bins, y = made()
    tree, leaf = trees.grow(bins, y, np.ones(len(y), bool), P | {"max_depth": 6, "num_leaves": 11, "min_child_samples": 40}, np.arange(5), np.zeros(5), np.random.default_rng(0))
    assert (tree.feature < 0).sum() == 11 and np.bincount(leaf)[tree.feature[: leaf.max() + 1] < 0].min() >= 40


def test_boosting_stops_with_patience_and_is_cut_back_to_the_best():
    bins, y = made()
    held = np.arange(len(y)) % 4 == 0
    fitted = trees.boost(bins, y, ~held, held, P | {"learning_rate": 0.3, "patience": 7}, np.zeros(5))
    best = int(np.argmin(fitted.errors)) + 1
    assert len(fitted.trees) == best and len(fitted.errors) == best + 7 < 1000
    again = trees.boost(bins, y, ~held, held, P | {"learning_rate": 0.3, "n_estimators": best}, np.zeros(5))
    assert np.allclose(fitted.predicted, again.predicted) and np.isclose(np.sqrt(((y - fitted.predicted)[held] ** 2).mean()), min(fitted.errors))


def test_constrained_features_never_fall():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 40, (3, 3000)).astype(np.uint8)
    y = 0.02 * bins[0] + np.sin(bins[0] / 2.0) * 0.3 + 0.1 * bins[1] + rng.normal(0, 0.1, 3000)
    none = np.zeros(3000, bool)
    for sign in (1, -1):
        signs = np.array([sign, 0, 0])
        edges = [np.arange(39.0)] * 3
        fitted = trees.boost(bins, y, ~none, none, P | {"n_estimators": 40}, signs)
        grid = np.array([[a, 20.0, 20.0] for a in range(40)])
        out = np.zeros(40)
        for t in fitted.trees:
            threshold = np.array([edges[0][min(c, 38)] for c in t.cut])
            down, up = (np.where(t.feature < 0, np.arange(len(t.cut)), side) for side in (t.down, t.up))
            out += trees._predicted(grid, 0.0, np.array([0]), t.feature, threshold, down, up, t.value)
        assert (sign * np.diff(out) >= -1e-12).all()


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (900, 3))
    y = np.where(x[:, 0] > 0, 2.0, -1.0) + x[:, 1] ** 2 + rng.normal(0, 0.05, 900)
    rows = [(f"id{i}", *map(float, v), float(t), "train" if i % 5 else "val") for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "simulation_id string, a double, b double, c double, label double, split string").cache()


@pytest.mark.parametrize("rows", [1000, 200])
def test_saved_nodes_predict_what_tasks_fitted(spark, frame, rows, tmp_path):
    shards = trees.stored_shards(frame, ["a", "b", "c"], ["label"], (F.col("split") == "val").cast("int"), {}, rows)
    assert shards.number == -(-900 // rows) == shards.table.count() and shards.table.agg(F.sum("n")).first()[0] == 900
    nodes = regress.boosted(shards, ["label"], n_estimators=60, patience=10)[0]
    model = trees.TreeEnsemble(nodes, ["a", "b", "c"], "p")
    model.save(str(tmp_path / "m"))
    model = trees.TreeEnsemble(spark.read.parquet(str(tmp_path / "m")), ["a", "b", "c"], "p")
    out = model.transform(frame)
    by = {r.split: r.e for r in out.groupBy("split").agg(F.sqrt(F.avg((F.col("label") - F.col("p")) ** 2)).alias("e")).collect()}
    assert by["val"] < (0.9 if rows == 1000 else 1.3)  # the labels spread by 2
    if shards.number == 1:  # the stored nodes give the error that the fit has seen
        job = regress.DEFAULTS | {"seed": regress.SEED, "per_node": 1.0, "n_estimators": 60, "patience": 10, "job": 0, "label": 0, "held": 1, "forest": False}
        seen = trees.score_jobs(shards, [job])[0]
        assert by["val"] == pytest.approx((seen.sse / seen.n) ** 0.5)
    kept = model.tree_counts().first()
    assert kept.n_members == shards.number and 10 <= kept.n_trees <= 60 * shards.number
    gains = {r.position: r.gain for r in model.importance().collect()}
    assert sum(gains.values()) == pytest.approx(1) and gains[0] > gains.get(2, 0)


def test_forest_averages_all_trees(frame):
    shards = trees.stored_shards(frame, ["a", "b", "c"], ["label"], (F.col("split") == "val").cast("int"), {})
    nodes = regress.forest(shards, ["label"], n_estimators=23)[0]
    assert nodes.where("tree >= 0 AND node = 0").count() == 23
    out = trees.TreeEnsemble(nodes, ["a", "b", "c"], "p").transform(frame.where("split = 'val'"))
    assert out.agg(F.sqrt(F.avg((F.col("label") - F.col("p")) ** 2))).first()[0] < 1.0


def test_a_sample_is_bounded(frame):
    shards = trees.stored_shards(frame, ["a"], ["label"], F.lit(0), {}, shard_rows=50, most=4)
    assert shards.number == 4 and shards.table.agg(F.sum("n")).first()[0] < 400


def test_search_by_rungs_finds_what_a_full_search_finds(spark):
    store = learning.stored(spark, SF)
    space = {"learning_rate": (0.02, 0.3, "log"), "max_depth": (2, 8, 1), "n_estimators": (100, 200, 100)}
    found = {}
    for name, rungs in (("full", ()), ("rungs", (20,))):
        rows = regress.cv_search(store, "max_von_mises_pa", 6, 3, space, rungs).collect()
        assert len(rows) == 6 and {r.trial for r in rows} == set(range(6))
        found[name] = rows[0]
        assert rows[0].rmse == min(r.rmse for r in rows if r.rung == len(rungs))
    assert found["rungs"].trial == found["full"].trial and found["rungs"].rmse == pytest.approx(found["full"].rmse)


def test_cross_validation_reports_folds_and_trees(spark):
    rows = {r.fold: r for r in regress.cv_report(learning.stored(spark, SF), "max_displacement_m", n_estimators=60).collect()}
    assert set(rows) == {*"01234", "mean", "std"}
    assert rows["mean"].r2 == pytest.approx(np.mean([rows[k].r2 for k in "01234"])) and 0 < rows["mean"].n_trees <= 60
    assert rows["std"].rmse == pytest.approx(np.std([rows[k].rmse for k in "01234"]))


def test_a_fit_leaves_a_record_that_the_run_table_reads(spark, tmp_path):
    from platewise.operators.runs import run_table
    from platewise.plans.training import row_fingerprint, train_and_record

    store, path = learning.stored(spark, SF), str(tmp_path / "t")
    model = train_and_record(store, path, "fit-0001-long-name", n_estimators=30)
    row = run_table(spark.read.parquet(f"{path}/runs")).first()
    scores = {(r.target, r.split): r for r in regress.evaluate(model, store).collect()}
    assert row.run_id == "fit-0001" and row.status == "FINISHED"
    assert row.r2_displacement == pytest.approx(scores["max_displacement_m", "test"].r2_orig)
    assert row.rmse_displacement == pytest.approx(scores["max_displacement_m", "test"].rmse_orig)
    raw = spark.read.parquet(f"{path}/runs").first()
    metrics, params = ({m.key: m.value for m in pairs} for pairs in (raw.metrics, raw.params))
    assert metrics["n_train"] == store.where("split = 'train'").count() and params["n_estimators"] == "30" and params["num_leaves"] == "127"
    assert params["dataset_fingerprint"] == row_fingerprint(store.repartition(9)).first().fingerprint
    for target in model.models:
        lines = spark.read.csv(f"{path}/importance/fit-0001-long-name/feature_importance_gain_{target}", header=True).collect()
        values = [float(r.importance) for r in lines]
        assert len(lines) == len(model.features) and values == sorted(values, reverse=True) and sum(values) == pytest.approx(1)


def test_fingerprints_of_rows_count_repeats_and_not_order(spark):
    from platewise.plans.training import row_fingerprint

    rows = [(1, "a", None), (2, "b", 1.5), (2, "b", 1.5)]
    make = lambda r: row_fingerprint(spark.createDataFrame(r, "i int, s string, d double")).first()
    assert make(rows) == make(rows[::-1]) and make(rows) != make(rows[:2]) and make(rows) != make([(1, "a", 0.0), *rows[1:]])
    assert make([]).n_rows == 0


def test_counting_one_sibling_gives_the_trees_of_counting_both(monkeypatch):
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 60, (6, 3000)).astype(np.uint8)
    bins[5] = bins[0]  # ties go to the first feature
    y = np.sin(bins[0] / 9.0) + (bins[1] > 20) * bins[2] / 60.0 + 0.05 * rng.normal(size=3000)
    train = rng.random(3000) < 0.8
    p = regress.DEFAULTS | {"n_estimators": 15, "seed": 1, "per_node": 1.0}
    signs = np.array([0, 1, 0, 0, -1, 0])
    counted = []
    plain = trees._histograms
    monkeypatch.setattr(trees, "_histograms", lambda b, *a: counted.append(b.size) or plain(b, *a))
    one = trees.boost(bins, y, train, ~train, p, signs)
    first = sum(counted)
    monkeypatch.setattr(trees, "_KEPT_CELLS", 0)
    both = trees.boost(bins, y, train, ~train, p, signs)
    assert 2 * first < sum(counted) - first
    for a, b in zip(one.trees, both.trees, strict=True):
        assert all(np.array_equal(x, z) for x, z in zip(a[:4], b[:4]))
        assert np.allclose(a.value, b.value, rtol=0, atol=1e-12)


def test_packed_trees_predict_what_a_walk_finds(spark):
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 40, (4, 2000)).astype(np.uint8)
    y = np.sin(bins[0] / 7.0) + (bins[1] > 20) * bins[2] / 40.0
    part = rng.random(2000) < 0.2
    kinds = [{"num_leaves": 60}, {"num_leaves": 1}, {"num_leaves": 400, "min_child_samples": 1, "max_depth": 14}]
    rows, want = [], 0.5
    x = rng.integers(-2, 42, (777, 4)) + rng.choice([0.0, 0.5], (777, 4))
    x[0], x[1, 2], x[2] = np.nan, np.nan, np.inf
    for shard, kind in enumerate(kinds):
        fitted = trees.boost(bins, y, ~part, part, regress.DEFAULTS | {"n_estimators": 4, "seed": shard, "per_node": 1.0} | kind, np.zeros(4))
        for t, tree in enumerate(fitted.trees if shard != 1 else [trees.Tree(*[np.array(c) for c in zip((-1, 0, -1, -1, 0.25, 0.0))])]):
            cut = np.where(tree.cut == 39, np.inf, tree.cut).astype(float)
            rows += [(7, shard, t, i, *[c.item() for c in r]) for i, r in enumerate(zip(tree.feature, cut, tree.down, tree.up, tree.value, tree.gain))]
            down, up = (np.where(tree.feature < 0, np.arange(len(cut)), side) for side in (tree.down, tree.up))
            want = want + trees._predicted(x, 0.0, np.array([0]), tree.feature, cut, down, up, tree.value)
    nodes = spark.createDataFrame(rows[::-1] + [(7, 9, -1, 0, -1, 0.0, -1, -1, 0.5, 0.0)], trees._NODE).repartition(5)
    members = trees.TreeEnsemble(nodes, list("abcd"), "p")._members()
    sizes = [len(v) for *_, v in members.trees()]
    assert min(sizes) == 1 and max(sizes) > trees._MOST_LEAVES and any(1 < s <= 60 for s in sizes)
    assert np.allclose(trees._scores(x, members), want, rtol=0, atol=1e-12)
    assert trees._scores(x[:0], members).shape == (0,)
    assert (trees._scores(x, trees.TreeEnsemble(nodes.where("tree < 0"), list("abcd"), "p")._members()) == 0.5).all()

"""Supervised plate models: boosted trees and a forest baseline on normalised log targets."""

from __future__ import annotations

import random
from dataclasses import dataclass, field
from math import sqrt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from platewise.constants import CATEGORICAL_COLUMNS, FEATURE_INPUT_COLUMNS, MONOTONE_SIGNS, SEED, TARGETS
from platewise.functions.hashing import stable_bucket
from platewise.functions.numeric import linspace
from platewise.models.trees import Shards, TreeEnsemble, fit_trees, score_jobs, stored_shards
from platewise.operators.features import engineer_features, feature_columns
from platewise.operators.metrics import regression_metrics
from platewise.operators.physics import denormalize, log_targets, normalizer
from platewise.operators.ranking import encode_ordinal, vocabulary_index
from platewise.operators.requests import validate_requests
from platewise.schema import nan_to_null

# Default training parameters, and the ranges that a search draws from (ends, scale or step).
DEFAULTS = {
    "n_estimators": 1000,
    "learning_rate": 0.05,
    "num_leaves": 127,
    "max_depth": 10,
    "min_child_samples": 20,
    "subsample": 0.8,
    "colsample": 0.8,
    "reg_alpha": 0.1,
    "reg_lambda": 1.0,
    "patience": 50,
}
SEARCH_SPACE = {
    "n_estimators": (400, 2000, 100),
    "learning_rate": (0.01, 0.2, "log"),
    "num_leaves": (31, 255, 1),
    "max_depth": (8, 16, 1),
    "min_child_samples": (10, 100, 1),
    "subsample": (0.6, 1.0, "even"),
    "colsample": (0.5, 1.0, "even"),
    "reg_alpha": (1e-8, 10.0, "log"),
    "reg_lambda": (1e-8, 10.0, "log"),
}
FOREST = {"n_estimators": 100, "max_depth": 15, "min_child_samples": 5, "num_leaves": 1 << 15, "reg_alpha": 0.0, "reg_lambda": 0.0}
# Trees of a draw in each rung of a search, the share of draws that goes on to the next, and the learning rate of these
# rungs: with its own, a draw that learns slowly would be dropped for having few trees.
RUNGS, GOES_ON, RUNG_RATE = (10, 50), 1 / 5, 0.3


@dataclass
class PlateModel:
    """One fitted pipeline per target with what is needed to score raw cases."""

    models: dict[str, TreeEnsemble]
    features: list[str]
    vocabulary: DataFrame
    version: str = "v0"
    options: dict = field(default_factory=dict)

    def save(self, path: str) -> str:
        spark = self.vocabulary.sparkSession
        for target, model in self.models.items():
            model.save(f"{path}/{target}")
        self.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
        rows = [(self.version, i, c) for i, c in enumerate(self.features)]
        spark.createDataFrame(rows, "version string, position int, feature string").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{path}/features")
        return path


def load_plate_model(spark: SparkSession, path: str, targets=TARGETS) -> PlateModel:
    rows = spark.read.parquet(f"{path}/features").orderBy("position").collect()
    features = [r["feature"] for r in rows]
    models = {t: TreeEnsemble(spark.read.parquet(f"{path}/{t}"), features, f"pred_{t}") for t in targets}
    return PlateModel(models, features, spark.read.parquet(f"{path}/vocabulary"), rows[0]["version"])


def model_features(df: DataFrame) -> list[str]:
    return [c for c in feature_columns(df.columns, training=True) if c != "split" and not c.startswith("log_max_")]


def feature_nulls(df: DataFrame, features: list[str]) -> DataFrame:
    """One row: nulls and NaN in the whole feature matrix."""
    df = nan_to_null(df)
    return df.agg(F.coalesce(F.sum(sum((F.col(c).isNull().cast("int") for c in features), F.lit(0))), F.lit(0)).alias("n_null"))


def training_frame(store: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Log targets and encoded categories, with the category table fitted on train only."""
    features = model_features(store)
    vocabulary = vocabulary_index(store.filter("split = 'train'"), CATEGORICAL_COLUMNS)
    return encode_ordinal(log_targets(store), vocabulary, CATEGORICAL_COLUMNS), vocabulary, features


def boosted(shards: Shards, labels: list[str], **params) -> list[DataFrame]:
    """Boosted trees per label, stopped by the part 1 (no error drop for ``patience`` trees) and cut back to the best."""
    p = DEFAULTS | {"seed": SEED, "per_node": 1.0} | params
    jobs = [p | {"job": i, "label": i, "held": 1, "forest": False} for i in range(len(labels))]
    nodes = fit_trees(shards, jobs)
    members = nodes.where("tree < 0").groupBy("job").agg(F.count("*").alias("members"))
    averaged = nodes.join(F.broadcast(members), "job").withColumn("value", F.col("value") / F.col("members")).drop("members")
    return [averaged.where(F.col("job") == i) for i in range(len(labels))]


def forest(shards: Shards, labels: list[str], **params) -> list[DataFrame]:
    """Trees on rows drawn with replacement, each node choosing among the square root of the features; their mean."""
    p = FOREST | {"per_node": sqrt(len(shards.features)) / len(shards.features)} | params
    trees = max(1, round(p["n_estimators"] / shards.number))
    chunk = 5  # trees of one task
    parts = [(label, first) for label in range(len(labels)) for first in range(0, trees, chunk)]
    jobs = [
        p | {"job": i, "label": label, "held": 1, "forest": True, "n_estimators": min(chunk, trees - first), "seed": SEED + i} for i, (label, first) in enumerate(parts)
    ]
    nodes = fit_trees(shards, jobs)
    out = []
    for label in range(len(labels)):
        own = nodes.where(F.col("job").isin([i for i, (x, _) in enumerate(parts) if x == label]))
        out.append(own.withColumn("value", F.col("value") / float(trees * shards.number)))
    return out


def fit_plate_model(store: DataFrame, build=boosted, targets=TARGETS, version: str = "v0", **params) -> PlateModel:
    """Fit every target on train, stopping early on val; raises when a feature is null.

    Values may only rise or fall along the features of ``MONOTONE_SIGNS``. Rows beyond those that the shards of
    ``stored_shards`` hold are left out, by hash.
    """
    frame, vocabulary, features = training_frame(store)
    known = frame.filter(F.col("split").isin("train", "val"))
    if params.pop("check_nulls", True) and feature_nulls(known, features).first()["n_null"]:
        raise ValueError("null values in the feature matrix")
    labels = [f"log_{t}" for t in targets]
    signs = MONOTONE_SIGNS if build is boosted else {}
    models = {}
    # A row without one target still teaches the other; targets with the same rows share their shards.
    for own in _shared_labels(known, labels):
        shards = stored_shards(known, features, own, (F.col("split") == "val").cast("int"), signs)
        for label, nodes in zip(own, build(shards, own, **params)):
            target = label.removeprefix("log_")
            models[target] = TreeEnsemble(nodes, features, f"pred_{target}")
    return PlateModel({t: models[t] for t in targets}, features, vocabulary, version, dict(params))


def _shared_labels(rows: DataFrame, labels: list[str]) -> list[list[str]]:
    """The labels together if none is ever null, else each on its own."""
    nulls = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in labels]).first()
    return [labels] if not any(nulls) else [[c] for c in labels]


def score(plate_model: PlateModel, df: DataFrame) -> DataFrame:
    """Add ``pred_<target>`` (normalised log) and ``predicted_<target>`` (physical) to feature rows."""
    encoded = encode_ordinal(df, plate_model.vocabulary, CATEGORICAL_COLUMNS)
    for target, model in plate_model.models.items():
        encoded = model.transform(encoded)
    return encoded.withColumns({f"predicted_{t}": denormalize(F.col(f"pred_{t}"), t) for t in plate_model.models})


def evaluation_rows(scored: DataFrame, targets=TARGETS) -> DataFrame:
    """Long form ``(target, split, y, y_log, pred_log, norm)`` of scored feature rows."""
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(t).alias("target"),
                    F.col(t).alias("y"),
                    F.col(f"log_{t}").alias("y_log"),
                    F.col(f"pred_{t}").alias("pred_log"),
                    normalizer(t).alias("norm"),
                )
                for t in targets
            ]
        )
    )
    return log_targets(scored, targets).select("split", rows.alias("_r")).select("split", "_r.*").filter("y_log IS NOT NULL")


def evaluate(plate_model: PlateModel, store: DataFrame) -> DataFrame:
    """The six scores per target and split."""
    return regression_metrics(evaluation_rows(score(plate_model, store), tuple(plate_model.models)))


def predict_cases(plate_model: PlateModel, cases: DataFrame) -> DataFrame:
    """One row per case: ``reasons`` (empty when accepted) and predictions, null for a refused case.

    Cases are checked, engineered, encoded, scored and denormalised in one pass, as a stream as well. A refused case
    goes through without values, so that nothing is read twice, and its predictions are left out. Inputs and model
    version are echoed.
    """
    checked = validate_requests(cases)
    if "timestamp" not in checked.columns:
        checked = checked.withColumn("timestamp", F.current_timestamp())
    echo = ["geometry_type", "length_m", "height_m", "young_modulus_pa", "traction_pa", "hole_radius_ratio"]
    rows = checked.withColumn("_input", F.struct(*echo)).withColumn("_reasons", F.col("reasons"))
    refused = F.size("_reasons") > 0
    used = [c for c in FEATURE_INPUT_COLUMNS if c in rows.columns and c != "simulation_id"]
    rows = rows.withColumns({c: F.when(~refused, F.col(c)) for c in used})
    scored = score(plate_model, engineer_features(rows, require_targets=False))
    return scored.select(
        "simulation_id",
        F.lit(plate_model.version).alias("model_version"),
        *[F.col(f"_input.{c}").alias(c) for c in echo],
        F.col("_reasons").alias("reasons"),
        *[F.when(~refused, F.col(f"predicted_{t}")).alias(t) for t in plate_model.models],
    )


def feature_importance(plate_model: PlateModel) -> DataFrame:
    """``(target, feature, gain, n_splits)`` of every feature, from the tables of nodes."""
    spark = plate_model.vocabulary.sparkSession
    names = spark.createDataFrame(list(enumerate(plate_model.features)), "position int, feature string")
    out = None
    for target, model in plate_model.models.items():
        part = names.join(model.importance(), "position", "left").select(
            F.lit(target).alias("target"), "feature", F.coalesce("gain", F.lit(0.0)).alias("gain"), F.coalesce("n_splits", F.lit(0)).alias("n_splits")
        )
        out = part if out is None else out.unionByName(part)
    return out


def tree_counts(plate_model: PlateModel) -> DataFrame:
    """``(target, n_trees, n_members)``: trees kept after cutting back to the best, over all members."""
    out = None
    for target, model in plate_model.models.items():
        part = model.tree_counts().select(F.lit(target).alias("target"), "n_trees", "n_members")
        out = part if out is None else out.unionByName(part)
    return out


def top_features(importance: DataFrame, target: str, n: int = 15) -> DataFrame:
    return importance.filter(F.col("target") == target).orderBy(F.desc("gain"), "feature").limit(n)


def with_fold(df: DataFrame, folds: int = 5, id_col: str = "simulation_id", seed: int = SEED) -> DataFrame:
    """Fold number from the id's bucket: stable, shuffled, no shuffle of data."""
    bucket = stable_bucket(F.col(id_col), f"fold|{seed}")
    return df.withColumn("fold", F.least(F.floor(bucket * folds), F.lit(folds - 1)).cast("int"))


def _folded(store: DataFrame, target: str, folds: int) -> Shards:
    """Shards of the train split whose parts are the folds. Categories are numbered on the whole split, as a code of an
    unseen category exists either way; no label enters the numbers."""
    frame, _, features = training_frame(store.filter("split = 'train'"))
    return stored_shards(with_fold(frame, folds), features, [f"log_{target}"], F.col("fold"), MONOTONE_SIGNS)


def _fold_jobs(draws: list[tuple[int, dict]], folds: int) -> list[dict]:
    plain = {"seed": SEED, "per_node": 1.0, "label": 0, "forest": False}
    return [DEFAULTS | plain | p | {"job": trial * folds + k, "held": k} for trial, p in draws for k in range(folds)]


def cv_report(store: DataFrame, target: str, folds: int = 5, **params) -> DataFrame:
    """Per-fold R2, RMSE and trees kept on the train split, and a ``mean`` and ``std`` row (population spread).

    The held-out fold stops the boosting. All folds are fitted side by side.
    """
    shards = _folded(store, target, folds)
    scores = []
    for r in score_jobs(shards, _fold_jobs([(0, params)], folds)):  # a row per fold
        spread = r["squares"] - r["sum"] ** 2 / r["n"]
        scores.append((str(r["job"]), 1 - r["sse"] / spread if spread > 0 else None, sqrt(r["sse"] / r["n"]), r["n_trees"]))
    table = store.sparkSession.createDataFrame(scores, "fold string, r2 double, rmse double, n_trees double")
    for name, fn in (("mean", F.avg), ("std", F.stddev_pop)):
        summary = table.where("fold NOT IN ('mean', 'std')").agg(*[fn(c).alias(c) for c in ("r2", "rmse", "n_trees")])
        table = table.unionByName(summary.withColumn("fold", F.lit(name)))
    return table


def draw_parameters(n: int, seed: int = SEED, space: dict | None = None) -> list[dict]:
    """``n`` seeded draws from the search ranges: whole numbers by step, evenly, or evenly on a log scale."""
    rng, out = random.Random(seed), []
    ranges = space or SEARCH_SPACE
    for _ in range(n):
        draw = {}
        for name, (low, high, kind) in ranges.items():
            if kind == "log":
                draw[name] = low * (high / low) ** rng.random()
            elif kind == "even":
                draw[name] = rng.uniform(low, high)
            else:
                draw[name] = rng.randrange(low, high + 1, kind)
        out.append(draw)
    return out


def cv_search(
    store: DataFrame, target: str, n_trials: int, folds: int = 5, space: dict | None = None, rungs: tuple[int, ...] = RUNGS, goes_on: float = GOES_ON, **fixed
) -> DataFrame:
    """Cross-validated RMSE of parameter draws, best first: ``trial`` (0-based), ``rung``, ``rmse``, ``n_trees``, ``params``.

    Every fit stops with patience on its held-out fold. Draws start with few trees at a common high rate; only the best
    share of a rung goes on to the next, and those of the last one have all their trees and their own rate. A draw's row
    is that of the last rung it reached. Without ``rungs`` all draws are fitted in full.
    """
    shards = _folded(store, target, folds)
    draws = [(i, d | fixed) for i, d in enumerate(draw_parameters(n_trials, space=space))]
    rows, alive = {}, draws
    for rung, most in enumerate([*rungs, None]):
        capped = [(i, d if most is None else d | {"n_estimators": min(most, (DEFAULTS | d)["n_estimators"]), "learning_rate": RUNG_RATE}) for i, d in alive]
        by_trial: dict[int, list] = {}
        for r in score_jobs(shards, _fold_jobs(capped, folds)):  # a row per draw and fold
            by_trial.setdefault(r["job"] // folds, []).append(r)
        for i, d in alive:
            own = by_trial.get(i, [])
            mean = sum(sqrt(r["sse"] / r["n"]) for r in own) / len(own) if own else None
            rows[i] = (i, rung, mean, sum(r["n_trees"] for r in own) / len(own) if own else None, str(sorted(d.items())))
        ranked = sorted((x for x in alive if rows[x[0]][2] is not None), key=lambda x: rows[x[0]][2])
        alive = ranked[: max(1, round(len(alive) * goes_on))] if most is not None else []
        if not alive:
            break
    table = store.sparkSession.createDataFrame(list(rows.values()), "trial int, rung int, rmse double, n_trees double, params string")
    return table.orderBy(F.desc("rung"), F.col("rmse").asc_nulls_last(), "trial")


def monotone_check(plate_model: PlateModel, store: DataFrame, target: str, points: int = 12) -> DataFrame:
    """Sign violations per constrained feature.

    Base cases are the average plate of each material and geometry. Each constrained feature is swept over
    its observed range with everything else fixed; all sweeps are scored in one pass and compared with
    ``lag``.
    """
    signs = {f: s for f, s in MONOTONE_SIGNS.items() if s and f in plate_model.features}
    numeric = [f for f in plate_model.features if f not in CATEGORICAL_COLUMNS]
    by = list(CATEGORICAL_COLUMNS)
    base = store.groupBy(*by).agg(*[F.avg(f).alias(f) for f in numeric], F.count("*").alias("_n"))
    ends = store.agg(
        F.struct(*[F.struct(F.min(f).alias("lo"), F.max(f).alias("hi")).alias(f) for f in signs]).alias("e")
    ).scalar()
    sweeps = F.explode(
        F.array(
            *[
                F.struct(F.lit(f).alias("feature"), F.lit(s).alias("sign"), linspace(F.col("_e")[f]["lo"], F.col("_e")[f]["hi"], points).alias("grid"))
                for f, s in signs.items()
            ]
        )
    )
    # The ends enter as a column: lambdas of array functions cannot hold a subquery themselves.
    laid = base.withColumn("_e", ends).select("*", sweeps.alias("_s")).select("*", F.posexplode("_s.grid").alias("point", "_value"))
    swept = laid.withColumns(
        {f: F.when(F.col("_s.feature") == f, F.col("_value")).otherwise(F.col(f)) for f in signs}
    ).select(*by, *numeric, F.col("_s.feature").alias("feature"), F.col("_s.sign").alias("sign"), "point")
    # Encoding replaces the category columns, so the case key is kept apart.
    keyed = swept.withColumn("case", F.concat_ws("|", *by))
    encoded = encode_ordinal(keyed, plate_model.vocabulary, CATEGORICAL_COLUMNS)
    scored = plate_model.models[target].transform(encoded)
    order = Window.partitionBy("case", "feature").orderBy("point")
    step = F.col(f"pred_{target}") - F.lag(f"pred_{target}").over(order)
    return (
        scored.withColumn("_step", step)
        .groupBy("feature", "sign")
        .agg(
            F.count_if(F.col("sign") * F.col("_step") < -1e-9).alias("n_violations"),
            F.count("_step").alias("n_steps"),
        )
    )

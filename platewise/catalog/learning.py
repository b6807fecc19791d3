"""Model jobs and clusters. Values of fitted models are checked by rows and by the unit tests."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.catalog.base import cleaned, query, rounded, table
from platewise.catalog.ingest import _request_rows
from platewise.constants import TARGETS
from platewise.models import regress, unsupervised
from platewise.models.subspace import Blocks, fit_subspace, projected
from platewise.operators import fields
from platewise.operators.clusters import core_points, dbscan, standard_scale
from platewise.operators.eda import crosstab
from platewise.operators.metrics import class_report
from platewise.operators.runs import run_table
from platewise.plans.feature_store import build_feature_store
from platewise.plans.training import train_and_record
from platewise.session import new_path
from platewise.sources.lake import stream_parquet
from platewise.streaming import jobs

# Draws of the parameter search, pixels a side, components and restarts of the field queries.
TRIALS, SIZE, COMPONENTS, INITS = 60, 64, 50, 10
_GEOMETRIES = ["with_hole", "with_hole_moving", "without_hole"]


@lru_cache(maxsize=4)
def _store_path(spark: SparkSession, sf: str) -> str:
    path = new_path(spark, "store")
    # Read once, so the cleaned table need not be stored beside it.
    build_feature_store(spark, cleaned(spark, sf), path)
    return f"{path}/features"


def stored(spark, sf) -> DataFrame:
    return spark.read.parquet(_store_path(spark, sf))


@lru_cache(maxsize=4)
def _plate_model_path(spark: SparkSession, sf: str) -> str:
    fitted = regress.fit_plate_model(stored(spark, sf), version="v1")
    return fitted.save(new_path(spark, "model"))


def plate_model(spark, sf) -> regress.PlateModel:
    return regress.load_plate_model(spark, _plate_model_path(spark, sf))


@query("gbt_train_score")
def gbt_train_score(spark, sf):
    """Feature store, boosted trees per target with patience, scores on every split and the trees kept."""
    model = plate_model(spark, sf)
    return regress.evaluate(model, stored(spark, sf)).join(F.broadcast(regress.tree_counts(model)), "target")


@query("training_run")
def training_run(spark, sf):
    """The run table's row of a fit, read from the record that the fit has made."""
    path = new_path(spark, "training")
    train_and_record(stored(spark, sf), path, "fit-0001", n_estimators=100)
    row = run_table(spark.read.parquet(f"{path}/runs"))
    files = spark.read.csv(f"{path}/importance/fit-0001/*", header=True).agg(F.count("*").alias("n_importances"))
    return row.drop("start_time").withColumn("n_importances", files.scalar())


@query("evaluate_batch")
def evaluate_batch(spark, sf):
    return regress.evaluate(plate_model(spark, sf), stored(spark, sf).filter("split IN ('val', 'test')"))


@query("predict_batch")
def predict_batch(spark, sf):
    cases = _request_rows(spark, sf).withColumnRenamed("k", "case_kind").drop("max_displacement_m", "max_von_mises_pa")
    return regress.predict_cases(plate_model(spark, sf), cases).withColumn("reasons", F.array_join("reasons", ","))


@query("feature_importance")
def feature_importance(spark, sf):
    return regress.feature_importance(plate_model(spark, sf))


@query("top_features")
def top_features(spark, sf):
    return _by_target(lambda target: regress.top_features(feature_importance(spark, sf), target, 15).drop("target"))


@query("monotone_check")
def monotone_check(spark, sf):
    return _by_target(lambda target: regress.monotone_check(plate_model(spark, sf), stored(spark, sf), target))


@query("rf_baseline")
def rf_baseline(spark, sf):
    forest = regress.fit_plate_model(stored(spark, sf), build=regress.forest)
    return regress.evaluate(forest, stored(spark, sf))


def _by_target(report) -> DataFrame:
    """The report of every target, with its name."""
    parts = [report(t).select(F.lit(t).alias("target"), "*") for t in TARGETS]
    return reduce(DataFrame.unionByName, parts)


@query("cv_report")
def cv_report(spark, sf):
    return _by_target(lambda target: regress.cv_report(stored(spark, sf), target))


@query("cv_search")
def cv_search(spark, sf):
    return _by_target(lambda target: regress.cv_search(stored(spark, sf), target, TRIALS))  # best first, target by target


@query("stream_predict")
def stream_predict(spark, sf):
    """The cases of ``predict_batch`` as a stream; the two give the same rows."""
    lake, out = new_path(spark, "cases"), new_path(spark, "stream")
    cases = _request_rows(spark, sf).withColumnRenamed("k", "case_kind").drop("max_displacement_m", "max_von_mises_pa")
    cases.write.parquet(lake)
    jobs.drain(jobs.stream_predict(plate_model(spark, sf), stream_parquet(spark, lake, cases.schema)), out, new_path(spark, "state"))
    return spark.read.parquet(out).withColumn("reasons", F.array_join("reasons", ","))


# --- fields as vectors ---------------------------------------------------------------------------------------
def field_matrix(spark, sf, size: int = SIZE) -> Blocks:
    """Every plate's scaled field as a row; stored are the plates' values only."""
    rows, read = fields.field_blocks(stored(spark, sf), size, keep=("simulation_id", "geometry_type"))
    return Blocks(rows, read, size * size)


def field_points(spark, sf, components: int = COMPONENTS) -> DataFrame:
    """Every plate on the first principal components, written once for the passes that follow."""
    matrix = field_matrix(spark, sf)
    path = new_path(spark, "field-points")
    projected(matrix, fit_subspace(matrix, components), ["simulation_id", "geometry_type"]).write.parquet(path)
    return spark.read.parquet(path)


@query("pca_fields")
def pca_fields(spark, sf):
    space = fit_subspace(field_matrix(spark, sf), COMPONENTS)
    return unsupervised.cumulative_variance(unsupervised.explained_variance(space, spark))


@query("kmeans_elbow")
def kmeans_elbow(spark, sf):
    return unsupervised.kmeans_elbow(field_points(spark, sf), inits=INITS)


@query("kmeans_geometry")
def kmeans_geometry(spark, sf):
    labels = unsupervised.kmeans_labels(field_points(spark, sf), 3, inits=INITS)
    return crosstab(labels, "cluster", "geometry_type", _GEOMETRIES)


def field_rows(spark, sf, size: int = SIZE) -> DataFrame:
    rows = fields.scale_each(fields.field_vectors(stored(spark, sf), size))
    return unsupervised.as_vector(rows.select("simulation_id", "split", "geometry_type", "field"), "field")


@query("field_classifier")
def field_classifier(spark, sf):
    label = F.array_position(F.array(*[F.lit(g) for g in _GEOMETRIES]), F.col("geometry_type")) - 1
    rows = field_rows(spark, sf).withColumn("label", label.cast("double"))
    model = unsupervised.geometry_classifier(rows.filter("split = 'train'"), 3, SIZE * SIZE)
    return class_report(model.transform(rows.filter("split = 'test'")).select("label", "prediction"))


# --- vectors of the given embedding table ----------------------------------------------------------------------


@query(
    "cumulative_variance",
    """WITH dims AS (SELECT unnest(embedding)::double AS v, unnest(range(len(embedding))) AS d FROM embeddings),
    spread AS (SELECT d, var_pop(v) AS s FROM dims GROUP BY d), ratios AS (SELECT d AS component, s / (SELECT sum(s) FROM spread) AS ratio FROM spread),
    summed AS (SELECT component, ratio, sum(ratio) OVER (ORDER BY component) AS cumulative FROM ratios)
    SELECT component::int AS component, round(ratio, 9) AS ratio, round(cumulative, 9) AS cumulative,
    (SELECT min(component) + 1 FROM summed WHERE cumulative >= 0.95e0)::int AS n_needed FROM summed""",
)
def cumulative_variance(spark, sf):
    dims = table(spark, sf, "embeddings").select(F.posexplode("embedding").alias("component", "v"))
    spread = dims.groupBy("component").agg(F.var_pop(F.col("v").cast("double")).alias("s"))
    ratios = spread.select("component", (F.col("s") / spread.agg(F.sum("s")).scalar()).alias("ratio"))
    return rounded(unsupervised.cumulative_variance(ratios), 9, "ratio", "cumulative")


def _points(spark, sf) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))


_EPS, _MIN = 0.03, 8
_PAIRS = f"""p AS (SELECT vec_id, embedding[1]::double AS x, embedding[2]::double AS y FROM embeddings),
  near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM p a JOIN p b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {_EPS}e0 * {_EPS}e0),
  core AS (SELECT a AS vec_id FROM near GROUP BY a HAVING count(*) >= {_MIN})"""


@query(
    "eps_neighbors",
    f"WITH {_PAIRS} SELECT vec_id, CASE WHEN vec_id IN (SELECT vec_id FROM core) THEN 1 ELSE 0 END AS is_core FROM p",
)
def eps_neighbors(spark, sf):
    return core_points(_points(spark, sf), "vec_id", "x", "y", _EPS, _MIN)


@query(
    "dbscan",
    f"""WITH RECURSIVE {_PAIRS}, links AS (SELECT a, b FROM near WHERE a IN (SELECT vec_id FROM core) AND b IN (SELECT vec_id FROM core)),
    reach AS (SELECT vec_id AS root, vec_id AS node FROM core UNION SELECT r.root, l.b FROM reach r JOIN links l ON r.node = l.a WHERE r.root < l.b),
    named AS (SELECT node AS vec_id, min(root) AS cluster FROM reach GROUP BY node),
    border AS (SELECT n.a AS vec_id, min(c.cluster) AS cluster FROM near n JOIN named c ON n.b = c.vec_id WHERE n.a NOT IN (SELECT vec_id FROM core) GROUP BY 1)
    SELECT vec_id, CASE WHEN c.cluster IS NOT NULL THEN 'core' WHEN b.cluster IS NOT NULL THEN 'border' ELSE 'noise' END AS kind,
    coalesce(c.cluster, b.cluster) AS cluster FROM p LEFT JOIN named c USING (vec_id) LEFT JOIN border b USING (vec_id)""",
)
def density_clusters(spark, sf):
    return dbscan(_points(spark, sf), "vec_id", "x", "y", _EPS, _MIN)


@query("dbscan_fields")
def dbscan_fields(spark, sf):
    """Fields on two principal components, scaled, then clustered: plates per kind, cluster and geometry."""
    flat = field_points(spark, sf, 2)
    # Rounded: the projection is a sum of many terms, and its copies must agree between passes.
    xy = flat.select(
        "simulation_id", "geometry_type", F.round(F.col("pca_values")[0], 9).alias("x"), F.round(F.col("pca_values")[1], 9).alias("y")
    )
    found = dbscan(standard_scale(xy, ["x", "y"]), "simulation_id", "x", "y").join(xy.select("simulation_id", "geometry_type"), "simulation_id")
    return found.groupBy("kind", "cluster", "geometry_type").agg(F.count("*").alias("n"))

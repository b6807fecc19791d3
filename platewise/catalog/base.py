"""Registry, inputs derived from the given tables, and the shared pieces of the checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.constants import CRITICAL_COLUMNS
from platewise.operators.clean import clean
from platewise.operators.monitor import request_log
from platewise.operators.sizing import spread
from platewise.session import new_path
from platewise.sinks.tables import write_warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL it is checked by rows only (and by the unit tests)."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = " ".join(sql.split("\n"))
        return fn

    return add


# --- inputs ---------------------------------------------------------------------------------------
# Plates as a projection of lineitem; the same expressions run in Spark and in the checking SQL.
_TRACTION = "(2e5 + l_extendedprice * 19e0)"
_LENGTH = "(0.5e0 + (l_partkey % 171) / 1e2)"
PLATE_COLUMNS = {
    "simulation_id": "concat('sim-', l_orderkey, '-', l_linenumber)",
    "ts": "l_shipdate",
    "material_category": "CASE l_partkey % 3 WHEN 0 THEN 'steel' WHEN 1 THEN 'aluminum' ELSE 'titanium' END",
    "dimension_category": "CASE l_suppkey % 3 WHEN 0 THEN 'small' WHEN 1 THEN 'medium' ELSE 'large' END",
    "length_m": _LENGTH,
    "height_m": "0.08e0 + ((l_suppkey * 7 + l_linenumber) % 53) / 1e2",
    "young_modulus_pa": "CASE l_partkey % 3 WHEN 0 THEN 190e9 + (l_orderkey % 41) * 1e9 "
    "WHEN 1 THEN 65e9 + (l_orderkey % 14) * 1e9 ELSE 105e9 + (l_orderkey % 21) * 1e9 END",
    "poisson_ratio": "0.25e0 + (l_orderkey % 11) / 1e2",
    "traction_pa": _TRACTION,
    "mesh_nx": "120",
    "mesh_ny": "24",
    "geometry_type": "CASE WHEN l_returnflag = 'A' THEN 'without_hole' WHEN l_returnflag = 'R' THEN 'with_hole_moving' END",
    "hole_radius_ratio": "CASE WHEN l_returnflag = 'A' THEN NULL WHEN l_returnflag = 'N' AND l_partkey % 5 = 0 THEN NULL "
    "ELSE 0.05e0 + l_quantity / 2e2 END",
    "hole_cx_ratio": "CASE WHEN l_returnflag = 'R' THEN 0.3e0 + l_discount * 4e0 END",
    "hole_cy_ratio": "CASE WHEN l_returnflag = 'R' THEN 0.35e0 + l_tax * 375e-2 END",
    "max_displacement_m": f"CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE {_TRACTION} * {_LENGTH} * (0.9e0 + l_discount) / 1e11 END",
    "max_von_mises_pa": f"{_TRACTION} * (1e0 + l_quantity / 25e0) * (0.95e0 + l_tax)",
    "solver_name": "'proxy'",
    "solver_version": "'1.0'",
    "data_version": "'sim_v1'",
    "source": "CASE WHEN l_returnflag = 'A' THEN 'sim_v1_without_hole' WHEN l_returnflag = 'R' THEN 'sim_v2_moving_hole' "
    "WHEN l_linestatus = 'F' THEN 'sim_v1' ELSE 'sim_v1_wide' END",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def plates(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in PLATE_COLUMNS.items()])
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).withColumnRenamed("ts", "timestamp")


@lru_cache(maxsize=8)
def _plates_path(spark: SparkSession, sf: str) -> str:
    return write_warehouse(spread(plates(spark, sf)), new_path(spark, "plates"))


def stored_plates(spark: SparkSession, sf: str) -> DataFrame:
    """The plates as stored: written once per session, so that jobs scan columns, not the projection above."""
    return spark.read.parquet(_plates_path(spark, sf))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """The plates cleaned, from the given table: they need not be stored before, unless a query reads them too."""
    return clean(spread(plates(spark, sf)))


@lru_cache(maxsize=8)
def _warehouse_path(spark: SparkSession, sf: str) -> str:
    return write_warehouse(cleaned(spark, sf), new_path(spark, "warehouse"))


def warehouse(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned table as stored: written once per session, so that reports scan columns, not lineage."""
    return spark.read.parquet(_warehouse_path(spark, sf))


def log_rows(spark: SparkSession, sf: str) -> DataFrame:
    return request_log(table(spark, sf, "events"))


def stamp(c: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(c, fmt)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- shared SQL -----------------------------------------------------------------------------------
_names = list(PLATE_COLUMNS)
PLATES = "plates AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in PLATE_COLUMNS.items()) + " FROM lineitem)"
TOTAL_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in ["ts"] + [n for n in _names if n not in ("ts", "simulation_id")])
_complete = " AND ".join(f"{c} IS NOT NULL" for c in CRITICAL_COLUMNS)
DEDUP = f"dedup AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY simulation_id ORDER BY {TOTAL_ORDER}) AS rn FROM plates) WHERE rn = 1)"
CLEAN = (
    f"clean AS (SELECT sha256(simulation_id) AS simulation_id, {', '.join(n for n in _names if n != 'simulation_id')} "
    f"FROM dedup WHERE {_complete})"
)
WAREHOUSE = f"WITH {PLATES}, {DEDUP}, {CLEAN}"

SIGNAL = "signal AS (SELECT * FROM plates WHERE geometry_type IS NOT NULL OR hole_radius_ratio IS NOT NULL OR hole_cx_ratio IS NOT NULL)"
_other = [n for n in _names if n not in ("geometry_type", "hole_radius_ratio", "hole_cx_ratio", "hole_cy_ratio")]
FILLED = f"""filled AS (SELECT {', '.join(_other)},
  CASE WHEN geometry_type IN ('with_hole', 'without_hole', 'with_hole_moving') THEN geometry_type
       WHEN hole_cx_ratio IS NOT NULL AND hole_cy_ratio IS NOT NULL THEN 'with_hole_moving'
       WHEN hole_radius_ratio > 0 THEN 'with_hole' ELSE 'without_hole' END AS geometry_type,
  CASE WHEN hole_radius_ratio > 0 THEN 1 ELSE 0 END AS has_hole,
  CASE WHEN hole_cx_ratio IS NOT NULL AND hole_cy_ratio IS NOT NULL THEN 1 ELSE 0 END AS has_moving_hole,
  coalesce(hole_radius_ratio, 0e0) AS hole_radius_ratio,
  coalesce(hole_cx_ratio, 0.5e0) AS hole_cx_ratio,
  coalesce(hole_cy_ratio, 0.5e0) AS hole_cy_ratio FROM signal)"""
FEATURE_STEPS = """f1 AS (SELECT *, length_m * height_m AS area_m2, length_m / (height_m + 1e-12) AS aspect_ratio,
    hole_radius_ratio * least(length_m, height_m) AS radius_abs FROM filled),
  f2 AS (SELECT *, least(greatest(2e0 * radius_abs / (height_m + 1e-12), 0e0), 0.95e0) AS d_over_W FROM f1),
  f3 AS (SELECT *, CASE WHEN has_hole = 1 THEN least(greatest(3e0 + (-3.13e0) * d_over_W + 3.66e0 * (d_over_W * d_over_W)
      + (-1.53e0) * (d_over_W * d_over_W * d_over_W), 1e0), 10e0) ELSE 1e0 END AS Kt_theory,
    least(greatest(1e0 - d_over_W, 1e-3), 1e0) AS net_section_ratio FROM f2),
  f4 AS (SELECT *, traction_pa / (net_section_ratio + 1e-12) AS sigma_net,
    traction_pa / (young_modulus_pa + 1e-12) AS epsilon, 1e0 - poisson_ratio * poisson_ratio AS biaxial_factor,
    greatest(hole_cx_ratio - hole_radius_ratio, 0e0) AS lig_left,
    greatest(1e0 - hole_cx_ratio - hole_radius_ratio, 0e0) AS lig_right,
    greatest(hole_cy_ratio - hole_radius_ratio, 0e0) AS lig_bottom,
    greatest(1e0 - hole_cy_ratio - hole_radius_ratio, 0e0) AS lig_top,
    abs(hole_cx_ratio - 0.5e0) AS eccentricity_x, abs(hole_cy_ratio - 0.5e0) AS eccentricity_y FROM f3),
  f5 AS (SELECT *, Kt_theory * sigma_net AS stress_amp_proxy, epsilon * length_m AS delta_theory,
    epsilon AS traction_over_E, least(lig_left, lig_right, lig_bottom, lig_top) AS lig_min,
    sqrt(eccentricity_x * eccentricity_x + eccentricity_y * eccentricity_y) AS eccentricity FROM f4),
  f6 AS (SELECT *, hole_radius_ratio / (lig_min + 1e-12) AS edge_ratio FROM f5),
  features AS (SELECT *, round(log10(greatest(young_modulus_pa, 1e6)), 9) AS logE, round(log10(greatest(traction_pa, 1e3)), 9) AS logS,
    round(log10(greatest(epsilon, 1e-12)), 9) AS log_epsilon, round(log10(greatest(delta_theory, 1e-12)), 9) AS log_delta_th,
    round(log10(greatest(sigma_net, 1e-12)), 9) AS log_sigma_net, round(log10(greatest(Kt_theory, 1e0)), 9) AS log_Kt,
    round(log10(greatest(lig_min, 1e-12)), 9) AS log_lig_min, round(log10(greatest(edge_ratio, 1e-12)), 9) AS log_edge_ratio FROM f6)"""
FEATURES = f"WITH {PLATES}, {SIGNAL}, {FILLED}, {FEATURE_STEPS}"


def bucket_sql(key: str, seed: int | str = 42) -> str:
    return f"(('0x' || substr(sha256({key} || '|{seed}'), 1, 16))::ubigint)::double / 18446744073709551615e0"


SPLIT = f"""bucketed AS (SELECT *, {bucket_sql('simulation_id')} AS bucket FROM features),
  store AS (SELECT *, CASE WHEN bucket < 0.7e0 THEN 'train' WHEN bucket < 0.7e0 + 0.15e0 THEN 'val' ELSE 'test' END AS split FROM bucketed)"""
STORE = f"{FEATURES}, {SPLIT}"
# Targets with a hand-calculated prediction, so that scores can be checked without a model.
SCORED = """scored AS (
  SELECT simulation_id, 'max_von_mises_pa' AS target, split, geometry_type, material_category, max_von_mises_pa AS y,
    greatest(traction_pa, 1e-12) AS norm, log10(greatest(max_von_mises_pa / greatest(traction_pa, 1e-12), 1e-12)) AS y_log,
    log10(greatest(stress_amp_proxy / greatest(traction_pa, 1e-12), 1e-12)) AS pred_log FROM store WHERE max_von_mises_pa IS NOT NULL
  UNION ALL
  SELECT simulation_id, 'max_displacement_m' AS target, split, geometry_type, material_category, max_displacement_m AS y,
    greatest(delta_theory, 1e-12) AS norm, log10(greatest(max_displacement_m / greatest(delta_theory, 1e-12), 1e-12)) AS y_log,
    log10(greatest(biaxial_factor * delta_theory / greatest(delta_theory, 1e-12), 1e-12)) AS pred_log FROM store WHERE max_displacement_m IS NOT NULL)"""
RESULTS = f"{STORE}, {SCORED}"
LOG = """log AS (SELECT event_id, ts, event_type AS handler, CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status,
  value AS duration_ms, user_id AS job FROM events)"""

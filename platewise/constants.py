"""Names, bounds and coefficients every result depends on."""

from __future__ import annotations

# --- column names -----------------------------------------------------------------------------
TARGETS = ("max_displacement_m", "max_von_mises_pa")
CRITICAL_COLUMNS = (
    "max_displacement_m",
    "max_von_mises_pa",
    "length_m",
    "height_m",
    "young_modulus_pa",
    "poisson_ratio",
    "traction_pa",
)
NUMERIC_COLUMNS = (
    "length_m",
    "height_m",
    "young_modulus_pa",
    "poisson_ratio",
    "traction_pa",
    "max_displacement_m",
    "max_von_mises_pa",
)
REQUIRED_COLUMNS = (
    "simulation_id",
    "timestamp",
    "material_category",
    "dimension_category",
    "length_m",
    "height_m",
    "young_modulus_pa",
    "poisson_ratio",
    "traction_pa",
    "mesh_nx",
    "mesh_ny",
    "max_displacement_m",
    "max_von_mises_pa",
    "solver_name",
    "solver_version",
    "data_version",
)
# The feature job needs the contract without the three provenance columns.
FEATURE_INPUT_COLUMNS = REQUIRED_COLUMNS[:13]
HOLE_COLUMNS = ("hole_radius_ratio", "hole_cx_ratio", "hole_cy_ratio")
CATEGORICAL_COLUMNS = ("geometry_type", "material_category", "dimension_category")
METADATA_COLUMNS = ("simulation_id", "timestamp", "solver_name", "solver_version", "data_version")
MESH_COLUMNS = ("mesh_nx", "mesh_ny")
SOURCE_COLUMNS = ("source", "simulation_source")
CHUNK_STAT_COLUMNS = (
    "length_m",
    "height_m",
    "young_modulus_pa",
    "poisson_ratio",
    "traction_pa",
    "mesh_nx",
    "mesh_ny",
    "hole_radius_ratio",
    "hole_cx_ratio",
    "hole_cy_ratio",
    "max_displacement_m",
    "max_von_mises_pa",
)

# --- geometry -----------------------------------------------------------------------------------
WITH_HOLE = "with_hole"
WITHOUT_HOLE = "without_hole"
MOVING_HOLE = "with_hole_moving"
GEOMETRY_TYPES = (WITH_HOLE, WITHOUT_HOLE, MOVING_HOLE)
DEFAULT_RADIUS = 0.0
DEFAULT_CENTER = 0.5

# --- physics ------------------------------------------------------------------------------------
EPS = 1e-12
MAX_D_OVER_W = 0.95
# Finite-width stress concentration polynomial in d/W.
KT_COEFFICIENTS = (3.0, -3.13, 3.66, -1.53)
KT_BOUNDS = (1.0, 10.0)
NET_SECTION_FLOOR = 1e-3
MODULUS_FLOOR = 1e6
TRACTION_FLOOR = 1e3
ESTIMATE_NET_SECTION_FLOOR = 0.05
# Each target is divided by this column before the logarithm.
NORMALIZE_BY = {"max_displacement_m": "delta_theory", "max_von_mises_pa": "traction_pa"}
YIELD_MPA = {"steel": 250.0, "aluminum": 270.0, "titanium": 880.0}
SAFETY_BANDS = (1.0, 2.0)
TRACTION_TRAINED_MAX_MPA = {"steel": 2.2, "aluminum": 1.2, "titanium": 1.8}
DEFAULT_TRAINED_MAX_MPA = 2.2
FIELD_DEFAULT_RADIUS_SHARE = 0.1
FIELD_EDGE_ROWS = 4
FIELD_EDGE_BASE = 0.65
FIELD_EDGE_STEP = 0.09
FIELD_RADIUS_FLOOR = 1e-9

# --- ranges of the material and size classes ------------------------------------------------------
MATERIAL_RANGES = {
    "steel": {"young_modulus_pa": (190e9, 230e9), "poisson_ratio": (0.27, 0.31), "traction_pa": (0.5e6, 2.2e6)},
    "aluminum": {"young_modulus_pa": (65e9, 78e9), "poisson_ratio": (0.31, 0.35), "traction_pa": (0.2e6, 1.2e6)},
    "titanium": {"young_modulus_pa": (105e9, 125e9), "poisson_ratio": (0.30, 0.35), "traction_pa": (0.4e6, 1.8e6)},
}
DIMENSION_RANGES = {
    "small": {"length_m": (0.5, 0.9), "height_m": (0.08, 0.18)},
    "medium": {"length_m": (0.9, 1.4), "height_m": (0.15, 0.30)},
    "large": {"length_m": (1.4, 2.2), "height_m": (0.25, 0.60)},
}
CHUNK_ROWS = 5000
# Parameter sweeps: (low, high, points). The modulus sweep takes its ends from the material.
SWEEP_RANGES = {
    "traction_pa": (2e5, 10e6, 12),
    "hole_radius_ratio": (0.02, 0.45, 12),
    "length_m": (0.3, 3.0, 12),
    "height_m": (0.05, 1.0, 12),
}
MODULUS_SWEEP_POINTS = 12
SURFACE_TRACTION_MPA = (10.0, 80.0, 8)
SURFACE_RADIUS = (0.05, 0.40, 8)
REFERENCE_KT = 3.0

# --- split and models -----------------------------------------------------------------------------
TRAIN_RATIO = 0.7
VAL_RATIO = 0.15
SEED = 42
# Sign a feature may move a prediction in; features not listed are free.
MONOTONE_SIGNS = {
    "young_modulus_pa": -1,
    "logE": -1,
    "hole_radius_ratio": 1,
    "d_over_W": 1,
    "Kt_theory": 1,
    "edge_ratio": 1,
    "net_section_ratio": -1,
    "lig_min": -1,
}
METRIC_NAMES = ("r2_log", "rmse_log", "mae_log", "r2_orig", "rmse_orig", "mape")
OVERFIT_GAP = 0.05
UNDERFIT_R2 = 0.7
COVERAGE_Z = 1.96
RUN_R2_THRESHOLD = 0.95
DBSCAN_EPS = 0.4
DBSCAN_MIN_POINTS = 8

# --- names that carry targets ---------------------------------------------------------------------
NAME_SCALE = 10000
NAME_DISPLACEMENT_SHIFT = 12

# --- monitoring -------------------------------------------------------------------------------------
ERROR_RATE_LIMIT = 0.05
LATENCY_LIMIT_S = 2.0

import math

import pytest
from pyspark.sql import functions as F

from platewise.functions.numeric import inverse_normal, linspace, normal_cdf
from platewise.operators.features import engineer_features, feature_columns
from platewise.operators.fields import field_points, field_vectors, flip_variants
from platewise.operators.geometry import hole_inside_plate, resolve_ambiguous
from platewise.operators.physics import analytic_estimate, denormalize, log_targets, safety_assessment
from platewise.plans.feature_store import features_with_split


def expected(row):
    """The formulas by hand, in plain Python."""
    r = row["hole_radius_ratio"] or 0.0
    cx = 0.5 if row["hole_cx_ratio"] is None else row["hole_cx_ratio"]
    cy = 0.5 if row["hole_cy_ratio"] is None else row["hole_cy_ratio"]
    L, H, E, s = row["length_m"], row["height_m"], row["young_modulus_pa"], row["traction_pa"]
    d = min(max(2 * r * min(L, H) / (H + 1e-12), 0), 0.95)
    kt = min(max(3 - 3.13 * d + 3.66 * d**2 - 1.53 * d**3, 1), 10) if r > 0 else 1.0
    net = min(max(1 - d, 1e-3), 1)
    lig = min(max(cx - r, 0), max(1 - cx - r, 0), max(cy - r, 0), max(1 - cy - r, 0))
    return {
        "d_over_W": d,
        "Kt_theory": kt,
        "sigma_net": s / (net + 1e-12),
        "stress_amp_proxy": kt * s / (net + 1e-12),
        "delta_theory": s / (E + 1e-12) * L,
        "lig_min": lig,
        "edge_ratio": r / (lig + 1e-12),
        "eccentricity": math.hypot(cx - 0.5, cy - 0.5),
        "logE": math.log10(max(E, 1e6)),
        "logS": math.log10(max(s, 1e3)),
        "log_edge_ratio": math.log10(max(r / (lig + 1e-12), 1e-12)),
    }


CASES = [
    {},
    {"geometry_type": "without_hole", "hole_radius_ratio": None},
    {"geometry_type": "with_hole_moving", "hole_cx_ratio": 0.3, "hole_cy_ratio": 0.7},
    {"hole_radius_ratio": 0.5, "length_m": 0.2},
    {"hole_radius_ratio": 0.0},
    {"traction_pa": 0.0},
    {"hole_cx_ratio": 0.0, "hole_cy_ratio": 1.0, "geometry_type": "with_hole_moving"},
]


@pytest.mark.parametrize("case", CASES)
def test_formulas(plate_rows, case):
    df = plate_rows(case)
    got = engineer_features(df).first().asDict()
    for name, value in expected(df.first().asDict()).items():
        assert got[name] == pytest.approx(value, rel=1e-9, abs=1e-15), name


@pytest.mark.parametrize(
    "case, geometry, flags",
    [
        ({"geometry_type": None}, "with_hole", (1, 0)),
        ({"geometry_type": "  with_hole "}, "with_hole", (1, 0)),
        ({"geometry_type": "square"}, "with_hole", (1, 0)),
        ({"geometry_type": ""}, "with_hole", (1, 0)),
        ({"geometry_type": None, "hole_radius_ratio": 0.0}, "without_hole", (0, 0)),
        ({"geometry_type": None, "hole_radius_ratio": float("nan")}, "without_hole", (0, 0)),
        ({"geometry_type": None, "hole_cx_ratio": 0.4, "hole_cy_ratio": 0.4}, "with_hole_moving", (1, 1)),
        ({"geometry_type": None, "hole_radius_ratio": None, "hole_cx_ratio": 0.4}, "without_hole", (0, 0)),
    ],
)
def test_geometry(plate_rows, case, geometry, flags):
    row = engineer_features(plate_rows(case)).first()
    assert row["geometry_type"] == geometry
    assert (row["has_hole"], row["has_moving_hole"]) == flags


def test_ambiguous_rows(plate_rows):
    bare = {"geometry_type": None, "hole_radius_ratio": None}
    df = plate_rows(bare, bare | {"geometry_type": ""}, bare | {"hole_cy_ratio": 0.5}, {})
    assert [r["simulation_id"] for r in resolve_ambiguous(df).collect()] == ["p-1", "p-3"]
    kept = {r["simulation_id"]: r["geometry_type"] for r in resolve_ambiguous(df, keep=True).collect()}
    assert kept == {"p-0": "without_hole", "p-1": "", "p-2": "without_hole", "p-3": "with_hole"}


def test_missing_columns_raise(plate_rows):
    with pytest.raises(ValueError, match="length_m"):
        engineer_features(plate_rows({}).drop("length_m"))
    targets_gone = plate_rows({}).drop("max_displacement_m", "max_von_mises_pa")
    assert engineer_features(targets_gone, require_targets=False).count() == 1
    with pytest.raises(ValueError):
        engineer_features(targets_gone)


def test_optional_columns_are_added(plate_rows):
    df = plate_rows({}).drop("geometry_type", "hole_radius_ratio", "hole_cx_ratio", "hole_cy_ratio")
    assert engineer_features(df).first()["geometry_type"] == "without_hole"


def test_there_are_42_model_features(plate_rows):
    store = features_with_split(plate_rows({}).withColumn("source", F.lit("a")))
    assert len([c for c in feature_columns(store.columns, training=True) if c != "split"]) == 42
    assert "source" in feature_columns(store.columns)


def test_generated_code_can_be_compiled(spark, plate_rows, tmp_path, capsys):
    import re

    plate_rows({}).withColumn("source", F.lit("a")).write.parquet(str(tmp_path / "t"))
    features_with_split(spark.read.parquet(str(tmp_path / "t"))).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_targets_round_trip(plate_rows):
    df = log_targets(engineer_features(plate_rows({}, {"max_displacement_m": 0.0})))
    back = df.select(denormalize(F.col("log_max_von_mises_pa"), "max_von_mises_pa").alias("v")).first()["v"]
    assert back == pytest.approx(2e7)
    assert df.collect()[1]["log_max_displacement_m"] == -12.0


def test_estimate_guards(plate_rows):
    rows = analytic_estimate(plate_rows({"young_modulus_pa": 0.0}, {"hole_radius_ratio": 0.49})).collect()
    assert rows[0]["est_displacement_m"] is None
    d = min(2 * 0.49 * 0.3 / 0.3, 0.95)
    kt = max(3 - 3.13 * d + 3.66 * d * d - 1.53 * d**3, 1)
    assert rows[1]["est_von_mises_pa"] == pytest.approx(kt * 1.5e6 / max(1 - d, 0.05))


def test_safety_of_zero_stress(plate_rows):
    row = safety_assessment(plate_rows({"max_von_mises_pa": 0.0})).first()
    assert row["safety_factor"] == float("inf") and row["safety_band"] == "green"


def test_hole_inside_plate(plate_rows):
    inside = {"hole_cx_ratio": 0.5, "hole_cy_ratio": 0.5}
    df = plate_rows(inside, inside | {"hole_cx_ratio": 0.01}, inside | {"hole_radius_ratio": 0.5}, {})
    assert [r["simulation_id"] for r in hole_inside_plate(df).collect()] == ["p-0"]


def test_normal_functions(spark):
    from statistics import NormalDist

    ps = [1e-6, 0.01, 0.3, 0.5, 0.9, 0.999]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    for p, q, c in df.select("p", inverse_normal(F.col("p")), normal_cdf(inverse_normal(F.col("p")))).collect():
        assert q == pytest.approx(NormalDist().inv_cdf(p), abs=1e-7)
        assert c == pytest.approx(p, abs=2e-7)


def test_linspace_ends(spark):
    assert spark.range(1).select(linspace(1.0, 2.0, 5)).first()[0] == [1.0, 1.25, 1.5, 1.75, 2.0]


@pytest.mark.parametrize("size", [4, 8, 16])
def test_fields_agree(plate_rows, size):
    plain = {"geometry_type": "without_hole", "hole_radius_ratio": None}
    moving = {"geometry_type": "with_hole_moving", "hole_cx_ratio": 0.3, "hole_cy_ratio": 0.6}
    df = engineer_features(plate_rows({}, plain, moving, {"hole_radius_ratio": 0.0}))
    arrays = {r["simulation_id"]: r["field"] for r in field_vectors(df, size).collect()}
    for r in field_points(df, size).collect():
        assert arrays[r["simulation_id"]][r["i"] * size + r["j"]] == pytest.approx(r["vm"], rel=1e-9, abs=1e-6)
    # Row 0 of a plain plate is lowered once, or twice where the sides overlap.
    edge = [0.65 + 0.09 * i if i < 4 else 1.0 for i in range(size)]
    assert arrays["p-1"][0] == pytest.approx(1.5e6 * edge[0] * edge[size - 1])
    # Without a hole in the middle the load passes unchanged.
    assert arrays["p-3"][0] == pytest.approx(1.5e6)


def test_flips(plate_rows):
    df = plate_rows({}).select("simulation_id", F.array(*[F.lit(float(k)) for k in range(4)]).alias("field"))
    got = {r["variant"]: r["field"] for r in flip_variants(df, 2).collect()}
    assert got == {"original": [0, 1, 2, 3], "horizontal": [1, 0, 3, 2], "vertical": [2, 3, 0, 1], "both": [3, 2, 1, 0]}

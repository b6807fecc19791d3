import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from platewise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


BASE = {
    "simulation_id": "p-1",
    "timestamp": "2026-02-10T08:00:00",
    "material_category": "steel",
    "dimension_category": "medium",
    "length_m": 1.0,
    "height_m": 0.3,
    "young_modulus_pa": 2.1e11,
    "poisson_ratio": 0.3,
    "traction_pa": 1.5e6,
    "mesh_nx": 120,
    "mesh_ny": 24,
    "geometry_type": "with_hole",
    "hole_radius_ratio": 0.1,
    "hole_cx_ratio": None,
    "hole_cy_ratio": None,
    "max_displacement_m": 5e-6,
    "max_von_mises_pa": 2e7,
    "solver_name": "proxy",
    "solver_version": "1.0",
    "data_version": "v1",
}


@pytest.fixture
def plate_rows(spark):
    """Frame of plates; each argument is a dict of what differs from a sound plate with a hole."""
    from platewise.schema import RAW_SCHEMA

    def make(*changes):
        rows = []
        for i, change in enumerate(changes):
            row = BASE | {"simulation_id": f"p-{i}"} | change
            rows.append(tuple(row[n] for n in RAW_SCHEMA.names))
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return make

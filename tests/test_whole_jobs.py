"""Registered queries run the whole job: the functions' defaults, all targets, all plates."""

import pytest

from platewise.catalog import learning
from platewise.constants import TARGETS

SF = "/root/testdata/sf0.001"


class Stopped(Exception):
    pass


def caught(monkeypatch, module, name, call):
    """Arguments of the first call of a function."""
    seen = []

    def stop(*args, **kwargs):
        seen.append((args, kwargs))
        raise Stopped

    monkeypatch.setattr(module, name, stop)
    with pytest.raises(Stopped):
        call()
    return seen[0]


def test_models_are_fitted_with_their_defaults(spark, monkeypatch):
    learning.stored(spark, SF)
    with monkeypatch.context() as m:
        _, options = caught(m, learning.regress, "fit_plate_model", lambda: learning._plate_model_path.__wrapped__(spark, SF))
        assert options == {"version": "v1"}
    with monkeypatch.context() as m:
        _, options = caught(m, learning.regress, "fit_plate_model", lambda: learning.rf_baseline(spark, SF))
        assert options == {"build": learning.regress.forest}
    with monkeypatch.context() as m:
        args, options = caught(m, learning, "fit_subspace", lambda: learning.pca_fields(spark, SF))
        assert args[1] == 50 and args[0].width == 64 * 64 and args[0].rows.count() == learning.stored(spark, SF).count()
    with monkeypatch.context() as m:
        args, options = caught(m, learning.unsupervised, "geometry_classifier", lambda: learning.field_classifier(spark, SF))
        assert args[1:] == (3, 64 * 64) and not options


def test_reports_and_searches_cover_all_targets(spark, monkeypatch):
    calls = []

    def answer(store, target, *args, **kwargs):
        calls.append((target, args, kwargs))
        return spark.createDataFrame([("0", 1.0)], "fold string, rmse double")

    monkeypatch.setattr(learning.regress, "cv_report", answer)
    monkeypatch.setattr(learning.regress, "cv_search", answer)
    assert {r.target for r in learning.cv_report(spark, SF).collect()} == set(TARGETS)
    assert {r.target for r in learning.cv_search(spark, SF).collect()} == set(TARGETS)
    assert calls == [(t, (), {}) for t in TARGETS] + [(t, (60,), {}) for t in TARGETS]

"""The folds of a cross-validation are fitted together, not one after the other."""

import os

import pytest

from checks import load, modeling

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not there")
def test_cv_scores_fits_all_folds_at_once(spark, monkeypatch):
    fits, real = [], modeling.b.fit_boosted
    monkeypatch.setattr(modeling.b, "fit_boosted", lambda *a, **k: fits.append(k) or real(*a, **k))
    made = load()[0]["cv_scores"](spark, SF_DIR).collect()
    assert fits == [{"trees": 3, "depth": 3}]
    assert sorted(r["fold"] for r in made) == [0, 1, 2, 3, 4] and all(r["beats_nothing"] and r["n"] for r in made)

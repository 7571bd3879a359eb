"""The registered model queries run the library's own job: all targets, candidates, folds and trees."""

import pytest

from gapweave.operators import models
from gapweave.plans import queries_models
from gapweave.plans.catalog import Tables
from gapweave.sources import layouts


class Stop(Exception):
    pass


@pytest.mark.parametrize("name, targets, candidates", [
    ("boosted_search", ["t28m"], 3), ("hourly_skill", ["t28m"], 3), ("hourly_product", layouts.TARGETS, 3), ("daily_product", ["t28m"], 10),
])
def test_boosted_queries_search_in_full(spark, monkeypatch, name, targets, candidates):
    seen = []

    def record(train, target, covariates, model, grid, folds, parallelism):
        seen.append((target, len(grid), folds, model.getMaxIter(), not train.isEmpty()))
        raise Stop

    monkeypatch.setattr(models, "_search", record)
    with pytest.raises(Stop):
        getattr(queries_models, name)(Tables(spark, "/root/testdata/sf0.001"))
    assert sorted(seen) == sorted((t, candidates, 3, 50, True) for t in targets)

"""The registered random search is the operator's whole search."""

import json

from riskframe.operators import models as MD
from riskframe.plans import q_models


def test_random_search_is_whole(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(q_models, "_train_folds", lambda *a: None)

    def search(df, make, candidates, *a, **kw):
        seen.extend(candidates)
        return spark.createDataFrame([(len(candidates),)], "n int")
    monkeypatch.setattr(MD, "search_cv", search)
    assert q_models.l4(spark, "").first()["n"] == MD.SEARCH_CANDIDATES == 50
    assert seen == MD.sample_grid(MD.RF_GRID) and len({json.dumps(p, sort_keys=True) for p in seen}) == 50

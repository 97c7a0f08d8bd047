"""The queries on NDCG trees take the operators' own rounds, learning rate and folds."""

import pytest

from cartloom.operators import boosting as B
from cartloom.operators import ranking as R
from cartloom.plans import catalogue as CT


class Seen(Exception):
    pass


@pytest.fixture
def given(monkeypatch):
    """What boosting is asked for, which ends the query."""
    asked = {}

    def boost(table, bins, models, settings, report=None):
        asked.update(models=models, settings=settings)
        raise Seen

    monkeypatch.setattr(B, "boost", boost)
    return asked


def test_folds(spark, small, given):
    with pytest.raises(Seen):
        CT.queries()["ranker_ndcg_folds"](spark, small)
    assert given["models"] == 5
    assert given["settings"] == R.NDCG_RANKER and given["settings"].rounds == 1000 and given["settings"].rate == 0.05


def test_recommendations(spark, small, given):
    with pytest.raises(Seen):
        CT.queries()["recommend_ranked"](spark, small)
    assert given["models"] == 1
    assert given["settings"] == R.NDCG_RANKER and given["settings"].rounds == 1000 and given["settings"].rate == 0.05

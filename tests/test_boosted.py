import pytest

from tidemark.plans import jobs


def test_boosted_scores_fits_all_trees(spark, monkeypatch):
    class Done(Exception):
        pass

    def fitted(gbt, rows):
        raise Done(gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize())

    monkeypatch.setattr("pyspark.ml.classification.GBTClassifier.fit", fitted)
    with pytest.raises(Done) as found:
        jobs.boosted_scores(spark, "/root/testdata/sf0.001")
    assert found.value.args == (100, 3, 0.1)

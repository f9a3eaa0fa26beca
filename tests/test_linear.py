"""The linear model from blocks of rows against Spark's own fit."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GeneralizedLinearRegression

from demandgrid.models import linear as L
from demandgrid.models import regression as R

GIVEN = {"family": "tweedie", "variancePower": 1.3, "linkPower": 0.0, "regParam": 0.01, "labelCol": "label"}


def rows(spark, n=3000, constant=False):
    rng = np.random.default_rng(5)
    x = np.c_[rng.normal(2, 1, n), rng.integers(0, 4, n), 300 * rng.random(n), rng.integers(0, 2, n) * 0.5]
    x[:, 3] = 0.0 if constant else x[:, 3]
    label = rng.poisson(np.exp(0.4 * x[:, 0] - 0.3 * x[:, 1] - 0.8 + 0.002 * x[:, 2])).astype(float)
    made = [(float(y), Vectors.dense(r)) for y, r in zip(label, x.tolist(), strict=True)]
    return spark.createDataFrame(made, ["label", "features"]).repartition(3).localCheckpoint()


def test_equals_sparks_fit(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_ROWS", 700)
    monkeypatch.setattr(L, "CHUNK_ROWS", 300)
    table = rows(spark)
    for rounds in (0, 1, 25):
        for intercept in (True, False):
            given = GIVEN | {"maxIter": rounds, "fitIntercept": intercept}
            want = GeneralizedLinearRegression(**given).fit(table)
            got = L.BlockwiseRegression(**given).fit(table)
            assert np.allclose([got.intercept, *got.coefficients], [want.intercept, *want.coefficients], rtol=1e-7, atol=1e-9)
            assert got.summary.numIterations == want.summary.numIterations
            assert np.allclose(got.summary.coefficientStandardErrors, want.summary.coefficientStandardErrors, rtol=1e-6)
            assert got.summary.deviance == pytest.approx(want.summary.deviance)
    assert got.getVariancePower() == 1.3 and got.getMaxIter() == 25 and type(got) is type(want)


def test_a_feature_that_never_varies_counts_for_nothing(spark):
    table = rows(spark, constant=True)
    got = L.BlockwiseRegression(**GIVEN).fit(table)
    less = table.select("label", vector_to_array("features").alias("a")).rdd.map(lambda r: (r.label, Vectors.dense(r.a[:3])))
    want = GeneralizedLinearRegression(**GIVEN).fit(spark.createDataFrame(less, ["label", "features"]))
    assert got.coefficients[3] == 0
    assert np.allclose([got.intercept, *got.coefficients[:3]], [want.intercept, *want.coefficients], rtol=1e-7)
    assert got.summary.numIterations < 25


def test_blocks_keep_all_values():
    rng = np.random.default_rng(6)
    x = np.c_[rng.normal(0, 1, 5000), rng.integers(0, 300, 5000) / 7, rng.integers(-3, 3, 5000), np.zeros(5000)]
    label = rng.poisson(1, 5000).astype(float)
    (row,) = L._coded(label, x).to_pylist()
    columns = [codes if table is None else table[codes] for codes, table in L._columns(row)]
    assert np.array_equal(np.array(columns).T, x) and [c.dtype.itemsize for c, _ in L._columns(row)] == [8, 2, 1, 1]


def test_rounds_do_not_read_vectors(spark, monkeypatch):
    """The vectors are read once, and never written."""
    read, fit = [], L.BlockwiseRegression._fit_java
    monkeypatch.setattr(L.BlockwiseRegression, "_fit_java", lambda self, dataset: read.append(dataset) or fit(self, dataset))
    table = rows(spark)
    assert isinstance(R.GlmSettings().stage(), L.BlockwiseRegression)
    R.GlmSettings(max_iter=3).stage().fit(table)
    assert len(read) == 1
    assert type(R.GlmSettings(variance_power=1.0).stage()) is GeneralizedLinearRegression


def test_odd_rows_are_refused(spark):
    for label, value in ((None, 1.0), (-1.0, 1.0), (1.0, float("nan")), (1.0, float("inf"))):
        table = spark.createDataFrame([(1.0, Vectors.dense([3.0, 1.0])), (label, Vectors.dense([value, 2.0]))], ["label", "features"])
        with pytest.raises(Exception, match="must not be"):
            L.BlockwiseRegression(**GIVEN).fit(table)
    with pytest.raises(ValueError, match="training rows"):
        L.BlockwiseRegression(**GIVEN).fit(rows(spark).limit(0))

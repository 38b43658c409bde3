"""The recurrent forecaster against plain numpy, and its whole chain over shared segments."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.operators import forecast as fc
from conftest import SF_SMALL

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def samples(spark):
    """A target that the last two steps make by a product: no linear model finds it."""
    r = np.random.default_rng(7)
    lags = r.uniform(-1, 1, size=(3000, 3, 2))
    y = lags[:, 2, 0] * lags[:, 1, 1] + 0.3 * lags[:, 0, 0] + r.normal(size=3000) * 0.01
    names = fc.lag_columns(FEATURES, 3)
    assert names == ["a_lag3", "b_lag3", "a_lag2", "b_lag2", "a_lag1", "b_lag1"]
    rows = [(i, float(y[i]), i % 5 == 0, *map(float, lags[i].ravel())) for i in range(3000)]
    return spark.createDataFrame(rows, "id long, target double, late boolean, " + ", ".join(f"{n} double" for n in names)).repartition(6), lags, y


def test_states_follow_the_recurrence():
    r = fc.Reservoir(2, 3, units=5, radius=0.7, seed=1)
    w_in, w, bias = r.weights()
    assert abs(np.abs(np.linalg.eigvals(w)).max() - 0.7) < 1e-12
    lags = np.random.default_rng(0).normal(size=(4, 3, 2))
    for row, got in zip(lags, r.states(lags)):
        h = [0.0] * 5
        for x in row:
            h = [np.tanh(sum(x[i] * w_in[i, u] for i in range(2)) + sum(h[v] * w[v, u] for v in range(5)) + bias[u]) for u in range(5)]
        assert np.allclose(got, h, atol=1e-12)


def test_sums_and_fit(spark, samples):
    rows, lags, y = samples
    r = fc.Reservoir(2, 3, units=32)
    z = np.hstack([r.design(lags), y[:, None]])
    late = np.arange(3000) % 5 == 0
    got = fc.sums(rows, fc.lag_columns(FEATURES, 3), r, "late")
    assert np.allclose(got[0], z[~late].T @ z[~late]) and np.allclose(got[1], z[late].T @ z[late])
    model = fc.fit(rows, FEATURES, 3, "late", units=32)
    k = z.shape[1] - 1
    a = z[:, :k].T @ z[:, :k] + np.diag(np.r_[0, np.full(k - 1, model.ridge * 3000)])
    assert model.recurrent and np.allclose(r.design(lags) @ np.linalg.solve(a, z[:, :k].T @ y), model.predict(lags), atol=1e-6)
    told = {row.id: row.predicted for row in fc.forecast(model, rows, "id").collect()}
    assert np.allclose([told[i] for i in range(3000)], model.predict(lags))
    x = np.hstack([np.ones((3000, 1)), lags.reshape(3000, -1)])
    linear = x @ np.linalg.lstsq(x, y, rcond=None)[0]
    assert np.abs(model.predict(lags) - y).mean() < 0.5 * np.abs(linear - y).mean()


def test_states_that_do_not_help_are_left_out(spark, samples):
    rows, lags, _ = samples
    plain = rows.withColumn("target", F.col("a_lag1") * 2 - F.col("b_lag3") + 1)
    model = fc.fit(plain, FEATURES, 3, "late", units=8)
    assert np.allclose(model.predict(lags), 2 * lags[:, 2, 0] - lags[:, 0, 1] + 1, atol=1e-4)


def test_empty(spark, samples):
    none = samples[0].limit(0)
    model = fc.fit(none, FEATURES, 3, "late", units=8)
    assert fc.forecast(model, none, "id").collect() == []


def test_chain_over_one_cut(spark):
    """Samples made over shared segments equal those made step by step, and forecasts cover every held-out sample."""
    from aerolith.operators import ml
    from aerolith.plans import base, q_ml
    feats = list(ml.SEQ_FEATURES)
    split = q_ml._samples(spark, SF_SMALL)
    g = ml.minmax_scale(ml.forward_fill(base.gold_a(spark, SF_SMALL), feats), feats)
    want = ml.chronological_split(ml.sequence_windows(g, keep=("timestamp",))).drop("timestamp")
    got = split.drop("timestamp").select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    told = q_ml.forecasts(spark, SF_SMALL)
    assert told.count() == split.filter("NOT is_train").count()
    e = told.selectExpr("avg(abs(actual - predicted)) AS m", "avg(abs(actual - last)) AS p").first()
    assert e.m < e.p

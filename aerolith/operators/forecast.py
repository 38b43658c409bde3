"""Next-reading forecast by a recurrent model that sums can fit (2.9).

The model reads a sample's lag window from the oldest reading to the newest through a fixed random recurrent layer,
``h = tanh(W_in x + W h + b)`` from ``h = 0`` (a reservoir: its weights are drawn from a seed, not trained), and predicts from the last state
and the lags by ridge regression. Only the readout is fitted, and what it needs are sums over rows: the normal equations of
every partition, added up; the driver sees matrices of fixed size. Some training rows, which the caller marks, are summed apart, so that
the ridge weight, and whether the states help at all, are chosen by the error on them, without a further pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RIDGES = (1e-6, 1e-4, 1e-2, 1.0)


@dataclass(frozen=True)
class Reservoir:
    features: int
    length: int
    units: int = 64
    radius: float = 0.9
    seed: int = 42

    def weights(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r = np.random.default_rng(self.seed)
        w = r.normal(size=(self.units, self.units))
        return (r.normal(size=(self.features, self.units)), w * (self.radius / np.abs(np.linalg.eigvals(w)).max()),
                r.uniform(-1, 1, size=self.units))

    def states(self, lags: np.ndarray) -> np.ndarray:
        """Last state of each window; ``lags[row, step, feature]``, oldest step first."""
        w_in, w, bias = self.weights()
        h = np.zeros((len(lags), self.units))
        for step in range(self.length):
            h = np.tanh(lags[:, step] @ w_in + h @ w + bias)
        return h

    def design(self, lags: np.ndarray) -> np.ndarray:
        """One, the lags, the last state."""
        return np.hstack([np.ones((len(lags), 1)), lags.reshape(len(lags), -1), self.states(lags)])


@dataclass
class Forecaster:
    reservoir: Reservoir
    columns: list[str]
    weights: np.ndarray
    ridge: float
    recurrent: bool

    def predict(self, lags: np.ndarray) -> np.ndarray:
        return self.reservoir.design(lags) @ self.weights


def lag_columns(features, length: int) -> list[str]:
    """Names of a window's columns, oldest step first."""
    return [f"{f}_lag{i}" for i in range(length, 0, -1) for f in features]


def _windows(b: pa.RecordBatch, columns: list[str], r: Reservoir) -> np.ndarray:
    return np.stack([b.column(c).to_numpy() for c in columns], axis=1).reshape(b.num_rows, r.length, r.features)


def sums(rows: DataFrame, columns: list[str], r: Reservoir, late: str, target: str = "target") -> np.ndarray:
    """``[early, late]`` sums of ``z z^T`` over all rows, ``z`` the design with the target appended."""
    width = 2 + len(columns) + r.units

    def add(batches):
        total = np.zeros((2, width, width))
        for b in batches:
            if b.num_rows:
                z = np.hstack([r.design(_windows(b, columns, r)), b.column("y").to_numpy()[:, None]])
                is_late = b.column("late").to_numpy(zero_copy_only=False).astype(bool)
                for i, part in enumerate((z[~is_late], z[is_late])):
                    total[i] += part.T @ part
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    told = rows.select(*columns, F.col(target).cast("double").alias("y"), F.col(late).alias("late")).mapInArrow(add, "s binary").rdd
    parts = told.map(lambda row: np.frombuffer(row.s).reshape(2, width, width))
    return parts.treeReduce(np.add) if told.getNumPartitions() > 64 else parts.fold(np.zeros((2, width, width)), np.add)


def _solve(s: np.ndarray, used: int, ridge: float) -> np.ndarray:
    """Ridge weights of the first ``used`` columns (the constant is not shrunk); 0 for the others."""
    n = s[0, 0]
    a = s[:used, :used] + np.diag(np.r_[0.0, np.full(used - 1, ridge * max(n, 1))])
    w = np.zeros(len(s) - 1)
    w[:used] = np.linalg.lstsq(a, s[:used, -1], rcond=None)[0]
    return w


def fit(train: DataFrame, features, length: int, late: str, units: int = 64, seed: int = 42) -> Forecaster:
    """``late`` marks the training rows that choose the ridge weight and judge the states; the final weights come from all rows."""
    r, columns = Reservoir(len(features), length, units, seed=seed), lag_columns(features, length)
    early, last = sums(train, columns, r, late)
    linear = 1 + len(columns)

    def error(choice):
        w = np.r_[_solve(early, *choice), -1.0]
        return w @ last @ w

    used, ridge = min(((u, k) for u in (linear, linear + units) for k in RIDGES), key=error)
    return Forecaster(r, columns, _solve(early + last, used, ridge), ridge, used > linear)


def forecast(model: Forecaster, rows: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns with ``predicted``."""
    told = rows.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        m = told.value
        for b in batches:
            out = m.predict(_windows(b, m.columns, m.reservoir)) if b.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(out)], names=[*keep, "predicted"])

    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)
    return rows.select(*dict.fromkeys([*keep, *model.columns])).mapInArrow(predict, f"{kinds}predicted double")

"""Quality scores of texts: random Fourier features, ridge regression, isotonic calibration.

A document is a vector of statistics of its whole text (``STATISTICS``), standardised
with mean and deviation over all documents. ``FEATURES`` random cosines of it approximate a
Gaussian kernel. Every partition sums its share of the normal equations; Spark adds the
shares, and the driver solves one system of fixed size. Ridge scores are then
calibrated: labelled rows that the ridge has not seen are summed into score bins of
equal width, and isotonic regression over the bins gives the share of label 1. Inside a
level of the isotonic curve, ``TILT`` of the score follows the raw score, so that documents on one level keep their order.

Labelled rows are split by ``crc32(doc_id) % 3``: 0 fits the ridge, 2 calibrates, 1 is held out.
Labels and ids decide which rows are fitted on; a score is a function of the text alone.

Defined cases: null text counts as empty and gets a score like any other; labels other than 0 and 1
are ignored, and several labels of one id count as their mean; without labels every score is 0.5;
repeated rows get equal scores; a null id is never labelled, and held out as crc32 of the empty text says;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.store import keep
from aerolith.llm.text import words

FEATURES = 256
RIDGE = 1e-3
BINS = 1000
TILT = 0.02
SEED = 5
STATISTICS = ("log_chars", "log_words", "word_bytes", "word_spread", "longest", "letters", "capitals", "digits", "blanks",
              "newlines", "stops", "marks", "symbols", "non_ascii", "distinct_words", "top_run", "distinct_lines", "line_words",
              "short_words", "ending", "entropy", "bare_words", "doubled")


def _class(chars: str) -> np.ndarray:
    mask = np.zeros(256)
    mask[list(chars.encode())] = 1
    return mask


_CLASSES = np.stack([_class("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                     _class("0123456789"), _class(" \t\r\x0b\x0c"), _class("\n"), _class(".!?"), _class(",;:'\"()-"),
                     _class("|#$%&*<>=+@/\\_~^[]{}`"), np.r_[np.zeros(128), np.ones(128)]])


def statistics(text: str | None) -> list[float]:
    """Numbers about a whole text, in the order of ``STATISTICS``."""
    raw = (text or "").encode()
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    n = max(1, len(raw))
    share = _CLASSES @ hist / n
    ws = words(text)
    lens = np.fromiter(map(len, ws), float, len(ws)) if ws else np.zeros(1)
    lines = [x for x in (text or "").split("\n") if x]
    p = hist[hist > 0] / n
    distinct = len(set(ws)) / max(1, len(ws))
    doubled = sum(map(bytes.__eq__, ws, ws[1:])) / max(1, len(ws))
    return [np.log1p(len(raw)), np.log1p(len(ws)), lens.mean(), lens.std(), np.log1p(lens.max()), *share,
            distinct, distinct * np.log1p(len(ws)), len(set(lines)) / max(1, len(lines)), np.log1p(len(ws) / max(1, len(lines))),
            float((lens <= 3).mean()), float(raw[-1:] in (b".", b"!", b"?")), float(-(p * np.log(p)).sum()),
            float(np.mean([w.isalpha() for w in ws])) if ws else 0.0, doubled]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, x``: the statistics of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches):
        for b in batches:
            x = [statistics(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, schema.field("x").type)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id bigint, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Cosines:
    """Random Fourier features of the Gaussian kernel whose width is the square root of the dimension."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, features: int = FEATURES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.w = rng.standard_normal((len(mean), features)) / np.sqrt(len(mean))
        self.phase = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.ones((len(x), 1)), np.cos(z @ self.w + self.phase) * np.sqrt(2 / len(self.phase))])


def _partition_sums(df: DataFrame, size: int, add) -> np.ndarray:
    """Sum over partitions of a vector of fixed ``size``; the driver gets one row per entry.

    ``add(batch)`` gives a batch's share. Each partition sends its sum as numbered entries, which Spark adds up.
    """
    def run(batches):
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += add(b)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"i": pa.array(at, pa.int32()), "v": pa.array(total[at], pa.float64())})

    out = np.zeros(size)
    for i, v in df.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v")).collect():
        out[i] = v
    return out


def isotonic(score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centres and levels of the rising step function of least squares."""
    pools: list[list[float]] = []  # score x weight, label x weight, weight
    for s, y, w in zip(score, label, weight):
        pools.append([s * w, y * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    p = np.array(pools)
    return p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]


class Model:
    def __init__(self, cosines: Cosines, beta: np.ndarray, centres: np.ndarray, levels: np.ndarray):
        self.cosines, self.beta, self.centres, self.levels = cosines, beta, centres, levels

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.cosines(x) @ self.beta, -0.5, 1.5)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        if not len(self.centres):
            return np.full(len(x), 0.5)
        return (1 - TILT) * np.interp(raw, self.centres, self.levels) + TILT * (raw + 0.5) / 2


def fit(measured: DataFrame, labels: DataFrame, label: str = "quality", features: int = FEATURES,
        ridge: float = RIDGE, bins: int = BINS) -> Model:
    """Model from the labelled rows of folds 0 (ridge) and 2 (calibration)."""
    p = len(STATISTICS)

    def moments(b):
        x = _matrix(b.column(0))
        return np.r_[len(x), x.sum(0), (x * x).sum(0)]

    m = _partition_sums(measured.select("x"), 2 * p + 1, moments)
    n = max(1.0, m[0])
    mean = m[1:p + 1] / n
    cosines = Cosines(mean, np.sqrt(np.maximum(m[p + 1:] / n - mean ** 2, 0)), features)

    y = (labels.filter(F.col(label).isin(0, 1)).groupBy(F.col("doc_id").alias("_id"))
         .agg(F.avg(F.col(label).cast("double")).alias("y")))
    known = (measured.join(y, measured["doc_id"] == y["_id"])
             .select("x", "y", held_out(F.col("doc_id")).alias("fold")).filter("fold <> 1"))
    known = keep(known, "labelled")
    k = features + 1

    def normal(b):
        z, t = cosines(_matrix(b.column(0))), b.column(1).to_numpy()
        return np.r_[(z.T @ z).ravel(), z.T @ t, len(z)]

    s = _partition_sums(known.filter("fold = 0").select("x", "y"), k * k + k + 1, normal)
    seen = max(1.0, s[-1])
    beta = np.linalg.solve(s[:k * k].reshape(k, k) / seen + ridge * np.eye(k), s[k * k:-1] / seen)
    model = Model(cosines, beta, np.empty(0), np.empty(0))

    def binned(b):
        raw, t = model.raw(_matrix(b.column(0))), b.column(1).to_numpy()
        at = np.minimum(((raw + 0.5) / 2 * bins).astype(int), bins - 1)
        return np.concatenate([np.bincount(at, v, bins) for v in (raw, t, np.ones(len(raw)))])

    raw, hits, rows = _partition_sums(known.filter("fold = 2").select("x", "y"), 3 * bins, binned).reshape(3, bins)
    at = rows > 0
    if at.any():
        model.centres, model.levels = isotonic(raw[at] / rows[at], hits[at] / rows[at], rows[at])
    return model


def score_quality(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    measured = keep(measure(docs), "statistics")
    model = fit(measured, labels, **settings)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.clip(model(_matrix(b.column(1))), 0, 1))], schema=schema)

    scored = measured.mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", (held_out(F.col("doc_id")) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5, **settings) -> DataFrame:
    """The rows of ``docs`` whose text scores ``least`` or more."""
    model = fit(keep(measure(docs), "statistics"), labels, **settings)

    @F.pandas_udf("double")
    def score(text):
        import pandas as pd
        x = np.array([statistics(t) for t in text])
        return pd.Series(np.clip(model(x), 0, 1) if len(x) else [])

    return docs.filter(score(F.col("text")) >= least)

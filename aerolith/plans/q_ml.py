"""Registered queries: ML data work (2.9)."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from aerolith.functions import weather as wx
from aerolith.operators import boosting, clean, forecast, ml
from aerolith.operators.warehouse import materialize
from aerolith.plans import base
from aerolith.plans.oracle import cte, sql
from aerolith.plans.registry import register
from aerolith.sources.layers import fresh_path
from aerolith.sources.tables import memo, readings

F24 = ml.FEATURES_24
SEQ = ml.SEQ_FEATURES

_FM_COLS = ", ".join(f"coalesce({c}, -1) AS {c}" for c in F24)
cte("feature_matrix", ["gold_a"], f"SELECT reading_id, {_FM_COLS}, is_extreme_weather AS label FROM gold_a")
cte("strat", ["feature_matrix"], """SELECT *, row_number() OVER (PARTITION BY label
  ORDER BY md5(CAST(reading_id AS VARCHAR)), reading_id) <= floor(count(*) OVER (PARTITION BY label) * 0.8) AS is_train
FROM feature_matrix""")


def _fm(spark, d):
    return ml.feature_matrix(base.gold_a(spark, d))


@register("feature_matrix", sql("SELECT * FROM feature_matrix", "feature_matrix"))
def q_feature_matrix(spark, d):
    return _fm(spark, d)


@register("stratified_split", sql("SELECT reading_id, label, is_train FROM strat", "strat"))
def q_strat(spark, d):
    return ml.stratified_split(_fm(spark, d), label="label").select("reading_id", "label", "is_train")


@register("class_weights", sql("""SELECT count(*) FILTER (WHERE label = 0) AS n_normal,
  count(*) FILTER (WHERE label = 1) AS n_extreme,
  count(*) FILTER (WHERE label = 0) / greatest(count(*) FILTER (WHERE label = 1), 1) AS pos_weight
FROM strat WHERE is_train""", "strat"))
def q_class_weights(spark, d):
    s = ml.stratified_split(_fm(spark, d), label="label")
    return ml.class_weights(s.filter("is_train"))


@register("chronological_split", sql("""SELECT reading_id, city, row_number() OVER (PARTITION BY city
  ORDER BY timestamp, reading_id) <= floor(count(*) OVER (PARTITION BY city) * 0.8) AS is_train FROM gold_a""",
                                     "gold_a"))
def q_chrono(spark, d):
    return ml.chronological_split(base.gold_a(spark, d)).select("reading_id", "city", "is_train")


_FF = ["temperature_fahrenheit", "humidity_percent", "pressure_hpa", "wind_speed_mph"]


@register("forward_fill", sql("SELECT reading_id, city, " + ", ".join(
    f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY city ORDER BY timestamp, reading_id "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS {c}" for c in _FF)
    + " FROM readings_dedup", "readings_dedup"))
def q_ffill(spark, d):
    """Per-city forward fill of the raw (deduplicated) readings; leading nulls -> 0."""
    r = clean.dedup_readings(readings(spark, d)).select("reading_id", "city", "timestamp", *_FF)
    return ml.forward_fill(r, _FF).select("reading_id", "city", *_FF)


_LAG_SQL = ", ".join(f"lag({f}, {i}) OVER w AS {f}_lag{i}" for i in range(1, 8) for f in SEQ)
cte("seq", ["gold_a"], f"""SELECT * EXCLUDE (_rn) FROM (SELECT reading_id, city, temperature_fahrenheit AS target,
  {_LAG_SQL}, row_number() OVER w AS _rn FROM gold_a
  WINDOW w AS (PARTITION BY city ORDER BY timestamp, reading_id)) x WHERE _rn > 7""")


@register("sequence_windows", sql("SELECT * FROM seq", "seq"))
def q_seq(spark, d):
    return ml.sequence_windows(base.gold_a(spark, d))


@register("minmax_scale", sql("SELECT reading_id, " + ", ".join(
    f"CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0.0 ELSE ({c} - min({c}) OVER ()) / "
    f"(max({c}) OVER () - min({c}) OVER ()) END AS {c}" for c in SEQ) + " FROM gold_a", "gold_a"))
def q_minmax(spark, d):
    return ml.minmax_scale(base.gold_a(spark, d).select("reading_id", *SEQ), SEQ)


cte("rule_pred", ["gold_a"], f"""SELECT reading_id, is_extreme_weather AS label,
  CASE WHEN {wx.risk_level_sql()} = 'HIGH' THEN 1 ELSE 0 END AS prediction FROM gold_a""")


def _rule_pred(spark, d):
    g = base.gold_a(spark, d)
    return g.select("reading_id", F.col("is_extreme_weather").alias("label"),
                    F.when(wx.risk_level() == "HIGH", 1).otherwise(0).alias("prediction"))


def _bm_sql(src: str) -> str:
    return f"""SELECT round(CASE WHEN n > 0 THEN correct / n ELSE 0.0 END, 6) AS accuracy,
  round(p, 6) AS precision, round(r, 6) AS recall,
  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r
      FROM (SELECT CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp,
                   CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
                   CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn,
                   CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE label = prediction) AS DOUBLE) AS correct
            FROM {src}) c) m"""


@register("binary_metrics", sql(_bm_sql("rule_pred"), "rule_pred"))
def q_binary(spark, d):
    """Metrics of the serving layer's rule-based risk (HIGH = predicted extreme) against the label."""
    return ml.binary_metrics(_rule_pred(spark, d))


@register("confusion_matrix", sql("SELECT label, prediction, count(*) AS n FROM rule_pred GROUP BY ALL",
                                  "rule_pred"))
def q_confusion(spark, d):
    return ml.confusion_matrix(_rule_pred(spark, d))


@register("regression_metrics", sql("""SELECT round(avg(abs(target - temperature_fahrenheit_lag1)), 6) AS mae,
  round(sqrt(avg((target - temperature_fahrenheit_lag1) * (target - temperature_fahrenheit_lag1))), 6) AS rmse
FROM seq""", "seq"))
def q_regression(spark, d):
    """MAE / RMSE of the persistence forecast (next temperature = last temperature)."""
    s = ml.sequence_windows(base.gold_a(spark, d))
    return ml.regression_metrics(s.select(F.col("target").alias("actual"),
                                          F.col("temperature_fahrenheit_lag1").alias("predicted")))


# --- the classifier of extreme weather ----------------------------------------------------

def _train_test(spark, d):
    """Training and held-out rows; the split is written once, as edges, blocks, search and predictions each read it."""
    s = memo(spark, "extreme_split", d)(lambda: materialize(ml.stratified_split(_fm(spark, d), label="label"), "extreme_split"))
    return s.filter("is_train"), s.filter("NOT is_train")


def classifier(spark, d) -> boosting.Model:
    """200 trees of depth 6 fitted on the training rows, once per application: the driver holds the trees, not rows."""
    return memo(spark, "extreme_classifier", d)(lambda: boosting.fit(_train_test(spark, d)[0], list(F24)))


def predictions(spark, d):
    """``reading_id, label, margin, probability, prediction`` of the held-out rows."""
    return boosting.predict(classifier(spark, d), _train_test(spark, d)[1], "reading_id", "label")


@register("train_extreme_classifier")
def q_train(spark, d):
    """What the classifier says about every held-out row (a learned result: no SQL twin, see tests/test_boosting.py)."""
    return predictions(spark, d).select("reading_id", "label", "prediction", "probability")


LEAST_F1 = 0.95


@register("extreme_classifier_floor", sql("SELECT reading_id, label, TRUE AS good_f1 FROM strat WHERE NOT is_train", "strat"))
def q_train_floor(spark, d):
    """Held-out rows with their labels, and whether the model's F1 on them is ``LEAST_F1`` or more."""
    pred = predictions(spark, d)
    return pred.crossJoin(ml.binary_metrics(pred).select((F.col("f1") >= LEAST_F1).alias("good_f1"))).select(
        "reading_id", "label", "good_f1")  # the metrics are one row


@register("feature_importance")
def q_importance(spark, d):
    """Features by their mean absolute Shapley value over the held-out rows."""
    told = boosting.contributions(classifier(spark, d), _train_test(spark, d)[1], "reading_id")
    return boosting.importance(told, list(F24))


@register("shapley_values")
def q_shapley(spark, d):
    """Per held-out row: base value, margin and one Shapley value per feature."""
    told = boosting.contributions(classifier(spark, d), _train_test(spark, d)[1], "reading_id")
    return told.select("reading_id", "base", "margin", *[F.col("phi")[i].alias(f"phi_{c}") for i, c in enumerate(F24)])


@register("tune_classifier")
def q_tune(spark, d):
    """50 settings from the nine ranges with the F1 of each of 5 folds; the best one, fitted on all training rows, has its held-out F1."""
    train, test = _train_test(spark, d)
    tried, model = boosting.tune(train, list(F24))
    held_out = ml.binary_metrics(boosting.predict(model, test, "label")).first().f1
    best = tried.orderBy(F.desc("f1"), "trial").first().trial
    return tried.withColumn("best", F.col("trial") == best).withColumn("held_out_f1", F.when(F.col("best"), F.lit(held_out)))


cte("scaled_test", ["gold_a"], """SELECT v, prev FROM (
  SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY city) AS n FROM (
    SELECT *, lag(v) OVER w AS prev, row_number() OVER w AS rn FROM (
      SELECT *, CASE WHEN max(t) OVER () = min(t) OVER () THEN 0.0
                     ELSE (t - min(t) OVER ()) / (max(t) OVER () - min(t) OVER ()) END AS v FROM (
        SELECT reading_id, city, timestamp, coalesce(last_value(temperature_fahrenheit IGNORE NULLS) OVER (
          PARTITION BY city ORDER BY timestamp, reading_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS t
        FROM gold_a) f) s WINDOW w AS (PARTITION BY city ORDER BY timestamp, reading_id)) q
  WHERE rn > 7 WINDOW w AS (PARTITION BY city ORDER BY timestamp, reading_id)) c WHERE r > floor(n * 0.8)""")


def _samples(spark, d):
    """Scaled lag windows of every city with ``is_train`` (the first 80 % in time).

    One cut into segments serves all steps; the filled readings are written with their extremes noted on the way, and the samples once.
    """
    feats = list(SEQ)
    seg = ml.ordered_segments(base.gold_a(spark, d).select("reading_id", "city", "timestamp", *feats), "city",
                              [F.col("timestamp"), F.col("reading_id")])
    noted, path = Observation(), fresh_path(spark, "forecast/filled")
    (ml.forward_fill(seg, feats).observe(noted, *[f(c).alias(f"{f.__name__}_{c}") for c in feats for f in (F.min, F.max)])
       .write.parquet(path))
    lo, hi = ({c: noted.get[f"{f}_{c}"] for c in feats} for f in ("min", "max"))
    scale = {c: F.lit(0.0) if lo[c] == hi[c] else (F.col(c) - F.lit(lo[c])) / F.lit(hi[c] - lo[c]) for c in feats}
    seq = ml.sequence_windows(spark.read.parquet(path).withColumns(scale), keep=("timestamp", "_seg"))
    samples = fresh_path(spark, "forecast/samples")
    seq.write.parquet(samples)
    return ml.chronological_split(spark.read.parquet(samples))


def forecasts(spark, d):
    """``reading_id, city, actual, predicted, last`` of held-out samples in scaled units, by the recurrent model.

    Fill forward -> scale to 0..1 -> sequences -> chronological split per city -> reservoir with a ridge readout.
    """
    split = _samples(spark, d)
    # an eighth of the training samples, by a hash of the reading, chooses the ridge weight
    train = split.filter("is_train").withColumn("late", F.pmod(F.xxhash64("reading_id"), F.lit(8)) == 0)
    model = forecast.fit(train, SEQ, 7, "late")
    test = split.filter("NOT is_train")
    told = forecast.forecast(model, test, "reading_id", "city", "target", "temperature_fahrenheit_lag1")
    return told.withColumnsRenamed({"target": "actual", "temperature_fahrenheit_lag1": "last"})


@register("forecast_predictions")
def q_forecasts(spark, d):
    """Every held-out sample with the value, its forecast and "as last time" (a learned result: no SQL twin, see tests/test_forecast.py)."""
    return forecasts(spark, d)


@register("forecast_regressor", sql("""SELECT count(*) AS n_test, round(avg(abs(v - prev)), 6) AS persistence_mae,
  round(sqrt(avg((v - prev) * (v - prev))), 6) AS persistence_rmse, TRUE AS better_mae, TRUE AS better_rmse
FROM scaled_test""", "scaled_test"))
def q_forecast_reg(spark, d):
    """Held-out rows, scaled errors of "as last time" on them, and whether the model's errors are smaller."""
    e, p = F.col("actual") - F.col("predicted"), F.col("actual") - F.col("last")
    told = fresh_path(spark, "forecast/told")
    forecasts(spark, d).write.parquet(told)
    return spark.read.parquet(told).agg(
        F.count(F.lit(1)).alias("n_test"), F.round(F.avg(F.abs(p)), 6).alias("persistence_mae"),
        F.round(F.sqrt(F.avg(p * p)), 6).alias("persistence_rmse"),
        (F.avg(F.abs(e)) < F.avg(F.abs(p))).alias("better_mae"), (F.avg(e * e) < F.avg(p * p)).alias("better_rmse"))

"""Threshold and null edge rows for every profile (hand-built, FIXTURES.md F1/F2)."""

import datetime as dt

from pyspark.sql import functions as F

from aerolith.functions import calendar as cal
from aerolith.functions import weather as wx
from aerolith.operators import clean
from aerolith.profiles import PROFILE_A, PROFILE_B, PROFILE_C


def _one(spark, cols: dict, expr):
    schema = ", ".join(f"{k} double" for k in cols)
    df = spark.createDataFrame([tuple(cols.values())], schema)
    return df.select(expr.alias("v")).first()["v"]


def test_heat_index_gates(spark):
    T, H = "temperature_fahrenheit", "humidity_percent"
    # A/C need H >= 40; B only T >= 80
    assert _one(spark, {T: 80.0, H: 39.0}, wx.heat_index(PROFILE_A)) == 80.0
    assert _one(spark, {T: 80.0, H: 39.0}, wx.heat_index(PROFILE_B)) != 80.0
    a = _one(spark, {T: 80.0, H: 40.0}, wx.heat_index(PROFILE_A))
    b = _one(spark, {T: 80.0, H: 40.0}, wx.heat_index(PROFILE_B))
    assert a == round(b, 1) and a != 80.0
    assert _one(spark, {T: 79.999, H: 90.0}, wx.heat_index(PROFILE_C)) == 80.0  # else branch rounded (C)
    assert _one(spark, {T: 79.999, H: 90.0}, wx.heat_index(PROFILE_A)) == 79.999
    assert _one(spark, {T: None, H: 50.0}, wx.heat_index(PROFILE_A)) is None


def test_wind_chill_gates(spark):
    T, W = "temperature_fahrenheit", "wind_speed_mph"
    assert _one(spark, {T: 50.0, W: 3.0}, wx.wind_chill(PROFILE_A)) == 50.0
    v = _one(spark, {T: 50.0, W: 3.1}, wx.wind_chill(PROFILE_A))
    assert v != 50.0 and round(v, 1) == v
    assert _one(spark, {T: 50.1, W: 20.0}, wx.wind_chill(PROFILE_B)) == 50.1


def test_extreme_flags_a_edges(spark):
    df = spark.createDataFrame([(105.0, 1.0, 40.0, 7.6), (104.9, 0.1, 39.9, 7.59)],
                               "heat_index double, wind_chill double, wind_speed_mph double, precipitation_mm double")
    df = df.withColumn("wind_chill", F.when(F.col("heat_index") == 105.0, F.lit(0.0)).otherwise(F.col("wind_chill")))
    rows = df.select(*[v.alias(k) for k, v in wx.extreme_flags_a().items()]).collect()
    assert [rows[0][k] for k in ("is_heatwave", "is_extreme_cold", "is_high_wind", "is_heavy_precipitation",
                                 "is_extreme_weather")] == [1, 1, 1, 1, 1]
    assert [rows[1][k] for k in ("is_heatwave", "is_extreme_cold", "is_high_wind", "is_heavy_precipitation",
                                 "is_extreme_weather")] == [0, 0, 0, 0, 0]


def test_extreme_flags_b_precip_not_in_extreme(spark):
    df = spark.createDataFrame([(70.0, 5.0, 11.0, 0.0)],
                               "temperature_fahrenheit double, wind_speed_mph double, precipitation_mm double, "
                               "temp_anomaly_score double")
    r = df.select(*[v.alias(k) for k, v in wx.extreme_flags_b().items()]).first()
    assert r["is_heavy_precipitation"] == 1 and r["is_extreme_weather"] == 0


def test_daytime_hours(spark):
    hours = [5, 6, 18, 19, 20]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    a = [r[0] for r in df.select(cal.daytime(PROFILE_A, F.col("h"))).collect()]
    b = [r[0] for r in df.select(cal.daytime(PROFILE_B, F.col("h"))).collect()]
    assert a == [0, 1, 1, 0, 0]
    assert b == [0, 1, 1, 1, 0]


def test_season_months(spark):
    df = spark.createDataFrame([(m,) for m in (2, 3, 11, 12)], "m int")
    assert [r[0] for r in df.select(cal.season(F.col("m"))).collect()] == ["Winter", "Spring", "Fall", "Winter"]


def test_range_flag_bounds_and_null(spark):
    rows = [(-60.0, 0.0, 0.0, 870.0), (140.0, 100.0, 250.0, 1084.0), (-60.1, 50.0, 5.0, 1000.0),
            (70.0, 100.1, 5.0, 1000.0), (70.0, 50.0, 250.1, 1000.0), (70.0, 50.0, 5.0, 869.9),
            (None, None, None, None), (141.0, -1.0, 300.0, 800.0)]
    df = spark.createDataFrame(rows, "temperature_fahrenheit double, humidity_percent double, "
                                     "wind_speed_mph double, pressure_hpa double")
    got = [r["quality_flag"] for r in clean.range_quality_flag(df).collect()]
    assert got == ["VALID", "VALID", "SUSPECT_TEMPERATURE", "SUSPECT_HUMIDITY", "SUSPECT_WIND",
                   "SUSPECT_PRESSURE", "VALID", "SUSPECT_TEMPERATURE"]


def test_clamp_b_keeps_null(spark):
    df = spark.createDataFrame([(70.0, -5.0), (70.0, 105.0), (70.0, None), (-81.0, 50.0), (140.0, 50.0)],
                               "temperature_fahrenheit double, humidity_percent double")
    got = [tuple(r) for r in clean.range_filter_clamp(df).collect()]
    assert got == [(70.0, 0.0), (70.0, 100.0), (70.0, None), (140.0, 50.0)]


def test_dedup_keeps_earliest_ingestion(spark):
    t = dt.datetime(2024, 1, 1, 0, 0)
    rows = [(2, "X", t, t + dt.timedelta(seconds=65), 71.0), (1, "X", t, t + dt.timedelta(seconds=5), 70.0),
            (3, "X", t + dt.timedelta(hours=1), t, 60.0), (4, None, t, t, 1.0)]
    df = spark.createDataFrame(rows, "reading_id long, city string, timestamp timestamp_ntz, "
                                     "ingestion_timestamp timestamp_ntz, temperature_fahrenheit double")
    got = sorted((r["reading_id"], r["temperature_fahrenheit"]) for r in clean.dedup_readings(df).collect())
    assert got == [(1, 70.0), (3, 60.0), (4, 1.0)]


def test_one_row_city_has_zero_score(spark):
    from aerolith.operators import features
    df = spark.createDataFrame([("Solo", 50.0, 10.0), ("Pair", 50.0, 10.0), ("Pair", 60.0, 10.0)],
                               "city string, temperature_fahrenheit double, humidity_percent double")
    out = {(r["city"], r["temperature_fahrenheit"]): r for r in features.with_city_anomalies(df, PROFILE_A).collect()}
    assert out[("Solo", 50.0)]["city_stddev_temp"] is None
    assert out[("Solo", 50.0)]["temp_anomaly_score"] == 0.0
    assert out[("Pair", 60.0)]["temperature_anomaly"] == 5.0
    assert out[("Pair", 60.0)]["temp_anomaly_score"] == round(5.0 / 7.07, 2)


def test_risk_levels(spark):
    rows = [(2.6, 70.0), (0.0, 101.0), (0.0, 9.0), (1.6, 70.0), (0.0, 91.0), (0.0, 19.0), (1.5, 90.0), (0.0, 20.0)]
    df = spark.createDataFrame(rows, "temp_anomaly_score double, temperature_fahrenheit double")
    got = [r[0] for r in df.select(wx.risk_level()).collect()]
    assert got == ["HIGH", "HIGH", "HIGH", "MODERATE", "MODERATE", "MODERATE", "LOW", "LOW"]


def test_extreme_reasons_text(spark):
    df = spark.createDataFrame([(101.26, 55.0, 3.0), (50.0, 5.0, 0.0)],
                               "temperature_fahrenheit double, wind_speed_mph double, temp_anomaly_score double")
    got = [r[0] for r in df.select(wx.extreme_reasons()).collect()]
    assert got[0] == ("High temperature (101.3°F > 100°F); High wind (55.0 mph > 50 mph); "
                      "High anomaly score (3.0 > 2.5)")
    assert got[1] == ""


def test_critical_present_agrees_with_dropna(spark):
    import datetime as dt
    from aerolith.operators import clean
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "A", t, 50.0), (2, None, t, 50.0), (3, "B", None, 50.0),
                                (4, "C", t, None), (5, "D", t, float("nan"))],
                               "reading_id long, city string, timestamp timestamp_ntz, temperature_fahrenheit double")
    kept = sorted(r[0] for r in clean.drop_null_critical(df, "A").collect())
    flagged = sorted(r[0] for r in df.filter(clean.critical_present(df, "A")).collect())
    assert kept == flagged == [1]


def test_exact_avg_round_ties(spark):
    """The mean 61.85 (a double just below the tie) rounds up; negative ties round away from zero."""
    from pyspark.sql import functions as F
    from aerolith.functions.numeric import exact_avg_round
    rows = [("a", 61.85)] * 41 + [("a", 2597.7 - 41 * 61.85), ("b", -0.25), ("b", -0.25), ("c", 1 / 3), ("d", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: (r["r1"], r["r2"]) for r in df.groupBy("k").agg(
        exact_avg_round("x", 1).alias("r1"), exact_avg_round("x", 2).alias("r2")).collect()}
    assert got == {"a": (61.9, 61.85), "b": (-0.3, -0.25), "c": (0.3, 0.33), "d": (None, None)}

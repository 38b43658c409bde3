"""Ordered per-city work on a hot city: bounded segments, results equal to a whole-city window."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolith.operators import ml


def _hot(spark, hot_rows=600, cold_cities=5, cold_rows=20):
    t0 = dt.datetime(2024, 1, 1)
    rows, rid = [], 0
    for city, n in [("Hot", hot_rows)] + [(f"C{i}", cold_rows) for i in range(cold_cities)]:
        for j in range(n):
            rid += 1
            temp = None if j % 11 == 3 else float((rid * 37) % 120)
            # all of the hot city's readings fall in one hour: hour segments would not split it
            rows.append((rid, city, t0 + dt.timedelta(seconds=j), temp, float(j % 7)))
    return spark.createDataFrame(rows, "reading_id long, city string, timestamp timestamp_ntz, "
                                       "temperature_fahrenheit double, humidity_percent double")


def test_hot_city_is_split(spark):
    df = _hot(spark)
    seg = ml.ordered_segments(df, "city", [F.col("timestamp"), F.col("reading_id")], parts=8)
    sizes = seg.groupBy("city", "_seg").count()
    assert sizes.filter("city = 'Hot'").count() >= 4
    assert sizes.agg(F.max("count")).first()[0] < 600


def test_forward_fill_matches_whole_city_window(spark):
    df = _hot(spark)
    got = ml.forward_fill(df, ["temperature_fahrenheit"], parts=8)
    w = (Window.partitionBy("city").orderBy("timestamp", "reading_id")
               .rowsBetween(Window.unboundedPreceding, 0))
    want = df.select("reading_id", F.coalesce(F.last("temperature_fahrenheit", ignorenulls=True).over(w),
                                              F.lit(0.0)).alias("temperature_fahrenheit"))
    a = sorted(tuple(r) for r in got.select("reading_id", "temperature_fahrenheit").collect())
    b = sorted(tuple(r) for r in want.collect())
    assert a == b


def test_sequence_windows_match_lags(spark):
    df = _hot(spark).fillna(0.0)
    feats = ["temperature_fahrenheit", "humidity_percent"]
    got = ml.sequence_windows(df, features=feats, parts=8)
    w = Window.partitionBy("city").orderBy("timestamp", "reading_id")
    want = (df.select("reading_id", F.row_number().over(w).alias("_rn"),
                      *[F.lag(f, i).over(w).alias(f"{f}_lag{i}") for i in range(1, 8) for f in feats])
              .filter("_rn > 7").drop("_rn"))
    cols = want.columns
    a = sorted(tuple(r) for r in got.select(cols).collect())
    b = sorted(tuple(r) for r in want.collect())
    assert len(a) == 600 - 7 + 5 * (20 - 7)
    assert a == b


def test_chronological_split_matches_row_number(spark):
    df = _hot(spark)
    got = ml.chronological_split(df, parts=8)
    w = Window.partitionBy("city").orderBy("timestamp", "reading_id")
    want = df.select("reading_id", (F.row_number().over(w)
                                    <= F.floor(F.count(F.lit(1)).over(Window.partitionBy("city")) * 0.8))
                     .alias("is_train"))
    a = sorted(tuple(r) for r in got.select("reading_id", "is_train").collect())
    b = sorted(tuple(r) for r in want.collect())
    assert a == b


def test_default_segments_without_coalescing(spark):
    """Without ``parts`` the session's shuffle width applies; results are exact however AQE sizes segments."""
    df = _hot(spark)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        seg = ml.ordered_segments(df, "city", [F.col("timestamp"), F.col("reading_id")])
        assert seg.filter("city = 'Hot'").select("_seg").distinct().count() > 1
        got = ml.forward_fill(df, ["temperature_fahrenheit"])
        a = sorted(tuple(r) for r in got.select("reading_id", "temperature_fahrenheit").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    w = (Window.partitionBy("city").orderBy("timestamp", "reading_id")
               .rowsBetween(Window.unboundedPreceding, 0))
    want = df.select("reading_id", F.coalesce(F.last("temperature_fahrenheit", ignorenulls=True).over(w),
                                              F.lit(0.0)).alias("temperature_fahrenheit"))
    assert a == sorted(tuple(r) for r in want.collect())

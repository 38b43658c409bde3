"""Serving operators over Gold (2.2 serving rules, 2.4 dashboards, 2.6 top-k)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.constants import MAP_COORDS_BY_CITY, US_REGION_BY_CITY
from aerolith.functions import weather as wx
from aerolith.functions.numeric import exact_avg_round
from aerolith.operators.hints import literal_broadcast

T, H, W = "temperature_fahrenheit", "humidity_percent", "wind_speed_mph"


def latest_per_city(gold: DataFrame, ts: str = "timestamp", tie: str = "reading_id", keys_hook=None) -> DataFrame:
    """One current row per city: latest timestamp, then highest id.

    Two hash aggregates over plain columns find each city's newest time and the highest id there (one small
    key row per city); the row itself is fetched by a join with those keys. Nothing is sorted to find it, a city with
    a third of all rows is reduced map-side, and unused columns are never read.

    ``keys_hook`` may materialise the key rows; the planner then knows their real size and broadcasts them when small, so
    that the rows, in full width, are filtered where they are read instead of being shuffled by city.
    """
    newest = gold.groupBy("city").agg(F.max(ts).alias("_ts"))
    at = gold.select("city", ts, tie).join(newest.withColumnRenamed("city", "_city"),
                                           (F.col("city") == F.col("_city")) & F.col(ts).eqNullSafe(F.col("_ts")))
    keys = at.groupBy(F.col("city").alias("_city"), "_ts").agg(F.max(tie).alias("_tie"))
    if keys_hook is not None:
        keys = keys_hook(keys)
    return (gold.join(keys, (F.col("city") == F.col("_city")) & F.col(ts).eqNullSafe(F.col("_ts"))
                      & (F.col(tie) == F.col("_tie")))
                .drop("_city", "_ts", "_tie"))


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """Global top-k: per-partition top-k, then a k-row merge (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def with_rank(df_top: DataFrame, *order) -> DataFrame:
    """Number an already-limited (k-row) result; the window spans k rows only."""
    return df_top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def region_lookup(df: DataFrame) -> DataFrame:
    """city -> one of 8 US regions via the fixed 20-entry map, else 'Other'."""
    spark = df.sparkSession
    m = literal_broadcast(spark.createDataFrame(list(US_REGION_BY_CITY.items()), "city string, us_region string"))
    return (df.join(m, "city", "left")
              .withColumn("us_region", F.coalesce(F.col("us_region"), F.lit("Other"))))


def geo_lookup(df: DataFrame) -> DataFrame:
    """city -> dashboard map coordinates, default (0, 0)."""
    spark = df.sparkSession
    rows = [(c, lat, lon) for c, (lat, lon) in MAP_COORDS_BY_CITY.items()]
    m = literal_broadcast(spark.createDataFrame(rows, "city string, map_lat double, map_lon double"))
    return (df.join(m, "city", "left")
              .withColumn("map_lat", F.coalesce("map_lat", F.lit(0.0)))
              .withColumn("map_lon", F.coalesce("map_lon", F.lit(0.0))))


def region_stats(latest: DataFrame) -> DataFrame:
    r = region_lookup(latest)
    return (r.groupBy("us_region").agg(
        exact_avg_round(T, 1).alias("avg_temp"),
        F.round(F.max(T), 1).alias("max_temp"),
        F.round(F.min(T), 1).alias("min_temp"),
        exact_avg_round(H, 1).alias("avg_humidity"),
        exact_avg_round(W, 1).alias("avg_wind"),
        F.concat_ws(",", F.array_sort(F.collect_list("city"))).alias("cities"),
        F.count(F.lit(1)).alias("city_count"),
        F.sum("is_extreme_weather").cast("long").alias("extreme_count")))


def city_cards(latest: DataFrame) -> DataFrame:
    r1 = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)), 1)
    return latest.select(
        "city", "state",
        r1(T).alias("temperature_f"), r1("temperature_celsius").alias("temperature_c"),
        r1(H).alias("humidity"), r1(W).alias("wind_speed"), r1("pressure_hpa").alias("pressure"),
        r1("heat_index").alias("heat_index"), F.col("weather_condition"),
        r1("cloud_cover_percent").alias("cloud_cover"),
        (F.col("is_extreme_weather") == 1).alias("is_extreme"),
        F.round(F.coalesce("temp_anomaly_score", F.lit(0.0)), 2).alias("anomaly_score"))


def risk_levels(latest: DataFrame) -> DataFrame:
    return latest.select(
        "city", "state", F.round(T, 1).alias("temperature_f"), F.round(H, 1).alias("humidity"),
        F.round(W, 1).alias("wind_speed"), F.round("heat_index", 1).alias("heat_index"),
        F.round("temp_anomaly_score", 2).alias("anomaly_score"),
        (F.col("is_extreme_weather") == 1).alias("predicted_extreme"),
        wx.risk_level().alias("risk_level"))


def forecast_24h(gold: DataFrame, ts: str = "timestamp", tie: str = "reading_id") -> DataFrame:
    """Per city and hour 1..24: current + sin(h*pi/12) * sd * 0.3, rounded to 1 dp.

    The current temperature is that of the latest reading (as ``latest_per_city``)
    and ``sd`` the city's sample stddev (2.0 for a one-row city), both from one
    partial aggregate per city. The unseeded noise term of the application is left
    out so the result is reproducible.
    """
    agg = gold.groupBy("city").agg(F.max_by(F.col(T), F.struct(ts, tie)).alias("current_temp_f"),
                                   F.count(F.lit(1)).alias("_n"), F.stddev_samp(T).alias("_sd"))
    base = agg.withColumn("_sd", F.when(F.col("_n") > 1, F.col("_sd")).otherwise(F.lit(2.0)))
    h = F.col("hour")
    pred = F.round(F.col("current_temp_f") + F.sin(h * F.lit(3.141592653589793) / 12) * F.col("_sd") * 0.3, 1)
    return (base.select("city", "current_temp_f", "_sd", F.explode(F.sequence(F.lit(1), F.lit(24))).alias("hour"))
                .select("city", "hour", pred.alias("predicted_temp_f"))
                .withColumn("predicted_temp_c", F.round((F.col("predicted_temp_f") - 32) * 5 / 9, 1))
                .withColumn("confidence", F.round(F.greatest(F.lit(0.7), 1.0 - h * 0.01), 2)))

"""Registered queries: cleaning (2.2), features and city windows (2.5) on the layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions import weather as wx
from aerolith.functions.numeric import safe_double, safe_int
from aerolith.operators import clean, features
from aerolith.plans import base, medallion
from aerolith.plans.oracle import READING_NAMES, sql
from aerolith.plans.registry import register
from aerolith.profiles import PROFILE_A, PROFILE_B, PROFILE_C
from aerolith.sources.tables import readings

_R = ", ".join(READING_NAMES)


@register("dedup_readings", sql(f"SELECT {_R} FROM readings_dedup", "readings_dedup"))
def q_dedup(spark, d):
    return clean.dedup_readings(readings(spark, d))


@register("range_quality_flag", sql(
    "SELECT reading_id, city, quality_flag FROM (SELECT *, " + clean.range_quality_flag_sql()
    + " AS quality_flag FROM readings_dedup) x", "readings_dedup"))
def q_flag(spark, d):
    return clean.range_quality_flag(clean.dedup_readings(readings(spark, d))).select(
        "reading_id", "city", "quality_flag")


@register("drop_null_critical", sql(
    "SELECT count(*) FILTER (WHERE " + clean.drop_null_critical_sql("A") + ") AS kept_a, "
    "count(*) FILTER (WHERE " + clean.drop_null_critical_sql("B") + ") AS kept_b, "
    "count(*) AS total FROM readings_dedup", "readings_dedup"))
def q_dropnull(spark, d):
    df = clean.dedup_readings(readings(spark, d))
    a = F.col("city").isNotNull() & F.col("timestamp").isNotNull() & F.col("temperature_fahrenheit").isNotNull()
    b = F.col("city").isNotNull() & F.col("temperature_fahrenheit").isNotNull()
    # one scan with conditional counts; equals count() of dropna(subset) for each profile
    return df.agg(F.count(F.when(a, 1)).alias("kept_a"), F.count(F.when(b, 1)).alias("kept_b"),
                  F.count(F.lit(1)).alias("total"))


@register("silver_a", sql(f"SELECT * FROM silver_a", "silver_a"))
def q_silver_a(spark, d):
    """Whole Silver A layer: dedup, flag, drop nulls, fill defaults, celsius, date parts."""
    return base.silver_a(spark, d)


@register("fill_null_defaults", sql(
    "SELECT reading_id, humidity_percent, wind_speed_mph, wind_direction_degrees, precipitation_mm, "
    "visibility_miles, cloud_cover_percent, weather_condition, weather_description, state, country, "
    "continent, region FROM silver_a", "silver_a"))
def q_fill(spark, d):
    return base.silver_a(spark, d).select(
        "reading_id", "humidity_percent", "wind_speed_mph", "wind_direction_degrees", "precipitation_mm",
        "visibility_miles", "cloud_cover_percent", "weather_condition", "weather_description", "state",
        "country", "continent", "region")


@register("celsius_backfill", sql(
    "SELECT reading_id, temperature_celsius AS celsius_a, "
    "round((temperature_fahrenheit - 32) * 5 / 9, 2) AS celsius_b FROM silver_a", "silver_a"))
def q_celsius(spark, d):
    # both variants in one projection of the same rows: B rebuilds the column, so hide A's under another name
    s = base.silver_a(spark, d).withColumnRenamed("temperature_celsius", "celsius_a")
    b = clean.celsius_backfill(s, "B")
    return b.select("reading_id", "celsius_a", F.col("temperature_celsius").alias("celsius_b"))


@register("reading_date_parts", sql(
    "SELECT reading_date, reading_year, reading_month, reading_day, count(*) AS n FROM silver_a "
    "GROUP BY ALL", "silver_a"))
def q_date_parts(spark, d):
    return (base.silver_a(spark, d)
            .groupBy("reading_date", "reading_year", "reading_month", "reading_day")
            .agg(F.count(F.lit(1)).alias("n")))


@register("valid_only", sql("SELECT reading_id, city FROM silver_a WHERE quality_flag = 'VALID'", "silver_a"))
def q_valid(spark, d):
    return clean.valid_only(base.silver_a(spark, d)).select("reading_id", "city")


@register("range_filter_clamp", sql(
    "SELECT reading_id, temperature_fahrenheit, humidity_percent FROM silver_b", "silver_b"))
def q_clamp(spark, d):
    return base.silver_b(spark, d).select("reading_id", "temperature_fahrenheit", "humidity_percent")


@register("silver_b", sql("SELECT * FROM silver_b", "silver_b"))
def q_silver_b(spark, d):
    return base.silver_b(spark, d)


@register("gold_a", sql("SELECT * FROM gold_a", "gold_a"))
def q_gold_a(spark, d):
    """Whole Gold A layer (49 reference columns plus reading_id)."""
    return base.gold_a(spark, d)


@register("gold_b", sql("SELECT * FROM gold_b", "gold_b"))
def q_gold_b(spark, d):
    return base.gold_b(spark, d)


@register("fill_numeric_zero", sql(
    "SELECT reading_id, temperature_celsius, heat_index, wind_direction_degrees, humidity_percent "
    "FROM gold_b", "gold_b"))
def q_fill_zero(spark, d):
    return base.gold_b(spark, d).select("reading_id", "temperature_celsius", "heat_index",
                                        "wind_direction_degrees", "humidity_percent")


# heat index / wind chill under every profile, on the deduplicated readings
@register("heat_index", sql(
    f"SELECT reading_id, {wx.heat_index_sql(PROFILE_A)} AS heat_index_a, "
    f"{wx.heat_index_sql(PROFILE_B)} AS heat_index_b, {wx.heat_index_sql(PROFILE_C)} AS heat_index_c "
    "FROM readings_dedup", "readings_dedup"))
def q_heat_index(spark, d):
    return clean.dedup_readings(readings(spark, d)).select(
        "reading_id", wx.heat_index(PROFILE_A).alias("heat_index_a"),
        wx.heat_index(PROFILE_B).alias("heat_index_b"), wx.heat_index(PROFILE_C).alias("heat_index_c"))


@register("wind_chill", sql(
    f"SELECT reading_id, {wx.wind_chill_sql(PROFILE_A)} AS wind_chill_a, "
    f"{wx.wind_chill_sql(PROFILE_B)} AS wind_chill_b FROM readings_dedup", "readings_dedup"))
def q_wind_chill(spark, d):
    return clean.dedup_readings(readings(spark, d)).select(
        "reading_id", wx.wind_chill(PROFILE_A).alias("wind_chill_a"),
        wx.wind_chill(PROFILE_B).alias("wind_chill_b"))


@register("extreme_flags_a", sql(
    "SELECT reading_id, is_heatwave, is_extreme_cold, is_high_wind, is_heavy_precipitation, "
    "is_extreme_weather FROM gold_a", "gold_a"))
def q_flags_a(spark, d):
    return base.gold_a(spark, d).select("reading_id", "is_heatwave", "is_extreme_cold", "is_high_wind",
                                        "is_heavy_precipitation", "is_extreme_weather")


@register("extreme_flags_b", sql(
    "SELECT reading_id, is_heatwave, is_extreme_cold, is_high_wind, is_heavy_precipitation, "
    "is_extreme_weather FROM gold_b", "gold_b"))
def q_flags_b(spark, d):
    return base.gold_b(spark, d).select("reading_id", "is_heatwave", "is_extreme_cold", "is_high_wind",
                                        "is_heavy_precipitation", "is_extreme_weather")


@register("time_features_a", sql(
    "SELECT reading_id, hour_of_day, day_of_week, month_of_year, quarter, season, is_daytime "
    "FROM gold_a", "gold_a"))
def q_time_a(spark, d):
    return base.gold_a(spark, d).select("reading_id", "hour_of_day", "day_of_week", "month_of_year",
                                        "quarter", "season", "is_daytime")


@register("time_features_b", sql(
    "SELECT reading_id, hour_of_day, day_of_week, month, is_daytime FROM gold_b", "gold_b"))
def q_time_b(spark, d):
    return base.gold_b(spark, d).select("reading_id", "hour_of_day", "day_of_week", "month", "is_daytime")


@register("visibility_km", sql("SELECT reading_id, visibility_km FROM gold_b", "gold_b"))
def q_vis(spark, d):
    return base.gold_b(spark, d).select("reading_id", "visibility_km")


@register("safe_numeric_cast", sql(
    "SELECT reading_id, TRY_CAST(trunc(wind_direction_degrees) AS INTEGER) AS wind_direction_int, "
    "TRY_CAST(trunc(cloud_cover_percent) AS INTEGER) AS cloud_cover_int, "
    "TRY_CAST(trunc(temperature_celsius) AS INTEGER) AS celsius_int, "
    "TRY_CAST(weather_condition AS DOUBLE) AS condition_as_double FROM gold_a", "gold_a"))
def q_safe_cast(spark, d):
    g = base.gold_a(spark, d)
    return g.select("reading_id", safe_int(F.col("wind_direction_degrees")).alias("wind_direction_int"),
                    safe_int(F.col("cloud_cover_percent")).alias("cloud_cover_int"),
                    safe_int(F.col("temperature_celsius")).alias("celsius_int"),
                    safe_double("weather_condition").alias("condition_as_double"))


@register("adaptive_columns", sql(
    "SELECT reading_id, round((temperature_fahrenheit - 32) * 5 / 9, 2) AS temperature_celsius, "
    "CAST(0.0 AS DOUBLE) AS visibility_km, 0 AS is_heavy_precipitation, "
    "CAST(hour(timestamp) AS INTEGER) AS hour_of_day FROM silver_b", "silver_b"))
def q_adaptive(spark, d):
    """Variant B rules on a layer lacking celsius, visibility and precipitation, whose time
    column is ``reading_timestamp``: each rule adapts to the columns present."""
    df = readings(spark, d).drop("temperature_celsius", "visibility_miles", "precipitation_mm") \
        .withColumnRenamed("timestamp", "reading_timestamp")
    return medallion.gold_b(medallion.silver_b(df)).select(
        "reading_id", "temperature_celsius", "visibility_km", "is_heavy_precipitation", "hour_of_day")


# --- 2.5 city windows -------------------------------------------------------

@register("city_statistics", sql("SELECT * FROM city_stats_a", "city_stats_a"))
def q_city_stats(spark, d):
    g = clean.valid_only(base.silver_a(spark, d))
    return features.city_statistics(g, PROFILE_A)


@register("temperature_anomaly", sql(
    "SELECT a.reading_id, a.temperature_anomaly AS anomaly_a, b.temperature_anomaly AS anomaly_b "
    "FROM gold_a a JOIN gold_b b ON a.reading_id = b.reading_id", "gold_a", "gold_b"))
def q_anomaly(spark, d):
    a = base.gold_a(spark, d).select("reading_id", F.col("temperature_anomaly").alias("anomaly_a"))
    b = base.gold_b(spark, d).select("reading_id", F.col("temperature_anomaly").alias("anomaly_b"))
    return a.join(b, "reading_id")


@register("anomaly_score", sql(
    "SELECT a.reading_id, a.temp_anomaly_score AS score_a, b.temp_anomaly_score AS score_b "
    "FROM gold_a a JOIN gold_b b ON a.reading_id = b.reading_id", "gold_a", "gold_b"))
def q_score(spark, d):
    a = base.gold_a(spark, d).select("reading_id", F.col("temp_anomaly_score").alias("score_a"))
    b = base.gold_b(spark, d).select("reading_id", F.col("temp_anomaly_score").alias("score_b"))
    return a.join(b, "reading_id")

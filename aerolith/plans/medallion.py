"""Bronze -> Silver -> Gold as one lazy chain per profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from aerolith.functions import calendar as cal
from aerolith.functions import weather as wx
from aerolith.operators import clean, features
from aerolith.profiles import PROFILE_A, PROFILE_B


def silver_a(bronze: DataFrame, stamp: bool = False, noted: tuple[Observation, Observation] | None = None) -> DataFrame:
    """dedup -> range flag -> drop null critical -> fill defaults -> celsius -> date parts.

    ``noted`` observes the rows after the de-duplication and the Silver rows with the valid ones among them, while they are
    written. Both places lie in the writing stage, so a stage that runs again does not count twice; such a plan is for one write.
    """
    df = clean.dedup_readings(bronze)
    if noted:
        df = df.observe(noted[0], F.count(F.lit(1)).alias("after_dedup"))
    df = clean.range_quality_flag(df)
    df = clean.drop_null_critical(df, "A")
    if noted:
        df = df.observe(noted[1], F.count(F.lit(1)).alias("silver_rows"), F.count(F.when(F.col("quality_flag") == "VALID", 1)).alias("valid_rows"))
    df = clean.fill_null_defaults(df)
    df = clean.celsius_backfill(df, "A")
    df = clean.reading_date_parts(df)
    if stamp:
        df = df.withColumn("silver_loaded_at", F.current_timestamp())
    return df


def gold_a(silver: DataFrame, stamp: bool = False, stats_hook=None) -> DataFrame:
    """VALID rows -> heat index, wind chill, extreme flags, time features, city anomalies."""
    df = clean.valid_only(silver)
    df = features.add_heat_index(df, PROFILE_A)
    df = features.add_wind_chill(df, PROFILE_A)
    df = df.withColumns(wx.extreme_flags_a())
    df = df.withColumns(cal.time_features_a())
    df = features.with_city_anomalies(df, PROFILE_A, stats_hook=stats_hook)
    if stamp:
        df = df.withColumn("gold_loaded_at", F.current_timestamp())
    return df


def silver_b(bronze: DataFrame, stamp: bool = False) -> DataFrame:
    """dedup -> drop null critical -> range filter + clamp -> quality tag -> reading_date."""
    df = clean.dedup_readings(bronze)
    df = clean.drop_null_critical(df, "B")
    df = clean.range_filter_clamp(df)
    if stamp:
        df = df.withColumn("processed_at", F.current_timestamp())
    df = df.withColumn("data_quality_flag", F.lit("PASSED"))
    ts = clean.first_timestamp_column(df)
    return df.withColumn("reading_date", F.to_date(ts) if ts else F.current_date())


def gold_b(silver: DataFrame, stats_hook=None) -> DataFrame:
    """Column-adaptive feature chain of the orchestrated variant, nulls -> 0 at the end."""
    df = clean.celsius_backfill(silver, "B")
    cols = set(df.columns)
    if {"temperature_fahrenheit", "humidity_percent"} <= cols:
        df = features.add_heat_index(df, PROFILE_B)
    if {"temperature_fahrenheit", "wind_speed_mph"} <= cols:
        df = features.add_wind_chill(df, PROFILE_B)
    if {"city", "temperature_fahrenheit"} <= cols:
        df = features.with_city_anomalies(df, PROFILE_B, with_humidity=False, stats_hook=stats_hook)
    ts = clean.first_timestamp_column(df)
    if ts:
        df = df.withColumns(cal.time_features_b(ts))
    df = features.visibility_km(df)
    df = df.withColumns(wx.extreme_flags_b("precipitation_mm" in df.columns))
    return clean.fill_numeric_zero(df)

"""Gold-layer feature operators (2.2 formulas, 2.5 city statistics and anomalies)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions import weather as wx
from aerolith.functions.numeric import exact_avg_round, exact_avg_round_sql
from aerolith.profiles import Profile

T = "temperature_fahrenheit"


def add_heat_index(df: DataFrame, p: Profile) -> DataFrame:
    return df.withColumn("heat_index", wx.heat_index(p))


def add_wind_chill(df: DataFrame, p: Profile) -> DataFrame:
    return df.withColumn("wind_chill", wx.wind_chill(p))


def city_statistics(df: DataFrame, p: Profile, with_humidity: bool = True) -> DataFrame:
    """Per-city aggregate table: avg/min/max (profile digits), sample stddev (2 dp).

    This replaces the reference's whole-partition window. A window needs every row
    of a city in one task; the aggregate runs a partial step per map task and
    shuffles one small buffer per (task, city), so a city holding a third of all
    rows costs no more than any other. The per-city table is then joined back.
    """
    d = p.stats_digits
    aggs = [exact_avg_round(T, d).alias("city_avg_temp"),
            F.round(F.min(T), d).alias("city_min_temp"),
            F.round(F.max(T), d).alias("city_max_temp"),
            F.round(F.stddev_samp(T), 2).alias("city_stddev_temp")]
    if with_humidity:
        aggs.append(exact_avg_round("humidity_percent", 1).alias("city_avg_humidity"))
    return df.groupBy("city").agg(*aggs)


def city_statistics_sql(p: Profile, src: str, with_humidity: bool = True) -> str:
    d = p.stats_digits
    hum = f", {exact_avg_round_sql('humidity_percent', 1)} AS city_avg_humidity" if with_humidity else ""
    return (f"SELECT city, {exact_avg_round_sql(T, d)} AS city_avg_temp, "
            f"round(min({T}), {d}) AS city_min_temp, round(max({T}), {d}) AS city_max_temp, "
            f"round(stddev_samp({T}), 2) AS city_stddev_temp{hum} FROM {src} GROUP BY city")


def temperature_anomaly(p: Profile):
    return F.round(F.col(T) - F.col("city_avg_temp"), p.anomaly_digits)


def anomaly_score(p: Profile):
    sd = F.col("city_stddev_temp")
    base = F.abs(F.col("temperature_anomaly")) if p.score_from_rounded_anomaly else \
        F.abs(F.col(T) - F.col("city_avg_temp"))
    return F.when(sd > 0, F.round(base / sd, 2)).otherwise(F.lit(0.0))


def anomaly_sql(p: Profile) -> tuple[str, str]:
    anom = f"round({T} - s.city_avg_temp, {p.anomaly_digits})"
    base = f"abs({anom})" if p.score_from_rounded_anomaly else f"abs({T} - s.city_avg_temp)"
    score = f"CASE WHEN s.city_stddev_temp > 0 THEN round({base} / s.city_stddev_temp, 2) ELSE 0.0 END"
    return anom, score


def with_city_anomalies(df: DataFrame, p: Profile, with_humidity: bool = True,
                        stats_hook=None) -> DataFrame:
    """Join per-city statistics back and derive anomaly and score columns.

    ``stats_hook`` may materialise the (one row per city) statistics table; the
    planner then knows its real size and broadcasts it when small, so the
    readings are never shuffled by city (no skew on a hot city), and the input
    is not recomputed for the second branch of the join.
    """
    stats = city_statistics(df, p, with_humidity)
    if stats_hook is not None:
        stats = stats_hook(stats)
    out = df.join(stats, "city", "left")
    out = out.withColumn("temperature_anomaly", temperature_anomaly(p))
    return out.withColumn("temp_anomaly_score", anomaly_score(p))


def visibility_km(df: DataFrame) -> DataFrame:
    if "visibility_km" in df.columns:
        return df
    if "visibility_miles" in df.columns:
        return df.withColumn("visibility_km", F.round(F.col("visibility_miles") * 1.60934, 2))
    return df.withColumn("visibility_km", F.lit(None).cast("double"))

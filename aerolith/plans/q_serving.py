"""Registered queries: serving (2.2 rules, 2.4 dashboards, 2.6 top-k) over Gold A."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.constants import MAP_COORDS_BY_CITY, US_REGION_BY_CITY
from aerolith.functions import weather as wx
from aerolith.functions.numeric import exact_avg_round, exact_avg_round_sql
from aerolith.operators import serving
from aerolith.plans import base
from aerolith.plans.oracle import sql
from aerolith.plans.registry import register

T, H, W = "temperature_fahrenheit", "humidity_percent", "wind_speed_mph"


latest = base.latest_a


def _values(pairs) -> str:
    return ", ".join("(" + ", ".join(repr(x) if isinstance(x, str) else f"CAST({x} AS DOUBLE)"
                                     for x in p) + ")" for p in pairs)


_REGION_VALUES = _values(US_REGION_BY_CITY.items())
_GEO_VALUES = _values((c, a, b) for c, (a, b) in MAP_COORDS_BY_CITY.items())


@register("latest_per_city", sql("SELECT city, reading_id, timestamp FROM latest_a", "latest_a"))
def q_latest(spark, d):
    return serving.latest_per_city(base.gold_a(spark, d)).select("city", "reading_id", "timestamp")


_CARDS_SQL = """SELECT city, state, round(coalesce(temperature_fahrenheit, 0.0), 1) AS temperature_f,
  round(coalesce(temperature_celsius, 0.0), 1) AS temperature_c, round(coalesce(humidity_percent, 0.0), 1) AS humidity,
  round(coalesce(wind_speed_mph, 0.0), 1) AS wind_speed, round(coalesce(pressure_hpa, 0.0), 1) AS pressure,
  round(coalesce(heat_index, 0.0), 1) AS heat_index, weather_condition,
  round(coalesce(cloud_cover_percent, 0.0), 1) AS cloud_cover, is_extreme_weather = 1 AS is_extreme,
  round(coalesce(temp_anomaly_score, 0.0), 2) AS anomaly_score FROM latest_a"""


@register("city_cards", sql(_CARDS_SQL, "latest_a"))
def q_cards(spark, d):
    return serving.city_cards(latest(spark, d))


_DETAIL_CITY = "city_7"


@register("city_detail", sql(f"""SELECT city, state, latitude, longitude,
  round(temperature_fahrenheit, 1) AS temperature_fahrenheit, round(temperature_celsius, 1) AS temperature_celsius,
  round(heat_index, 1) AS heat_index, round(wind_chill, 1) AS wind_chill, weather_condition AS weather,
  round(humidity_percent, 1) AS humidity_percent, round(pressure_hpa, 1) AS pressure_hpa,
  round(wind_speed_mph, 1) AS wind_speed_mph, round(wind_direction_degrees, 1) AS wind_direction_deg,
  round(cloud_cover_percent, 1) AS cloud_cover_percent, round(visibility_miles, 1) AS visibility_miles,
  is_extreme_weather = 1 AS is_extreme_weather, round(temp_anomaly_score, 2) AS anomaly_score,
  round(temperature_anomaly, 2) AS temperature_anomaly, round(city_avg_temp, 1) AS city_avg_temp
FROM latest_a WHERE lower(city) = lower('{_DETAIL_CITY}')""", "latest_a"))
def q_detail(spark, d, city: str = _DETAIL_CITY):
    """Case-insensitive lookup of one city's current record (the nested API record, flattened)."""
    r1 = lambda c: F.round(c, 1)
    lt = latest(spark, d).filter(F.lower("city") == F.lower(F.lit(city)))
    return lt.select(
        "city", "state", "latitude", "longitude",
        r1(T).alias("temperature_fahrenheit"), r1("temperature_celsius").alias("temperature_celsius"),
        r1("heat_index").alias("heat_index"), r1("wind_chill").alias("wind_chill"),
        F.col("weather_condition").alias("weather"), r1(H).alias("humidity_percent"),
        r1("pressure_hpa").alias("pressure_hpa"), r1(W).alias("wind_speed_mph"),
        r1("wind_direction_degrees").alias("wind_direction_deg"),
        r1("cloud_cover_percent").alias("cloud_cover_percent"), r1("visibility_miles").alias("visibility_miles"),
        (F.col("is_extreme_weather") == 1).alias("is_extreme_weather"),
        F.round("temp_anomaly_score", 2).alias("anomaly_score"),
        F.round("temperature_anomaly", 2).alias("temperature_anomaly"), r1("city_avg_temp").alias("city_avg_temp"))


@register("risk_level", sql(f"""SELECT city, state, round({T}, 1) AS temperature_f, round({H}, 1) AS humidity,
  round({W}, 1) AS wind_speed, round(heat_index, 1) AS heat_index, round(temp_anomaly_score, 2) AS anomaly_score,
  is_extreme_weather = 1 AS predicted_extreme, {wx.risk_level_sql()} AS risk_level FROM latest_a""", "latest_a"))
def q_risk(spark, d):
    return serving.risk_levels(latest(spark, d))


@register("risk_summary", sql(f"""SELECT count(*) FILTER (WHERE r = 'HIGH') AS high_risk,
  count(*) FILTER (WHERE r = 'MODERATE') AS moderate_risk, count(*) FILTER (WHERE r = 'LOW') AS low_risk
FROM (SELECT {wx.risk_level_sql()} AS r FROM latest_a) x""", "latest_a"))
def q_risk_summary(spark, d):
    r = latest(spark, d).select(wx.risk_level().alias("r"))
    return r.agg(F.count(F.when(F.col("r") == "HIGH", 1)).alias("high_risk"),
                 F.count(F.when(F.col("r") == "MODERATE", 1)).alias("moderate_risk"),
                 F.count(F.when(F.col("r") == "LOW", 1)).alias("low_risk"))


@register("extreme_reasons", sql(f"""SELECT city, state, round({T}, 1) AS temperature_f,
  round(temp_anomaly_score, 2) AS anomaly_score, round({W}, 1) AS wind_speed,
  {wx.extreme_reasons_sql()} AS reasons FROM latest_a WHERE is_extreme_weather = 1""", "latest_a"))
def q_reasons(spark, d):
    lt = latest(spark, d).filter(F.col("is_extreme_weather") == 1)
    return lt.select("city", "state", F.round(T, 1).alias("temperature_f"),
                     F.round("temp_anomaly_score", 2).alias("anomaly_score"), F.round(W, 1).alias("wind_speed"),
                     wx.extreme_reasons().alias("reasons"))


def _top5(spark, d, asc: bool):
    order = [F.col(T).asc() if asc else F.col(T).desc(), F.col("city").asc()]
    top = serving.top_k(latest(spark, d).select("city", "country", T), 5, *order)
    return serving.with_rank(top, *order).select("rank", "city", "country", F.round(T, 1).alias("temperature_f"))


_TOP5 = """SELECT CAST(row_number() OVER (ORDER BY {T} {dir}, city) AS INTEGER) AS rank, city, country,
  round({T}, 1) AS temperature_f FROM latest_a ORDER BY {T} {dir}, city LIMIT 5"""


@register("top5_hottest", sql(_TOP5.format(T=T, dir="DESC"), "latest_a"))
def q_hot(spark, d):
    return _top5(spark, d, asc=False)


@register("top5_coldest", sql(_TOP5.format(T=T, dir="ASC"), "latest_a"))
def q_cold(spark, d):
    return _top5(spark, d, asc=True)


@register("most_humid", sql(f"""SELECT city, country, round({H}, 1) AS humidity, round({T}, 1) AS temperature_f
FROM latest_a ORDER BY {H} DESC NULLS LAST, city LIMIT 1""", "latest_a"))
def q_humid(spark, d):
    top = serving.top_k(latest(spark, d), 1, F.col(H).desc_nulls_last(), F.col("city"))
    return top.select("city", "country", F.round(H, 1).alias("humidity"), F.round(T, 1).alias("temperature_f"))


@register("windiest", sql(f"""SELECT city, country, round({W}, 1) AS wind_speed, round({T}, 1) AS temperature_f
FROM latest_a ORDER BY {W} DESC NULLS LAST, city LIMIT 1""", "latest_a"))
def q_windy(spark, d):
    top = serving.top_k(latest(spark, d), 1, F.col(W).desc_nulls_last(), F.col("city"))
    return top.select("city", "country", F.round(W, 1).alias("wind_speed"), F.round(T, 1).alias("temperature_f"))


def _now(flag_col: str | None, fallback):
    def q(spark, d):
        lt = latest(spark, d)
        cond = (F.col(flag_col) == 1) if flag_col in lt.columns else fallback()
        return lt.filter(cond).select("city", "country", F.round(T, 1).alias("temperature_f"))
    return q


register("extreme_now", sql(f"SELECT city, country, round({T}, 1) AS temperature_f FROM latest_a "
                            "WHERE is_extreme_weather = 1", "latest_a"))(_now("is_extreme_weather", lambda: F.lit(False)))
register("heatwave_now", sql(f"SELECT city, country, round({T}, 1) AS temperature_f FROM latest_a "
                             "WHERE is_heatwave = 1", "latest_a"))(_now("is_heatwave", lambda: F.col(T) > 100))
register("extreme_cold_now", sql(f"SELECT city, country, round({T}, 1) AS temperature_f FROM latest_a "
                                 "WHERE is_extreme_cold = 1", "latest_a"))(_now("is_extreme_cold", lambda: F.col(T) < 10))

_ANOM_THRESHOLD = 1.5


@register("anomalies_over", sql(f"""SELECT city, state, round({T}, 1) AS temperature_f,
  round(city_avg_temp, 1) AS city_avg_temp, round(temp_anomaly_score, 2) AS anomaly_score,
  round(temperature_anomaly, 2) AS temperature_anomaly FROM latest_a
WHERE temp_anomaly_score >= {_ANOM_THRESHOLD}""", "latest_a"))
def q_anomalies_over(spark, d, threshold: float = _ANOM_THRESHOLD):
    lt = latest(spark, d).filter(F.col("temp_anomaly_score") >= threshold)
    return (lt.orderBy(F.desc("temp_anomaly_score"), "city")
              .select("city", "state", F.round(T, 1).alias("temperature_f"),
                      F.round("city_avg_temp", 1).alias("city_avg_temp"),
                      F.round("temp_anomaly_score", 2).alias("anomaly_score"),
                      F.round("temperature_anomaly", 2).alias("temperature_anomaly")))


@register("distinct_cities", sql("""SELECT (SELECT count(DISTINCT city) FROM silver_a) AS silver_cities,
  (SELECT count(DISTINCT city) FROM gold_a) AS gold_cities""", "gold_a"))
def q_distinct(spark, d):
    s = base.silver_a(spark, d)
    # one scan: a city is a gold city when it has at least one VALID row
    per_city = s.groupBy("city").agg(F.max((F.col("quality_flag") == "VALID").cast("int")).alias("v"))
    return per_city.agg(F.count(F.lit(1)).alias("silver_cities"), F.sum("v").cast("long").alias("gold_cities"))


@register("region_stats", sql(f"""SELECT us_region, {exact_avg_round_sql(T, 1)} AS avg_temp,
  round(max({T}), 1) AS max_temp, round(min({T}), 1) AS min_temp, {exact_avg_round_sql(H, 1)} AS avg_humidity,
  {exact_avg_round_sql(W, 1)} AS avg_wind, array_to_string(list_sort(list(city)), ',') AS cities,
  count(*) AS city_count, CAST(sum(is_extreme_weather) AS BIGINT) AS extreme_count
FROM (SELECT l.*, coalesce(m.us_region, 'Other') AS us_region FROM latest_a l
      LEFT JOIN (VALUES {_REGION_VALUES}) m(city, us_region) ON l.city = m.city) x GROUP BY us_region""",
                            "latest_a"))
def q_region_stats(spark, d):
    return serving.region_stats(latest(spark, d))


@register("region_lookup", sql(f"""SELECT l.city, coalesce(m.us_region, 'Other') AS us_region FROM latest_a l
LEFT JOIN (VALUES {_REGION_VALUES}) m(city, us_region) ON l.city = m.city""", "latest_a"))
def q_region_lookup(spark, d):
    return serving.region_lookup(latest(spark, d).select("city")).select("city", "us_region")


@register("geo_lookup", sql(f"""SELECT l.city, coalesce(m.lat, 0.0) AS map_lat, coalesce(m.lon, 0.0) AS map_lon
FROM latest_a l LEFT JOIN (VALUES {_GEO_VALUES}) m(city, lat, lon) ON l.city = m.city""", "latest_a"))
def q_geo(spark, d):
    return serving.geo_lookup(latest(spark, d).select("city")).select("city", "map_lat", "map_lon")


@register("dashboard_stats", sql(f"""SELECT count(*) AS total_readings, count(DISTINCT city) AS total_cities,
  {exact_avg_round_sql(T, 1)} AS avg_temperature, round(max({T}), 1) AS max_temperature,
  round(min({T}), 1) AS min_temperature, CAST(sum(is_extreme_weather) AS BIGINT) AS extreme_events,
  count(DISTINCT continent) AS continents, count(DISTINCT country) AS countries FROM gold_a""", "gold_a"))
def q_dashboard(spark, d):
    g = base.gold_a(spark, d)
    return g.agg(F.count(F.lit(1)).alias("total_readings"), F.countDistinct("city").alias("total_cities"),
                 exact_avg_round(T, 1).alias("avg_temperature"), F.round(F.max(T), 1).alias("max_temperature"),
                 F.round(F.min(T), 1).alias("min_temperature"),
                 F.sum("is_extreme_weather").cast("long").alias("extreme_events"),
                 F.countDistinct("continent").alias("continents"), F.countDistinct("country").alias("countries"))


@register("forecast_24h", sql(f"""SELECT city, hour, predicted_temp_f, round((predicted_temp_f - 32) * 5 / 9, 1) AS predicted_temp_c,
  round(greatest(0.7e0, 1.0e0 - hour * 0.01e0), 2) AS confidence
FROM (SELECT l.city, h.hour, round(l.{T} + sin(h.hour * pi() / 12) * s.sd * 0.3, 1) AS predicted_temp_f
      FROM latest_a l JOIN (SELECT city, CASE WHEN count(*) > 1 THEN stddev_samp({T}) ELSE 2.0 END AS sd
                            FROM gold_a GROUP BY city) s ON l.city = s.city,
           (SELECT CAST(range AS INTEGER) AS hour FROM range(1, 25)) h) x""", "latest_a"))
def q_forecast(spark, d):
    g = base.gold_a(spark, d)
    return serving.forecast_24h(g)

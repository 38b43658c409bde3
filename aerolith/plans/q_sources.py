"""Registered queries: payload decoding, layer IO, sinks and streams (2.1, 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.constants import city_catalogue_rows
from aerolith.functions import weather as wx
from aerolith.plans import base
from aerolith.plans.oracle import cte, sql
from aerolith.plans.registry import register
from aerolith.profiles import PROFILE_C
from aerolith.schemas import READING_FIELDS
from aerolith.sources import layers, payloads as pl
from aerolith.sources.tables import memo, readings
from aerolith.streaming import jobs

_ISO = f"strftime(timestamp, '{pl.ISO_DUCK}')"
_NOT_MALFORMED = f"reading_id % {pl.MALFORMED_EVERY} <> 0 AND reading_id % {pl.QUOTED_EVERY} <> 0"


def _topic_path(spark, d, name: str, build) -> str:
    """A topic's messages, published (written) once per application, in several parts as a topic holds them."""
    return memo(spark, f"topic-{name}", d)(lambda: layers.land(layers.spread(build(readings(spark, d)), "message_id"), name))


def simple_topic_path(spark, d) -> str:
    return _topic_path(spark, d, "simple-topic", pl.simple_reading_topic)


def _topic(spark, d, name: str, build):
    return spark.read.parquet(_topic_path(spark, d, name, build))


def simple_topic(spark, d):
    return _topic(spark, d, "simple-topic", pl.simple_reading_topic)


@register("decode_json_payload", sql(f"""SELECT reading_id AS message_id, {_ISO} AS timestamp, city AS location,
  temperature_fahrenheit AS temperature, humidity_percent AS humidity, wind_speed_mph AS wind_speed,
  pressure_hpa AS pressure, precipitation_mm AS precipitation, CAST(NULL AS VARCHAR) AS forecast_text,
  CAST(NULL AS BOOLEAN) AS is_daytime FROM readings WHERE {_NOT_MALFORMED}""", "readings"))
def q_decode_json(spark, d):
    return pl.decode_json_payload(simple_topic(spark, d))


def _kept(col: str, default: str) -> str:
    """A key kept with its null (explicit-null message) or defaulted (missing key)."""
    return f"CASE WHEN reading_id % {pl.EXPLICIT_NULLS_EVERY} = 0 THEN {col} ELSE coalesce({col}, {default}) END"


cte("processed_c", ["readings"], f"""SELECT message_id, timestamp, location,
  greatest(-50.0, least(150.0, t)) AS temperature, greatest(0.0, least(100.0, h)) AS humidity,
  greatest(0.0, w) AS wind_speed, pressure, precipitation
FROM (SELECT reading_id AS message_id, {_ISO} AS timestamp, city AS location,
        {_kept('temperature_fahrenheit', '70.0')} AS t, {_kept('humidity_percent', '50.0')} AS h,
        {_kept('wind_speed_mph', '0.0')} AS w, {_kept('pressure_hpa', '1013.0')} AS pressure,
        {_kept('precipitation_mm', '0.0')} AS precipitation
      FROM readings WHERE {_NOT_MALFORMED}) x
WHERE t IS NOT NULL AND h IS NOT NULL AND w IS NOT NULL""")
cte("processed", ["processed_c"], f"""SELECT *, {wx.heat_index_sql(PROFILE_C, 'temperature', 'humidity')} AS heat_index,
  {wx.extreme_event_c_sql()} AS extreme_event FROM processed_c""")


@register("processor_clean", sql("SELECT * FROM processed", "processed"))
def q_processor(spark, d):
    return pl.processor_clean(simple_topic(spark, d))


@register("extreme_event_c", sql("SELECT message_id, temperature, wind_speed, extreme_event FROM processed",
                                 "processed"))
def q_extreme_c(spark, d):
    p = pl.processor_clean(simple_topic(spark, d))
    return p.select("message_id", "temperature", "wind_speed", "extreme_event")


@register("latest_processed", sql("""SELECT location, temperature, humidity, wind_speed, heat_index, extreme_event,
  timestamp FROM processed ORDER BY timestamp DESC, message_id DESC LIMIT 20""", "processed"))
def q_latest_processed(spark, d, limit: int = 20):
    p = pl.processor_clean(simple_topic(spark, d))
    return (p.orderBy(F.desc("timestamp"), F.desc("message_id")).limit(limit)
             .select("location", "temperature", "humidity", "wind_speed", "heat_index", "extreme_event",
                     "timestamp"))


_CAT_VALUES = ", ".join(f"('{c.replace(chr(39), chr(39) * 2)}', '{co}', '{ct}', '{rg}', CAST({la} AS DOUBLE), "
                        f"CAST({lo} AS DOUBLE))" for c, co, ct, rg, la, lo in city_catalogue_rows())


@register("normalize_current_weather", sql(f"""SELECT r.reading_id AS message_id, r.city,
  coalesce(c.country, r.country) AS country, coalesce(c.continent, r.continent) AS continent,
  coalesce(c.region, r.region) AS region, r.state, coalesce(c.lat, r.latitude) AS latitude,
  coalesce(c.lon, r.longitude) AS longitude, round(temperature_fahrenheit, 2) AS temperature_fahrenheit,
  round((temperature_fahrenheit - 32) * 5 / 9, 2) AS temperature_celsius, humidity_percent, pressure_hpa,
  round(wind_speed_mph, 2) AS wind_speed_mph, coalesce(wind_direction_degrees, 0.0) AS wind_direction_degrees,
  weather_condition, weather_description, cloud_cover_percent,
  round(CAST(CASE WHEN reading_id % {pl.VISIBILITY_MISSING_EVERY} <> 0
                  THEN CAST(floor(visibility_miles * {pl.METERS_PER_MILE}) AS BIGINT) ELSE 10000 END AS DOUBLE)
        / {pl.METERS_PER_MILE}, 2) AS visibility_miles,
  CASE WHEN precipitation_mm > 0 THEN precipitation_mm ELSE 0.0 END AS precipitation_mm,
  strftime(r.timestamp, '{pl.ISO_DUCK}') AS timestamp
FROM readings r LEFT JOIN (VALUES {_CAT_VALUES}) c(city, country, continent, region, lat, lon) ON r.city = c.city
WHERE temperature_fahrenheit IS NOT NULL AND humidity_percent IS NOT NULL AND pressure_hpa IS NOT NULL
  AND wind_speed_mph IS NOT NULL AND weather_condition IS NOT NULL AND weather_description IS NOT NULL
  AND cloud_cover_percent IS NOT NULL
  AND NOT (reading_id % {pl.CURRENT_NULLS_EVERY} = 0 AND (wind_direction_degrees IS NULL OR
           reading_id % {pl.VISIBILITY_MISSING_EVERY} = 0 OR NOT coalesce(precipitation_mm > 0, false)))""", "readings"))
def q_current(spark, d):
    return pl.normalize_current_weather(_topic(spark, d, "current-topic", pl.current_weather_topic))


@register("normalize_forecast_period", sql(f"""SELECT reading_id AS message_id, {_ISO} AS timestamp, city AS location,
  coalesce(temperature_fahrenheit, 70.0) AS temperature, coalesce(humidity_percent, 50.0) AS humidity,
  CASE WHEN reading_id % {pl.WIND_MISSING_EVERY} <> 0 THEN CAST(CAST(floor(wind_speed_mph) AS BIGINT) AS DOUBLE)
       ELSE 0.0 END AS wind_speed,
  CASE WHEN pressure_hpa * 100 > 100 THEN pressure_hpa * 100 / 100 ELSE pressure_hpa * 100 END AS pressure,
  CAST(0.0 AS DOUBLE) AS precipitation,
  CASE WHEN reading_id % {pl.FORECAST_NULLS_EVERY} = 0 THEN weather_description ELSE coalesce(weather_description, '') END
    AS forecast_text,
  hour(timestamp) >= 6 AND hour(timestamp) < 18 AS is_daytime FROM readings
WHERE reading_id % {pl.MALFORMED_EVERY} <> 0 AND reading_id % {pl.CALM_EVERY} <> 0
  AND NOT (reading_id % {pl.FORECAST_NULLS_EVERY} = 0 AND temperature_fahrenheit IS NULL)""", "readings"))
def q_forecast_period(spark, d):
    return pl.normalize_forecast_period(_topic(spark, d, "forecast-topic", pl.forecast_period_topic))


# --- layer IO ----------------------------------------------------------------------

@register("write_layer", sql("SELECT * FROM gold_a", "gold_a"))
def q_write_layer(spark, d):
    """Gold A written partitioned by reading_date, read back (load stamps excluded)."""
    path = layers.fresh_path(spark, "layers/gold")
    layers.write_layer(base.gold_a(spark, d), path)
    return layers.read_layer(spark, path)


@register("read_layer", sql("SELECT * FROM silver_a", "silver_a"))
def q_read_layer(spark, d):
    """Silver A written, then read with an explicit schema and the emptiness probe."""
    s = base.silver_a(spark, d)
    path = layers.fresh_path(spark, "layers/silver")
    layers.write_layer(s, path)
    back = layers.read_layer(spark, path, schema=s.schema)
    return back.select(*s.columns)


@register("warehouse_sink", sql("SELECT * FROM fact", "fact"))
def q_wh_sink(spark, d):
    """Truncate-and-load of the fact table (parquet here; JDBC with a URL), read back."""
    from aerolith.plans.q_warehouse import star
    path = layers.fresh_path(spark, "warehouse/fact")
    layers.warehouse_sink(star(spark, d)["fact_weather_readings"], path=path)
    return spark.read.parquet(path)


# --- streams --------------------------------------------------------------------------

_BRONZE_COLS = ", ".join(
    f"strftime({n}, '{pl.ISO_MICRO_DUCK}') AS {n}" if n in ("timestamp", "ingestion_timestamp") else n
    for n, _ in READING_FIELDS)


@register("bronze_stream", sql(f"SELECT {_BRONZE_COLS}, CAST(timestamp AS DATE) AS ingestion_date FROM readings",
                               "readings"))
def q_bronze_stream(spark, d):
    """Messages -> decode -> stamp -> parquet partitioned by ingestion_date (availableNow), read back."""
    landing = _topic_path(spark, d, "reading-topic", pl.reading_json_topic)
    out, ckpt = layers.fresh_path(spark, "bronze"), layers.fresh_path(spark, "checkpoints/bronze")
    q = jobs.start_bronze_stream(spark, jobs.file_source(spark, landing), out, ckpt,
                                 trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(out).drop("bronze_loaded_at")


@register("bronze_stream_sink", sql("""SELECT CAST(timestamp AS DATE) AS ingestion_date, count(*) AS n,
  count(DISTINCT city) AS cities, min(temperature_fahrenheit) AS coldest, max(temperature_fahrenheit) AS hottest,
  count(humidity_percent) AS humid_rows FROM readings GROUP BY ALL""", "readings"))
def q_bronze_sink(spark, d):
    """What the Bronze sink holds in each ingestion_date directory."""
    return q_bronze_stream(spark, d).groupBy("ingestion_date").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("city").alias("cities"),
        F.min("temperature_fahrenheit").alias("coldest"), F.max("temperature_fahrenheit").alias("hottest"),
        F.count("humidity_percent").alias("humid_rows"))


def _processor_run(spark, d):
    out, ckpt = layers.fresh_path(spark, "processor"), layers.fresh_path(spark, "checkpoints/processor")
    jobs.start_processor_stream(spark, jobs.file_source(spark, simple_topic_path(spark, d)), out, ckpt,
                                trigger={"availableNow": True}).awaitTermination()
    return jobs.raw_table(spark, out), jobs.processed_table(spark, out)


@register("processor_stream", sql("SELECT * FROM processed", "processed"))
def q_processor_stream(spark, d):
    _, proc = _processor_run(spark, d)
    return proc.drop("processed_at")


@register("raw_and_processed_sink", sql(f"""SELECT r.reading_id AS message_id, strftime(r.timestamp, '{pl.ISO_DUCK}') AS timestamp, r.city AS location,
  r.temperature_fahrenheit AS raw_temperature, r.humidity_percent AS raw_humidity, p.temperature, p.humidity,
  p.heat_index, p.extreme_event
FROM (SELECT * FROM readings WHERE {_NOT_MALFORMED}) r LEFT JOIN processed p ON p.message_id = r.reading_id""", "processed"))
def q_raw_processed(spark, d):
    """Rows of both tables side by side: every raw message, with its processed row where there is one."""
    raw, proc = _processor_run(spark, d)
    p = proc.select(F.col("message_id"), "temperature", "humidity", "heat_index", "extreme_event")
    return (raw.select("message_id", "timestamp", "location", F.col("temperature").alias("raw_temperature"),
                       F.col("humidity").alias("raw_humidity")).join(p, "message_id", "left"))


def sink_counts(raw, proc):
    """Rows of each sink and processed rows whose message also reached the raw table."""
    r = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    # the marker comes from the raw side: a USING join's key column is never null for left rows
    in_raw = raw.select("message_id", F.lit(1).alias("_in_raw"))
    p = proc.join(in_raw, "message_id", "left").agg(
        F.count(F.lit(1)).alias("processed_rows"),
        F.count("_in_raw").alias("processed_with_raw"))
    return r.withColumn("_k", F.lit(1)).join(p.withColumn("_k", F.lit(1)), "_k").drop("_k")

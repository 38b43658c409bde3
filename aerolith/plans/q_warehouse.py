"""Registered queries: star schema, joins, upserts, checks and star SQL questions (2.3, 2.4)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from aerolith.constants import DQ_CHECKS, SOURCE_TAG
from aerolith.functions.numeric import exact_avg_round_sql, exact_ratio_round
from aerolith.operators import summaries
from aerolith.operators import warehouse as wh
from aerolith.plans import base
from aerolith.plans.oracle import UNKNOWN_KEY, dim_location_sql, sql
from aerolith.plans.registry import register
from aerolith.sources.layers import fresh_path
from aerolith.sources.tables import memo


def star(spark, d):
    """A fresh star schema: Gold materialised once, dimensions materialised, fact joined."""
    return wh.star(base.gold_a(spark, d))


def star_views(spark, d) -> dict:
    """The loaded warehouse as temp views, for the serving questions.

    The warehouse is loaded once per application (as the pipeline loads it once
    and the questions then run against it): the fact by date, and its summary rows per
    date and location, which the checks and totals read instead of the fact.
    """
    def load():
        s = wh.star(base.gold_a(spark, d))
        root = fresh_path(spark, "warehouse/star")
        summaries.load_dates(spark, s[summaries.FACT], root)
        s[summaries.FACT] = spark.read.parquet(os.path.join(root, summaries.FACT))
        s[summaries.SUMMARY] = summaries.read_summary(spark, root)
        return s
    s = memo(spark, "warehouse", d)(load)
    for name, df in s.items():
        df.createOrReplaceTempView(name)
    return s


@register("dim_location", sql("SELECT * FROM dim_location", "dim_location"))
def q_dim_location(spark, d):
    return wh.dim_location(base.gold_a(spark, d))


@register("dim_time", sql("SELECT * FROM dim_time", "dim_time"))
def q_dim_time(spark, d):
    """Hourly calendar spanning the readings (the reference fixes 2025-2026; the range is a parameter)."""
    g = base.gold_a(spark, d)
    from aerolith.functions.calendar import hour_floor
    h = hour_floor(F.col("timestamp").cast("timestamp_ntz"))
    return wh.dim_time(spark, F.min(h), F.max(h), source=g)


@register("insert_missing_weather_type", sql("SELECT * FROM dim_weather_type", "dim_weather_type"))
def q_weather_types(spark, d):
    return wh.dim_weather_type(base.gold_a(spark, d))


@register("upsert_dim_location", sql(f"""SELECT coalesce(e.location_key, {wh.md5_key_sql('coalesce(e.city, i.city)', 'coalesce(e.country, i.country)')}) AS location_key,
  coalesce(e.city, i.city) AS city, coalesce(e.country, i.country) AS country,
  CASE WHEN i.city IS NOT NULL THEN i.continent ELSE e.continent END AS continent,
  CASE WHEN i.city IS NOT NULL THEN i.state ELSE e.state END AS state,
  CASE WHEN i.city IS NOT NULL THEN i.latitude ELSE e.latitude END AS latitude,
  CASE WHEN i.city IS NOT NULL THEN i.longitude ELSE e.longitude END AS longitude,
  CASE WHEN i.city IS NOT NULL THEN i.region ELSE e.region END AS region
FROM ({dim_location_sql('gold_b')}) e FULL OUTER JOIN dim_location i ON e.city = i.city AND e.country = i.country""",
                                    "dim_location", "gold_b"))
def q_upsert(spark, d):
    """Existing dimension loaded from the B pipeline, upserted with the A pipeline's locations."""
    existing = wh.dim_location(base.gold_b(spark, d))
    incoming = wh.dim_location(base.gold_a(spark, d))
    return wh.upsert_dim_location(existing, incoming)


@register("join_location", sql("""SELECT reading_key AS reading_id, f.location_key FROM fact f
JOIN dim_location l ON f.location_key = l.location_key WHERE l.city <> 'Miami'""", "fact", "dim_location"))
def q_join_location(spark, d):
    """Against a dimension that lacks one city: its readings are dropped."""
    g = base.gold_a(spark, d)
    loc = wh.materialize(wh.dim_location(g).filter("city <> 'Miami'"), "dim_location")
    return wh.join_location(g, loc).select("reading_id", "location_key")


@register("join_time", sql("""SELECT reading_id, CASE WHEN date_trunc('hour', timestamp) <= (
    SELECT date_trunc('hour', max(timestamp)) - INTERVAL 1 DAY FROM gold_a) THEN t.time_key END AS time_key
FROM gold_a LEFT JOIN dim_time t ON date_trunc('hour', timestamp) = t.full_timestamp""", "gold_a", "dim_time"))
def q_join_time(spark, d):
    """A calendar that ends a day before the data does: later readings keep a null key."""
    from aerolith.functions.calendar import hour_floor
    g = base.gold_a(spark, d)
    h = hour_floor(F.col("timestamp").cast("timestamp_ntz"))
    dim = wh.dim_time(spark, F.min(h), F.max(h) - F.expr("INTERVAL 1 DAY"), source=g)
    return wh.join_time(g, dim).select("reading_id", "time_key")


@register("join_weather_type", sql(f"""SELECT g.reading_id,
  CASE WHEN g.weather_condition IS NULL THEN CAST({UNKNOWN_KEY} AS BIGINT)
       WHEN trim(g.weather_condition) = '' THEN NULL
       ELSE coalesce(w.weather_type_key, CAST({UNKNOWN_KEY} AS BIGINT)) END AS weather_type_key
FROM gold_b g LEFT JOIN dim_weather_type w ON trim(g.weather_condition) = w.condition""",
                                   "gold_b", "dim_weather_type"))
def q_join_wt(spark, d):
    """On Gold B, whose conditions keep their nulls (they become the 'Unknown' key)."""
    wt = wh.materialize(wh.dim_weather_type(base.gold_a(spark, d)), "dim_weather_type")
    return wh.join_weather_type(base.gold_b(spark, d), wt).select("reading_id", "weather_type_key")


@register("build_fact", sql("SELECT * FROM fact", "fact"))
def q_fact(spark, d):
    return star(spark, d)["fact_weather_readings"]


_STAR_SQL = """SELECT f.reading_key, l.city, l.country, l.continent, t.month_name, t.day_name, t.hour, t.season,
  t.is_weekend, w.condition, w.category, w.severity, f.temperature_fahrenheit, f.is_extreme_weather
FROM {fact} f JOIN {loc} l ON f.location_key = l.location_key
LEFT JOIN {tim} t ON f.time_key = t.time_key
LEFT JOIN {wt} w ON f.weather_type_key = w.weather_type_key"""


@register("star_join", sql(_STAR_SQL.format(fact="fact", loc="dim_location", tim="dim_time", wt="dim_weather_type"),
                           "fact"))
def q_star_join(spark, d):
    star_views(spark, d)
    return spark.sql(_STAR_SQL.format(fact="fact_weather_readings", loc="dim_location", tim="dim_time",
                                      wt="dim_weather_type"))


_DQ_VALUES = [  # SQL scalars over the star, in the order of DQ_CHECKS
    "SELECT count(*) FROM {fact}", "SELECT count(DISTINCT city) FROM {loc}", "SELECT count(DISTINCT country) FROM {loc}",
    "SELECT count(*) FROM {fact} WHERE is_extreme_weather = 1", "SELECT count(*) FROM {fact} WHERE temperature_fahrenheit IS NULL",
    "SELECT count(*) FROM {fact} WHERE temperature_fahrenheit < -80 OR temperature_fahrenheit > 140",
    "SELECT count(*) FROM {fact} WHERE time_key IS NULL", "SELECT count(*) FROM {fact} WHERE location_key IS NULL",
    "SELECT count(*) FROM {fact} WHERE source = '" + SOURCE_TAG + "'",
]
_DQ = [(name, q, lo, hi) for (name, lo, hi), q in zip(DQ_CHECKS, _DQ_VALUES)]


def _dq_sql(fact: str, loc: str) -> str:
    parts = []
    for name, q, lo, hi in _DQ:
        cond = " AND ".join(([f"v >= {lo}"] if lo is not None else []) + ([f"v <= {hi}"] if hi is not None else []))
        parts.append(f"SELECT '{name}' AS check_name, v AS value, CASE WHEN {cond} THEN 'PASS' ELSE 'FAIL' END "
                     f"AS status FROM ({q.format(fact=fact, loc=loc)}) c(v)")
    return "\nUNION ALL\n".join(parts)


@register("dq_checks", sql(_dq_sql("fact", "dim_location"), "fact"))
def q_dq(spark, d):
    """Nine named checks; ``dq_gate`` raises when any FAILs (the job-failure semantics)."""
    s = star_views(spark, d)
    return dq_checks(s[summaries.SUMMARY], s["dim_location"])


def dq_checks(summary, loc):
    """(check_name, value, status) of the nine checks: a merge of the summary rows and one scan of the location dimension."""
    spark = summary.sparkSession
    f = summaries.totals(summary).select(
        F.col("total").alias("Total fact records"), F.col("extreme").alias("Extreme weather count"),
        F.col("null_temperature").alias("Null temperatures"), F.col("out_of_range").alias("Temperature range check"),
        (F.col("total") - F.col("with_time")).alias("Null time_key (should be low)"),
        F.col("null_location").alias("Null location_key"), F.col("tagged").alias("Records with source tag"))
    l = loc.agg(F.countDistinct("city").alias("Unique cities"), F.countDistinct("country").alias("Unique countries"))
    melt = lambda df: df.unpivot([], df.columns, "check_name", "value")
    rows = melt(f).unionByName(melt(l))
    bounds = spark.createDataFrame([(n, lo, hi) for n, _, lo, hi in _DQ], "check_name string, lo long, hi long")
    return (rows.join(F.broadcast(bounds), "check_name")
                .select("check_name", "value",
                        F.when((F.col("lo").isNull() | (F.col("value") >= F.col("lo")))
                               & (F.col("hi").isNull() | (F.col("value") <= F.col("hi"))), "PASS")
                         .otherwise("FAIL").alias("status")))


def dq_gate(checks_df) -> None:
    """Raise if any check failed (pulls at most 9 rows)."""
    failed = [r["check_name"] for r in checks_df.filter(F.col("status") == "FAIL").collect()]
    if failed:
        raise RuntimeError(f"Data quality checks failed: {failed}")


@register("warehouse_summary", sql("""SELECT (SELECT count(*) FROM fact) AS total_records,
  (SELECT count(*) FROM fact WHERE time_key IS NOT NULL) AS with_time_key,
  (SELECT count(*) FROM fact WHERE is_extreme_weather = 1) AS extreme_events,
  (SELECT count(DISTINCT city) FROM dim_location) AS cities,
  (SELECT count(DISTINCT continent) FROM dim_location) AS continents""", "fact"))
def q_wh_summary(spark, d):
    s = star_views(spark, d)
    f = summaries.totals(s[summaries.SUMMARY]).select(F.col("total").alias("total_records"), F.col("with_time").alias("with_time_key"),
                                                      F.col("extreme").alias("extreme_events"))
    l = s["dim_location"].agg(F.countDistinct("city").alias("cities"),
                              F.countDistinct("continent").alias("continents"))
    # both sides are single-row aggregates; a keyed join on a constant keeps this a plain equi-join
    return f.withColumn("_k", F.lit(1)).join(l.withColumn("_k", F.lit(1)), "_k").drop("_k")


# --- the six demo questions: SQL over the star views, answered here from the summary rows ----------------
_AVG_T = exact_avg_round_sql("f.temperature_fahrenheit", 2)
_AVG_W = exact_avg_round_sql("f.wind_speed_mph", 2)
STAR_QUESTIONS = {
    "q_avg_temp_by_city": f"""SELECT l.city, {_AVG_T} AS avg_temp
FROM {{fact}} f JOIN {{loc}} l ON f.location_key = l.location_key GROUP BY l.city
ORDER BY avg_temp DESC, l.city LIMIT 20""",
    "q_extreme_cities": """SELECT DISTINCT l.city FROM {fact} f JOIN {loc} l ON f.location_key = l.location_key
WHERE f.is_extreme_weather = 1""",
    "q_hottest_city": """SELECT l.city, f.temperature_fahrenheit AS max_temp
FROM {fact} f JOIN {loc} l ON f.location_key = l.location_key
ORDER BY f.temperature_fahrenheit DESC, l.city, f.reading_key LIMIT 1""",
    "q_total_readings": "SELECT count(*) AS total_readings FROM {fact}",
    "q_humid_cities": """SELECT l.city, round(max(f.humidity_percent), 1) AS max_humidity, count(*) AS readings_above_80
FROM {fact} f JOIN {loc} l ON f.location_key = l.location_key WHERE f.humidity_percent > 80 GROUP BY l.city""",
    "q_avg_wind_by_region": f"""SELECT l.region, {_AVG_W} AS avg_wind
FROM {{fact}} f JOIN {{loc}} l ON f.location_key = l.location_key GROUP BY l.region""",
}


def _located(spark, d):
    """The summary per location with the location's attributes."""
    s = star_views(spark, d)
    return summaries.by_location(s[summaries.SUMMARY]).join(s["dim_location"], "location_key")


def _mean(kind: str, digits: int = 2):
    return exact_ratio_round(F.sum(f"sum_{kind}"), F.sum(f"n_{kind}"), digits)


STAR_ANSWERS = {
    "q_avg_temp_by_city": lambda spark, d: _located(spark, d).groupBy("city").agg(_mean("temperature").alias("avg_temp"))
        .orderBy(F.desc("avg_temp"), "city").limit(20),
    "q_extreme_cities": lambda spark, d: _located(spark, d).filter("extreme > 0").select("city").distinct(),
    "q_hottest_city": lambda spark, d: _located(spark, d).orderBy(F.desc("max_temperature"), "city", "hottest_key")
        .select("city", F.col("max_temperature").alias("max_temp")).limit(1),
    "q_total_readings": lambda spark, d: summaries.totals(star_views(spark, d)[summaries.SUMMARY]).select(F.col("total").alias("total_readings")),
    "q_humid_cities": lambda spark, d: _located(spark, d).filter("humid > 0").groupBy("city").agg(
        F.round(F.max("max_humidity"), 1).alias("max_humidity"), F.sum("humid").alias("readings_above_80")),
    "q_avg_wind_by_region": lambda spark, d: _located(spark, d).groupBy("region").agg(_mean("wind").alias("avg_wind")),
}

for _name, _text in STAR_QUESTIONS.items():
    register(_name, sql(_text.format(fact="fact", loc="dim_location"), "fact"))(STAR_ANSWERS[_name])

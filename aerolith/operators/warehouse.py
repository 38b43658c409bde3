"""Star schema (2.3): dimensions, surrogate keys, fact assembly, upserts, checks.

Surrogate keys are deterministic functions of the natural key (an md5 prefix, or
the hour stamp for time), never a global ``row_number``: assigning them needs no
single-partition sort and gives the same key on every rerun.
Dimensions are materialised as tables before the fact is joined to them (as a
warehouse loads dimensions first); the planner then sees their real size and
broadcasts them when small, falling back to a shuffle join otherwise.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.constants import CONDITION_CATEGORY, QUALITY_FALLBACK, SOURCE_TAG, WEATHER_TYPES_DDL
from aerolith.functions import calendar as cal
from aerolith.functions.numeric import safe_double, safe_int
from aerolith.session import scratch_path


def md5_key(*cols) -> Column:
    """60-bit key from the md5 of the natural key (same value in SQL: see ``md5_key_sql``)."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 15), 16, 10).cast("bigint")


def md5_key_sql(*cols: str) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(cols)})), 1, 15)) AS BIGINT)"


def hour_key(ts) -> Column:
    """yyyyMMddHH as a number: a readable, order-preserving key of an hour."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return (F.year(t) * 1000000 + F.month(t) * 10000 + F.dayofmonth(t) * 100 + F.hour(t)).cast("bigint")


def hour_key_sql(ts: str) -> str:
    return (f"CAST(year({ts}) * 1000000 + month({ts}) * 10000 + day({ts}) * 100 + hour({ts}) AS BIGINT)")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back (cuts lineage)."""
    path = scratch_path(df.sparkSession, f"warehouse/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


# --- dimensions --------------------------------------------------------------

LOCATION_ATTRS = ["continent", "state", "latitude", "longitude", "region"]


def dim_location(gold: DataFrame) -> DataFrame:
    """Unique (city, country) with attributes of its latest reading."""
    attrs = [c for c in LOCATION_ATTRS if c in gold.columns]
    ts = "timestamp" if "timestamp" in gold.columns else "reading_timestamp"
    agg = (gold.groupBy("city", "country")
               .agg(F.max_by(F.struct(*attrs), F.struct(ts, "reading_id")).alias("_a"))
               .select("city", "country", "_a.*"))
    return agg.select(md5_key("city", "country").alias("location_key"), "city", "country", *attrs)


def dim_time(spark: SparkSession, start: Column | str, end: Column | str,
             source: DataFrame | None = None) -> DataFrame:
    """Hourly calendar from ``start`` to ``end`` inclusive.

    With ``source`` given, ``start``/``end`` are aggregate expressions over it
    (the calendar then spans the data); otherwise they are timestamp literals.
    """
    if source is None:
        bounds = spark.range(1).select(F.to_timestamp_ntz(F.lit(start)).alias("s"),
                                       F.to_timestamp_ntz(F.lit(end)).alias("e"))
    else:
        bounds = source.agg(start.alias("s"), end.alias("e"))
    hours = bounds.select(F.explode(F.sequence("s", "e", F.expr("INTERVAL 1 HOUR"))).alias("full_timestamp"))
    t = F.col("full_timestamp")
    return hours.select(
        hour_key(t).alias("time_key"), t.alias("full_timestamp"), F.to_date(t).alias("date"),
        F.year(t).alias("year"), F.quarter(t).alias("quarter"), F.month(t).alias("month"),
        F.date_format(t, "MMMM").alias("month_name"), F.weekofyear(t).alias("week_of_year"),
        F.dayofmonth(t).alias("day_of_month"), (F.dayofweek(t) - 1).alias("day_of_week"),
        F.date_format(t, "EEEE").alias("day_name"), F.hour(t).alias("hour"),
        F.dayofweek(t).isin(1, 7).alias("is_weekend"), cal.season(F.month(t)).alias("season"))


def dim_time_sql(src_bounds: str) -> str:
    """``src_bounds`` yields one row (s, e)."""
    return f"""SELECT {hour_key_sql('ts')} AS time_key, ts AS full_timestamp, CAST(ts AS DATE) AS date,
  CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter, CAST(month(ts) AS INTEGER) AS month,
  monthname(ts) AS month_name, CAST(weekofyear(ts) AS INTEGER) AS week_of_year,
  CAST(day(ts) AS INTEGER) AS day_of_month, CAST(dayofweek(ts) AS INTEGER) AS day_of_week,
  dayname(ts) AS day_name, CAST(hour(ts) AS INTEGER) AS hour, dayofweek(ts) IN (0, 6) AS is_weekend,
  {cal.season_sql('month(ts)')} AS season
FROM (SELECT unnest(generate_series(s, e, INTERVAL 1 HOUR)) AS ts FROM ({src_bounds}) b) x"""


def seeded_weather_types(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, c, cat, sev, desc) for i, (c, cat, sev, desc) in enumerate(WEATHER_TYPES_DDL)]
    return spark.createDataFrame(
        rows, "weather_type_key long, condition string, category string, severity string, description string")


def category_of(cond: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in CONDITION_CATEGORY.items() for x in kv])
    return F.coalesce(m[cond], F.lit("Other"))


def insert_missing_weather_type(existing: DataFrame, gold: DataFrame) -> DataFrame:
    """Add trimmed, non-empty conditions not yet present (category by map, severity Normal)."""
    seen = (gold.select(F.trim("weather_condition").alias("condition"))
                .filter(F.col("condition").isNotNull() & (F.col("condition") != ""))
                .distinct())
    new = (seen.join(existing.select("condition"), "condition", "left_anti")
               .select(md5_key("condition").alias("weather_type_key"), "condition",
                       category_of(F.col("condition")).alias("category"), F.lit("Normal").alias("severity"),
                       F.concat(F.col("condition"), F.lit(" conditions")).alias("description")))
    return existing.unionByName(new)


def dim_weather_type(gold: DataFrame) -> DataFrame:
    return insert_missing_weather_type(seeded_weather_types(gold.sparkSession), gold)


def upsert_dim_location(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """ON CONFLICT (city, country) update attributes, keep the existing key.

    A full outer join on the natural key, in which a missing country equals a missing country (else such a
    location would be added again by every load); attributes come from the incoming row
    when present. New locations get the deterministic natural-key hash.
    """
    attrs = [c for c in LOCATION_ATTRS if c in incoming.columns]
    e = existing.withColumn("_old", F.lit(True)).alias("e")
    i = incoming.select("city", "country", *attrs).withColumn("_new", F.lit(True)).alias("i")
    j = e.join(i, F.col("e.city").eqNullSafe(F.col("i.city")) & F.col("e.country").eqNullSafe(F.col("i.country")), "full_outer")
    pick = lambda c: F.when(F.col("i._new"), F.col(f"i.{c}")).otherwise(F.col(f"e.{c}"))
    city, country = pick("city"), pick("country")
    return j.select(F.coalesce(F.col("e.location_key"), md5_key(city, country)).alias("location_key"),
                    city.alias("city"), country.alias("country"), *[pick(a).alias(a) for a in attrs])


# --- fact ------------------------------------------------------------------

def join_location(fact: DataFrame, dim_loc: DataFrame) -> DataFrame:
    """(city, country) key, else the city-only key (highest key per city); unmatched dropped."""
    by_pair = dim_loc.select("city", "country", F.col("location_key").alias("_k1"))
    by_city = dim_loc.groupBy("city").agg(F.max("location_key").alias("_k2"))
    return (fact.join(by_pair, ["city", "country"], "left")
                .join(by_city, "city", "left")
                .withColumn("location_key", F.coalesce("_k1", "_k2"))
                .drop("_k1", "_k2")
                .filter(F.col("location_key").isNotNull()))


def join_time(fact: DataFrame, dim_t: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Floor to the hour and match the calendar; out of range -> null key, row kept."""
    hours = dim_t.select(F.col("full_timestamp").alias("_hour"), "time_key")
    return (fact.withColumn("_hour", cal.hour_floor(F.col(ts).try_cast("timestamp_ntz")))
                .join(hours, "_hour", "left").drop("_hour"))


def join_weather_type(fact: DataFrame, dim_wt: DataFrame, cond: str = "weather_condition") -> DataFrame:
    """trim(condition) -> key; unknown text -> 'Unknown' key; '' -> null; null -> 'Unknown' key."""
    keys = dim_wt.select(F.col("condition").alias("_cond"), F.col("weather_type_key").alias("_wk"))
    c = F.trim(F.col(cond))
    # 'Unknown' is a seeded condition, so its key is fixed by the seed order
    unknown_key = [i + 1 for i, r in enumerate(WEATHER_TYPES_DDL) if r[0] == "Unknown"][0]
    joined = fact.withColumn("_cond", c).join(keys, "_cond", "left")
    key = (F.when(F.col(cond).isNull(), F.lit(unknown_key).cast("long"))
            .when(F.col("_cond") == "", F.lit(None).cast("long"))
            .otherwise(F.coalesce(F.col("_wk"), F.lit(unknown_key).cast("long"))))
    return joined.withColumn("weather_type_key", key).drop("_cond", "_wk")


FACT_MEASURES = [
    ("temperature_fahrenheit", "double"), ("temperature_celsius", "double"), ("humidity_percent", "double"),
    ("pressure_hpa", "double"), ("wind_speed_mph", "double"), ("wind_direction_degrees", "int"),
    ("precipitation_mm", "double"), ("visibility_km", "double"), ("cloud_cover_percent", "int"),
    ("uv_index", "double"), ("heat_index", "double"), ("wind_chill", "double"),
    ("temp_anomaly", "double"), ("temp_anomaly_score", "double"), ("is_extreme_weather", "int"),
    ("is_heatwave", "int"), ("is_extreme_cold", "int"), ("is_high_wind", "int"),
    ("is_heavy_precipitation", "int"),
]


def fact_columns(df: DataFrame) -> list[Column]:
    cols = set(df.columns)

    def val(name, typ):
        src = "temperature_anomaly" if name == "temp_anomaly" else name
        if name == "uv_index":  # the producer never sends it
            return F.lit(None).cast(typ)
        if src not in cols:
            return F.lit(0) if name.startswith("is_") else F.lit(None).cast(typ)
        return safe_int(F.col(src)) if typ == "int" else safe_double(F.col(src))

    out = []
    for name, typ in FACT_MEASURES:
        if name == "visibility_km":
            km = safe_double(F.col("visibility_km")) if "visibility_km" in cols else F.lit(None).cast("double")
            miles = safe_double(F.col("visibility_miles")) if "visibility_miles" in cols else F.lit(None).cast("double")
            out.append(F.when(km.isNull() | (km == 0), F.round(miles * 1.60934, 2)).otherwise(km).alias(name))
        else:
            out.append(val(name, typ).alias(name))
    q = [F.col(c) for c in ("quality_flag", "data_quality_flag") if c in cols]
    out.append(F.lit(SOURCE_TAG).alias("source"))
    out.append(F.coalesce(*q, F.lit(QUALITY_FALLBACK)).alias("quality_flag"))
    return out


def build_fact(gold: DataFrame, dim_loc: DataFrame, dim_t: DataFrame, dim_wt: DataFrame) -> DataFrame:
    ts = "timestamp" if "timestamp" in gold.columns else "reading_timestamp"
    f = join_location(gold, dim_loc)
    f = join_time(f, dim_t, ts)
    f = join_weather_type(f, dim_wt)
    return f.select(F.col("reading_id").alias("reading_key"), "location_key", "time_key",
                    "weather_type_key", *fact_columns(f))


def star(gold: DataFrame, persist: bool = True) -> dict[str, DataFrame]:
    """Dimensions (materialised) and the fact, spanning the data's hours."""
    spark = gold.sparkSession
    if persist:
        # the warehouse loads from the written Gold layer: compute Gold once, not once per dimension
        gold = materialize(gold, "gold")
    ts = "timestamp" if "timestamp" in gold.columns else "reading_timestamp"
    loc = dim_location(gold)
    h = cal.hour_floor(F.col(ts).try_cast("timestamp_ntz"))
    tim = dim_time(spark, F.min(h), F.max(h), source=gold)
    wt = dim_weather_type(gold)
    if persist:
        loc, tim, wt = materialize(loc, "dim_location"), materialize(tim, "dim_time"), \
            materialize(wt, "dim_weather_type")
    fact = build_fact(gold, loc, tim, wt)
    return {"dim_location": loc, "dim_time": tim, "dim_weather_type": wt, "fact_weather_readings": fact}

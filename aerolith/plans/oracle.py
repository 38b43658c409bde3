"""SQL twins of the composed plans, as named CTEs for the DuckDB oracle.

``sql(body, "gold_a")`` prefixes ``body`` with ``WITH`` and every CTE it needs,
in dependency order. Each CTE mirrors one Spark plan in ``aerolith.plans``.
"""

from __future__ import annotations

from aerolith.constants import SILVER_A_FILL
from aerolith.functions import calendar as cal
from aerolith.functions import weather as wx
from aerolith.operators import clean, features
from aerolith.profiles import PROFILE_A, PROFILE_B
from aerolith.sources.tables import READING_COLUMNS, readings_sql

READING_NAMES = [n for n, _ in READING_COLUMNS] + ["ingestion_timestamp"]
NUMERIC_READING = ["reading_id", "latitude", "longitude", "temperature_fahrenheit",
                   "temperature_celsius", "humidity_percent", "pressure_hpa", "wind_speed_mph",
                   "wind_direction_degrees", "cloud_cover_percent", "visibility_miles",
                   "precipitation_mm"]

_CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    _CTES[name] = (deps, body)


def _order(names) -> list[str]:
    seen, out = set(), []

    def visit(n):
        if n in seen:
            return
        seen.add(n)
        for d in _CTES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def positive_zero_rounding(text: str) -> str:
    """Rewrite every ``round(a, n)`` as ``(round(a, n) + 0.0)``.

    Spark rounds through BigDecimal and never yields -0.0; DuckDB's double round
    does (round(-0.04, 1)). Adding 0.0 maps -0.0 to 0.0 and leaves all else alone.
    """
    out, i, key = [], 0, "round("
    while True:
        j = text.find(key, i)
        if j < 0 or (j > 0 and (text[j - 1].isalnum() or text[j - 1] == "_")):
            if j < 0:
                out.append(text[i:])
                return "".join(out)
            out.append(text[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(text[k], 0)
            k += 1
        inner = positive_zero_rounding(text[j + len(key):k - 1])
        out.append(text[i:j] + f"(round({inner}) + 0.0)")
        i = k


def sql(body: str, *needs: str) -> str:
    names = _order(needs)
    if names:
        parts = ",\n".join(f"{n} AS (\n{_CTES[n][1]}\n)" for n in names)
        body = f"WITH {parts}\n{body}"
    return positive_zero_rounding(body)


# --- readings and the Silver layers -----------------------------------------
cte("readings", [], readings_sql())
cte("readings_dedup", ["readings"], clean.dedup_readings_sql("readings"))

_silver_a_cols = []
for c in READING_NAMES:
    if c in SILVER_A_FILL:
        v = SILVER_A_FILL[c]
        _silver_a_cols.append(f"coalesce({c}, {repr(v) if isinstance(v, str) else f'CAST({v} AS DOUBLE)'}) AS {c}")
    elif c == "temperature_celsius":
        _silver_a_cols.append(f"{clean.CELSIUS_BACKFILL_A_SQL} AS temperature_celsius")
    else:
        _silver_a_cols.append(c)
cte("silver_a", ["readings_dedup"], f"""SELECT {', '.join(_silver_a_cols)}, quality_flag,
  {clean.READING_DATE_PARTS_SQL}
FROM (SELECT *, {clean.range_quality_flag_sql()} AS quality_flag FROM readings_dedup) x
WHERE {clean.drop_null_critical_sql('A')}""")

cte("silver_b", ["readings_dedup"], f"""SELECT * REPLACE ({clean.CLAMP_HUMIDITY_B_SQL} AS humidity_percent),
  'PASSED' AS data_quality_flag, CAST(timestamp AS DATE) AS reading_date
FROM readings_dedup WHERE {clean.drop_null_critical_sql('B')} AND {clean.RANGE_FILTER_B_SQL}""")

# --- Gold A -----------------------------------------------------------------
_flags_a = ", ".join(f"{v} AS {k}" for k, v in wx.extreme_flags_a_sql().items())
_time_a = ", ".join(f"{v} AS {k}" for k, v in cal.time_features_a_sql().items())
cte("gold_a_base", ["silver_a"], f"""SELECT *, {wx.heat_index_sql(PROFILE_A)} AS heat_index,
  {wx.wind_chill_sql(PROFILE_A)} AS wind_chill FROM silver_a WHERE quality_flag = 'VALID'""")
cte("gold_a_feat", ["gold_a_base"], f"SELECT *, {_flags_a}, {_time_a} FROM gold_a_base")
cte("city_stats_a", ["gold_a_base"], features.city_statistics_sql(PROFILE_A, "gold_a_base"))
_anom_a, _score_a = features.anomaly_sql(PROFILE_A)
cte("gold_a", ["gold_a_feat", "city_stats_a"], f"""SELECT f.*, s.city_avg_temp, s.city_min_temp,
  s.city_max_temp, s.city_stddev_temp, s.city_avg_humidity,
  {_anom_a} AS temperature_anomaly, {_score_a} AS temp_anomaly_score
FROM gold_a_feat f LEFT JOIN city_stats_a s ON f.city = s.city""")

# --- Gold B -----------------------------------------------------------------
_time_b = ", ".join(f"{v} AS {k}" for k, v in cal.time_features_b_sql().items())
_flags_b = ", ".join(f"{v} AS {k}" for k, v in wx.extreme_flags_b_sql().items())
cte("gold_b_base", ["silver_b"], f"""SELECT *, {wx.heat_index_sql(PROFILE_B)} AS heat_index,
  {wx.wind_chill_sql(PROFILE_B)} AS wind_chill FROM silver_b""")
cte("city_stats_b", ["gold_b_base"], features.city_statistics_sql(PROFILE_B, "gold_b_base", False))
_anom_b, _score_b = features.anomaly_sql(PROFILE_B)
cte("gold_b_pre", ["gold_b_base", "city_stats_b"], f"""SELECT f.*, s.city_avg_temp, s.city_min_temp,
  s.city_max_temp, s.city_stddev_temp, {_anom_b} AS temperature_anomaly,
  {_score_b} AS temp_anomaly_score, {_time_b},
  round(visibility_miles * 1.60934, 2) AS visibility_km
FROM gold_b_base f LEFT JOIN city_stats_b s ON f.city = s.city""")
GOLD_B_NUMERIC = NUMERIC_READING + [
    "heat_index", "wind_chill", "city_avg_temp", "city_min_temp", "city_max_temp",
    "city_stddev_temp", "temperature_anomaly", "temp_anomaly_score", "hour_of_day", "day_of_week",
    "month", "is_daytime", "visibility_km"]
_fill_b = ", ".join(f"coalesce({c}, 0) AS {c}" for c in GOLD_B_NUMERIC)
cte("gold_b", ["gold_b_pre"], f"""SELECT * REPLACE ({_fill_b}), {_flags_b} FROM gold_b_pre""")

# --- serving views ------------------------------------------------------------
cte("latest_a", ["gold_a"], """SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY city ORDER BY timestamp DESC, reading_id DESC) AS _rn FROM gold_a) x WHERE _rn = 1""")

# --- star schema ------------------------------------------------------------
from aerolith.constants import CONDITION_CATEGORY, QUALITY_FALLBACK, SOURCE_TAG, WEATHER_TYPES_DDL  # noqa: E402
from aerolith.operators import warehouse as wh  # noqa: E402


def dim_location_sql(src: str) -> str:
    return f"""SELECT {wh.md5_key_sql('city', 'country')} AS location_key, city, country, continent, state,
  latitude, longitude, region FROM (SELECT *, row_number() OVER (PARTITION BY city, country
  ORDER BY timestamp DESC, reading_id DESC) AS _rn FROM {src}) x WHERE _rn = 1"""


_SEED_VALUES = ", ".join(f"(CAST({i + 1} AS BIGINT), '{c}', '{cat}', '{sev}', '{desc}')"
                         for i, (c, cat, sev, desc) in enumerate(WEATHER_TYPES_DDL))
_CATEGORY_CASE = "CASE condition " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in CONDITION_CATEGORY.items()) + " ELSE 'Other' END"
UNKNOWN_KEY = [i + 1 for i, r in enumerate(WEATHER_TYPES_DDL) if r[0] == "Unknown"][0]


def dim_weather_type_sql(src: str) -> str:
    return f"""SELECT * FROM (VALUES {_SEED_VALUES}) s(weather_type_key, condition, category, severity, description)
UNION ALL
SELECT {wh.md5_key_sql('condition')} AS weather_type_key, condition, {_CATEGORY_CASE} AS category,
  'Normal' AS severity, condition || ' conditions' AS description
FROM (SELECT DISTINCT trim(weather_condition) AS condition FROM {src}
      WHERE weather_condition IS NOT NULL AND trim(weather_condition) <> '') n
WHERE condition NOT IN (SELECT c FROM (VALUES {_SEED_VALUES}) s(k, c, a, b, d))"""


def fact_sql(src: str, quality: str = "quality_flag") -> str:
    return f"""SELECT g.reading_id AS reading_key, coalesce(l1.location_key, l2.k2) AS location_key, t.time_key,
  CASE WHEN g.weather_condition IS NULL THEN CAST({UNKNOWN_KEY} AS BIGINT)
       WHEN trim(g.weather_condition) = '' THEN NULL
       ELSE coalesce(w.weather_type_key, CAST({UNKNOWN_KEY} AS BIGINT)) END AS weather_type_key,
  g.temperature_fahrenheit, g.temperature_celsius, g.humidity_percent, g.pressure_hpa, g.wind_speed_mph,
  TRY_CAST(trunc(g.wind_direction_degrees) AS INTEGER) AS wind_direction_degrees, g.precipitation_mm,
  round(g.visibility_miles * 1.60934, 2) AS visibility_km,
  TRY_CAST(trunc(g.cloud_cover_percent) AS INTEGER) AS cloud_cover_percent, CAST(NULL AS DOUBLE) AS uv_index,
  g.heat_index, g.wind_chill, g.temperature_anomaly AS temp_anomaly, g.temp_anomaly_score,
  g.is_extreme_weather, g.is_heatwave, g.is_extreme_cold, g.is_high_wind, g.is_heavy_precipitation,
  '{SOURCE_TAG}' AS source, coalesce(g.{quality}, '{QUALITY_FALLBACK}') AS quality_flag
FROM {src} g
LEFT JOIN dim_location l1 ON g.city = l1.city AND g.country = l1.country
LEFT JOIN (SELECT city, max(location_key) AS k2 FROM dim_location GROUP BY city) l2 ON g.city = l2.city
LEFT JOIN dim_time t ON date_trunc('hour', g.timestamp) = t.full_timestamp
LEFT JOIN dim_weather_type w ON trim(g.weather_condition) = w.condition
WHERE coalesce(l1.location_key, l2.k2) IS NOT NULL"""


cte("dim_location", ["gold_a"], dim_location_sql("gold_a"))
cte("dim_time", ["gold_a"], wh.dim_time_sql(
    "SELECT min(date_trunc('hour', timestamp)) AS s, max(date_trunc('hour', timestamp)) AS e FROM gold_a"))
cte("dim_weather_type", ["gold_a"], dim_weather_type_sql("gold_a"))
cte("fact", ["gold_a", "dim_location", "dim_time", "dim_weather_type"], fact_sql("gold_a"))

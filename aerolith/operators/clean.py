"""Silver-layer cleaning operators (2.2) with their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.constants import SILVER_A_FILL


def first_timestamp_column(df: DataFrame, candidates=("timestamp", "reading_timestamp")) -> str | None:
    """Variant B adapts to the columns present: first existing timestamp name."""
    return next((c for c in candidates if c in df.columns), None)


def dedup_readings(df: DataFrame, keys=("city", "timestamp"),
                   order=("ingestion_timestamp", "reading_id")) -> DataFrame:
    """One row per (city, timestamp): the earliest ingestion, then the lowest id.

    A first-row window per key: Spark limits groups on the map side
    (WindowGroupLimit), so a hot key with many copies is cut before the shuffle, and columns that the
    caller does not use are pruned down to the scan.
    """
    keys = [k for k in keys if k in df.columns]
    if not keys or "timestamp" not in keys:
        ts = first_timestamp_column(df)
        keys = ["city", ts] if ts else ["city"]
    order = [o for o in order if o in df.columns]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_first", F.row_number().over(w)).filter("_first = 1").drop("_first")


def dedup_readings_sql(src: str, keys=("city", "timestamp"),
                       order=("ingestion_timestamp", "reading_id")) -> str:
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{', '.join(keys)} ORDER BY {', '.join(order)}) AS _rn FROM {src}) WHERE _rn = 1")


_FLAG_RULES = [
    ("temperature_fahrenheit", -60, 140, "SUSPECT_TEMPERATURE"),
    ("humidity_percent", 0, 100, "SUSPECT_HUMIDITY"),
    ("wind_speed_mph", 0, 250, "SUSPECT_WIND"),
    ("pressure_hpa", 870, 1084, "SUSPECT_PRESSURE"),
]


def range_quality_flag(df: DataFrame) -> DataFrame:
    """Variant A: first violated range wins; null compares unknown, so it stays VALID."""
    expr = None
    for c, lo, hi, label in _FLAG_RULES:
        cond = (F.col(c) < lo) | (F.col(c) > hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return df.withColumn("quality_flag", expr.otherwise(F.lit("VALID")))


def range_quality_flag_sql() -> str:
    whens = " ".join(f"WHEN {c} < {lo} OR {c} > {hi} THEN '{label}'" for c, lo, hi, label in _FLAG_RULES)
    return f"CASE {whens} ELSE 'VALID' END"


def _critical(df: DataFrame, profile: str) -> list[str]:
    subset = ["city", "timestamp", "temperature_fahrenheit"] if profile == "A" else \
        ["city", "temperature_fahrenheit"]
    return [c for c in subset if c in df.columns]


def drop_null_critical(df: DataFrame, profile: str = "A") -> DataFrame:
    return df.dropna(subset=_critical(df, profile))


def critical_present(df: DataFrame, profile: str = "A") -> Column:
    """True where ``drop_null_critical`` keeps the row (no null, and no NaN in a float column)."""
    cond = F.lit(True)
    for c in _critical(df, profile):
        ok = F.col(c).isNotNull()
        if df.schema[c].dataType.typeName() in ("double", "float"):
            ok = ok & ~F.isnan(c)
        cond = cond & ok
    return cond


def drop_null_critical_sql(profile: str = "A") -> str:
    cols = ["city", "timestamp", "temperature_fahrenheit"] if profile == "A" else \
        ["city", "temperature_fahrenheit"]
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


def fill_null_defaults(df: DataFrame) -> DataFrame:
    """Variant A default map (runs after flagging, so fills never trip a range flag)."""
    return df.fillna({k: v for k, v in SILVER_A_FILL.items() if k in df.columns})


def fill_null_defaults_sql(columns: list[str]) -> list[str]:
    """Select list replacing the filled columns with ``coalesce``."""
    out = []
    for c in columns:
        if c in SILVER_A_FILL:
            v = SILVER_A_FILL[c]
            lit = f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)"
            out.append(f"coalesce({c}, {lit}) AS {c}")
        else:
            out.append(c)
    return out


def fill_numeric_zero(df: DataFrame) -> DataFrame:
    """Variant B: every double/float/int/long column null -> 0, in one call."""
    numeric = [f.name for f in df.schema.fields
               if f.dataType.typeName() in ("double", "float", "integer", "long")]
    return df.fillna(0, subset=numeric) if numeric else df


def celsius_backfill(df: DataFrame, profile: str = "A") -> DataFrame:
    t = F.col("temperature_fahrenheit")
    if profile == "A":
        if "temperature_celsius" not in df.columns:
            return df
        c = F.col("temperature_celsius")
        return df.withColumn("temperature_celsius",
                             F.when(c.isNull() & t.isNotNull(), (t - 32) * 5 / 9).otherwise(c))
    if "temperature_celsius" in df.columns:
        return df
    return df.withColumn("temperature_celsius", F.round((t - 32) * 5 / 9, 2))


CELSIUS_BACKFILL_A_SQL = ("CASE WHEN temperature_celsius IS NULL AND temperature_fahrenheit IS NOT NULL "
                          "THEN (temperature_fahrenheit - 32) * 5 / 9 ELSE temperature_celsius END")


def reading_date_parts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.select("*", F.to_date(ts).alias("reading_date"), F.year(ts).alias("reading_year"),
                     F.month(ts).alias("reading_month"), F.dayofmonth(ts).alias("reading_day"))


READING_DATE_PARTS_SQL = ("CAST(timestamp AS DATE) AS reading_date, CAST(year(timestamp) AS INTEGER) AS reading_year, "
                          "CAST(month(timestamp) AS INTEGER) AS reading_month, "
                          "CAST(day(timestamp) AS INTEGER) AS reading_day")


def range_filter_clamp(df: DataFrame) -> DataFrame:
    """Variant B: drop T outside [-80, 140]; clamp humidity to [0, 100], null stays null."""
    out = df
    if "temperature_fahrenheit" in df.columns:
        t = F.col("temperature_fahrenheit")
        out = out.filter((t >= -80) & (t <= 140))
    if "humidity_percent" in df.columns:
        h = F.col("humidity_percent")
        out = out.withColumn("humidity_percent",
                             F.when(h < 0, F.lit(0.0)).when(h > 100, F.lit(100.0)).otherwise(h))
    return out


RANGE_FILTER_B_SQL = "temperature_fahrenheit >= -80 AND temperature_fahrenheit <= 140"
CLAMP_HUMIDITY_B_SQL = ("CASE WHEN humidity_percent < 0 THEN 0.0 WHEN humidity_percent > 100 THEN 100.0 "
                        "ELSE humidity_percent END")


def valid_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("quality_flag") == "VALID")

"""Summary rows beside the fact table (2.4): kept per date and location, merged by the checks and totals.

The fact is written partitioned by ``date_key`` (``yyyymmdd`` of the reading hour, 0 where the hour is unknown). Beside it lies one
summary row per (date, location): counts, exact sums and extremes, so everything a check or a total asks is a merge of
these rows, whose number is that of the locations seen per day and not that of the readings. A load replaces the fact partitions of
the dates it touches and computes the summary rows of these dates alone; all other partitions of both tables stay as they are.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aerolith.constants import SOURCE_TAG

FACT, SUMMARY = "fact_weather_readings", "fact_summary"
HUMID = 80


def with_date_key(fact: DataFrame) -> DataFrame:
    return fact.withColumn("date_key", F.coalesce((F.col("time_key") / 100).cast("int"), F.lit(0)))


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(20,6)")


def summarize(fact: DataFrame) -> DataFrame:
    """One row per (date, location): everything the checks and totals need."""
    t, w, h = F.col("temperature_fahrenheit"), F.col("wind_speed_mph"), F.col("humidity_percent")
    count = lambda cond: F.count(F.when(cond, 1))
    return fact.groupBy("date_key", "location_key").agg(
        F.count(F.lit(1)).alias("n"), count(F.col("is_extreme_weather") == 1).alias("extreme"),
        count(t.isNull()).alias("null_temperature"), count((t < -80) | (t > 140)).alias("out_of_range"),
        F.count("time_key").alias("with_time"), count(F.col("source") == SOURCE_TAG).alias("tagged"),
        F.count(t).alias("n_temperature"), F.sum(_exact("temperature_fahrenheit")).alias("sum_temperature"),
        F.count(w).alias("n_wind"), F.sum(_exact("wind_speed_mph")).alias("sum_wind"),
        F.max(t).alias("max_temperature"), F.min(F.when(t.isNotNull(), F.struct(-t, "reading_key"))).getField("reading_key").alias("hottest_key"),
        count(h > HUMID).alias("humid"), F.max(F.when(h > HUMID, h)).alias("max_humidity"))


def _replace_dates(df: DataFrame, path: str) -> list[int]:
    """Replace the dates of ``df`` in the table at ``path``; these dates, noted while they are written."""
    noted = Observation()
    (df.hint("rebalance", "date_key").observe(noted, F.collect_set("date_key").alias("dates"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_key").parquet(path))
    return sorted(noted.get["dates"] or [])


def load_dates(spark: SparkSession, fact: DataFrame, root: str) -> list[int]:
    """Replace the dates that ``fact`` holds, in the fact table under ``root`` and in its summary; the dates touched.

    The summary of these dates is computed from what was written, by a scan of their partitions alone. Run again after a
    failure between the two writes, the load gives the same tables. The dates of one load are its days, a short list.
    """
    fact_path, summary_path = os.path.join(root, FACT), os.path.join(root, SUMMARY)
    keyed = with_date_key(fact)
    dates = _replace_dates(keyed, fact_path)
    written = spark.read.schema(keyed.schema).parquet(fact_path)
    if dates:
        _replace_dates(summarize(written.filter(F.col("date_key").isin(dates))), summary_path)
    return dates


def read_summary(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(os.path.join(root, SUMMARY))


def totals(summary: DataFrame) -> DataFrame:
    """One row: the summary's counts over all dates and locations."""
    names = {"n": "total", "extreme": "extreme", "null_temperature": "null_temperature", "out_of_range": "out_of_range",
             "with_time": "with_time", "tagged": "tagged"}
    return summary.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(a) for c, a in names.items()],
                       F.coalesce(F.sum(F.when(F.col("location_key").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("null_location"))


def by_location(summary: DataFrame) -> DataFrame:
    """One row per location: sums, extremes and the key of the first of its hottest readings."""
    return summary.groupBy("location_key").agg(
        F.sum("n").alias("n"), F.sum("extreme").alias("extreme"), F.sum("n_temperature").alias("n_temperature"),
        F.sum("sum_temperature").alias("sum_temperature"), F.sum("n_wind").alias("n_wind"), F.sum("sum_wind").alias("sum_wind"),
        F.min(F.when(F.col("hottest_key").isNotNull(), F.struct(-F.col("max_temperature"), "hottest_key"))).getField("hottest_key").alias("hottest_key"),
        F.max("max_temperature").alias("max_temperature"), F.sum("humid").alias("humid"), F.max("max_humidity").alias("max_humidity"))

"""The batch jobs as a plain chain of functions over layer paths.

Each job reads its input layer, builds one lazy plan and performs one write;
row counts are noted while the rows are written (``Observation``) rather than
by a ``count()`` after every step. Paths may be any Hadoop-compatible URI.

    bronze_to_silver(spark, bronze, silver)       -> Silver A (partitioned by reading_date)
    silver_to_gold(spark, silver, gold)           -> Gold A (partitioned by reading_date)
    gold_to_warehouse(spark, gold, warehouse)     -> dim_*, the fact by date and its summary under ``warehouse``
    quality_checks(spark, warehouse)              -> nine checks; raises if any fails
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators import summaries
from aerolith.operators import warehouse as wh
from aerolith.plans import medallion
from aerolith.sources import layers


def _typed_bronze(df: DataFrame) -> DataFrame:
    """Bronze written by the stream holds ISO-8601 strings; parse them once (UTC)."""
    for c in ("timestamp", "ingestion_timestamp"):
        if c in df.columns and df.schema[c].dataType.typeName() == "string":
            df = df.withColumn(c, F.substring(c, 1, 26).try_cast("timestamp_ntz"))
    if "reading_id" not in df.columns:
        # a stable id from the natural key, used only as the final tie-breaker
        df = df.withColumn("reading_id", F.xxhash64("city", "timestamp", "ingestion_timestamp"))
    return df


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str) -> dict:
    df = medallion.silver_a(_typed_bronze(layers.read_layer(spark, bronze)), stamp=True)
    return audit(spark, silver, layers.write_layer(df, silver))


def silver_to_gold(spark: SparkSession, silver: str, gold: str) -> dict:
    s = layers.read_layer(spark, silver)
    stats_path = os.path.join(gold.rstrip("/") + "_city_stats")

    def write_stats(stats: DataFrame) -> DataFrame:
        stats.write.mode("overwrite").parquet(stats_path)
        return spark.read.parquet(stats_path)

    return audit(spark, gold, layers.write_layer(medallion.gold_a(s, stamp=True, stats_hook=write_stats), gold))


def gold_to_warehouse(spark: SparkSession, gold: str, warehouse: str) -> dict:
    g = layers.read_layer(spark, gold).drop("gold_loaded_at", "silver_loaded_at")
    tables = wh.star(g, persist=True)
    for name, df in tables.items():
        if name != summaries.FACT:
            layers.warehouse_sink(df, path=os.path.join(warehouse, name))
    summaries.load_dates(spark, tables[summaries.FACT], warehouse)
    return {name: os.path.join(warehouse, name) for name in [*tables, summaries.SUMMARY]}


def quality_checks(spark: SparkSession, warehouse: str) -> DataFrame:
    """The nine checks from the summary rows beside the fact and ``dim_location``; raises if any fails."""
    from aerolith.plans.q_warehouse import dq_checks, dq_gate
    summary = summaries.read_summary(spark, warehouse)
    loc = spark.read.parquet(os.path.join(warehouse, "dim_location"))
    checks = dq_checks(summary, loc)
    dq_gate(checks)
    return checks


def audit(spark: SparkSession, layer: str, rows: int) -> dict:
    """Rows noted while a layer was written, and its distinct cities (one column read)."""
    return {"rows": rows, "cities": spark.read.parquet(layer).agg(F.countDistinct("city")).first()[0]}

"""Shared plan inputs.

``silver_a`` / ``silver_b`` are the lazy Bronze -> Silver plans. Gold is built, as
in a medallion pipeline, from the *written* Silver layer (a parquet table under
the shared checkpoint folder, written once per application): Gold then starts
from a column-pruned, filter-pushed scan instead of recomputing the
de-duplication shuffle for each branch of its plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from aerolith.operators import clean, serving
from aerolith.operators.warehouse import materialize
from aerolith.plans import medallion
from aerolith.sources.tables import memo, readings


def bronze(spark: SparkSession, d: str) -> DataFrame:
    return readings(spark, d)


def silver_a(spark: SparkSession, d: str) -> DataFrame:
    return memo(spark, "silver_a", d)(lambda: medallion.silver_a(readings(spark, d)))


def _silver_a_written(spark: SparkSession, d: str) -> tuple[DataFrame, dict]:
    def write():
        noted = Observation(), Observation()
        layer = materialize(medallion.silver_a(readings(spark, d), noted=noted), "silver_a")
        return layer, noted[0].get | noted[1].get

    return memo(spark, "silver_a_layer", d)(write)


def silver_a_layer(spark: SparkSession, d: str) -> DataFrame:
    return _silver_a_written(spark, d)[0]


def silver_a_counts(spark: SparkSession, d: str) -> dict:
    """Row counts that were noted while the Silver layer was written."""
    return _silver_a_written(spark, d)[1]


def silver_b_layer(spark: SparkSession, d: str) -> DataFrame:
    return memo(spark, "silver_b_layer", d)(lambda: materialize(silver_b(spark, d), "silver_b"))


def _stats_table(name: str):
    return lambda stats: materialize(stats, name)


def _gold_a_with_stats(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    def build():
        kept = []

        def hook(stats):
            kept.append(materialize(stats, "city_stats_a"))
            return kept[0]

        return medallion.gold_a(silver_a_layer(spark, d), stats_hook=hook), kept[0]

    return memo(spark, "gold_a", d)(build)


def gold_a(spark: SparkSession, d: str) -> DataFrame:
    return _gold_a_with_stats(spark, d)[0]


def latest_a(spark: SparkSession, d: str) -> DataFrame:
    """The current row of every city as a small written table, which all serving queries read.

    The current rows are found among the valid Silver rows; Gold's columns, which depend on the row and on the statistics
    of its city over all rows, are derived for these rows alone.
    """
    def build():
        stats = _gold_a_with_stats(spark, d)[1]
        rows = serving.latest_per_city(clean.valid_only(silver_a_layer(spark, d)), keys_hook=lambda keys: materialize(keys, "latest_keys"))
        return materialize(medallion.gold_a(rows, stats_hook=lambda _: stats), "latest_a")

    return memo(spark, "latest_a", d)(build)


def silver_b(spark: SparkSession, d: str) -> DataFrame:
    return memo(spark, "silver_b", d)(lambda: medallion.silver_b(readings(spark, d)))


def gold_b(spark: SparkSession, d: str) -> DataFrame:
    return memo(spark, "gold_b", d)(
        lambda: medallion.gold_b(silver_b_layer(spark, d), stats_hook=_stats_table("city_stats_b")))

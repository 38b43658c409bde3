"""Registered queries, grouped as in the inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions.numeric import exact_avg_round, exact_avg_round_sql
from aerolith.plans import base
from aerolith.plans.oracle import sql
from aerolith.plans.registry import register

# --- 2.4 aggregations ------------------------------------------------------

@register("city_summary", sql("SELECT city, " + exact_avg_round_sql("temperature_fahrenheit", 1) + " AS avg_temp, "
                              + exact_avg_round_sql("temp_anomaly_score", 2) + " AS avg_anomaly, "
                              "count(*) AS records FROM gold_a GROUP BY city", "gold_a"))
def city_summary(spark, d):
    """Per-city average temperature (1 dp), average anomaly score (2 dp), records."""
    g = base.gold_a(spark, d)
    return (g.groupBy("city")
             .agg(exact_avg_round("temperature_fahrenheit", 1).alias("avg_temp"),
                  exact_avg_round("temp_anomaly_score", 2).alias("avg_anomaly"),
                  F.count(F.lit(1)).alias("records"))
             .orderBy(F.desc("avg_temp"), "city"))

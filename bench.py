"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed to completion with the ``noop`` sink (every row is
produced, nothing is collected to the driver); one warm-up run, then the
median of ``BENCH_RUNS`` timed runs. Prints one JSON line.

Every timed run starts from what its job reads: the Silver jobs from the Bronze files, what the application
builds on Silver from the written Silver layer, decoders and streams from the published topic. City statistics, Gold, the
dimensions and the fact table are computed again on every run (``tables.forget``). The checks and questions run against
the loaded warehouse, ``region_stats`` against the table of current rows; ``warehouse_load`` is the time of loading it (Gold, dimensions, fact by date, summary), on every run anew.
The streams and one learned query are timed once, after their warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dedup_readings", "silver_a", "gold_a", "gold_b", "city_summary", "latest_per_city", "region_stats",
    "forecast_24h", "build_fact", "warehouse_load", "dq_checks", "q_avg_temp_by_city", "processor_clean",
    "normalize_current_weather", "render_documents", "retrieve_top_k", "route_questions",
    "sequence_windows", "stratified_split", "bronze_stream", "processor_stream", "forecast_regressor",
]
ONCE = {"bronze_stream", "processor_stream", "forecast_regressor"}
FROM_SILVER = ("table", "readings", "silver_a", "silver_b", "silver_a_layer", "silver_b_layer",
               "topic-simple-topic", "topic-current-topic", "topic-reading-topic")
LOADED = {"dq_checks": ("warehouse",), "q_avg_temp_by_city": ("warehouse",), "region_stats": ("gold_a", "latest_a")}


def warehouse_load(spark, sf_dir):
    """The load of the whole star; returns the number of its summary rows, so that the fact is not read again."""
    from aerolith.operators.summaries import SUMMARY
    from aerolith.plans.q_warehouse import star_views
    return star_views(spark, sf_dir)[SUMMARY].groupBy().count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from aerolith.plans.registry import load_all
    from aerolith.session import build_session
    from aerolith.sources.tables import forget

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="aerolith-bench")
    reg = load_all()
    timings = {}
    for name in HEADLINE:
        if name not in reg and name != "warehouse_load":
            continue
        fn = reg[name][0] if name in reg else warehouse_load

        def once():
            forget(keep=FROM_SILVER + LOADED.get(name, ()))
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()  # warm-up: JIT, file listing, Python workers
        timings[name] = round(statistics.median(once() for _ in range(1 if name in ONCE else runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_median_sec", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()

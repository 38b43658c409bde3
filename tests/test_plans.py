"""Physical-plan properties that matter at scale."""

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_is_one_map_stage_without_python(spark):
    from aerolith.plans import base
    p = _plan(base.gold_a(spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "Exchange hashpartitioning" not in p      # no shuffle of readings by city
    assert "Window" not in p                          # no whole-city window
    assert "BroadcastHashJoin" in p                   # statistics table broadcast by size


def test_silver_filter_reaches_the_scan(spark):
    from aerolith.plans import base
    p = base.gold_a(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(quality_flag), EqualTo(quality_flag,VALID)]" in p


def test_readings_broadcasts_tiny_dimensions(spark):
    from aerolith.sources.tables import derived_readings
    p = _plan(derived_readings(spark, SF_SMALL))
    assert p.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in p


def test_dedup_limits_groups_before_the_shuffle(spark):
    from aerolith.operators import clean
    from aerolith.sources.tables import readings
    p = _plan(clean.dedup_readings(readings(spark, SF_SMALL)))
    assert "WindowGroupLimit" in p and "Partial" in p


def _read_columns(df) -> set:
    import re
    p = df._jdf.queryExecution().executedPlan().toString()
    return {c.split(":")[0] for s in re.findall(r"ReadSchema: struct<([^\n]*)>", p) for c in s.split(",")}


def test_narrow_queries_scan_narrow(spark):
    from aerolith.plans.registry import load_all
    q = load_all()
    unused = {"longitude", "latitude", "weather_description", "cloud_cover_percent", "pressure_hpa", "props"}
    for name in ("top5_hottest", "risk_summary"):
        assert not _read_columns(q[name][0](spark, SF_SMALL)) & unused, name
    assert not _read_columns(q["quality_flag_counts"][0](spark, SF_SMALL)) & unused - {"pressure_hpa"}  # the flag needs the pressure


def test_latest_per_city_sorts_nothing_below_its_aggregates(spark):
    from aerolith.operators import serving
    from aerolith.plans import base
    g = base.gold_a(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    p = _plan(serving.latest_per_city(g))
    assert "SortAggregate" not in p and "HashAggregate" in p
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == old


def test_retrieval_limits_before_shuffle(spark):
    from aerolith.plans.registry import load_all
    p = _plan(load_all()["retrieve_top_k"][0](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_json_parsed_once(spark):
    from aerolith.plans.registry import load_all
    p = _plan(load_all()["normalize_current_weather"][0](spark, SF_SMALL))
    # the payload is parsed once into fields and once into keys, the two inner objects once each
    assert p.count("from_json(StructField(main") == 1


def test_scale_settings_bounds():
    from aerolith.session import scale_settings
    big = scale_settings(100 * 10**12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) <= 100_000
    assert int(big["spark.sql.shuffle.partitions"]) >= 3 * 8000
    assert int(scale_settings(10**6, 8)["spark.sql.shuffle.partitions"]) == 24
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 << 20


def test_context_never_shuffles_texts_by_id(spark):
    """With the text table over the broadcast threshold, the written top-k rows are broadcast instead."""
    from conftest import SF_CHECK
    from aerolith.operators import retrieval
    emb = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").withColumnRenamed("doc_id", "vec_id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 << 10))  # documents: ~2 MB of parquet
    try:
        ctx = retrieval.build_context(retrieval.cosine_top_k(emb, retrieval.label_centroids(emb), 5), docs)
        ctx.collect()
        p = ctx._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(vec_id" not in p and "hashpartitioning(doc_id" not in p
    assert "BroadcastHashJoin" in p


def test_split_joins_histogram_map_side(spark):
    """The written histogram is sized by the planner: rows join it by broadcast, not by a shuffle join."""
    from aerolith.plans.registry import load_all
    df = load_all()["stratified_split"][0](spark, SF_SMALL)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p
    assert "BroadcastHashJoin" in p

"""The batch job chain over written layers, summaries beside the fact, and stream restarts (rows that commit together)."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_batch_chain_matches_lazy_plans(spark):
    from aerolith.plans import base, batch
    from aerolith.sources import layers
    from aerolith.sources.tables import readings
    root = layers.fresh_path(spark, "batch-test")
    bronze = os.path.join(root, "bronze")
    readings(spark, SF_SMALL).withColumn("ingestion_date", F.to_date("timestamp")).write.partitionBy("ingestion_date").parquet(bronze)
    s = batch.bronze_to_silver(spark, bronze, os.path.join(root, "silver"))
    g = batch.silver_to_gold(spark, os.path.join(root, "silver"), os.path.join(root, "gold"))
    assert s["rows"] == base.silver_a(spark, SF_SMALL).count()
    assert g["rows"] == base.gold_a(spark, SF_SMALL).count()
    batch.gold_to_warehouse(spark, os.path.join(root, "gold"), os.path.join(root, "wh"))
    checks = batch.quality_checks(spark, os.path.join(root, "wh"))
    assert checks.filter("status = 'FAIL'").count() == 0
    gold = spark.read.parquet(os.path.join(root, "gold")).select("reading_id", "temp_anomaly_score")
    expect = base.gold_a(spark, SF_SMALL).select("reading_id", "temp_anomaly_score")
    assert gold.exceptAll(expect).count() == 0 and expect.exceptAll(gold).count() == 0


def _commits(spark, path):
    """Files that each entry of the sink's log has added."""
    log = os.path.join(path, "_spark_metadata")
    for name in sorted((n for n in os.listdir(log) if n.isdigit()), key=int):
        with open(os.path.join(log, name)) as f:
            yield [json.loads(line)["path"] for line in f.read().splitlines()[1:]]


def test_raw_and_processed_rows_commit_together(spark):
    """Every batch, also after a restart, adds a message's raw row and processed row in one commit, once."""
    from aerolith.sources import layers, payloads as pl
    from aerolith.sources.tables import readings
    from aerolith.streaming import jobs
    topic = pl.simple_reading_topic(readings(spark, SF_SMALL))
    landing, out, ckpt = (layers.fresh_path(spark, n) for n in ("together-topic", "together", "together-ckpt"))
    expected = set()
    for share in (0, 1):  # the second half arrives while the job is down
        part = topic.filter(F.col("message_id") % 2 == share)
        part.repartition(3).write.mode("append").parquet(landing)
        jobs.start_processor_stream(spark, jobs.file_source(spark, landing, max_files=1), out, ckpt, {"availableNow": True}).awaitTermination()
        expected |= {r.message_id for r in pl.processor_clean(part).collect()}
        raw, processed = jobs.raw_table(spark, out), jobs.processed_table(spark, out)
        seen = [r.message_id for r in processed.select("message_id").collect()]
        assert set(seen) == expected and len(seen) == len(expected)
        assert processed.join(raw, "message_id", "left_anti").isEmpty()
        assert raw.count() == raw.select("message_id").distinct().count() == pl.raw_events(spark.read.parquet(landing)).count()
        assert processed.filter("processed_at IS NULL").isEmpty()
    commits = list(_commits(spark, out))
    assert len(commits) == 6
    for files in commits:
        ids = {kind: {r.message_id for r in spark.read.parquet(*[f for f in files if f"kind={kind}" in f]).collect()} for kind in (pl.RAW, pl.PROCESSED)}
        assert ids[pl.PROCESSED] and ids[pl.PROCESSED] <= ids[pl.RAW]


def test_message_rows_of_odd_messages(spark):
    from aerolith.sources import payloads as pl
    values = ['{"temperature": 60, "location": "A", "timestamp": "t"}', '{"temperature": null, "location": "B"}', '{"temperature": "72"}',
              '{"pressure": "x", "temperature": 1}', '[1]', '5', 'null', '', None, '{"location": {"a": 1}, "humidity": 200}', '{"location": null}',
              '{"temperature": 50, "temperature": 300}', '{"precipitation": true}']
    df = spark.createDataFrame(list(enumerate(values)), "message_id long, value string")
    rows = {(r.kind, r.message_id): r for r in pl.raw_and_processed(df).collect()}
    assert sorted(i for k, i in rows if k == pl.RAW) == [0, 1, 9, 10, 11]
    assert sorted(i for k, i in rows if k == pl.PROCESSED) == [0, 3, 9, 10, 11, 12]
    assert rows[pl.RAW, 9].humidity == 200 and rows[pl.PROCESSED, 9].humidity == 100 and rows[pl.PROCESSED, 9].location == '{"a":1}'
    assert rows[pl.RAW, 10].location is None and rows[pl.PROCESSED, 10].location is None and rows[pl.PROCESSED, 12].location == "Unknown"
    assert rows[pl.PROCESSED, 11].temperature == 150 and rows[pl.RAW, 0].heat_index is None and rows[pl.PROCESSED, 0].heat_index == 60
    same = [c for c in pl.PROCESSED_COLUMNS]
    both = pl.raw_and_processed(df).filter(F.col("kind") == pl.PROCESSED).select(*same)
    assert both.exceptAll(pl.processor_clean(df)).isEmpty() and pl.processor_clean(df).exceptAll(both).isEmpty()


def test_avro_values_with_and_without_registry_header(spark):
    """Which of the two positions a value is decoded at; a stub stands for the package that is not on this machine."""
    from aerolith.schemas import READING
    from aerolith.streaming import jobs
    asked = []

    def stub(column, schema, options):
        asked.append((schema, options))
        return F.from_json(column.cast("string"), READING)

    header = b"\x00\x00\x00\x00\x07"
    values = [b'{"city": "bare", "humidity_percent": 1}', header + b'{"city": "framed", "humidity_percent": 2}', b"garbage", header + b"garbage", b"", None,
              b'{"city": null}', b'{"city": ""}', b'     {"city": "blanks"}', header]
    out = jobs.decode_reading_avro("the schema", stub)(spark.createDataFrame([(v,) for v in values], "value binary"))
    assert out.columns == [f.name for f in READING.fields]
    assert sorted((r.city, r.humidity_percent) for r in out.collect()) == [("bare", 1.0), ("blanks", None), ("framed", 2.0)]
    assert asked == [("the schema", {"mode": "PERMISSIVE"})] * 2


def test_summaries_follow_an_incremental_load(spark):
    """After a load of one date the checks and totals from the summary equal those of a full scan, and other dates are untouched."""
    from aerolith.operators import summaries, warehouse as wh
    from aerolith.plans import base
    from aerolith.sources import layers
    fact = wh.star(base.gold_a(spark, SF_SMALL))[summaries.FACT]
    root = layers.fresh_path(spark, "incremental")
    dates = summaries.load_dates(spark, fact, root)
    assert len(dates) > 3 and dates == sorted({r.d for r in summaries.with_date_key(fact).select(F.col("date_key").alias("d")).collect()})
    day = dates[1]
    late = (summaries.with_date_key(fact).filter(F.col("date_key") == day).drop("date_key").filter("reading_key % 3 <> 0")
            .withColumn("temperature_fahrenheit", F.when(F.col("reading_key") % 5 > 0, F.col("temperature_fahrenheit") + 90))
            .withColumn("location_key", F.when(F.col("reading_key") % 7 > 0, F.col("location_key"))))
    kept = {f for f in os.listdir(os.path.join(root, summaries.SUMMARY, f"date_key={dates[2]}"))}
    for _ in range(2):  # run again: the same tables
        assert summaries.load_dates(spark, late, root) == [day]
    assert kept == {f for f in os.listdir(os.path.join(root, summaries.SUMMARY, f"date_key={dates[2]}"))}
    whole = spark.read.parquet(os.path.join(root, summaries.FACT))
    assert whole.filter(F.col("date_key") == day).count() == late.count() < fact.count()
    kept_rows, fresh = summaries.read_summary(spark, root), summaries.summarize(whole)
    assert kept_rows.select(*fresh.columns).exceptAll(fresh).isEmpty() and kept_rows.count() == fresh.count()
    t = summaries.totals(kept_rows).first()
    want = whole.selectExpr("count(*)", "count_if(is_extreme_weather = 1)", "count_if(temperature_fahrenheit IS NULL)",
                            "count_if(temperature_fahrenheit > 140 OR temperature_fahrenheit < -80)", "count(time_key)",
                            "count_if(location_key IS NULL)").first()
    assert (t.total, t.extreme, t.null_temperature, t.out_of_range, t.with_time, t.null_location) == tuple(want)
    assert t.null_temperature > 0 and t.null_location > 0
    per = {r.location_key: r for r in summaries.by_location(kept_rows).collect()}
    for r in whole.groupBy("location_key").agg(F.count(F.lit(1)).alias("n"), F.max("temperature_fahrenheit").alias("m"),
                                               F.min(F.when(F.col("temperature_fahrenheit").isNotNull(), F.struct(-F.col("temperature_fahrenheit"), "reading_key"))).alias("k")).collect():
        assert (per[r.location_key].n, per[r.location_key].max_temperature) == (r.n, r.m)
        assert r.m is None or per[r.location_key].hottest_key == r.k.reading_key


def test_upsert_keeps_locations_without_a_country(spark):
    from aerolith.operators import warehouse as wh
    rows = spark.createDataFrame([("A", None, "x", None, 1.0, 2.0, "r"), ("A", "US", "x", None, 1.0, 2.0, "r")],
                                 "city string, country string, continent string, state string, latitude double, longitude double, region string")
    once = wh.upsert_dim_location(rows.limit(0).withColumn("location_key", F.lit(1).cast("long")), rows)
    twice = wh.upsert_dim_location(once, rows.withColumn("region", F.lit("s")))
    assert once.count() == twice.count() == 2 and {r.region for r in twice.collect()} == {"s"}
    assert {r.location_key for r in once.collect()} == {r.location_key for r in twice.collect()}
    assert len({r.location_key for r in once.collect()}) == 2

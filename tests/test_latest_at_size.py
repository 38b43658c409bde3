"""Latest rows and Bronze without shuffles of rows in full width (round 3)."""

from aerolith.operators import serving


def test_latest_rows_with_written_keys(spark, tmp_path):
    """the keys may be written first; the same rows, and rows in full width are not shuffled where the keys are few."""
    gold = spark.createDataFrame([(i, f"c{i % 7}" if i % 11 else None, i // 14, float(i)) for i in range(200)] + [(500, "c9", None, 1.0)],
                                 "reading_id long, city string, timestamp int, v double")
    path = str(tmp_path / "keys")

    def written(keys):
        keys.write.parquet(path)
        return spark.read.parquet(path)

    got = serving.latest_per_city(gold, keys_hook=written)
    assert sorted(got.collect()) == sorted(serving.latest_per_city(gold).collect())
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_bronze_deals_narrow_events(spark):
    """events are dealt over the tasks before they become readings of twenty columns."""
    from aerolith.sources.tables import derived_readings

    d = "/root/testdata/sf0.001"
    dealt = derived_readings(spark, d, deal=True)
    below = dealt._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert len(below) == 2 and "continent" not in below[1]
    assert sorted(map(str, dealt.collect())) == sorted(map(str, derived_readings(spark, d).collect()))

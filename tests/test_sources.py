"""Payload decoders on hand-built messages (FIXTURES.md F2/F3)."""

from aerolith.sources import payloads as pl


def test_processor_missing_vs_null(spark):
    msgs = [
        (1, '{"timestamp": "t", "location": "A"}'),                          # all defaults
        (2, '{"timestamp": "t", "temperature": null, "humidity": 50, "wind_speed": 1}'),  # explicit null -> skip
        (3, '{"timestamp": "t", "temperature": 200, "humidity": -5, "wind_speed": -3, "pressure": null}'),
        (4, 'not json'),
        (5, '{"timestamp": "t", "temperature": "72", "humidity": 50, "wind_speed": 1}'),  # quoted number -> skip
        (6, '[1, 2]'),
    ]
    df = spark.createDataFrame(msgs, "message_id long, value string")
    rows = {r["message_id"]: r for r in pl.processor_clean(df).collect()}
    assert set(rows) == {1, 3}
    r1 = rows[1]
    assert (r1["temperature"], r1["humidity"], r1["wind_speed"], r1["pressure"], r1["precipitation"]) == \
        (70.0, 50.0, 0.0, 1013.0, 0.0)
    assert r1["heat_index"] == 70.0 and r1["extreme_event"] == 0
    r3 = rows[3]
    assert (r3["temperature"], r3["humidity"], r3["wind_speed"], r3["pressure"]) == (150.0, 0.0, 0.0, None)
    assert r3["extreme_event"] == 1


def test_forecast_period_quirks(spark):
    msgs = [(1, "A", "t", '{"temperature": 60, "windSpeed": "12 mph", "relativeHumidity": {"value": null}}'),
            (2, "B", "t", '{"windSpeed": "", "barometricPressure": {"value": 101325}}')]
    df = spark.createDataFrame(msgs, "message_id long, location string, observed_at string, payload string")
    rows = {r["message_id"]: r for r in pl.normalize_forecast_period(df).collect()}
    assert (rows[1]["temperature"], rows[1]["wind_speed"], rows[1]["humidity"], rows[1]["pressure"]) == \
        (60.0, 12.0, 50.0, 10.13)   # default 1013 > 100 is divided by 100, as in the application
    assert (rows[2]["temperature"], rows[2]["wind_speed"], rows[2]["pressure"]) == (70.0, 0.0, 1013.25)
    assert rows[2]["is_daytime"] is True and rows[2]["forecast_text"] == ""


def test_current_weather_defaults(spark):
    p = ('{"main": {"temp": 77.777, "humidity": 40, "pressure": 1000}, "wind": {"speed": 3.456}, '
         '"weather": [{"main": "Rain", "description": "light rain"}], "clouds": {"all": 20}}')
    missing = '{"main": {"temp": 70}, "wind": {"speed": 1}, "weather": [], "clouds": {"all": 1}}'
    rows = [(1, "Tokyo", "x", "x", "x", None, 0.0, 0.0, "t", p), (2, "Nowhere", "NW", "C", "R", None, 1.0, 2.0, "t", p),
            (3, "Z", "x", "x", "x", None, 0.0, 0.0, "t", missing)]
    df = spark.createDataFrame(rows, "message_id long, city string, country string, continent string, region string, "
                                     "state string, latitude double, longitude double, observed_at string, "
                                     "payload string")
    out = {r["message_id"]: r for r in pl.normalize_current_weather(df).collect()}
    assert set(out) == {1, 2}
    t = out[1]
    assert (t["country"], t["latitude"], t["temperature_fahrenheit"], t["temperature_celsius"]) == \
        ("JP", 35.68, 77.78, 25.43)
    assert (t["wind_speed_mph"], t["wind_direction_degrees"], t["visibility_miles"], t["precipitation_mm"]) == \
        (3.46, 0.0, 6.21, 0.0)
    assert (out[2]["country"], out[2]["latitude"]) == ("NW", 1.0)


def test_sink_counts_detect_missing_raw(spark):
    from aerolith.plans.q_sources import sink_counts
    raw = spark.createDataFrame([(1,), (2,)], "message_id long")
    proc = spark.createDataFrame([(1, 70.0), (2, 71.0), (3, 72.0)], "message_id long, temperature double")
    r = sink_counts(raw, proc).first()
    assert (r["raw_rows"], r["processed_rows"], r["processed_with_raw"]) == (2, 3, 2)


def test_forecast_period_bad_input(spark):
    good = '"windSpeed": "5 mph", "relativeHumidity": {"value": 40}, "barometricPressure": {"value": 90}'
    msgs = [(1, "{not json"), (2, '{"temperature": null, ' + good + '}'), (3, '{"relativeHumidity": null}'),
            (4, '{"windSpeed": "calm"}'), (5, '{"barometricPressure": null}'), (6, '{"temperature": "61", ' + good + '}'),
            (7, '{"shortForecast": null, "windSpeed": null}')]
    df = spark.createDataFrame([(i, "A", "t", p) for i, p in msgs], "message_id long, location string, observed_at string, payload string")
    rows = {r["message_id"]: r for r in pl.normalize_forecast_period(df).collect()}
    assert set(rows) == {6, 7}
    assert (rows[6]["temperature"], rows[6]["wind_speed"], rows[6]["humidity"], rows[6]["pressure"]) == (61.0, 5.0, 40.0, 90.0)
    assert rows[7]["forecast_text"] is None and rows[7]["wind_speed"] == 0.0


def test_current_weather_explicit_nulls(spark):
    base = ('"main": {"temp": 70, "humidity": 40, "pressure": 1000}, '
            '"weather": [{"main": "Rain", "description": "light rain"}], "clouds": {"all": 20}')
    wind = '"wind": {"speed": 3}'
    msgs = ["{%s, %s}" % (base, wind), '{%s, "wind": {"speed": 3, "deg": null}}' % base, '{%s, %s, "visibility": null}' % (base, wind),
            '{%s, %s, "rain": null}' % (base, wind), '{%s, %s, "rain": {"1h": null}}' % (base, wind), '{%s, %s, "rain": {}}' % (base, wind)]
    rows = [(i, "Z", "x", "x", "x", None, 0.0, 0.0, "t", m) for i, m in enumerate(msgs)]
    df = spark.createDataFrame(rows, "message_id long, city string, country string, continent string, region string, "
                                     "state string, latitude double, longitude double, observed_at string, payload string")
    assert {r["message_id"] for r in pl.normalize_current_weather(df).collect()} == {0, 5}


def test_kafka_columns_pass_the_decoders(spark):
    from aerolith.streaming import jobs
    rows = [(None, b'{"temperature": 70, "timestamp": "2025-01-01T00:00:00", "city": "A"}', "t", 0, 5)]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long")
    assert pl.decode_json_payload(df).count() == 1 and pl.processor_clean(df).count() == 1 and pl.raw_events(df).count() == 1
    assert jobs.bronze(jobs.decode_reading_json(df)).count() == 1
    assert pl.envelope(df).first()["message_id"] is not None


def test_bad_time_keeps_the_row_with_a_null_key(spark):
    from aerolith.operators import warehouse as wh
    from aerolith.plans.batch import _typed_bronze
    dim = wh.dim_time(spark, "2025-01-01 00:00:00", "2025-01-02 00:00:00")
    facts = spark.createDataFrame([(1, "garbage"), (2, "2025-01-01T05:30:00")], "reading_id long, timestamp string")
    got = {r.reading_id: r.time_key for r in wh.join_time(facts, dim).collect()}
    assert got[1] is None and got[2] is not None
    assert _typed_bronze(facts).filter("timestamp is null").count() == 1


def test_exact_mean_of_large_values(spark):
    from pyspark.sql import functions as F
    from aerolith.functions.numeric import exact_avg_round
    df = spark.createDataFrame([(1e9,), (3e9,), (0.000004,)], "x double")
    assert df.agg(exact_avg_round("x", 2)).first()[0] == 1333333333.33

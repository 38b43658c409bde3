"""Message payloads: building topic twins from tables, decoding and normalising them.

A topic twin is a DataFrame with a ``value`` column holding what a producer
would have published for each reading; the decoders are the operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.constants import METERS_PER_MILE, city_catalogue_rows
from aerolith.functions import weather as wx
from aerolith.operators.hints import literal_broadcast
from aerolith.profiles import PROFILE_C
from pyspark.sql.types import StringType, StructField, StructType, VariantType

from aerolith.schemas import CURRENT_WEATHER, SIMPLE_READING

CORRUPT = "_corrupt_record"

ISO_SPARK = "yyyy-MM-dd'T'HH:mm:ss"
ISO_DUCK = "%Y-%m-%dT%H:%M:%S"
MALFORMED_EVERY = 101   # every 101st reading publishes a malformed message
EXPLICIT_NULLS_EVERY = 2  # every 2nd message keeps null keys instead of omitting them
QUOTED_EVERY = 103        # every 103rd message sends its temperature as a quoted number


def iso(ts: str) -> Column:
    return F.date_format(F.col(ts), ISO_SPARK)


# --- JSON topic (simple readings) --------------------------------------------

def simple_reading_topic(readings: DataFrame) -> DataFrame:
    """One JSON message per reading; missing keys and explicit nulls both occur."""
    s = F.struct(iso("timestamp").alias("timestamp"), F.col("city").alias("location"),
                 F.col("temperature_fahrenheit").alias("temperature"), F.col("humidity_percent").alias("humidity"),
                 F.col("wind_speed_mph").alias("wind_speed"), F.col("pressure_hpa").alias("pressure"),
                 F.col("precipitation_mm").alias("precipitation"))
    rid = F.col("reading_id")
    quoted = s.withField("temperature", F.lit("72"))
    value = (F.when(rid % MALFORMED_EVERY == 0, F.lit("{not json"))
              .when(rid % QUOTED_EVERY == 0, F.to_json(quoted))
              .when(rid % EXPLICIT_NULLS_EVERY == 0, F.to_json(s, {"ignoreNullFields": "false"}))
              .otherwise(F.to_json(s)))
    return readings.select(F.col("reading_id").alias("message_id"), value.alias("value"))


def parse_json(value: Column, schema: StructType) -> Column:
    """``from_json`` that keeps malformed input visible in ``_corrupt_record``."""
    return F.from_json(value, StructType(schema.fields + [StructField(CORRUPT, StringType())]),
                       {"columnNameOfCorruptRecord": CORRUPT})


def parse_once(df: DataFrame, parsed: Column, alias: str) -> DataFrame:
    """Attach a parsed struct evaluated exactly once per row.

    Catalyst pushes filters through projections by substituting the projected
    expression, so every predicate on a parsed field would re-run the parser.
    A one-element ``explode`` is a Generate node: predicates on its output stay
    above it, and the parser runs once per message.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(alias))


def well_formed(parsed: str) -> Column:
    return F.col(parsed).isNotNull() & F.col(f"{parsed}.{CORRUPT}").isNull()


def envelope(messages: DataFrame) -> DataFrame:
    """Give messages an id where the source has none: Kafka's topic, partition and offset name a message."""
    if "message_id" in messages.columns:
        return messages
    return messages.withColumn("message_id", F.xxhash64("topic", "partition", "offset"))


def decode_json_payload(topic: DataFrame) -> DataFrame:
    """value (JSON string) -> simple reading columns; malformed messages dropped."""
    topic = envelope(topic)
    parsed = parse_once(topic.select("message_id", "value"), parse_json(F.col("value").cast("string"),
                                                                        SIMPLE_READING), "m")
    return parsed.filter(well_formed("m")).select("message_id", *[f"m.{f.name}" for f in SIMPLE_READING.fields])


TEXTS = ("timestamp", "location")
NUMBERS = ("temperature", "humidity", "wind_speed", "pressure", "precipitation")
RAW, PROCESSED = "raw", "processed"
RAW_COLUMNS = ("message_id", *TEXTS, *NUMBERS)
PROCESSED_COLUMNS = (*RAW_COLUMNS, "heat_index", "extreme_event")

_MESSAGE = StructType([StructField(n, VariantType()) for n in TEXTS + NUMBERS])


def _message(topic: DataFrame) -> DataFrame:
    """``message_id, k``: the message parsed once, each key as a variant of its own; what is no JSON object is dropped.

    A missing key is null, a key with a null is a variant null, and numbers and strings stay apart.
    """
    parsed = parse_once(envelope(topic).select("message_id", "value"), parse_json(F.col("value").cast("string"), _MESSAGE), "k")
    return parsed.filter(well_formed("k"))


def _double(name: str) -> Column:
    return F.try_variant_get(f"k.{name}", "$", "double")


def _text(name: str) -> Column:
    v = F.col(f"k.{name}")
    return F.coalesce(F.try_variant_get(v, "$", "string"), F.when(~F.is_variant_null(v), F.to_json(v)))


def _raw_fields() -> tuple[Column, list[Column]]:
    """Whether every number of the message is a number (or null, or missing), and the fields as sent."""
    bad = F.lit(False)
    for n in NUMBERS:
        v = F.col(f"k.{n}")
        bad |= v.isNotNull() & ~F.is_variant_null(v) & (_double(n).isNull() | F.schema_of_variant(v).isin("STRING", "BOOLEAN"))
    return ~F.coalesce(bad, F.lit(False)), [*[_text(n).alias(n) for n in TEXTS], *[_double(n).alias(n) for n in NUMBERS]]


def _processed_fields() -> tuple[Column, list[Column]]:
    """Whether the application can process the message, and its fields with defaults for missing keys, clamped.

    A null or a quoted temperature, humidity or wind speed makes its arithmetic fail; that message is skipped.
    """
    def get(name, default, value):
        return F.when(F.col(f"k.{name}").isNull(), F.lit(default)).otherwise(value)

    def needed(name, default):
        return get(name, default, F.when(F.schema_of_variant(f"k.{name}") != "STRING", _double(name)))

    t, h, w = needed("temperature", 70.0), needed("humidity", 50.0), needed("wind_speed", 0.0)
    ok = t.isNotNull() & h.isNotNull() & w.isNotNull()
    return ok, [_text("timestamp").alias("timestamp"), get("location", "Unknown", _text("location")).alias("location"),
                F.greatest(F.lit(-50.0), F.least(F.lit(150.0), t)).alias("temperature"),
                F.greatest(F.lit(0.0), F.least(F.lit(100.0), h)).alias("humidity"), F.greatest(F.lit(0.0), w).alias("wind_speed"),
                get("pressure", 1013.0, _double("pressure")).alias("pressure"),
                get("precipitation", 0.0, _double("precipitation")).alias("precipitation")]


def _derived() -> list[Column]:
    return [wx.heat_index(PROFILE_C, "temperature", "humidity").alias("heat_index"), wx.extreme_event_c().alias("extreme_event")]


def processor_clean(topic: DataFrame) -> DataFrame:
    """Variant C row processor: defaults for *missing* keys, clamps, heat index, extreme flag."""
    ok, fields = _processed_fields()
    return _message(topic).filter(ok).select("message_id", *fields).select("*", *_derived())


def raw_events(topic: DataFrame) -> DataFrame:
    """The raw table: the message fields as sent (null where a key is missing); messages with a number that is none are dropped."""
    ok, fields = _raw_fields()
    return _message(topic).filter(ok).select("message_id", *fields)


def raw_and_processed(topic: DataFrame) -> DataFrame:
    """Each message's raw row and, where it has one, its processed row: ``kind`` and the columns of both, from one parse."""
    raw_ok, raw = _raw_fields()
    ok, processed = _processed_fields()
    both = F.array(F.when(raw_ok, F.struct(F.lit(RAW).alias("kind"), *raw)), F.when(ok, F.struct(F.lit(PROCESSED).alias("kind"), *processed)))
    rows = _message(topic).select("message_id", F.explode(F.filter(both, lambda r: r.isNotNull())).alias("r")).select("message_id", "r.*")
    heat, extreme = [F.when(F.col("kind") == PROCESSED, c) for c in _derived()]
    return rows.select("kind", *RAW_COLUMNS, heat.alias("heat_index"), extreme.alias("extreme_event"))


# --- provider payload: current conditions --------------------------------------

VISIBILITY_MISSING_EVERY = 7
CURRENT_NULLS_EVERY = 19  # every 19th payload keeps null keys, which the application cannot convert


def current_weather_topic(readings: DataFrame) -> DataFrame:
    """Provider-shaped JSON per reading, with the city envelope carried alongside."""
    rid = F.col("reading_id")
    payload = F.struct(
        F.struct(F.col("temperature_fahrenheit").alias("temp"), F.col("humidity_percent").alias("humidity"),
                 F.col("pressure_hpa").alias("pressure")).alias("main"),
        F.struct(F.col("wind_speed_mph").alias("speed"), F.col("wind_direction_degrees").alias("deg")).alias("wind"),
        F.when(F.col("weather_condition").isNotNull(),
               F.array(F.struct(F.col("weather_condition").alias("main"),
                                F.col("weather_description").alias("description")))).alias("weather"),
        F.struct(F.col("cloud_cover_percent").alias("all")).alias("clouds"),
        F.when(rid % VISIBILITY_MISSING_EVERY != 0,
               F.floor(F.col("visibility_miles") * METERS_PER_MILE).cast("bigint")).alias("visibility"),
        F.when(F.col("precipitation_mm") > 0, F.struct(F.col("precipitation_mm").alias("1h"))).alias("rain"))
    return readings.select(
        F.col("reading_id").alias("message_id"), "city", "country", "continent", "region", "state", "latitude",
        "longitude", iso("timestamp").alias("observed_at"),
        F.when(rid % CURRENT_NULLS_EVERY == 0, F.to_json(payload, {"ignoreNullFields": "false"}))
         .otherwise(F.to_json(payload)).alias("payload"))


def normalize_current_weather(topic: DataFrame) -> DataFrame:
    """Provider JSON -> flat reading. Messages lacking a required field are skipped, and so
    are those that hold a null where a missing key would have a default.

    City attributes come from the fixed catalogue when the city is in it (a
    broadcast of 80 literal rows), else from the message envelope.
    """
    p = parse_once(topic, F.from_json("payload", CURRENT_WEATHER), "p")
    inner = F.try_variant_get("p.rain", "$.1h", "variant")
    null_key = F.lit(False)
    for key in (F.col("p.visibility"), F.col("p.rain"), F.col("p.wind.deg"), inner):
        null_key |= F.is_variant_null(key)
    req = (~F.coalesce(null_key, F.lit(False)) & F.col("p.main.temp").isNotNull() & F.col("p.main.humidity").isNotNull()
           & F.col("p.main.pressure").isNotNull() & F.col("p.wind.speed").isNotNull()
           & F.get(F.col("p.weather"), 0)["main"].isNotNull() & F.get(F.col("p.weather"), 0)["description"].isNotNull()
           & F.col("p.clouds.all").isNotNull())
    spark = topic.sparkSession
    cat = literal_broadcast(spark.createDataFrame(
        city_catalogue_rows(), "city string, c_country string, c_continent string, c_region string, "
                               "c_lat double, c_lon double"))
    p = p.filter(req).join(cat, "city", "left")
    temp = F.col("p.main.temp")
    return p.select(
        "message_id", "city",
        F.coalesce("c_country", "country").alias("country"),
        F.coalesce("c_continent", "continent").alias("continent"),
        F.coalesce("c_region", "region").alias("region"),
        "state",
        F.coalesce("c_lat", "latitude").alias("latitude"),
        F.coalesce("c_lon", "longitude").alias("longitude"),
        F.round(temp, 2).alias("temperature_fahrenheit"),
        F.round((temp - 32) * 5 / 9, 2).alias("temperature_celsius"),
        F.col("p.main.humidity").alias("humidity_percent"),
        F.col("p.main.pressure").alias("pressure_hpa"),
        F.round("p.wind.speed", 2).alias("wind_speed_mph"),
        F.coalesce(F.try_variant_get("p.wind.deg", "$", "double"), F.lit(0.0)).alias("wind_direction_degrees"),
        F.get(F.col("p.weather"), 0)["main"].alias("weather_condition"),
        F.get(F.col("p.weather"), 0)["description"].alias("weather_description"),
        F.col("p.clouds.all").alias("cloud_cover_percent"),
        F.round(F.coalesce(F.try_variant_get("p.visibility", "$", "double"), F.lit(10000.0)) / METERS_PER_MILE, 2)
         .alias("visibility_miles"),
        F.coalesce(F.try_variant_get("p.rain", "$.1h", "double"), F.lit(0.0)).alias("precipitation_mm"),
        F.col("observed_at").alias("timestamp"))


# --- provider payload: forecast period -------------------------------------------

WIND_MISSING_EVERY = 11
FORECAST_NULLS_EVERY = 13  # every 13th payload keeps null keys
CALM_EVERY = 17            # every 17th payload has a wind without a number


def forecast_period_topic(readings: DataFrame) -> DataFrame:
    rid = F.col("reading_id")
    wind_text = F.when(rid % CALM_EVERY == 0, F.lit("calm")).when(
        rid % WIND_MISSING_EVERY != 0, F.concat(F.floor("wind_speed_mph").cast("bigint").cast("string"), F.lit(" mph")))
    payload = F.struct(
        F.col("temperature_fahrenheit").alias("temperature"), wind_text.alias("windSpeed"),
        F.struct(F.col("humidity_percent").alias("value")).alias("relativeHumidity"),
        F.struct((F.col("pressure_hpa") * 100).alias("value")).alias("barometricPressure"),
        F.col("weather_description").alias("shortForecast"),
        ((F.hour("timestamp") >= 6) & (F.hour("timestamp") < 18)).alias("isDaytime"))
    return readings.select(F.col("reading_id").alias("message_id"), F.col("city").alias("location"),
                           iso("timestamp").alias("observed_at"),
                           F.when(rid % MALFORMED_EVERY == 0, F.lit("{not json"))
                            .when(rid % FORECAST_NULLS_EVERY == 0, F.to_json(payload, {"ignoreNullFields": "false"}))
                            .otherwise(F.to_json(payload)).alias("payload"))


def normalize_forecast_period(topic: DataFrame) -> DataFrame:
    """Forecast period -> simple reading.

    "12 mph" -> 12.0 (first token), no or empty wind -> 0; humidity default 50; pressure default
    1013, and any pressure above 100 is divided by 100 (so the default becomes
    10.13, as in the application); precipitation is 0. Dropped, because the application fails on them:
    malformed messages, a null temperature, a null humidity or pressure object, a wind without a leading number.
    """
    p = parse_once(topic.select("message_id", "location", "observed_at", "payload"),
                   F.from_json("payload", "map<string,string>"), "k")

    def field(name: str, default, value: Column) -> Column:
        return F.when(F.map_contains_key("k", name), value).otherwise(F.lit(default))

    def inner(name: str, default: float) -> Column:
        """``{"value": x}``: the default where the value is missing or null, null where the object is not one."""
        obj = F.col("k")[name]
        x = F.get_json_object(obj, "$.value")
        return field(name, default, F.when(obj.startswith("{"), F.when(x.isNull(), F.lit(default)).otherwise(x.try_cast("double"))))

    ws = F.col("k")["windSpeed"]
    wind = F.when(F.coalesce(ws, F.lit("")) == "", F.lit(0.0)).otherwise(F.split(F.trim(ws), r"\s+", 2)[0].try_cast("double"))
    p = p.filter(F.col("k").isNotNull()).select(
        "message_id", F.col("observed_at").alias("timestamp"), "location",
        field("temperature", 70.0, F.col("k")["temperature"].try_cast("double")).alias("temperature"),
        inner("relativeHumidity", 50.0).alias("humidity"), wind.alias("wind_speed"),
        inner("barometricPressure", 1013.0).alias("pressure"),
        F.lit(0.0).alias("precipitation"),
        field("shortForecast", "", F.col("k")["shortForecast"]).alias("forecast_text"),
        field("isDaytime", True, F.col("k")["isDaytime"].try_cast("boolean")).alias("is_daytime"))
    return (p.dropna(subset=["temperature", "humidity", "wind_speed", "pressure"])
             .withColumn("pressure", F.when(F.col("pressure") > 100, F.col("pressure") / 100).otherwise(F.col("pressure"))))


# --- flat reading topic (what the Bronze stream consumes) -------------------------

ISO_MICRO_SPARK = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
ISO_MICRO_DUCK = "%Y-%m-%dT%H:%M:%S.%f+00:00"


def reading_json_topic(readings: DataFrame) -> DataFrame:
    """Each reading as the 20-field flat JSON message, timestamps as ISO strings with offset."""
    from aerolith.schemas import READING_FIELDS
    cols = []
    for name, _ in READING_FIELDS:
        if name in ("timestamp", "ingestion_timestamp"):
            cols.append(F.date_format(F.col(name), ISO_MICRO_SPARK).alias(name))
        else:
            cols.append(F.col(name))
    return readings.select(F.col("reading_id").alias("message_id"), F.to_json(F.struct(*cols)).alias("value"))

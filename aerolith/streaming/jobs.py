"""Streaming operators.

Sources are anything ``readStream`` can read: the Kafka source in production
(``kafka_source``), a file directory of messages in tests. Sinks are parquet
file sinks with their own checkpoints, which gives exactly-once output per sink
and lets a restarted job (or a lost executor) resume from committed offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.schemas import READING
from aerolith.sources import payloads

BRONZE_TRIGGER = "30 seconds"


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Subscribe from the earliest offsets, tolerating data loss (needs the Kafka connector jar).

    ``max_offsets_per_trigger`` bounds a micro-batch, so a backlog (first start
    from the earliest offsets, or a restart after an outage) is drained in
    batches of a known size instead of one batch holding the whole topic.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", "earliest")
         .option("failOnDataLoss", "false"))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return payloads.envelope(r.load())


def file_source(spark: SparkSession, path: str, schema: str = "message_id long, value string",
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def decode_reading_json(messages: DataFrame) -> DataFrame:
    """value (flat reading JSON) -> 20 typed columns; undecodable messages dropped."""
    parsed = payloads.parse_once(messages.select("value"),
                                 payloads.parse_json(F.col("value").cast("string"), READING), "data")
    return parsed.filter(payloads.well_formed("data")).select(*[f"data.{f.name}" for f in READING.fields])


REGISTRY_HEADER = 5  # bytes before the Avro body of a message that a schema registry has framed


def decode_reading_avro(schema: str, from_avro=None):
    """Decoder of Avro values (``schema``: the JSON text of the reading's schema); needs the spark-avro package.

    Producers send a bare Avro body or one behind the registry's 5-byte header. Each value is decoded as it is; only where that
    gives no reading (undecodable, or no city: the header's leading zero byte reads as an empty one) it is decoded again
    without its first five bytes. A value that gives no reading either way is dropped.

    ``from_avro(column, schema, options)`` can be given in place of Spark's, as the tests do.
    """
    def decode(messages: DataFrame) -> DataFrame:
        read = from_avro
        if read is None:
            from pyspark.sql.avro.functions import from_avro as read
        options = {"mode": "PERMISSIVE"}
        bare = payloads.parse_once(messages.select("value"), read(F.col("value"), schema, options), "bare")
        body = F.substring("value", REGISTRY_HEADER + 1, 2**31 - 1)
        # evaluated for the values that are no bare reading alone
        chosen = F.when(is_reading("bare"), F.col("bare")).otherwise(read(body, schema, options))
        parsed = payloads.parse_once(bare, chosen, "data")
        return parsed.filter(is_reading("data")).select(*[f"data.{f.name}" for f in READING.fields])

    def is_reading(data: str):
        return F.coalesce(F.col(f"{data}.city") != "", F.lit(False))

    return decode


def bronze(decoded: DataFrame) -> DataFrame:
    """Stamp load time and the partition column (date of the reading timestamp).

    Timestamps are ISO-8601 strings in UTC, so the date is their first ten
    characters: independent of the session time zone and of parser policies.
    """
    return (decoded.withColumn("bronze_loaded_at", F.current_timestamp())
                   .withColumn("ingestion_date", F.try_to_date(F.substring("timestamp", 1, 10), "yyyy-MM-dd")))


def start_parquet_sink(df: DataFrame, path: str, checkpoint: str, partition_by: str | None = None,
                       trigger: dict | None = None):
    w = (df.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if partition_by:
        w = w.partitionBy(partition_by)
    trig = trigger or {"processingTime": BRONZE_TRIGGER}
    return w.trigger(**trig).start()


def start_bronze_stream(spark: SparkSession, source: DataFrame, path: str, checkpoint: str,
                        trigger: dict | None = None, decoder=decode_reading_json):
    """Messages -> ``decoder`` (JSON, or ``decode_reading_avro``) -> Bronze files by date."""
    return start_parquet_sink(bronze(decoder(source)), path, checkpoint, "ingestion_date", trigger)


def start_processor_stream(spark: SparkSession, source: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """The JSON processor, writing the raw and the processed table together.

    One query reads and parses each message once, turns it into its raw row and its processed row (where it has one), and
    writes both with one file sink, partitioned by ``kind``. The sink commits a micro-batch's files in one entry of its log, so a reader
    sees a message's two rows or neither, also between batches and after a restart, and a replayed batch is not written twice.
    ``processed_at`` stamps processing time.
    """
    rows = payloads.raw_and_processed(source).withColumn("processed_at", F.when(F.col("kind") == payloads.PROCESSED, F.current_timestamp()))
    return start_parquet_sink(rows, path, checkpoint, "kind", trigger)


def raw_table(spark: SparkSession, path: str) -> DataFrame:
    """Committed raw rows of :func:`start_processor_stream`."""
    return spark.read.parquet(path).filter(F.col("kind") == payloads.RAW).select(*payloads.RAW_COLUMNS)


def processed_table(spark: SparkSession, path: str) -> DataFrame:
    """Committed processed rows of :func:`start_processor_stream`."""
    return spark.read.parquet(path).filter(F.col("kind") == payloads.PROCESSED).select(*payloads.PROCESSED_COLUMNS, "processed_at")

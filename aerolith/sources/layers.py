"""Layer IO: parquet layers, the warehouse sink and landing folders for stream twins."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aerolith.session import scratch_path


class LayerMissing(FileNotFoundError):
    pass


def read_layer(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a parquet layer; fail clearly when it is missing or empty.

    Emptiness is probed with ``isEmpty()`` (reads at most one row), never ``count()``.
    """
    try:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        df = r.parquet(path)
    except AnalysisException as e:  # path does not exist / cannot infer schema
        raise LayerMissing(f"layer not found or unreadable: {path}") from e
    if df.isEmpty():
        raise LayerMissing(f"layer is empty: {path}")
    return df


def write_layer(df: DataFrame, path: str, partition_by: str = "reading_date") -> int:
    """Overwrite a layer partitioned by date; the rows written, noted on the way. With dynamic partition overwrite (session
    default here) only the dates present in ``df`` are replaced, so reruns are idempotent.

    The rows are rebalanced on the partition column first: otherwise every task
    of the preceding shuffle writes one file per date it holds (tasks x dates
    small files). With AQE the rebalance sizes write tasks toward the advisory
    partition size, splitting a hot date over several tasks and merging small ones.
    """
    noted = Observation()
    (df.hint("rebalance", partition_by).observe(noted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "snappy")
       .partitionBy(partition_by).parquet(path))
    return noted.get["rows"]


def warehouse_sink(df: DataFrame, url: str | None = None, table: str | None = None,
                   path: str | None = None, batch_size: int = 200, properties: dict | None = None) -> None:
    """Truncate-and-load the fact table: JDBC when a URL is given, else parquet at ``path``."""
    if url:
        (df.write.mode("overwrite").option("truncate", "true").option("batchsize", batch_size)
           .jdbc(url, table, properties=properties or {}))
    else:
        df.write.mode("overwrite").parquet(path)


def fresh_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt over as many parts as the session shuffles to, whatever the number of its scan tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def land(df: DataFrame, name: str, records_per_file: int | None = None) -> str:
    """Write a message DataFrame as parquet, a file-source stand-in for a topic: one file per
    input partition, or several where ``records_per_file`` bounds them."""
    path = fresh_path(df.sparkSession, f"landing/{name}")
    w = df.write.option("maxRecordsPerFile", records_per_file) if records_per_file else df.write
    w.parquet(path)
    return path

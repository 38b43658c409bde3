"""Reading the driver tables and cutting lineage with written tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from aerolith.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    The written table outlives lost executors and is read, not recomputed, by
    every later use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blocks(total: int, per_block: int) -> int:
    """Number of blocks of about ``per_block`` units that hold ``total`` units."""
    return max(1, -(-int(total or 0) // per_block))

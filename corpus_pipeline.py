"""From raw documents to packed training sequences, stage by stage.

Each stage takes what the stage before it kept (written as Parquet and read again) and
its decisions take effect; all but the last return the columns of ``documents``.

Defined cases: a null or empty text is scored, kept or rejected, and mixed like any other (size 0: taken as often as its
source's whole epochs say) and packs as its end token alone; without labels every text scores 0.5 and is kept; rows without an id lose
repeated lines, are copies of each other where their shingles are equal, and pack like others; rows that share an id are judged
by id and text; equal rows with an id stay together or go together; columns beside id, text, source and ``n_chars`` (which follows the text)
are passed through, whatever their names; an empty table gives no rows at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import line_dedup, mixing, ngram_join, packing, quality
from aerolith.llm.store import keep, read


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score 0.5 or more)."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without their repeated lines; ``n_chars`` follows the text."""
    left = line_dedup.dedup_lines(docs, counts=False)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast("long"))
    return left.select(*docs.columns)


def keep_one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group of near-duplicate documents."""
    return ngram_join.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [("quality classifier", keep_good), ("line dedup", drop_repeated_lines), ("n-gram jaccard join", keep_one_per_group),
          ("mixing sources", mix_sources), ("packing", pack_sequences)]

#: The quality model and the tokenizer have no SQL form; tests/llm/test_models.py checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs

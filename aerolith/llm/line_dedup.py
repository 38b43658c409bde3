"""Line de-duplication over all documents (DataFrame functions only).

The key of a line is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
lower-cased. Lines travel as two 64-bit hashes of their key with document and
position, never as text: they are range-partitioned by key and sorted by key, document (largest first) and position, and
the sorted partitions are read as streams: the first row of a key is its first occurrence in the largest ``doc_id``, which keeps its
lines; counting the changes of document tells in how many documents the key occurs; a key in ``min_docs`` documents or more
loses its lines in all others. No hash exchange or join follows for the keys.

A key that holds more than about a quarter of a partition's share of all lines is split by document into pieces with a range of their own
(``piece``), so that no key has to fit in a task; the first rows of its pieces, one per piece, are added up and sent back to the lines of these few
keys. Which keys are split is told by a sample and changes the sizes of the ranges alone, never the result.

The result is a compressed keep bitmap per document: 64-bit words of keep bits, words that keep all 64 lines left out.

Defined cases: null or empty text is one empty line; keys under ``min_chars`` code
points are never dropped; a null ``doc_id`` counts as no document and keeps no repeated
line; rows with equal id and text share one bitmap; other columns are passed through
(those named like an added count are replaced); an empty table gives no bitmaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.store import keep

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(BLANKS))
    # lower() and the A-Z translation agree on ASCII strings
    return (F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare))
            .otherwise(F.translate(bare, UPPER, LOWER)))


def text_id(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


SAMPLE = 400  # sampled lines per partition; a key with a quarter of a partition's share has 100 of them


def keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``h1, h2, doc_id, text_id, pos, row`` of every line whose key is long enough; ``row`` only tells rows apart."""
    return (docs.select("doc_id", text_id(F.col("text")).alias("text_id"), F.monotonically_increasing_id().alias("row"),
                        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
            .select("doc_id", "text_id", "row", "pos", line_key(F.col("line")).alias("key"))
            .filter(F.char_length("key") >= min_chars)
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "text_id", "pos", "row"))


def frequent_keys(lines: DataFrame, parts: int) -> DataFrame:
    """``h1, h2`` of keys with more than about a quarter of a partition's lines: at most some ``8 * parts`` of them."""
    share = min(1.0, SAMPLE * parts / max(1, lines.count()))
    return (lines.select("h1", "h2").sample(share, seed=1).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > SAMPLE // 8).select("h1", "h2"))


def streamed(lines: DataFrame, frequent: DataFrame, parts: int) -> DataFrame:
    """Every line with what its key's (or, of a split key, its piece's) sorted run tells: ``first`` (document and position
    of the run's first line), ``docs`` (documents of the run), ``is_first``."""
    pieces = F.when(F.col("split"), F.pmod(F.xxhash64(F.coalesce("doc_id", "row")), F.lit(parts)) + 1).otherwise(F.lit(0))
    cut = lines.join(F.broadcast(frequent.withColumn("split", F.lit(True))), ["h1", "h2"], "left").withColumn("piece", pieces)  # 8 * parts keys at most
    order = [F.desc_nulls_last("doc_id"), F.asc("pos")]
    ranged = cut.drop("split", "row").repartitionByRange("h1", "h2", "piece").sortWithinPartitions("h1", "h2", "piece", *order)
    # the windows ask for no more than the order the ranges are sorted in, so they read them as they are
    run = Window.partitionBy("h1", "h2", "piece")
    along = run.orderBy(*order)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.col("doc_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.lag("doc_id").over(along))
    return (ranged.withColumn("other", other.cast("int")).withColumn("is_first", F.row_number().over(along) == 1)
            .withColumn("first", F.first(F.struct("doc_id", "pos")).over(whole)).withColumn("docs", F.sum("other").over(whole)).drop("other"))


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, text_id, n_dropped, keep: array<struct<word, bits>>`` of documents that lose lines."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = keep(keyed_lines(docs, min_chars), "lines")
    frequent = keep(frequent_keys(lines, parts), "frequent-lines")
    split, loses = F.col("piece") > 0, ~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    judged = keep(streamed(lines, frequent, parts).filter(split | (F.col("docs") >= min_docs) & loses), "repeated-lines")
    pieces = (judged.filter(split & F.col("is_first")).groupBy("h1", "h2")
              .agg(F.sum("docs").alias("all_docs"), F.max("first.doc_id").alias("keeper")).filter(F.col("all_docs") >= min_docs))
    told = judged.filter(split).join(F.broadcast(pieces), ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))  # as many as split keys
    dropped = judged.filter(~split).select("doc_id", "text_id", "pos").unionByName(told.select("doc_id", "text_id", "pos"))
    words = (dropped.groupBy("doc_id", "text_id", (F.col("pos") / 64).cast("int").alias("word"))
             .agg(F.expr("~bit_or(shiftleft(1L, pos % 64))").alias("bits")))
    return (words.groupBy("doc_id", "text_id")
            .agg(F.sum(F.bit_count(F.bitwise_not("bits"))).alias("n_dropped"), F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("keep")))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, counts: bool = True) -> DataFrame:
    """``docs`` with ``text`` reduced to kept lines; with ``counts`` also ``n_lines`` and ``n_dropped``."""
    rows = docs.select(F.struct("*").alias("row")).withColumn("text_id", text_id(F.col("row.text")))
    b = bitmaps.withColumnRenamed("doc_id", "id")
    joined = rows.join(b, F.col("row.doc_id").eqNullSafe(F.col("id")) & (rows["text_id"] == b["text_id"]), "left")
    gone = F.expr("flatten(transform(keep, w -> filter(sequence(w.word * 64, w.word * 64 + 63),"
                  " p -> (shiftright(w.bits, p % 64) & 1L) = 0L)))")
    whole = F.coalesce("row.text", F.lit(""))
    lines = lines_of(whole)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    kept = F.when(F.col("keep").isNull(), whole).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    breaks = F.char_length(whole) - F.char_length(F.replace(whole, F.lit("\n"), F.lit("")))
    added = {"n_lines": (breaks + 1).cast("long"), "n_dropped": F.coalesce("n_dropped", F.lit(0)).cast("long")} if counts else {}
    return joined.select(*[kept.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns if c not in added],
                         *[column.alias(name) for name, column in added.items()])


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, counts: bool = True) -> DataFrame:
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs), counts)

"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target is its share of all words by weight, at most ``max_epochs`` times
its size, the excess reshared by weight among the others. Each source takes whole
epochs while they fit its target; the rest is a fractional epoch: documents get
the key ``-ln(u) / quality`` (smaller first), ``u`` drawn from a seeded hash of the id,
and are taken in key order while their running size stays within the rest of the target.

Only whole documents are taken, so a long one at the border could leave a wide gap. A second
pass therefore goes on, in key order, among the untaken documents that fit the gap, and one closing document of the
size nearest to what is then left is taken if that brings the source nearer to its target.

The running sum never sorts one source in one task: the documents are range-partitioned by source and key into bins
of about ``BIN_ROWS`` (bounds from a sample of the keys as they are, so any weights give even bins), bins
are summed first, and rows are only ordered within their bin. The bins are written once, so that all passes see the same ones.

Defined cases: null text has size 0; a null source is a source of its own, sorted
last; rows with equal id, source and text are one unit, taken or left together; a
missing, null or non-positive quality weight counts as ``LEAST_WEIGHT``; ties in the key go to the
smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.llm.store import blocks, keep

BIN_ROWS = 20_000
MAX_BINS = 100_000  # more documents make larger bins
PASSES = 2
LEAST_WEIGHT = 1e-3
WORD = r"[^\x20\x09-\x0D]+"


def text_weight() -> Column:
    """Default quality weight: 1 at a mean word length of 6 characters, falling off on both sides."""
    mean = F.try_divide(F.col("chars").cast("double"), F.col("size"))  # null without words
    return F.lit(1.0) / (F.lit(1.0) + F.abs(mean - F.lit(6.0)) / F.lit(6.0))


def uniform(seed: int, *cols: str) -> Column:
    """(0, 1) from 52 bits of a hash; the same on every run."""
    text = F.concat(F.lit(f"{seed}:"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """``source, source_size, rows, weight, target`` from one row per source.

    ``sizes`` has one row per source (source, source_size, rows). With ``k`` sources
    capped, the uncapped share one level of words per weight; sorted by how
    early they cap, the first ``k`` whose next source stays below its cap is the end of the resharing.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = sizes.select("*", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                       ((F.row_number().over(order) - 1) % len(weights) + 1)).alias("weight"))
    cap = F.col("source_size") * max_epochs
    caps = Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = caps.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    w = w.select("*", level.alias("level"), cap.alias("cap"))
    ends = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level")))
    end = w.agg(ends.alias("e")).select(F.col("e.level").alias("final"))
    return (w.crossJoin(end)  # one row
            .select("source", "source_size", "rows", "weight",
                    F.least(F.coalesce(F.col("final") * F.col("weight"), F.lit(0.0)), F.col("cap").cast("double")).alias("target")))


def binned(units: DataFrame, rows: int) -> DataFrame:
    """``units`` with ``bin``, which never falls along the key order of a source."""
    bins = min(MAX_BINS, blocks(rows, BIN_ROWS))
    ranged = units.repartitionByRange(bins, F.col("source").isNull(), F.col("source"), F.col("key"), F.col("doc_id"), F.col("text_id"))
    return keep(ranged.withColumn("bin", F.spark_partition_id()), "mix-bins")


def _gaps(u: DataFrame) -> DataFrame:
    """``_g, gap``: words that each source's fractional epoch still lacks."""
    rest = F.max(F.col("target") - F.col("epochs") * F.col("source_size"))
    return (u.groupBy("source").agg((rest - F.sum(F.when(F.col("taken"), F.col("total")).otherwise(0))).alias("gap"))
            .select(F.col("source").alias("_g"), "gap"))


def _fill(u: DataFrame) -> DataFrame:
    """Takes, in key order, untaken units that fit their source's gap, while their running size does."""
    u = u.join(_gaps(u), F.col("source").eqNullSafe(F.col("_g"))).drop("_g")
    fits = ~F.col("taken") & (F.col("gap") > 0) & (F.col("total") <= F.col("gap"))
    u = u.withColumn("part", F.when(fits, F.col("total")).otherwise(F.lit(0)))
    bins = u.groupBy("source", "bin").agg(F.sum("part").alias("words"))
    ahead = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(F.col("source").alias("_bs"), F.col("bin").alias("_b"),
                       F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    within = (Window.partitionBy("source", "bin").orderBy("key", "doc_id", "text_id")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = u.withColumn("upto", F.sum("part").over(within))
    run = run.join(bins, F.col("source").eqNullSafe(F.col("_bs")) & (F.col("bin") == F.col("_b"))).drop("_bs", "_b")
    return (run.withColumn("taken", F.col("taken") | (fits & (F.col("ahead") + F.col("upto") <= F.col("gap"))))
            .drop("gap", "part", "ahead", "upto"))


def _close(u: DataFrame) -> DataFrame:
    """Takes one more unit per source: the untaken one of the size nearest to the gap, if it makes the gap smaller."""
    off = F.abs(F.col("total") - F.col("gap"))
    last = (u.filter("not taken and total > 0").join(_gaps(u), F.col("source").eqNullSafe(F.col("_g")))
            .filter(off < F.col("gap"))
            .groupBy("_g").agg(F.min(F.struct(off.alias("off"), "key", "doc_id", "text_id")).alias("c")))
    u = u.join(last, F.col("source").eqNullSafe(F.col("_g")), "left")
    closing = F.col("doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("text_id") == F.col("c.text_id"))
    return u.withColumn("taken", F.col("taken") | F.coalesce(closing, F.lit(False)))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 7,
        quality: str | None = None) -> DataFrame:
    """How often the mix takes each unit: ``doc_id, source, text_id, rows, size, source_size, target, copies``.

    ``rows`` counts the equal rows of a unit; ``size`` is that of one row. ``quality``
    names a column of weights; without it ``text_weight`` of the text is used.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", "source", F.xxhash64(text).alias("text_id"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                       F.char_length(text).alias("chars"),
                       (F.col(quality) if quality else F.lit(None)).cast("double").alias("given"))
    weight = F.col("given") if quality else text_weight()
    units = (base.groupBy("doc_id", "source", "text_id")
             .agg(F.count(F.lit(1)).alias("rows"), F.first("size").alias("size"), F.first("chars").alias("chars"),
                  F.max("given").alias("given"))
             .select("doc_id", "source", "text_id", "rows", "size",
                     F.when(weight > LEAST_WEIGHT, weight).otherwise(F.lit(LEAST_WEIGHT)).alias("w"))
             .select("doc_id", "source", "text_id", "rows", "size",
                     (-F.ln(uniform(seed, "doc_id")) / F.col("w")).alias("key")))
    units = keep(units, "mix")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"),
                                        F.count(F.lit(1)).alias("rows"))
    plan = source_targets(sizes, weights, max_epochs)
    plan = keep(plan.select(
        F.col("source").alias("_s"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).alias("epochs")), "mix-plan")
    u = (units.join(plan, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
         .withColumn("total", F.col("size") * F.col("rows")).withColumn("taken", F.lit(False)))
    u = binned(u, units.count())
    for _ in range(PASSES):
        u = keep(_fill(u), "mix-taken")
    return (_close(u).select("doc_id", "source", "text_id", "rows", "size", "source_size", "target",
                             (F.col("epochs") + F.col("taken").cast("int")).cast("long").alias("copies")))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    m = mix(docs, **settings).filter("copies > 0").select("doc_id", "source", "text_id", "copies")
    rows = docs.select(F.struct("*").alias("row")).withColumn("h", F.xxhash64(F.coalesce("row.text", F.lit(""))))
    return (rows.join(m, F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & F.col("row.source").eqNullSafe(F.col("source"))
                      & (F.col("h") == F.col("text_id")))
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*"))

"""Filter interaction audit: what five filters remove, alone, together and in every order.

A counting-Bloom prepass finds the texts that can have a twin. A task counts its texts' hashes in cells of a sketch and
sends, per slice of ``SLICE`` cells, the cells it has seen once and those it has seen more often; a slice adds up what all tasks say, message
by message, and keeps one bit per cell: "seen more than once". A text with a cell that was seen once is unique and stays
where it is. The merged bits have at most ``MAX_CELLS / 8`` bytes whatever the input, so they may be broadcast; where texts outnumber
the cells, fewer are cleared and the result is the same. Only texts that are not cleared are shuffled, whole, to
find the smallest id of each text; partial aggregation sends a text once per task, so a text that a third of the rows
hold is no hot group.

A row's failures are a mask of five bits. Masks are counted per part with the labels joined in; counts of masks add
up, and all 120 orders, their steps and the Shapley share come from the at most 32 counts of a part.

Defined cases: null text is empty (so empty and null texts are copies of each other); null ``lang`` is the part ``''``; a row
without an id never fails E and is no smaller id to others; rows that repeat an id count one by one; a label
counts once per row of its document, and as 1 if any label row of the id says 1; other columns are ignored; an empty table has no parts and gives no rows.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.store import keep

FILTERS = "ABCDE"
HASHES = 3
CELLS_PER_TEXT = 16
MAX_CELLS = 1 << 30
SLICE = 1 << 20
FLUSH = 1 << 20  # texts that a task counts before it sends

UPPERCASE = bytes(range(65, 91))
MARKS = b"#$%&*|"


def cells_for(rows: int) -> int:
    """Cells of the sketch for ``rows`` texts: a power of two, ``MAX_CELLS`` at most."""
    return min(MAX_CELLS, max(SLICE, 1 << (CELLS_PER_TEXT * max(1, rows) - 1).bit_length()))


def places(hashes: np.ndarray, cells: int) -> np.ndarray:
    """The ``HASHES`` cells of every hash, one row each."""
    h = hashes.astype(np.int64).view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(h + np.uint64(i) * step) & np.uint64(cells - 1) for i in range(HASHES)], axis=1).astype(np.int64)


def text_hash():
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")


def repeated_cells(docs: DataFrame, cells: int) -> DataFrame:
    """``slice, bits``: which cells of the merged counting sketch were seen more than once."""
    def counted(hashes):
        at, n = np.unique(places(np.concatenate(hashes), cells).ravel(), return_counts=True)
        edges = np.r_[np.flatnonzero(np.r_[True, at[1:] // SLICE != at[:-1] // SLICE]), len(at)]
        spans = [(int(i), int(j)) for i, j in zip(edges[:-1], edges[1:])]
        local = (at % SLICE).astype(np.uint32)
        return pa.RecordBatch.from_arrays([
            pa.array([int(at[i]) // SLICE for i, _ in spans], pa.int32()),
            pa.array([local[i:j][n[i:j] == 1].tobytes() for i, j in spans], pa.binary()),
            pa.array([local[i:j][n[i:j] > 1].tobytes() for i, j in spans], pa.binary())], names=["slice", "once", "more"])

    def count(batches):
        held, size = [], 0
        for b in batches:
            held.append(b.column(0).to_numpy())
            size += b.num_rows
            if size >= FLUSH:
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)

    def merge(batches):
        # rows arrive by slice: one slice's counters are held at a time
        now, seen = None, np.zeros(SLICE, np.uint8)

        def told():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(seen > 1).tobytes()], pa.binary())],
                                              names=["slice", "bits"])

        for b in batches:
            for r in b.to_pylist():
                if r["slice"] != now:
                    if now is not None:
                        yield told()
                    now, seen[:] = r["slice"], 0
                once = np.frombuffer(r["once"], np.uint32)
                seen[once] = np.minimum(seen[once] + 1, 2)
                seen[np.frombuffer(r["more"], np.uint32)] = 2
        if now is not None:
            yield told()

    return (docs.select(text_hash()).mapInArrow(count, "slice int, once binary, more binary")
            .repartitionById(cells // SLICE, F.col("slice")).sortWithinPartitions("slice")
            .mapInArrow(merge, "slice int, bits binary"))


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask, text``: bits of A to D per row; ``text`` only where it may have a twin."""
    spark = docs.sparkSession
    cells = cells_for(docs.count())
    bits = np.zeros(cells // 8, np.uint8)
    for r in repeated_cells(docs, cells).toLocalIterator():
        bits[r.slice * SLICE // 8:(r.slice + 1) * SLICE // 8] = np.frombuffer(r.bits, np.uint8)
    merged = spark.sparkContext.broadcast(bits)

    def mask(text: str) -> int:
        raw = text.encode()
        ws = raw.split()
        n, chars = len(ws), len(text)
        return ((n < 200) | (100 * len(set(ws)) < 50 * n) << 1 | (100 * (len(raw) - len(raw.translate(None, UPPERCASE))) > 3 * chars) << 2
                | (len(raw) != len(raw.translate(None, MARKS))) << 3)

    def judge(batches):
        seen = merged.value
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            at = places(b.column("h").to_numpy(), cells)
            twin = ((seen[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1).tolist() if b.num_rows else []
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("part"), pa.array([mask(t) for t in texts], pa.int32()),
                pa.array([t if may else None for t, may in zip(texts, twin)], pa.string())], names=["doc_id", "part", "mask", "text"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("part"), F.col("text"), text_hash())
    return rows.mapInArrow(judge, "doc_id bigint, part string, mask int, text string")


def masks(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask``: the failures of every row as bits, A lowest."""
    rows = keep(failures(docs), "filter-failures")
    may = rows.filter("text IS NOT NULL")
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    smallest = (may.groupBy("text").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
                .filter("n > 1").select(digest, "least"))
    # the group was made by the whole text; its digest only brings the answer back to the rows
    told = (may.select("doc_id", "part", "mask", digest).join(smallest, "digest", "left")
            .select("doc_id", "part", (F.col("mask") + F.when(F.col("doc_id") > F.col("least"), 16).otherwise(0)).alias("mask")))
    return rows.filter("text IS NULL").select("doc_id", "part", "mask").unionByName(told)


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: rows per part and set of failures, with the good and the toxic ones among them."""
    marks = (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    return (masks(docs).join(marks, "doc_id", "left").groupBy("part", "mask")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).cast("long").alias("good"),
                 F.sum(F.coalesce("toxic", F.lit(0))).cast("long").alias("toxic")))


def steps() -> list[tuple[str, int, int, int]]:
    """``(order, step, bit, bits before)`` of all orders."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for i, name in enumerate(order):
            bit = 1 << FILTERS.index(name)
            out.append(("".join(order), i + 1, bit, before))
            before |= bit
    return out


def report(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from ``mask_counts``."""
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("c"))
    every = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(p).alias("before"))
                      for o, s, b, p in steps()])
    rows = per_part.withColumn("s", F.explode(every)).select("part", "c", "s.*")

    def total(what: str, when: str):
        return F.expr(f"aggregate(filter(c, m -> {when}), 0L, (t, m) -> t + {what})")

    fails, passed = "(m.mask & bit) <> 0", "(m.mask & before) = 0"
    return rows.select(
        "part", "filter_order", "step",
        total("m.n", "(m.mask & (before | bit)) = 0").alias("kept"), total("m.n", f"{fails} AND {passed}").alias("removed"),
        total("m.n", f"{fails} AND NOT {passed}").alias("redundant"), total("m.n", "m.mask = bit").alias("unique_fails"),
        total("m.good", f"{fails} AND {passed}").alias("good_lost"), total("m.toxic", f"{fails} AND {passed}").alias("toxic_lost"),
        # of the 120 orders, each of a row's failing filters comes first equally often
        total("m.n * (120L div bit_count(m.mask))", fails).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return report(mask_counts(docs, labels))

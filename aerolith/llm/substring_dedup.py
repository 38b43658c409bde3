"""Exact substring de-duplication by level-wise doubling.

Repeated word windows are found level by level: a window is only asked about if the
windows of the level before that it is made of repeat. The first level asks about
anchors alone: of the ``FIRST`` consecutive runs of ``FIRST`` words inside each window of
``2 * FIRST - 1`` words, the run with the smallest hash. Equal windows have equal anchors, so a window repeats only if
its anchor does, and a text has about one anchor per four words. Surviving anchors are extended
to that twofold window (13 words for ``FIRST`` = 7); windows that survive there are extended to twice their
length (26, 52, ...) while ``longest`` allows and any candidate is left.

A level's candidates are recomputed from the text and the answers to the earlier levels
(``exchange``), so nothing of the size of the corpus is kept between levels but answers.

Defined cases: null text has no words; texts under one window are kept whole; windows are
judged on the input; a null ``doc_id`` counts as the largest id; rows with
equal ids are one document and never remove each other's words; words are joined by single
blanks in the result; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm import exchange
from aerolith.llm.store import blocks
from aerolith.llm.text import distinct, hashes, runs, words

FIRST = 7
LAST_ID = np.iinfo(np.int64).max

RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])
RESULT_DDL = "doc_id bigint, n_words bigint, n_removed bigint, text string"


class Batch:
    """The documents of a batch as one run of word hashes."""

    def __init__(self, docs: pa.Table):
        self.ids = docs["doc_id"].fill_null(LAST_ID).to_numpy()
        self.null = docs["doc_id"].is_null().to_numpy()
        self.words = [words(t) for t in docs["text"].to_pylist()]
        self.lengths = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.ends = np.cumsum(self.lengths)
        self.h = np.concatenate([hashes(w) for w in self.words]) if self.words else np.empty(0, np.uint64)
        self.doc = np.repeat(np.arange(len(self.words)), self.lengths)
        self.room = np.repeat(self.ends, self.lengths) - np.arange(len(self.h))  # words from here to the document's end

    def anchors(self, first: int) -> np.ndarray:
        """Anchor position of every window of ``2 * first - 1`` words, -1 where no window starts."""
        n = max(0, len(self.h) - 2 * first + 2)
        at = np.full(len(self.h), -1)
        if n:
            r = runs(self.h, first)
            best, ahead = r[:n].copy(), np.zeros(n, np.int8)
            for j in range(1, first):
                less = r[j:j + n] < best
                np.copyto(best, r[j:j + n], where=less)
                np.copyto(ahead, j, where=less)
            at[:n] = np.where(self.room[:n] >= 2 * first - 1, np.arange(n) + ahead, -1)
        return at

    def windows(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and document id of the windows that start at ``at``."""
        return runs(self.h, length)[at] if len(at) else np.empty(0, np.uint64), self.ids[self.doc[at]]


def replay(b: Batch, told: pa.Table, first: int, levels: int):
    """Candidates of level ``levels``: start positions, keys, ids and the length of the windows."""
    anchor = b.anchors(first)
    starts = np.flatnonzero(np.bincount(anchor[anchor >= 0], minlength=len(b.h)))
    keys, ids = b.windows(starts, first)
    length = first
    for level in range(levels):
        totals, _ = exchange.answers(told, level)
        alive = np.zeros(len(b.h), bool)
        alive[starts] = totals[np.searchsorted(distinct(keys), keys)] >= 2 if len(keys) else False
        if level == 0:
            longer = 2 * first - 1
            starts = np.flatnonzero((anchor >= 0) & alive[anchor])
        else:
            longer = 2 * length
            starts = starts[alive[starts]]
            starts = starts[b.room[starts] >= longer]
            starts = starts[alive[starts + length]]
        length = longer
        keys, ids = b.windows(starts, length)
    return starts, keys, ids, length



def ask(batched: DataFrame, told: DataFrame | None, level: int, buckets: int, first: int) -> DataFrame:
    """Answers of all levels up to ``level``."""
    def send(key, docs, side):
        b = Batch(docs)
        _, keys, ids, _ = replay(b, side, first, level)
        return exchange.messages(key[0].as_py(), level, exchange.tally(keys, ids), buckets, level > 0)

    if told is None:
        def start(key, docs):
            return send(key, docs, exchange.ANSWER.empty_table())
        return exchange.resolve(batched.groupBy("batch").applyInArrow(start, exchange.MESSAGE_DDL))
    sent = batched.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(send, exchange.MESSAGE_DDL)
    return told.unionByName(exchange.resolve(sent))


def remove_repeats(docs: DataFrame, first: int = FIRST) -> DataFrame:
    """``doc_id, n_words, n_removed, text``: words in windows of ``2 * first - 1`` words that a smaller id has are gone."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    batched = exchange.deal(docs, blocks(size, exchange.BATCH_BYTES))
    buckets = blocks(size, exchange.BUCKET_BYTES)
    told = ask(batched, ask(batched, None, 0, buckets, first), 1, buckets, first)

    def finish(docs, side):
        b = Batch(docs)
        starts, keys, ids, length = replay(b, side, first, 1)
        _, least = exchange.answers(side, 1)
        hit = starts[least[np.searchsorted(distinct(keys), keys)] < ids] if len(keys) else starts
        edge = np.zeros(len(b.h) + 1, np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        removed = np.bincount(b.doc[gone], minlength=len(b.words))
        texts = []
        for ws, end, n in zip(b.words, b.ends.tolist(), removed.tolist()):
            kept = ws if not n else [w for w, g in zip(ws, gone[end - len(ws):end].tolist()) if not g]
            texts.append(b" ".join(kept).decode())
        return pa.Table.from_arrays([pa.array(b.ids, mask=b.null), pa.array(b.lengths), pa.array(removed.astype(np.int64)),
                                     pa.array(texts, pa.string())], schema=RESULT)

    return batched.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(finish, RESULT_DDL)


def repeated_windows(docs: DataFrame, first: int = FIRST, longest: int | None = None) -> DataFrame:
    """``doc_id, start, length, documents``: per level, the windows that repeat in several documents.

    Levels are asked one by one until none has a candidate or the next length passes ``longest`` (if given); each level's
    answers are written before the next is asked.
    """
    from aerolith.llm.store import keep
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    batched = exchange.deal(docs, blocks(size, exchange.BATCH_BYTES))
    buckets = blocks(size, exchange.BUCKET_BYTES)
    told, level, length = keep(ask(batched, None, 0, buckets, first), "windows-0"), 1, 2 * first - 1
    while longest is None or length <= longest:
        more = keep(ask(batched, told, level, buckets, first), f"windows-{level}")
        if more.filter(F.col("level") == level).isEmpty():
            break
        told, level, length = more, level + 1, 2 * length
    levels = level

    def spans(docs, side):
        b, found = Batch(docs), []
        for k in range(1, levels):
            starts, keys, ids, length = replay(b, side, first, k)
            totals, _ = exchange.answers(side, k)
            n = totals[np.searchsorted(distinct(keys), keys)] if len(keys) else np.empty(0, np.uint32)
            base = (b.ends - b.lengths)[b.doc[starts]]
            found.append(np.stack([ids, starts - base, np.full(len(starts), length), n])[:, n >= 2].astype(np.int64))
        cols = np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)
        return pa.table({c: pa.array(v) for c, v in zip(("doc_id", "start", "length", "documents"), cols)})

    return (batched.groupBy("batch").cogroup(told.groupBy("batch"))
            .applyInArrow(spans, "doc_id bigint, start bigint, length bigint, documents bigint"))

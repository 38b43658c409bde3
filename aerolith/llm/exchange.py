"""Questions about keys that all documents share, asked in packed messages.

Documents are dealt into batches of bounded text by a hash. A batch sends each of its
distinct keys once, sorted, cut into messages by key range (bucket); a bucket adds up what all
batches say about a key and answers every message in kind. So a key held by a third of all
documents is one entry per batch, and no group grows with it; keys travel as
eight packed bytes. A batch gets its answers aligned with its own sorted distinct keys, whatever the order its
rows arrive in.

``tally`` is the map-side sum: documents per key and, where asked, the smallest document id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20

MESSAGE = pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("level", pa.int32()), ("keys", pa.binary()),
                     ("counts", pa.binary()), ("least", pa.binary())])
MESSAGE_DDL = "bucket int, batch int, level int, keys binary, counts binary, least binary"
ANSWER = pa.schema([("batch", pa.int32()), ("bucket", pa.int32()), ("level", pa.int32()), ("totals", pa.binary()),
                    ("least", pa.binary())])
ANSWER_DDL = "batch int, bucket int, level int, totals binary, least binary"


def deal(docs: DataFrame, batches: int) -> DataFrame:
    """``docs`` with a column ``batch``, even where ids are null or repeat."""
    return docs.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int"))


def tally(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys (sorted), different documents of each, smallest document of each."""
    if not len(keys):
        return keys.astype(np.uint64), np.empty(0, np.uint32), np.empty(0, np.int64)
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    first = np.r_[True, keys[1:] != keys[:-1]]
    other = first | np.r_[True, docs[1:] != docs[:-1]]
    at = np.flatnonzero(first)
    return keys[at], np.add.reduceat(other, at, dtype=np.uint32), docs[at]


def messages(batch: int, level: int, told: tuple, buckets: int, least: bool) -> pa.Table:
    """A batch's tally, cut into one message per key range."""
    keys, counts, smallest = told
    # buckets are ranges of the upper half of a key; only those that hold a key of this batch are visited
    bucket = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    edges = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(keys)] if len(keys) else np.zeros(1, np.int64)
    rows = [(int(bucket[i]), batch, level, keys[i:j].tobytes(), counts[i:j].tobytes(), smallest[i:j].tobytes() if least else None)
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist())]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(MESSAGE)], schema=MESSAGE)


def _resolve(group):
    rows = group.to_pylist()
    sent = [np.frombuffer(r["keys"], np.uint64) for r in rows]
    keys = np.concatenate(sent)
    order = np.argsort(keys, kind="stable")
    first = np.r_[True, keys[order][1:] != keys[order][:-1]]
    at, of = np.flatnonzero(first), np.empty(len(keys), np.int64)
    of[order] = np.cumsum(first) - 1
    totals = np.add.reduceat(np.concatenate([np.frombuffer(r["counts"], np.uint32) for r in rows])[order], at, dtype=np.uint32)[of]
    least = None
    if rows[0]["least"] is not None:
        least = np.minimum.reduceat(np.concatenate([np.frombuffer(r["least"], np.int64) for r in rows])[order], at)[of]
    ends = np.cumsum([len(k) for k in sent])
    spans = [(int(e) - len(k), int(e)) for k, e in zip(sent, ends)]
    return pa.Table.from_arrays([
        group["batch"].combine_chunks(), group["bucket"].combine_chunks(), group["level"].combine_chunks(),
        pa.array([totals[i:j].tobytes() for i, j in spans], pa.binary()),
        pa.array([None if least is None else least[i:j].tobytes() for i, j in spans], pa.binary())], schema=ANSWER)


def resolve(sent: DataFrame) -> DataFrame:
    """Answers to messages, by batch and level."""
    return sent.groupBy("level", "bucket").applyInArrow(_resolve, ANSWER_DDL)


def answers(rows: pa.Table, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Totals and smallest documents of a batch's keys at ``level``, in the order of its sorted distinct keys."""
    mine = sorted((r for r in rows.to_pylist() if r["level"] == level), key=lambda r: r["bucket"])
    return (np.frombuffer(b"".join(r["totals"] for r in mine), np.uint32),
            np.frombuffer(b"".join(r["least"] or b"" for r in mine), np.int64))

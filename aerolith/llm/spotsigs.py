"""SpotSigs: signatures of content words that follow common-word anchors.

Words are runs of letters and digits (any non-ASCII character counts as a letter), A-Z lowered.
An anchor is a common word of ``ANCHORS`` or a word of at most two bytes; in texts of other
languages and in lists one word in ``ONE_IN``, chosen by hash, plays that part as well. A spot
signature is an anchor with the ``CHAIN`` content words that follow it; a document's
fingerprint is the set of its signature hashes (32 bits each, sorted, in hexadecimal). A text without
a complete chain has its single words as signatures, one without words its characters. ``near_duplicates`` partitions fingerprints by set
length, so that only sets whose lengths allow the wanted likeness meet, and compares them by
Jaccard likeness, which gives up early where the lengths rule a match out.

Defined cases: null text counts as empty; an empty text has the empty
fingerprint; two empty fingerprints are alike (1), an empty and another are not (0);
rows with equal ids are ordered by text hash; a null id comes first; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.store import blocks, keep
from aerolith.llm.text import batch, hashes, mix

#: Common words of the languages the corpus is expected in.
ANCHORS = """the of and to in is was it that for on are with as his they at be this from have or by one had not but
what all were when we there can an your which their said if do will each about how up out them then she many some so
der die das und in zu den von ist mit auf für nicht ein eine im dem des sich auch als an nach wie aus bei
le la les de des et un une en que qui dans pour pas sur au par plus ce il est
el los las del y que en un una por con para su al lo como""".split()
CHAIN = 2
ONE_IN = 8
BLOCK_BYTES = 8 << 20
RANGES = 10_000     # id ranges at most: the driver holds one id of each; ranges are streamed, so longer ones need no more memory

RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])
RESULT_DDL = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
_ANCHOR_HASHES = np.unique(hashes([w.encode() for w in ANCHORS]))
_FIRST = -(1 << 63)
#: Bytes of letters and digits stay (A-Z lowered), all others become blanks.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def signatures(text: str | None) -> np.ndarray:
    raw = (text or "").encode()
    ws = raw.translate(_LETTERS).split() or [raw[i:i + 1] for i in range(len(raw))]
    h = hashes(ws)
    at = np.minimum(np.searchsorted(_ANCHOR_HASHES, h), len(_ANCHOR_HASHES) - 1)
    anchor = ((_ANCHOR_HASHES[at] == h) | (np.fromiter(map(len, ws), np.int64, len(ws)) <= 2)
              | (h % np.uint64(ONE_IN) == 0))
    content, spots = np.flatnonzero(~anchor), np.flatnonzero(anchor)
    nxt = np.searchsorted(content, spots)
    full = nxt + CHAIN <= len(content)
    spots, nxt = spots[full], nxt[full]
    if not len(spots):
        return np.unique(mix(h).astype(np.uint32))
    sig = mix(h[spots])
    for j in range(CHAIN):
        sig = mix(sig + h[content[nxt + j]])
    return np.unique(sig.astype(np.uint32))


def hexed(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard likeness of two sorted sets; 0 at once where their lengths keep it below ``floor``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < floor * max(len(a), len(b)):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def in_id_order(docs: DataFrame, per_block: int = BLOCK_BYTES) -> DataFrame:
    """``block, tail, doc_id, key, text``: documents dealt into ranges of ``doc_id``, each range followed by the next one's first document.

    The driver sees one id per range. ``tail`` rows only serve as successor of the last document before them.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("key"),
                    F.coalesce("text", F.lit("")).alias("text"))
    n = min(RANGES, blocks(d.agg(F.sum(F.octet_length("text"))).first()[0], per_block))
    cuts = d.agg(F.percentile_approx("key", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0] or []
    cuts = np.unique(np.asarray(cuts if n > 1 else [], np.int64))

    @F.pandas_udf("int")
    def block(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(np.int64), side="left")).astype("int32")

    firsts = sorted((b, k) for b, k in d.select("key").groupBy(block("key").alias("b")).agg(F.min("key")).collect())
    first_of = np.asarray([k for _, k in firsts], np.int64)
    block_of = np.asarray([b for b, _ in firsts], np.int64)

    @F.pandas_udf("array<int>")
    def places(key: pd.Series) -> pd.Series:
        k = key.to_numpy(np.int64)
        own = np.searchsorted(cuts, k, side="left")
        at = np.minimum(np.searchsorted(first_of, k), len(first_of) - 1)
        return pd.Series([[2 * o] if first_of[i] != x else [2 * o, 2 * block_of[i - 1] + 1] for x, o, i in zip(k, own, at)])

    rows = d.select("*", F.explode(places("key")).alias("p"))
    rows = rows.select((F.col("p") / 2).cast("int").alias("block"), (F.col("p") % 2 == 1).alias("tail"), "doc_id", "key", "text")
    return (rows.repartition(max(1, len(firsts)), "block")
            .sortWithinPartitions("block", "tail", "key", F.xxhash64("text")))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    The edited text has its last quarter (rounded down) replaced by as much of the
    next document's beginning; the first document follows the last.
    """
    def result(doc, text, sig, next_text, next_sig):
        k = len(text) // 4
        edited = text[:len(text) - k] + next_text[:k]
        edited_sig = signatures(edited)
        return (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(sig), hexed(edited_sig),
                likeness(sig, edited_sig), likeness(sig, next_sig))

    def run(batches):
        block, held = None, None
        for b in batches:
            found = []
            for at, tail, doc, text in zip(*(b.column(c).to_pylist() for c in ("block", "tail", "doc_id", "text"))):
                if at != block:
                    block, held = at, None
                elif held is None:
                    continue  # further copies of the successor
                sig = signatures(text)
                if held is not None:
                    found.append(result(*held, text, sig))
                held = None if tail else (doc, text, sig)
            yield batch({name: [r[i] for r in found] for i, name in enumerate(RESULT.names)}, RESULT)

    return in_id_order(docs).select("block", "tail", "doc_id", "text").mapInArrow(run, RESULT_DDL)


def classes(prints: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, id``: the smallest id with the same fingerprint, for fingerprints that are not empty."""
    p = prints.filter("length(fingerprint) > 0").select("doc_id", "fingerprint")
    named = p.groupBy("fingerprint").agg(F.min("doc_id").alias("id"))
    return p.join(named, "fingerprint").select("doc_id", "fingerprint", "id")


def near_duplicates(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs ``a, b, likeness`` of different fingerprints at ``threshold`` or more, from ``doc_id, fingerprint``.

    Equal fingerprints are one class, named by its smallest id (``classes`` gives the members). A class enters the partition
    of its set length and, as the shorter side, every partition its length could match; classes meet where they share one
    of the first ``len - ceil(threshold * len) + 1`` signatures, rarest first, so that a signature of many documents is
    only asked about where a fingerprint has too few rare ones.
    """
    step = -math.log(threshold)
    reps = keep(prints.filter("length(fingerprint) > 0").groupBy("fingerprint").agg(F.min("doc_id").alias("id"))
                .select("id", F.expr("transform(sequence(0, cast(length(fingerprint) / 8 as int) - 1),"
                                     " i -> substring(fingerprint, i * 8 + 1, 8))").alias("sigs")), "classes")
    held = reps.select("id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    shared = held.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # signatures of one class alone come first in the order: they fill the prefix but meet nobody
    ranked = (held.join(shared, "sig").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("s"))
              .withColumn("band", F.floor(F.ln("n") / step)))
    room = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1 - (F.col("n") - F.size("s"))
    spots = keep(ranked.filter(room > 0).select("id", "n", "band", F.explode(F.slice("s", 1, room.cast("int"))).alias("s"))
                 .select("id", "n", "band", "s.sig"), "spots")
    short = spots.select(F.col("id").alias("a"), F.col("n").alias("na"), "sig",
                         F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    pairs = (short.join(spots, ["band", "sig"])
             .filter(((F.col("na") < F.col("n")) | ((F.col("na") == F.col("n")) & (F.col("a") < F.col("id"))))
                     & (F.col("na") >= threshold * F.col("n")))
             .select("a", F.col("id").alias("b")).distinct())
    both = F.size(F.array_intersect("s1", "s2"))
    return (pairs.join(reps.select(F.col("id").alias("a"), F.col("sigs").alias("s1")), "a")
            .join(reps.select(F.col("id").alias("b"), F.col("sigs").alias("s2")), "b")
            .select("a", "b", (both / (F.size("s1") + F.size("s2") - both)).alias("likeness"))
            .filter(F.col("likeness") >= threshold))

"""Phrase collocations from sorted count streams.

Counting. Every word position of a text gives one padded trigram ``(word, next, next but one)``, empty where the piece
ends. A task sorts and adds up the trigrams of some megabytes of text and sends them in prefix order to ranges of
the whole key (language and three words), so a frequent first word or pair spreads over many ranges. A
range's sorted stream is read once: runs of equal first word, of equal first two and of equal three words are the
counts of words, pairs and triples. Runs at the border of a range go on in the next one; these few partial counts are added up
afterwards. Counts under ``min_count`` are dropped there, as no part of a frequent phrase is rarer than the phrase.

Merging. The counts are sorted as streams of words, pairs and triples in prefix order and again in suffix order
(words reversed), cut into ranges at the same keys, and each range is merged in lockstep: a word's count is met
before the pairs it starts, a pair's before its triples. Prefix order gives the count left of every cut and a pair's largest extension to
the right, suffix order the count right of every cut and the largest extension to the left. A word or pair whose extensions span
several ranges is sent to each of them, so no range needs its neighbour and no group has to fit in a task.

Range bounds come from a sample; they set the sizes of the ranges and never the result. Scores are exact: products are decimals.

Defined cases: null text is empty; null language is ``und``; pieces without words give nothing; a language without
a candidate has no rows; repeated rows count as often as they occur; ids play no part; other columns are
ignored; an empty table gives no rows. A text longer than ``CHUNK`` is cut at blanks, with two words carried over.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.store import blocks, keep

CHUNK = 4 << 20  # bytes of text that a task sorts at once
RANGE_BYTES = 16 << 20  # bytes of text per range, as long as there are at most MAX_RANGES
RANGE_ROWS = 500_000  # counts per range of the merge
MAX_RANGES = 20_000  # more text makes longer ranges, which are sorted and streamed
OUT = 1 << 17  # rows of an Arrow batch

# A-Z to a-z, the ends of pieces to one sign, tabs to blanks
_FROM = bytes(range(65, 91)) + b",;:!?\n\x0b\x0c\r\t"
FOLD = bytes.maketrans(_FROM, _FROM[:26].lower() + b"." * 9 + b" ")
END = b"."

COUNT_DDL = "lang string, w1 string, w2 string, w3 string, f bigint, edge boolean"
MERGED_DDL = "lang string, w1 string, w2 string, w3 string, f bigint, one bigint, two bigint, ext bigint"


# Words keep the order of their bytes inside keys that are joined by \x00: \x00 and \x01 are written as two bytes.
def escape(b: bytes) -> bytes:
    return b.replace(b"\x01", b"\x01\x02").replace(b"\x00", b"\x01\x01") if b"\x00" in b or b"\x01" in b else b


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\x01\x01"), F.lit("\x00")), F.lit("\x01\x02"), F.lit("\x01"))


def segments(text: bytes):
    """Folded text in parts of about ``CHUNK`` bytes, cut at blanks."""
    folded = text.translate(FOLD).replace(END, b" . ")
    at = 0
    while len(folded) - at > CHUNK:
        end = folded.find(b" ", at + CHUNK)
        if end < 0:
            break
        yield folded[at:end]
        at = end
    yield folded[at:]


def trigrams(lang: bytes, tokens: list[bytes], upto: int) -> tuple[pa.Array, np.ndarray]:
    """Sorted distinct keys of the padded trigrams that start at the first ``upto`` tokens, and how often they occur."""
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(1, len(order) + 1)
    ids = np.r_[rank[coded.indices.to_numpy()], 0, 0]
    end = pc.index(coded.dictionary, pa.scalar(END, pa.binary())).as_py()
    if end >= 0:
        ids[ids == rank[end]] = 0
    first, second, third = ids[:upto], ids[1:upto + 1], ids[2:upto + 2]
    bits = int(len(order) + 1).bit_length()
    if 3 * bits > 63:  # no text has so many different words in a chunk
        raise ValueError("chunk too large")
    keys = np.sort(((first << 2 * bits) | (second << bits) | np.where(second == 0, 0, third))[first > 0])
    if not len(keys):
        return pa.array([], pa.binary()), np.empty(0, np.int64)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    counts = np.diff(np.r_[starts, len(keys)])
    keys = keys[starts]
    words = pc.take(coded.dictionary, order)
    raw = words.buffers()[2].to_pybytes() if len(words) else b""
    if b"\x00" in raw or b"\x01" in raw:
        words = pa.array([escape(w) for w in words.to_pylist()], pa.binary())
    words = pa.concat_arrays([pa.array([b""], pa.binary()), words])
    low = (1 << bits) - 1
    cols = [pc.take(words, pa.array(keys >> s & low)) for s in (2 * bits, bits, 0)]
    return pc.binary_join_element_wise(pa.scalar(escape(lang), pa.binary()), *cols, pa.scalar(b"\x00", pa.binary())), counts


def streams(batches):
    """``(sorted keys, counts)`` of some megabytes of text of one language after the other."""
    held, size = {}, 0

    def flush():
        for lang, tokens in held.items():
            if tokens:
                yield trigrams(lang, tokens, len(tokens))
        held.clear()

    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            if not text:
                continue
            tokens = held.setdefault(lang.encode(), [])
            tokens.append(END)
            raw = text.encode()
            for part in segments(raw):
                if len(tokens) > CHUNK // 8:
                    yield trigrams(lang.encode(), tokens, len(tokens) - 2)
                    del tokens[:-2]
                tokens += part.split()
            size += len(raw)
            if size >= CHUNK:
                yield from flush()
                size = 0
    yield from flush()


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text"))


def quantiles(keys: list[bytes], ranges: int) -> list[bytes]:
    """``ranges - 1`` keys that cut the distinct ``keys`` into parts of equal number."""
    keys = sorted(set(keys))
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def text_bounds(docs: DataFrame) -> list[bytes]:
    """Keys at which the padded trigrams of ``docs`` are cut into ranges, from some documents (about 50 keys a range)."""
    size, rows = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    ranges = min(MAX_RANGES, blocks(size, RANGE_BYTES))
    if ranges == 1:
        return []

    def some(batches):
        for b in batches:
            out = []
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                if text:
                    keys, _ = trigrams(lang.encode(), t := next(segments(text.encode())).split(), len(t))
                    out += keys.take(pa.array(range(0, len(keys), max(40, len(keys) // 50)), pa.int64())).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["key"])

    share = min(1.0, (200 + 10 * ranges) / rows)
    return quantiles([bytes(r.key) for r in docs.sample(share, seed=1).mapInArrow(some, "key binary").collect()], ranges)


def _parts(keys: pa.Array) -> list[pa.Array]:
    """Language and words of keys."""
    flat = pc.list_flatten(pc.split_pattern(keys, b"\x00"))
    at = np.arange(0, 4 * len(keys), 4)
    return [pc.take(flat, pa.array(at + i)) for i in range(4)]


def _changes(a: pa.Array) -> np.ndarray:
    return pc.not_equal(a.slice(1), a.slice(0, len(a) - 1)).to_numpy(zero_copy_only=False)


def count_runs(batches, least: int):
    """Counts of words, pairs and triples (and of all words: no words named) of one sorted range."""
    carry = [None] * 4  # per order the open run: labels, sum, whether it began the range

    def out(rows):
        cols = list(zip(*rows)) if rows else [()] * 6
        return pa.RecordBatch.from_arrays([*[pa.array([None if x is None else x.decode() for x in c], pa.string()) for c in cols[:4]],
                                           pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.bool_())],
                                          names=["lang", "w1", "w2", "w3", "f", "edge"])

    def row(order, labels, total, edge):
        """Padded runs are no phrases; runs inside the range count from ``least`` on."""
        if order and (labels[order] == b"" or not edge and total < least):
            return []
        return [(*labels[:order + 1], *[None] * (3 - order), total, edge or order == 0)]

    for b in batches:
        if not b.num_rows:
            continue
        parts, n = _parts(b.column(0)), b.column(1).to_numpy()
        changed, rows = np.zeros(b.num_rows - 1, bool), []
        for order in range(4):
            changed = changed | _changes(parts[order])
            starts = np.flatnonzero(np.r_[True, changed])
            sums = np.add.reduceat(n, starts)

            def labels(g):
                return tuple(parts[i][int(starts[g])].as_py() for i in range(order + 1))

            was, head = carry[order], labels(0)
            began = was is None
            if was and was[0] == head:
                sums[0] += was[1]
                began = was[2]
            elif was:
                rows += row(order, was[0], was[1], was[2])
            last = len(starts) - 1
            if last:
                rows += row(order, head, int(sums[0]), began)
                inner = np.flatnonzero(sums[1:last] >= least) + 1 if order else np.arange(1, last)
                got = [pc.take(parts[i], pa.array(starts[inner])).to_pylist() for i in range(order + 1)]
                for g, *words in zip(inner.tolist(), *got):
                    rows += row(order, words, int(sums[g]), False)
                carry[order] = (labels(last), int(sums[last]), False)
            else:
                carry[order] = (head, int(sums[0]), began)
        yield out(rows)
    yield out([r for order, c in enumerate(carry) if c for r in row(order, c[0], c[1], True)])


def phrase_counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``lang, w1, w2, w3, f`` of words, pairs and triples that occur ``least`` times; ``lang, n``: all words of a language."""
    rows = texts(docs)
    bounds = rows.sparkSession.sparkContext.broadcast(text_bounds(rows))

    def send(batches):
        cuts = bounds.value
        for keys, counts in streams(batches):
            if not len(keys):
                continue
            first = bisect.bisect_right(cuts, keys[0].as_py())
            inside = cuts[first:bisect.bisect_right(cuts, keys[len(keys) - 1].as_py())]
            ends, at = [], 0
            for cut in inside:  # keys are sorted, so are the cuts
                at = bisect.bisect_left(keys, cut, lo=at, key=lambda k: k.as_py())
                ends.append(at)
            ranges = np.repeat(np.arange(first, first + len(inside) + 1), np.diff([0, *ends, len(keys)]))
            whole = pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), keys, pa.array(counts, pa.int64())], names=["range", "key", "n"])
            for i in range(0, len(keys), OUT):
                yield whole.slice(i, OUT)

    sent = rows.mapInArrow(send, "range int, key binary, n bigint")
    ranged = sent.repartitionById(len(bounds.value) + 1, F.col("range")).sortWithinPartitions("key").select("key", "n")
    told = keep(ranged.mapInArrow(lambda batches: count_runs(batches, least), COUNT_DDL), "phrase-counts")
    phrases = told.filter("w1 IS NOT NULL")
    border = (phrases.filter("edge").groupBy("lang", "w1", "w2", "w3").agg(F.sum("f").alias("f")).filter(F.col("f") >= least))
    counts = phrases.filter("NOT edge").drop("edge").unionByName(border)
    return counts, told.filter("w1 IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))


def merge(counts: DataFrame, rows: int, backwards: bool) -> DataFrame:
    """Every pair and triple with the counts of its first word (``one``) and, of a triple, of its first two (``two``), and
    every pair with its most frequent triple (``ext``); from the end of the phrase if ``backwards``."""
    words = [F.coalesce(c, F.lit("")) for c in ("w1", "w2", "w3")]
    if backwards:
        size = F.when(F.col("w2").isNull(), 1).when(F.col("w3").isNull(), 2).otherwise(3)
        words = [F.when(size == 1, words[0]).when(size == 2, words[1]).otherwise(words[2]),
                 F.when(size == 2, words[0]).when(size == 3, words[1]).otherwise(F.lit("")),
                 F.when(size == 3, words[0]).otherwise(F.lit(""))]
    keyed = counts.select(F.concat_ws("\x00", "lang", *words).cast("binary").alias("key"), "f")
    ranges = min(MAX_RANGES, blocks(rows, RANGE_ROWS))
    sample = keyed.select("key").sample(min(1.0, 50 * ranges / max(1, rows)), seed=1).collect() if ranges > 1 else []
    bounds = keyed.sparkSession.sparkContext.broadcast(quantiles([bytes(r.key) for r in sample], ranges))

    def send(batches):
        cuts = bounds.value
        for b in batches:
            keys, f = b.column(0).to_pylist(), b.column(1).to_pylist()
            out = []
            for key, n in zip(keys, f):
                k = bisect.bisect_right(cuts, key)
                out.append((k, key, n))
                stem = key.rstrip(b"\x00")
                if len(key) > len(stem):  # a word or pair: also to the later ranges that hold what it starts
                    out += [(i, key, n) for i in range(k + 1, bisect.bisect_left(cuts, stem + b"\x01") + 1)]
            cols = list(zip(*out)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64())],
                                             names=["range", "key", "f"])

    def lockstep(batches):
        one = two = pair = None
        best = None

        def phrase(ws, f, first, both, ext):
            lang, *ws = (w.decode() for w in ws)
            if backwards:
                ws.reverse()
            return (lang, *ws, *[None] * (3 - len(ws)), f, first, both, ext)

        def out(rows):
            cols = list(zip(*rows)) if rows else [()] * 8
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i < 4 else pa.int64()) for i, c in enumerate(cols)],
                                              names=["lang", "w1", "w2", "w3", "f", "one", "two", "ext"])

        for b in batches:
            rows = []
            for key, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                lang, w1, w2, w3 = key.split(b"\x00")
                if not w3 and pair:
                    rows.append(phrase(pair, two, one, None, best))
                    pair = None
                if not w2:
                    one = f
                elif not w3:
                    pair, two, best = (lang, w1, w2), f, None
                else:
                    rows.append(phrase((lang, w1, w2, w3), f, one, two, None))
                    best = max(best or 0, f)
            yield out(rows)
        if pair:
            yield out([phrase(pair, two, one, None, best)])

    sent = keyed.mapInArrow(send, "range int, key binary, f bigint")
    return (sent.repartitionById(len(bounds.value) + 1, F.col("range")).sortWithinPartitions("key").select("key", "f")
            .mapInArrow(lockstep, MERGED_DDL))


def scored(phrases: DataFrame) -> DataFrame:
    """``a, l, r, score`` of the lowest-scoring cut of each phrase."""
    def cut(k: int, left: str, right: str) -> Column:
        a, l, r = (F.col(c).cast("decimal(18,0)") for c in ("a", left, right))
        return F.struct(F.call_function("div", a * a * F.lit(1000000).cast("decimal(7,0)"), l * r).cast("long").alias("score"),
                        F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))

    pair = cut(1, "l_one", "r_one")
    triple = F.least(cut(1, "l_one", "r_two"), cut(2, "l_two", "r_one"))  # ties: the smallest k
    return phrases.withColumn("c", F.when(F.col("w3").isNull(), pair).otherwise(triple)).select("*", "c.score", "c.l", "c.r").drop("c")


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of two and three words that occur ``least``
    times; a phrase inside a longer one with at least ``share`` percent of its occurrences is dropped."""
    counts, totals = phrase_counts(docs, least)
    counts = keep(counts, "phrases")
    rows = counts.count()
    left = merge(counts, rows, False).withColumnsRenamed({"one": "l_one", "two": "l_two"})
    right = merge(counts, rows, True).withColumnsRenamed({"one": "r_one", "two": "r_two"})
    both = (left.unionByName(right, allowMissingColumns=True).groupBy("lang", "w1", "w2", "w3")
            .agg(F.max("f").alias("a"), *[F.max(c).alias(c) for c in ("l_one", "l_two", "r_one", "r_two", "ext")]))
    kept = scored(both.filter(f"ext IS NULL OR 100 * ext < {share} * a"))
    phrase = F.concat_ws(" ", *[unescape(F.col(c)) for c in ("w1", "w2", "w3")])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (kept.select("lang", phrase.alias("phrase"), "a", "l", "r", "score")
              .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
    return ranked.join(totals, "lang").select(unescape(F.col("lang")).alias("lang"), F.col("rank").cast("long").alias("rank"),
                                              "phrase", "a", "l", "r", "n", "score")

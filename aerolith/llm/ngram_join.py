"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its 5-word shingles; documents link when
``100 * |A and B| >= 80 * |A or B|``. Sorted by any order common to all documents, two linked sets share at least
``k`` of their first ``|S| - ceil(0.8 |S|) + k`` shingles, for every ``k``: a prefix lengthened by ``k - 1`` asks
for ``k`` matches. The join uses this three times.

1. Equal sets become one class with a number of its own, written once. Its first row (smallest id, rows without an id
   last) stands for it.
2. Hash order, ``k`` = a fifth of the set: a class can only have a partner if that many prefix shingles occur in
   other classes. Shingles are counted over all classes (``exchange``). Most documents end here.
3. Among those left, rarest first: each class picks the ``k`` (1, 2, 4, ...) with the least estimated cost, which is the
   posting entries its prefix meets plus one verification for every ``k`` of them. Classes that share a prefix
   shingle form a family (connected components over each shingle's smallest class); no link leaves a family. A class
   leaves its family if no size in it fits: two linked sets share 4/9 of their sizes' sum, and a set cannot share more than
   those of its shingles that occur in other sets at all.

Families are compared in cells of bounded size: small families together, a large one in blocks of about
``CELL_SHINGLES`` shingles, so that a huge group of near copies is many tasks. Block 0 meets every block, which joins
such a group in one pass; what is left outside its largest component is then compared with itself and that component. In
a cell, prefix postings are counted, pairs with ``min(k)`` matches and fitting sizes are verified on the whole
sets, and only links that join two parts of the cell are returned; these and the classes give the components.

Defined cases: null or blank text has no shingles and links with nothing; texts under five words have one
shingle, the whole sequence; rows of one id with different texts are judged one by one; rows with a null id take part
like others but cannot name a component (its ``component_id`` is null if all its ids are); of a group, the rows of the first id
and text stay, one row if that has no id; other columns are ignored or passed through; an empty table gives no rows. Shingles are 64-bit hashes, sets are told apart by 128 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm import exchange
from aerolith.llm.components import components
from aerolith.llm.store import blocks, keep
from aerolith.llm.text import distinct, hashes, lower_words, mix, runs

WORDS = 5
PERCENT = 80
CELL_SHINGLES = 300_000

SET_DDL = "doc_id bigint, batch int, t1 bigint, t2 bigint, n bigint, h1 bigint, h2 bigint"
LEFT_DDL = "id bigint, n bigint, shingles binary"
READY_DDL = "id bigint, n bigint, k int, prefix int, shingles binary"
CELL_DDL = "a bigint, b bigint"
WORD = r"[^\x20\x09-\x0D]"
_U = np.uint64


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    h = hashes(lower_words(text))
    return distinct(runs(h, min(size, len(h)))) if len(h) else h


def least_overlap(n):
    """Shingles that a set of ``n`` shares with any linked set, at least (also: the smallest linked set)."""
    return (PERCENT * n + 99) // 100


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed integers."""
    h = [mix(s ^ _U(salt)).sum(dtype=np.uint64) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return tuple(int(x.astype(np.int64)) for x in h)


def wide_k(n: int) -> int:
    return max(1, n // 5)


def wide_prefix(s: np.ndarray) -> np.ndarray:
    """The lengthened prefix in hash order."""
    return s[:len(s) - least_overlap(len(s)) + wide_k(len(s))]


def choose_k(n: int, frequency: np.ndarray) -> int:
    """Matches to ask for: least posting entries plus verifications. ``frequency`` is that of the set's shingles, rarest first."""
    overlap, met, best = least_overlap(n), np.cumsum(frequency), (np.inf, 1)
    k = 1
    while k <= overlap:
        entries = float(met[n - overlap + k - 1])
        best = min(best, (entries + entries / k * n, k))
        k *= 2
    return best[1]


class Sets:
    """Classes of a cell with their postings."""

    def __init__(self, rows: list[dict]):
        self.id = np.array([r["id"] for r in rows], np.int64)
        self.n = np.array([r["n"] for r in rows], np.int64)
        self.k = np.array([r["k"] for r in rows], np.int64)
        self.sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        self.prefixes = [s[:r["prefix"]] for s, r in zip(self.sets, rows)]

    def __len__(self):
        return len(self.id)


def postings(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(keys, kind="stable")
    return keys[order], owner[order]


def matches(s: np.ndarray, index: tuple[np.ndarray, np.ndarray], size: int) -> np.ndarray:
    """How many of ``s`` each indexed set holds."""
    keys, owner = index
    lo, hi = np.searchsorted(keys, s, "left"), np.searchsorted(keys, s, "right")
    some = hi > lo
    lo, hi = lo[some], hi[some]
    length = hi - lo
    if not len(length):
        return np.zeros(size, np.int64)
    at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(lo, length)
    return np.bincount(owner[at], minlength=size)


def cell_links(left: Sets, right: Sets, within: bool) -> list[tuple[int, int]]:
    """Verified links between two blocks (or within one) that join different parts of the cell."""
    part = np.arange(len(right)) if within else np.r_[np.arange(len(right)), np.arange(len(left)) + len(right)]
    short, whole, found = postings(right.prefixes), postings(right.sets), []
    for i in range(len(left)):
        shared = matches(left.prefixes[i], short, len(right))
        n, m = left.n[i], right.n
        near = (shared >= np.minimum(left.k[i], right.k)) & (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m))
        me = i if within else i + len(right)
        if within:
            near[:i + 1] = False
        near &= part[:len(right)] != part[me]
        if not near.any():
            continue
        both = matches(left.sets[i], whole, len(right))
        linked = np.flatnonzero(near & (100 * both >= PERCENT * (n + m - both)))
        parts, first = np.unique(part[linked], return_index=True)
        if len(parts):
            found += [(int(left.id[i]), int(right.id[linked[f]])) for f in first]
            part[np.isin(part, parts)] = part[me]
    return found


def _links_of(rows: list[dict], within: bool) -> list[tuple[int, int]]:
    left = Sets([r for r in rows if not r["right"]])
    return cell_links(left, left if within else Sets([r for r in rows if r["right"]]), within)


def text_marks() -> list[Column]:
    """128 bits of a text."""
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(WORDS), "text").alias("t2")]


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, batch, t1, t2, n, h1, h2`` of dealt documents."""
    def run(batches):
        for b in batches:
            sets = [shingles(t) for t in b.column("text").to_pylist()]
            marks = [digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("batch"), b.column("t1"), b.column("t2"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64())],
                names=["doc_id", "batch", "t1", "t2", "n", "h1", "h2"])

    return docs.select("doc_id", "batch", "text", *text_marks()).mapInArrow(run, SET_DDL)


def _named(docs: pa.Table, named: list[dict]) -> list[tuple[int, np.ndarray]]:
    """Classes that a document of this batch stands for, with their sets."""
    want = {(r["doc_id"], r["h1"], r["h2"]): r["id"] for r in named}
    mine = {d for d, _, _ in want}
    out = []
    for doc, text in zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist()):
        if doc in mine:
            s = shingles(text)
            name = want.pop((doc, *digest(s)), None)
            if name is not None:
                out.append((name, s))
    return out


def _with_partners(batched: DataFrame, classes: DataFrame, buckets: int) -> DataFrame:
    """``id, n, shingles`` of classes that the lengthened prefix in hash order leaves."""
    def tallied(found):
        keys = [wide_prefix(s) for _, s in found]
        ids = np.repeat(np.arange(len(found)), [len(k) for k in keys])
        return exchange.tally(np.concatenate(keys) if keys else np.empty(0, np.uint64), ids)

    def send(key, docs, named):
        return exchange.messages(key[0].as_py(), 0, tallied(_named(docs, named.to_pylist())), buckets, False)

    def finish(docs, side):
        rows = side.to_pylist()
        found = _named(docs, [r for r in rows if r["totals"] is None])
        told = side.filter(pa.compute.is_valid(side["totals"]))
        totals, _ = exchange.answers(told, 0)
        keys, _, _ = tallied(found)
        out = []
        for name, s in found:
            prefix = wide_prefix(s)
            if (totals[np.searchsorted(keys, prefix)] >= 2).sum() >= wide_k(int(least_overlap(len(s)))):
                out.append((name, len(s), s.tobytes()))
        return pa.table({"id": pa.array([r[0] for r in out], pa.int64()), "n": pa.array([r[1] for r in out], pa.int64()),
                         "shingles": pa.array([r[2] for r in out], pa.binary())})

    sent = batched.groupBy("batch").cogroup(classes.groupBy("batch")).applyInArrow(send, exchange.MESSAGE_DDL)
    side = classes.unionByName(exchange.resolve(sent), allowMissingColumns=True)
    return batched.groupBy("batch").cogroup(side.groupBy("batch")).applyInArrow(finish, LEFT_DDL)


def _ready(left: DataFrame, batches: int) -> DataFrame:
    """``id, n, k, prefix, shingles``: shingles other classes have as well, rarest first, with the chosen prefix."""
    dealt = left.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int"))

    def tallied(t):
        sets = [np.frombuffer(b, np.uint64) for b in t["shingles"].to_pylist()]
        keys = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        return sets, exchange.tally(keys, np.repeat(np.arange(len(sets)), [len(s) for s in sets]))

    def send(key, t):
        return exchange.messages(key[0].as_py(), 0, tallied(t)[1], batches, False)

    def finish(t, side):
        sets, (keys, _, _) = tallied(t)
        totals, _ = exchange.answers(side, 0)
        out = []
        for name, n, s in zip(t["id"].to_pylist(), t["n"].to_pylist(), sets):
            df = totals[np.searchsorted(keys, s)].astype(np.int64)
            order = np.lexsort((s, df))
            alone = int((df == 1).sum())
            k = choose_k(n, df[order] - 1)
            prefix = int(n - least_overlap(n) + k - alone)
            # the prefix must hold as many shared shingles as the least any partner asks for
            if prefix >= 1 and n - alone >= least_overlap(n):
                out.append((name, n, k, prefix, s[order][alone:].tobytes()))
        cols = list(zip(*out)) or [[]] * 5
        return pa.table({c: pa.array(v, t) for c, v, t in zip(("id", "n", "k", "prefix", "shingles"), cols, (
            pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))})

    told = exchange.resolve(dealt.groupBy("batch").applyInArrow(send, exchange.MESSAGE_DDL))
    return dealt.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(finish, READY_DDL)


def _families(ready: DataFrame, batches: int) -> DataFrame:
    """``id, component``: classes connected by shared prefix shingles."""
    dealt = ready.select("id", "prefix", "shingles", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int").alias("batch"))

    def tallied(t):
        sets = [np.frombuffer(b, np.uint64)[:p] for b, p in zip(t["shingles"].to_pylist(), t["prefix"].to_pylist())]
        ids = t["id"].to_numpy()
        keys = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        return sets, exchange.tally(keys, np.repeat(ids, [len(s) for s in sets]))

    def send(key, t):
        return exchange.messages(key[0].as_py(), 0, tallied(t)[1], batches, True)

    def finish(t, side):
        sets, (keys, _, _) = tallied(t)
        _, least = exchange.answers(side, 0)
        pairs = [(name, other) for name, s in zip(t["id"].to_pylist(), sets)
                 for other in distinct(least[np.searchsorted(keys, s)]).tolist() if other != name]
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})

    told = exchange.resolve(dealt.groupBy("batch").applyInArrow(send, exchange.MESSAGE_DDL))
    return components(dealt.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(finish, CELL_DDL))


def _least_shared(t: pa.Table) -> pa.Table:
    """Of one family's set sizes (``n``, ``rows``, ``most``: the most shared shingles of a set of that size): how many shingles a
    set of each size has to share for a link to be possible; sizes without a possible partner are left out."""
    t = t.sort_by("n")
    n, rows, most = (t[c].to_numpy() for c in ("n", "rows", "most"))
    reach = (100 + PERCENT) * most // PERCENT - n  # largest partner whose overlap a set of this size can hold
    out = []
    for i, size in enumerate(n.tolist()):
        lo, hi = np.searchsorted(n, least_overlap(size), "left"), np.searchsorted(n, 100 * size // PERCENT, "right")
        ok = (reach[lo:hi] >= size) & (n[lo:hi] <= reach[i])
        if lo <= i < hi and rows[i] < 2:
            ok[i - lo] = False
        if ok.any():
            smallest = int(n[lo + int(ok.argmax())])
            out.append((t["component"][0].as_py(), size, -(-PERCENT * (size + smallest) // (100 + PERCENT))))
    cols = list(zip(*out)) or [[]] * 3
    return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("component", "n", "least"), cols)})


def _possible(ready: DataFrame, families: DataFrame) -> DataFrame:
    """Classes of ``ready`` that can link with a set of their family, by what both share with any others at all.

    Linked sets of ``n`` and ``m`` have 4/9 of ``n + m`` in common, which is more than 4/5 of ``n`` unless the partner is as small as
    may be. Pages that only have a frame in common share too little for pages of their own size, so they leave here, however many they are.
    """
    held = keep(ready.join(families, "id").withColumn("shared", (F.octet_length("shingles") / 8).cast("long")), "held")
    sizes = held.groupBy("component", "n").agg(F.count(F.lit(1)).alias("rows"), F.max("shared").alias("most"))
    least = sizes.groupBy("component").applyInArrow(_least_shared, "component bigint, n bigint, least bigint")
    return (held.join(least, ["component", "n"]).filter(F.col("shared") >= F.col("least"))
            .select("id", "n", "k", "prefix", "shingles", "component"))


def _compare(cells: DataFrame) -> DataFrame:
    """Links ``a, b`` of cells: within block ``i``, or (``right``) of block ``j`` with block ``i``."""
    def run(key, t):
        found = _links_of(t.to_pylist(), key[1] == key[2])
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return keep(cells.select("cell", "i", "j", "right", "id", "n", "k", "prefix", "shingles")
                .groupBy("cell", "i", "j").applyInArrow(run, CELL_DDL), "cell-links")


def _upto(end) -> Column:
    return F.explode(F.sequence(F.lit(0), end - 1))


def _block(parts) -> Column:
    return F.pmod(F.xxhash64("id"), parts).cast("int")


def _cell_links(members: DataFrame) -> DataFrame:
    """Links of all families (``members``: classes with their family, ``component``), cell by cell.

    Small families share cells. Of a large one, block 0 meets every block; that joins a group of near copies at
    a cost that grows with its size. Where the largest component so far holds two rows of the other blocks, they need
    no comparison, so only the rest of the family is compared, with itself and with that component.
    """
    sized = keep(members.withColumn("held", F.octet_length("shingles") / 8), "sized")
    shape = keep(sized.groupBy("component").agg(F.sum("held").alias("held"))
                 .withColumn("parts", F.ceil(F.col("held") / CELL_SHINGLES).cast("int")), "families")
    rows = sized.drop("held").join(shape.drop("held"), "component")
    pools = blocks(shape.filter("parts = 1").agg(F.sum("held")).first()[0], CELL_SHINGLES)
    zero = F.lit(0)
    small = _compare(rows.filter("parts = 1").select(
        "*", F.pmod(F.xxhash64("component"), F.lit(pools)).alias("cell"), zero.alias("i"), zero.alias("j"), F.lit(False).alias("right")))
    if shape.filter("parts > 1").isEmpty():
        return small

    large = rows.filter("parts > 1").select("*", F.col("component").alias("cell"), _block(F.col("parts")).alias("part"))
    met = large.select("*", zero.alias("i"), F.explode(F.when(F.col("part") == 0, F.sequence(zero, F.col("parts") - 1))
                                                       .otherwise(F.array("part"))).alias("j"), (F.col("part") > 0).alias("right"))
    first = _compare(met)
    joined = components(first).withColumnRenamed("component", "joined")
    others = (large.filter("part > 0").join(joined, "id", "left")
              .withColumn("joined", F.coalesce("joined", "id")))
    main = (others.groupBy("cell", "joined").agg(F.count(F.lit(1)).alias("rows"))
            .groupBy("cell").agg(F.max_by("joined", F.struct("rows", "joined")).alias("main")))
    others = keep(others.join(main, "cell"), "others")
    rest = others.filter("joined <> main")
    shape = keep(rest.groupBy("cell").agg(F.ceil(F.sum(F.octet_length("shingles")) / 8 / CELL_SHINGLES).cast("int").alias("blocks")),
                 "rest")
    rest = rest.join(shape, "cell").withColumn("block", _block(F.col("blocks")))
    among = rest.withColumn("other", _upto(F.col("blocks"))).select(
        "*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).alias("right"))
    # cells with the main component are numbered below zero
    ahead = rest.withColumn("other", _upto(F.col("parts"))).filter("other > 0").select(
        "*", (-F.col("other")).alias("i"), F.col("block").alias("j"), F.lit(True).alias("right"))
    behind = others.filter("joined = main").join(shape, "cell").select(
        "*", (-F.col("part")).alias("i"), _upto(F.col("blocks")).alias("j"), F.lit(False).alias("right"))
    columns = ["cell", "i", "j", "right", "id", "n", "k", "prefix", "shingles"]
    second = _compare(among.select(columns).union(ahead.select(columns)).union(behind.select(columns)))
    return small.union(first).union(second)


def class_links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets of documents (``doc_id, t1, t2, n, id, first``: its class and the row that stands for it, null without
    shingles), classes (``id, first``) and links ``a, b`` between classes.

    Links left out are those inside a part that other links already join.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    batched = exchange.deal(docs, blocks(size, exchange.BATCH_BYTES))
    sets = keep(shingle_sets(batched), "sets")
    named = (sets.filter("n > 0").groupBy("h1", "h2", "n")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "t1", "t2", "batch")).alias("first"))
             .select("h1", "h2", "first", F.monotonically_increasing_id().alias("id")))
    named = keep(named, "classes")
    left = keep(_with_partners(batched, named.select("first.batch", "first.doc_id", "h1", "h2", "id"),
                               blocks(size, exchange.BUCKET_BYTES)), "partners")
    batches = blocks((left.agg(F.sum("n")).first()[0] or 0) * 8, exchange.BATCH_BYTES)
    ready = keep(_ready(left, batches), "ready")
    links = _cell_links(_possible(ready, _families(ready, batches)))
    held = F.col("n") > 0
    member = sets.join(named.select("h1", "h2", "id", "first"), ["h1", "h2"], "left").select(
        "doc_id", "t1", "t2", "n", F.when(held, F.col("id")).alias("id"), F.when(held, F.col("first")).alias("first"))
    return member, named.select("id", "first"), links


def _judged(docs: DataFrame) -> DataFrame:
    """``doc_id, t1, t2, n, first`` of every document: the row that stands for its group, null without shingles."""
    member, classes, links = class_links(docs)
    linked = keep(components(links).join(classes, "id"), "linked")
    firsts = linked.groupBy("component").agg(F.min("first").alias("ahead"))
    ahead = linked.select("id", "component").join(firsts, "component").select("id", "ahead")
    return member.join(ahead, "id", "left").select("doc_id", "t1", "t2", "n", F.coalesce("ahead", "first").alias("first"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    return _judged(docs).select("doc_id", F.col("n").alias("n_shingles"),
                                F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document (the smallest id) of each group of linked documents."""
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("t1") == F.col("first.t1")) & (F.col("t2") == F.col("first.t2"))
    gone = keep(_judged(docs).filter((F.col("n") > 0) & ~stays)
                .select(F.col("doc_id").cast("long").alias("gone"), F.col("t1").alias("g1"), F.col("t2").alias("g2")).distinct(), "gone")
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("gone")) & (F.col("t1") == F.col("g1")) & (F.col("t2") == F.col("g2"))

    def left(rows):
        return rows.select(F.struct("*").alias("row"), *text_marks()).join(gone, same, "left_anti")

    # without an id, equal rows are copies of each other; without shingles, all stay
    unnamed = docs.filter("doc_id is null")
    text = F.coalesce("text", F.lit("")).rlike(WORD)
    return (left(docs.filter("doc_id is not null")).union(left(unnamed.filter(text)).dropDuplicates(["t1", "t2"])).select("row.*")
            .union(unnamed.filter(~text)))

"""Exact vector retrieval (2.10): cosine top-k and context assembly.

Brute-force scoring is the operator (no approximate index). Items are dealt into
shards and queries into blocks of ``block_bytes``; each task scores one shard
against one block by a blocked product over Arrow data and returns at most k rows per query, which a per-query
``row_number() <= k`` merges. One code path serves any number and width of queries, nothing is
broadcast, and no pair table is built.

Ranking uses the full double-precision score; the output is rounded. Vectors that
are null, hold null components, or have length zero take no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.sources.layers import fresh_path

BLOCK_BYTES = 4 << 20
SHARD_ROWS = 65_536


def as_double_array(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def label_centroids(emb: DataFrame, key: str = "label", vec: str = "embedding") -> DataFrame:
    """Mean vector per label (one query per class), built with a partial aggregate per dimension."""
    exploded = emb.select(key, F.posexplode(as_double_array(vec)).alias("pos", "x"))
    per_dim = exploded.groupBy(key, "pos").agg(F.avg("x").alias("x"))
    return (per_dim.groupBy(key)
                   .agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("_p"))
                   .select(F.col(key).alias("query_id"), F.transform("_p", lambda s: s["x"]).alias("query_vec")))


def _usable(df: DataFrame, id_col: str, vec: str, out: str) -> DataFrame:
    v = as_double_array(vec)
    d = df.select(F.col(id_col).alias(out), v.alias("v")).filter("v is not null")
    return (d.filter(~F.exists("v", lambda x: x.isNull()) & F.exists("v", lambda x: x != 0))
             .withColumn("dim", F.size("v")))


def _matrix(t: pa.Table) -> np.ndarray:
    return t["v"].combine_chunks().values.to_numpy(zero_copy_only=False).reshape(len(t), -1)


def _norms(m: np.ndarray) -> np.ndarray:
    total = np.zeros(len(m))
    for x in m.T:
        total += x * x
    return np.sqrt(total)


def best_in_shard(items: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int, cells: int = 1 << 21):
    """Item positions and cosine scores (queries, <= k) of the best items of each query, ties to smaller ids.

    Products are added up component by component, so equal vectors get equal scores wherever they lie.
    """
    order = np.argsort(ids, kind="stable")
    items = items[order]
    qn, n = _norms(queries), _norms(items)
    at, score = np.empty((len(queries), 0), np.int64), np.empty((len(queries), 0))
    step = max(1, cells // max(1, len(queries)))
    for lo in range(0, len(items), step):
        part = items[lo:lo + step]
        s = np.zeros((len(queries), len(part)))
        for x, y in zip(queries.T, part.T):
            s += x[:, None] * y
        s /= qn[:, None] * n[lo:lo + step]
        score = np.hstack([score, s])
        at = np.hstack([at, np.broadcast_to(np.arange(lo, lo + len(part)), s.shape)])
        keep = np.argsort(-score, axis=1, kind="stable")[:, :k]  # stable: earlier ids win ties
        score, at = np.take_along_axis(score, keep, 1), np.take_along_axis(at, keep, 1)
    return order[at], score


def cosine_top_k(items: DataFrame, queries: DataFrame, k: int, item_id: str = "vec_id", vec: str = "embedding",
                 block_bytes: int = BLOCK_BYTES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, vec_id, score, rank): the k items most cosine-similar to each query."""
    it, q = _usable(items, item_id, vec, "item"), _usable(queries, "query_id", "query_vec", "query")
    n, wide = q.agg(F.count(F.lit(1)), F.max("dim")).first()
    blocks = max(1, -(-n * (wide or 0) * 8 // block_bytes))
    shards = max(1, -(-it.count() // shard_rows))
    types = {f.name: f.dataType.simpleString() for f in [*it.schema.fields, *q.schema.fields]}
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    held = it.select("*", F.pmod(F.xxhash64("item"), F.lit(shards)).cast("int").alias("shard")).select("*", each(blocks).alias("block"))
    asked = q.select("*", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block")).select("*", each(shards).alias("shard"))

    def score(q_rows, i_rows):
        if not len(q_rows) or not len(i_rows):
            return pa.table({"query_id": q_rows["query"].slice(0, 0), item_id: i_rows["item"].slice(0, 0),
                             "score": pa.array([], pa.float64())})
        at, s = best_in_shard(_matrix(i_rows), i_rows["item"].to_numpy(), _matrix(q_rows), k)
        which = np.repeat(np.arange(len(at)), at.shape[1])
        return pa.table({"query_id": q_rows["query"].take(pa.array(which)), item_id: i_rows["item"].take(pa.array(at.ravel())),
                         "score": pa.array(s.ravel())})

    found = (asked.groupBy("dim", "shard", "block").cogroup(held.groupBy("dim", "shard", "block"))
             .applyInArrow(score, f"query_id {types['query']}, {item_id} {types['item']}, score double"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(item_id))
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
                 .select("query_id", item_id, F.round("score", 6).alias("score"), "rank"))


# --- exact pruning by balls ------------------------------------------------------------

CENTRES_MOST = 4096  # bounds what is broadcast: CENTRES_MOST vectors
SAMPLE_ROWS = 20_000
SLACK = 1e-7  # radians added to every ball, far above the rounding of angles near 0 and pi


def _unit(m: np.ndarray) -> np.ndarray:
    return m / _norms(m)[:, None]


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def centres_of(sample: np.ndarray, n: int, rounds: int = 5, seed: int = 1) -> np.ndarray:
    """At most ``n`` directions that the sample's vectors gather around (spherical k-means)."""
    unit = np.unique(_unit(sample), axis=0)
    centres = unit[np.random.default_rng(seed).permutation(len(unit))[:n]]
    for _ in range(rounds):
        nearest = (unit @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, nearest, unit)
        norm = np.sqrt((total * total).sum(axis=1))
        centres = np.where(norm[:, None] > 1e-9, total / np.maximum(norm, 1e-9)[:, None], centres)
    return centres


@dataclass
class Balls:
    """Shards of items with the direction each lies around, its greatest angle from it and its number of items."""
    shards: np.ndarray
    centres: np.ndarray
    radius: np.ndarray
    rows: np.ndarray

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No item of the shard has a greater cosine with the query than this."""
        return np.cos(np.maximum(0, _angles(_unit(queries), self.centres) - self.radius - SLACK))


def _arranged(items: DataFrame, shard_rows: int) -> tuple[DataFrame, Balls | None]:
    """``items`` (of one width) as a written table with ``shard``, and the shards' balls: items near one centre, at most about ``shard_rows``."""
    spark, n = items.sparkSession, items.count()
    sample = items.select("v") if n <= SAMPLE_ROWS else items.select("v").sample(SAMPLE_ROWS / n, seed=1)
    taken = np.array([r.v for r in sample.limit(2 * SAMPLE_ROWS).collect()], float)
    if not len(taken):
        return items.withColumn("shard", F.lit(0).cast("long")), None
    wanted = min(CENTRES_MOST, max(1, int(np.sqrt(n))), max(1, len(taken) // 4))
    told = spark.sparkContext.broadcast(centres_of(taken, wanted))

    def place(batches):
        centres = told.value
        for b in batches:
            if b.num_rows:
                unit = _unit(_matrix(pa.table({"v": b.column("v")})))
                near = (unit @ centres.T).argmax(axis=1)
                angle = np.arccos(np.clip((unit * centres[near]).sum(axis=1), -1, 1))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near.astype(np.int64)), pa.array(angle)],
                                                 names=[*b.schema.names, "centre", "angle"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields) + ", centre bigint, angle double"
    path, out = fresh_path(spark, "retrieval/placed"), fresh_path(spark, "retrieval/shards")
    items.mapInArrow(place, ddl).write.parquet(path)
    placed = spark.read.parquet(path)
    # a centre that many items (say equal ones) lie at is dealt into several shards
    parts = placed.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("long").alias("parts"))
    width = 1 << 32
    sharded = placed.join(F.broadcast(parts), "centre").withColumn(  # CENTRES_MOST rows at most
        "shard", F.col("centre") * width + F.pmod(F.xxhash64("item"), F.col("parts")))
    sharded.select(*items.columns, "shard", "angle").write.parquet(out)
    written = spark.read.parquet(out)
    rows = written.groupBy("shard").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n")).orderBy("shard").collect()
    shards = np.array([r.shard for r in rows], np.int64)
    return written.drop("angle"), Balls(shards, told.value[shards // width], np.array([r.radius for r in rows]), np.array([r.n for r in rows]))


def _scored(asked: DataFrame, held: DataFrame, k: int, item_id: str, types: dict, block_bytes: int) -> DataFrame:
    """The k best items of each (query, shard) in ``asked``; a shard's queries are dealt into blocks of ``block_bytes``."""
    need = asked.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) * F.max("dim") * 8 / block_bytes).cast("int").alias("blocks"))
    path = fresh_path(asked.sparkSession, "retrieval/blocks")
    need.write.parquet(path)
    need = asked.sparkSession.read.parquet(path)
    queries = asked.join(need, "shard").withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int")).drop("blocks")
    items = held.join(need, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def score(q_rows, i_rows):
        if not len(q_rows) or not len(i_rows):
            return pa.table({"query_id": q_rows["query"].slice(0, 0), item_id: i_rows["item"].slice(0, 0), "score": pa.array([], pa.float64())})
        at, s = best_in_shard(_matrix(i_rows), i_rows["item"].to_numpy(), _matrix(q_rows), k)
        which = np.repeat(np.arange(len(at)), at.shape[1])
        return pa.table({"query_id": q_rows["query"].take(pa.array(which)), item_id: i_rows["item"].take(pa.array(at.ravel())),
                         "score": pa.array(s.ravel())})

    return (queries.groupBy("shard", "block").cogroup(items.groupBy("shard", "block"))
            .applyInArrow(score, f"query_id {types['query']}, {item_id} {types['item']}, score double"))


def pruned_top_k(items: DataFrame, queries: DataFrame, k: int, item_id: str = "vec_id", vec: str = "embedding",
                 block_bytes: int = BLOCK_BYTES, shard_rows: int = 8_192) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`cosine_top_k`, and ``query_id, pairs, scored``: how many items each query was scored against, of how many.

    Items lie in shards around centres; a shard's centre and greatest angle bound the cosine of all its items with a query. Each query is
    scored against its nearest shards until these hold k items, which gives it a k-th best score; then against every other
    shard whose bound reaches that score. All other shards can hold no better item, nor one of equal score.
    Centres come from a sample and only set how much is pruned. Items of one width are arranged; widths are treated one by one.
    """
    it, q = _usable(items, item_id, vec, "item"), _usable(queries, "query_id", "query_vec", "query")
    types = {f.name: f.dataType.simpleString() for f in [*it.schema.fields, *q.schema.fields]}
    spark, found, shares = items.sparkSession, [], []
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(item_id))
    for (dim,) in q.select("dim").distinct().collect():
        held, balls = _arranged(it.filter(F.col("dim") == dim), shard_rows)
        if balls is None:
            continue
        told = spark.sparkContext.broadcast(balls)
        ddl = f"query {types['query']}, v array<double>, dim int, shard bigint, n bigint"

        def route(batches, later: bool, told=told):
            """A row per query and shard that it has to be scored against, first or later on."""
            b = told.value
            for part in batches:
                if part.num_rows:
                    bounds = b.bounds(_matrix(pa.table({"v": part.column("v")})))
                    order = np.argsort(-bounds, axis=1, kind="stable")
                    first = np.zeros(bounds.shape, bool)  # the nearest shards up to k items
                    np.put_along_axis(first, order, np.cumsum(b.rows[order], axis=1) - b.rows[order] < k, axis=1)
                    if later:
                        have, least = (part.column(c).to_numpy()[:, None] for c in ("have", "least"))
                        first = ~first & ((have < k) | (bounds >= least - SLACK))
                    which, shard = np.nonzero(first)
                    yield pa.RecordBatch.from_arrays([*[part.column(c).take(pa.array(which)) for c in ("query", "v", "dim")], pa.array(b.shards[shard]),
                                                      pa.array(b.rows[shard].astype(np.int64))], names=["query", "v", "dim", "shard", "n"])

        def written(df, name):
            path = fresh_path(spark, f"retrieval/{name}")
            df.write.parquet(path)
            return spark.read.parquet(path)

        mine = q.filter(F.col("dim") == dim)
        asked = written(mine.mapInArrow(lambda x: route(x, False), ddl), "first")
        nearest = written(_scored(asked.drop("n"), held, k, item_id, types, block_bytes), "nearest")
        least = (nearest.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).groupBy(F.col("query_id").alias("query"))
                 .agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("have")))
        reached = written(mine.join(least, "query").mapInArrow(lambda x: route(x, True), ddl), "reached")
        found.append(nearest.unionByName(_scored(reached.drop("n"), held, k, item_id, types, block_bytes)))
        shares.append(asked.unionByName(reached).groupBy(F.col("query").alias("query_id"))
                      .agg(F.lit(int(balls.rows.sum())).alias("pairs"), F.sum("n").alias("scored")))
    if not found:
        empty = spark.createDataFrame([], f"query_id {types['query']}, {item_id} {types['item']}, score double, rank int")
        return empty, spark.createDataFrame([], f"query_id {types['query']}, pairs bigint, scored bigint")
    rows = reduce(DataFrame.unionByName, found)
    return (rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
                .select("query_id", item_id, F.round("score", 6).alias("score"), "rank"), reduce(DataFrame.unionByName, shares))


def build_context(ranked: DataFrame, texts: DataFrame, item_id: str = "vec_id",
                  text: str = "text") -> DataFrame:
    """Join retrieved texts in rank order with newlines: one context per query (k texts).

    The ranked rows (queries x k) are written once so the planner sizes them
    from file statistics: under the broadcast threshold they are broadcast into
    one streamed scan of the text table, which is never shuffled. The inner join
    comes first because a left outer join can only broadcast its right side;
    ranks without a text are restored by a join of two small tables.
    """
    spark = ranked.sparkSession
    path = fresh_path(spark, "retrieval/ranked")
    ranked.select("query_id", item_id, "rank").write.parquet(path)
    r = spark.read.parquet(path)
    found = texts.select(F.col(item_id), F.col(text)).join(r, item_id).select("query_id", item_id, text)
    j = r.join(found, ["query_id", item_id], "left")
    return (j.groupBy("query_id")
             .agg(F.array_sort(F.collect_list(F.struct("rank", F.coalesce(F.col(text), F.lit(""))
                                                       .alias("t")))).alias("_d"))
             .select("query_id", F.concat_ws("\n", F.transform("_d", lambda s: s["t"])).alias("context")))

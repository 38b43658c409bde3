"""Approximate nearest neighbours by inner product: one navigable small-world graph per shard.

Vectors are dealt into shards by a hash of the vector, so that copies meet and are one graph
node with their smallest ids (as many as a result can hold, and the query's own). A component that brings all
vectors of a shard to its largest norm turns the inner product into nearness between nodes. That only works in
single precision while norms are alike and of moderate size, so a shard holds vectors of one norm band (a
factor of ``2 ** BAND_BITS``) and works on them, and on queries, scaled by powers of two. Each
shard is a layered graph, built in batches that double: a batch searches the graph so far,
is compared with itself, and linked both ways with the usual diversity rule. A graph is
stored as one row of flat arrays (ids, vectors, neighbour lists per layer).

Queries go to every shard in blocks; a task searches one block in one shard, all
queries of the block in step. Each query gets its best of every shard, merged by exact
double-precision inner products, ties to the smaller id.

Defined cases: null vectors, zero vectors and vectors with null, NaN or infinite components take no part, neither
as query nor as candidate; vectors only meet vectors of their own length; equal rows (id and vector) are one
candidate and one query; an id with several vectors is a candidate with each, and a query with each (every one has its own
list, ranked from 1), but a query never meets its own id; a null id takes no part; fewer than ``k`` candidates are all returned;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.llm.store import blocks, keep

SHARD_ROWS = 8192
BAND_BITS = 4       # norms of a shard differ by less than a factor of 16
BLOCK_QUERIES = 2048
LINKS = 16          # per node and upper layer; twice as many on the bottom layer
EF_BUILD = 64
EF_SEARCH = 128
STEP = 4            # nodes expanded at once

INDEX_DDL = "dim int, shard int, nodes int, ids binary, of binary, vectors binary, layers array<binary>, members array<binary>"
HIT_DDL = "query bigint, query_id bigint, ids array<bigint>, scores array<double>"


class Layer:
    """Neighbour lists of the nodes of one layer: ``links[i, j]`` is a node number, -1 where empty."""

    def __init__(self, nodes: np.ndarray, width: int, links: np.ndarray | None = None):
        self.nodes, self.width = nodes, width
        self.links = np.full((len(nodes), width), -1, np.int32) if links is None else links


def beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, start: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """Best ``ef`` nodes of every query (numbers and similarities, best first, -1 where none), searched in step.

    ``x`` are the layer's vectors, ``start`` (queries, s) are entry nodes.
    """
    n_q, n = len(q), len(x)
    seen = np.zeros((n_q, n), bool)
    rows = np.arange(n_q)[:, None]
    ids = np.full((n_q, ef), -1, np.int32)
    sim = np.full((n_q, ef), -np.inf, np.float32)
    done = np.ones((n_q, ef), bool)

    def take(at, new):
        """Merge new nodes (queries ``at``, candidates) into the beams."""
        new = np.where(new >= 0, new, 0), new >= 0
        good = new[1] & ~seen[at[:, None], new[0]]
        s = np.sort(np.where(good, new[0], n), axis=1)  # drop doubles
        good = s < n
        good[:, 1:] &= s[:, 1:] != s[:, :-1]
        s = np.where(good, s, 0)
        seen[np.broadcast_to(at[:, None], s.shape)[good], s[good]] = True
        v = np.where(good, np.einsum("qcd,qd->qc", x[s], q[at]), -np.inf).astype(np.float32)
        all_ids = np.hstack([ids[at], np.where(good, s, -1)])
        all_sim = np.hstack([sim[at], v])
        all_done = np.hstack([done[at], ~good])
        best = np.argsort(-all_sim, axis=1, kind="stable")[:, :ef]
        ids[at] = np.take_along_axis(all_ids, best, 1)
        sim[at] = np.take_along_axis(all_sim, best, 1)
        done[at] = np.take_along_axis(all_done, best, 1)

    take(np.arange(n_q), start)
    while True:
        active = np.flatnonzero((~done).any(1))
        if not len(active):
            return ids, sim
        pick = np.argsort(done[active], axis=1, kind="stable")[:, :STEP]  # beams are sorted: first open ones are best
        opened = ~np.take_along_axis(done[active], pick, 1)
        node = np.where(opened, np.take_along_axis(ids[active], pick, 1), -1)
        done[active[:, None], pick] = True
        near = np.where((node >= 0)[:, :, None], links[np.maximum(node, 0)], -1)
        take(active, near.reshape(len(active), -1))


def diverse(x: np.ndarray, own: np.ndarray, cand: np.ndarray, width: int) -> np.ndarray:
    """Of each node's candidates, those nearer to it than to a chosen one, then the nearest others, up to ``width``."""
    ok = cand >= 0
    c = x[np.maximum(cand, 0)]
    to_own = np.where(ok, np.einsum("ncd,nd->nc", c, own), -np.inf)
    order = np.argsort(-to_own, axis=1, kind="stable")
    cand, to_own = np.take_along_axis(cand, order, 1), np.take_along_axis(to_own, order, 1)
    c = np.take_along_axis(c, order[:, :, None], 1)
    between = np.einsum("nad,nbd->nab", c, c)
    ok = cand >= 0
    chosen = np.zeros(cand.shape, bool)
    for j in range(cand.shape[1]):
        covered = (chosen & (between[:, j] > to_own[:, j:j + 1])).any(1)
        chosen[:, j] = ok[:, j] & ~covered & (chosen.sum(1) < width)
    rank = np.argsort(np.where(chosen, 0, np.where(ok, 1, 2)), axis=1, kind="stable")[:, :width]
    out = np.take_along_axis(np.where(ok, cand, -1), rank, 1)
    return out if out.shape[1] == width else np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1)


def build_layer(x: np.ndarray, width: int, ef: int = EF_BUILD, batch: int = 512) -> np.ndarray:
    """Neighbour lists of the vectors ``x`` (numbers are rows of ``x``)."""
    n = len(x)
    links = np.full((n, width), -1, np.int32)
    lo = 0
    while lo < n:
        hi = min(n, max(64, 2 * lo), lo + batch)
        new = np.arange(lo, hi)
        inside = x[new] @ x[new].T
        np.fill_diagonal(inside, -np.inf)
        k = min(ef, len(new) - 1)
        cand = np.argsort(-inside, axis=1)[:, :k].astype(np.int32) + lo if k > 0 else np.empty((len(new), 0), np.int32)
        if lo:
            start = np.broadcast_to((np.arange(8) * lo // 8).astype(np.int32), (len(new), 8))
            cand = np.hstack([beam(x[:lo], links[:lo], x[new], start, min(ef, lo))[0], cand])
        if cand.shape[1]:
            links[new] = diverse(x, x[new], cand, width)
            source = np.repeat(new, width)
            target = links[new].ravel()
            source, target = source[target >= 0], target[target >= 0]
            order = np.argsort(target, kind="stable")
            source, target = source[order], target[order]
            hit, first, count = np.unique(target, return_index=True, return_counts=True)
            for part in range(0, len(hit), 1024):
                h, f, c = hit[part:part + 1024], first[part:part + 1024], count[part:part + 1024]
                cols = np.arange(c.max())
                back = np.where(cols < c[:, None], source[np.minimum(f[:, None] + cols, len(source) - 1)], -1)
                old = links[h]
                back = np.where((back[:, :, None] == old[:, None, :]).any(2), -1, back)
                links[h] = diverse(x, x[h], np.hstack([old, back]).astype(np.int32), width)
        lo = hi
    return links


def build(x: np.ndarray, seed: int = 3) -> list[Layer]:
    """Layers from the bottom up; each upper layer holds one node in ``LINKS`` of the layer below."""
    rng = np.random.default_rng(seed)
    layers, nodes = [], np.arange(len(x))
    while True:
        width = LINKS if layers else 2 * LINKS
        layers.append(Layer(nodes, width, build_layer(x[nodes], width)))
        if len(nodes) <= 4 * LINKS:
            return layers
        nodes = np.sort(rng.choice(nodes, max(1, len(nodes) // LINKS), replace=False))


def search(x: np.ndarray, layers: list[Layer], q: np.ndarray, ef: int = EF_SEARCH) -> np.ndarray:
    """Node numbers of the best ``ef`` found for every query, -1 where fewer."""
    start = np.zeros((len(q), 1), np.int32)
    for layer in reversed(layers[1:]):
        found, _ = beam(x[layer.nodes], layer.links, q, start, STEP * 2)
        below = layers[layers.index(layer) - 1].nodes
        start = np.where(found >= 0, np.searchsorted(below, layer.nodes[np.maximum(found, 0)]), -1).astype(np.int32)
    return beam(x, layers[0].links, q, start, min(ef, len(x)))[0]


def augmented(v: np.ndarray, top: float) -> np.ndarray:
    """One more component that brings every vector to the squared norm ``top``."""
    rest = np.sqrt(np.maximum(top - np.einsum("nd,nd->n", v, v), 0))
    return np.hstack([v, rest[:, None]]).astype(np.float32)


def scaled(v: np.ndarray, axis: int | None = None) -> np.ndarray:
    """``v`` (or each of its rows) by a power of two that brings the largest component into 0.5 to 1."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=axis, keepdims=True))[1])


def products(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows, added up component by component (equal vectors get equal sums)."""
    total = np.zeros(len(v))
    for a, b in zip(v.T, q.T):
        total += a * b
    return total


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v: array<double>, dim, band`` of vectors that take part; norms of 1 are in the middle of band 0."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    most = F.array_max(F.transform("v", F.abs))
    bits = F.log2("most") + F.log2(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.col("most")) * (x / F.col("most")))) / 2
    return (vectors.select(F.col("vec_id").cast("long"), v.alias("v")).filter("v is not null and vec_id is not null")
            .filter(~bad & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v")).withColumn("most", most)
            .withColumn("band", F.floor(bits / BAND_BITS + 0.5).cast("int")).drop("most"))


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard of ``usable`` vectors without equal rows."""
    bands, first = [], 0
    for band, rows in sorted(vectors.groupBy("band").count().collect()):  # a few hundred at most: exponents of a double
        bands.append((band, first, blocks(rows, shard_rows)))
        first += bands[-1][2]
    bands = F.broadcast(vectors.sparkSession.createDataFrame(bands, "band int, first int, shards int"))
    same = Window.partitionBy("v").orderBy("vec_id")
    rows = vectors.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1)

    def index(key, t):
        ids = t["vec_id"].to_numpy()
        v = t["v"].combine_chunks().values.to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        order = np.lexsort((ids, *v.T[::-1]))
        ids, v = ids[order], v[order]
        first = np.r_[True, (v[1:] != v[:-1]).any(1)]
        nodes = v[first]
        spread = np.random.default_rng(len(nodes)).permutation(len(nodes))  # nodes enter the graph in random order
        place = np.empty_like(spread)
        place[spread] = np.arange(len(nodes))
        of = place[np.cumsum(first) - 1]
        by_node = np.argsort(of, kind="stable")
        x = scaled(nodes[spread])
        layers = build(augmented(x, float(np.einsum("nd,nd->n", x, x).max())))
        return pa.table({
            "dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
            "nodes": pa.array([len(nodes)], pa.int32()), "ids": [ids[by_node].tobytes()],
            "of": [of[by_node].astype(np.int32).tobytes()], "vectors": [nodes[spread].tobytes()],
            "layers": pa.array([[x.links.astype(np.int32).tobytes() for x in layers]], pa.list_(pa.binary())),
            "members": pa.array([[x.nodes.astype(np.int64).tobytes() for x in layers]], pa.list_(pa.binary()))})

    rows = rows.join(bands, "band").withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("v"), F.col("shards"))).cast("int"))
    rows = rows.select("vec_id", "v", "dim", "shard")
    return keep(rows.groupBy("dim", "shard").applyInArrow(index, INDEX_DDL), "hnsw")


def nearest(vectors: DataFrame, is_query, k: int = 20, shard_rows: int = SHARD_ROWS, ef: int = EF_SEARCH) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every vector that ``is_query`` (a column) selects."""
    vectors = keep(usable(vectors).distinct(), "vectors")
    index = build_index(vectors, k, shard_rows)
    # numbered once, as an id may repeat with other vectors
    queries = keep(vectors.filter(is_query).select(F.monotonically_increasing_id().alias("query"), F.col("vec_id").alias("query_id"),
                                                   "v", "dim"), "queries")
    parts = blocks(queries.count(), BLOCK_QUERIES)
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    asked = (queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def run(key, asked, held):
        out = {"query": [], "query_id": [], "ids": [], "scores": []}
        if len(asked) and len(held):
            r, dim = held.to_pylist()[0], key[0].as_py()
            ids, of = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["of"], np.int32)
            nodes = np.frombuffer(r["vectors"]).reshape(-1, dim)
            start = np.searchsorted(of, np.arange(len(nodes) + 1))
            layers = [Layer(np.frombuffer(m, np.int64), 0, np.frombuffer(x, np.int32).reshape(-1, LINKS if i else 2 * LINKS))
                      for i, (x, m) in enumerate(zip(r["layers"], r["members"]))]
            x = np.hstack([scaled(nodes), np.zeros((len(nodes), 1))]).astype(np.float32)  # queries have no rest component
            q = asked["v"].combine_chunks().values.to_numpy(zero_copy_only=False).reshape(-1, dim)
            q0 = np.hstack([scaled(q, 1), np.zeros((len(q), 1))]).astype(np.float32)
            names = zip(asked["query"].to_pylist(), asked["query_id"].to_pylist())
            for i, ((number, query), found) in enumerate(zip(names, search(x, layers, q0, max(ef, k + 1)))):
                found = found[found >= 0]
                score = products(nodes[found], np.broadcast_to(q[i], (len(found), dim)))
                hit = np.concatenate([ids[start[f]:start[f + 1]] for f in found])
                score = np.repeat(score, start[found + 1] - start[found])
                order = np.lexsort((hit, -score))
                order = order[hit[order] != query][:k]
                for name, value in zip(out, (number, query, hit[order], score[order])):
                    out[name].append(value)
        return pa.table({"query": pa.array(out["query"], pa.int64()), "query_id": pa.array(out["query_id"], pa.int64()), "ids": pa.array(out["ids"], pa.list_(pa.int64())),
                         "scores": pa.array(out["scores"], pa.list_(pa.float64()))})

    hits = (asked.groupBy("dim", "shard", "block").cogroup(held.groupBy("dim", "shard", "block")).applyInArrow(run, HIT_DDL)
            .select("query", "query_id", F.explode(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("scores").alias("score"))).alias("h"))
            .select("query", "query_id", "h.*"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (hits.toDF("query", "query_id", "vec_id", "score").withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))

"""Exact retrieval with pruning by balls."""

import numpy as np
import pytest

from aerolith.operators import retrieval


def _frame(spark, rows, names):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], f"{names[0]} long, {names[1]} array<double>")


def _same(spark, items, queries, k, **settings):
    got, shares = retrieval.pruned_top_k(items, queries, k, **settings)
    want = retrieval.cosine_top_k(items, queries, k)
    key = lambda df: sorted(tuple(r) for r in df.select("query_id", "vec_id", "score", "rank").collect())
    assert key(got) == key(want)
    return shares.collect()


def test_clustered_vectors_are_mostly_left_out(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(40, 24))
    vectors = centres[np.arange(4000) % 40] + r.normal(size=(4000, 24)) * 0.15
    scale = 10.0 ** r.integers(-3, 4, size=4000)[:, None]
    items = _frame(spark, list(enumerate(vectors * scale)), ("vec_id", "embedding")).repartition(4)
    queries = _frame(spark, [(i, centres[i] + r.normal(size=24) * 0.1) for i in range(30)], ("query_id", "query_vec"))
    shares = _same(spark, items, queries, 5, shard_rows=64)
    share = sum(s.scored for s in shares) / sum(s.pairs for s in shares)
    assert len(shares) == 30 and all(s.pairs == 4000 for s in shares) and share < 0.5, share


@pytest.mark.parametrize("k", [1, 7, 500])
def test_hard_vectors(spark, k):
    """Vectors without clusters, equal ones (more than a shard holds), opposite ones, unusable ones, other widths; k past the items."""
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=6)) for i in range(200)] + [(1000 + i, [1, 2, 3, 4, 5, 6]) for i in range(90)] + [(2000 + i, [-1, -2, -3, -4, -5, -6]) for i in range(5)]
    rows += [(3000, None), (3001, [0] * 6), (3002, [1, 0, 0]), (3003, [0, 1, 1])]
    items = _frame(spark, rows, ("vec_id", "embedding")).repartition(3)
    queries = _frame(spark, [(1, [1, 2, 3, 4, 5, 6]), (2, [-6, 5, -4, 3, -2, 1]), (3, [0, 0, 1]), (4, None), (5, [0] * 6), (6, [1, 1])], ("query_id", "query_vec"))
    _same(spark, items, queries, k, shard_rows=16, block_bytes=64)


def test_nothing(spark):
    none = _frame(spark, [], ("vec_id", "embedding"))
    some = _frame(spark, [(1, [1, 2])], ("query_id", "query_vec"))
    assert retrieval.pruned_top_k(none, some, 3)[0].collect() == []
    assert retrieval.pruned_top_k(_frame(spark, [(1, [1, 2])], ("vec_id", "embedding")), some.limit(0), 3)[0].collect() == []

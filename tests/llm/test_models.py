"""Chat templates, quality scores, neighbour graphs and the pipeline."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TEXTS = ["", "plain", "<|im_end|>", "<|im_start|>user<|im_sep|>x", "</s>[INST] ok [/INST]", "<<SYS>>[</s>", "<\\|a|>", "[\\\\INST]",
         "<s><s", "[[INST]]", "<", "[/INST", "\\", "a\nb", "日本 😀<|x|>"]


def test_chat_round_trip(spark):
    from aerolith.llm import chat_format
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    rows = df.select("t", chat_format.escape(F.col("t")).alias("e"), chat_format.unescape(chat_format.escape(F.col("t"))).alias("u")).collect()
    assert all(r.t == r.u for r in rows) and len({r.e for r in rows}) == len(TEXTS)
    for r in rows:
        assert "<|" not in r.e.replace("<\\", "") or "|>" not in r.e
        for control in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", chat_format.START, chat_format.SEP, chat_format.END):
            assert control not in r.e


def test_chat_examples(spark):
    from aerolith.llm import chat_format
    rows = [(1, 0, "system", TEXTS[4]), (1, 1, "user", "q"), (1, 2, "assistant", TEXTS[3]), (1, 3, "user", None), (1, 4, "assistant", "done"),
            (1, 5, None, "tail"), (2, 0, "user", "alone"), (None, None, None, None), (3, 0, "assistant", "a"), (3, 0, "assistant", "a")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, example string")
    got = chat_format.format_chats(turns).collect()
    spans = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r.example):
        spans[r.conv_id].append(r.text[r.loss_start:r.loss_end])
        assert r.text.endswith(chat_format.END)
    assert len(spans[1]) == 3 and spans[1][1] == "done" and spans[1][2] == "" and spans[2] == [""] and spans[3] == ["a", "a"] and spans[None] == [""]
    back = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chats(turns)).collect()}
    assert back[1].n_turns == 6 and back[1].loss_chars == len(TEXTS[3]) + 4 and back[3].loss_chars == 2 and back[2].loss_chars == 0


def test_quality_held_out(spark):
    from aerolith.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op4_quality"][0](spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert len(got) == docs and got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got.doc_id, got.held_out))
    m = got.merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    m = m[m.held_out]
    good, bad = m.score[m.quality == 1].to_numpy(), m.score[m.quality == 0].to_numpy()
    auc = ((good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2)
    assert auc > 0.95 and (m.predicted == m.quality).mean() > 0.93


def test_quality_ignores_held_out_labels(spark, hard_docs):
    """Scores depend on texts and labels of the fitting folds alone; hard rows all get one."""
    from aerolith.llm import quality
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    twisted = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = ({r.doc_id: round(r.score, 6) for r in quality.score_quality(docs, x).collect()} for x in (labels, twisted))
    assert one == two
    hard = quality.score_quality(hard_docs, labels.unionByName(spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 5, 1)], labels.schema)))
    assert hard.count() == hard_docs.count() and hard.filter("score is null or score < 0 or score > 1").count() == 0
    kept = quality.accepted(hard_docs, labels)
    assert kept.columns == hard_docs.columns


def test_isotonic():
    from aerolith.llm.quality import isotonic
    x, y = isotonic(np.array([0., 1, 2, 3, 4]), np.array([0., 1, 0, 1, 1]), np.array([1., 1, 3, 1, 1]))
    assert (np.diff(y) >= 0).all() and np.allclose(y, [0, 0.25, 1]) or np.allclose(y, [0, 0.25, 1, 1])


@pytest.mark.parametrize("shard_rows", [64, 8192])
def test_neighbours_recall(spark, shard_rows):
    from aerolith.llm import hnsw
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = df.collect()
    x = np.array([r.embedding for r in rows], float)
    ids = np.array([r.vec_id for r in rows])
    got = collections.defaultdict(list)
    for r in sorted(hnsw.nearest(df, F.col("vec_id") % 20 == 0, shard_rows=shard_rows).collect(), key=lambda r: r["rank"]):
        got[r.query_id].append((r.vec_id, r.score))
    recall = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        want = [i for i in ids[np.lexsort((ids, -s))] if i != ids[q]][:20]
        found = got[ids[q]]
        recall.append(len({i for i, _ in found} & set(want)) / 20)
        assert all(abs(s[np.flatnonzero(ids == i)[0]] - v) < 1e-12 for i, v in found) and len(found) == 20
    assert np.mean(recall) >= 0.95


def test_neighbours_long_vectors(spark):
    """A few vectors 1e3 to 1e20 (and 1e37) times longer leave the neighbours of the others as they are."""
    from aerolith.llm import hnsw
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    far = [1e3, 1e4, 1e6, 1e10, 1e20, 1e37]
    x[:len(far)] *= np.array(far)[:, None]
    x[len(far):2 * len(far)] /= np.array(far)[:, None]
    x = x.astype(np.float32).astype(float)
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id bigint, embedding array<float>")
    got = collections.defaultdict(list)
    for r in hnsw.nearest(df, F.col("vec_id") % 40 == 0, ef=64).collect():
        got[r.query_id].append(r.vec_id)
    recall = []
    for q in range(0, len(x), 40):
        s = x @ x[q]
        s[q] = -np.inf
        want = np.lexsort((ids, -s))[:20]
        assert set(want[want < len(far)]) <= set(got[q])
        recall.append(len(set(want) & set(got[q])) / 20)
    assert np.mean(recall) >= 0.9, np.mean(recall)


def test_neighbours_hard(spark):
    from aerolith.llm import hnsw
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [-3.0, 4.0]), (40, [1.0, 2.0, 3.0]), (9, []), (None, [1.0, 1.0]), (60, [0.0, 0.0])]
    rows += [(100 + i, [2.0, 1.0]) for i in range(1, 60)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, shard int")
    got = collections.defaultdict(list)
    for r in sorted(hnsw.nearest(df, F.col("vec_id") % 20 == 0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    copies = [100 + i for i in range(1, 60)]
    assert [i for i, _ in got[0]] == copies[:20] and [i for i, _ in got[20]] == copies[:20]
    assert [i for i, _ in got[120]] == [i for i in copies if i != 120][:20] and got[120][0][1] == 5.0
    assert 40 not in got and 60 not in got


def test_neighbours_repeated_rows(spark):
    """A row repeated 30 times is one query and one candidate; an id with two vectors has a list for each."""
    from aerolith.llm import hnsw
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 8)).astype(np.float32).astype(float)
    rows = [(i, x[i]) for i in range(60)] + [(0, x[0])] * 29
    rows += [(100 + i, x[0]) for i in range(30)]  # equal vectors with larger ids than the repeated query's
    rows += [(1, x[2])]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id bigint, embedding array<float>")
    pairs = {(i, tuple(v)) for i, v in rows}

    def want(query, v):
        near = sorted((-float(np.dot(v, w)), i) for i, w in pairs if i != query)[:20]
        return [(i, round(-s, 9)) for s, i in near]

    got = collections.defaultdict(list)
    for r in hnsw.nearest(df, F.col("vec_id") < 2).collect():
        got[r.query_id].append((r["rank"], r.vec_id, round(r.score, 9)))
    assert sorted(got[0]) == [(j + 1, *hit) for j, hit in enumerate(want(0, x[0]))]
    both = [(j + 1, *hit) for v in (x[1], x[2]) for j, hit in enumerate(want(1, v))]
    assert sorted(got[1]) == sorted(both)


def test_pipeline(spark):
    """Every stage against its own input."""
    import corpus_pipeline as cp
    from aerolith.llm import line_dedup, mixing, ngram_join, quality
    from aerolith.llm.store import keep
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in cp.STAGES:
        out = keep(stage(spark, docs, SF), "test-stage")
        seen.append((name, docs, out))
        docs = out
    for name, before, after in seen[:-1]:
        assert after.columns == columns, name
    _, before, after = seen[0]
    scores = {r.doc_id: r.predicted for r in quality.score_quality(before, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert {r.doc_id for r in after.collect()} == {d for d, p in scores.items() if p == 1}
    _, before, after = seen[1]
    assert {r.doc_id: r.text for r in after.collect()} == {r.doc_id: r.text for r in line_dedup.dedup_lines(before).collect()}
    _, before, after = seen[2]
    groups = collections.defaultdict(list)
    for r in ngram_join.near_duplicates(before).collect():
        groups[r.component_id].append(r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(min(g) for g in groups.values())
    _, before, after = seen[3]
    assert after.count() == mixing.mix(before).agg(F.sum(F.col("copies") * F.col("rows"))).first()[0]
    _, before, after = seen[4]
    assert after.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
    assert after.filter("start = 0").count() == before.count()
    assert cp.run(spark, SF).count() == after.count()

"""The pipeline on hard rows, and the quality score against a plain computation."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def labelled(spark, tmp_path):
    """A folder whose ``labels`` hold nulls, repeats and unknown ids; and one whose ``labels`` are empty."""
    rows = [(i, i % 2, 0) for i in range(1, 16)] + [(None, 1, 0), (3, None, 1), (3, 1, 0), (999, 0, 0), (5, 7, None)]
    frame = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for name, part in (("some", frame), ("none", frame.limit(0))):
        part.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    return str(tmp_path)


def _key(r):
    return str(r.doc_id), str(r.text), str(r.source)


@pytest.mark.parametrize("labels", ["some", "none"])
def test_pipeline_on_hard_rows(spark, hard_docs, labelled, labels):
    import corpus_pipeline as cp
    from aerolith.llm import line_dedup, mixing, ngram_join, quality
    from aerolith.llm.store import keep
    sf, docs, seen = f"{labelled}/{labels}", hard_docs, []
    for name, stage in cp.STAGES:
        out = keep(stage(spark, docs, sf), "hard-stage")
        seen.append((docs, out))
        docs = out
    for before, after in seen[:-1]:
        assert after.columns == hard_docs.columns
    before, after = seen[0]
    given = spark.read.parquet(f"{sf}/labels.parquet")
    good = collections.Counter((str(r.doc_id), r.predicted) for r in quality.score_quality(before, given).collect())
    kept = collections.Counter(str(r.doc_id) for r in after.collect())
    assert kept == collections.Counter({i: n for (i, p), n in good.items() if p == 1})
    if labels == "none":
        assert after.count() == before.count()
    before, after = seen[1]
    assert sorted(map(_key, after.collect())) == sorted(map(_key, line_dedup.dedup_lines(before, counts=False).collect()))
    assert all(r.n_chars == len(r.text) for r in after.collect())
    before, after = seen[2]
    assert sorted(map(_key, after.collect())) == sorted(map(_key, ngram_join.one_per_group(before).collect()))
    before, after = seen[3]
    copies = collections.Counter()
    for r in mixing.mix(before).collect():
        copies[str(r.doc_id), str(r.source)] += r.copies * r.rows
    assert collections.Counter((str(r.doc_id), str(r.source)) for r in after.collect()) == +copies
    before, after = seen[4]
    assert after.filter("start = 0").count() == before.count()
    spans = collections.defaultdict(list)
    for r in after.collect():
        spans[r.sequence_id].append((r.offset, r.length))
    for pieces in spans.values():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:])) and sum(n for _, n in pieces) <= 1024


def test_pipeline_on_an_empty_table(spark, no_docs, labelled):
    import corpus_pipeline as cp
    from aerolith.llm.store import keep
    docs = no_docs
    for name, stage in cp.STAGES:
        docs = keep(stage(spark, docs, f"{labelled}/some"), "empty-stage")
        assert docs.isEmpty(), name


def test_pipeline_run_with_nulls_and_repeats(spark, tmp_path, labelled):
    """``run`` over tables of the documents' own columns with a third of the rows without an id."""
    import corpus_pipeline as cp
    rows = [(None if i % 3 == 0 else i // 2, None if i % 11 == 0 else " ".join(f"w{(i // 4 * 7 + j) % 50}" for j in range(30 + i % 5)),
             None if i % 5 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", None) for i in range(60)]
    rows += rows[:10]
    spark.createDataFrame(rows, DOCUMENT).write.parquet(f"{tmp_path}/t/documents.parquet")
    spark.read.parquet(f"{labelled}/some/labels.parquet").write.parquet(f"{tmp_path}/t/labels.parquet")
    out = cp.run(spark, f"{tmp_path}/t")
    assert out.count() > 0 and out.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 1024


# -- quality --------------------------------------------------------------------------------------------------------

def plain_statistics(text):
    raw = (text or "").encode()
    ws, n = raw.split(), max(1, len(raw))
    lens = [len(w) for w in ws] or [0]
    mean = sum(lens) / len(lens)
    lines = [x for x in (text or "").split("\n") if x]
    share = lambda chars: sum(b in chars for b in raw) / n
    upper, lower = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
    distinct = len(set(ws)) / max(1, len(ws))
    counts = collections.Counter(raw)
    return [math.log(1 + len(raw)), math.log(1 + len(ws)), mean, math.sqrt(sum((x - mean) ** 2 for x in lens) / len(lens)), math.log(1 + max(lens)),
            share(upper + lower), share(upper), share(b"0123456789"), share(b" \t\r\x0b\x0c"), share(b"\n"), share(b".!?"), share(b",;:'\"()-"),
            share(b"|#$%&*<>=+@/\\_~^[]{}`"), sum(b > 127 for b in raw) / n, distinct, distinct * math.log(1 + len(ws)),
            len(set(lines)) / max(1, len(lines)), math.log(1 + len(ws) / max(1, len(lines))), sum(x <= 3 for x in lens) / len(lens),
            float(raw[-1:] in (b".", b"!", b"?")), -sum(c / n * math.log(c / n) for c in counts.values()),
            sum(w.isalpha() for w in ws) / len(ws) if ws else 0.0, sum(a == b for a, b in zip(ws, ws[1:])) / max(1, len(ws))]


def plain_scores(docs, labels, q):
    """The whole model on one matrix."""
    x = np.array([plain_statistics(t) for _, t in docs])
    mean, std = x.mean(0), x.std(0)
    rng = np.random.default_rng(q.SEED)
    w, phase = rng.standard_normal((x.shape[1], q.FEATURES)) / np.sqrt(x.shape[1]), rng.uniform(0, 2 * np.pi, q.FEATURES)
    z = np.clip((x - mean) / np.where(std > 1e-9, std, 1), -8, 8)
    z = np.c_[np.ones(len(x)), np.cos(z @ w + phase) * np.sqrt(2 / q.FEATURES)]
    told = collections.defaultdict(list)
    for i, y in labels:
        if y in (0, 1):
            told[i].append(y)
    fold = [zlib.crc32(str(i).encode()) % 3 for i, _ in docs]
    fit = [r for r, (i, _) in enumerate(docs) if i in told and fold[r] == 0]
    check = [r for r, (i, _) in enumerate(docs) if i in told and fold[r] == 2]
    y = np.array([np.mean(told[i]) if i in told else np.nan for i, _ in docs])
    a = z[fit].T @ z[fit] / len(fit) + q.RIDGE * np.eye(z.shape[1])
    raw = np.clip(z @ np.linalg.solve(a, z[fit].T @ y[fit] / len(fit)), -0.5, 1.5)
    bins = collections.defaultdict(list)
    for r in check:
        bins[min(int((raw[r] + 0.5) / 2 * q.BINS), q.BINS - 1)].append(r)
    pools = [[len(m), raw[m].mean(), y[m].mean()] for _, m in sorted(bins.items())]
    while True:  # merge the first pair that does not rise, until all do
        at = next((i for i in range(len(pools) - 1) if pools[i][2] >= pools[i + 1][2]), None)
        if at is None:
            break
        (n1, s1, y1), (n2, s2, y2) = pools[at], pools[at + 1]
        pools[at:at + 2] = [[n1 + n2, (n1 * s1 + n2 * s2) / (n1 + n2), (n1 * y1 + n2 * y2) / (n1 + n2)]]
    level = np.interp(raw, [p[1] for p in pools], [p[2] for p in pools])
    return np.clip((1 - q.TILT) * level + q.TILT * (raw + 0.5) / 2, 0, 1)


def test_quality_scores_equal_a_plain_computation(spark):
    """Every step recomputed without partitions or sums: statistics, kernel features, ridge, calibration."""
    from aerolith.llm import quality as q
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(300).collect()]
    docs += [(10_001, None), (10_002, ""), (10_003, " \n\n \t"), (10_004, "é" * 50), (10_005, "x" * 100_000), (10_006, "a a a a.")]
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()] + [(10_004, 0), (10_005, 0), (5, None)]
    for (_, t) in docs[-8:]:
        assert np.allclose(q.statistics(t), plain_statistics(t), atol=1e-9)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.score for r in q.score_quality(frame, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    want = plain_scores(docs, labels, q)
    assert np.allclose([got[i] for i, _ in docs], want, atol=1e-6)

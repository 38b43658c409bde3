import pytest

from aerolith.llm import exchange, hnsw, licenses, mixing, ngram_join, packing, spotsigs  # noqa: F401

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, batch int, row string, keep int, n_lines string"
BOILER = "All rights reserved by the owner of this page"


@pytest.fixture(scope="session")
def hard_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, extra columns with clashing names."""
    story = " ".join(f"word{i % 97}x{i % 13}" for i in range(400))
    near = story.replace("word7x7 ", "changed ", 1)
    texts = [(1, story, "a"), (2, near, "a"), (3, story, "a"), (4, None, "b"), (5, "", "b"), (6, " \t\n ", None),
             (7, "one", "c"), (8, "one two three four", "c"), (9, f"{BOILER}\nalpha beta\n  {BOILER.upper()}  \n", "a"),
             (10, f"{BOILER}\n\nGamma É", "a"), (11, f"x\n{BOILER}", None), (12, "wordy " * 30_000, "b"), (12, "wordy " * 30_000, "b"),
             (None, "no id here at all, none of it", "a"), (None, None, None), (13, "\x0b\x1c日本 x </s>", "c"), (13, "second text of thirteen", "c"),
             (14, "ONE Two three FOUR", "c"), (15, "released under the MIT License. CC-BY 4.0", "c")]
    rows = [(i, t, None if i and i % 2 else "en", s, None, 1, "r", 2, "z") for i, t, s in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def small_batches(monkeypatch):
    """Many batches, buckets and cells on small tables."""
    monkeypatch.setattr(exchange, "BATCH_BYTES", 1 << 17)
    monkeypatch.setattr(exchange, "BUCKET_BYTES", 1 << 17)
    monkeypatch.setattr(ngram_join, "CELL_SHINGLES", 2000)

"""Licence scan with a positional index of rare licence words.

Every template's ``ANCHORS`` rarest words (highest inverse document frequency over the scanned
documents) are indexed with their position in the template. A file looks up its own
licence words in that index; each hit votes for a template start (position in the
file minus position in the template). A start where at least ``min(2, anchors)`` different
anchors agree, give or take ``SLACK`` words, is a candidate; it counts if the
template's mandatory key phrase stands there in full. The score is the best share
of a template's words found in place.

Base phrases are searched at every position of the whole file, whatever the index says.

Defined cases: null text counts as empty (no words, null places, empty labels, score
0); repeated rows give repeated results; other columns are ignored; an empty table
gives no rows, and its document frequencies are all 0.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from aerolith.llm.text import batch

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label, template words, mandatory key phrase.
TEMPLATES = [
    ("cc-by-4", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights", "waived all copyright"),
    ("gpl-notice", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl-notice", "you can redistribute it and or modify it under the terms of the gnu general public license",
     "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "released into the public domain"),
    ("all-rights", "all rights reserved", "all rights reserved"),
]
ANCHORS = 4
SLACK = 2
BASE_SCORE = 0.5

RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])
RESULT_DDL = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
              "base_labels string, labels string, score double")
#: Bytes of words stay (A-Z lowered), all others become blanks.
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def licence_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_CLEAN).split()


def _split(phrase: str) -> list[bytes]:
    return phrase.encode().split()


def vocabulary(templates=TEMPLATES) -> frozenset[bytes]:
    return frozenset(w for _, t, _ in templates for w in _split(t)) | {w for p in BASE for w in _split(p)}


def document_frequencies(docs: DataFrame, templates=TEMPLATES) -> tuple[int, dict[bytes, int]]:
    """Documents and, for each licence word, documents with it: a row per word of the fixed vocabulary reaches the driver."""
    vocab = vocabulary(templates)

    def count(batches):
        df = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                df[b""] += 1
                df.update(vocab.intersection(licence_words(text)))
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(df), pa.binary()), "df": pa.array(list(df.values()), pa.int64())})

    rows = docs.select("text").mapInArrow(count, "word binary, df bigint").groupBy("word").sum("df").collect()
    df = {bytes(w): n for w, n in rows}
    return df.pop(b"", 0), df


class Index:
    """Word -> [(template, position)] of each template's rarest words."""

    def __init__(self, total: int, df: dict[bytes, int], templates=TEMPLATES, anchors: int = ANCHORS):
        self.templates = [(label, _split(t), _split(key)) for label, t, key in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.needed = []
        for k, (_, ws, _) in enumerate(self.templates):
            idf = {w: math.log((total + 1) / (df.get(w, 0) + 1)) for w in ws}
            rare = sorted(idf, key=lambda w: (-idf[w], w))[:anchors]
            self.needed.append(min(2, len(rare)))
            for pos, w in enumerate(ws):
                if w in rare:
                    self.postings.setdefault(w, []).append((k, pos))
        self.base = [(_split(p), label) for p, label in BASE.items()]
        self.look = frozenset(self.postings) | {ws[0] for ws, _ in self.base}

    def scan(self, ws: list[bytes]) -> tuple:
        votes: dict[tuple[int, int], set[int]] = {}
        places, base_labels, labels, score = [], set(), set(), 0.0
        for i in [i for i, w in enumerate(ws) if w in self.look]:
            for phrase, label in self.base:
                if ws[i] == phrase[0] and ws[i:i + len(phrase)] == phrase:
                    places.append(i)
                    base_labels.add(label)
            for k, pos in self.postings.get(ws[i], ()):
                votes.setdefault((k, i - pos), set()).add(pos)
        for k, start in votes:
            near = set().union(*(votes.get((k, start + s), ()) for s in range(-SLACK, SLACK + 1)))
            label, template, key = self.templates[k]
            if len(near) < self.needed[k]:
                continue
            lo, hi = max(0, start - SLACK), max(0, start + len(template) + SLACK)
            if any(ws[j:j + len(key)] == key for j in range(lo, hi)):
                found = sum(0 <= start + j < len(ws) and ws[start + j] == w for j, w in enumerate(template))
                labels.add(label)
                score = max(score, found / len(template))
        if base_labels:
            score = max(score, BASE_SCORE)
        return (len(ws), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels)), score)


def scan_licences(docs: DataFrame, templates=TEMPLATES, anchors: int = ANCHORS) -> DataFrame:
    index = Index(*document_frequencies(docs, templates), templates, anchors)

    def run(batches):
        for b in batches:
            found = [(doc, *index.scan(licence_words(text))) for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield batch({name: [r[i] for r in found] for i, name in enumerate(RESULT.names)}, RESULT)

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, RESULT_DDL)

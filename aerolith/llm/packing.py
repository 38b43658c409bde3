"""Packing documents into fixed-length sequences: first-fit decreasing in randomised groups.

Documents are tokenized where they are read and cut into pieces of at most
``capacity`` ids; only the pieces' numbers travel. A seeded hash deals documents into groups of
about ``GROUP_DOCS``; in a group, pieces are placed longest first into the first
sequence with room, which a tournament tree over the sequences' free room finds in
logarithmic time.

Ids are those of the byte-level BPE vocabulary (its special token is recognised in texts,
as the ``tokenizers`` library does by default), followed by ``END_ID``. They are computed with
the rank file of the same vocabulary, which gives the same ids several times faster;
a test compares both.

Defined cases: null or empty text is its end id alone; texts of any length are cut,
never shortened; equal documents are packed each; a null ``doc_id`` is kept; ties
are placed by id, then start; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.store import blocks
from aerolith.llm.text import batch

CAPACITY = 1024
GROUP_DOCS = 4096
END_ID = 0
VOCABULARY = "byte_bpe_50k"
SPECIAL = {"<|endoftext|>": 50256}

PIECE = pa.schema([("group", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                   ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
PIECE_DDL = "group bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PLACED_DDL = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
              "sequence_id bigint, offset bigint, sequence_length bigint, padded_length bigint")


@lru_cache(maxsize=2)
def encoding(vocabulary: str = VOCABULARY):
    import public_tokenizers
    import tiktoken
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def token_ids(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    ids = encoding(vocabulary).encode_to_numpy(text or "", allowed_special="all")
    return np.append(ids, END_ID).astype("<u4")


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece; ``lengths`` must be in falling order."""
    leaves = 1 << max(0, int(len(lengths) - 1).bit_length())
    room = [capacity] * (2 * leaves)  # room[1] is the winner: the most room of any bin
    bins, offsets = [], []
    for length in lengths.tolist():
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - room[node])
        room[node] -= length
        while node > 1:
            node //= 2
            left, right = room[2 * node], room[2 * node + 1]
            room[node] = left if left >= right else right
    return bins, offsets


def cut(docs: DataFrame, groups: int, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, seed: int = 11) -> DataFrame:
    """One row per piece: ``group, doc_id, start, length, ids_crc32, doc_tokens``."""
    def run(batches):
        for b in batches:
            out = {name: [] for name in PIECE.names}
            for group, doc, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                ids = token_ids(text, vocabulary)
                for start in range(0, len(ids), capacity):
                    piece = ids[start:start + capacity]
                    for name, value in zip(PIECE.names, (group, doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))):
                        out[name].append(value)
            yield batch(out, PIECE)

    group = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(groups))
    return docs.select(group.alias("group"), F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, PIECE_DDL)


def pack(docs: DataFrame, capacity: int = CAPACITY, group_docs: int = GROUP_DOCS, vocabulary: str = VOCABULARY,
         seed: int = 11) -> DataFrame:
    """Where each piece lies: piece columns, ``sequence_id, offset, sequence_length, padded_length``."""
    def place(group: pa.Table) -> pa.Table:
        t = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        lengths = t["length"].to_numpy()
        bins, offsets = first_fit_decreasing(lengths, capacity)
        bins = np.asarray(bins, np.int64)
        used = np.bincount(bins, lengths, minlength=1).astype(np.int64)[bins]
        padded = np.where(used & (used - 1) == 0, used, capacity)
        t = t.append_column("sequence_id", pa.array((t["group"].to_numpy() << 32) + bins))
        for name, values in (("offset", offsets), ("sequence_length", used), ("padded_length", padded)):
            t = t.append_column(name, pa.array(values, pa.int64()))
        return t.drop_columns("group")

    pieces = cut(docs, blocks(docs.count(), group_docs), capacity, vocabulary, seed)
    return pieces.groupBy("group").applyInArrow(place, PLACED_DDL)

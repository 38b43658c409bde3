"""Words and hashes of texts, for use inside tasks.

``bytes.split()`` splits at exactly ``[\\x20\\x09-\\x0D]`` and ``bytes.lower()`` lowers
exactly A-Z, so both follow the word rules of the operators for any UTF-8 text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, ws), np.uint64, len(ws))


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix: spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted distinct values (sorting beats the hash table behind ``np.unique`` here)."""
    s = np.sort(h)
    return s[np.r_[True, s[1:] != s[:-1]]] if len(s) else s


def runs(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive word hashes (order counts)."""
    n = len(h) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out = mix(out + _GOLDEN) ^ h[j:j + n] if j % 4 == 3 else out * np.uint64(0x100000001B3) + h[j:j + n]
    return mix(out)


def batch(rows: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)

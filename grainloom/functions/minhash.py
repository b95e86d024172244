"""MinHash signatures of character 5-grams, bit for bit those of the usual 64-bit wrapping formula.

A shingle is the first four bytes of its MD5, little-endian; slot k of the signature is the least (a_k * x + b_k) mod
2^61 - 1 over a text's shingles, where a_k * x + b_k wraps around as a signed 64-bit number and mod is never negative.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

SLOTS, SIZE, PRIME = 128, 5, (1 << 61) - 1


@cache
def coefficients(slots: int = SLOTS, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.RandomState(seed)
    return rng.randint(1, PRIME, size=slots, dtype=np.int64), rng.randint(0, PRIME, size=slots, dtype=np.int64)


def _shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(code of each shingle of each text, owner text, distinct shingles)."""
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    flat = np.concatenate(points) if points else np.zeros(0, np.uint32)
    sizes = np.array([len(p) for p in points])
    owner = np.repeat(np.arange(len(texts)), np.maximum(sizes - SIZE + 1, 0))
    starts = np.cumsum(sizes) - sizes
    many = np.maximum(sizes - SIZE + 1, 0)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many - starts, many)
    letter, alphabet = pd.factorize(flat)
    bits = max(1, int(len(alphabet) - 1).bit_length())
    if bits * SIZE > 63:  # more than 4,096 letters at once: two keys
        high = (letter[at].astype(np.int64) << 42) | (letter[at + 1].astype(np.int64) << 21) | letter[at + 2]
        low = (letter[at + 3].astype(np.int64) << 21) | letter[at + 4]
        first, _ = pd.factorize(high)
        key = first.astype(np.int64) * (int(low.max(initial=0)) + 1) + low if len(first) and int(first.max()) * (int(low.max()) + 1) < 1 << 62 else pd.factorize(pd.Series(list(zip(high.tolist(), low.tolist()))))[0]
    else:
        key = np.zeros(len(at), np.int64)
        for k in range(SIZE):
            key = (key << bits) | letter[at + k]
    code, own = pd.factorize(key)
    sample = np.empty(len(own), np.int64)
    sample[code] = at
    return code, owner, [flat[s : s + SIZE].tobytes().decode("utf-32-le", "surrogatepass") for s in sample]


def signatures(texts: list[str], slots: int = SLOTS) -> list[np.ndarray | None]:
    """None for a text of fewer than SIZE characters after lower() and strip()."""
    texts = [t.lower().strip() for t in texts]
    code, owner, distinct = _shingles(texts)
    if not distinct:
        return [None] * len(texts)
    x = np.array([int.from_bytes(hashlib.md5(s.encode("utf-8", "surrogatepass")).digest()[:4], "little") for s in distinct], np.int64)
    has = np.unique(owner)
    at = np.searchsorted(owner, has)
    a, b = coefficients(slots)
    out = np.empty((slots, len(has)), np.int64)
    with np.errstate(over="ignore"):
        for k in range(slots):
            out[k] = np.minimum.reduceat(((a[k] * x + b[k]) % PRIME)[code], at)
    result: list[np.ndarray | None] = [None] * len(texts)
    for i, t in enumerate(has.tolist()):
        result[t] = out[:, i]
    return result


def with_signature(docs: DataFrame, key: str, text: str, slots: int = SLOTS, at_once: int = 1 << 20) -> DataFrame:
    """(key, signature array<long>, null if the text is too short); about at_once characters are worked on together."""
    kind = dict(docs.dtypes)[key]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, first = [t or "" for t in batch.column(1).to_pylist()], 0
            while first < len(texts):
                last, held = first, 0
                while last < len(texts) and (held < at_once or last == first):
                    held += len(texts[last])
                    last += 1
                found = signatures(texts[first:last], slots)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(found, pa.list_(pa.int64()))], [key, "signature"])
                first = last

    return docs.select(key, text).mapInArrow(rows, f"{key} {kind}, signature array<long>")

"""Character n-grams by 64-bit hashes, on the code points of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Characters that are worked on at once.
AT_ONCE = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of each text's distinct n-grams; a shorter text has one, of all of it and its length."""
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(p) for p in points], np.int64)
    flat = np.concatenate([*points, np.zeros(n, np.uint32)]).astype(np.uint64)
    weights = np.random.default_rng(n).integers(1, 1 << 63, n + 1, dtype=np.uint64) | np.uint64(1)
    many = np.maximum(sizes - n + 1, 1)
    begin = np.cumsum(sizes) - sizes
    at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many - begin, many)
    owner = np.repeat(np.arange(len(texts)), many)
    left = np.repeat(np.minimum(sizes, n), many)
    total = left.astype(np.uint64) * weights[n]
    for k in range(n):
        total += np.where(k < left, (flat[np.minimum(at + k, len(flat) - 1)] + np.uint64(1)) * weights[k], np.uint64(0))
    total = _mixed(total)
    order = np.lexsort((total, owner))
    owner, total = owner[order], total[order]
    new = np.ones(len(total), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (total[1:] != total[:-1])
    return owner[new], total[new].view(np.int64)


def gram_rows(rows: DataFrame, key: str, text: str, n: int, known: np.ndarray | None = None) -> DataFrame:
    """(key, n_grams, gram) of every distinct n-gram of every text, null as empty; with known (sorted), only of those in it."""
    kind = dict(rows.dtypes)[key]

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, first = [t or "" for t in batch.column(1).to_pylist()], 0
            while first < len(texts):
                last, held = first, 0
                while last < len(texts) and (held < AT_ONCE or last == first):
                    held += len(texts[last])
                    last += 1
                owner, found = gram_hashes(texts[first:last], n)
                count = np.bincount(owner, minlength=last - first)[owner]
                if known is not None:
                    place = np.searchsorted(known, found)
                    hit = known[np.minimum(place, len(known) - 1)] == found if len(known) else np.zeros(len(found), bool)
                    owner, found, count = owner[hit], found[hit], count[hit]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner + first)), pa.array(count, pa.int64()), pa.array(found, pa.int64())], [key, "n_grams", "gram"])
                first = last

    return rows.select(key, text).mapInArrow(grams, f"{key} {kind}, n_grams long, gram long")

"""Best-fit packing of token pieces after Martello and Toth's dominance reduction.

Pieces of one length are interchangeable, so the instance is its histogram of lengths: at most `room` numbers, however
many documents there are. The driver solves that, every pattern of lengths with the number of sequences that use it;
the pieces are then ranked within their length and read their place off the patterns.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainloom.llm.common import gapless_rank, quiet_threads, settled, short_batches
from grainloom.llm.wordbpe import default_path, loaded

ROOM = 4096


@dataclass
class Plan:
    """patterns: (sequences, lengths in each). fixed: sequences that the reduction fixed. bound: no packing has fewer."""

    room: int
    patterns: list[tuple[int, tuple[int, ...]]] = field(default_factory=list)
    fixed: int = 0
    bound: int = 0

    @property
    def sequences(self) -> int:
        return sum(n for n, _ in self.patterns)


def reduce_instance(counts: np.ndarray, room: int) -> list[tuple[int, tuple[int, ...]]]:
    """Takes out of counts (index: length) the sets that dominate all others that hold their largest piece.

    Largest first. With L the piece and k how many of the smallest others fit beside it: k = 0, L alone; k = 1 or a piece
    that fills L up exactly, L with the largest that fits; k = 2, that same pair if no two pieces fill more than the one,
    or the best two where the larger is the one and nothing between them could do better. Anything else stays.
    """
    fixed: list[tuple[int, tuple[int, ...]]] = []

    def fix(*lengths: int) -> None:
        need = {x: lengths.count(x) for x in lengths}
        times = min(int(counts[x]) // n for x, n in need.items())
        for x, n in need.items():
            counts[x] -= times * n
        fixed.append((times, lengths))

    def without(length: int) -> np.ndarray:
        rest = counts.copy()
        rest[length] -= 1
        return rest

    changed = True
    while changed:
        changed = False
        for length in range(room, 0, -1):
            while counts[length]:
                rest = without(length)
                there = np.flatnonzero(rest[1 : room - length + 1]) + 1  # pieces that fit beside it
                if not len(there):
                    fix(length)
                    changed = True
                    continue
                best = int(there[-1])
                smallest = np.repeat(there[:3], np.minimum(rest[there[:3]], 3))[:3]
                k = int((np.cumsum(smallest) <= room - length).sum())
                if best == room - length or k == 1:
                    fix(length, best)
                    changed = True
                    continue
                if k == 2:
                    a, b = _best_two(rest, there, room - length)
                    if best >= a + b:
                        fix(length, best)
                        changed = True
                        continue
                    between = int(rest[b + 1 : a].sum())
                    if a == best and (between <= 1 or length + _two_above(rest, b, a) > room):
                        fix(length, a, b)
                        changed = True
                        continue
                break
    return fixed


def _best_two(rest: np.ndarray, there: np.ndarray, space: int) -> tuple[int, int]:
    """Two pieces a >= b that fill the most of space."""
    best = (0, 0)
    for a in there[::-1].tolist():
        fits = there[(there <= space - a) & (there <= a)]
        if len(fits) and int(fits[-1]) == a and rest[a] < 2:
            fits = fits[:-1]
        if len(fits) and a + int(fits[-1]) > sum(best):
            best = (a, int(fits[-1]))
    return best


def _two_above(rest: np.ndarray, b: int, a: int) -> int:
    """The least sum of two pieces of lengths above b, up to a."""
    lengths = np.flatnonzero(rest[b + 1 : a + 1]) + b + 1
    two = np.repeat(lengths[:2], np.minimum(rest[lengths[:2]], 2))[:2]
    return int(two.sum())


def best_fit(counts: np.ndarray, room: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best fit, longest first, for all pieces of a length at once: a piece goes where the least space is left over."""
    groups: list[list[tuple[int, tuple[int, ...]]]] = [[] for _ in range(room + 1)]
    free = np.zeros(room + 1, bool)  # by space left

    def put(left: int, times: int, lengths: tuple[int, ...]) -> None:
        if times:
            groups[left].append((times, lengths))
            free[left] = True

    for length in range(room, 0, -1):
        rest = int(counts[length])
        while rest:
            at = int(np.argmax(free[length:])) + length
            if not free[at]:
                each = room // length
                full, more = divmod(rest, each)
                put(room - each * length, full, (length,) * each)
                if more:
                    put(room - more * length, 1, (length,) * more)
                break
            times, lengths = groups[at].pop()
            free[at] = bool(groups[at])
            each = at // length  # the same sequence stays the best fit until it is too full
            used, more = divmod(rest, each)
            used = min(used, times)
            put(at - each * length, used, lengths + (length,) * each)
            rest -= used * each
            if used < times:
                more = min(rest, each - 1) if rest < each else 0
                if more:
                    put(at - more * length, 1, lengths + (length,) * more)
                    rest -= more
                    used += 1
                put(at, times - used, lengths)
    return [g for level in groups for g in level]


def solve(counts: np.ndarray, room: int = ROOM) -> Plan:
    """counts[length] pieces of each length 1..room."""
    counts = counts.astype(np.int64).copy()
    plan = Plan(room, bound=-(-int((counts * np.arange(len(counts))).sum()) // room))
    plan.patterns = reduce_instance(counts, room)
    plan.fixed = plan.sequences
    plan.patterns += best_fit(counts, room)
    return plan


def places(plan: Plan) -> dict[str, np.ndarray]:
    """For each run of ranks within a length: length, first rank, first sequence, offset; sorted by length and rank."""
    next_rank = np.zeros(plan.room + 1, np.int64)
    rows, sequence = [], 0
    for times, lengths in plan.patterns:
        offset = 0
        for length in lengths:
            rows.append((length, int(next_rank[length]), sequence, offset))
            next_rank[length] += times
            offset += length
        sequence += times
    out = np.array(rows, np.int64).reshape(-1, 4)
    out = out[np.lexsort((out[:, 1], out[:, 0]))]
    return {k: out[:, i] for i, k in enumerate(("length", "rank", "sequence", "offset"))}


def pieces(docs: DataFrame, room: int = ROOM, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids binary) of every whole text: its ids and then end_id, cut after every `room`."""
    path = tokenizer or default_path()
    kind = dict(docs.dtypes)["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads(keep_tokens=True)
        bpe = loaded(path)
        for batch in batches:
            for first, last, ids, bounds in bpe.encode(batch.column("text")):
                whole = np.insert(ids, bounds[1:], end_id).astype("<u4", copy=False)
                at = bounds + np.arange(len(bounds))
                sizes = np.diff(at)
                parts = -(-sizes // room)
                doc = np.repeat(np.arange(len(sizes)), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * room
                length = np.minimum(room, sizes[doc] - start)
                begin = at[doc] + start
                raw = [whole[b : b + n].tobytes() for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array([zlib.crc32(r) for r in raw], pa.int64()), pa.array(raw, pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary")


def pack(docs: DataFrame, room: int = ROOM, tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Packs all rows of docs (doc_id, text; other columns are ignored) into as few sequences of `room` tokens as it can.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, with keep_ids also ids (little-endian unsigned
    32-bit). A null or empty text is one piece of one token. Repeated rows are packed as often as they stand; null ids
    stay null. An empty table gives no rows.
    """
    cut = pieces(docs, room, tokenizer)
    with short_batches(docs.sparkSession):
        cut = settled((cut if keep_ids else cut.drop("ids")).withColumn("_tie", F.monotonically_increasing_id()))
    # at most `room` rows
    sizes = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = np.zeros(room + 1, np.int64)
    counts[list(sizes)] = list(sizes.values())
    at = places(solve(counts, room))
    order = [F.col(c) for c in ("doc_id", "piece", "ids_crc32", "_tie")]
    ranked = gapless_rank(cut, "length", sizes, order, "_rank")
    kind = dict(cut.dtypes)["doc_id"]
    first = np.searchsorted(at["length"], np.arange(room + 2))
    own = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            # runs of one length are contiguous: look for the last that starts at or before the rank
            low, high = first[length], first[length + 1]
            while (open_ := low + 1 < high).any():
                middle = (low + high) // 2
                up = at["rank"][np.minimum(middle, len(at["rank"]) - 1)] <= rank
                low, high = np.where(open_ & up, middle, low), np.where(open_ & ~up, middle, high)
            sequence, offset = at["sequence"][low] + rank - at["rank"][low], at["offset"][low]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*own, "sequence_id", "offset"])

    return ranked.select(*own, "_rank").mapInArrow(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, {'ids binary, ' * keep_ids}sequence_id long, offset long")

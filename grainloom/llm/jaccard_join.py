"""N-gram Jaccard join by chosen paths.

Texts are sets of five-word shingles. Sets that are equal are one node. A run of the join samples shared tokens (the
smallest shingle under a random order) and splits the nodes by them, again and again, until a bucket is small enough to
compare by brute force; runs repeat until a pair at the threshold is met with the target recall.

A large bucket is first compared with a few leaders, one comparison a row. Two signatures that may be of similar sets
differ in at most `reach` places, so whatever is similar to a row within `reach` of a leader is within twice that: all of
those are linked to the leader, and the row is done. Where the leader's near rows are no larger part of these the bucket
goes on whole. A bucket whose rows all hang on one leader holds nothing new and ends. So a hot group of near copies costs
a few comparisons a row, and no row is copied to more than the branches of its next level.

What buckets find are coarse links by signatures. Their connected clusters are then compared exactly, in pairs of blocks:
each node's shingles are read anew from the whole text, every pair within a cluster is counted once, and a block returns
counts and a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.llm.common import drop_tables, quiet_threads, short_batches, stored
from grainloom.llm.components import components
from grainloom.llm.textbytes import mixed, slices, spans, word_hashes, words

#: Random orders of a signature: PER_LEVEL of them split each level, all of them estimate a similarity.
ORDERS = 64


@dataclass(frozen=True)
class ChosenPaths:
    """threshold: least Jaccard similarity of a link. recall: least chance that a pair at the threshold meets in a bucket.

    branches: sampled tokens by which a node's bucket is split in a run. small: rows of a bucket that is compared by
    brute force. leaders: rows of a larger bucket that all its rows are compared with. block, block_shingles: rows and
    shingles, about, of a block of the exact comparison.
    """

    threshold: float = 0.8
    recall: float = 0.9999
    words: int = 5
    branches: int = 2
    small: int = 128
    leaders: int = 3
    block: int = 512
    block_shingles: int = 1 << 18

    def lost(self) -> float:
        """The chance that a pair at the threshold never meets in one run, however deep: the branching process dies out."""
        q = 0.0
        for _ in range(10_000):
            q = (1 - self.threshold + self.threshold * q) ** self.branches
        return q

    def runs(self) -> int:
        return max(1, math.ceil(math.log(1 - self.recall) / math.log(self.lost())))

    def levels(self) -> int:
        return max(1, ORDERS // (self.runs() * self.branches))

    def least_equal(self) -> int:
        """Equal places of two signatures below which a pair at the threshold comes with a chance of under 1e-5."""
        p, total = self.threshold, 0.0
        for k in range(ORDERS + 1):
            total += math.comb(ORDERS, k) * p**k * (1 - p) ** (ORDERS - k)
            if total > 1e-5:
                return k
        return ORDERS


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, shingles, bounds) of slices: each text's distinct 64-bit shingle hashes in order.

    Words are runs of letters, digits and non-ASCII characters, in lower case. A text of fewer than n words, but at least
    one, has one shingle: all of its words.
    """
    rng = np.random.default_rng(20)
    weights = rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
    for s in slices(column, lower=True):
        starts, ends, per = words(s)
        h = word_hashes(s.data, starts, ends)
        counts = np.diff(per)
        many = np.maximum(counts - n + 1, np.minimum(counts, 1))
        at = spans(per[:-1], many)
        owner = np.repeat(np.arange(len(counts)), many)
        end = per[1:][owner]
        total = np.zeros(len(at), np.uint64)
        for k in range(n):
            inside = at + k < end
            total[inside] += h[at[inside] + k] * weights[k]
        total = mixed(total)
        order = np.lexsort((total, owner))
        total, owner = total[order], owner[order]
        new = np.ones(len(total), bool)
        new[1:] = (total[1:] != total[:-1]) | (owner[1:] != owner[:-1])
        total, owner = total[new], owner[new]
        yield s.first, s.last, total, np.searchsorted(owner, np.arange(len(counts) + 1))


def _orders() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(5)
    return rng.integers(0, 1 << 32, ORDERS, dtype=np.uint32), rng.integers(0, 1 << 32, ORDERS, dtype=np.uint32) | np.uint32(1)


def signatures(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of ORDERS least values for each non-empty set, zeros for empty ones."""
    flips, factors = _orders()
    full = np.diff(bounds) > 0
    out = np.zeros((len(full), ORDERS), np.uint32)
    if len(shingles):
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        at = bounds[:-1][full]
        for k in range(ORDERS):
            out[full, k] = np.minimum.reduceat((low ^ flips[k]) * factors[k], at)
    return out


def _sketch(n: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            texts, keys = batch.column("text"), batch.column("text_key")
            for first, last, shingles, bounds in shingle_sets(texts, n):
                sizes = np.diff(bounds)
                full = sizes > 0
                marks = np.zeros((len(sizes), 2), np.uint64)
                if len(shingles):
                    at = bounds[:-1][full]
                    marks[full, 0] = np.add.reduceat(shingles, at)
                    marks[full, 1] = np.add.reduceat(mixed(shingles + np.uint64(0x632BE59BD9B4E019)), at)
                sig = signatures(shingles, bounds)
                # a text without words is a node by its bytes
                own = keys.slice(first, last - first).to_pylist()
                node = [marks[i].tobytes() if full[i] else own[i] for i in range(len(own))]
                packed = [sig[i].tobytes() if full[i] else None for i in range(len(own))]
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array(node, pa.binary()), pa.array(packed, pa.binary()), pa.array(sizes, pa.int64())], ["doc_id", "text_key", "node", "sig", "shingles"])

    return sketch


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of rows that come sorted by key, several groups in a frame."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        frame = batch.to_pandas()
        if not len(frame):
            continue
        last = tuple(frame[k].iat[-1] for k in key)
        values, cut = [frame[k].to_numpy() for k in key], len(frame) - 1
        # one by one: compared with an array, a bytes scalar loses the NULs at its end
        while cut and all(v[cut - 1] == x for v, x in zip(values, last, strict=True)):
            cut -= 1
        if cut:
            yield pd.concat([*rest, frame.iloc[:cut]], ignore_index=True)
            rest = [frame.iloc[cut:]]
        else:
            if rest and tuple(rest[0][k].iat[0] for k in key) != last:
                yield pd.concat(rest, ignore_index=True)
                rest = []
            rest.append(frame)
    if rest:
        yield pd.concat(rest, ignore_index=True)


def _edges_of(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a boolean matrix of links, found row by row so that the pairs are never listed."""
    n = len(linked)
    seen, out = np.zeros(n, bool), []
    for start in range(n):
        if seen[start]:
            continue
        seen[start], stack = True, [start]
        while stack:
            x = stack.pop()
            new = np.flatnonzero(linked[x] & ~seen)
            seen[new] = True
            out += [(x, int(y)) for y in new]
            stack += new.tolist()
    return out


def _cross_edges(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links (row, column) between the rows of two blocks."""
    seen = [np.zeros(n, bool) for n in linked.shape]
    sides, out = (linked, linked.T), []
    for start in range(len(linked)):
        if seen[0][start]:
            continue
        seen[0][start], stack = True, [(0, start)]
        while stack:
            side, x = stack.pop()
            new = np.flatnonzero(sides[side][x] & ~seen[1 - side])
            seen[1 - side][new] = True
            out += [(int(y), x) if side else (x, int(y)) for y in new]
            stack += [(1 - side, int(y)) for y in new]
    return out


_KEY = ["bucket", "i", "j"]


def _blocks(rows: DataFrame, blocks: Column, *carry: str) -> DataFrame:
    """Rows (bucket, node, ...) dealt to pairs of blocks: every two rows of a bucket meet in exactly one (bucket, i, j), i < j, or in (i, i) if of one block."""
    own = rows.withColumn("_nb", blocks).withColumn("_own", F.pmod(F.xxhash64("node", "bucket"), F.col("_nb")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("_other")
    return own.select("bucket", "node", "_own", *carry, other).select("bucket", "node", "_own", *carry, F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"))


def _coarse(least: int):
    def coarse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for frame in _groups(batches, ["bucket"]):
            sig = np.frombuffer(b"".join(frame["sig"]), np.uint32).reshape(len(frame), ORDERS)
            node, bucket, out_a, out_b = frame["node"].to_numpy(), frame["bucket"].to_numpy(), [], []
            at = [0, *np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(frame)]
            for s, e in zip(at, at[1:], strict=False):
                if e - s == 2:
                    if (sig[s] == sig[s + 1]).sum() >= least:
                        out_a.append(node[s])
                        out_b.append(node[s + 1])
                elif e - s > 2:
                    equal = np.zeros((e - s, e - s), np.uint8)
                    for k in range(ORDERS):
                        v = sig[s:e, k]
                        equal += v[:, None] == v[None, :]
                    for a, b in _edges_of(equal >= least):
                        out_a.append(node[s + a])
                        out_b.append(node[s + b])
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], ["a", "b"])

    return coarse


def _to_leaders(n: int):
    """Adds to each row in how many places its signature equals that of each leader of its bucket."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        read = lambda column: np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, ORDERS)
        for batch in batches:
            sig = read(batch.column("sig"))
            equal = [pa.array((sig == read(batch.column(f"_sig{k}"))).sum(1), pa.int32()) for k in range(n)]
            kept = ["node", "run", "bucket", "head", "sig", *(f"_lead{k}" for k in range(n))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *equal], [*kept, *(f"_eq{k}" for k in range(n))])

    return compared


def _meet(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of all intersections of left with right (or with itself), by products of 0/1 matrices over the shingles that two sets have."""
    n, sets = len(left), [*left, *(right or ())]
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    code = np.cumsum(new) - 1
    often = np.bincount(code) > 1
    if right is not None:  # only what both sides have
        often = (np.bincount(code, owner < n) > 0) & (np.bincount(code, owner >= n) > 0)
    keep = often[code]
    code, owner = (np.cumsum(often) - 1)[code[keep]], owner[keep]
    out = np.zeros((n, n if right is None else len(right)), np.float32)
    at, width = 0, 2048
    for first in range(0, int(often.sum()), width):
        to = int(np.searchsorted(code, first + width))
        have = np.zeros((len(sets), min(width, int(often.sum()) - first)), np.float32)
        have[owner[at:to], code[at:to] - first] = 1
        out += have[:n] @ (have if right is None else have[n:]).T
        at = to
    return out


def _exact(threshold: float):
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for frame in _groups(batches, _KEY):
            for (_, i, j), part in frame.groupby(_KEY, sort=False):
                part = part.drop_duplicates("node")  # a row that repeats both id and text comes as often as it stands
                sides = [part] if i == j else [part[part["_own"] == i], part[part["_own"] == j]]
                if not all(map(len, sides)):
                    continue
                sets = [[np.frombuffer(s, np.uint64) for s in side["shingles"]] for side in sides]
                sizes = [np.array([len(s) for s in own]) for own in sets]
                both = _meet(*sets)
                linked = both >= threshold * (sizes[0][:, None] + sizes[-1][None, :] - both) - 1e-6
                if i == j:
                    np.fill_diagonal(linked, False)
                forest = _edges_of(linked) if i == j else _cross_edges(linked)
                nodes, copies = [side["node"].to_numpy() for side in sides], [side["copies"].to_numpy() for side in sides]
                texts, docs = linked.sum(1), linked @ copies[-1]
                a, b = [*nodes[0]], [nodes[-1][y] for _, y in forest]
                if i != j:
                    texts, docs, a = np.concatenate((texts, linked.sum(0))), np.concatenate((docs, copies[0] @ linked)), [*a, *nodes[1]]
                some = np.flatnonzero(texts)
                pad = [0] * len(forest)
                columns = [pa.array([*(a[x] for x in some), *(nodes[0][x] for x, _ in forest)], pa.binary()), pa.array([*(None for _ in some), *b], pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([*texts[some].tolist(), *pad], pa.int64()), pa.array([*docs[some].tolist(), *pad], pa.int64())], ["a", "b", "texts", "docs"])

    return exact


def _first_level(sketches: DataFrame, how: ChosenPaths) -> DataFrame:
    """(bucket, run, node, size) of the first level's buckets of at least two nodes."""
    orders = how.runs() * how.branches
    first = sketches.select("node", F.explode(F.array(*(F.struct(F.lit(k // how.branches).alias("run"), F.xxhash64(F.lit(k), F.substring("sig", 1 + 4 * k, 4)).alias("bucket")) for k in range(orders)))).alias("_x"))
    rows = first.select("node", "_x.run", "_x.bucket")
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return rows.join(counts, "bucket")


def _led(held: DataFrame, how: ChosenPaths, tables: list[DataFrame]) -> DataFrame:
    """Rows (node, run, bucket, head, sig) with `_lead` (the bucket's best leader), `_eq` (places equal to it) and `_alike` (its near rows are at least half of those within twice the reach)."""
    every = range(how.leaders)
    pick = [F.min(F.struct(F.col("head").isNotNull(), F.xxhash64("node", F.lit(k)), F.col("node").alias("n"), F.col("sig").alias("s"))).alias(f"_l{k}") for k in every]
    # small next to what it is joined with; Spark broadcasts it only where its files are small, and splits a hot bucket else
    leads = stored(held.groupBy("bucket").agg(*pick).select("bucket", *(F.col(f"_l{k}.n").alias(f"_lead{k}") for k in every), *(F.col(f"_l{k}.s").alias(f"_sig{k}") for k in every)))
    kinds = ["node binary", "run int", "bucket long", "head binary", "sig binary", *(f"_lead{k} binary" for k in every), *(f"_eq{k} int" for k in every)]
    compared = stored(held.join(leads, "bucket").mapInArrow(_to_leaders(how.leaders), ", ".join(kinds)))
    near, wide = how.least_equal(), 2 * how.least_equal() - ORDERS
    score = [F.struct(F.count(F.when(F.col(f"_eq{k}") >= near, 1)).alias("near"), F.count(F.when(F.col(f"_eq{k}") >= wide, 1)).alias("wide"), F.lit(k).alias("k")) for k in every]
    fit = [F.struct((2 * F.col(f"_s{k}.near") >= F.col(f"_s{k}.wide")).alias("alike"), F.col(f"_s{k}.near").alias("near"), F.lit(k).alias("k")) for k in every]
    best = compared.groupBy("bucket").agg(*(s.alias(f"_s{k}") for k, s in enumerate(score))).select("bucket", F.greatest(*fit).alias("_b") if how.leaders > 1 else fit[0].alias("_b"))
    best = stored(best.select("bucket", F.col("_b.alike").alias("_alike"), F.col("_b.k").alias("_k")))
    tables += [leads, compared, best]
    of = lambda name: F.element_at(F.array(*(F.col(f"{name}{k}") for k in every)), F.col("_k") + 1)
    return compared.join(best, "bucket").select("node", "run", "bucket", "head", "sig", of("_lead").alias("_lead"), of("_eq").alias("_eq"), "_alike")


def _coarse_links(sketches: DataFrame, how: ChosenPaths) -> tuple[DataFrame, list[DataFrame]]:
    """(a, b): links that connect whatever may be similar, level by level; and the tables that they are read from."""
    near, wide = how.least_equal(), 2 * how.least_equal() - ORDERS
    orders, tables, links = how.runs() * how.branches, [], []

    def brute(rows: DataFrame) -> DataFrame:
        small = rows.select("bucket", "node", "sig").repartition("bucket").sortWithinPartitions("bucket")
        return small.mapInArrow(_coarse(how.least_equal()), "a binary, b binary")

    rows = stored(_first_level(sketches, how))
    tables.append(rows)
    links.append(brute(rows.where(F.col("size") <= how.small).join(sketches, "node")))
    rows = rows.where(F.col("size") > how.small)
    if rows.isEmpty():
        return links[0], tables
    rows = stored(rows.join(sketches, "node").select("node", "run", "bucket", F.lit(None).cast("binary").alias("head"), "sig"))
    tables.append(rows)
    for level in range(1, how.levels()):
        led = _led(rows, how, tables)
        links.append(led.where(F.col("_alike") & (F.col("_eq") >= wide) & (F.col("node") != F.col("_lead"))).select(F.col("_lead").alias("a"), F.col("node").alias("b")))
        rest = led.where(~F.col("_alike") | (F.col("_eq") < near))
        order = F.lit(level * orders) + F.col("run") * how.branches + F.col("_j")
        head = F.when(F.col("_alike") & (F.col("_eq") >= wide), F.col("_lead")).otherwise(F.col("head")).alias("head")
        split = rest.select("node", "run", "bucket", head, "sig", F.explode(F.sequence(F.lit(0), F.lit(how.branches - 1))).alias("_j"))
        split = split.select("node", "run", F.xxhash64("bucket", "_j", F.substring("sig", F.lit(1) + order * 4, F.lit(4))).alias("bucket"), "head", "sig")
        # rows that hang on one leader are linked already
        fresh = (F.count("head") < F.count(F.lit(1))) | (F.min("head") != F.max("head"))
        sizes = split.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), fresh.alias("_fresh")).where("size > 1 AND _fresh").select("bucket", "size")
        rows = stored(split.join(sizes, "bucket"))
        tables.append(rows)
        links.append(brute(rows.where(F.col("size") <= how.small)))
        rows = rows.where(F.col("size") > how.small).drop("size")
        if rows.isEmpty():
            break
    else:
        # out of orders: what is left of a bucket is one cluster, which the exact comparison parts again
        last = rows.groupBy("bucket").agg(F.min("node").alias("a"))
        links.append(rows.join(last, "bucket").where(F.col("a") != F.col("node")).select("a", F.col("node").alias("b")))
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out, tables


def _sorted_blocks(dealt: DataFrame) -> DataFrame:
    return dealt.repartition(*_KEY).sortWithinPartitions(*_KEY)


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"), *more).withColumn("text_key", F.unhex(F.md5("text")))


def _classified(docs: DataFrame, how: ChosenPaths) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """members (doc_id, text_key, node) of docs; nodes (node, pick: the least row, copies); labels (node, label) of nodes
    with links; links (node, texts, docs). All have cut lineage, but for links, which read a table."""
    keyed = _keyed(docs)
    kind = dict(docs.dtypes)["doc_id"]
    with short_batches(docs.sparkSession):
        members = stored(keyed.select("doc_id", "text", "text_key").mapInArrow(_sketch(how.words), f"doc_id {kind}, text_key binary, node binary, sig binary, shingles long"))
    # pick: one row of each node; all texts of a node have equal sets
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("id"), F.col("text_key").alias("key")))
    nodes = stored(members.groupBy("node").agg(pick.alias("pick"), F.count(F.lit(1)).alias("copies"), F.min("sig").alias("sig"), F.min("shingles").alias("shingles")))
    coarse, tables = _coarse_links(nodes.where("sig IS NOT NULL").select("node", "sig"), how)
    clusters = components(coarse)
    drop_tables(*tables)
    inside = stored(clusters.withColumnRenamed("label", "bucket").join(nodes.select("node", "pick", "copies", "shingles"), "node"))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / how.block, F.sum("shingles") / how.block_shingles)).cast("int")
    sizes = stored(inside.groupBy("bucket").agg(blocks.alias("blocks")))
    wanted = inside.join(sizes, "bucket").select("bucket", "node", "copies", "blocks", F.col("pick.id").alias("_id"), F.col("pick.key").alias("_key"))
    wanted = keyed.join(wanted, keyed["doc_id"].eqNullSafe(F.col("_id")) & (keyed["text_key"] == F.col("_key")))
    sets = wanted.select("bucket", "node", "blocks", "copies", "text").mapInArrow(_sets(how.words), "bucket binary, node binary, blocks int, copies long, shingles binary")
    dealt = _blocks(sets, F.col("blocks"), "copies", "shingles").select(*_KEY, "node", "_own", "copies", "shingles")
    with short_batches(docs.sparkSession):
        found = stored(_sorted_blocks(dealt).mapInArrow(_exact(how.threshold), "a binary, b binary, texts long, docs long"))
    drop_tables(clusters, inside, sizes)
    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    labels = components(found.where("b IS NOT NULL").select("a", "b"))
    return members.select("doc_id", "text_key", "node"), nodes.select("node", "pick", "copies"), labels, links


def jaccard_classes(docs: DataFrame, how: ChosenPaths | None = None) -> DataFrame:
    """One row for each row of docs (doc_id, text; other columns are ignored, whatever their names).

    Returns doc_id, class_id (the least doc_id of its connected class), class_size (rows of the class), n_links (other
    rows that are equal or similar to it), n_text_links (similar nodes: sets of shingles that differ from its own).
    Texts without words (null counts as empty) are linked only to equal texts. Repeated rows are copies of each other.
    Texts of any length are compared as a whole; pairs at exactly the threshold are links. A null doc_id is kept; class_id
    is null if all of the class are. An empty table gives no rows.
    """
    members, nodes, labels, links = _classified(docs, how or ChosenPaths())
    own = nodes.select("node", F.col("pick.id").alias("_id"), "copies")
    linked = stored(labels.join(own, "node"))
    heads = stored(linked.groupBy("label").agg(F.min("_id").alias("_class"), F.sum("copies").alias("_size")))
    of = linked.join(heads, "label").select("node", F.lit(True).alias("_in"), "_class", "_size")
    zero = lambda c: F.coalesce(c, F.lit(0))
    classed = own.join(of, "node", "left").join(links, "node", "left").select(
        "node", F.when(F.col("_in"), F.col("_class")).otherwise(F.col("_id")).alias("class_id"), F.coalesce("_size", "copies").alias("class_size"),
        (zero("docs") + F.col("copies") - 1).alias("n_links"), zero("texts").alias("n_text_links"),
    )
    return members.join(stored(classed), "node").select("doc_id", "class_id", "class_size", "n_links", "n_text_links")


def _sets(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for first, last, shingles, bounds in shingle_sets(batch.column("text"), n):
                packed = [shingles[s:e].tobytes() for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("bucket", "node", "blocks", "copies")), pa.array(packed, pa.binary())], ["bucket", "node", "blocks", "copies", "shingles"])

    return sets


def keep_one(docs: DataFrame, how: ChosenPaths | None = None) -> DataFrame:
    """docs with one row of each class: that of the least doc_id, and of those the least text hash; all columns stay, whatever their names.

    Null ids come after all others; a null text is empty, and texts without words are in one class only with equal ones.
    Rows that repeat both id and text are one row afterwards. An empty table gives no rows.
    """
    members, nodes, labels, _ = _classified(docs, how or ChosenPaths())
    least = F.min("pick").alias("pick")
    heads = stored(nodes.join(labels, "node", "left").groupBy(F.coalesce("label", "node").alias("label")).agg(least).select("pick.id", "pick.key"))
    # docs' own columns travel in a struct, so none of their names can meet one of these
    keyed = _keyed(docs, F.struct(*(docs[c] for c in docs.columns)).alias("whole"))
    kept = keyed.join(heads, keyed["doc_id"].eqNullSafe(heads["id"]) & (keyed["text_key"] == heads["key"]), "left_semi")
    # only rows that repeat an id and a text could be kept twice
    repeated = members.groupBy("doc_id", "text_key").count().where("count > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text_key"])
    return kept.select("whole.*")

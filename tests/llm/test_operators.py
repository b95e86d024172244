"""The ten operators against brute force and on odd tables: nulls, empty and long texts, ties, repeated rows, no rows, clashing names."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grainloom.llm import common, jaccard_join, licenses, media, mixing, packing, quality_classifier, quality_rules, queries, sharding, token_counts, warc
from grainloom.llm.common import scratch
from grainloom.llm.components import components
from grainloom.llm.wordbpe import default_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, node string, shard int, copies int, _doc string, score double"


def prose(seed, n, vocabulary=4000):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, vocabulary, n))


BASE = prose(1, 120)
NEAR = " ".join([*BASE.split()[:118], "other", "ending"])
FAR = " ".join([*BASE.split()[:60], *prose(2, 60).split()])
LONG = prose(3, 9000)
ROWS = [
    (0, BASE, "en", "a"), (1, NEAR, "en", "a"), (2, BASE, None, "b"), (3, FAR, "en", None), (4, None, "en", "b"), (5, "", "en", "a"), (6, "  \n\t ", "de", "c"),
    (7, LONG, "en", "c"), (8, "short text", "en", "a"), (8, "short text", "en", "a"), (9, "Short, TEXT!", "en", "a"), (None, "no id here at all but words", "en", None), (None, "no id here at all but words", "en", None),
    (11, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.", "en", "b"), (12, "x" * 5000, "en", "b"), (13, "a|b " * 40, "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), 7, "n", 3, 2, "d", 0.5) for i, t, lang, s in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [r.asDict() for r in df.collect()]


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda x: (x is None, x))


ALL_IDS = sorted((r[0] for r in ROWS), key=lambda x: (x is None, x))


def test_components_follow_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 3), (200, 201), (200, 201)]
    out = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**dict.fromkeys(range(41), 0), 100: 100, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# 1. Token counts


def test_rollup_counts_and_is_idempotent(spark, docs, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(default_path())
    tok.encode_special_tokens = True
    path = scratch(spark, "t1")
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"], r["n_chars"]) for r in token_counts.rollup(docs, path).collect()}
    want = collections.defaultdict(lambda: (0, 0, 0))
    for _, text, lang, source in ROWS:
        for name, n in (("word_bpe_49k", len(tok.encode(text or "", add_special_tokens=False).ids)), ("words", len(re.findall(r"[^\x20\x09-\x0D]+", text or "")))):
            a = want[source, lang, name]
            want[source, lang, name] = (a[0] + 1, a[1] + n, a[2] + len(text or ""))
    assert got == dict(want)
    again = {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"], r["n_chars"]) for r in token_counts.rollup(docs, path).collect()}
    assert again == got and token_counts.rollup(none, scratch(spark, "t1e")).count() == 0


def test_deltas_delete_and_revise(spark, docs):
    ledger = token_counts.Ledger(spark, scratch(spark, "t1d"))
    assert ledger.totals().count() == 0
    old = token_counts.counted(docs, "words", None)
    assert ledger.commit("one", token_counts.inserts(old)) and not ledger.commit("one", token_counts.inserts(old))
    new = token_counts.counted(docs.where("doc_id != 7 OR doc_id IS NULL").withColumn("text", F.when(F.col("doc_id") == 0, "only three words").otherwise(F.col("text"))), "words", None)
    change = token_counts.revised(old, new)
    assert sorted((r["doc_id"], r["sign"]) for r in change.collect()) == [(0, -1), (0, 1), (7, -1)]
    assert ledger.commit("two", change)
    key = lambda r: (r["source"] or "", r["lang"] or "", r["n_docs"], r["n_tokens"], r["n_chars"])
    fresh = token_counts.Ledger(spark, scratch(spark, "t1f"))
    fresh.commit("all", token_counts.inserts(new))
    assert sorted(map(key, ledger.totals().collect())) == sorted(map(key, fresh.totals().collect()))
    assert ledger.commit("three", token_counts.deletes(new)) and ledger.totals().count() == 0
    with pytest.raises(ValueError):
        ledger.commit("a/b", change)


def test_writers_of_one_batch_count_once(spark, docs):
    from concurrent.futures import ThreadPoolExecutor

    ledger = token_counts.Ledger(spark, scratch(spark, "t1r"))
    changes = token_counts.inserts(token_counts.counted(docs, "words", None))
    with ThreadPoolExecutor(4) as pool:
        told = list(pool.map(lambda _: ledger.commit("one", changes), range(4)))
    assert any(told) and ledger.batches() == ["batch-one"] and ledger.totals().agg(F.sum("n_docs")).first()[0] == len(ROWS)
    token_counts.delta(changes).write.parquet(f"{ledger.path}/delta-dead")
    assert "delta-dead" in ledger.tidy() and ledger.totals().agg(F.sum("n_docs")).first()[0] == len(ROWS)


# 2. Packing


def test_pack_is_a_packing_of_exact_ids(spark, docs, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(default_path())
    tok.encode_special_tokens = True
    want = collections.Counter()
    room = 256
    for i, text, *_ in ROWS:
        full = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(-(-len(full) // room)):
            part = full[k * room : (k + 1) * room]
            want[i, k, k * room, len(part), zlib.crc32(part.tobytes())] += 1
    out = rows(packing.pack(docs, room))
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    at = collections.defaultdict(list)
    for r in out:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= room
    total = sum(r["length"] for r in out)
    assert len(at) <= -(-total // room) + 1
    assert packing.pack(none).count() == 0
    kept = packing.pack(docs, room, keep_ids=True).where("doc_id = 8").select("ids", "ids_crc32").collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in kept) and len(kept) == 2


# 3. Jaccard join


def shingles(text, n=5):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else None


def brute_links(texts, threshold=0.8):
    sets = [shingles(t) for t in texts]
    out = []
    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a is None or b is None:
                linked = a is None and b is None and (texts[i] or "") == (texts[j] or "")
            else:
                linked = len(a & b) >= threshold * len(a | b) - 1e-12
            if linked:
                out.append((i, j))
    return out


def brute_classes(texts):
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = brute_links(texts)
    for i, j in links:
        parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))], collections.Counter(x for p in links for x in p)


def test_join_on_odd_rows(docs, none):
    out = rows(jaccard_join.jaccard_classes(docs))
    roots, links = brute_classes([r[1] for r in ROWS])
    want = []
    for k, (i, *_) in enumerate(ROWS):
        own = [ROWS[j][0] for j in range(len(ROWS)) if roots[j] == roots[k]]
        want.append((i, min((x for x in own if x is not None), default=None), len(own), links[k]))
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r["doc_id"], r["class_id"], r["class_size"], r["n_links"]) for r in out), key=key) == sorted(want, key=key)
    assert jaccard_join.jaccard_classes(none).count() == 0


def test_join_finds_every_link_of_a_hot_group(spark):
    """A large group of near copies, a passage that many share, chains, and small buckets so that everything is split and dealt in blocks."""
    rng = np.random.default_rng(6)
    base, passage = prose(10, 150).split(), prose(11, 60)
    texts = []
    for k in range(90):
        w = list(base)
        for p in rng.integers(0, 150, rng.integers(0, 5)):
            w[p] = f"v{k}"
        texts.append(" ".join(w))
    texts += [f"{passage} {prose(100 + k, int(rng.integers(1, 200)))}" for k in range(150)]
    texts += [prose(500 + k, 80) for k in range(60)]
    chain = prose(12, 100).split()
    for _ in range(8):
        chain = [*chain[4:], *prose(int(rng.integers(1000, 9000)), 4).split()]
        texts.append(" ".join(chain))
    roots, links = brute_classes(texts)
    how = jaccard_join.ChosenPaths(small=8, block=16)
    got = {r["doc_id"]: r for r in rows(jaccard_join.jaccard_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5), how))}
    assert {k: (r["class_id"], r["n_links"]) for k, r in got.items()} == {k: (roots[k], links[k]) for k in range(len(texts))}


def test_join_is_linear_and_whole_on_two_thousand_near_copies(spark):
    """Sixteen edits of one text at most: near copies of all degrees, of which only some are links."""
    rng = np.random.default_rng(8)
    base = prose(20, 150).split()
    texts = []
    for k in range(2000):
        w = list(base)
        for p in rng.integers(0, 150, rng.integers(0, 17)):
            w[p] = f"v{k}"
        texts.append(" ".join(w))
    texts += [prose(3000 + k, 90) for k in range(200)]
    sets = [shingles(t) for t in texts]
    code = {g: k for k, g in enumerate(sorted({g for s in sets for g in s}))}
    have = np.zeros((len(texts), len(code)), np.float32)
    for k, s in enumerate(sets):
        have[k, [code[g] for g in s]] = 1
    both, n = have @ have.T, have.sum(1)
    linked = both >= 0.8 * (n[:, None] + n[None, :] - both) - 1e-4
    np.fill_diagonal(linked, False)
    how = jaccard_join.ChosenPaths(block=512)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    out = {r["doc_id"]: r for r in rows(jaccard_join.jaccard_classes(df, how))}
    assert [out[k]["n_links"] for k in range(len(texts))] == linked.sum(1).tolist()
    roots = list(range(len(texts)))
    for k in range(len(texts)):
        if roots[k] == k:
            todo = [k]
            while todo:
                for y in np.flatnonzero(linked[todo.pop()]):
                    if y > k and roots[y] == y:
                        roots[y] = k
                        todo.append(int(y))
    assert [out[k]["class_id"] for k in range(len(texts))] == roots
    assert sorted(r["doc_id"] for r in rows(jaccard_join.keep_one(df, how))) == sorted(set(roots))
    # what buckets hand on grows with the rows alone
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text_key": [str(k).encode() for k in range(len(texts))], "text": texts})
    sketches = [r for b in jaccard_join._sketch(5)(iter([batch])) for r in zip(b.column("node").to_pylist(), b.column("sig").to_pylist(), strict=True)]
    links, _ = jaccard_join._coarse_links(spark.createDataFrame(sketches, "node binary, sig binary").distinct(), how)
    assert links.count() <= how.runs() * how.branches * 2 * len(texts)


def test_join_finds_the_links_of_the_test_table(spark):
    """Every pair of sf0.01's documents by brute force: the recall is a measurement."""
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    ids, texts = list(table), list(table.values())
    roots, links = brute_classes(texts)
    least = {}
    for k, r in enumerate(roots):
        least[r] = min(least.get(r, ids[k]), ids[k])
    out = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows(jaccard_join.jaccard_classes(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))}
    assert sum(links.values()) > 200 and out == {i: (least[roots[k]], links[k]) for k, i in enumerate(ids)}


def test_keep_one_leaves_clashing_names_alone(spark):
    names = ["_key", "_text_key", "_id", "_s", "_doc", "whole", "id", "key", "text_key"]
    table = spark.createDataFrame([(k, t, *(f"{n}{k}" for n in names)) for k, t in ((1, BASE), (2, BASE), (3, NEAR), (None, FAR), (5, "word " * 1_000_000))], ", ".join(["doc_id long, text string", *(f"{n} string" for n in names)]))
    kept = rows(jaccard_join.keep_one(table))
    assert sorted(r["_key"] for r in kept) == ["_key1", "_key5", "_keyNone"]
    assert all(r[n] == f"{n}{r['doc_id']}" for r in kept for n in names)


def test_groups_are_whole_across_batches():
    for label in (b"ab\x00", b"\x00\x00", b"ab", 7):
        keys = [(b"a" if isinstance(label, bytes) else 1, 0, 0), *[(label, 0, 0)] * 7, (label, 0, 1)]
        table = pa.table({"bucket": [k[0] for k in keys], "i": [k[1] for k in keys], "j": [k[2] for k in keys], "at": range(len(keys))})
        for most in range(1, 10):
            frames = [list(zip(*(f[c] for c in ("bucket", "i", "j", "at")), strict=True)) for f in jaccard_join._groups(iter(table.to_batches(most)), ["bucket", "i", "j"])]
            assert [r for f in frames for r in f] == [(*k, n) for n, k in enumerate(keys)]
            assert all(a[-1][:3] != b[0][:3] for a, b in zip(frames, frames[1:], strict=False))


def test_join_compares_across_batches_whatever_the_label_ends_in(spark):
    """The label of a cluster is its least node, here one that ends in NUL; batches hold fewer rows than the cluster."""

    def nodes(texts):
        batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text_key": [b""] * len(texts), "text": texts})
        return [n for b in jaccard_join._sketch(5)(iter([batch])) for n in b.column("node").to_pylist()]

    near = lambda seed: [f"{prose(seed, 120)} v{k}" for k in range(7)]
    texts = next(t for t in map(near, range(20_000)) if min(nodes(t)).endswith(b"\x00"))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        got = rows(jaccard_join.jaccard_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    finally:
        spark.conf.set(name, before)
    assert sorted((r["doc_id"], r["class_id"], r["n_links"], r["n_text_links"]) for r in got) == [(k, 0, 6, 6) for k in range(7)]


def test_keep_one_keeps_the_least_of_each_class(docs, none):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    roots, _ = brute_classes([r[1] for r in ROWS])
    order = lambda k: (ROWS[k][0] is None, ROWS[k][0] or 0)
    want = [ROWS[min((k for k in range(len(ROWS)) if roots[k] == r), key=order)][0] for r in set(roots)]
    assert ids(kept) == sorted(want, key=lambda x: (x is None, x))
    assert jaccard_join.keep_one(none).count() == 0


def test_runs_meet_the_recall():
    how = jaccard_join.ChosenPaths()
    assert how.lost() ** how.runs() <= 1 - how.recall < how.lost() ** (how.runs() - 1)


# 4. Media


def test_media_round_trip(docs, none):
    for form in ("pgm", "bmp"):
        out = rows(media.store(docs, form))
        by_id = collections.defaultdict(list)
        for r in out:
            by_id[r["doc_id"]].append(r)
        for i, text, *_ in ROWS:
            raw = (text or "").encode()
            padded = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
            r = by_id[i][0]
            assert media.decode(bytes(r["media"])).tobytes() == padded
            assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        assert ids(media.store(docs, form)) == ALL_IDS
    flat = {r["doc_id"]: r for r in rows(media.digests(media.store(docs)))}
    strip = lambda r: {k: v for k, v in r.items() if k != "doc_id"}
    assert strip(flat[0]) == strip(flat[2]) and strip(flat[4]) == strip(flat[5])
    assert media.digests(media.store(none)).count() == 0


def test_media_digests_are_those_of_the_stored_bytes(spark, docs, none, tmp_path, monkeypatch):
    flat = lambda df: sorted(map(repr, rows(df)))
    for form in ("pgm", "bmp"):
        assert flat(media.kept(docs, f"{tmp_path}/{form}", form)) == flat(media.digests(media.store(docs, form)))
    assert media.kept(none, f"{tmp_path}/none").count() == 0
    # a fault in the stored table shows
    other = media.store(spark.createDataFrame([(0, FAR)], "doc_id long, text string")).select(F.col("media").alias("_m"), F.col("tile").alias("_t"))
    hurt = F.col("doc_id") == 0
    bad = spark.read.parquet(f"{tmp_path}/pgm").crossJoin(other).withColumn("media", F.when(hurt, F.col("_m")).otherwise(F.col("media"))).withColumn("tile", F.when(hurt, F.col("_t")).otherwise(F.col("tile"))).drop("_m", "_t")
    media.write_tiles(bad, f"{tmp_path}/bad")
    a, b = ({r["doc_id"]: r for r in rows(media.reread(spark, f"{tmp_path}/{x}"))} for x in ("pgm", "bad"))
    assert {k for k in a if a[k] != b[k]} == {0} and all(a[0][c] != b[0][c] for c in ("payload_sha256", "media_sha256", "feature"))
    # the query stores its whole table
    (tmp_path / "in").mkdir()
    docs.write.parquet(f"{tmp_path}/in/documents.parquet")
    monkeypatch.setattr(queries, "scratch", lambda spark, name: f"{tmp_path}/{name}")
    assert flat(queries.op4_media_columns(spark, f"{tmp_path}/in")) == flat(media.digests(media.store(docs)))
    assert spark.read.parquet(f"{tmp_path}/media").count() == len(ROWS)


# 5. Licenses


def brute_phrases(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places}))


LICENSED = [
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "apache-license\nAPACHE LICENSE mit licenses mit license", "ccby cc by", "éapache license apache licenseé",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", None, "", "gnu general public license " * 3,
]


def test_phrases_and_templates(spark, none):
    rows_in = [(i, t) for i, t in enumerate(LICENSED)]
    out = {r["doc_id"]: r for r in rows(licenses.scan(spark.createDataFrame(rows_in, "doc_id long, text string")))}
    for i, t in rows_in:
        r = out[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_phrases(t), t
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
    assert "tmpl:gpl-3.0-statement" in out[0]["labels"] and "tmpl:cc-by-nc-4.0" in out[1]["labels"] and "tmpl:mit-statement" in out[2]["labels"]
    assert "tmpl:mit" not in out[6]["labels"].split(",") and out[7]["labels"] == ""
    assert licenses.digest(licenses.scan(none)).count() == 0


def test_scan_on_odd_rows(docs):
    """Null and repeated ids, clashing columns, and a text of five megabytes: all of them are scanned whole."""
    assert ids(licenses.scan(docs)) == ALL_IDS
    spark = docs.sparkSession
    long = "plain words " * 420_000 + "Released under the MIT License."
    out = rows(licenses.scan(spark.createDataFrame([(None, long, "x"), (1, long, "y"), (1, long, "y")], "doc_id long, text string, labels string")))
    assert [r["labels"] for r in out] == ["mit,tmpl:mit-statement"] * 3 and {r["first_word"] for r in out} == {840_003}


def brute_match(template, text):
    """Every (first, end) where the template stands in text, by trying all ways through its parts, one after the other."""
    low = text.lower()
    places = [(m.start(), m.end()) for m in re.finditer(r"[0-9a-z\x80-\U0010ffff]+", low)]
    own = [low[a:b] for a, b in places]
    pieces = re.split(r'(<<beginOptional>>|<<endOptional>>|<<var;.*?">>)', template)

    def tree(k):
        out = []
        while k < len(pieces):
            x = pieces[k]
            if x == "<<beginOptional>>":
                inside, k = tree(k + 1)
                out.append(inside)
            elif x == "<<endOptional>>":
                return out, k + 1
            elif x.startswith("<<var"):
                out.append(re.compile(re.search(r'match="(.*)">>', x)[1].lower(), re.S))
                k += 1
            else:
                out += re.findall(r"[0-9a-z\x80-\U0010ffff]+", x.lower())
                k += 1
        return out, k

    def ends(nodes, at):
        if not nodes:
            return {at}
        head, rest = nodes[0], nodes[1:]
        if isinstance(head, str):
            return ends(rest, at + 1) if at < len(own) and own[at] == head else set()
        if isinstance(head, list):
            return set().union(ends(rest, at), *(ends(rest, e) for e in ends(head, at)))
        return set().union(*(ends(rest, e) for e in range(at, len(own) + 1) if head.fullmatch(low[places[at][0] : places[e - 1][1]] if e > at else "")))

    nodes, _ = tree(0)
    return {at: max(found) for at in range(len(own)) if (found := ends(nodes, at))}


TOYS = [
    'a b <<beginOptional>>c <<beginOptional>>d<<endOptional>><<endOptional>> e',
    '<<beginOptional>>x<<endOptional>> a <<var;name="n";original="o";match=".{1,6}">> b c',
    'a <<var;name="n";original="o";match="(?:b )*c?">> d <<var;name="m";original="";match=".*">>',
    'e <<var;name="n";original="o";match="[ab]+( [ab])?">><<beginOptional>>, d<<endOptional>> a',
]


def test_templates_accept_what_brute_force_accepts():
    rng = np.random.default_rng(3)
    for template in TOYS:
        machine = licenses.compile_template(template)
        for _ in range(300):
            text = "".join(rng.choice(list("abcdex"), 1)[0] + str(rng.choice([" ", ", ", "-", "\n"])) for _ in range(rng.integers(0, 12)))
            spoken = licenses.spoken(text.encode())
            got = {at: end for at in range(len(spoken.tokens)) if (end := machine.longest(spoken, at)) is not None}
            assert got == brute_match(template, text), (template, text)


def test_published_templates_need_their_mandatory_wording():
    scanner = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)

    def labels(text):
        spoken = licenses.spoken(text.encode())
        return {x for _, _, x in scanner.scan(spoken.data, np.array(spoken.starts, np.int64), np.array(spoken.ends, np.int64))[1]}

    for label, template in licenses.TEMPLATES.items():
        plain = re.sub(r'<<var;name="[^"]*";original="([^"]*)";match="(?:[^"\\]|\\.)*">>', r"\1", template)
        assert label in labels("Some words. " + re.sub(r"<<(?:begin|end)Optional>>", "", plain) + ". And more"), label
        # mandatory words, and what stands for variables between them
        words, depth = [], 0
        originals = iter(re.findall(r'original="([^"]*)"', template))
        for mark, inside in licenses.parts(template):
            depth += (mark == "beginOptional") - (mark == "endOptional")
            if mark == "var":
                words += [(w, False) for w in next(originals).split() if not depth]
            elif not mark and not depth:
                words += [(w, re.search("[A-Za-z]", w)) for w in inside.split()]
        assert label in labels(" ".join(w for w, _ in words)), label
        for k in [k for k, (_, own) in enumerate(words) if own][::5]:
            assert label not in labels(" ".join([*(w for w, _ in words[:k]), "zzz", *(w for w, _ in words[k + 1 :])])), (label, words[k])
    with pytest.raises(ValueError):
        licenses.compile_template("a <<beginOptional>> b")
    with pytest.raises(ValueError):
        licenses.compile_template('a <<var;name="x">> b')


# 6. Sharding


def test_shards_keep_groups_and_balance(docs, none, spark):
    out = rows(sharding.shard(docs, 4))
    assert ids(sharding.shard(docs, 4)) == ALL_IDS
    text = {i: t for i, t, *_ in ROWS}
    where = collections.defaultdict(set)
    for r in out:
        where[text[r["doc_id"]] or ""].add(r["shard"])
        assert r["size"] == len((text[r["doc_id"]] or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((text[r["doc_id"]] or "").encode()) and r["law"] == "bytes" and r["grown_shard"] is None
    assert all(len(s) == 1 for s in where.values())
    slots = collections.defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(none).count() == 0
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.col("id").cast("string"), (F.col("id") % 37 + 1).cast("int")).alias("text"))
    sums = sorted(r["b"] for r in sharding.shard(many, 8).groupBy("shard").agg(F.sum("size").alias("b")).collect())
    assert len(sums) == 8 and sums[-1] - sums[0] <= 200


# 7. Classifier


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(8)
    out, labels = [], []
    for i in range(400):
        good = i % 5 > 0
        w = prose(i, int(rng.integers(20, 200)), 300).split()
        text = " ".join(w) if good else " ".join(f"{x}$$$" for x in w)
        out.append((i, text))
        if i % 2:
            labels.append((i, int(good), 0))
    out += [(1000, None), (1001, ""), (1001, ""), (None, prose(1, 50))]
    return spark.createDataFrame(out, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_tells_held_out_rows(labelled, none):
    docs, labels = labelled
    out = rows(quality_classifier.classify(docs, labels))
    assert len(out) == 404
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    held = [r for r in out if r["held_out"] and r["doc_id"] < 400]
    right = [r["predicted"] == int(r["doc_id"] % 5 > 0) for r in held]
    assert np.mean(right) > 0.97
    assert len({r["score"] for r in out if r["doc_id"] in (1000, 1001)}) == 1
    assert quality_classifier.classify(none, labels).count() == 0
    assert {r["score"] for r in rows(quality_classifier.classify(docs, labels.where("quality = 7")))} == {0.5}


def test_classifier_never_reads_held_out_labels(labelled):
    docs, labels = labelled
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda y: {r["doc_id"]: r["score"] for r in rows(quality_classifier.classify(docs, y)) if r["doc_id"] is not None}
    assert score(labels) == score(flipped)


def test_classifier_stage_keeps_columns(labelled):
    docs, labels = labelled
    kept = quality_classifier.keep_good(docs, labels)
    predicted = quality_classifier.classify(docs, labels).where("predicted = 1")
    assert kept.columns == docs.columns and ids(kept) == ids(predicted)


def test_prior_estimate():
    up = lambda x: np.cumsum(x[::-1])[::-1].astype(float)
    cells = np.zeros(10)
    cells[8] = 700
    cells[1] = 300
    positive = np.zeros(10)
    positive[8] = 200
    assert 0.7 <= quality_classifier.estimate_prior(up(cells), up(positive), 1000, 200) < 0.75


def test_cut_of_least_risk():
    """Against the risk of every cut, one by one, over two planted heaps of logits; and with a single positive."""
    rng = np.random.default_rng(6)
    good, bad, trusted, prior = rng.normal(7, 0.7, 4000), rng.normal(1, 0.6, 1000), rng.normal(7, 0.7, 500), 0.8
    bins = np.linspace(-quality_classifier.REACH, quality_classifier.REACH, quality_classifier.CELLS + 1)
    cells = lambda s: np.histogram(s, bins)[0].astype(float)
    every = np.concatenate((good, bad))
    cut = quality_classifier.estimate_cut(cells(every), cells(trusted), prior)
    risk = lambda t: prior * (trusted < t).mean() + max(0.0, (every >= t).mean() - prior * (trusted >= t).mean())
    risks = [risk(t) for t in bins[:-1]]
    assert risk(cut) <= min(risks) + 0.02 and (good < cut).mean() == 0 and (bad >= cut).mean() < 0.02
    # the fit's own cut stands where the whole lies on one side, and one positive is not lost by its own cut
    assert quality_classifier.estimate_cut(cells(good), cells(trusted), 1.0) < trusted.min()
    assert quality_classifier.estimate_cut(cells(every), cells(trusted[:1]), prior) <= trusted[0]


def test_cut_keeps_held_out_accuracy(spark):
    """On the given tables, where both kinds are held out."""
    docs, labels = (common.table(spark, "/root/testdata/sf0.01", k) for k in ("documents", "labels"))
    got = rows(quality_classifier.classify(docs, labels).where("held_out").join(labels.select("doc_id", "quality"), "doc_id"))
    good, bad = ([r["predicted"] for r in got if r["quality"] == q] for q in (1, 0))
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.1


def test_fit_reaches_the_least_risk(spark):
    """Against plain gradient descent on the non-negative risk, over the same standardised features."""
    rng = np.random.default_rng(4)
    d = len(quality_classifier.FEATURES)
    good, bad = rng.normal(0.3, 1, (700, d)), rng.normal(-0.3, 1, (300, d))
    every, trusted, prior = np.vstack((good, bad)), rng.normal(0.3, 1, (120, d)), 0.7
    mean, scale = every.mean(0), every.std(0)
    table = spark.createDataFrame([(r.tolist(),) for r in every], "f array<double>")
    w, bend = quality_classifier._fit(table, trusted, mean, scale, prior)
    x, z = (quality_classifier._expanded(m, mean, scale) for m in (trusted, every))
    ridge = np.full(d + 1, quality_classifier.RIDGE + 1 / len(trusted))
    ridge[-1] = 1e-6

    def risk(v):
        negative = np.logaddexp(0, z @ v).mean() - prior * np.logaddexp(0, x @ v).mean()
        return prior * np.logaddexp(0, -(x @ v)).mean() + max(0, negative) + (ridge * v * v).sum() / 2

    def slope(v):
        p, u = 1 / (1 + np.exp(-(x @ v))), 1 / (1 + np.exp(-(z @ v)))
        negative = np.logaddexp(0, z @ v).mean() - prior * np.logaddexp(0, x @ v).mean()
        out = prior * (x.T @ (p - 1)) / len(x) + ridge * v
        return out + (z.T @ u / len(z) - prior * x.T @ p / len(x) if negative >= 0 else 0)

    v = np.zeros(d + 1)
    for _ in range(20_000):
        v -= 0.2 * slope(v)
    assert risk(w) <= risk(v) + 1e-3
    # a positive left out scores as a fit without it says
    w0, bend0 = quality_classifier._fit(table, trusted, mean, scale, None)
    without = np.delete(trusted, 5, 0)
    w1, _ = quality_classifier._fit(table, without, mean, scale, None)
    assert abs(quality_classifier.left_out(x, w0, bend0)[5] - 1 / (1 + math.exp(-float(x[5] @ w1)))) < 0.02


def test_trusted_sample_is_bounded_and_of_least_hash(spark):
    ids = spark.range(5000).withColumn("f", F.array(*(F.lit(0.5) + F.col("id") for _ in quality_classifier.FEATURES))).withColumnRenamed("id", "doc_id")
    got = quality_classifier.sample(ids.union(ids), 300)
    want = [r["doc_id"] + 0.5 for r in ids.orderBy(F.xxhash64("doc_id")).limit(300).collect()]
    assert sorted(got[:, 0]) == sorted(want) and len(quality_classifier.sample(ids.limit(7), 300)) == 7 and len(quality_classifier.sample(ids.limit(0), 300)) == 0


# 8. Rules


def brute_base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = collections.defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i : i + 5])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_rules_measure_exactly(docs, none, spark):
    extra = ["a b c d e a b c d e", "a b c d e f a b c d e", "x " * 9, "same line\nsame line\n \nsame line\n", "one\x0btwo\x0cthree", "é ü ß \U0001f600 z", "#*$%&|<> ###", "a b c d e " * 500]
    every = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(extra, 100)), "doc_id long, text string"))
    text = {i: t for i, t, *_ in ROWS} | dict(enumerate(extra, 100))
    for r in rows(quality_rules.judge(every)):
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == brute_base(text[r["doc_id"]]), text[r["doc_id"]]
        failed = got[0] < 10 or 100 * got[4] > 20 * got[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and ids(kept) == ids(quality_rules.judge(docs).where("kept"))
    assert quality_rules.judge(none).count() == 0 and quality_rules.keep_good(none).count() == 0


def test_rules_run_without_user_functions(docs):
    plan = quality_rules.judge(docs.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# 9. Mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, target, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > most * sizes[s]}
        if not over:
            return target | {s: left * w[s] / total for s in open_}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return target


@pytest.fixture(scope="module")
def sourced(spark):
    rng = np.random.default_rng(9)
    out = [(i, "w " * int(rng.lognormal(4, 1)), None if i % 11 == 0 else f"s{int(i % 7)}" if i % 3 else "s0") for i in range(3000)]
    return out, spark.createDataFrame(out, "doc_id long, text string, source string").repartition(4)


def test_mix_meets_its_targets(sourced, docs, none):
    data, df = sourced
    out = rows(mixing.mix(df))
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
    want = brute_targets(sizes)
    assert all(math.isclose(target[s], want[s], rel_tol=1e-9) for s in want)
    longest = max(r["size"] for r in out)
    assert all(abs(taken[s] - target[s]) <= max(longest, 0.01 * target[s]) for s in want)
    again = {r["doc_id"]: r["taken"] for r in rows(mixing.mix(df.repartition(7)))}
    assert again == {r["doc_id"]: r["taken"] for r in out}
    assert ids(mixing.mix(docs)) == ALL_IDS and mixing.mix(none).count() == 0


def test_mix_meets_targets_on_null_repeated_and_few_documents(spark):
    """500 null ids, one id 300 times, a source of one text; and the small table, where a source has ten documents."""
    data = [(None, "w " * 100, "b") for _ in range(500)] + [(k, "w " * (10 + k % 90), "a") for k in range(400)] + [(7, "x " * 50, "c") for _ in range(300)] + [(k, "y " * (5 + k % 70), None) for k in range(300)]
    for part in (spark.createDataFrame(data, "doc_id long, text string, source string").repartition(5), spark.read.parquet("/root/testdata/sf0.001/documents.parquet")):
        by = mixing.mix(part).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")).collect()
        assert all(r["most"] <= 2 for r in by)
        assert all(abs(r["taken"] - r["target"]) <= max(50, 0.01 * r["target"]) for r in by if r["source"] in ("a", "b", "c", None))
        assert all(abs(r["taken"] - r["target"]) <= 0.01 * r["target"] for r in by if r["source"] and r["source"].startswith("src"))
    hot = spark.createDataFrame(data, "doc_id long, text string, source string")
    taken = mixing.mix(hot).agg(F.sum("taken")).first()[0]
    assert taken == mixing.mix(hot.repartition(3)).agg(F.sum("taken")).first()[0]
    assert mixing.mixed(hot).select(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0] == taken


def test_rates_are_exponentially_tilted(sourced):
    """log(rate) / size is one number for all documents of a source below the cap: the dual's solution."""
    _, df = sourced
    tilt = collections.defaultdict(set)
    for r in rows(mixing.mix(df)):
        if r["size"] and r["rate"] < 2:
            tilt[r["source"]].add(round(math.log(r["rate"]) / r["size"], 9))
    assert tilt and all(len(t) == 1 for t in tilt.values())


def test_mixed_rows_come_as_often_as_taken(docs, sourced):
    _, df = sourced
    copies = collections.Counter()
    for r in rows(mixing.mix(df)):
        copies[r["doc_id"]] += r["copies"]
    got = collections.Counter(r["doc_id"] for r in mixing.mixed(df).select("doc_id").collect())
    assert got == +copies
    assert mixing.mixed(docs).columns == docs.columns


def test_mix_is_native(sourced):
    _, df = sourced
    plan = mixing.mix(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# 10. WARC


@pytest.mark.parametrize("few", [warc.FEW_PAYLOADS, 0])
def test_archives_round_trip(spark, monkeypatch, few):
    monkeypatch.setattr(warc, "FEW_PAYLOADS", few)
    big, bigger = "<p>" + "é" * 600, "<p>" + "y" * 5000
    data = [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, big), (4, "http://b\r\nX: y", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", bigger), (8, "u", bigger), (None, "u", bigger), (9, "u", "\r\n\r\nWARC/1.1\r\n")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("digest", F.lit("x")).repartition(3)
    path = scratch(spark, "t10")
    out = rows(warc.stored(pages, path))
    assert list(out[0]) == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = []
    for i, _, html in data:
        raw = (html or "").encode()
        top = max((j for j, _, h in data if (h or "") == (html or "") and j is not None), default=None)
        revisit = len(raw) >= 1000 and i != top
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted((tuple(r.values()) for r in out), key=key) == sorted(want, key=key)
    archive = warc.Archive(path)
    assert warc.index(archive, spark).count() == len(data)
    found = rows(warc.lookup(archive, spark, spark.createDataFrame([("4",), ("3",)], "page_id string")))
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in found} == {"4": "small", "3": big}
    assert warc.stored(pages.limit(0), scratch(spark, "t10e")).count() == 0

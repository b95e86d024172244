import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grainloom import queries
from grainloom.functions import minhash
from grainloom.functions.ngram_hash import gram_hashes
from grainloom.operators import contamination, dedup
from grainloom.plans import pipelines

FOX = "The quick brown fox jumps over the lazy dog"


def brute_signature(text):
    text = text.lower().strip()
    x = {int.from_bytes(hashlib.md5(text[i : i + 5].encode()).digest()[:4], "little") for i in range(len(text) - 4)}
    if not x:
        return None
    a, b = minhash.coefficients()
    with np.errstate(over="ignore"):
        return ((np.array(sorted(x), np.int64)[:, None] * a + b) % ((1 << 61) - 1)).min(0)


def test_coefficients():
    a, b = minhash.coefficients()
    assert a[:3].tolist() == [2297359619001564596, 1396682528897996047, 1973689801170867272] and b[:3].tolist() == [128244176522764997, 198252699085051290, 782344890802360637]


@settings(deadline=None, max_examples=40)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=8))
def test_signatures_are_exact(texts):
    for got, text in zip(minhash.signatures(texts), texts, strict=True):
        want = brute_signature(text.encode("utf-8", "ignore").decode())
        assert (got is None and want is None) or (got == want).all()


def test_many_letters_at_once():
    text = "".join(chr(c) for c in range(0x4E00, 0x4E00 + 6000))
    assert (minhash.signatures([text])[0] == brute_signature(text)).all()


def brute_kept(texts, threshold=0.85):
    kept, out = [], []
    for t in texts:
        s = brute_signature(t)
        ok = s is not None and all((s == k).mean() < threshold for k in kept)
        out.append(ok)
        if ok:
            kept.append(s)
    return out


def test_pairs_and_members_give_every_link(spark, tmp_path):
    """Exact copies, texts that differ in case or outer blanks, near texts, one that ties in every slot, others, and texts without a shingle."""
    near = " ".join([FOX] * 3) + " and sleeps until the morning comes around"
    texts = [near, FOX, near, near.upper(), f"  {near}\n", near + " again", FOX.lower(), "another text of no likeness", near + " again", None, "abc", "abc", near + "s"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.minhash_pairs(spark, str(tmp_path)).collect()]
    signs = [brute_signature(t or "") for t in texts]
    alike = lambda i, j: 0.0 if signs[i] is None or signs[j] is None else float((signs[i] == signs[j]).mean())
    assert len(set(got)) == len(got) and all(a < b and s == alike(a, b) for a, b, s in got)
    head = {b: a for a, b, s in got if s == 1}
    assert head == {2: 0, 3: 0, 4: 0, 6: 1, 8: 5, 12: 0}
    pairs = {(a, b) for a, b, s in got if s < 1}
    want = {(i, j) for j in range(len(texts)) for i in range(j) if alike(i, j) >= 0.85}
    of = lambda i: head.get(i, i)
    assert pairs and {(i, j) for j in range(len(texts)) for i in range(j) if signs[i] is not None and (of(i) == of(j) or (min(of(i), of(j)), max(of(i), of(j))) in pairs)} == want


def test_greedy_near_duplicates(spark):
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    texts = [FOX, FOX, "hey", "", "An unrelated sentence about something else entirely, really."]
    base = [word() for _ in range(120)]
    for k in range(25):
        base = [*base[3:], word(), word(), word()] if k % 3 else [*base[1:], word()]
        texts.append(" ".join(base))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["kept"] for r in dedup.near(rows).collect()}
    assert [got[i] for i in range(len(texts))] == brute_kept(texts)
    assert dedup.near(rows.limit(0)).count() == 0


def test_greedy_rule_is_not_components(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (4, 5), (4, 6), (5, 6)], "a long, b long")
    heads = spark.createDataFrame([(i,) for i in range(1, 8)], "head long")
    assert sorted(r["head"] for r in dedup.greedy_kept(heads, pairs).collect()) == [1, 3, 4, 7]


def test_exact_and_latest(spark):
    rows = spark.createDataFrame([(2, "a"), (1, "a"), (3, None), (4, "")], "doc_id long, text string")
    assert {r["doc_id"]: r["is_first"] for r in dedup.exact(rows).collect()} == {1: True, 2: False, 3: True, 4: False}
    versions = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("m", 0, "x")], "k string, v int, t string")
    assert sorted(tuple(r) for r in dedup.latest(versions, "k", "v").collect()) == [("k", 2, "new"), ("m", 0, "x")]


def test_funnel(spark):
    text = " ".join(f"word{i}" for i in range(60)) + " mail me at a@b.com"
    rows = spark.createDataFrame([(1, "tiny text"), (2, text), (3, text), (4, text.replace("word1 ", "other "))], "doc_id long, text string")
    out, counts = pipelines.clean(rows, limits=__import__("grainloom.operators.quality", fromlist=["Limits"]).Limits(max_special=0.9))
    assert counts.first().asDict() == {"total": 4, "duplicates": 2, "filtered": 1, "output": 1}
    row = out.first()
    assert row["doc_id"] == 2 and row["text"].endswith("[REDACTED]_EMAIL") and row["n_email"] == 1


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"


def test_word_overlap_counts_repeats_of_the_item(spark):
    items = spark.createDataFrame([(1, f"{ITEM} {ITEM}"), (2, "short item")], "item_id long, text string")
    docs = spark.createDataFrame([(1, ITEM.upper() + "!"), (2, "nothing here"), (3, None)], "doc_id long, text string")
    rows = contamination.word_overlaps(docs, items).collect()
    assert [(r["doc_id"], r["item_id"], r["hits"], r["doc_ngrams"], r["overlap"]) for r in rows] == [(1, 1, 8, 4, 2.0)]
    first = contamination.first_hits(contamination.word_overlaps(docs, items)).first()
    assert first["match_type"] == "exact" and first["doc_id"] == 1
    report = contamination.word_report(docs, items, contamination.word_overlaps(docs, items)).first()
    assert (report["contaminated_items"], report["rate"], report["clean"]) == (1, 0.5, False)


def test_char_overlap_prefers_exact(spark):
    items = spark.createDataFrame([(1, ITEM), (2, "What is the capital of France?")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "  what is  the capital of france"), (2, f"so: {ITEM} and more words follow"), (3, "unrelated text of some length"), (4, "")], "doc_id long, text string")
    rows = {r["doc_id"]: (r["item_id"], r["match_type"]) for r in contamination.char_overlaps(docs, items).collect()}
    assert rows == {1: (2, "exact"), 2: (1, "ngram")}
    text = contamination.benchmark_text([F.lit("q"), F.lit(None).cast("string")], F.array(F.lit("c1"), F.lit("c2")), F.lit("ref"))
    assert docs.select(text.alias("t")).first()["t"] == "q c1 c2 ref"


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(alphabet="abé ", max_size=20), min_size=1, max_size=6))
def test_gram_hashes_stand_for_grams(texts):
    owner, found = gram_hashes(texts, 4)
    want = [{t[i : i + 4] for i in range(len(t) - 3)} or {t} for t in texts]
    assert np.bincount(owner, minlength=len(texts)).tolist() == [len(w) for w in want]
    for i in range(len(texts)):
        for j in range(i):
            both = set(found[owner == i].tolist()) & set(found[owner == j].tolist())
            assert len(both) == len(want[i] & want[j])


def test_clean_counts_rows_that_repeat_ids_or_have_none(spark):
    from grainloom.plans import pipelines

    long = " ".join(f"word{k}" for k in range(60))
    other = " ".join(f"item{k * 7}" for k in range(60))
    data = [(1, long), (1, other), (None, " ".join(f"thing{k * 3}" for k in range(60))), (2, long), (1, long), (None, None)]
    out, counts = pipelines.clean(spark.createDataFrame(data, "doc_id long, text string").repartition(3))
    assert counts.first().asDict() == {"total": 6, "duplicates": 3, "filtered": 0, "output": 3}
    assert sorted((r["doc_id"] is None, r["text"][:4]) for r in out.collect()) == [(False, "item"), (False, "word"), (True, "thin")]


def test_incremental_rows_meet_the_index(spark):
    from grainloom.operators import dedup

    text = lambda seed: " ".join(f"w{seed}x{k}" for k in range(60))
    rows = lambda *r: spark.createDataFrame(list(r), "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, signature array<long>")
    first, index = dedup.incremental(none, rows((5, text(1)), (6, text(2)), (7, text(1) + "!")))
    assert {r["doc_id"]: r["kept"] for r in first.collect()} == {5: True, 6: True, 7: False}
    second, index = dedup.incremental(index, rows((1, text(2)), (2, text(3)), (3, "abc")))
    assert {r["doc_id"]: r["kept"] for r in second.collect()} == {1: False, 2: True, 3: False} and index.count() == 3

"""The pipeline's stages against brute force, and the registered queries."""

import collections
import re

import corpus_pipeline
import pytest
from test_operators import brute_classes

import __spark_entry__ as entry
from grainloom.llm import mixing, packing, quality_rules
from grainloom.llm.common import scratch, table

SF = "/root/testdata/sf0.001"


def test_stages_are_the_five():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "ngram_jaccard_join", "source_mixing", "best_fit_packing"]
    names = entry.queries()
    assert "pipeline" in names and all(any(re.match(rf"op{n}_", k) for k in names) for n in range(1, 11))


def test_each_stage_does_what_its_operator_says(spark):
    docs = table(spark, SF, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, f"test-{name}")
        stage(spark, seen[-1], SF).write.parquet(path)
        seen.append(spark.read.parquet(path))
    assert all(s.columns == docs.columns for s in seen[:5])
    whole = [[r.asDict() for r in s.collect()] for s in seen]
    ids = [collections.Counter(r["doc_id"] for r in w) for w in whole[:5]]
    assert set(ids[1]) == {r["doc_id"] for r in quality_rules.judge(docs).where("kept").select("doc_id").collect()}
    quality = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    assert ids[2] <= ids[1] and sum(quality.get(i) == 1 for i in ids[2]) >= 0.95 * sum(quality.get(i) == 1 for i in ids[1])
    texts = [r["text"] for r in sorted(whole[2], key=lambda r: r["doc_id"])]
    order = sorted(ids[2])
    roots, _ = brute_classes(texts)
    assert set(ids[3]) == {order[r] for r in set(roots)}
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(seen[3]).collect()}
    assert ids[4] == collections.Counter({i: c for i, c in taken.items() if c})
    pieces = collections.Counter(r["doc_id"] for r in packing.pieces(seen[4]).select("doc_id").collect())
    assert collections.Counter(r["doc_id"] for r in whole[5]) == pieces
    ends = collections.Counter()
    for r in whole[5]:
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 4096


def test_stages_take_odd_tables(spark):
    """Names that the operators use themselves, null in every column, repeated rows and ids, a text of megabytes; and no rows at all."""
    names = ["_key", "_text_key", "_id", "_s", "_doc", "_h", "_cell", "node", "bucket", "label", "copies", "size", "rate", "whole", "score", "kept", "length"]
    text = "The members of the board met in the morning and they went over the plans for the year, {}, with the people of the town and the school."
    prose = lambda k: " ".join(text.format(f"number {k} of {k * 7}") for _ in range(1)) + f" It was item {k} that took the most time of all the things on that list, as they had to be there for the vote {k * k}."
    rows = [(k, prose(k), "en", "a", len(prose(k))) for k in range(40)] + [(3, prose(3), "en", "a", 9)] * 2 + [(None, prose(90), None, None, None), (None, prose(90), None, None, None), (None, None, None, None, None), (50, "", "en", "b", 0)]
    rows.append((60, " ".join(f"{prose(k)}\n" for k in range(100, 20_000)), "en", "b", 5_000_000))
    table_ = spark.createDataFrame([(*r, *(f"{n}{r[0]}" for n in names)) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    for docs in (table_, table_.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            got = out.collect()
            if docs is not table_:
                assert not got, name
            elif name != "best_fit_packing":
                assert out.columns == docs.columns and {r["doc_id"] for r in got} <= {r[0] for r in rows}
                assert all(r[n] == f"{n}{r['doc_id']}" for r in got for n in names), name
                assert name in ("quality_rules", "quality_classifier") or 60 in {r["doc_id"] for r in got}, name
            else:
                assert {r["doc_id"] for r in got} == {r[0] for r in rows}


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@pytest.mark.parametrize("name", [n for n in entry.queries() if re.match(r"op\d+_", n)])
def test_queries_return_a_row_a_document(spark, name):
    out = entry.queries()[name](spark, SF)
    n = out.count()
    if name.startswith(("op1_", "op2_")):
        assert n > 0
    else:
        assert n == table(spark, SF, "pages" if name.startswith("op10_") else "documents").count()

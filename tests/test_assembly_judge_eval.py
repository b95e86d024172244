import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grainloom.functions import chat
from grainloom.operators import assemble, evaluate, judge, versioning
from grainloom.plans import pipelines


def test_templates(spark):
    df = spark.createDataFrame([([("system", "S%s"), ("user", "U"), ("assistant", "A"), ("tool", "T"), (None, "N")],)], "m array<struct<role:string,content:string>>")
    show = lambda t: df.select(chat.rendered(F.col("m"), t).alias("t")).first()["t"]
    assert show("chatml") == "<|im_start|>system\nS%s<|im_end|>\n<|im_start|>user\nU<|im_end|>\n<|im_start|>assistant\nA<|im_end|>\n<|im_start|>user\nN<|im_end|>\n"
    assert show("llama").startswith("<|begin_of_text|><|begin_of_text|><|start_header_id|>system")
    assert show("alpaca") == "### Instruction:\nU\n\n### Response:\nA\n\n### Instruction:\nN\n\n### Response:\n"
    assert show("vicuna") == "S%s\n\nUSER: U\nASSISTANT: A</s>\nUSER: N\n"
    with pytest.raises(ValueError):
        chat.rendered(F.col("m"), "other")


def test_conversations(spark):
    rule = "=" * 40
    rows = [(1, "stackoverflow", f" Q? \n{rule}\nAnswers:\n A! Answers: \n{rule}\nmore"), (2, "stackoverflow", "no rule"), (3, "huggingface", "first\n\nsecond"), (4, "huggingface", "x" * 600), (5, "other", "y" * 3000)]
    out = {r["doc_id"]: [(m["role"], m["content"]) for m in r["messages"]] for r in assemble.conversations(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert out[1] == [("system", assemble.HELPFUL), ("user", "Q?"), ("assistant", "A!")] and 2 not in out
    assert out[3] == [("user", "first"), ("assistant", "first\n\nsecond")] and out[4][0][1] == "x" * 500
    assert out[5][2][1] == "y" * 3000 and out[5][1][1].count("y") in (500, 2000, 501, 2001, 502, 2002) or out[5][1][1]


def brute_first_fit(lengths, room):
    bins, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        for b, used in enumerate(bins):
            if used + 1 + lengths[i] <= room:
                bins[b] += 1 + lengths[i]
                break
        else:
            b = len(bins)
            bins.append(lengths[i])
        out[i] = b
    return out


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(0, 20), max_size=60))
def test_first_fit_by_counts_is_first_fit(lengths):
    counts = np.bincount(lengths, minlength=21)
    table, want, ranks, got = assemble.first_fit(counts, 20), brute_first_fit(lengths, 20), {}, {}
    for i, n in enumerate(lengths):
        rank = ranks[n] = ranks.get(n, -1) + 1
        for length, low, many, sequence, each in table.tolist():
            if length == n and low <= rank < low + many:
                got[i] = sequence + (rank - low) // each
    assert got == want


def test_packed_texts(spark):
    texts = [" ".join(["w"] * n) for n in (3, 9, 0, 5, 5, 12, 1, 9, 2)]
    rows = spark.createDataFrame(list(enumerate(texts)), "pos long, text string").repartition(3)
    got = {r["sequence"]: (r["text"], r["n_words"]) for r in assemble.packed(rows, 10).collect()}
    lengths = [min(len(t.split()), 10) for t in texts]
    want = brute_first_fit(lengths, 10)
    order = sorted(range(len(texts)), key=lambda i: -lengths[i])
    for s in set(want.values()):
        own = [i for i in order if want[i] == s]
        assert got[s] == (assemble.SEPARATOR.join(" ".join(texts[i].split()[:10]) for i in own), sum(lengths[i] for i in own))
    assert len(got) == len(set(want.values()))
    assert 0 < assemble.utilisation(assemble.packed(rows, 10), 10).first()["utilisation"] <= 1


@pytest.mark.parametrize(("n", "want"), [(1, (0, 0, 1)), (2, (0, 1, 1)), (3, (1, 1, 1)), (100, (90, 5, 5))])
def test_split_sizes(spark, n, want):
    out = assemble.split(spark.range(n).select(F.col("id").alias("doc_id"), F.lit(4.2).alias("composite_score")))
    counts = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert tuple(counts.get(k, 0) for k in ("train", "validation", "test")) == want


def test_assembled_with_packing(spark):
    rows = spark.createDataFrame([(i, "web", f"text {i} " * 10, 4.0) for i in range(30)], "doc_id long, source string, text string, composite_score double")
    assert pipelines.assembled(rows).count() == 30
    assert 0 < pipelines.assembled(rows, room=512).count() < 30


def test_composites_and_salvage(spark):
    df = spark.createDataFrame([({"a": 4.0, "b": 2.0},), ({"a": 5.0},), ({},)], "s map<string,double>")
    assert [round(r[0], 6) for r in df.select(judge.composite(F.col("s"), {"a": 3, "b": 1})).collect()] == [3.5, 3.75, 0.0]
    assert df.select(judge.composite(F.col("s"), {})).first()[0] == 0.0
    replies = ['{"a": 1}', 'Sure!\n```json\n{"a": 2}\n```\nbye', 'I say {"a": {"b": 3}} indeed', "no json"]
    got = [r[0] for r in spark.createDataFrame([(r,) for r in replies], "r string").select(judge.salvaged_json(F.col("r"))).collect()]
    assert [json.loads(g) if g else None for g in got] == [{"a": 1}, {"a": 2}, {"a": {"b": 3}}, None]
    raw = spark.createDataFrame([("4.9",), ("0",), ("77",), ("x",), (None,)], "r string")
    assert [r[0] for r in raw.select(judge.clamped(F.col("r"))).collect()] == [4, 1, 5, 1, 1]


def test_cache_keeps_every_document(spark):
    docs = spark.createDataFrame([(1, "same"), (2, "same"), (3, "new")], "doc_id long, text string")
    cache = docs.where("doc_id = 1").select(F.sha2("text", 256).alias("content_hash"), F.lit(4.0).alias("composite_score"))
    hits, misses = judge.cached(docs, cache)
    assert sorted(r["doc_id"] for r in hits.collect()) == [1, 2] and [r["doc_id"] for r in misses.collect()] == [3]


def test_agreement(spark):
    rows = spark.createDataFrame([(5.0, 4.0), (5.0, 1.0), (1.0, 1.0), (2.0, 2.0)], "h double, j double")
    r = judge.agreement(rows, "h", "j").first()
    assert (r["kappa"], r["agreement"], r["n_samples"]) == (0.5, 0.75, 4)
    assert judge.agreement(rows.limit(0), "h", "j").first().asDict() == {"kappa": 0.0, "agreement": 0.0, "n_samples": 0}
    d = judge.dimension_agreement(rows, F.col("h"), F.col("j")).first()
    assert d["pearson"] == round(float(np.corrcoef([5, 5, 1, 2], [4, 1, 1, 2])[0, 1]), 4) and d["mae"] == 1.25
    assert judge.dimension_agreement(rows.withColumn("h", F.lit(1.0)), F.col("h"), F.col("j")).first()["pearson"] is None


def test_significance(spark):
    assert evaluate.paired_bootstrap([1] * 50, [1] * 50, 200) == 1.0 and evaluate.paired_bootstrap([1] * 100, [0] * 100, 200) == 0.0
    rows = spark.createDataFrame([("same", 1, 1)] * 50 + [("better", 1, 0)] * 60 + [("mixed", 1, 0), ("mixed", 0, 1)] * 20, "m string, a int, b int")
    p = {r["m"]: r["p_value"] for r in evaluate.bootstrap(rows, ["m"], "a", "b", 2000).collect()}
    assert p["same"] == 1.0 and p["better"] == 0.0 and 0.4 < p["mixed"] < 0.7
    bits = rows.select("m", (F.col("a") == 1).alias("a"), (F.col("b") == 1).alias("b"))
    m = {r["m"]: r["p_value"] for r in evaluate.mcnemar(bits, ["m"], "a", "b").collect()}
    assert m["same"] == 1.0 and m["better"] < 0.001 and m["mixed"] > 0.8


def test_overlap_and_choices(spark):
    assert evaluate.lcs("a b c d".split(), "b x d".split()) == 2
    assert evaluate.overlap_f1("The cat sat.", "the cat") == pytest.approx(0.8) and evaluate.overlap_f1(None, "x") == 0.0
    df = spark.createDataFrame([([0.1, 0.9, 0.9],)], "s array<double>")
    assert df.select(evaluate.argmax_choice(F.col("s"))).first()[0] == 1
    acc = evaluate.accuracy(spark.createDataFrame([("b", True), ("b", False)], "k string, is_correct boolean"), ["k"]).first()
    assert (acc["total"], acc["correct"], acc["accuracy"]) == (2, 1, 0.5)


def test_leaderboard_ties_and_gaps(spark):
    rows = spark.createDataFrame([("x", "a", 0, 0.5), ("x", "b", 1, 0.5), ("y", "a", 0, None), ("z", "a", 0, 0.1), ("z", "b", 1, 0.2)], "benchmark string, model string, rank int, score double")
    assert {r["benchmark"]: r["model"] for r in evaluate.leaderboard(rows).collect()} == {"x": "a", "y": None, "z": "b"}
    assert evaluate.model_pairs(rows).count() == 2


def test_ensemble_and_preferences(spark):
    votes = spark.createDataFrame([(1, "a", 4.0), (1, "a", 2.0), (1, "b", 5.0), (1, "c", 9.0)], "item_id long, criterion string, score double")
    assert evaluate.ensemble(votes, {"a": 0.5, "b": 0.2}).first()["composite"] == 2.5
    answers = spark.createDataFrame([(1, 0, "a b"), (1, 1, "c d"), (1, 2, "e"), (1, 3, "f")], "prompt_id long, i int, text string")
    r = evaluate.preference_pairs(answers).first()
    assert (r["chosen"], r["rejected"]) == ("a b", "f")
    maps = [({"question": "q", "preferred": "c", "rejected": "r"},), ({"prompt": None, "question": "q", "chosen": "c", "rejected": "r"},), ({"prompt": "p"},)]
    assert evaluate.preferences(spark.createDataFrame(maps, "fields map<string,string>")).select("prompt", "chosen", "rejected").collect() == [("q", "c", "r")]


def test_versions(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x":1}\n\n{"x":2}\n')
    (tmp_path / "b.txt").write_text("hello")
    files = versioning.manifest(spark, str(tmp_path))
    snap = versioning.snapshot(files).first()
    assert (snap["num_files"], snap["total_bytes"], snap["total_examples"]) == (2, 22, 2)
    new = files.withColumn("sha256", F.when(F.col("filename") == "b.txt", "other").otherwise(F.col("sha256"))).union(spark.createDataFrame([("c", 1, "s", 0)], "f string, b long, s string, l int"))
    assert {r["filename"]: r["status"] for r in versioning.diff(files, new).collect()} == {"a.jsonl": "unchanged", "b.txt": "modified", "c": "added"}
    diff = {r["path"]: (r["a"], r["b"]) for r in versioning.config_diff(spark, {"a": {"b": 1, "c": [1]}, "d": 2}, {"a": {"b": 1, "c": [2]}, "e": None}).collect()}
    assert diff == {"a.c": ("[1]", "[2]"), "d": ("2", None), "e": (None, "null")}
    runs = [spark.createDataFrame([("eval", "loss", v), ("eval", "zero", z)], "stage string, metric string, value double") for v, z in ((2.0, 0.0), (1.5, 3.0))]
    assert {r["metric"]: (r["delta"], r["pct"]) for r in versioning.metric_deltas(*runs).collect()} == {"loss": (-0.5, -25.0), "zero": (3.0, 0.0)}
    assert len(versioning.config_hash({"a": 1})) == 12 and len(versioning.run_hash({"a": 1})) == 8
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        versioning.manifest(spark, str(tmp_path / "none")).count()

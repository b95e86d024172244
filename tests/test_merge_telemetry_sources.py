import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainloom import queries
from grainloom.functions.text import words
from grainloom.operators import merge, telemetry
from grainloom.sources import config, documents, sinks
from grainloom.streaming import telemetry as streams


def state(spark, **arrays):
    return spark.createDataFrame([(k, [float(x) for x in v]) for k, v in arrays.items()], "param string, values array<double>")


def vectors(spark, *models):
    return spark.createDataFrame([(k, m, [float(x) for x in v]) for m, arrays in enumerate(models) for k, v in arrays.items()], "param string, model int, values array<double>")


def values(df):
    return {r["param"]: np.array(r["values"]) for r in df.collect()}


def test_task_vector_and_linear(spark):
    base = state(spark, w=[1, 2, 3], only=[1], odd=[1, 2])
    got = values(merge.task_vector(base, state(spark, w=[1.5, 2.3, 2.8], odd=[1])))
    assert set(got) == {"w"} and np.allclose(got["w"], [0.5, 0.3, -0.2])
    out = values(merge.linear(state(spark, w=[0, 0], keep=[7]), vectors(spark, {"w": [1, 1]}, {"w": [2, 2]}), [0.5, 0.5]))
    assert np.allclose(out["w"], 1.5) and out["keep"].tolist() == [7]


def brute_ties(base, deltas, weights, density):
    d = [np.asarray(x, float) * w for x, w in zip(deltas, weights)]
    trimmed = []
    for x in d:
        k = max(1, int(len(x) * (1 - density)))
        trimmed.append(np.where(np.abs(x) >= np.sort(np.abs(x))[k - 1], x, 0))
    t = np.array(trimmed)
    votes = np.sign(t).sum(0)
    top = np.sign(t[np.argmax(np.abs(t).sum(1))])
    sign = np.where(votes != 0, np.sign(votes), top)
    same = (np.sign(t) == sign) & (t != 0)
    merged = np.where(same.any(0), (t * same).sum(0) / np.maximum(same.sum(0), 1), 0)
    norm = np.linalg.norm(merged)
    return np.asarray(base) + (merged * np.mean([np.linalg.norm(x) for x in d]) / norm if norm else merged)


def test_ties(spark):
    rng = np.random.default_rng(1)
    a, b, c, base = rng.normal(size=(4, 20))
    got = values(merge.ties(state(spark, w=base), vectors(spark, {"w": a}, {"w": b}, {"w": c}), [0.5, 0.3, 0.2], 0.4))
    assert np.allclose(got["w"], brute_ties(base, [a, b, c], [0.5, 0.3, 0.2], 0.4))


def test_dare_and_slerp(spark):
    kept = values(merge.dare(vectors(spark, {"w": np.ones(1000)}), 0.5))["w"]
    assert set(kept) == {0.0, 2.0} and abs(kept.mean() - 1) < 0.3
    for m in ("dare_linear", "dare_ties", "task_arithmetic"):
        assert "w" in values(merge.METHODS[m](state(spark, w=np.zeros(50)), vectors(spark, {"w": np.ones(50)}), [1.0]))
    a, b = state(spark, w=[1, 0], s=[2], odd=[1, 2], only=[3]), state(spark, w=[0, 1], s=[4], odd=[1])
    assert np.allclose(values(merge.slerp(a, b, 0))["w"], [1, 0]) and np.allclose(values(merge.slerp(a, b, 1))["w"], [0, 1])
    half = values(merge.slerp(a, b, 0.5))
    assert np.isclose(np.linalg.norm(half["w"]), 1) and half["s"].tolist() == [3] and half["odd"].tolist() == [1, 2] and half["only"].tolist() == [3]
    assert merge.parameter_counts(a).first()["parameters"] == 6
    two = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0], [1.0])], "a array<double>, b array<double>")
    assert [r[0] and round(r[0], 6) for r in two.select(merge.similarity(F.col("a"), F.col("b"))).collect()] == [0.707107, None]


def test_metrics(spark):
    rows = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 4.0), ("b", 1, 38.0)], "k string, i int, value double")
    assert {r["k"]: r["total"] for r in telemetry.counters(rows, ["k"]).collect()} == {"a": 6.0, "b": 38.0}
    assert {r["k"]: r["last"] for r in telemetry.gauges(rows, ["k"], "value", "i").collect()} == {"a": 4.0, "b": 38.0}
    seen = spark.createDataFrame([("h", x) for x in (0.05, 0.3, 2.0)], "k string, value double")
    n = lambda compat: [r["n"] for r in telemetry.histogram(seen, ["k"], (0.1, 0.5, 1, 5), compat=compat).collect()]
    assert n(False) == [1, 2, 2, 3, 3] and n(True) == [1, 3, 5, 8, 3]
    series = spark.createDataFrame([("m", "gauge", {"b": "2", "a": "1"}, 1.5), ("m", "gauge", {}, 2.0)], "name string, type string, labels map<string,string>, value double")
    assert telemetry.exposition(series).first()["text"] == '# TYPE m gauge\nm 2.0\nm{a="1",b="2"} 1.5\n'
    many = spark.range(200).select(F.lit("x").alias("k"), F.col("id").cast("double").alias("value"), "id")
    r = telemetry.nearest_rank(many, ["k"], "value").first()
    assert (r["n"], r["mean"], r["pxx"]) == (200, 99.5, 198.0)
    assert telemetry.nearest_rank(many, ["k"], "value", last=100, order=["id"]).first()["pxx"] == 199.0


def test_exposition_numbers_and_order(spark):
    at = [1e7, 59907727.8, -1e15, 1e16, 1.0885086979780916e18, 1e-3, 1e-4, 1.5e-5, 5e-324, -0.0, float("nan"), float("-inf"), None]
    series = spark.createDataFrame([("m", "gauge", {"k": f"{i:02d}"}, x) for i, x in enumerate(at)], "name string, type string, labels map<string,string>, value double")
    assert telemetry.exposition(series).first()["text"] == "# TYPE m gauge\n" + "".join(f'm{{k="{i:02d}"}} {x!r}\n' for i, x in enumerate(at) if x is not None)
    kinds = spark.createDataFrame([("m", "gauge", {"k": k}, 20_000_000.0) for k in ("a!", "a b", "a")], "name string, type string, labels map<string,string>, value float")
    assert telemetry.exposition(kinds).first()["text"] == '# TYPE m gauge\nm{k="a"} 20000000.0\nm{k="a b"} 20000000.0\nm{k="a!"} 20000000.0\n'
    counts = kinds.withColumn("value", F.lit(12345678901).cast("long")).limit(1)
    assert telemetry.exposition(counts).first()["text"].endswith(" 12345678901\n")
    assert telemetry.exposition(kinds.withColumn("value", F.lit(None).cast("double"))).first()["text"] is None


@pytest.mark.parametrize("rows", [[("click", 6e7 / 7)] * 7 + [("view", 0.25), ("view!", 1.5), ("view all", 2.5), (None, 3.0)], [(None, 1.0)], []])
def test_exposition_is_its_sql(spark, tmp_path, rows):
    duckdb = pytest.importorskip("duckdb")
    spark.createDataFrame(rows, "event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    got = [tuple(r) for r in queries.queries()["metric_exposition"](spark, str(tmp_path)).collect()]
    assert got == db.execute(queries.oracle_sql()["metric_exposition"]).fetchall()


def test_moving_statistics(spark):
    x = np.random.default_rng(2).normal(size=300)
    x[250] = 40
    rows = spark.createDataFrame([("r", i, float(v)) for i, v in enumerate(x)], "run string, step long, loss double").repartition(3)
    e, want = None, []
    for v in x:
        e = v if e is None else 0.1 * v + 0.9 * e
        want.append(e)
    got = [r["ema"] for r in telemetry.ema(rows, "run", "step", "loss").orderBy("step").collect()]
    assert np.allclose(got, want)
    spikes = [r["step"] for r in telemetry.spikes(rows, "run", ["step"], "loss").where("is_spike").collect()]
    assert spikes == [250]
    stop = telemetry.early_stop(spark.createDataFrame([("r", i, v) for i, v in enumerate([1.0, 0.5, 3.0, *[2.0] * 7])], "run string, i int, v double"), "run", "i", "v").first()
    assert (stop["best"], stop["stop_at"]) == (2.0, 8)
    assert [r["step"] for r in telemetry.stale_checkpoints(rows, "run", "step", 298).orderBy("step").collect()] == [0, 1]
    s = telemetry.loss_summary(rows, "run", "step", "loss").first()
    assert s["steps"] == 300 and s["first"] == x[0] and np.isclose(s["improvement"], x[0] - x[-1])
    n = telemetry.norms(state(spark, a=[3, 4], z=[0, 0])).collect()
    assert [(r["param"], r["norm"], r["dead"]) for r in n] == [("a", 5.0, False), ("z", 0.0, True)]


def times(spark, rows):
    t0 = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(k, t0 + datetime.timedelta(seconds=s), float(v)) for k, s, v in rows], "event_type string, ts timestamp, value double")


def test_alert_cooldown(spark):
    rows = times(spark, [("a", 0, 9), ("a", 30, 9), ("a", 61, 9), ("a", 62, 1), ("a", 130, 9), ("b", 0, 1)])
    fired = telemetry.alerts(rows, "event_type", "ts", "value", "gt", 5, 60).orderBy("fired_at").collect()
    assert [(r["event_type"], r["fired_at"].minute * 60 + r["fired_at"].second) for r in fired] == [("a", 0), ("a", 61), ("a", 130)]
    stages = spark.createDataFrame([("x", "completed", 1.0), ("y", "completed", 3.0), ("z", "failed", 9.0)], "stage string, status string, end_time double")
    assert telemetry.latest_stage(stages).first()["stage"] == "y"


def run_stream(spark, rows, path, plan, mode):
    rows.coalesce(1).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
    out = []
    q = plan(stream).writeStream.outputMode(mode).foreachBatch(lambda b, i: out.extend(b.collect())).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return out


def test_held_alert_stream(spark, tmp_path):
    rows = times(spark, [("a", 0, 9), ("a", 100, 9), ("a", 310, 9), ("a", 320, 9), ("a", 330, 0), ("a", 340, 9), ("b", 0, 9), ("b", 100, 1), ("b", 400, 9)])
    out = run_stream(spark, rows, str(tmp_path), lambda s: streams.held_alerts(s, 5, 300), "append")
    assert [(r["event_type"], r["fired_at"].minute * 60 + r["fired_at"].second) for r in out] == [("a", 310)]


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    rows = times(spark, [("a", s, 1) for s in range(0, 7200, 100)] + [("a", 0, 1)])
    stream = run_stream(spark, rows, str(tmp_path), streams.tumbling, "complete")
    assert sorted(map(tuple, stream)) == sorted(map(tuple, streams.tumbling(rows).collect()))
    assert streams.distinct_events(rows, ["event_type", "ts"]).count() == 72
    users = rows.withColumn("user_id", F.lit(1))
    assert streams.sessions(users, "90 seconds").count() == 72 and streams.sessions(users, "200 seconds").count() == 1


def test_json_lines_and_sinks(spark, tmp_path):
    (tmp_path / "in/deep").mkdir(parents=True)
    (tmp_path / "in/a.jsonl").write_text('{"x":1}\n\n{"x":2}\n')
    (tmp_path / "in/deep/b.jsonl").write_text('{"x":3}\nbroken\n')
    assert documents.jsonl(spark, str(tmp_path / "in"), "x int", "DROPMALFORMED").collect() and documents.jsonl(spark, str(tmp_path / "in"), "x int", "DROPMALFORMED").agg(F.sum("x")).first()[0] == 6
    with pytest.raises(Exception):
        documents.jsonl(spark, str(tmp_path / "in"), "x int").collect()
    with pytest.raises(Exception):
        documents.jsonl(spark, str(tmp_path / "missing")).collect()
    (tmp_path / "urls").write_text("# note\n\n http://a \n #kept\n")
    assert sorted(r["url"] for r in documents.url_list(spark, str(tmp_path / "urls")).collect()) == ["#kept", "http://a"]
    rows = spark.range(1200).withColumn("split", F.when(F.col("id") < 1000, "train").otherwise("test"))
    sinks.jsonl_batches(rows.coalesce(1), str(tmp_path / "b"), 500)
    assert len(list((tmp_path / "b").glob("*.json"))) == 3
    sinks.splits(rows, str(tmp_path / "s"), "arrow")
    assert spark.read.parquet(str(tmp_path / "s/split=train")).count() == 1000
    scored = rows.select("id", (F.col("id") % 5).cast("double").alias("composite_score"))
    sinks.scored_and_passed(scored, str(tmp_path / "j"))
    assert spark.read.parquet(str(tmp_path / "j/passed")).count() == 240
    assert documents.training_set(spark, str(tmp_path / "s")).count() == 1200


def test_html_pages(spark):
    html = '<html><head><title> A &amp; B </title><style>x{}</style></head><body><nav>menu</nav><p>One <b>two</b> three</p><script>var t="</p>"</script><a href="/x#f">link</a><a href="mailto:a@b">m</a><footer>end</footer></body></html>'
    text, title, links = documents.parse_page(html)
    assert text == "A & B\nOne\ntwo\nthree\nlink\nm" and title == "A & B" and links == ["/x#f", "mailto:a@b"]
    assert documents.parse_page("")[0] == "" and documents.parse_page(None)[0] == ""
    assert documents.absolute("http://a.b:8/c/d", ["e", "//h/i", "ftp://x", "http://[bad"]) == ["http://a.b:8/c/e", "http://h/i"]
    page = lambda body: f"<p>{body * 30}</p>"
    pages = spark.createDataFrame([("http://a.b:8/1", page("word ") + '<a href="/2">x</a>'), ("http://a.b:8/2", page("more ") + '<a href="/3">x</a><a href="/1">x</a>'), ("http://a.b:8/3", "tiny" + '<a href="/4">x</a>'), ("http://a.b:8/4", page("far "))], "url string, html string")
    docs = {r["url"]: r for r in documents.crawled(pages).collect()}
    assert set(docs) == {f"http://a.b:8/{i}" for i in (1, 2, 4)} and docs["http://a.b:8/1"]["title"] == "/1" and docs["http://a.b:8/1"]["metadata"]["domain"] == "a.b:8"
    order = documents.crawl_order(pages, pages.limit(1).select("url"), 3)
    assert {r["url"][-1]: r["depth"] for r in order.collect()} == {"1": 0, "2": 1, "3": 2}


def test_sources_unite(spark):
    issues = spark.createDataFrame([("o/r", 1, "u", "T", "B", ["bug", "ui"], None, [("me", f"c{i}") for i in range(12)]), ("o/r", 2, "u", "PR", "B", [], "yes", None)], "repo string, number long, html_url string, title string, body string, labels array<string>, pull_request string, comments array<struct<user:string,body:string>>")
    questions = spark.createDataFrame([(7, "l", "Q", "body", 3, ["t"], [(1, False, "low"), (9, True, "best")]), (8, "l", "Q", "b", -1, [], [])], "question_id long, link string, title string, body string, score int, tags array<string>, answers array<struct<score:int,is_accepted:boolean,body:string>>")
    hub = spark.createDataFrame([("hi", [("human", "q"), ("gpt", "a")]), ("", None)], "instruction string, conversations array<struct<from:string,value:string>>")
    feed = spark.createDataFrame([('<feed><entry><id>http://x/abs/1</id><title>T\n one</title><summary>S</summary><published>2024-01-02T00:00:00Z</published><author><name>N</name></author><link href="p" title="pdf"/></entry><entry><id>http://x/abs/2</id><title>U</title><summary>S</summary><published>2020-01-02</published></entry></feed>',)], "xml string")
    out = {r["source"]: r for r in documents.ingest({"github": (issues, {}), "stackoverflow": (questions, {}), "huggingface": (hub, {"dataset": "d", "fields": ["instruction", "conversations", "none"]}), "arxiv": (feed, {"first": "2024-01-01"}), "unknown": (hub, {})}).collect()}
    assert out["github"]["content"] == "Issue: T\n\nLabels: bug, ui\n\nBody:\nB\n\nComments:\n" + "\n\n---\n\n".join(f"**me**: c{i}" for i in range(10)) and out["github"]["source_id"] == "o/r/issues/1"
    assert out["stackoverflow"]["content"] == "Question: Q\nTags: t\nScore: 3\n\nbody\n\n" + "=" * 40 + "\nAnswers:\n[Score: 9  \u2713 Accepted]\nbest\n\n---\n\n[Score: 1]\nlow"
    assert out["huggingface"]["content"] == "instruction: hi\n\n[human]: q\n\n[gpt]: a" and out["huggingface"]["source_id"] == "d/0"
    assert out["arxiv"]["content"] == "Title: T\n one\n\nAbstract: S" and out["arxiv"]["source_id"] == "1" and out["arxiv"]["metadata"]["pdf_url"] == "p"
    with pytest.raises(ValueError):
        documents.ingest({"unknown": (hub, {})})
    assert spark.createDataFrame([("a b",)], "t string").select(F.size(words(F.col("t")))).first()[0] == 2


def test_config(tmp_path, monkeypatch):
    monkeypatch.setenv("GL_A", "1")
    (tmp_path / "c.yaml").write_text("a: ${GL_A}\nb: {c: ['${GL_NONE:7}', '${GL_NONE}']}\nn: 3\n")
    c = config.load(str(tmp_path / "c.yaml"), {"b.d.e": "5"})
    assert c == {"a": "1", "b": {"c": ["7", "${GL_NONE}"], "d": {"e": "5"}}, "n": 3}
    assert config.get(c, "b.d.e") == "5" and config.get(c, "x.y", 0) == 0
    config.checked(c, {"n": (0, 5), "none": (0, 1)})
    with pytest.raises(ValueError):
        config.checked(c, {"n": (0, 2)})
    assert len(config.grid({"a": [1, 2], "b": [3, 4, 5]})) == 6 and len(config.grid({"a": [1, 2], "b": [3, 4, 5]}, 4)) == 4
    d = next(config.draws({"a": [1], "b": (1, 3), "c": (0.5, 0.6), "d": (1e-5, 1e-3, "log")}, 1))
    assert d["a"] == 1 and 1 <= d["b"] <= 3 and 0.5 <= d["c"] <= 0.6 and 1e-5 <= d["d"] <= 1e-3


def test_ranks_are_found_in_cells(spark):
    from grainloom.operators import telemetry

    import random

    rng = random.Random(3)
    data = [(k % 3, rng.choice([rng.random() * 10**rng.randint(0, 6), 5.0, -3.0])) for k in range(3000)] + [(7, 1.5)] * 10 + [(8, 2.0), (9, None)]
    out = {r["g"]: r for r in telemetry.nearest_rank(spark.createDataFrame(data, "g int, v double"), ["g"], "v").collect()}
    for g in (0, 1, 2, 7, 8):
        own = sorted(v for k, v in data if k == g)
        assert out[g]["n"] == len(own) and out[g]["pxx"] == own[int(len(own) * 0.99)] and abs(out[g]["mean"] - sum(own) / len(own)) < 1e-6


def test_models_that_lack_a_parameter_count_as_zeros(spark):
    from grainloom.operators import merge

    base = spark.createDataFrame([("p", [0.0, 0.0]), ("q", [1.0])], "param string, values array<double>")
    vectors = spark.createDataFrame([("p", 0, [3.0, 4.0])], "param string, model int, values array<double>")
    out = {r["param"]: r["values"] for r in merge.ties(base, vectors, [1.0, 1.0], density=1.0).collect()}
    assert out["q"] == [1.0] and abs(sum(x * x for x in out["p"]) ** 0.5 - 2.5) < 1e-9


def test_manifest_tells_folders_apart(spark, tmp_path):
    from grainloom.operators import versioning

    for k in "ab":
        (tmp_path / k).mkdir()
        (tmp_path / k / "part.jsonl").write_text('{"x": 1}\n' * (2 if k == "a" else 3))
    files = versioning.manifest(spark, str(tmp_path))
    assert {(r["filename"], r["lines"]) for r in files.collect()} == {("a/part.jsonl", 2), ("b/part.jsonl", 3)}
    assert versioning.snapshot(files).first()["total_examples"] == 5


def test_significance_of_models(spark):
    from grainloom.operators import evaluate

    data = [("b", m, rank, k, int(ok(k))) for rank, (m, ok) in enumerate((("good", lambda k: k % 10 > 0), ("bad", lambda k: k % 2 > 0), ("short", lambda k: True))) for k in range(50 if m == "short" else 100)]
    out = {(r["model_a"], r["model_b"]): r for r in evaluate.significance(spark.createDataFrame(data, "benchmark string, model string, rank int, item int, is_correct int")).collect()}
    assert out["good", "bad"]["significant"] and out["good", "bad"]["p_value"] < 0.01 and abs(out["good", "bad"]["delta"] - 0.4) < 1e-9
    assert out["good", "short"]["p_value"] == 1.0 and not out["good", "short"]["significant"]

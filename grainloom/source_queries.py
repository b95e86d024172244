"""Queries for sources, sinks, fallbacks and formats: payloads are formed from the tables, and SQL says what comes out."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainloom.functions.chat import TEMPLATES
from grainloom.operators import assemble, contamination, dedup, evaluate, judge, merge, telemetry, versioning
from grainloom.plans import pipelines
from grainloom.queries import _CHAR13, _COMPOSITE, _GREEDY, _HASH, _SQL, _literal, _overlaps, _scores, _state, _streamed, _t, contamination_chars, query
from grainloom.session import numbered, scratch
from grainloom.sources import documents as sources
from grainloom.sources import sinks
from grainloom.streaming import telemetry as streams


# Sinks and the scans that read them back.
@query("SELECT doc_id, source, length(text)::BIGINT AS n FROM documents")
def scan_jsonl(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "jsonl")
    sinks.jsonl_batches(_t(spark, d, "documents").select("doc_id", "source", "text"), path)
    return sources.jsonl(spark, path, "doc_id long, source string, text string").select("doc_id", "source", F.length("text").cast("long").alias("n"))


@query(_SQL["stratified_split"])
def scan_training_set(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "splits")
    rows = _t(spark, d, "documents").select("doc_id", "source").join(_scores(spark, d).select("doc_id", "composite_score"), "doc_id", "left")
    sinks.splits(assemble.split(rows), path)
    read = spark.read.option("basePath", path).parquet(f"{path}/*")
    return read.select("doc_id", "source", F.round("composite_score", 6).alias("composite_score"), "split")


@query("SELECT doc_id, source FROM documents JOIN (" + _COMPOSITE + ") USING (doc_id) WHERE composite_score >= 3.5")
def sink_scored_and_passed(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "scored")
    sinks.scored_and_passed(judge.with_scores(_t(spark, d, "documents").select("doc_id", "source"), _scores(spark, d)), path)
    return spark.read.parquet(f"{path}/passed").select("doc_id", "source")


@query(_SQL["contamination_report"])
def sink_report(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "report")
    sinks.report(contamination.word_report(_t(spark, d, "documents"), _t(spark, d, "benchmark"), _overlaps(spark, d)), path)
    return spark.read.json(path).select("total_items", "total_docs", "contaminated_items", "hit_docs", "rate", "clean")


@query("SELECT trim(url) AS url FROM pages WHERE page_id % 5 <> 0 AND trim(url) <> ''")
def scan_url_list(spark: SparkSession, d: str) -> DataFrame:
    """Every fifth URL is a comment; blank lines stand between."""
    path = scratch(spark, "urls")
    line = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("# "), "url")).otherwise(F.concat(F.lit("  "), "url", F.lit(" \n")))
    _t(spark, d, "pages").select(line.alias("value")).write.text(path)
    return sources.url_list(spark, path)


@query("SELECT vec_id // 2 AS param, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) AS total FROM embeddings WHERE vec_id % 2 = 1 OR vec_id + 1 NOT IN (SELECT vec_id FROM embeddings)")
def scan_weights(spark: SparkSession, d: str) -> DataFrame:
    """Two shards: the second has parameters of the first anew."""
    path = scratch(spark, "weights")
    for odd, name in ((0, "shard-1"), (1, "shard-2")):
        sinks.weights(_state(spark, d, odd), f"{path}/{name}")
    total = F.aggregate("values", F.lit(0.0), lambda s, x: s + x)
    return sources.weights(spark, path).select("param", F.round(total, 4).alias("total"))


# Sources: payloads as their services give them.
_TURNS = "SELECT conv_id, list(struct_pack(turn := turn, role := role, text := coalesce(text, '')) ORDER BY turn) AS t FROM conversations GROUP BY conv_id"


def _talks(spark: SparkSession, d: str) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text"))))
    return _t(spark, d, "conversations").groupBy("conv_id").agg(turns.alias("t"))


@query(f"""
SELECT 'o/r/issues/' || conv_id AS source_id, 'T' || conv_id AS title, 'Issue: T' || conv_id || chr(10) || chr(10) || 'Labels: ' || t[1].role || ', all' || chr(10) || chr(10) || 'Body:' || chr(10) || t[1].text || chr(10) || chr(10) || 'Comments:' || chr(10)
  || array_to_string(list_transform(t[1:10], lambda c: '**' || c.role || '**: ' || c.text), chr(10) || chr(10) || '---' || chr(10) || chr(10)) AS content FROM ({_TURNS}) WHERE conv_id % 7 <> 0""")
def source_issues(spark: SparkSession, d: str) -> DataFrame:
    return sources.issues(_issues(spark, d)).select("source_id", "title", "content")


def _issues(spark: SparkSession, d: str) -> DataFrame:
    said = F.transform("t", lambda c: F.struct(c["role"].alias("user"), c["text"].alias("body")))
    name = F.concat(F.lit("T"), F.col("conv_id").cast("string"))
    request = F.when(F.col("conv_id") % 7 == 0, F.lit("yes"))
    return _talks(spark, d).select(F.lit("o/r").alias("repo"), F.col("conv_id").alias("number"), F.lit("u").alias("html_url"), name.alias("title"), F.col("t")[0]["text"].alias("body"), F.array(F.col("t")[0]["role"], F.lit("all")).alias("labels"), request.alias("pull_request"), said.alias("comments"))


@query(f"""
WITH a AS (SELECT conv_id, list_transform(list_sort(list_transform(t, lambda x, i: struct_pack(k := -(length(x.text) % 10), i := i, ok := i = 2, body := x.text))), lambda x: x) AS a FROM ({_TURNS}))
SELECT conv_id::VARCHAR AS source_id, 'https://stackoverflow.com/q/' || conv_id AS url, 'Question: Q' || conv_id || chr(10) || 'Tags: x, y' || chr(10) || 'Score: ' || (conv_id % 4) || chr(10) || chr(10) || 'asked' || chr(10) || chr(10) || repeat('=', 40) || chr(10) || 'Answers:' || chr(10)
  || array_to_string(list_transform(a[1:5], lambda x: '[Score: ' || (-x.k) || CASE WHEN x.ok THEN '  ✓ Accepted' ELSE '' END || ']' || chr(10) || x.body), chr(10) || chr(10) || '---' || chr(10) || chr(10)) AS content FROM a WHERE conv_id % 4 >= 1""")
def source_questions(spark: SparkSession, d: str) -> DataFrame:
    return sources.questions(_questions(spark, d), least_score=1).select("source_id", "url", "content")


def _questions(spark: SparkSession, d: str) -> DataFrame:
    answers = F.transform("t", lambda c, i: F.struct((F.length(c["text"]) % 10).alias("score"), (i == 1).alias("is_accepted"), c["text"].alias("body")))
    return _talks(spark, d).select(F.col("conv_id").alias("question_id"), F.lit(None).cast("string").alias("link"), F.concat(F.lit("Q"), F.col("conv_id").cast("string")).alias("title"), F.lit("asked").alias("body"), (F.col("conv_id") % 4).alias("score"), F.array(F.lit("x"), F.lit("y")).alias("tags"), answers.alias("answers"))


@query(f"""
WITH r AS (SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN 'do ' || conv_id END AS instruction, CASE WHEN conv_id % 5 = 0 THEN [] ELSE t END AS t FROM ({_TURNS})),
c AS (SELECT conv_id, array_to_string(list_concat(CASE WHEN instruction IS NULL THEN [] ELSE ['instruction: ' || instruction] END, list_transform(t, lambda x: '[' || x.role || ']: ' || x.text)), chr(10) || chr(10)) AS content FROM r)
SELECT 'set/' || (row_number() OVER (ORDER BY conv_id) - 1) AS source_id, 'set - Example ' || (row_number() OVER (ORDER BY conv_id) - 1) AS title, content FROM c WHERE content <> ''""")
def source_hub_rows(spark: SparkSession, d: str) -> DataFrame:
    return sources.hub_rows(_hub(spark, d), "set", order=["conv_id"]).select("source_id", "title", "content")


def _hub(spark: SparkSession, d: str) -> DataFrame:
    turns = F.when(F.col("conv_id") % 5 != 0, F.transform("t", lambda c: F.struct(c["role"].alias("from"), c["text"].alias("value"))))
    return _talks(spark, d).select("conv_id", F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("do "), F.col("conv_id").cast("string"))).alias("instruction"), turns.alias("conversations"))


_ATOM = "SELECT doc_id::VARCHAR AS source_id, 'http://x/abs/' || doc_id AS url, 'Title: About ' || doc_id || chr(10) || ' more' || chr(10) || chr(10) || 'Abstract: in ' || lang AS content FROM documents WHERE 2000 + doc_id % 25 BETWEEN 2010 AND 2020"


def _atom(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("doc_id").cast("string")
    xml = F.concat(F.lit("<feed><entry><id>http://x/abs/"), key, F.lit("</id><title> About "), key, F.lit("\n more </title><summary>in "), "lang", F.lit("</summary><published>"), (2000 + F.col("doc_id") % 25).cast("string"), F.lit("-03-01T00:00:00Z</published></entry></feed>"))
    return _t(spark, d, "documents").select(xml.alias("xml"))


@query(_ATOM)
def source_atom(spark: SparkSession, d: str) -> DataFrame:
    return sources.atom(_atom(spark, d), "2010-01-01", "2020-12-31").select("source_id", "url", "content")


@query(f"SELECT 'github' AS source, count(*) AS n FROM ({_TURNS}) WHERE conv_id % 7 <> 0 UNION ALL SELECT 'stackoverflow', count(*) FROM ({_TURNS}) WHERE conv_id % 4 >= 1 UNION ALL SELECT 'arxiv', count(*) FROM ({_ATOM})")
def source_union(spark: SparkSession, d: str) -> DataFrame:
    payloads = {"github": (_issues(spark, d), {}), "stackoverflow": (_questions(spark, d), {"least_score": 1}), "arxiv": (_atom(spark, d), {"first": "2010-01-01", "last": "2020-12-31"}), "unknown": (_hub(spark, d), {})}
    return sources.ingest(payloads).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


# Fallbacks, aliases, salvage.
def _fields(spark: SparkSession, d: str) -> DataFrame:
    cases = [F.create_map(F.lit("text"), "text"), F.create_map(F.lit("instruction"), "text", F.lit("prompt"), F.lit("p")), F.create_map(F.lit("prompt"), "lang"), F.create_map(F.lit("other"), "lang")]
    pick = F.col("doc_id") % 4
    of = F.when(pick == 0, cases[0]).when(pick == 1, cases[1]).when(pick == 2, cases[2]).otherwise(cases[3])
    return _t(spark, d, "documents").select("doc_id", of.alias("fields"))


@query("SELECT doc_id, md5(CASE doc_id % 4 WHEN 0 THEN coalesce(text, '') WHEN 1 THEN coalesce(text, '') WHEN 2 THEN coalesce(lang, '') ELSE '' END) AS text_md5 FROM documents")
def text_fallback(spark: SparkSession, d: str) -> DataFrame:
    return _fields(spark, d).select("doc_id", F.md5(sources.text_of(F.col("fields"))).alias("text_md5"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN sha256(coalesce(text, '')) WHEN 1 THEN 'id' || doc_id ELSE '' END AS key FROM documents")
def document_identity(spark: SparkSession, d: str) -> DataFrame:
    k, source_id = F.col("doc_id") % 3, F.concat(F.lit("id"), F.col("doc_id").cast("string"))
    fields = F.create_map(F.lit("content_hash"), F.when(k == 0, F.sha2(F.coalesce("text", F.lit("")), 256)).otherwise(""), F.lit("source_id"), F.when(k < 2, source_id))
    return _t(spark, d, "documents").select("doc_id", sources.identity(fields).alias("key"))


@query("SELECT item_id, md5('q' || item_id || ' ' || coalesce(text, '') || ' a b r') AS text_md5 FROM benchmark")
def benchmark_text(spark: SparkSession, d: str) -> DataFrame:
    text = contamination.benchmark_text([F.concat(F.lit("q"), F.col("item_id").cast("string")), F.lit(None).cast("string"), F.col("text")], F.array(F.lit("a"), F.lit("b")), F.lit("r"))
    return _t(spark, d, "benchmark").select("item_id", F.md5(text).alias("text_md5"))


@query("SELECT conv_id, 'p' || conv_id AS prompt, CASE WHEN conv_id % 4 = 0 THEN 'preferred' ELSE 'chosen' END || conv_id AS chosen, 'r' || conv_id AS rejected FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 5 <> 0")
def preference_aliases(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("conv_id").cast("string")
    of = lambda name, value: F.create_map(F.lit(name), value)
    prompt = F.when(F.col("conv_id") % 3 == 0, of("prompt", F.concat(F.lit("p"), key))).when(F.col("conv_id") % 3 == 1, of("question", F.concat(F.lit("p"), key))).otherwise(of("instruction", F.concat(F.lit("p"), key)))
    chosen = F.when(F.col("conv_id") % 4 == 0, of("preferred", F.concat(F.lit("preferred"), key))).otherwise(of("chosen", F.concat(F.lit("chosen"), key)))
    rejected = of("rejected_response", F.when(F.col("conv_id") % 5 != 0, F.concat(F.lit("r"), key)))
    rows = _t(spark, d, "conversations").select("conv_id").distinct().select("conv_id", F.map_concat(prompt, chosen, rejected).alias("fields"))
    return evaluate.preferences(rows).select("conv_id", "prompt", "chosen", "rejected")


def _reply(key: Column) -> Column:
    body = F.concat(F.lit('{"quality": '), (key % 8).cast("string"), F.lit("}"))
    return F.when(key % 5 == 0, body).when(key % 5 == 1, F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```\nDone."))).when(key % 5 == 2, F.concat(F.lit("I say "), body, F.lit(" in all."))).when(key % 5 == 3, F.lit("no idea")).otherwise(F.lit('{"quality": '))


@query("SELECT doc_id, CASE WHEN doc_id % 5 < 3 THEN doc_id % 8 END AS quality, greatest(1, least(5, CASE WHEN doc_id % 5 < 3 THEN doc_id % 8 ELSE 1 END))::INTEGER AS clamped FROM documents")
def salvaged_scores(spark: SparkSession, d: str) -> DataFrame:
    value = F.get_json_object(judge.salvaged_json(_reply(F.col("doc_id"))), "$.quality")
    return _t(spark, d, "documents").select("doc_id", value.cast("long").alias("quality"), judge.clamped(value).alias("clamped"))


@query("SELECT doc_id, 1.0::DOUBLE + least(length(substring(coalesce(text, ''), 1, 4000)), 4)::DOUBLE AS composite_score FROM documents")
def judge_callable(spark: SparkSession, d: str) -> DataFrame:
    """A scorer in place of a model: the length of what it is asked about, up to 4, and 1."""

    def scorer(prompts: pd.Series) -> pd.Series:
        n = prompts.map(lambda p: 1 + min(4, len(p.split("Text:\n", 1)[1])))
        return n.map(lambda k: f'Here: {{"quality": {k}, "civility": {k}}}')

    out = judge.scored_by(_t(spark, d, "documents"), scorer, {"quality": 0.7, "civility": 0.3})
    return out.select("doc_id", F.round("composite_score", 6).alias("composite_score"))


# Evaluation, versions, telemetry, merges.
@query(f"WITH {_CHAR13} SELECT (SELECT count(*) FROM documents) AS total_training_examples, (SELECT count(*) FROM benchmark) AS total_benchmark_examples, count(DISTINCT doc_id) AS contaminated_count, count(*) AS matches, count(DISTINCT doc_id) / (SELECT count(*) FROM documents)::DOUBLE AS contamination_rate FROM c")
def contamination_training(spark: SparkSession, d: str) -> DataFrame:
    return contamination.training_report(_t(spark, d, "documents"), _t(spark, d, "benchmark"), contamination_chars(spark, d))


_LATER = _GREEDY.replace("FROM documents", "FROM (SELECT doc_id + 1000000000000 * (doc_id % 2) AS doc_id, text FROM documents) d")


@query(f"WITH RECURSIVE {_LATER} SELECT doc_id - 1000000000000 AS doc_id, kept FROM mh_kept WHERE doc_id >= 1000000000000")
def incremental_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Odd ids come after even ones, against the index that those have left."""
    docs = _t(spark, d, "documents").select("doc_id", "text")
    none = spark.createDataFrame([], "doc_id long, signature array<long>")
    index = dedup.incremental(none, docs.where("doc_id % 2 = 0"))[1]
    return dedup.incremental(index, docs.where("doc_id % 2 = 1"))[0]


@query("SELECT * FROM (VALUES ('a.b', '1', '2'), ('a.c', '[1, 2]', NULL), ('d', NULL, '\"x\"')) t(path, a, b)")
def config_diff(spark: SparkSession, d: str) -> DataFrame:
    return versioning.config_diff(spark, {"a": {"b": 1, "c": [1, 2]}, "e": {"f": True}}, {"a": {"b": 2}, "d": "x", "e": {"f": True}})


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def metric_log(spark: SparkSession, d: str) -> DataFrame:
    """Appended in two runs."""
    path = scratch(spark, "log")
    for odd in (0, 1):
        telemetry.append_log(_t(spark, d, "events").where(F.col("event_id") % 2 == odd).select("event_type", "value"), path)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("""
WITH l AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 200),
r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n, avg(value) OVER (PARTITION BY event_type) AS mean FROM l)
SELECT event_type, n, round(mean, 6) AS mean, value AS pxx FROM r WHERE i = floor(n * 0.99)""")
def latency_p99_recent(spark: SparkSession, d: str) -> DataFrame:
    return telemetry.nearest_rank(_t(spark, d, "events"), ["event_type"], "value", last=200, order=["ts", "event_id"]).withColumn("mean", F.round("mean", 6))


@query("""
WITH r AS (SELECT event_type, ts, value > 20 AS hot, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events),
g AS (SELECT *, i - row_number() OVER (PARTITION BY event_type, hot ORDER BY i) AS run FROM r),
b AS (SELECT event_type, ts, epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY event_type, run)) AS held, run FROM g WHERE hot)
SELECT event_type, min(ts) AS fired_at FROM b WHERE held >= 1800000000 GROUP BY event_type, run""")
def held_alerts(spark: SparkSession, d: str) -> DataFrame:
    return _streamed(spark, d, "held", lambda s: streams.held_alerts(s, 20.0, 1800), "append")


@query("SELECT vec_id, list_position(embedding, list_max(embedding))::INTEGER - 1 AS choice FROM embeddings")
def argmax_choice(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "embeddings").select("vec_id", evaluate.argmax_choice(F.col("embedding")).cast("int").alias("choice"))


@query("""
WITH e AS (SELECT vec_id // 2 AS param, vec_id % 2 AS odd, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)
SELECT a.param, round(list_cosine_similarity(a.v, b.v), 6) AS cosine FROM e a JOIN e b ON a.param = b.param AND a.odd = 0 AND b.odd = 1""")
def state_similarity(spark: SparkSession, d: str) -> DataFrame:
    both = _state(spark, d, 0).join(_state(spark, d, 1).withColumnRenamed("values", "other"), "param")
    return both.select("param", F.round(merge.similarity(F.col("values"), F.col("other")), 6).alias("cosine"))


@query("""
WITH a AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS pos FROM benchmark), b AS (SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS pos FROM pages)
SELECT item_id, page_id FROM a JOIN b USING (pos)""")
def positional_zip(spark: SparkSession, d: str) -> DataFrame:
    at = lambda name, key: numbered(_t(spark, d, name).select(key), [key], "pos")
    return evaluate.zipped(at("benchmark", "item_id"), at("pages", "page_id")).select("item_id", "page_id")


_FORM = TEMPLATES["chatml"]
_RENDERED = _literal(_FORM["bos"]) + " || " + " || ".join(f"{_literal(_FORM[role][0])} || {at} || {_literal(_FORM[role][1])}" for role, at in (("system", "system"), ("user", "instruction"), ("assistant", "response")))


@query(f"SELECT doc_id, md5({_RENDERED}) AS text_md5, split FROM ({_SQL['document_conversations']}) JOIN (SELECT doc_id, split FROM ({_SQL['stratified_split']})) USING (doc_id)")
def assembled_texts(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "documents").join(_scores(spark, d).select("doc_id", "composite_score"), "doc_id", "left")
    return pipelines.assembled(rows).select("doc_id", F.md5("text").alias("text_md5"), "split")

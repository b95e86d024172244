"""Judged documents: composites, cache lookups, thresholds, salvage of replies, agreement with people."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.functions.text import rounded
from grainloom.operators.dedup import latest


def composite(scores: Column, weights: Mapping[str, float]) -> Column:
    """The weighted mean of a map of scores; a missing dimension is 0; no weight gives 0."""
    total = sum(weights.values())
    if not total:
        return F.lit(0.0)
    parts = [F.coalesce(F.try_element_at(scores, F.lit(k)), F.lit(0.0)) * w for k, w in weights.items()]
    return sum(parts[1:], parts[0]) / total


def salvaged_json(reply: Column) -> Column:
    """The JSON text in a reply: all of it, else the first fenced block, else from the first { to the last }; null if none parses."""
    fenced = F.regexp_extract(reply, r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    braced = F.regexp_extract(reply, r"(?s)(\{.*\})", 1)
    return F.coalesce(*(F.when(F.try_parse_json(x).isNotNull() & (F.trim(x) != ""), x) for x in (reply, fenced, braced)))


def clamped(raw: Column, low: int = 1, high: int = 5) -> Column:
    """A score cut to a whole number within bounds; what isn't a number, or is missing, is the lowest."""
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(raw.try_cast("double").cast("int"), F.lit(low))))


#: Fixed wording of what a scorer is asked.
PROMPT = "Score the text on each dimension from 1 to 5.\nDimensions: {dimensions}\nAnswer with one JSON object of numbers.\n\nText:\n{text}"


def prompt(text: Column, dimensions: Mapping[str, float], most_chars: int = 4000, template: str = PROMPT) -> Column:
    """What a scorer is asked about a text: the template with the dimensions by name and the text's first characters."""
    named = F.replace(F.lit(template), F.lit("{dimensions}"), F.lit(", ".join(dimensions)))
    return F.replace(named, F.lit("{text}"), F.substring(F.coalesce(text, F.lit("")), 1, most_chars))


def scored_by(docs: DataFrame, scorer: Callable[[pd.Series], pd.Series], dimensions: Mapping[str, float], text: str = "text") -> DataFrame:
    """docs with scores and composite_score from any scorer of a batch of prompts that answers with JSON; a reply without any counts as the lowest."""
    reply = F.pandas_udf(scorer, "string")(prompt(F.col(text), dimensions))
    given = docs.withColumn("_reply", salvaged_json(reply))
    cells = [x for d in dimensions for x in (F.lit(d), clamped(F.get_json_object("_reply", f"$.{d}")).cast("double"))]
    scored = given.withColumn("scores", F.create_map(*cells)).drop("_reply")
    return scored.withColumn("composite_score", composite(F.col("scores"), dimensions))


def with_scores(docs: DataFrame, scores: DataFrame, key: str = "doc_id", order: str | None = None) -> DataFrame:
    """docs that have a score, with it; of several scores of a key the greatest in order, by default the last in the order that they were read."""
    if order is None:
        order, scores = "_read", scores.withColumn("_read", F.monotonically_increasing_id())
        return docs.join(latest(scores, key, order).drop(order), key)
    return docs.join(latest(scores, key, order), key)


def cached(docs: DataFrame, cache: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(hits with the cached score, misses): by SHA-256 of the text; every document keeps its own id."""
    hashed = docs.withColumn("content_hash", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    return hashed.join(cache, "content_hash"), hashed.join(cache.select("content_hash"), "content_hash", "left_anti")


def passed(scored: DataFrame, least: float = 3.5) -> DataFrame:
    return scored.where(F.col("composite_score") >= least)


def statistics(scored: DataFrame, least: float = 3.5) -> DataFrame:
    """One row: scored, passed, failed, errors (composites of 0), mean."""
    ok = F.col("composite_score") >= least
    return scored.agg(F.count(F.lit(1)).alias("scored"), F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed"), F.count_if(F.col("composite_score") == 0).alias("errors"), rounded(F.avg("composite_score"), 4).alias("mean_score"))


def agreement(pairs: DataFrame, human: str, judge: str, least: float = 3.5) -> DataFrame:
    """One row: Cohen's kappa of both passing `least`, raw agreement and the number of pairs, four digits."""
    h, j = (F.col(human) >= least).cast("int"), (F.col(judge) >= least).cast("int")
    sums = pairs.agg(F.avg((h == j).cast("int")).alias("po"), F.avg(h).alias("ph"), F.avg(j).alias("pj"), F.count(F.lit(1)).alias("n_samples"))
    pe = F.col("ph") * F.col("pj") + (1 - F.col("ph")) * (1 - F.col("pj"))
    kappa = F.when(F.col("n_samples") == 0, 0.0).when(pe >= 1, 0.0).otherwise((F.col("po") - pe) / (1 - pe))
    return sums.select(rounded(kappa, 4).alias("kappa"), rounded(F.coalesce("po", F.lit(0.0)), 4).alias("agreement"), "n_samples")


def dimension_agreement(pairs: DataFrame, human: Column, judge: Column) -> DataFrame:
    """One row: Pearson's r (null where a side is constant) and mean absolute error, four digits."""
    both = pairs.select(human.cast("double").alias("h"), judge.cast("double").alias("j"))
    sums = both.agg(F.avg("h").alias("mh"), F.avg("j").alias("mj"), F.avg(F.col("h") * F.col("j")).alias("hj"), F.stddev_pop("h").alias("sh"), F.stddev_pop("j").alias("sj"), F.avg(F.abs(F.col("h") - F.col("j"))).alias("mae"))
    r = F.when((F.col("sh") > 0) & (F.col("sj") > 0), (F.col("hj") - F.col("mh") * F.col("mj")) / (F.col("sh") * F.col("sj")))
    return sums.select(rounded(r, 4).alias("pearson"), rounded("mae", 4).alias("mae"))

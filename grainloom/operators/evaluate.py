"""Evaluation: accuracy, overlap with references, judge ensembles, significance, leaderboards, preference pairs."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.functions.text import words


def accuracy(rows: DataFrame, by: list[str], correct: str = "is_correct") -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(correct)).alias("correct")).withColumn("accuracy", F.col("correct") / F.col("total"))


def argmax_choice(scores: Column) -> Column:
    """The first of the greatest, from 0."""
    return F.array_position(scores, F.array_max(scores)) - 1


def mcnemar(pairs: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """(by, b, c, chi2, p_value): discordant pairs of two booleans, with continuity correction; without any, p is 1."""
    sums = pairs.groupBy(*by).agg(F.count_if(F.col(a) & ~F.col(b)).alias("b"), F.count_if(~F.col(a) & F.col(b)).alias("c"))
    n = F.col("b") + F.col("c")
    chi2 = F.when(n > 0, F.pow(F.abs(F.col("b") - F.col("c")) - 1, F.lit(2)) / n).otherwise(F.lit(0.0))
    return sums.withColumn("chi2", chi2).withColumn("p_value", F.when(n > 0, chi2_tail(F.col("chi2"))).otherwise(F.lit(1.0)))


def chi2_tail(x: Column) -> Column:
    """1 - CDF of chi square with one degree of freedom."""

    def tail(v: pd.Series) -> pd.Series:
        return v.map(lambda y: math.erfc(math.sqrt(y / 2)))

    return F.pandas_udf(tail, "double")(x)


def bootstrap(pairs: DataFrame, by: list[str], a: str, b: str, resamples: int = 10_000, seed: int = 42) -> DataFrame:
    """(by, n, p_value): the share of resampled mean differences a - b that aren't positive; one-sided, 1 for equal scores.

    A resample's mean depends only on how often each difference is drawn, and these numbers are multinomial. So rows are
    counted by difference before they meet, and a task gets one row for each distinct difference: three for 0/1 scores.
    """
    kinds = dict(pairs.dtypes)
    counts = pairs.groupBy(*by, (F.col(a).cast("double") - F.col(b).cast("double")).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))

    def group(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_d")
        n = int(frame["_n"].sum())
        drawn = np.random.RandomState(seed).multinomial(n, frame["_n"] / n, size=resamples)
        return frame[by].head(1).assign(n=n, p_value=float((drawn @ frame["_d"].to_numpy() <= 1e-12).mean()))

    return counts.groupBy(*by).applyInPandas(group, ", ".join([*(f"{k} {kinds[k]}" for k in by), "n long, p_value double"]))


def paired_bootstrap(scores_a: list[float], scores_b: list[float], resamples: int = 10_000, seed: int = 42) -> float:
    """The same test on two short lists, with indices drawn one resample after the other."""
    diff = np.asarray(scores_a, float) - np.asarray(scores_b, float)
    rng = np.random.RandomState(seed)
    return float(np.mean([diff[rng.randint(0, len(diff), size=len(diff))].mean() <= 0 for _ in range(resamples)]))


def lcs(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence: a bit for each word of b, a whole row of the table in one sum of integers."""
    places: dict[str, int] = {}
    for j, y in enumerate(b):
        places[y] = places.get(y, 0) | 1 << j
    all_ones = (1 << len(b)) - 1
    row = all_ones  # a 0 where the row's count goes up
    for x in a:
        met = row & places.get(x, 0)
        row = ((row + met) | (row - met)) & all_ones
    return len(b) - row.bit_count()


def overlap_f1(prediction: str | None, reference: str | None) -> float:
    x, y = (re.findall(r"[a-z0-9]+", (t or "").lower()) for t in (prediction, reference))
    n = lcs(x, y)
    return 2 * n / (len(x) + len(y)) if n else 0.0


def rouge_l(prediction: Column, reference: Column) -> Column:
    """F1 of the longest common subsequence of lower-case words of letters and digits."""

    def scores(p: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([overlap_f1(x, y) for x, y in zip(p, r, strict=True)], dtype=float)

    return F.pandas_udf(scores, "double")(prediction, reference)


def ensemble(judgements: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(item_id, composite): each criterion's mean over the judges that gave it, weighted; weights aren't normalised."""
    means = judgements.groupBy("item_id", "criterion").agg(F.avg("score").alias("mean"))
    weight = F.lit(0.0)
    for k, w in weights.items():
        weight = F.when(F.col("criterion") == k, F.lit(float(w))).otherwise(weight)
    return means.groupBy("item_id").agg(F.sum(F.col("mean") * weight).alias("composite"))


def leaderboard(results: DataFrame) -> DataFrame:
    """(benchmark, model, score): of results (benchmark, model, rank, score) the best; the lower rank wins a tie, no score loses."""
    best = F.max_by(F.struct("model", "score"), F.struct(F.coalesce("score", F.lit(float("-inf"))), -F.col("rank")))
    top = results.where("score IS NOT NULL").groupBy("benchmark").agg(best.alias("_b"))
    return results.select("benchmark").distinct().join(top, "benchmark", "left").select("benchmark", "_b.model", "_b.score")


def model_pairs(results: DataFrame) -> DataFrame:
    """Pairs of models (rank below rank) on a benchmark, with the difference of their scores."""
    a = results.select("benchmark", F.col("model").alias("model_a"), F.col("rank").alias("_ra"), F.col("score").alias("score_a"))
    b = results.select("benchmark", F.col("model").alias("model_b"), F.col("rank").alias("_rb"), F.col("score").alias("score_b"))
    return a.join(b, "benchmark").where("_ra < _rb").select("benchmark", "model_a", "model_b", "score_a", "score_b", (F.col("score_a") - F.col("score_b")).alias("difference"))


def significance(answers: DataFrame, metric: str = "accuracy", resamples: int = 10_000, seed: int = 42, level: float = 0.05) -> DataFrame:
    """Pairs of models (rank below rank) on a benchmark, compared by their answers (benchmark, model, rank, item, is_correct).

    (benchmark, metric, model_a, model_b, value_a, value_b, delta, p_value, significant): means of is_correct, and the
    paired bootstrap over the items; 1 where the models answered different numbers of items, or none in common.
    """
    mine, yours = (answers.select("benchmark", "item", F.col("model").alias(f"model_{x}"), F.col("rank").alias(f"_r{x}"), F.col("is_correct").cast("double").alias(f"_{x}")) for x in "ab")
    pairs = mine.join(yours, ["benchmark", "item"]).where("_ra < _rb")
    tested = bootstrap(pairs, ["benchmark", "model_a", "model_b"], "_a", "_b", resamples, seed)
    means = answers.groupBy("benchmark", "model", "rank").agg(F.avg(F.col("is_correct").cast("double")).alias("score"), F.count(F.lit(1)).alias("n"))
    whole = model_pairs(means).join(tested.withColumnRenamed("n", "_both"), ["benchmark", "model_a", "model_b"], "left")
    for x in "ab":
        whole = whole.join(means.select("benchmark", F.col("model").alias(f"model_{x}"), F.col("n").alias(f"_n{x}")), ["benchmark", f"model_{x}"])
    p = F.when((F.col("_na") == F.col("_nb")) & (F.col("_both") == F.col("_na")), F.col("p_value")).otherwise(F.lit(1.0))
    return whole.select("benchmark", F.lit(metric).alias("metric"), "model_a", "model_b", F.col("score_a").alias("value_a"), F.col("score_b").alias("value_b"), F.col("difference").alias("delta"), p.alias("p_value"), (p < level).alias("significant"))


def zipped(examples: DataFrame, predictions: DataFrame, at: str = "pos") -> DataFrame:
    """Examples beside predictions of the same position, as far as both go."""
    return examples.join(predictions, at)


def preference_pairs(responses: DataFrame) -> DataFrame:
    """(prompt_id, chosen, rejected) of responses (prompt_id, i, text): the first of the most words and the last of the fewest."""
    n = F.size(words(F.coalesce("text", F.lit(""))))
    own = responses.withColumn("_n", n)
    return own.groupBy("prompt_id").agg(F.max_by("text", F.struct("_n", -F.col("i"))).alias("chosen"), F.min_by("text", F.struct("_n", -F.col("i"))).alias("rejected"), F.count(F.lit(1)).alias("n_responses"))


def aliased(fields: Column, names: tuple[str, ...]) -> Column:
    """The first of names that a map has as a key, even with a null value; "" if none is there."""
    out = F.lit("")
    for n in reversed(names):
        out = F.when(F.map_contains_key(fields, F.lit(n)), fields[n]).otherwise(out)
    return out


def preferences(rows: DataFrame, fields: str = "fields") -> DataFrame:
    """prompt, chosen and rejected of maps under their aliases; rows that lack one of them go."""
    f = F.col(fields)
    out = rows.select("*", aliased(f, ("prompt", "question", "instruction")).alias("prompt"), aliased(f, ("chosen", "chosen_response", "preferred")).alias("chosen"), aliased(f, ("rejected", "rejected_response", "dispreferred")).alias("rejected"))
    return out.where(" AND ".join(f"coalesce({c}, '') != ''" for c in ("prompt", "chosen", "rejected")))

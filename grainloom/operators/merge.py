"""Merging of named weight arrays: task vectors, linear, TIES, DARE and spherical interpolation.

States are rows (param, values array<double>); task vectors have a model (0, 1, ...) beside. The models of a parameter meet
as arrays, so one shuffle by parameter serves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.functions.text import let


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def task_vector(base: DataFrame, tuned: DataFrame) -> DataFrame:
    """(param, values): tuned less base, for parameters that both have in one shape."""
    both = base.select("param", F.col("values").alias("_b")).join(tuned.select("param", F.col("values").alias("_t")), "param")
    return both.where(F.size("_b") == F.size("_t")).select("param", F.zip_with("_t", "_b", lambda t, b: t - b).alias("values"))


def linear(base: DataFrame, vectors: DataFrame, weights: list[float]) -> DataFrame:
    """base + sum of weight x delta."""
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), F.col("model") + 1)
    # the models of a parameter, a few arrays, are added in place, in the order of the models
    parts = F.array_sort(F.collect_list(F.struct("model", F.transform("values", lambda x: x * w).alias("v"))))
    sums = vectors.groupBy("param").agg(parts.alias("_p"))
    added = F.aggregate(F.slice("_p", 2, 1 << 30), F.col("_p")[0]["v"], lambda s, p: F.zip_with(s, p["v"], lambda x, y: x + y))
    both = base.join(sums.select("param", added.alias("_d")), "param", "left")
    return both.select("param", F.when(F.col("_d").isNull(), F.col("values")).otherwise(F.zip_with("values", "_d", lambda x, y: x + y)).alias("values"))


def ties(base: DataFrame, vectors: DataFrame, weights: list[float], density: float = 0.5, normalize: bool = True) -> DataFrame:
    """Trim each weighted delta to its greatest values, elect a sign by count, average what agrees, restore the mean norm.

    Kept are values at least as great as the max(1, n(1 - density))-th smallest. Where signs balance, the sign of the model
    with the greatest trimmed total decides; agreeing entries of a count of 0 give 0. A model without the parameter counts
    as zeros in the mean norm.
    """
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), F.col("model") + 1)
    # a tensor is one array already: it is trimmed and summed where it stands, and no element is shuffled by itself
    scaled = vectors.select("param", "model", F.transform("values", lambda x: x * w).alias("v")).where(F.size("v") > 0)
    k = F.greatest(F.lit(1), F.floor(F.size("v") * (1 - density)).cast("int"))
    floor = F.element_at(F.array_sort(F.transform("v", lambda x: F.abs(x))), k)
    trimmed = scaled.select("param", "model", "v", let(floor, lambda f: F.transform("v", lambda x: F.when(F.abs(x) >= f, x).otherwise(0.0))).alias("t"))
    total = lambda a, of: F.aggregate(a, F.lit(0.0), lambda s, x: s + of(x))
    parts = trimmed.select("param", F.struct("model", "t", total("t", F.abs).alias("mass"), F.sqrt(total("v", lambda x: x * x)).alias("norm")).alias("_m"))
    models = parts.groupBy("param").agg(F.array_sort(F.collect_list("_m")).alias("_m"), F.max_by("_m.t", F.struct("_m.mass", -F.col("_m.model"))).alias("_top"), F.sum("_m.norm").alias("_norms"))
    of_top = lambda i: F.signum(F.element_at("_top", i + 1))

    def merged_at(i: Column) -> Column:
        own = F.transform("_m", lambda m: F.element_at(m["t"], i + 1))
        votes = lambda o: total(o, F.signum)
        sign = lambda o: let(votes(o), lambda n: F.when(n != 0, F.signum(n)).otherwise(of_top(i)))
        mean = lambda same: F.when(F.size(same) > 0, total(same, lambda x: x) / F.size(same)).otherwise(0.0)
        return let(own, lambda o: let(sign(o), lambda s: let(F.filter(o, lambda x: (F.signum(x) == s) & (x != 0)), mean)))

    deltas = models.select("param", F.transform(F.sequence(F.lit(0), F.size("_top") - 1), merged_at).alias("_d"), (F.col("_norms") / F.lit(float(len(weights)))).alias("_mean"))
    if normalize:
        norm = F.sqrt(total("_d", lambda x: x * x))
        deltas = deltas.select("param", let(norm, lambda n: F.when(n > 0, F.transform("_d", lambda x: x * F.col("_mean") / n)).otherwise(F.col("_d"))).alias("_d"))
    both = base.join(deltas.select("param", "_d"), "param", "left")
    return both.select("param", F.when(F.col("_d").isNull(), F.col("values")).otherwise(F.zip_with("values", "_d", lambda x, y: x + y)).alias("values"))


def dare(vectors: DataFrame, density: float = 0.5, rescale: bool = True, seed: int = 42) -> DataFrame:
    """Task vectors of which each element stays with the chance `density`, drawn by a hash of its place and model."""

    def drawn(v: Column) -> Column:
        keep = lambda x, i: F.pmod(F.xxhash64(F.lit(seed), F.col("model"), F.col("param"), i), F.lit(1 << 20)) < int(density * (1 << 20))
        return F.transform(v, lambda x, i: F.when(keep(x, i), x / density if rescale else x).otherwise(0.0))

    return vectors.withColumn("values", drawn(F.col("values")))


def slerp(a: DataFrame, b: DataFrame, t: float) -> DataFrame:
    """Between two states along the arc, with the norm interpolated; nearly parallel, single or differently shaped ones as noted.

    Nearly parallel arrays and single numbers are interpolated linearly; where shapes differ, or b lacks the parameter, a stays.
    """
    both = a.select("param", F.col("values").alias("_a")).join(b.select("param", F.col("values").alias("_b")), "param", "left")
    # each sum over the arrays stands once: what follows from it is let-bound, not written out in every use
    sums = F.struct(F.sqrt(_dot(F.col("_a"), F.col("_a"))).alias("na"), F.sqrt(_dot(F.col("_b"), F.col("_b"))).alias("nb"), _dot(F.col("_a"), F.col("_b")).alias("ab"))

    def angled(s: Column) -> Column:
        cos = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s["ab"] / (F.greatest(s["na"], F.lit(1e-8)) * F.greatest(s["nb"], F.lit(1e-8)))))
        return let(F.struct(s["na"].alias("na"), s["nb"].alias("nb"), cos.alias("cos")), factors)

    def factors(s: Column) -> Column:
        """What a and b are multiplied by."""
        flat = (F.size("_a") <= 1) | (F.abs(s["cos"]) > 0.9995) | (s["na"] == 0) | (s["nb"] == 0)
        norm, angle = s["na"] * (1 - t) + s["nb"] * t, F.acos(s["cos"])
        arc = lambda share, own: F.when(flat, F.lit(share)).otherwise(F.try_divide(F.sin(share * angle) * norm, F.sin(angle) * own))
        return let(F.struct(arc(1.0 - t, s["na"]).alias("a"), arc(float(t), s["nb"]).alias("b")), lambda u: F.zip_with("_a", "_b", lambda x, y: x * u["a"] + y * u["b"]))

    merged = let(sums, angled)
    return both.select("param", F.when(F.col("_b").isNull() | (F.size("_a") != F.size("_b")), F.col("_a")).otherwise(merged).alias("values"))


#: Methods that take a base and task vectors; slerp takes two states.
METHODS = {"linear": linear, "task_arithmetic": linear, "ties": ties}


def dare_ties(base: DataFrame, vectors: DataFrame, weights: list[float], density: float = 0.5, seed: int = 42) -> DataFrame:
    return ties(base, dare(vectors, density, True, seed), weights, density=1.0)


def dare_linear(base: DataFrame, vectors: DataFrame, weights: list[float], density: float = 0.5, seed: int = 42) -> DataFrame:
    return linear(base, dare(vectors, density, True, seed), weights)


METHODS |= {"dare_ties": dare_ties, "dare_linear": dare_linear}


def parameter_counts(state: DataFrame) -> DataFrame:
    return state.agg(F.count(F.lit(1)).alias("arrays"), F.sum(F.size("values")).alias("parameters"))


def similarity(a: Column, b: Column) -> Column:
    """The cosine of two arrays; null if one has no length."""
    norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when(norms > 0, _dot(a, b) / norms)

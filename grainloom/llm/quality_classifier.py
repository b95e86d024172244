"""Positive-unlabelled quality classifier: non-negative unbiased risk over trusted positives and all web text.

A linear model of text features f gives s = w . f. With the logistic loss, the unbiased risk of a class prior p is
p * mean(loss(s), positives) + [mean(loss(-s), unlabelled) - p * mean(loss(-s), positives)]; the bracket estimates the
negatives' risk and can't truly be below 0, so where it falls below, it counts as 0 and nothing is gained by overfitting.
Newton's steps of both sides of that place and along it, each in several lengths, are tried; the one of least risk is taken.

The unlabelled part runs over every text in each step, as sums that tasks form and an aggregate adds up; the trusted
positives are a bounded sample. The prior is estimated from scores of a first fit of positives against unlabelled text:
the least ratio, over thresholds, of the unlabelled share above it to the positives' share above it. There a positive
scores as if it had been left out of that fit, or few positives would look better than those that nobody has marked.

The fit ranks well, but its loss weighs the prior's error, so its constant is set anew: 0.5 is to lie where the same risk
under the 0-1 loss is least. Few documents score between good and bad, so a run of cuts is as good as the least; a quarter
of that run from its lower end is taken, for a good document lost counts more than a bad one kept.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainloom.llm.common import quiet_threads, settled, short_batches
from grainloom.llm.textbytes import SOLID, slices, word_hashes, words

#: Trusted positives that a fit uses at most: those of the least hash.
POSITIVES = 20_000
#: Newton's steps of each fit at most; lengths of a step that are tried at once; ridge penalty on weights of standardised
#: features; cells of a score histogram.
STEPS, TRIED, RIDGE, CELLS = 25, 8, 1e-3, 512
#: Logits beyond this count as this in the histogram for the cut; the cut's place in the run of cuts of least risk.
REACH, PLACE = 16, 0.25

FEATURES = (
    "log_words", "mean_word", "upper", "digit", "sentence_marks", "shouts", "symbols", "bars", "other_marks", "space",
    "same_as_before", "distinct", "line_words", "same_lines", "long_words", "short_words",
)


def _class(letters: str | range) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(x) if isinstance(x, str) else x for x in letters]] = True
    return out


_UPPER, _DIGIT, _LETTER = _class(range(0x41, 0x5B)), _class(range(0x30, 0x3A)), _class([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xF5)])
_MARKS = {"sentence_marks": _class(".,;:?"), "shouts": _class("!"), "symbols": _class("#$%&*<>=+~^@_\\"), "bars": _class("|"), "other_marks": _class("\"'()-/[]{}`"), "space": _class(" \t\r\n")}


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, last, rows of FEATURES) of slices of a string column, from whole texts; all are bounded, and 0 for an empty text."""
    for s in slices(column):
        n = s.last - s.first
        starts, ends, per = words(s, SOLID)
        n_words = np.diff(per)
        size = np.diff(s.bounds)
        some, chars = np.maximum(n_words, 1), np.maximum(size, 1)
        of = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[s.bounds])  # noqa: B023, E731
        by_word = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[per])  # noqa: B023, E731
        length = ends - starts
        h = word_hashes(s.data, starts, ends)
        owner = np.repeat(np.arange(n), n_words)
        again = np.zeros(len(h), bool)
        if len(h):
            again[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
        order = np.lexsort((h, owner))
        first = np.ones(len(h), bool)
        first[1:] = (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        # lines: cut at \n; a line's hash adds its words' by place
        line = np.cumsum(s.data == 0x0A) if len(s.data) else np.zeros(0, np.int64)
        mine = line[starts] + owner if len(starts) else np.zeros(0, np.int64)  # a text starts a line too
        line_at = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1]))) if len(mine) else np.zeros(0, np.int64)
        line_hash = np.add.reduceat(h * (2 * (np.arange(len(h)) - np.repeat(line_at, np.diff([*line_at, len(h)]))).astype(np.uint64) + np.uint64(1)), line_at) if len(line_at) else h
        line_owner = owner[line_at]
        n_lines = np.bincount(line_owner, minlength=n)
        l_order = np.lexsort((line_hash, line_owner))
        l_first = np.ones(len(line_at), bool)
        l_first[1:] = (line_hash[l_order][1:] != line_hash[l_order][:-1]) | (line_owner[l_order][1:] != line_owner[l_order][:-1])
        letters = np.maximum(of(_LETTER[s.data]), 1)
        distinct = np.bincount(owner[order][first], minlength=n)
        out = np.zeros((n, len(FEATURES)))
        values = {
            "log_words": np.log1p(n_words) / 10, "mean_word": np.minimum(by_word_sum(length, per) / some, 40) / 10, "upper": of(_UPPER[s.data]) / letters, "digit": of(_DIGIT[s.data]) / chars,
            **{k: np.minimum(of(v[s.data]) / some, 3) for k, v in _MARKS.items()},
            "same_as_before": by_word(again) / some, "distinct": distinct / some, "line_words": np.log1p(n_words / np.maximum(n_lines, 1)) / 10,
            "same_lines": 1 - np.bincount(line_owner[l_order][l_first], minlength=n) / np.maximum(n_lines, 1), "long_words": by_word(length > 15) / some, "short_words": by_word(length < 3) / some,
        }
        for k, name in enumerate(FEATURES):
            out[:, k] = np.where(n_words > 0, values[name], 0)
        yield s.first, s.last, out


def by_word_sum(length: np.ndarray, per: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(length)))[per])


def with_features(docs: DataFrame) -> DataFrame:
    """(doc_id, f): every row of docs, from its text alone."""
    kind = dict(docs.dtypes)["doc_id"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            for first, last, f in features(batch.column("text")):
                flat = pa.array(f.ravel(), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), pa.ListArray.from_arrays(pa.array(np.arange(last - first + 1, dtype=np.int32) * len(FEATURES)), flat)], ["doc_id", "f"])

    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, f array<double>")


def _expanded(f: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features, bounded, and a constant."""
    return np.hstack((np.clip((f - mean) / scale, -6, 6), np.ones((len(f), 1))))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("f").flatten().to_numpy().reshape(-1, len(FEATURES))


def _sigmoid(s: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(s, -40, 40)))


def _softplus(s: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, s)


def _summed(rows: DataFrame, each) -> np.ndarray:
    """The sum over all rows of each(features), a vector of a fixed length: one row for each of its numbers and task, added by an aggregate."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        total = None
        for batch in batches:
            if len(batch):
                v = each(_matrix(batch))
                total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["i", "v"])

    found = rows.select("f").mapInArrow(parts, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(found))
    for r in found:
        out[r["i"]] = r["v"]
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self, f: np.ndarray) -> np.ndarray:
        return _sigmoid(_expanded(f, self.mean, self.scale) @ self.weights)


def _fit(unlabelled: DataFrame, positives: np.ndarray, mean: np.ndarray, scale: np.ndarray, prior: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Weights, and the curvature of the risk there. With no prior, positives are told from unlabelled text as if that were all negative, each side weighing the same."""
    x = _expanded(positives, mean, scale)
    d = x.shape[1]
    w, best = np.zeros(d), np.inf
    ridge = np.full(d, RIDGE + 1 / len(positives))
    ridge[-1] = 1e-6
    upper = np.triu_indices(d)

    def whole(at: np.ndarray, u_risk: np.ndarray) -> np.ndarray:
        """The risk of each column of weights, given the unlabelled part's."""
        s = x @ at
        plus, minus = _softplus(-s).mean(0), _softplus(s).mean(0)
        parts = plus + u_risk if prior is None else prior * plus + np.maximum(0.0, u_risk - prior * minus)
        return parts + (ridge[:, None] * at * at).sum(0) / 2

    for _ in range(STEPS):
        at = w.copy()

        def each(f: np.ndarray, at: np.ndarray = at) -> np.ndarray:
            z = _expanded(f, mean, scale)
            s = z @ at
            q = _sigmoid(s)
            h = (z * (q * (1 - q))[:, None]).T @ z
            return np.concatenate(([len(f), _softplus(s).sum()], z.T @ q, h[upper]))

        sums = _summed(unlabelled, each)
        n = sums[0]
        u_risk, u_grad = sums[1] / n, sums[2 : 2 + d] / n
        u_hess = np.zeros((d, d))
        u_hess[upper] = sums[2 + d :] / n
        u_hess = u_hess + np.triu(u_hess, 1).T
        s = x @ w
        q = _sigmoid(s)
        plus_grad, minus_grad = -((1 - q)[:, None] * x).mean(0), (q[:, None] * x).mean(0)
        p_hess = (x * (q * (1 - q))[:, None]).T @ x / len(x)
        # the two sides of the place where the bracket is 0: with it, and with the positives' part alone
        sides = [(plus_grad + u_grad, p_hess + u_hess)] if prior is None else [(prior * (plus_grad - minus_grad) + u_grad, u_hess), (prior * plus_grad, prior * p_hess)]
        bends = [hess + np.diag(ridge + 1e-9) for _, hess in sides]
        best = min(best, whole(w[:, None], np.array([u_risk]))[0])
        ways = [np.linalg.solve(bend, grad + ridge * w) for bend, (grad, _) in zip(bends, sides, strict=True)]
        if prior is not None:
            # and along that place: the positives' part falls while the bracket, to first order, goes to 0
            a, c = u_grad - prior * minus_grad, u_risk - prior * _softplus(s).mean()
            bend = sum(bends) / 2
            free, held = np.linalg.solve(bend, sides[1][0] + ridge * w), np.linalg.solve(bend, a)
            ways.append(free - held * ((a @ free - c) / max(1e-12, a @ held)))
        ways = [way * min(1.0, 4.0 / max(1e-12, np.abs(way).max())) for way in ways]
        # all lengths of step are tried in one pass
        tried = np.stack([w - way * 0.5**k for way in ways for k in range(TRIED)], axis=1)
        risks = whole(tried, _summed(unlabelled, lambda f, tried=tried: _softplus(_expanded(f, mean, scale) @ tried).sum(0)) / n)
        if risks.min() >= best - 1e-6:
            return w, bends[0]
        w, best = tried[:, risks.argmin()], risks.min()
    warnings.warn(f"the fit had not come to rest after {STEPS} steps", stacklevel=2)
    return w, bends[0]


def left_out_logits(x: np.ndarray, weights: np.ndarray, bend: np.ndarray) -> np.ndarray:
    """Logits of the positives x, each by the weights that a fit without it comes to: one Newton's step back from the whole fit's."""
    s = x @ weights
    q = _sigmoid(s)
    reach = np.einsum("ij,ij->i", x, np.linalg.solve(bend, x.T).T) / len(x)
    return s - reach * (1 - q) / np.maximum(1e-3, 1 - reach * q * (1 - q))


def left_out(x: np.ndarray, weights: np.ndarray, bend: np.ndarray) -> np.ndarray:
    """Scores of left_out_logits()."""
    return _sigmoid(left_out_logits(x, weights, bend))


def _above(cells: np.ndarray) -> np.ndarray:
    return np.cumsum(cells[::-1])[::-1]


def estimate_prior(above_unlabelled: np.ndarray, above_positive: np.ndarray, n_unlabelled: float, n_positive: float) -> float:
    """The least upper estimate of the positives' share, over thresholds; arrays hold how many of each score above them.

    A threshold's ratio gets a standard error of both shares added, so one with few positives above it can't win by chance.
    """
    u, p = above_unlabelled / n_unlabelled, above_positive / n_positive
    sure = p > 0.05
    error = (np.sqrt(u * (1 - u) / n_unlabelled) + np.sqrt(p * (1 - p) / n_positive))
    ratio = ((u + error)[sure] / p[sure]) if sure.any() else np.ones(1)
    return float(np.clip(ratio.min(), 0.01, 0.99))


def estimate_cut(of_all: np.ndarray, of_positive: np.ndarray, prior: float) -> float:
    """The logit from which on a document is good, given histograms of logits from -REACH to REACH of all rows and of positives left out.

    A cut's risk is prior * (positives below it) + [all above it - prior * (positives above it)], the bracket 0 at least. Cuts
    next to the least one count as good as that within its standard error, down to 0 and up to where a twentieth of the
    positives would go.
    """
    n, k = of_all.sum(), of_positive.sum()
    u, p = _above(of_all) / n, _above(of_positive) / k
    risk = prior * (1 - p) + np.maximum(0.0, u - prior * p)
    least = first = last = int(risk.argmin())
    error = np.sqrt(u * (1 - u) / n)[least] + 2 * prior * np.sqrt(max(p[least] * (1 - p[least]), 1 / k) / k)
    near = (risk <= risk[least] + error) & (p >= min(0.95, p[least]))
    while first > 0 and near[first - 1]:
        first -= 1
    while last + 1 < len(near) and near[last + 1]:
        last += 1
    at = np.linspace(-REACH, REACH, len(near), endpoint=False)
    low = max(at[first], min(0.0, at[least]))
    return float(low + (at[last] - low) * PLACE)


def train(rows: DataFrame, positives: np.ndarray) -> Model:
    """rows (f) of all text, with cut lineage; positives: FEATURES of trusted positives, at least one."""
    d = len(FEATURES)
    sums = _summed(rows, lambda f: np.concatenate(([len(f)], f.sum(0), (f * f).sum(0))))
    n, mean = sums[0], sums[1 : 1 + d] / sums[0]
    scale = np.sqrt(np.maximum(sums[1 + d :] / n - mean * mean, 0))
    scale[scale < 1e-6] = 1
    weights, bend = _fit(rows, positives, mean, scale, None)
    first = Model(mean, scale, weights, 0.5)

    def histogram(score: np.ndarray) -> np.ndarray:
        return np.bincount(np.minimum((score * CELLS).astype(np.int64), CELLS - 1), minlength=CELLS).astype(np.float64)

    def logits(s: np.ndarray) -> np.ndarray:
        return np.bincount(np.clip(((s + REACH) * (CELLS / 2 / REACH)).astype(np.int64), 0, CELLS - 1), minlength=CELLS).astype(np.float64)

    x = _expanded(positives, mean, scale)
    of_all = _summed(rows, lambda f: histogram(first.score(f)))
    prior = estimate_prior(_above(of_all), _above(histogram(left_out(x, weights, bend))), n, len(positives))
    weights, bend = _fit(rows, positives, mean, scale, prior)
    of_all = _summed(rows, lambda f: logits(_expanded(f, mean, scale) @ weights))
    weights[-1] -= estimate_cut(of_all, logits(left_out_logits(x, weights, bend)), prior)
    return Model(mean, scale, weights, prior)


def _scored(rows: DataFrame, model: Model | None, kind: str) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        for batch in batches:
            value = model.score(_matrix(batch)) if model else np.full(len(batch), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(value)], ["doc_id", "score"])

    return rows.mapInArrow(score, f"doc_id {kind}, score double")


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(rows: DataFrame, most: int) -> np.ndarray:
    """FEATURES of `most` documents of rows (doc_id, f) at most: those of the least hash of their id, one row of each id.

    The hash is compared with a bound that lets a few more than `most` pass before any row is sorted, so tasks send the
    driver no more than that between them, however many documents there are.
    """
    each = settled(rows.groupBy("doc_id").agg(F.min("f").alias("f")))
    n, spare = each.count(), 1 + 8 * most**-0.5
    key = F.xxhash64("doc_id")
    while True:
        share = min(1.0, spare * most / max(1, n))
        passed = each.where(key <= int(-(2**63) + share * (2**64 - 1))) if share < 1 else each
        found = passed.orderBy(key, "doc_id").limit(most).select("f").collect()
        if share == 1 or len(found) == most:
            return np.array([r["f"] for r in found]).reshape(-1, len(FEATURES))
        spare *= 2


def fit(docs: DataFrame, labels: DataFrame, most: int = POSITIVES) -> tuple[Model | None, DataFrame]:
    """The model and (doc_id, f) of all rows of docs. None if docs has no trusted positive.

    Trusted positives: rows whose doc_id labels marks quality 1 and that aren't held out, at most `most` of them by the
    least hash. No other label is read; the unlabelled side is every row.
    """
    with short_batches(docs.sparkSession):
        rows = settled(with_features(docs))
    trusted = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id").distinct()
    chosen = sample(rows.join(trusted, "doc_id", "left_semi"), most)
    return (train(rows, chosen) if len(chosen) else None), rows


def classify(docs: DataFrame, labels: DataFrame, most: int = POSITIVES) -> DataFrame:
    """Scores every row of docs (doc_id, text; other columns are ignored) by a model fit as fit() says.

    Returns doc_id, held_out, score (0 to 1; higher: quality is likelier), predicted (1 if score >= 0.5, else 0). Null and
    empty texts are scored as texts without words; without any trusted positive all scores are 0.5. Repeated rows score
    alike, null ids are never held out, an empty table gives no rows.
    """
    model, rows = fit(docs, labels, most)
    scored = _scored(rows, model, dict(docs.dtypes)["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, most: int = POSITIVES, least: float = 0.5) -> DataFrame:
    """The rows of docs that score at least `least`, with all their columns, whatever their names; texts are scored where they are, no row is moved.

    Null and empty texts score as texts without words; equal texts score alike, and a score of exactly `least` stays. Null
    ids and repeated rows are rows like all others. Without any trusted positive all rows stay; an empty table gives no rows.
    """
    model, _ = fit(docs, labels, most)
    if model is None:
        return docs

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        quiet_threads()
        parts = [model.score(f) for _, _, f in features(pa.array(text, pa.string(), from_pandas=True))]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.where(score("text") >= least)

"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Each source has a target of words. Among all document rates between 0 and `most` whose expected words meet it, the ones
nearest in relative entropy to taking every document once are min(most, exp(t * size)), one tilt t for each source: the
dual of the problem, solved by Newton's steps inside a bracket. Rates depend on source and size alone, so the steps
run over the counts of documents by (source, size).

The rates are rounded to copies by a hash of each document's id and text: those whose hash, less the fraction of their
rate, lies below the source's cut are rounded up. Rows that are alike in id, source and text share one hash and, at the
cut, are told apart by count: so many of them are rounded up as fit. What a source then still lacks, or has too much, is
settled by flipping single documents, or swapping one for another, of the sizes that fit it best.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainloom.llm.common import gapless_rank, settled, stored

WORDS = r"[^ \t-\r]+"
#: Sources of up to this number are broadcast; more are joined by a shuffle.
FEW_SOURCES = 20_000
#: Cells of the rounding cut: FINE x FINE.
FINE = 4096
#: Newton's steps at most; rounds of flips after the rounding, each of one document or two in every source.
STEPS, FLIPS = 60, 4


def _few(rows: DataFrame) -> DataFrame:
    """settled(), for tables of a few rows a source: in a few files and tasks, not in one for each partition of a shuffle."""
    return settled(rows.coalesce(8))


def _with_source(rows: DataFrame, sources: DataFrame, n: int) -> DataFrame:
    """Joins on the null-safe key `_s`; the side of sources is broadcast if counted as few."""
    return rows.join(F.broadcast(sources) if n <= FEW_SOURCES else sources, "_s")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(…, target) for (_s, source, source_size): share of all sizes by weight, none above `most` times its size.

    Weights repeat over the sources by code point, null last. What a capped source leaves is dealt to the others by
    weight. The level is found in closed form: sources by size over weight, the capped ones come first.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    every = Window.partitionBy()
    ranked = sources.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("_cap", most * F.col("source_size").cast("double")).withColumn("_all", share * F.sum(F.col("source_size").cast("double")).over(every))
    by_level = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the level if all sources before this one are capped
    level = (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(after)
    ranked = ranked.withColumn("_level", level).withColumn("_place", F.row_number().over(by_level))
    free = F.col("_level") * F.col("_w") <= F.col("_cap")
    # the first source that isn't capped sets the level of all that follow
    ranked = ranked.withColumn("_first", F.min(F.when(free, F.struct("_place", "_level"))).over(every)["_level"])
    return ranked.withColumn("target", F.least("_cap", F.coalesce(F.col("_first") * F.col("_w"), "_cap")))


def _rate(size: Column, tilt: Column, scale: Column, most: float) -> Column:
    return F.least(F.lit(most), F.exp(F.least(F.lit(50.0), F.greatest(F.lit(-700.0), tilt * size / scale))))


def _tilts(counts: DataFrame, sources: DataFrame, n: int, most: float, near: float) -> DataFrame:
    """sources with `_tilt`: Newton's steps for all sources at once, kept between the tilts known to be too low and too high."""
    state = sources.withColumns({"_tilt": F.lit(0.0), "_low": F.lit(-1.0), "_high": F.lit(1.0), "_over": F.lit(False), "_under": F.lit(False), "_done": F.col("target") >= most * F.col("source_size") * (1 - 1e-12)})
    state = _few(state)
    for _ in range(STEPS):
        at = _with_source(counts, state.where(~F.col("_done")), n)
        rate = _rate(F.col("size").cast("double"), F.col("_tilt"), F.col("_scale"), most)
        words = F.col("_n") * F.col("size").cast("double")
        at = at.select("_s", (words * rate).alias("_taken"), F.when(rate < most, words * rate * F.col("size") / F.col("_scale")).otherwise(0.0).alias("_slope"))
        sums = at.groupBy("_s").agg(F.sum("_taken").alias("_taken"), F.sum("_slope").alias("_slope"))
        gap = F.col("_taken") - F.col("target")
        step = state.join(F.broadcast(sums) if n <= FEW_SOURCES else sums, "_s", "left").withColumn("_done", F.col("_done") | F.coalesce(F.abs(gap) <= near * F.col("target"), F.lit(True)))
        step = step.withColumns({
            "_low": F.when(gap < 0, F.col("_tilt")).otherwise(F.col("_low")), "_under": F.col("_under") | (gap < 0),
            "_high": F.when(gap > 0, F.col("_tilt")).otherwise(F.col("_high")), "_over": F.col("_over") | (gap > 0),
        })
        newton = F.col("_tilt") - F.try_divide(gap, F.col("_slope"))
        bounded = F.when(F.col("_under") & F.col("_over"), F.when((newton > F.col("_low")) & (newton < F.col("_high")), newton).otherwise((F.col("_low") + F.col("_high")) / 2))
        # no bracket yet: a step at most twice as far
        far = F.lit(1.0) + 2 * F.abs("_tilt")
        free = F.when(gap < 0, F.col("_tilt") + F.least(far, F.coalesce(F.try_divide(-gap, F.col("_slope")), far))).otherwise(F.col("_tilt") - F.least(far, F.coalesce(F.try_divide(gap, F.col("_slope")), far)))
        step = step.withColumn("_tilt", F.when(F.col("_done"), F.col("_tilt")).otherwise(F.coalesce(bounded, free)))
        state = _few(step.drop("_taken", "_slope"))
        if state.where(~F.col("_done")).isEmpty():
            return state
    # the rounding's cut makes up for what a tilt is off
    warnings.warn(f"tilts of some sources are not exact after {STEPS} steps", stacklevel=2)
    return state


@dataclass(frozen=True)
class Mix:
    """A solved mix.

    sources: parameters of each source by the key `_s`, with the cell `_cut` below which documents are rounded up; n: their
    number. special: (_s, size, _h, _rows, _total, _g), documents that don't follow the cut and the copies of all their
    rows, a few for each source. repeated: rows of those that repeat, by `_g`.
    """

    sources: DataFrame
    special: DataFrame
    repeated: dict[int, int]
    n: int
    most: int

    def apply(self, rows: DataFrame) -> DataFrame:
        """rows (doc_id, size, _s, _h, …) with source_size, target, rate, copies; each row by itself, so no row is moved
        unless sources are many; only repeated rows of a special document are numbered, from a table of their own."""
        out = _rounded(_rated(rows, self.sources, self.n, self.most))
        special = F.broadcast(self.special) if self.n <= FEW_SOURCES else self.special
        out = out.join(special, ["_s", "size", "_h"], "left")
        once = out.withColumn("copies", F.when(F.col("_rows") == 1, F.col("_total")).otherwise(F.col("copies")).cast("int"))
        extra = ["_rows", "_total", "_g"]
        if not self.repeated:
            return once.drop(*extra)
        many = settled(out.where("_rows > 1").withColumn("_tie", F.monotonically_increasing_id()))
        many = gapless_rank(many, "_g", self.repeated, [F.col("_tie")], "_place")
        at, n, total = F.col("_place"), F.col("_rows"), F.col("_total")
        many = many.withColumn("copies", (F.floor((at + 1) * total / n) - F.floor(at * total / n)).cast("int"))
        return once.where("_rows IS NULL OR _rows = 1").drop(*extra).unionByName(many.drop(*extra, "_tie", "_place"))


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, source, size, the null-safe key of a source ("0" for null, "1" and its name else) and a hash of id and text."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    key = F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "source"))
    return docs.select("doc_id", "source", size.alias("size"), key.alias("_s"), F.xxhash64("doc_id", "text").alias("_h"), *more)


def _rated(rows: DataFrame, sources: DataFrame, n: int, most: int) -> DataFrame:
    """rows with their rate, its whole part, whether it may be rounded up, and the cell of the cut that it falls into."""
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("_full"), F.lit(float(most))).otherwise(_rate(F.col("size").cast("double"), F.col("_tilt"), F.col("_scale"), float(most)))
    rated = _with_source(rows, sources, n).withColumn("rate", rate).withColumn("_whole", F.floor("rate").cast("int"))
    # a document is rounded up if its hash in [0, 1), less the rate's fraction, is below the source's cut: near 0
    unit = F.shiftrightunsigned(F.xxhash64("_h", F.lit("copies")), 11).cast("double") / float(1 << 53)
    may = (F.col("size") > 0) & (F.col("_whole") < most) & (F.col("rate") > F.col("_whole"))
    late = unit - (F.col("rate") - F.col("_whole"))
    return rated.withColumns({"_may": may, "_cell": F.floor((late + 1) / 2 * (FINE * FINE)).cast("long")})


def _rounded(rated: DataFrame) -> DataFrame:
    return rated.withColumn("copies", F.col("_whole") + (F.col("_may") & (F.col("_cell") < F.col("_cut"))).cast("int"))


def _solved(rows: DataFrame, weights: tuple[float, ...], share: float, most: int, near: float) -> Mix:
    """rows (doc_id, source, size, _s, _h), of cut lineage, are read a few times."""
    counts = stored(rows.groupBy("_s", "source", "size").agg(F.count(F.lit(1)).alias("_n")))
    sources = counts.groupBy("_s", "source").agg(F.sum(F.col("_n") * F.col("size")).alias("source_size"), F.sum("_n").alias("_docs"))
    sources = sources.withColumn("_scale", F.greatest(F.lit(1.0), F.col("source_size") / F.col("_docs")))
    sources = _few(targets(sources, weights, share, float(most)).select("_s", "source_size", "_scale", "target"))
    n = sources.count()
    tilts = _tilts(counts.where("size > 0").select("_s", "size", "_n"), sources, n, float(most), near)
    tilts = tilts.select("_s", "source_size", "_scale", "target", "_tilt", (F.col("target") >= most * F.col("source_size") * (1 - 1e-12)).alias("_full"))
    cuts = _cuts(_rated(rows, tilts, n, most), n)
    cut = _few(tilts.join(cuts, "_s"))
    special = _few(_special(_rounded(_rated(rows, cut, n, most)), cut.select("_s", "_left"), n, most))
    repeated = {r["_g"]: r["_rows"] for r in special.where("_rows > 1").collect()}  # a few for each source at most
    return Mix(cut.drop("_left"), special, repeated, n, most)


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: int = 2, near: float = 1e-6) -> DataFrame:
    """Copies of every row of docs (doc_id, text, source; other columns are ignored) for the mix.

    Returns doc_id, size (words of the text, null: 0), source, source_size, target (the source's), rate (before rounding),
    copies (0 .. most) and taken (copies times size). Null sources are one source, the last. Rows without words have no
    weight in the mix: rate and copies are 1, taken 0. Rows that repeat id, source and text, and null ids, stay separate
    rows, each with copies of its own. Where a source has no words its target is 0. Texts may be of any length. An empty
    table gives no rows. Equal tables give equal results, whatever their order: only rows alike in id, source and text
    may trade places.
    """
    rows = settled(_keyed(docs))
    final = _solved(rows, weights, share, most, near).apply(rows)
    return final.select("doc_id", "size", "source", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: int = 2, near: float = 1e-6) -> DataFrame:
    """docs with every row as often as mix() takes it; all columns stay, whatever their names.

    Null texts and texts without words stay once, null ids and repeated rows are treated as by mix(), an empty table gives
    no rows.
    """
    solved = _solved(settled(_keyed(docs)), weights, share, most, near)
    whole = solved.apply(_keyed(docs, F.struct(*(docs[c] for c in docs.columns)).alias("_doc")))
    return whole.where("copies > 0").select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_doc.*")


def _cuts(rated: DataFrame, n: int) -> DataFrame:
    """(_s, _cut, _left): the first cell at which rounding up all lower ones and this one reaches the target, and the words missing before it."""
    sure = rated.groupBy("_s").agg((F.first("target") - F.sum(F.col("_whole") * F.col("size"))).alias("_wanted"))
    may = rated.where("_may").select("_s", "size", F.floor(F.col("_cell") / FINE).alias("_step"), "_cell")
    up_to = Window.partitionBy("_s").orderBy("_step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most FINE rows a source
    coarse = stored(may.groupBy("_s", "_step").agg(F.sum("size").alias("_words")).withColumn("_sum", F.sum("_words").over(up_to)))
    coarse = coarse.join(F.broadcast(sure) if n <= FEW_SOURCES else sure, "_s")
    at = coarse.where(F.col("_sum") >= F.col("_wanted")).groupBy("_s").agg(F.min(F.struct("_step", (F.col("_wanted") - F.col("_sum") + F.col("_words")).alias("_left"))).alias("_at"))
    at = _few(at.select("_s", F.col("_at._step").alias("_at"), F.col("_at._left").alias("_want")))
    inside = _with_source(may, at, n).where(F.col("_step") == F.col("_at")).groupBy("_s", "_want", "_cell").agg(F.sum("size").alias("_words"))
    fine_to = Window.partitionBy("_s").orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_sum", F.sum("_words").over(fine_to)).where(F.col("_sum") >= F.col("_want"))
    first = inside.groupBy("_s").agg(F.min(F.struct("_cell", (F.col("_want") - F.col("_sum") + F.col("_words")).alias("_left"))).alias("_c"))
    # no cell reaches the target: all are rounded up
    most = coarse.groupBy("_s").agg(F.max("_sum").alias("_all"))
    every = sure.join(first, "_s", "left").join(most, "_s", "left")
    left = F.coalesce(F.col("_c._left"), F.col("_wanted") - F.coalesce("_all", F.lit(0)))
    return _few(every.select("_s", F.coalesce(F.col("_c._cell"), F.lit(FINE * FINE)).alias("_cut"), left.alias("_left")))


def _special(rounded: DataFrame, left: DataFrame, n: int, most: int) -> DataFrame:
    """(_s, size, _h, _rows, _total, _g): the documents of the cut's cell, and those that are flipped to settle the rest."""
    key = ["_s", "size", "_h"]
    at_cut = F.col("_may") & (F.col("_cell") == F.col("_cut"))
    # of the cell's documents, one after the other, as many rows as come nearest are rounded up
    cell = rounded.where(at_cut).groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"), F.first("_whole").alias("_whole"), F.first("_left").alias("_left"))
    before = Window.partitionBy("_s").orderBy("_h", "size").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("_left") - F.coalesce(F.sum(F.col("_rows") * F.col("size")).over(before), F.lit(0))
    cell = cell.withColumn("_up", F.greatest(F.lit(0), F.least("_rows", F.floor(room / F.col("size") + 0.5))))
    cell = _few(cell.select(*key, "_rows", (F.col("_rows") * F.col("_whole") + F.col("_up")).alias("_total"), (F.col("_up") * F.col("size")).alias("_words")))
    used = cell.groupBy("_s").agg(F.sum("_words").alias("_used"))
    rest = left.join(used, "_s", "left").select("_s", (F.col("_left") - F.coalesce("_used", F.lit(0))).alias("_r"))
    # for each size of a source, a document that can be taken once more, and one that can be taken once less
    pick = lambda can: F.min(F.when(can, F.struct("_h", "copies")))
    sizes = rounded.where(~at_cut & (F.col("size") > 0)).groupBy("_s", "size").agg(pick(F.col("copies") < most).alias("_more"), pick(F.col("copies") > 0).alias("_less"))
    sizes, rest, flips = stored(sizes), _few(rest), []
    for _ in range(FLIPS):
        done = _flip(sizes, rest)
        if done.where("_better").isEmpty():
            break
        better = done.where("_better")
        for size, which, sign in (("_a", "_more", 1), ("_b", "_less", -1)):
            flips.append(better.where(f"{size} > 0").select("_s", F.col(size).alias("size"), F.col(f"{which}._h").alias("_h"), F.col(f"{which}.copies").alias("_copies"), F.lit(sign).alias("_sign")))
        taken = better.select("_s", F.explode(F.array("_a", "_b")).alias("size"))
        sizes = sizes.join(F.broadcast(taken) if n <= FEW_SOURCES else taken, ["_s", "size"], "left_anti")
        rest = done.select("_s", F.when(F.col("_better"), F.col("_new")).otherwise(F.col("_r")).alias("_r"))
    out = cell.drop("_words")
    if flips:
        flipped = reduce(DataFrame.union, flips)
        found = rounded.select(*key).join(F.broadcast(flipped) if n <= FEW_SOURCES else flipped, key)
        out = out.union(found.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"), (F.count(F.lit(1)) * F.first("_copies") + F.first("_sign")).alias("_total")))
    return out.withColumn("_g", F.monotonically_increasing_id())


def _flip(sizes: DataFrame, rest: DataFrame) -> DataFrame:
    """(_s, _r, _a, _b, _more, _less, _new, _better): taking a document of _a words once more and one of _b words once less
    (0: none) brings a source nearest its target; found by looking up, for each _a, the sizes next to what is then too much."""
    none = rest.select("_s", F.lit(0).cast("long").alias("size"))
    both = rest.join(sizes, "_s")
    more = none.union(both.where("_more IS NOT NULL").select("_s", "size")).join(rest, "_s")
    asked = more.select("_s", (F.col("size") - F.col("_r")).alias("_v"), F.col("size").alias("_a"), "_r", F.lit(None).cast("long").alias("_b"))
    there = none.union(both.where("_less IS NOT NULL").select("_s", "size")).select("_s", F.col("size").cast("double").alias("_v"), F.lit(None).cast("long").alias("_a"), F.lit(None).cast("double").alias("_r"), F.col("size").alias("_b"))
    order = Window.partitionBy("_s").orderBy("_v")
    low = F.last("_b", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    high = F.first("_b", ignorenulls=True).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    tried = asked.union(there).withColumns({"_low": low, "_high": high}).where("_a IS NOT NULL").select("_s", "_r", "_a", F.explode(F.array("_low", "_high")).alias("_b")).where("_b IS NOT NULL")
    new = F.col("_r") - (F.col("_a") - F.col("_b"))
    best = tried.groupBy("_s").agg(F.first("_r").alias("_r"), F.min(F.struct(F.abs(new).alias("off"), "_a", "_b", new.alias("new"))).alias("_x"))
    best = best.select("_s", "_r", "_x._a", "_x._b", F.col("_x.new").alias("_new"), ((F.abs("_r") >= 0.5) & (F.col("_x.off") < F.abs("_r") - 1e-6)).alias("_better"))
    for size, which in (("_a", "_more"), ("_b", "_less")):
        best = best.join(sizes.select("_s", F.col("size").alias(size), which), ["_s", size], "left")
    return _few(best)

"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Every measure is an expression of the text; every rule bounds a measure. All of it is one struct whose parts share the
text's words and lines as lambda variables: no shuffle, no user function, nothing computed twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.functions.text import let

#: White space that parts words.
BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Very frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it was for on are as with by at from be this have or an not a i he you but his they "
    "der die das und ist von den mit zu im nicht ein eine des dem für auf als auch an er sie es sich bei nach aus wie "
    "le la les des et est un une dans que pour qui en du au ce il ne pas sur se plus par avec son je nous vous "
    "el los las y que de en un una por con para se no su al lo como más pero sus o este ha me si"
)


@dataclass(frozen=True)
class Rule:
    """A text passes if low <= measure <= high; either may be open."""

    measure: str
    low: float | None = None
    high: float | None = None


#: The production table. Ratios are per word, or per line with a word where they say so; stop_ratio counts one stop word
#: more than there are, so that short texts may do without.
RULES = (
    Rule("n_words", low=10),
    Rule("mean_word_chars", low=2, high=20),
    Rule("symbols_per_word", high=0.25),
    Rule("shouts_per_word", high=0.25),
    Rule("upper_word_ratio", high=0.5),
    Rule("stop_ratio", low=0.02),
    Rule("dup_line_ratio", high=0.5),
    Rule("ellipsis_line_ratio", high=0.3),
    Rule("bullet_line_ratio", high=0.9),
)


def _count(text: Column, letters: str) -> Column:
    """How many characters of text are among letters, all ASCII: what replacing each by nothing takes away."""
    rest = text
    for x in letters:
        rest = F.replace(rest, F.lit(x), F.lit(""))
    return F.octet_length(text) - F.octet_length(rest)


def _repeated(words: Column) -> Column:
    """Words inside windows of WINDOW words that the text has at least twice.

    Windows are compared by a 64-bit hash. If all differ, there is nothing to count. Else they are sorted with their
    places, so that equal ones are neighbours; the places that have such a neighbour, in order, each cover WINDOW words
    less what the next one covers too.
    """
    hashed = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))))
    placed = lambda h: F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    beside = lambda s, x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
    twice = lambda s: F.sort_array(F.transform(F.filter(s, lambda x, k: beside(s, x, k - 1) | beside(s, x, k + 1)), lambda x: x["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = lambda p: F.aggregate(p, start, lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).cast("long").alias("n")))["n"]
    none = F.lit(0).cast("long")
    of = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(let(placed(h), lambda s: let(twice(s), covered)))
    return F.when(F.size(words) >= WINDOW, let(hashed(words), of)).otherwise(none)


def _per(n: Column, of: Column) -> Column:
    return F.when(of > 0, n / of).otherwise(F.lit(0.0))


def _counts(text: Column, words: Column, lines: Column) -> Column:
    stops = sorted(dict.fromkeys(STOP_WORDS.split()))
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeated(words).alias("n_repeat_words"),
        F.size(lines).alias("lines"),
        _count(text, "!").alias("shouts"),
        F.size(F.filter(words, lambda w: w.rlike(r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$"))).alias("upper"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(*stops))).alias("stops"),
        F.size(F.filter(lines, lambda x: x.endswith("...") | x.endswith("…"))).alias("ellipses"),
        F.size(F.filter(lines, lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•", "·"))).alias("bullets"),
    )


def _measures(c: Column) -> Column:
    """MEASURES of a struct of counts."""
    own = [c[n].alias(n) for n in MEASURES[:5]]
    words, lines = c["n_words"], c["lines"]
    ratios = [_per(c["word_chars"], words), _per(c["n_symbols"], words), _per(c["shouts"], words), _per(c["upper"], words), _per(c["stops"] + 1, words), _per(c["n_dup_lines"], lines), _per(c["ellipses"], lines), _per(c["bullets"], lines)]
    return F.struct(*own, *(r.alias(n) for r, n in zip(ratios, MEASURES[5:], strict=True)))


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "mean_word_chars", "symbols_per_word", "shouts_per_word",
    "upper_word_ratio", "stop_ratio", "dup_line_ratio", "ellipsis_line_ratio", "bullet_line_ratio",
)


def compiled(rules: tuple[Rule, ...], of: Callable[[str], Column]) -> Column:
    """Names of the rules that fail; of gives a measure's column."""
    fails = []
    for r in rules:
        if r.low is not None:
            fails.append(F.when(of(r.measure) < r.low, F.lit(f"{r.measure} < {r.low:g}")))
        if r.high is not None:
            fails.append(F.when(of(r.measure) > r.high, F.lit(f"{r.measure} > {r.high:g}")))
    return F.array_compact(F.array(*fails))


def verdict(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """One struct of a text (null counts as empty): MEASURES, base_failed, kept, failed. Ratios over no words or lines are 0."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "")

    def judged(m: Column) -> Column:
        base = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
        fails = compiled(rules, m.getField)
        return let(fails, lambda f: F.struct(*(m[n].alias(n) for n in MEASURES), base.alias("base_failed"), (~base & (F.size(f) == 0)).alias("kept"), f.alias("failed")))

    return let(words, lambda w: let(lines, lambda x: let(_counts(text, w, x), lambda c: let(_measures(c), judged))))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures and verdict of every row of docs (doc_id, text; other columns are ignored).

    Returns doc_id, MEASURES, base_failed, kept and failed (the rules that the text breaks). Null and empty texts have no
    words, so they fail. Repeated rows have equal verdicts, null ids stay, an empty table gives no rows.
    """
    return docs.select("doc_id", verdict(docs["text"], rules).alias("_v")).select("doc_id", "_v.*")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs that judge() keeps, with all their columns, whatever their names.

    A null or empty text has no words and goes; a measure at exactly a bound stays; repeated rows and null ids are judged
    by their text like all others; texts are read whole; an empty table gives no rows.
    """
    return docs.where(verdict(docs["text"], rules)["kept"])

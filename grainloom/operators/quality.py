"""Quality metrics and rejection reasons, as one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.functions.text import let, word_ngram_hashes, words

#: A line that any of these is found in is boilerplate, whatever its case.
BOILERPLATE = (
    r"cookie\s*(?:policy|consent|notice)",
    r"privacy\s*policy",
    r"terms\s*(?:of|and)\s*(?:service|use|conditions)",
    r"subscribe\s*(?:to|for)\s*(?:our|the)\s*newsletter",
    r"all\s*rights\s*reserved",
    r"©\s*\d{4}",
)
#: Fixed values.
URL = r"https?://\S+"
CODE = r"(?:```[\s\S]*?```|def\s+\w+|class\s+\w+|import\s+\w+|function\s+\w+)"


@dataclass(frozen=True)
class Limits:
    """language: texts of another are rejected if detected with at least language_confidence; None: never."""

    min_chars: int = 100
    max_chars: int = 32768
    min_words: int = 20
    max_repetition: float = 0.3
    max_special: float = 0.5
    max_uppercase: float = 0.8
    max_urls: float = 0.3
    language: str | None = "en"
    language_confidence: float = 0.8
    remove_boilerplate: bool = True


def without_boilerplate(text: Column) -> Column:
    pattern = "(?iu)" + "|".join(f"(?:{p})" for p in BOILERPLATE)
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda line: ~line.rlike(pattern)), "\n")
    return F.when(text.rlike(pattern), kept).otherwise(text)


def repetition_ratio(tokens: Column, n: int = 10) -> Column:
    """The share of n-grams of lower-case words that came before; 0 if there are fewer than n words. n-grams are compared by 64-bit hashes."""
    of = lambda g: F.when(F.size(g) > 0, (F.size(g) - F.size(F.array_distinct(g))) / F.size(g)).otherwise(F.lit(0.0))
    return let(word_ngram_hashes(F.transform(tokens, F.lower), n), of)


def _measured(text: Column) -> Column:
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    upper = F.length(F.regexp_replace(text, r"\P{IsUppercase}+", ""))

    def of(w: Column) -> Column:
        n = F.size(w)
        return F.struct(
            F.length(text).alias("char_count"),
            n.alias("word_count"),
            (F.regexp_count(text, F.lit("\n")) + 1).alias("line_count"),
            F.when(n > 0, F.length(F.array_join(w, "")) / n).otherwise(F.lit(0.0)).alias("avg_word_length"),
            repetition_ratio(w).alias("repetition_ratio"),
            letters.alias("letters"),
            upper.alias("upper"),
            (F.regexp_count(text, F.lit(URL)) / F.greatest(n, F.lit(1))).alias("url_density"),
            text.rlike(f"(?U){CODE}").alias("has_code"),
        )

    return let(words(text), of)


def analysis(text: Column, limits: Limits = Limits(), language: Column | None = None, confidence: Column | None = None) -> Column:
    """A struct of metrics, reasons (in the order of the checks) and passed.

    language and confidence come from a detector; without one they are "unknown" and 0, which passes.
    """
    language = F.lit("unknown") if language is None else language
    confidence = F.lit(0.0) if confidence is None else confidence
    text = F.coalesce(text, F.lit(""))

    def judged(m: Column) -> Column:
        special = F.when(m["char_count"] > 0, 1.0 - m["letters"] / m["char_count"]).otherwise(F.lit(0.0))
        upper = m["upper"] / F.greatest(m["letters"], F.lit(1))
        two = lambda x: F.format_string("%.2f", x)
        reasons = [
            F.when(m["char_count"] < limits.min_chars, F.format_string(f"too_short (%d < {limits.min_chars})", m["char_count"])),
            F.when(m["char_count"] > limits.max_chars, F.format_string(f"too_long (%d > {limits.max_chars})", m["char_count"])),
            F.when(m["word_count"] < limits.min_words, F.format_string(f"too_few_words (%d < {limits.min_words})", m["word_count"])),
            F.when(m["repetition_ratio"] > limits.max_repetition, F.concat(F.lit("too_repetitive ("), two(m["repetition_ratio"]), F.lit(f" > {limits.max_repetition})"))),
            F.when(special > limits.max_special, F.concat(F.lit("too_many_special_chars ("), two(special), F.lit(")"))),
            F.when(upper > limits.max_uppercase, F.concat(F.lit("too_much_uppercase ("), two(upper), F.lit(")"))),
            F.when(m["url_density"] > limits.max_urls, F.concat(F.lit("too_many_urls ("), two(m["url_density"]), F.lit(")"))),
        ]
        if limits.language:
            wrong = (language != limits.language) & (confidence >= limits.language_confidence)
            reasons.append(F.when(wrong, F.concat(F.lit("wrong_language ("), language, F.lit(", confidence="), two(confidence.cast("double")), F.lit(")"))))
        names = ("char_count", "word_count", "line_count", "avg_word_length", "repetition_ratio")
        found = F.array_compact(F.array(*reasons))
        return let(found, lambda r: F.struct(*(m[n].alias(n) for n in names), special.alias("special_char_ratio"), upper.alias("uppercase_ratio"), m["url_density"].alias("url_density"), m["has_code"].alias("has_code"), language.alias("language"), confidence.alias("language_confidence"), r.alias("reasons"), (F.size(r) == 0).alias("passed")))

    body = without_boilerplate(text) if limits.remove_boilerplate else text
    return let(body, lambda t: let(_measured(t), judged))


def with_quality(docs: DataFrame, text: str = "text", limits: Limits = Limits(), language: Column | None = None, confidence: Column | None = None) -> DataFrame:
    """docs with a struct column `quality`."""
    return docs.withColumn("quality", analysis(F.col(text), limits, language, confidence))


def reason_counts(judged: DataFrame) -> DataFrame:
    """(reason, n): rejections by what stands before the bracket; a document counts for each of its reasons."""
    return judged.select(F.explode("quality.reasons").alias("r")).groupBy(F.substring_index("r", " (", 1).alias("reason")).agg(F.count(F.lit(1)).alias("n"))

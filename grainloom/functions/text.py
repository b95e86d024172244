"""Column functions for text: words, n-grams, normal forms, shared values in lambdas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.split and str.strip see it: Unicode's, and the four separators from U+001C.
SPACE = r"[\s\x1c-\x1f]"
_U = "(?U)"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once; the optimizer would else copy it into every use inside a lambda."""
    return F.transform(F.array(value), use)[0]


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"{_U}^{SPACE}+|{SPACE}+$", "")


def words(text: Column) -> Column:
    """Words between Unicode white space."""
    return F.filter(F.split(text, f"{_U}{SPACE}+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def word_ngrams(tokens: Column, n: int) -> Column:
    """All runs of n tokens joined by a space, in order and as often as they stand; none if there are fewer."""
    of = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.concat_ws(" ", *(F.get(w, i + k) for k in range(n))))
    return let(tokens, lambda w: F.when(F.size(w) >= n, of(w)).otherwise(F.array().cast("array<string>")))


def char_ngrams(text: Column, n: int) -> Column:
    """The distinct runs of n characters; of a shorter text, the text itself."""
    of = lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - n), lambda i: F.concat(*(F.get(c, i + k) for k in range(n))))
    return F.when(F.length(text) < n, F.array(text)).otherwise(F.array_distinct(let(F.split(text, ""), of)))


def word_ngram_hashes(tokens: Column, n: int) -> Column:
    """word_ngrams() by 64-bit hashes of their words: to count or to join them, without their text."""
    of = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(n))))
    return let(tokens, lambda w: F.when(F.size(w) >= n, of(w)).otherwise(F.array().cast("array<bigint>")))


def strip_then_drop_marks(text: Column) -> Column:
    """Lower case, stripped, white space collapsed, then marks deleted; blanks around a mark stay doubled."""
    return F.regexp_replace(F.regexp_replace(strip(F.lower(text)), f"{_U}{SPACE}+", " "), rf"{_U}[^\w\s\x1c-\x1f]", "")


def drop_marks_then_strip(text: Column) -> Column:
    """Lower case, marks deleted, then white space collapsed and stripped."""
    return strip(F.regexp_replace(F.regexp_replace(F.lower(text), rf"{_U}[^\w\s\x1c-\x1f]", ""), f"{_U}{SPACE}+", " "))


def rounded(x: Column, digits: int) -> Column:
    """Half to even, as Python rounds."""
    return F.bround(x, digits)

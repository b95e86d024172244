import collections
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grainloom.functions import pii
from grainloom.functions.text import char_ngrams, drop_marks_then_strip, strip, strip_then_drop_marks, word_ngrams, words
from grainloom.operators.quality import Limits, reason_counts, with_quality, without_boilerplate

TEXTS = ["", " a  b ", "nbsp\xa0here\x1cand there", "Café, Straße! x_y", "one", "Ünï  - codé", "a\n\nb\tc", "..", "x . y"]


def one(spark, column_of, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(column_of(F.col("t"))).collect()]


def test_words_and_normal_forms_are_pythons(spark):
    assert one(spark, words, TEXTS) == [t.split() for t in TEXTS]
    assert one(spark, strip, TEXTS) == [t.strip() for t in TEXTS]
    first = lambda t: re.sub(r"[^\w\s]", "", re.sub(r"\s+", " ", t.lower().strip()))
    second = lambda t: re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", t.lower())).strip()
    assert one(spark, strip_then_drop_marks, TEXTS) == [first(t) for t in TEXTS]
    assert one(spark, drop_marks_then_strip, TEXTS) == [second(t) for t in TEXTS]


def test_ngrams(spark):
    assert one(spark, lambda t: word_ngrams(words(t), 2), ["a b c", "a", ""]) == [["a b", "b c"], [], []]
    got = one(spark, lambda t: char_ngrams(t, 3), ["abcab", "ab", "", "aaaa"])
    assert got == [["abc", "bca", "cab"], ["ab"], [""], ["aaa"]]


def test_boilerplate_lines_go(spark):
    text = "keep\nAll Rights Reserved\nour PRIVACY   policy\n© 2020 x\nkeep too"
    assert one(spark, without_boilerplate, [text, "nothing"]) == ["keep\nkeep too", "nothing"]


def quality(spark, text, **limits):
    df = with_quality(spark.createDataFrame([(1, text)], "doc_id long, text string"), limits=Limits(**limits))
    return df.select("quality.*").first()


def test_reasons(spark):
    short = quality(spark, "Too short")
    assert not short["passed"] and short["reasons"] == ["too_short (9 < 100)", "too_few_words (2 < 20)"]
    fine = quality(spark, "This is a perfectly normal sentence about nothing.\nIt has a second line as well.\nAnd then a third.", min_chars=50, min_words=10)
    assert fine["passed"] and fine["line_count"] == 3
    again = quality(spark, "word " * 100)
    assert round(again["repetition_ratio"], 3) == 0.989 and "too_repetitive (0.99 > 0.3)" in again["reasons"]
    loud = quality(spark, "SHOUTING " * 3 + "http://a.b " * 3)
    assert any(r.startswith("too_much_uppercase") or r.startswith("too_many_urls") for r in loud["reasons"])
    assert not quality(spark, None)["passed"]
    assert quality(spark, "def f(x): pass")["has_code"]


def test_wrong_language_needs_confidence(spark):
    df = spark.createDataFrame([(1, "x " * 100, "de", 0.9), (2, "x " * 100, "de", 0.5)], "doc_id long, text string, lang string, c double")
    out = with_quality(df, language=F.col("lang"), confidence=F.col("c")).select("quality.reasons").collect()
    assert ["wrong_language" in " ".join(r[0]) for r in out] == [True, False]
    assert {r["reason"]: r["n"] for r in reason_counts(with_quality(df, language=F.col("lang"), confidence=F.col("c"))).collect()}["too_repetitive"] == 2


def brute_redact(text):
    counts = {}
    for name, p in pii.PATTERNS.items():
        counts[name] = len(re.findall(p, text))
        text = re.sub(p, f"[REDACTED]_{name.upper()}", text)
    return text, counts


@pytest.mark.parametrize("text", ["Mail a.b@c.com or call 555-123-4567, SSN 123-45-6789, host 192.168.1.1, card 4111-1111-1111-1111.", "4111111111111111", "1234567890123456 x@y.c|m", "$1 \\ none", "", "+1 (499) 555-6503 and 499.555.6503"])
def test_redaction(spark, text):
    r = spark.createDataFrame([(text,)], "t string").select(pii.redactions(F.col("t")).alias("r")).first()["r"]
    want, counts = brute_redact(text)
    assert r["text"] == want and {n: r[f"n_{n}"] for n in pii.PATTERNS} == counts


def test_redaction_of_some(spark):
    r = spark.createDataFrame([("a@b.co 555-123-4567",)], "t string").select(pii.redactions(F.col("t"), ("phone", "nonsense"), "<$x>").alias("r")).first()["r"]
    assert r.asDict() == {"text": "a@b.co <$x>_PHONE", "n_phone": 1}


@settings(deadline=None, max_examples=20)
@given(st.lists(st.text(alphabet="ab .", max_size=30), min_size=1, max_size=5))
def test_char_ngram_sets(texts):
    from pyspark.sql import SparkSession

    got = one(SparkSession.getActiveSession(), lambda t: char_ngrams(t, 4), texts)
    assert [set(g) for g in got] == [{t[i : i + 4] for i in range(len(t) - 3)} or {t} for t in texts]
    assert all(max(collections.Counter(g).values()) == 1 for g in got)

"""Personal data: five patterns, rewritten and counted one after the other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The patterns, in the order in which they apply. A phone number has no word boundary, so it takes the
#: first ten digits of a longer run; a pipe may stand in the last part of an address.
PATTERNS = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"(?:\+?1[-.\s]?)?\(?[0-9]{3}\)?[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}",
    "ssn": r"\b\d{3}[-\s]?\d{2}[-\s]?\d{4}\b",
    "ip_address": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "credit_card": r"\b(?:\d{4}[-\s]?){3}\d{4}\b",
}


def redactions(text: Column, names: Sequence[str] = tuple(PATTERNS), replacement: str = "[REDACTED]") -> Column:
    """A struct: text, and n_<name> for each active pattern, counted on what the earlier ones left.

    Patterns apply in their own order whatever that of names is; unknown names are ignored.
    """
    safe = replacement.replace("\\", "\\\\").replace("$", "\\$")
    active = [n for n in PATTERNS if n in names]

    def step(left: list[str], now: Column, counts: list[Column]) -> Column:
        if not left:
            return F.struct(now.alias("text"), *(c.alias(f"n_{n}") for n, c in zip(active, counts, strict=True)))
        name, *rest = left
        pattern = f"(?U){PATTERNS[name]}"
        pair = F.struct(F.regexp_replace(now, pattern, f"{safe}_{name.upper()}").alias("t"), F.regexp_count(now, F.lit(pattern)).alias("n"))
        return F.transform(F.array(pair), lambda p: step(rest, p["t"], [*counts, p["n"]]))[0]

    return step(active, text, [])

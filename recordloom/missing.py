"""Definitions of a missing value, one Column function each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that only say that nothing is known, lower case, compared after trimming.
SAYS_NOTHING = (
    "", "-", "--", "n/a", "na", "n.a.", "none", "null", "nil", "nan", "unknown", "?", "tbd", "tba", "unspecified",
    "not specified", "not stated", "not given", "not known", "not available", "not applicable", "not reported", "undisclosed",
)
_BLANK = r"(?U)^[\s\p{Punct}·…—–]*$"


def trim_all(c: Column) -> Column:
    """Trim all white space, Unicode included."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_missing(c: Column) -> Column:
    """NULL, blank, only punctuation, or a text that only says that nothing is known."""
    return c.isNull() | c.rlike(_BLANK) | F.lower(trim_all(c)).isin(*SAYS_NOTHING)


def says_nothing(text: str | None) -> bool:
    """Python twin of is_missing for use inside UDFs."""
    return text is None or not any(ch.isalnum() for ch in text) or text.strip().lower() in SAYS_NOTHING


def is_missing_m1(c: Column) -> Column:
    """Coercion on ingest: null, none and n/a in any case, after trimming."""
    return c.isNull() | F.lower(trim_all(c)).isin("null", "none", "n/a")


def is_missing_m2(c: Column) -> Column:
    """Quality gate: NULL, empty, 'null' or 'None' exactly."""
    return c.isNull() | c.isin("", "null", "None")


def is_missing_m3(c: Column) -> Column:
    """Merge and metrics: as M2 after trimming."""
    return c.isNull() | trim_all(c).isin("", "null", "None")


def is_missing_m4(c: Column) -> Column:
    """Strict compare: NULL or empty."""
    return c.isNull() | (c == "")


def is_missing_m5(c: Column) -> Column:
    """Relaxed compare: NULL, empty, or null, none, n/a in any case."""
    return c.isNull() | (c == "") | F.lower(c).isin("null", "none", "n/a")

"""Reading text as numbers, with null for what is not one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that count as "no value" when a raw file is profiled.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def is_missing(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | c.cast("string").isin(MISSING_TEXTS)


_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def to_number(c: Column | str) -> Column:
    """Double value of a decimal text or null. Java's type letters (``1d``) and hexadecimal notation make no number."""
    c = F.col(c) if isinstance(c, str) else c
    text = c.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def is_boolean(c: Column | str) -> Column:
    """True where a text is ``True`` or ``False`` in a spelling that a profiled file may use for it."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string").isin("True", "TRUE", "true", "False", "FALSE", "false")


def invalid_number(c: Column | str) -> Column:
    """True where a value is present and cannot be read as a number."""
    return ~is_missing(c) & to_number(c).isNull()

"""Spark spellings of dialect-specific SQL forms.

The queries were written for several engines; these are the Spark
equivalents, all built-in (JVM-side, inside whole-stage codegen):

* ``x ^ 3`` (power)             -> ``power``; in Spark ``^`` is bitwise XOR
* ``IIF(c, a, b)``              -> ``CASE WHEN``; NULL condition takes ``b``
* ``ISNULL(x, d)``              -> ``coalesce``
* ``DATEPART(YEAR, d)``         -> ``year``
* ``to_char(d, 'DD/MM/YYYY')``  -> ``date_format(d, 'dd/MM/yyyy')``
* ``'dd/mm/yyyy'::timestamp``   -> ``to_date(text, 'dd/MM/yyyy')``
* ``NOT LIKE '%[^0-9]%'``       -> regex character classes (Spark ``LIKE`` has
                                   no ``[...]`` classes and would treat ``[``
                                   as a literal)
* case-insensitive ``=``        -> compare lower-cased text
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character-class patterns and the day format.
NON_DIGIT = "[^0-9]"
NON_LATIN_LETTER = "[^a-zA-Z]"
DAY_FORMAT = "dd/MM/yyyy"


def power(x: Column, n) -> Column:
    return F.pow(x, F.lit(n) if not isinstance(n, Column) else n)


def iif(cond: Column, a: Column, b: Column) -> Column:
    return F.when(cond, a).otherwise(b)


def isnull_default(x: Column, default) -> Column:
    return F.coalesce(x, F.lit(default))


def year_of(d: Column) -> Column:
    return F.year(d)


def day_text(d: Column) -> Column:
    return F.date_format(d, DAY_FORMAT)


def day_of(text: Column) -> Column:
    """The date that dd/mm/yyyy text names; text that names none is an error, as in a cast."""
    return F.to_date(text, DAY_FORMAT)


def only_digits(s: Column) -> Column:
    """TRUE when ``s`` holds no character other than 0-9 (empty string too)."""
    return ~s.rlike(NON_DIGIT)


def only_latin_letters(s: Column) -> Column:
    return ~s.rlike(NON_LATIN_LETTER)


def ci_equals(s: Column, text: str) -> Column:
    return F.lower(s) == F.lit(text.lower())

"""Which texts count as a number in the event contract, and their value.

The contract follows the usual float grammar: blanks around it, a sign, single
underscores between digits, an exponent, and the words inf / infinity / nan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PLAIN = r"^-?+\d++(?:\.\d++)?+$"  # the usual case, decided without backtracking
_DIGITS = r"\d(?:_?\d)*"
_FINITE = (
    rf"^\s*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
    rf"(?:[eE][+-]?{_DIGITS})?\s*$"
)
_WORD = r"(?i)^\s*[+-]?(?:inf|infinity|nan)\s*$"


def is_finite_text(c: Column) -> Column:
    return c.rlike(_PLAIN) | c.rlike(_FINITE)


def is_special_text(c: Column) -> Column:
    """inf or nan: a valid float, but not a countable quantity."""
    return c.rlike(_WORD)


def number_value(c: Column) -> Column:
    """Double value of a text that passed one of the checks above."""
    return F.coalesce(c.try_cast("double"),
                      F.regexp_replace(c, "_", "").try_cast("double"))

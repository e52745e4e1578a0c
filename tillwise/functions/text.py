"""Text expressions for the cleaning steps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(x: Column) -> Column:
    """Remove all white space at both ends, tabs, line breaks and wide spaces included."""
    return F.trim(x, F.lit(WHITE_SPACE))


def to_number(x: Column) -> Column:
    """Text to double by the rules of a Python float literal; NULL when it is none.

    Plain decimals take the short way. The long way is for the names of NaN and infinity (bare in
    JSON they arrive in quotes) and for underscores between digits. What only the JVM would take,
    such as 1.0d or hexadecimal floats, is no number.
    """
    word = strip(x)
    named = F.regexp_extract(word, r'^(?:"(NaN|-?Infinity)"|([+-]?(?i:inf|infinity|nan)))$', 0)
    grouped = F.regexp_replace(word, r"(?<=[0-9])_(?=[0-9])", "")
    plain = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
    return (F.when(word.rlike(plain), word.try_cast("double"))
            .when(named != "", F.replace(named, F.lit('"'), F.lit("")).try_cast("double"))
            .when(grouped.rlike(plain), grouped.try_cast("double")))

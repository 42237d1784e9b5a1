"""Phone layout as one native expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a character that is no decimal digit and does not follow a "+".
# \P{Nd} instead of \D, because Java's \D knows ASCII digits only.
NON_DIGIT = r"(?<!\+)\P{Nd}"


def phone_digits(phone: Column) -> Column:
    """``phone`` without its separators."""
    return F.regexp_replace(phone, NON_DIGIT, "")


def phone_layout(digits: Column, original: Column) -> Column:
    """Lay out ``digits``; shorter numbers keep their ``original`` text.

    Plain text order matters here: eleven or more characters with a leading 1
    count as a US number with its extension, any other long text keeps the last
    ten characters as the number and repeats its last three as the extension.
    """
    n = F.length(digits)

    def cut(start, size=None):
        start = F.lit(start) if isinstance(start, int) else start
        return F.substr(digits, start, n if size is None else F.lit(size))

    def number(area, exchange, line):
        return F.concat(F.lit("("), area, F.lit(") "), exchange, F.lit("-"), line)

    def extension(text):
        return F.concat(F.lit(" (Ext: "), text, F.lit(")"))

    plain = number(cut(1, 3), cut(4, 3), cut(7))
    us = F.concat(F.lit("+1 "), number(cut(2, 3), cut(5, 3), cut(8)))
    foreign = F.concat(
        F.lit("+"),
        F.substr(digits, F.lit(1), n - 10),
        F.lit(" "),
        number(cut(n - 9, 3), cut(n - 6, 3), cut(n - 3, 4)),
        extension(cut(n - 2, 3)),
    )
    leading_one = digits.startswith("1")
    return (
        F.when(n < 10, original)
        .when(n == 10, plain)
        .when(leading_one & (n == 11), us)
        .when(leading_one, F.concat(us, extension(cut(12))))
        .otherwise(foreign)
    )


def phone_format(phone: Column) -> Column:
    """Normalised phone number; null stays null."""
    return phone_layout(phone_digits(phone), phone)

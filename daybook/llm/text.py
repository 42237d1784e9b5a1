"""Words and hashes shared by the corpus operators.

A word is a run of characters other than space and the controls 9 to 13.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text in order; null and blank texts have none."""
    one_blank = F.translate(or_empty(text), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(one_blank, " "), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def unit_interval(*parts: Column | str) -> Column:
    """A draw in [0, 1) that depends on the parts alone: 52 bits of their MD5."""
    columns = [F.lit(p) if isinstance(p, str) else or_empty(p) for p in parts]
    digits = F.substring(F.md5(F.concat_ws(":", *columns)), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))

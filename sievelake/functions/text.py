"""Text helpers whose whitespace and line rules cover all of Unicode."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters stripped at either end of a line or name, and line breaks.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = (
    r"[ \t\n\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
RARE_LINE_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def strip(text: Column) -> Column:
    """Text without whitespace at its ends (``trim`` alone only knows the space)."""
    return F.btrim(text, F.lit(WHITESPACE))


def _has_rare_breaks(text: Column) -> Column:
    """Whether lines end at more than line feeds, by plain searches."""
    return reduce(or_, [F.contains(text, F.lit(c)) for c in RARE_LINE_BREAKS])


def split_lines(text: Column) -> Column:
    """Array of lines; a break at the very end opens no further line.

    Texts with line feeds alone, as nearly all have, are cut by a plain search.
    """
    closed = F.regexp_replace(text, rf"(?:{LINE_BREAK})\z", "")
    ended = F.when(F.endswith(text, F.lit("\n")), F.left(text, F.length(text) - 1)).otherwise(text)
    return (
        F.when(text == "", F.array().cast("array<string>"))
        .when(_has_rare_breaks(text), F.split(closed, LINE_BREAK, -1))
        .otherwise(F.split(ended, "\n", -1))
    )


def split_line(line: Column) -> Column:
    """Array of lines within one that was read up to a line feed.

    Nearly always that is the line itself, which plain searches tell faster than a split.
    """
    ended = F.when(
        F.endswith(line, F.lit("\r")), F.left(line, F.length(line) - 1)
    ).otherwise(line)
    return F.when(_has_rare_breaks(line), F.split(ended, LINE_BREAK, -1)).otherwise(F.array(line))

"""Domain names: cleaning and validation as plain column expressions.

Each rule is one anchored regular expression that is evaluated once per row. It matches a
whole text or nothing, so extracting all matches gives an array of one name or none:
take its first item to keep every row, or explode it to keep only rows with a name.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from sievelake.functions.text import WHITESPACE_CLASS as WS
from sievelake.settings import MAX_DOMAIN_LENGTH, REJECTED_LAST_LABELS

# Letters are spelled out, as Java looks up a class of single characters in one table and
# tries the ranges of any other class one after the other.
LETTER = "abcdefghijklmnopqrstuvwxyz"
ALNUM = f"{LETTER}0123456789"

# A name of at most 253 characters. Labels have at most 63 and end in a letter or digit;
# only the first one must not start with a hyphen; the last one is letters only and not a
# reserved label. The shortest text of that form has the four characters a name needs.
NAME = (
    rf"(?![{ALNUM}.-]{{{MAX_DOMAIN_LENGTH}}}\.*[{ALNUM}-])"
    rf"[{ALNUM}](?:[{ALNUM}-]{{0,61}}[{ALNUM}])?"
    rf"(?:\.[{ALNUM}-]{{0,62}}[{ALNUM}])*"
    rf"\.(?!(?:{'|'.join(REJECTED_LAST_LABELS)})(?![{ALNUM}-]))[{LETTER}]{{2,}}"
)

# A name and nothing else but surrounding whitespace.
EXACT = rf"\A{WS}*+({NAME}){WS}*+\z"

# A name inside a URL-like text. Prefixes are possessive: once a scheme or "www." is
# there it is always dropped. Behind the name: spaces then dots, and then either the
# end, or a single port, path, query or fragment.
DIRTY = (
    rf"(?s)\A{WS}*+(?:https://)?+(?:http://)?+(?:ftp://)?+(?://)?+(?:www\.)*+{WS}*+"
    rf"({NAME})"
    rf"{WS}*+\.*+(?:{WS}*+\z|(?::[^:/?#]*+)?+(?:[/?#].*+)?+\z)"
)


def names(text: Column, pattern: str) -> Column:
    """Array with the name the pattern finds in the text, or empty."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _may_change(name: Column) -> Column:
    """Whether cleaning may change a valid lower-case name: it takes off no more than "www."."""
    return F.startswith(name, F.lit("www."))


def cleaned(domain: Column, named: bool = False) -> Column:
    """Array with the bare lower-case domain of a dirty one, or empty.

    ``named`` tells that all are valid lower-case names, as the parsers find them, so that most
    need no second search.
    """
    found = names(F.lower(domain), DIRTY)
    return F.when(_may_change(domain), found).otherwise(F.array(domain)) if named else found


def clean(domain: Column, named: bool = False) -> Column:
    """Bare lower-case domain of a dirty one; null when nothing valid is left."""
    found = F.get(cleaned(domain), F.lit(0))
    return F.when(_may_change(domain), found).otherwise(domain) if named else found


def is_valid(domain: Column) -> Column:
    """True for a well-formed public domain, false for anything else and for null."""
    return F.coalesce(F.lower(domain).rlike(EXACT), F.lit(False))


def register_sql(spark: SparkSession) -> None:
    """Make both rules callable from SQL as ``clean_domain`` and ``is_valid_domain``.

    SQL functions are inlined by the optimizer, unlike a Python UDF.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION clean_domain(domain STRING) RETURNS STRING "
        f"RETURN get(regexp_extract_all(lower(domain), R'{DIRTY}', 1), 0)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION is_valid_domain(domain STRING) RETURNS BOOLEAN "
        f"RETURN coalesce(lower(domain) RLIKE R'{EXACT}', false)"
    )

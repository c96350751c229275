"""Entry validation and first-wins dedupe per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievelake.functions import domains
from sievelake.settings import VALIDATION_ERROR


def dedupe(entries: DataFrame, order: Sequence[str] = ("path", "line_number")) -> DataFrame:
    """First entry of each domain within its source, in line order.

    Spark ranks within every map task first and ships one row per domain and task, so a
    domain or source that holds most rows does not gather in one task.
    """
    first = Window.partitionBy("source", "domain").orderBy(*order)
    return entries.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def lenient(entries: DataFrame, order: Sequence[str] = ("path", "line_number")) -> DataFrame:
    """Valid entries, unchanged, first one per source and domain."""
    return dedupe(entries.filter(domains.is_valid(F.col("domain"))), order)


def strict(entries: DataFrame, order: Sequence[str] = ("path", "line_number")) -> DataFrame:
    """As ``lenient``, but the job fails at an invalid entry."""
    message = F.concat(
        F.lit(f"{VALIDATION_ERROR}: "),
        F.coalesce(F.col("domain"), F.lit("null")),
        F.lit(" from "),
        F.coalesce(F.col("source"), F.lit("null")),
    )
    checked = F.when(domains.is_valid(F.col("domain")), F.col("domain")).otherwise(
        F.raise_error(message)
    )
    return dedupe(entries.withColumn("domain", checked), order)


def clean_and_validate(
    entries: DataFrame, order: Sequence[str] = ("path", "line_number"), named: bool = False
) -> DataFrame:
    """Entries under their cleaned domain; what cannot be cleaned is dropped.

    ``named`` tells that entries were parsed, so that their domains are valid names.
    """
    others = [c for c in entries.columns if c != "domain"]
    cleaned = entries.select(F.explode(domains.cleaned(F.col("domain"), named)).alias("domain"), *others)
    return dedupe(cleaned, order)

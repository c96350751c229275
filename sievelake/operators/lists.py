"""List documents to entries: line splitting, format dispatch, failures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.functions.domains import NAME, names
from sievelake.functions.text import WHITESPACE_CLASS as WS
from sievelake.functions.text import split_lines, strip
from sievelake.functions.times import moment

# What an entry looks like in each list format. Comments, headers and
# anything malformed simply do not match.
HOSTS_ENTRY = rf"(?i)\A{WS}*+(?:0\.0\.0\.0|127\.0\.0\.1){WS}++({NAME}){WS}*+\z"
ADBLOCK_ENTRY = rf"(?is)\A{WS}*+\|\|({NAME})\^(?:{WS}*+|\$.*+)\z"


def hosts_names(line: Column) -> Column:
    """Array with the name of a hosts line, or empty."""
    return names(line, HOSTS_ENTRY)


def adblock_names(line: Column) -> Column:
    """Array with the name of a domain rule, or empty for path and element rules."""
    return names(line, ADBLOCK_ENTRY)


# Parsers by format name; pass an extended mapping to support another format.
FORMATS: dict[str, Callable[[Column], Column]] = {
    "hosts": hosts_names,
    "adblock": adblock_names,
}


def lines(documents: DataFrame) -> DataFrame:
    """Numbered lines of documents held in a ``content`` column.

    Line numbers start at 1 and count blank and comment lines. All other columns are kept.
    """
    kept = [c for c in documents.columns if c != "content"]
    return documents.select(
        *kept, F.posexplode(split_lines(F.col("content"))).alias("line_number", "line")
    ).withColumn("line_number", F.col("line_number").cast("bigint") + 1)


def merged_metadata(line_number: Column, fetched: Column) -> Column:
    """Line number plus the fetch metadata; a key the fetch already has wins."""
    own = F.create_map(F.lit("line_number"), line_number.cast("string"))
    return (
        F.when(fetched.isNull(), own)
        .when(F.map_contains_key(fetched, "line_number"), fetched)
        .otherwise(F.map_concat(own, fetched))
    )


def parse(
    numbered: DataFrame,
    registry: DataFrame,
    as_of=None,
    formats: dict[str, Callable[[Column], Column]] = FORMATS,
) -> DataFrame:
    """Entries of numbered lines (source, path, line_number, line, fetch_metadata).

    The parser is picked by the format the registry gives for the source. Lines that are
    no entry of that format are dropped; sources of an unknown format give no entry.
    """
    found = F.lit(None).cast("array<string>")
    for name, names_of in formats.items():
        found = F.when(F.col("format") == name, names_of(F.col("line"))).otherwise(found)
    known = registry.select("source", "format", "category").filter(
        F.col("format").isin(list(formats))
    )
    return (
        numbered.join(known, "source")
        .select("*", F.explode(found).alias("name"))
        .select(
            F.lower("name").alias("domain"),
            "category",
            "source",
            F.col("format").alias("source_format"),
            strip(F.col("line")).alias("raw_entry"),
            moment(as_of).alias("ingestion_timestamp"),
            merged_metadata(F.col("line_number"), F.col("fetch_metadata")).alias("metadata"),
            "path",
            "line_number",
        )
    )


def failures(
    documents: DataFrame,
    registry: DataFrame,
    formats: dict[str, Callable[[Column], Column]] = FORMATS,
) -> DataFrame:
    """Documents that fail their source (source, path, reason), and sources without any.

    ``documents`` needs source, path and ``content_length``. A failed document does not
    stop the others. A document whose source the registry does not have is a failure.
    """
    known = registry.select("source", "format")
    reason = F.when(F.col("listed").isNull(), F.lit("Unknown source")).when(
        ~F.coalesce(F.col("format").isin(list(formats)), F.lit(False)),
        F.concat(F.lit("Unknown format type: "), F.coalesce("format", F.lit("none"))),
    ).when(
        F.coalesce(F.col("content_length"), F.lit(0)) == 0,
        F.lit("Empty content received from source"),
    )
    broken = (
        documents.select("source", "path", "content_length")
        .join(known.withColumn("listed", F.lit(True)), "source", "left")
        .select("source", "path", reason.alias("reason"))
        .filter(F.col("reason").isNotNull())
    )
    missing = known.join(documents.select("source").distinct(), "source", "left_anti").select(
        "source",
        F.lit(None).cast("string").alias("path"),
        F.lit("No document fetched").alias("reason"),
    )
    return broken.unionByName(missing)

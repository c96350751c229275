"""Entries to messages: JSON envelope, key and topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.functions.times import iso_text
from sievelake.settings import TOPICS


def topic_of(category: Column) -> Column:
    """Topic of a category; null when there is none."""
    topics = F.create_map(*[F.lit(x) for pair in TOPICS.items() for x in pair])
    return F.try_element_at(topics, category)


def to_messages(entries: DataFrame) -> DataFrame:
    """Messages (key, value, topic) of entries.

    Entries of an unknown category keep a null topic, so that the publisher can leave
    them out and the statistics can count them. Transport columns are passed on.
    """
    envelope = F.struct(
        "domain",
        "category",
        "source",
        "source_format",
        "raw_entry",
        iso_text(F.col("ingestion_timestamp")).alias("ingestion_timestamp"),
        F.coalesce("metadata", F.create_map().cast("map<string,string>")).alias("metadata"),
    )
    return entries.select(
        F.nullif(F.col("domain"), F.lit("")).cast("binary").alias("key"),
        F.to_json(envelope).cast("binary").alias("value"),
        topic_of(F.col("category")).alias("topic"),
        *[c for c in ("partition", "offset", "timestamp") if c in entries.columns],
    )

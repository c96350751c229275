"""Raw rows to cleaned and flagged rows: one out for every one in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelake.functions import domains
from sievelake.functions.times import moment
from sievelake.settings import VALIDATION_ERROR


def transform(bronze: DataFrame, as_of=None) -> DataFrame:
    """Rows under their cleaned domain, with validity flag and error text.

    Cleaning only ever returns valid names, so the flag is whether a name is left.
    """
    found = F.col("domain").isNotNull()
    return bronze.withColumn("domain", domains.clean(F.col("domain"))).select(
        "domain",
        "category",
        "source",
        "source_format",
        "raw_entry",
        "ingestion_timestamp",
        "bronze_timestamp",
        moment(as_of).alias("silver_timestamp"),
        "metadata",
        F.when(found, "true").otherwise("false").alias("is_valid"),
        F.when(~found, VALIDATION_ERROR).alias("validation_errors"),
        "ingestion_date",
        F.col("kafka_offset").alias("bronze_offset"),
    )


def valid_only(silver: DataFrame) -> DataFrame:
    """Rows that may go on to the per-domain table."""
    return silver.filter(F.col("is_valid") == "true")

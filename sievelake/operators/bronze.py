"""Messages to the raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelake.functions.times import moment, utc
from sievelake.schemas import MESSAGE_VALUE


def transform(messages: DataFrame, as_of=None) -> DataFrame:
    """Raw rows of messages. A message that cannot be read stays as a row of nulls."""
    fields = [f.name for f in MESSAGE_VALUE if f.name not in ("ingestion_timestamp", "metadata")]
    return (
        messages.select(
            F.from_json(F.col("value").cast("string"), MESSAGE_VALUE).alias("data"),
            F.col("topic").alias("kafka_topic"),
            F.col("partition").cast("bigint").alias("kafka_partition"),
            F.col("offset").cast("bigint").alias("kafka_offset"),
            F.col("timestamp").alias("kafka_timestamp"),
        )
        .select(
            *[F.col(f"data.{name}").alias(name) for name in fields],
            F.try_to_timestamp("data.ingestion_timestamp").alias("ingestion_timestamp"),
            F.col("data.metadata").alias("metadata"),
            "kafka_topic",
            "kafka_partition",
            "kafka_offset",
            "kafka_timestamp",
            moment(as_of).alias("bronze_timestamp"),
        )
        .withColumn("ingestion_date", F.to_date(utc(F.col("ingestion_timestamp"))))
    )

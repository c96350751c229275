"""Message topics: Kafka, or Parquet files with the same columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.schemas import TRANSPORT
from sievelake.settings import KAFKA_CONSUMER, KAFKA_PRODUCER, TOPICS


@dataclass(frozen=True)
class KafkaFeed:
    """Topics to read as a stream: from where, how much at a time, and if gaps are errors."""

    servers: str
    topics: Sequence[str] = tuple(TOPICS.values())
    start: str = "latest"
    trigger_limit: int | None = None
    gaps_fail: bool = False

    def options(self) -> dict[str, str]:
        chosen = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": ",".join(self.topics),
            "startingOffsets": self.start,
            "failOnDataLoss": str(self.gaps_fail).lower(),
            "maxOffsetsPerTrigger": self.trigger_limit and str(self.trigger_limit),
        }
        return KAFKA_CONSUMER | {name: value for name, value in chosen.items() if value}


def kafka_write_options(
    bootstrap_servers: str, topic: str | None = None, checkpoint: str | None = None
) -> dict[str, str]:
    """Options of the Kafka sink; without a topic each row names its own."""
    options = {"kafka.bootstrap.servers": bootstrap_servers}
    if topic:
        options["topic"] = topic
    if checkpoint:
        options["checkpointLocation"] = checkpoint
    else:
        options.update(KAFKA_PRODUCER)
    return options


def message_stream(
    spark: SparkSession,
    topics: Sequence[str] = tuple(TOPICS.values()),
    *,
    kafka: dict[str, str] | None = None,
    path: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of messages from Kafka (options) or from a published Parquet folder."""
    if (kafka is None) == (path is None):
        raise ValueError("give either Kafka options or a path")
    if kafka is not None:
        return spark.readStream.format("kafka").options(**kafka).load()
    reader = spark.readStream.schema(TRANSPORT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # The folder is partitioned by topic: the filter prunes directories.
    return reader.parquet(path).filter(F.col("topic").isin(list(topics)))

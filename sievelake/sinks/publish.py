"""Publishing of messages, routed by their topic column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sievelake.schemas import TRANSPORT


# Partitions that a folder of messages pretends to have.
PARTITIONS = 16


def publish(
    messages: DataFrame, *, kafka: dict[str, str] | None = None, path: str | None = None
) -> None:
    """Send all messages that have a topic to Kafka (options) or append them to a folder.

    Messages without a topic are left out; ``stats.publish`` counts them as failed. In a
    folder, partition, offset and time are filled in unless the messages bring their own;
    offsets then only order the messages of one call.
    """
    if (kafka is None) == (path is None):
        raise ValueError("give either Kafka options or a path")
    routed = messages.filter(F.col("topic").isNotNull())
    if kafka is not None:
        routed.select("key", "value", "topic").write.format("kafka").options(**kafka).save()
        return
    stamps = {
        "partition": F.pmod(F.hash("key"), F.lit(PARTITIONS)),
        "offset": F.monotonically_increasing_id(),
        "timestamp": F.current_timestamp(),
        "timestampType": F.lit(0),
    }
    columns = [
        (F.col(f.name) if f.name in messages.columns else stamps[f.name])
        .cast(f.dataType)
        .alias(f.name)
        for f in TRANSPORT
    ]
    routed.select(*columns).write.mode("append").partitionBy("topic").parquet(path)


def publish_stream(messages: DataFrame, options: dict[str, str]) -> StreamingQuery:
    """Stream messages to Kafka; ``options`` as ``topics.kafka_write_options`` gives them."""
    routed = messages.filter(F.col("topic").isNotNull())
    columns = ["key", "value"] if "topic" in options else ["key", "value", "topic"]
    return routed.select(*columns).writeStream.format("kafka").options(**options).start()

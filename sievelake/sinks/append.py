"""Append streams into Parquet tables, one folder per micro-batch."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sievelake.tables.batches import write_batch

INTERVAL = re.compile(r"\d+")


def trigger(interval: str | None) -> dict:
    """Trigger arguments: "5 seconds" or "1 minute"; None takes what is there and stops.

    Any other unit is refused right away rather than when the stream starts.
    """
    if interval is None:
        return {"availableNow": True}
    count = INTERVAL.search(interval)
    for unit in ("second", "minute"):
        if count and unit in interval.lower():
            return {"processingTime": f"{int(count.group())} {unit}s"}
    raise ValueError(f"not an interval in seconds or minutes: {interval!r}")


def batch_stream(
    rows: DataFrame,
    write: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    *,
    interval: str | None,
    name: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Start a stream that gives each micro-batch to ``write(batch, run, number)``.

    ``run`` tells the checkpoint from others that write to the same table.
    """
    fallback = hashlib.sha256(checkpoint.encode()).hexdigest()[:32]

    def each(batch: DataFrame, number: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write(batch, run or fallback, number)

    writer = (
        rows.writeStream.foreachBatch(each)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(interval))
    )
    if name:
        writer = writer.queryName(name)
    return writer.start()


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = (),
    interval: str | None = "5 seconds",
    name: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Start a stream that appends rows to a Parquet table exactly once, batch by batch."""

    def write(batch: DataFrame, run: str, number: int) -> None:
        write_batch(batch, path, run, number, partition_by)

    return batch_stream(
        rows, write, checkpoint, interval=interval, name=name, output_mode=output_mode
    )

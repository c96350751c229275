"""The three refinement streams. Each returns its running query.

The first two observe what they write; ``progress.Counts`` adds it up.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sievelake import schemas
from sievelake.operators import bronze as bronze_rules
from sievelake.operators import silver as silver_rules
from sievelake.settings import COMPACT_EVERY_BATCHES, TRIGGERS
from sievelake.sinks.append import append_stream, batch_stream
from sievelake.sources import layers
from sievelake.streaming import gold_table, progress
from sievelake.tables.batches import BATCH, open_view
from sievelake.tables.catalog import ensure_table

log = logging.getLogger(__name__)


def bronze(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    interval: str | None = TRIGGERS["bronze"],
    name: str = "bronze_stream",
    properties: Mapping[str, str] | None = None,
    as_of=None,
) -> StreamingQuery:
    """Messages to the raw table, partitioned by ingestion date within each batch.

    ``bronze.domains`` in the catalog shows it from the start.
    """
    ensure_table(messages.sparkSession, path, schemas.BRONZE, [*BATCH, "ingestion_date"])
    open_view(messages.sparkSession, "bronze.domains", path, schemas.BRONZE, properties)
    return append_stream(
        bronze_rules.transform(messages, as_of).observe("bronze", *progress.bronze_counts()),
        path,
        checkpoint,
        partition_by=["ingestion_date"],
        interval=interval,
        name=name,
    )


def silver(
    spark: SparkSession,
    bronze_path: str,
    path: str,
    checkpoint: str,
    *,
    interval: str | None = TRIGGERS["silver"],
    name: str = "silver_stream",
    max_files_per_trigger: int | None = None,
    properties: Mapping[str, str] | None = None,
    as_of=None,
) -> StreamingQuery:
    """Raw table to the cleaned and flagged table, partitioned by ingestion date in each batch.

    ``silver.domains`` in the catalog shows it from the start.
    """
    ensure_table(spark, path, schemas.SILVER, [*BATCH, "ingestion_date"])
    open_view(spark, "silver.domains", path, schemas.SILVER, properties)
    rows = layers.table_stream(spark, bronze_path, schemas.BRONZE, max_files_per_trigger)
    return append_stream(
        silver_rules.transform(rows, as_of).observe("silver", *progress.silver_counts()),
        path,
        checkpoint,
        partition_by=["ingestion_date"],
        interval=interval,
        name=name,
    )


def gold(
    spark: SparkSession,
    silver_path: str,
    path: str,
    checkpoint: str,
    *,
    interval: str | None = TRIGGERS["gold"],
    name: str = "gold_stream",
    max_files_per_trigger: int | None = None,
    published: str | None = None,
    publish_every: int = COMPACT_EVERY_BATCHES,
    buckets: int | None = None,
    as_of=None,
) -> StreamingQuery:
    """Valid rows of the cleaned table to the states of the per-domain table.

    The stream keeps no state: each micro-batch writes its own mergeable states, so a replay
    changes nothing and late rows simply fold in. ``gold.domains`` in the catalog shows them
    folded from the start. With a folder for ``published`` versions, a new one is written there every
    ``publish_every`` batches, as ``gold_table.publish`` does; otherwise run that as a job of its own.
    """
    gold_table.open_view(spark, path, as_of)

    def write(batch: DataFrame, run: str, number: int) -> None:
        gold_table.append(batch, path, run, number, as_of)
        if published and (number + 1) % publish_every == 0:
            try:
                gold_table.publish(spark, path, published, buckets=buckets, as_of=as_of)
            except Exception:
                # The states are complete without it; the next version folds more.
                log.exception("publishing %s up to batch %d failed", path, number)

    return batch_stream(
        layers.valid_silver_stream(spark, silver_path, max_files_per_trigger),
        write,
        checkpoint,
        interval=interval,
        name=name,
        output_mode="update",
    )

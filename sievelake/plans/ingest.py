"""One ingest run: landed list files to published messages and statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sievelake.operators import lists, messages, stats, validate
from sievelake.sinks.append import batch_stream
from sievelake.sinks.publish import publish
from sievelake.sources import files
from sievelake.tables import folders

# Bytes of the written entries that one task ranks, and of their row groups. A row is some 20
# bytes in a file and 400 in a sort.
SPLIT_BYTES, ROW_GROUP_BYTES = 16 << 20, 8 << 20


@contextmanager
def _split(spark: SparkSession, size: int) -> Iterator[None]:
    """Files are read in splits of at most ``size`` bytes by actions that start within."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass
class Ingest:
    """The frames of a run. After ``run`` they read what it wrote, not the landing folder."""

    entries: DataFrame
    failures: DataFrame
    valid: DataFrame
    messages: DataFrame
    statistics: DataFrame
    published: DataFrame
    validation: DataFrame


def plan(
    numbered: DataFrame,
    documents: DataFrame,
    registry: DataFrame,
    as_of=None,
    keep: Callable[[str, DataFrame], DataFrame] = lambda _, frame: frame,
) -> Ingest:
    """Parse, validate, route and count numbered lines and their documents.

    ``keep`` may write the entries and the valid ones, and return them as read back.
    """
    entries = keep("entries", lists.parse(numbered, registry, as_of))
    failures = lists.failures(documents, registry)
    valid = keep("valid", validate.clean_and_validate(entries, named=True))
    return Ingest(
        entries=entries,
        failures=failures,
        valid=valid,
        messages=messages.to_messages(valid),
        statistics=stats.run(entries, failures, named=True),
        published=stats.publish(valid),
        validation=stats.validation(entries, named=True),
    )


def run(
    spark: SparkSession,
    landing: str,
    registry: DataFrame,
    *,
    manifest: DataFrame | None = None,
    kafka: dict[str, str] | None = None,
    path: str | None = None,
    work: str | None = None,
    as_of=None,
) -> Ingest:
    """Ingest a landing folder and publish to Kafka (options) or to a folder.

    The lines are read and parsed once into ``work`` (by default a folder in the shared
    one). Messages come from there. Entries are counted by the writes themselves, in their
    last stage, where each task counts once. While valid entries are ranked, the session reads files
    in smaller splits; do not scan lists in it at that time.
    """
    landed = files.scan_lists(spark, landing, manifest)
    work = work or folders.scratch(spark, "ingest")

    counts = {"entries": stats.entry_counts(), "valid": stats.valid_counts()}
    seen: dict[str, int] = {}

    def keep(name: str, frame: DataFrame) -> DataFrame:
        observed = Observation(name)
        writer = frame.observe(observed, *counts[name]).write.option("parquet.block.size", str(ROW_GROUP_BYTES))
        # Valid entries are ranked from written ones; lists are read as they were counted.
        with _split(spark, SPLIT_BYTES) if name == "valid" else nullcontext():
            writer.parquet(f"{work}/{name}")
        seen.update(observed.get)
        return spark.read.schema(frame.schema).parquet(f"{work}/{name}")

    job = plan(landed.lines, landed.documents, registry, as_of, keep)
    job = replace(
        job,
        statistics=stats.observed_run(job.entries, job.failures, seen),
        validation=stats.observed_validation(job.entries, seen),
    )
    publish(job.messages, kafka=kafka, path=path)
    return job


def stream(
    spark: SparkSession,
    landing: str,
    registry: DataFrame,
    checkpoint: str,
    *,
    manifest: DataFrame | None = None,
    kafka: dict[str, str] | None = None,
    path: str | None = None,
    interval: str | None = "1 minute",
    max_files_per_trigger: int | None = None,
    as_of=None,
) -> StreamingQuery:
    """Publish lists as they land, to Kafka (options) or to a folder.

    A micro-batch is a set of files, whose names alone pass the driver; their lines are read
    in splits, so a large file is many tasks. The first entry of a domain and source counts
    within a batch; later batches may send it again, and gold folds it. Messages are sent at
    least once: a batch that failed half-way is sent anew.
    """

    def send(batch: DataFrame, _run: str, _number: int) -> None:
        only = [row["path"] for row in batch.select("path").distinct().collect()]
        if not only:
            return
        session = batch.sparkSession
        landed = files.scan_lists(session, landing, manifest, only)
        try:
            valid = validate.clean_and_validate(lists.parse(landed.lines, registry, as_of), named=True)
            publish(messages.to_messages(valid), kafka=kafka, path=path)
        finally:
            folders.delete(session, landed.starts)

    landed_files = files.arrivals(spark, landing, max_files_per_trigger)
    return batch_stream(landed_files, send, checkpoint, interval=interval)

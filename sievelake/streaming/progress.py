"""Counts of running streams, taken from the progress of their micro-batches.

The streams observe their rows while they write them, so nothing is read again to count.
"""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


def bronze_counts() -> list[Column]:
    """Rows written, and those whose message could not be read."""
    return [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("domain").isNull()).alias("unreadable")]


def silver_counts() -> list[Column]:
    """Rows written, valid and invalid."""
    valid = F.col("is_valid") == "true"
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("invalid"),
    ]


class Counts(StreamingQueryListener):
    """Adds up the observed counts of each run of a stream.

    Counts are as exact as Spark's accumulators: a batch that is tried again counts once, as
    only a batch that succeeds has progress, but a task that is computed again within a batch,
    after an executor with its shuffle files was lost, counts again. They are for monitoring;
    ``stats`` counts tables.
    """

    def __init__(self) -> None:
        self._added: dict[str, dict[str, Counter]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            added = self._added.setdefault(str(progress.runId), {}).setdefault(name, Counter())
            added.update({k: v or 0 for k, v in row.asDict().items()})

    def onQueryIdle(self, event) -> None:
        """Nothing was counted."""

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def of(self, query: StreamingQuery, timeout: float = 60) -> dict[str, dict[str, int]]:
        """What a stream that has ended observed, by the name of the observation."""
        run = str(query.runId)
        if not self._end(run).wait(timeout):
            raise TimeoutError(f"no word of the end of stream {run}")
        return {name: dict(added) for name, added in self._added.get(run, {}).items()}

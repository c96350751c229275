"""The registry of list sources as a small dimension table."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sievelake.schemas import REGISTRY
from sievelake.settings import DEFAULT_SOURCES


def registry(
    spark: SparkSession,
    sources: Mapping[str, Mapping[str, str]] = DEFAULT_SOURCES,
    only: str | None = None,
) -> DataFrame:
    """One row per source; ``only`` selects a single one.

    Built from an Arrow table, whose size Spark knows: joins broadcast it while it is
    below the session's threshold and shuffle beyond that.
    """
    if only is not None:
        sources = {only: sources[only]}
    names = REGISTRY.fieldNames()
    columns = {
        name: [source if name == "source" else row.get(name) for source, row in sources.items()]
        for name in names
    }
    table = pa.table({name: pa.array(values, pa.string()) for name, values in columns.items()})
    return spark.createDataFrame(table, REGISTRY)

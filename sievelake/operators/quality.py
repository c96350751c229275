"""Freshness, required columns and the health roll-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelake.functions.times import moment


def freshness(
    table: DataFrame, layer: str, stamp: str, max_age_minutes: int, as_of=None
) -> DataFrame:
    """One row (layer, latest, fresh); an empty table is not fresh."""
    oldest = moment(as_of) - F.expr(f"INTERVAL {int(max_age_minutes)} MINUTES")
    return table.agg(F.max(stamp).alias("latest")).select(
        F.lit(layer).alias("layer"),
        "latest",
        F.coalesce(F.col("latest") >= oldest, F.lit(False)).alias("fresh"),
    )


def not_null(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values per required column (column_name, nulls), in one pass."""
    counted = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "nulls")


def health(components: DataFrame) -> DataFrame:
    """Roll-up of (component, healthy): all_healthy, failed_count, failed (sorted JSON).

    A missing flag counts as failed; no component at all counts as unhealthy. Components
    are services or sources, so the list of failed ones is short.
    """
    down = ~F.coalesce(F.col("healthy"), F.lit(False))
    return components.agg(
        F.coalesce(F.bool_and(~down), F.lit(False)).alias("all_healthy"),
        F.count_if(down).alias("failed_count"),
        F.to_json(F.sort_array(F.collect_set(F.when(down, F.col("component"))))).alias("failed"),
    )

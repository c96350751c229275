"""Compaction, clustering, statistics and clean-up of Parquet tables.

Rewrites go to a new folder; point readers there with ``catalog.register_table(...,
replace=True)``. Running readers and streams keep the folder they started on.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievelake.settings import VACUUM_RETENTION_HOURS
from sievelake.sources.layers import table
from sievelake.tables import folders


# Bytes of input that make one file of a clustered table.
FILE_BYTES = 256 << 20
# Rows of the sample that ranges are cut by, and ranges of a column at most.
SAMPLE, MOST_RANGES = 4096, 256


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    target: str,
    partition_by: Sequence[str] = (),
) -> None:
    """Rewrite a table into files of the session's advisory partition size.

    Rebalancing splits a partition value that holds most of the rows over many tasks and
    merges small ones, unlike a repartition by value.
    """
    rows = table(spark, path, schema)
    if partition_by:
        rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(target)
    else:
        rows.hint("rebalance").write.parquet(target)


def cluster(
    spark: SparkSession,
    path: str,
    schema: StructType,
    target: str,
    columns: Sequence[str] = ("domain",),
    files: int | None = None,
) -> None:
    """Rewrite a table clustered by ``columns``, so that lookups skip files by their min/max.

    Rows are sorted by one column, and along a space-filling curve by several: it runs
    through the table in even slabs of one column, through each slab in slabs of the next,
    and back and forth, and files are cut from it. A lookup on any of k columns then opens
    about files**(1 - 1/k), however the columns depend on each other.
    Without ``files`` there are as many as give each ``FILE_BYTES`` of the input. The row
    id as last range column splits a value that fills more than one file.
    """
    files = files or max(1, -(-folders.size(spark, path) // FILE_BYTES))
    rows = table(spark, path, schema).withColumn("_id", F.monotonically_increasing_id())
    order = [F.col(c) for c in columns]
    if len(columns) > 1:
        order = [_curve(rows, columns, files)]
    ranged = rows.repartitionByRange(files, *order, F.col("_id"))
    ranged.sortWithinPartitions(*order, *columns).drop("_id").write.parquet(target)


def _curve(rows: DataFrame, columns: Sequence[str], files: int) -> Column:
    """The place of a row on the curve: the numbers of its ranges, each first one the slowest.

    Every other slab is run through backwards, so a file that holds the end of one slab and the
    start of the next spans a short piece of the column behind. The ranges come from a
    random sample of ``SAMPLE`` rows; it shapes files, not rows.
    """
    slabs = min(MOST_RANGES, max(1, round(files ** (1 / len(columns)))))
    sample = rows.select(*columns).orderBy(F.rand(SAMPLE)).limit(SAMPLE).collect()
    place = F.lit(0).cast("long")
    for c in columns:
        # Files are cut anywhere in the last column, so it is told finely.
        n = MOST_RANGES if c == columns[-1] else slabs
        values = sorted(r[c] for r in sample if r[c] is not None)
        cuts = sorted({values[i * len(values) // n] for i in range(1, n)}) if values else []
        kind = rows.schema[c].dataType
        number = F.when(F.col(c).isNull(), 0).otherwise(_range(F.col(c), [F.lit(v).cast(kind) for v in cuts], 0))
        turned = F.when(place % 2 == 0, number).otherwise(n - 1 - number)
        place = place * n + turned
    return place


def _range(value: Column, cuts: Sequence[Column], before: int) -> Column:
    """How many of the sorted cuts are at most the value, found by halving."""
    if not cuts:
        return F.lit(before).cast("long")
    half = len(cuts) // 2
    return F.when(value < cuts[half], _range(value, cuts[:half], before)).otherwise(
        _range(value, cuts[half + 1 :], before + half + 1)
    )


def lookups(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, files, opened)`` of a table as read from its files.

    ``opened`` is the number of files whose min and max admit a value, on average over the
    values of all rows. The spans of the files travel to the rows as one array for each column.
    """
    file = F.col("_metadata.file_path")
    spans = rows.groupBy(file).agg(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns])
    all_spans = spans.agg(*[F.collect_list(c).alias(f"_{c}") for c in columns], F.count("*").alias("files"))

    def admitted(c: str) -> Column:
        return F.size(F.filter(f"_{c}", lambda s: (s["low"] <= F.col(c)) & (F.col(c) <= s["high"])))

    # One row of spans: what it holds is bounded by the number of files.
    seen = rows.select(*columns).join(F.broadcast(all_spans), F.lit(True))
    means = seen.agg(F.any_value("files").alias("files"), *[F.avg(admitted(c)).alias(c) for c in columns])
    return means.unpivot("files", list(columns), "column", "opened").select("column", "files", "opened")


def table_statistics(spark: SparkSession, path: str) -> DataFrame:
    """One row: table_path, row_count, file_count, last_written, error.

    Counting reads no column. A path that is no table gives the error instead of failing.
    """
    try:
        rows = spark.read.parquet(path).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_modification_time").alias("written"),
        )
    except Exception as problem:
        reason = str(problem).splitlines()[0]
        return spark.range(1).select(
            F.lit(path).alias("table_path"),
            F.lit(None).cast("bigint").alias("row_count"),
            F.lit(None).cast("bigint").alias("file_count"),
            F.lit(None).cast("timestamp").alias("last_written"),
            F.lit(reason).alias("error"),
        )
    per_file = rows.groupBy("file").agg(
        F.count("*").alias("n"), F.max("written").alias("written")
    )
    return per_file.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count("*").alias("file_count"),
        F.max("written").alias("last_written"),
    ).select(
        F.lit(path).alias("table_path"),
        "row_count",
        "file_count",
        "last_written",
        F.lit(None).cast("string").alias("error"),
    )


def vacuum(
    spark: SparkSession,
    superseded: Sequence[str],
    retention_hours: float = VACUUM_RETENTION_HOURS,
) -> list[str]:
    """Delete superseded folders last written before the retention; returns those."""
    limit = time.time() - retention_hours * 3600
    old = [p for p in superseded if folders.modified(spark, p) < limit]
    for path in old:
        folders.delete(spark, path)
    return old

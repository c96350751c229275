"""Tables that grow by whole folders, one per micro-batch, and what readers see of them.

A batch table is a Parquet folder partitioned by the stream that wrote it and its batch,
before anything else. Its name in the catalog is a persistent view, which ``compact`` points to fewer
and larger files; the batches themselves stay for the streams that read them.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sievelake.tables import catalog, folders

BATCH = ("run", "batch_id")
# The run of batches that compactions write.
COMPACTED = "compacted"


def write_batch(
    rows: DataFrame, path: str, run: str, number: int, partition_by: Sequence[str] = ()
) -> bool:
    """Write one micro-batch to its own folder; False if it is there already.

    Rows are rebalanced on ``partition_by``, so small dates share a task and one that holds most of
    the batch is split at the session's advisory partition size. The folder is written aside
    and moved into place by one rename, so readers see all of a batch or nothing, and a
    replayed batch, which has the same rows, leaves the first one as it is. On a store without such a
    rename readers may see part of a batch while it is moved.
    """
    spark = rows.sparkSession
    place = f"{path}/{BATCH[0]}={run}/{BATCH[1]}={number}"
    if folders.exists(spark, place):
        return False
    aside = f"{path}/_writing/{run}-{number}"
    writer = rows.hint("rebalance", *partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(aside)
    folders.move(spark, aside, place)
    return True


def last_batches(spark: SparkSession, path: str) -> dict[str, int]:
    """The last batch of each run, out of the names of folders."""
    last: dict[str, int] = {}
    for place in folders.glob(spark, f"{path}/{BATCH[0]}=*/{BATCH[1]}=*"):
        run, number = (part.split("=", 1)[1] for part in place.rstrip("/").split("/")[-2:])
        if int(number) >= 0:
            last[run] = max(int(number), last.get(run, -1))
    return last


def between(after: Mapping[str, int], upto: Mapping[str, int] | None = None) -> str:
    """SQL condition for batches that come after some, and up to others; it prunes folders."""
    wanted = ["batch_id >= 0"]
    wanted += [f"NOT (run = '{run}' AND batch_id <= {last})" for run, last in after.items()]
    if upto is not None:
        ends = [f"(run = '{run}' AND batch_id <= {last})" for run, last in upto.items()]
        wanted.append(f"({' OR '.join(ends) or 'false'})")
    return " AND ".join(wanted)


def upto_folders(spark: SparkSession, path: str, last: Mapping[str, int]) -> list[str]:
    """Folders of the batches up to the last one of each run."""
    return [
        place
        for run, number in last.items()
        for place in folders.glob(spark, f"{path}/{BATCH[0]}={run}/{BATCH[1]}=*")
        if int(place.rstrip("/").rsplit("=", 1)[-1]) <= number
    ]


def open_view(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType,
    properties: Mapping[str, str] | None = None,
) -> str:
    """A name in the catalog for a batch table, empty or not; returns it.

    The view lists folders anew for each query, and filters on dates prune them. One that is
    there for the same folder keeps what has been compacted.
    """
    found = catalog.properties_of(spark, name)
    kept = {k: found[k] for k in ("into", "folded", "compactions") if found.get("batches") == path and k in found}
    return _point(spark, name, path, schema, {**(properties or {}), **kept})


def _point(spark: SparkSession, name: str, path: str, schema: StructType, properties: Mapping[str, str]) -> str:
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
    folded = json.loads(properties.get("folded", "{}"))
    query = f"SELECT {columns} FROM {catalog.folder(path)} WHERE {between(folded)}"
    if "into" in properties:
        done = between({}, {COMPACTED: int(properties["compactions"]) - 1})
        query = f"SELECT {columns} FROM {catalog.folder(properties['into'])} WHERE {done} UNION ALL {query}"
    return catalog.create_view(spark, name, query, {**properties, "batches": path})


def compact(
    spark: SparkSession, name: str, schema: StructType, target: str, partition_by: Sequence[str] = ()
) -> list[str]:
    """Rewrite the batches that came since the last time into few files, for readers of ``name``.

    The view then reads the new files in place of those batches, and later batches as they
    come; queries that run keep what they began to read, and streams go on reading batches.
    Returns the folders that the name no longer reads, for ``upkeep.vacuum`` once no stream needs them.
    """
    found = catalog.properties_of(spark, name)
    path, folded = found["batches"], json.loads(found.get("folded", "{}"))
    upto = last_batches(spark, path)
    number = int(found.get("compactions", 0))
    newer = spark.sql(f"SELECT * FROM {catalog.folder(path)} WHERE {between(folded, upto)}")
    # What a compaction that failed before its end left there is not seen, and written anew.
    folders.delete(spark, f"{target}/{BATCH[0]}={COMPACTED}/{BATCH[1]}={number}")
    write_batch(newer.select(*schema.fieldNames()), target, COMPACTED, number, partition_by)
    own = {k: v for k, v in found.items() if k not in ("batches", "into", "folded", "compactions") and "." not in k}
    state = {"into": target, "folded": json.dumps({**folded, **upto}), "compactions": str(number + 1)}
    _point(spark, name, path, schema, {**own, **state})
    return upto_folders(spark, path, {**folded, **upto})

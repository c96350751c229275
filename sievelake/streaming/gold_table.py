"""The per-domain table: states of each micro-batch, and published versions of their fold.

A stream writes the states of every micro-batch to a folder of its own in a plain Parquet
table. ``publish`` is a batch job that joins the last published version with the batches since,
into a new version, bucketed and sorted by domain. The view that readers use joins the
version with the batches after it in the same way when it is read, so it is never behind.
What a version holds stands in its table properties.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from sievelake import schemas
from sievelake.operators import gold
from sievelake.tables import catalog, folders
from sievelake.tables.batches import BATCH, between, last_batches, upto_folders, write_batch

VIEW = "gold.domains"
# Rows of a version's row groups, between which a lookup by Bloom filter chooses.
ROW_GROUP_BYTES = 16 << 20


@dataclass(frozen=True)
class Version:
    """A published table and, for each run, the last batch that is in it."""

    path: str | None = None
    table: str | None = None
    buckets: int = 0
    folded: Mapping[str, int] = field(default_factory=dict)


def append(batch: DataFrame, path: str, run: str, number: int, as_of=None) -> None:
    """Write the states of one micro-batch; a replayed one changes nothing."""
    write_batch(gold.partial(batch, as_of), path, run, number)


def current(spark: SparkSession, path: str, view: str = VIEW) -> Version:
    """The version that a view over the states in ``path`` stands on, if any."""
    found = catalog.properties_of(spark, view)
    if found.get("states") != path or not found.get("version"):
        return Version()
    version = catalog.properties_of(spark, found["version"])
    return Version(version["folder"], found["version"], int(version["buckets"]), json.loads(version["folded"]))


def _newer(path: str, version: Version, upto: Mapping[str, int] | None = None) -> str:
    """SQL of the rows of batches that are not in the version, and not after ``upto``.

    The filter prunes folders.
    """
    rows = f"FROM {catalog.folder(path)} WHERE {between(version.folded, upto)}"
    # Cut as the buckets are, so that a join finds both sides in place.
    hint = f"/*+ REPARTITION({version.buckets}, domain) */" if version.table else ""
    fold = ", ".join(gold.FOLDED)
    return f"(SELECT domain, {fold} FROM (SELECT {hint} * {rows}) GROUP BY domain)"


def _folded(path: str, version: Version, upto: Mapping[str, int]) -> str:
    """SQL of the states to publish. The version is read in its buckets, and not shuffled."""
    newer = _newer(path, version, upto)
    if version.table is None:
        return f"SELECT * FROM {newer}"
    columns = ", ".join(gold.COMBINED)
    return f"SELECT {columns} FROM {version.table} l FULL OUTER JOIN {newer} r ON l.domain = r.domain"


def _present(path: str, version: Version) -> str:
    """SQL of the states to read: the same rows, of domains in the version and others apart.

    So a filter on the domain reaches both scans, which no full join would let through.
    """
    newer = _newer(path, version)
    if version.table is None:
        return f"SELECT * FROM {newer}"
    columns = ", ".join(["l.domain", *gold.COMBINED[1:]])
    return f"""
        SELECT {columns} FROM {version.table} l LEFT JOIN {newer} r ON l.domain = r.domain
        UNION ALL
        SELECT r.* FROM {newer} r LEFT ANTI JOIN {version.table} l ON l.domain = r.domain"""


def open_view(spark: SparkSession, path: str, as_of=None, view: str = VIEW) -> str:
    """Make the states in ``path`` readable as the per-domain table, as they are at any time.

    Without ``as_of`` activity is judged when the view is read.
    """
    catalog.ensure_table(spark, path, schemas.GOLD_PARTIAL, BATCH)
    return _point(spark, path, current(spark, path, view), as_of, view)


def _point(spark: SparkSession, path: str, version: Version, as_of, view: str) -> str:
    names = ", ".join(gold.finished(as_of))
    kept = {"states": path, "version": version.table or ""}
    return catalog.create_view(spark, view, f"SELECT {names} FROM ({_present(path, version)})", kept)


def read(spark: SparkSession, path: str, as_of=None, view: str = VIEW) -> DataFrame:
    """The per-domain table in its published columns, every batch so far included."""
    return spark.table(open_view(spark, path, as_of, view))


def publish(
    spark: SparkSession,
    path: str,
    target: str,
    *,
    buckets: int | None = None,
    as_of=None,
    view: str = VIEW,
) -> Version:
    """Fold all batches so far into a new version below ``target``, and point the view to it.

    Rows are sorted by domain in their buckets, with a Bloom filter on it in every row group, so that a
    lookup of one name opens one bucket and, for a name that is not there, reads no row.
    ``buckets`` should put a few hundred MB in each; it defaults to those of the version
    before, or the shuffle partitions. Readers of the version before keep its files;
    ``superseded`` lists them.
    """
    before = current(spark, path, view)
    buckets = buckets or before.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    upto = last_batches(spark, path)
    states = spark.sql(_folded(path, before, upto))
    if buckets != before.buckets:
        states = states.repartition(buckets, "domain")
    database = view.split(".")[0]
    name = f"version_{uuid.uuid4().hex}"
    table, place = f"`{database}`.`{name}`", f"{target}/{name}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{database}`")
    (
        states.write.bucketBy(buckets, "domain")
        .sortBy("domain")
        .option("parquet.bloom.filter.enabled#domain", "true")
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .option("path", place)
        .saveAsTable(table)
    )
    folded = {**before.folded, **upto}
    kept = {"folder": place, "buckets": str(buckets), "folded": json.dumps(folded)}
    catalog.set_properties(spark, table, kept)
    version = Version(place, table, buckets, folded)
    _point(spark, path, version, as_of, view)
    if before.table:
        spark.sql(f"DROP TABLE IF EXISTS {before.table}")
    return version


def superseded(spark: SparkSession, path: str, target: str, view: str = VIEW) -> list[str]:
    """Folders that the view no longer reads: earlier versions, and batches in the present one.

    ``upkeep.vacuum`` deletes them by age. With a catalog that does not outlive the session keep the
    batches, since the version would be forgotten.
    """
    now = current(spark, path, view)
    versions = [p for p in folders.glob(spark, f"{target}/version_*") if now.table and not p.endswith(now.path.rsplit("/", 1)[-1])]
    return versions + upto_folders(spark, path, now.folded)

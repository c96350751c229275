"""Shared pieces: tables in the shared folder, groups split evenly, connected components."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_own_folder: str | None = None
_written: dict = {}
_shipped: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    global _own_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    _own_folder = _own_folder or tempfile.mkdtemp(prefix="llm-shared-")
    return _own_folder


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once as Parquet to the shared folder and read from there.

    A lost executor costs no more than the rows are read again. The table is deleted when
    the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    _written[path] = (place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()))
    found = spark.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def discarded(df: DataFrame) -> None:
    """Deletes a table that ``stored`` returned, once nothing is to read it any more."""
    place, system = _written.pop(df.stored_at)
    system.delete(place, True)


def on_workers(spark: SparkSession) -> None:
    """Sends this package to the executors, so that it need not be installed there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="llm-package-"), "sievelake_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


@atexit.register
def _delete_written() -> None:
    for place, system in _written.values():
        try:
            system.delete(place, True)
        except Exception:  # the JVM may have ended before
            return


def fresh(label: str) -> str:
    """A column name that no caller's table has."""
    return f"_{label}_{uuid.uuid4().hex}"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    """True for rows whose labels are kept from training; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# More rows than these are not gathered at the driver for a join.
FEW = 100_000


def by_merge(facts: DataFrame, total: int | None = None) -> DataFrame:
    """``facts`` for a join that leaves them in their tasks, unless they are few of ``total``.

    Spark guesses their size from the compressed file far behind them, whatever a Python step
    or an explode makes of its rows. By that guess it would send millions through the driver.
    """
    return facts if total is not None and total <= FEW else facts.hint("merge")


def dealt(rows: DataFrame, key: str, order: str, limit: int, weight: str | None = None) -> DataFrame:
    """``rows`` of keys that occur at least twice, with columns ``part_a, part_b, own``.

    The rows of a key are cut by a hash of ``order`` into pieces of about ``limit`` rows,
    or of rows whose ``weight`` adds up to about ``limit``, and each two pieces meet in one part. Two rows of a key meet in one part only: that of
    their piece if ``part_a = part_b``, else that where their ``own`` differ. So a hot key
    becomes many tasks of bounded size, and no pair of rows is lost.
    """
    sizes = (
        rows.groupBy(key)
        .agg(F.count("*").alias("_n"), (F.sum(weight) if weight else F.count("*")).alias("_load"))
        .filter("_n > 1")
        .select(key, F.ceil(F.col("_load") / limit).cast("int").alias("_pieces"))
    )
    piece = F.pmod(F.xxhash64(F.col(order)), F.col("_pieces")).cast("int")
    return (
        rows.join(by_merge(sizes), key)
        .withColumn("own", piece)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
        .withColumn("part_a", F.least("own", "_other"))
        .withColumn("part_b", F.greatest("own", "_other"))
        .drop("_pieces", "_other")
    )


# A key of more than this share of all rows is hot; there are fewer such keys than this.
HOT_SHARE = 1000


def looked_up(rows: DataFrame, facts: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``rows`` with the other columns of ``facts``, which has one row for each key of ``rows``.

    ``count`` tells how many of at most ``total`` rows have the key. The facts of hot keys,
    at most ``HOT_SHARE`` of them, are broadcast and their rows dealt out by a hash of the
    row, so that no key gathers in one task; all others are joined by key.
    """
    names = [c for c in facts.columns if c not in (key, count)]
    hot = F.col(count) * HOT_SHARE > F.lit(total)
    own, salt, mark = {c: fresh(c) for c in names}, fresh("salt"), fresh("hot")
    frequent = facts.filter(hot).select(key, F.lit(True).alias(mark), *[F.col(c).alias(own[c]) for c in names])
    others = facts.filter(~hot).select(key, *names, F.lit(0).alias(salt))
    turn = F.pmod(F.xxhash64(*rows.columns), F.lit(HOT_SHARE)).cast("int") + 1
    return (
        rows.join(F.broadcast(frequent), key, "left")
        .withColumn(salt, F.when(F.col(mark), turn).otherwise(0))
        .join(by_merge(others, total), [key, salt], "left")
        .select(*rows.columns, *[F.coalesce(F.col(own[c]), F.col(c)).alias(c) for c in names])
    )


PART = ["part_a", "part_b"]


def by_part(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Dealt rows, each part whole in one partition and in order."""
    return rows.repartition(key, *PART).sortWithinPartitions(key, *PART, order)


def whole_groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches of a sorted partition, cut anew so that no group spans two of them."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        if held:
            last = held[-1][keys].iloc[-1]
            same = np.logical_and.reduce([(frame[k] == last[k]).to_numpy() for k in keys])
            if same.all():
                held.append(frame)
                continue
        first_of_last = np.logical_and.reduce(
            [(frame[k] == frame[k].iloc[-1]).to_numpy() for k in keys]
        ).argmax()
        ready = pd.concat([*held, frame.iloc[:first_of_last]], ignore_index=True)
        if len(ready):
            yield ready
        held = [frame.iloc[first_of_last:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def group_numbers(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """0, 1, 2 ... for the groups of a sorted frame."""
    new = np.zeros(len(frame), bool)
    for k in keys:
        column = frame[k].to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


class Forest:
    """Union-find over row numbers; the root of a tree is its least row."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, rows: np.ndarray) -> np.ndarray:
        found = self.parent[rows]
        while True:
            up = self.parent[found]
            if (up == found).all():
                return found
            found = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        self.parent = self.roots(np.arange(len(self.parent)))
        a, b = self.parent[a], self.parent[b]
        apart = a != b
        parent = self.parent
        for x, y in set(zip(a[apart].tolist(), b[apart].tolist(), strict=True)):
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            if x != y:
                parent[max(x, y)] = min(x, y)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Each row that is no root, and its root."""
        root = self.roots(np.arange(len(self.parent)))
        child = np.flatnonzero(root != np.arange(len(root)))
        return child, root[child]


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of each node in ``links (a, b)``; ``root`` is the least linked node.

    Large-star and small-star steps in turn until nothing changes; the number of rounds
    grows with the logarithm of the longest chain. Every step is a minimum that combines
    before its shuffle and a join that deals out the links of a hub, so the links of one node
    are never gathered in one task.
    """
    edges = stored(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    mark, total = None, edges.count()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count_if(F.col("v") > F.col("u")).alias("links"))
        large = (
            looked_up(both.filter("v > u"), least, "u", "links", total)
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("links"))
        small = (
            looked_up(large, low, "u", "links", total)
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                      F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .filter("u <> v")
            .distinct()
        )
        edges = stored(small)
        now = edges.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if now == mark:
            break
        mark, total = now, now["n"]
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())

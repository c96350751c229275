"""Mixing sources to target weights by weighted fair queueing.

The documents of each source are shuffled. Copy ``e`` of a document finishes at the source's
words up to its end, ``(e - 1) * source size`` included, over the source's target: its
virtual finish time. All copies are ranged by that time and cut off at the total budget.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievelake.llm.common import fresh, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
# A source's shuffled rows are summed in this many slices before running totals are taken,
# and virtual time in slices of 1/1024: no total over a source or over all runs in one task.
SLICE_DIGITS = 3
TIME_SLICES = 1024


def size_of(text: Column) -> Column:
    """Words of a text: runs without ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column) -> Column:
    """The place of a document among those of its source: the same in every run."""
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 16)


def targets(sources: DataFrame, share: float, epochs: int, weights: tuple[float, ...]) -> DataFrame:
    """``(source, source_size, target)`` out of ``(source, source_size)``.

    Sources by code point, null last, take the weights in turn and share ``share`` of all
    sizes; a target stops at ``epochs`` times its source's size and the excess is shared
    anew by weight. Read in the order of ``size / weight``, the sources that stop come
    first, so one running total finds them. One row per source is ranked in one task.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    order = W.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cap = F.col("source_size") * F.lit(epochs)
    return (
        sources.withColumn("weight", weight)
        .withColumn("ratio", cap / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(after))
        .withColumn("level", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(whole))
        .select("source", "source_size", F.coalesce(F.least(cap.cast("double"), F.col("weight") * F.col("level")), cap.cast("double")).alias("target"))
    )


def mix(
    docs: DataFrame,
    share: float = 1.5,
    epochs: int = 2,
    weights: tuple[float, ...] = WEIGHTS,
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for each row of ``docs``.

    ``taken`` is the document's size times the copies that the mix takes, 0 to ``epochs``.
    A null source is a source of its own; a null or empty text has size 0 and nothing is
    taken of it; a source without words has target 0. Documents with the same place go by
    doc_id, then size, so a rerun takes the same. Other columns are ignored.
    """
    return _mixed(docs, share, epochs, weights).drop("text_hash")


def taken_documents(
    docs: DataFrame,
    share: float = 1.5,
    epochs: int = 2,
    weights: tuple[float, ...] = WEIGHTS,
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with ``size, source_size, target, taken``.

    Columns of these names give way. Rows with the same id and text get the largest
    ``taken`` of them.
    """
    added = ["size", "source_size", "target", "taken"]
    takes = _mixed(docs, share, epochs, weights).groupBy("doc_id", "text_hash").agg(*[F.max(c).alias(c) for c in added])
    own_id, own_hash = fresh("id"), fresh("hash")
    takes = takes.filter("taken > 0").withColumnsRenamed({"doc_id": own_id, "text_hash": own_hash})
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(own_hash))
    return docs.drop(*added).join(takes, same).drop(own_id, own_hash)


def _mixed(
    docs: DataFrame,
    share: float,
    epochs: int,
    weights: tuple[float, ...],
) -> DataFrame:
    place = F.col("place")
    sized = stored(
        docs.select(
            "doc_id",
            "source",
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
            shuffle_key(F.col("doc_id")).alias("place"),
            size_of(F.col("text")).alias("size"),
        )
    ).withColumn("slice", F.substring(place, 1, SLICE_DIGITS))
    slices = sized.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    goal = targets(slices.groupBy("source").agg(F.sum("words").alias("source_size")), share, epochs, weights)
    offsets = (
        slices.withColumn(
            "offset",
            F.sum("words").over(W.partitionBy("source").orderBy("slice")) - F.col("words"),
        )
        .alias("s")
        .join(goal.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source")))
        .select("s.source", "s.slice", "offset", "source_size", "target")
    )
    running = W.partitionBy("slice", "source_name").orderBy("place", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    name = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    queued = (
        sized.withColumn("source_name", name)
        .join(offsets.withColumn("source_name", name).drop("source"), ["slice", "source_name"])
        .withColumn("end", F.col("offset") + F.sum("size").over(running))
    )
    queued = stored(queued.select("doc_id", "text_hash", "source_name", "place", "size", "source_size", "target", "end"))

    def finish(copy: int) -> Column:
        return (F.col("end") + F.lit(copy) * F.col("source_size")) / F.nullif(F.col("target"), F.lit(0.0))

    copies = queued.filter("size > 0").select(
        "source_name", "place", "doc_id", "size",
        F.explode(F.array(*[finish(e) for e in range(epochs)])).alias("time"),
    ).withColumn("tick", F.floor(F.col("time") * TIME_SLICES))
    budget = queued.agg(F.sum("size").alias("n"))
    ticks = copies.groupBy("tick").agg(F.sum("size").alias("words"))
    ticks = ticks.withColumn("end", F.sum("words").over(W.orderBy("tick")))
    # One number and one tick come to the driver.
    total = budget.first()["n"] or 0
    edge = ticks.filter(F.col("end") > F.lit(share) * total).orderBy("tick").limit(1).first()
    order = F.struct("time", "source_name", "place", F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"), "size")
    if edge is None:
        taken = [F.lit(True)] * epochs
    else:
        # The edge tick is cut by range once more, and only the piece at the edge is ranked.
        # No two copies have the same order, as running totals differ.
        ranged = copies.filter(F.col("tick") == edge["tick"]).select("size", order.alias("order"))
        ranged = stored(ranged.repartitionByRange("order").withColumn("piece", F.spark_partition_id()))
        pieces = ranged.groupBy("piece").agg(F.sum("size").alias("words"), F.max("order").alias("last"))
        pieces = pieces.withColumn("end", F.sum("words").over(W.orderBy("piece")) + F.lit(edge["end"] - edge["words"]))
        upto = W.orderBy("order").rowsBetween(W.unboundedPreceding, 0)
        cut = pieces.filter(F.col("end") > F.lit(share) * total).orderBy("piece").limit(1).first()
        last = (
            ranged.filter(F.col("piece") == cut["piece"])
            .withColumn("upto", F.sum("size").over(upto) + F.lit(cut["end"] - cut["words"]))
            .filter(F.col("upto") <= F.lit(share) * total)
            .agg(F.max("order").alias("last"))
            .first()["last"]
        )
        if last is None:
            # The cut falls before this piece's first copy.
            last = pieces.filter(F.col("piece") < cut["piece"]).agg(F.max("last").alias("last")).first()["last"]
        taken = []
        for e in range(epochs):
            time = finish(e)
            within = F.lit(False)
            if last is not None:
                here = F.struct(time.alias("time"), "source_name", "place", F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"), "size")
                kinds = ("double", "string", "string", "long", "long")
                within = here <= F.struct(*[F.lit(x).cast(k) for x, k in zip(last, kinds, strict=True)])
            tick = F.floor(time * TIME_SLICES)
            taken.append((tick < F.lit(edge["tick"])) | ((tick == F.lit(edge["tick"])) & within))
    return queued.select(
        "doc_id",
        "text_hash",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, F.col("size") * reduce(lambda a, b: a + b, [t.cast("long") for t in taken]))
        .otherwise(F.lit(0))
        .cast("long")
        .alias("taken"),
    )

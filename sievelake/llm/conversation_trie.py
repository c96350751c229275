"""Prefix trie of conversations: what its subtrees hold, by the Euler-tour technique.

Every node has an arc that enters it and one that leaves it; together, in the order of a
walk around the tree, they are one linked list. The list is ranked in pieces: links that
stand in one batch are followed there, the heads of the pieces form a shorter list, and so
on. With the sums of weights behind every arc, a subtree's total is the difference of two
of them, however deep or wide it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievelake.llm.common import discarded, on_workers, stored

# Rows that meet by a number are dealt in blocks of so many.
BLOCK = 4096
# One arc of so many is a splitter; a list of at most so many arcs is ranked in one task.
SPLIT, AT_ONCE = 16, 1 << 14
END = -1


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with the place 0, 1, 2 ... of each in the order, written and read back.

    Every task counts its own range of the sort; what is added up in one task is one row
    per range. The last columns should tell rows apart, so that ranges are even.
    """
    ranged = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id())
    )
    span = F.shiftright(name, 33).alias("_range")
    counts = ranged.groupBy(span).agg(F.count("*").alias("_n"))
    starts = counts.select("_range", (F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).alias("_start"))
    numbered = ranged.withColumn("_range", span).join(F.broadcast(starts), "_range")
    return numbered.withColumn(name, F.col("_start") + F.col(name).bitwiseAND(F.lit((1 << 33) - 1))).drop("_range", "_start")


def numbers(rows: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """A row for each number from ``first`` to ``last``, in two steps of bounded arrays each.

    Nothing comes of a row whose ``first`` is greater.
    """
    some = rows.withColumn("_first", first).withColumn("_last", last).filter("_first <= _last")
    blocks = some.withColumn("_block", F.explode(F.sequence(F.expr(f"_first div {BLOCK}"), F.expr(f"_last div {BLOCK}"))))
    low, high = F.greatest("_first", F.col("_block") * BLOCK), F.least("_last", F.col("_block") * BLOCK + BLOCK - 1)
    return blocks.withColumn(name, F.explode(F.sequence(low, high))).drop("_first", "_last", "_block")


def rebuilt(conversations: DataFrame, family: int | None = None, shared: int = 9) -> tuple[DataFrame, DataFrame]:
    """The turns to make a trie of, and the conversations with their number of turns.

    ``(conv_id, pos, key, bytes, length)`` and ``(conv_id, length)``. Turns are in the order
    of ``turn``, null first; equal ones by their content. ``key`` stands for role and text,
    and ``bytes`` is the text's length in UTF-8. With ``family``, the first ``h`` turns of a conversation c are
    replaced by the first ``h`` of conversation c - c % family, where h is the CRC-32 of c
    modulo ``shared``.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", key.alias("key"), F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row_id")
    )
    turns = placed(turns, ["conv_id", "turn", "key", "row_id"], "rank").select("conv_id", "key", "bytes", "rank")
    whole = turns.groupBy("conv_id").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    if family is None:
        facts = whole.select("*", *[F.lit(0).cast("long").alias(c) for c in ("h", "taken", "base_first")])
    else:
        base = whole.select(F.col("conv_id").alias("base"), F.col("first").alias("base_first"), F.col("n").alias("base_n"))
        own = whole.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared)
        facts = (
            own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
            .join(base, "base", "left")
            .withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
        )
    facts = facts.withColumn("own", F.greatest(F.lit(0).cast("long"), F.col("n") - F.col("h"))).withColumn("length", F.col("taken") + F.col("own"))
    facts = stored(facts.select("conv_id", "first", "h", "taken", "base_first", "own", "length"))
    one = F.lit(1).cast("long")
    from_base = numbers(facts, one, F.col("taken"), "pos").withColumn("rank", F.col("base_first") + F.col("pos") - 1)
    from_own = (
        numbers(facts, one, F.col("own"), "k")
        .withColumn("pos", F.col("taken") + F.col("k"))
        .withColumn("rank", F.col("first") + F.col("h") + F.col("k") - 1)
    )
    seats = [part.select("conv_id", "pos", "rank", "length") for part in (from_base, from_own)]
    content = turns.select("rank", "key", "bytes")
    return seats[0].unionByName(seats[1]).join(content, "rank").drop("rank"), facts.select("conv_id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """Per turn the 128-bit name of the prefix that ends with it (a, b) and of that before.

    A prefix is named by the exclusive or of hashes of its turns with their positions, so a
    long conversation is named in blocks, and the blocks before one are added afterwards.
    """
    hashed = turns.withColumns({c: F.xxhash64(F.lit(i), "pos", "key") for i, c in enumerate(("x", "y"), 1)})
    hashed = hashed.withColumn("block", F.expr(f"(pos - 1) div {BLOCK}"))
    upto = W.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    within = hashed.withColumn("a", F.bit_xor("x").over(upto)).withColumn("b", F.bit_xor("y").over(upto))
    sums = hashed.filter(F.col("length") > BLOCK).groupBy("conv_id", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = sums.select("conv_id", "block", F.bit_xor("x").over(earlier).alias("xs"), F.bit_xor("y").over(earlier).alias("ys"))
    joined = within.join(before.filter("block > 0"), ["conv_id", "block"], "left")
    for name, more in (("a", "xs"), ("b", "ys")):
        joined = joined.withColumn(name, F.col(name).bitwiseXOR(F.coalesce(more, F.lit(0))))
    return joined.select(
        "conv_id", "pos", "bytes", "a", "b", F.col("a").bitwiseXOR(F.col("x")).alias("pa"), F.col("b").bitwiseXOR(F.col("y")).alias("pb"),
        (F.col("pos") == F.col("length")).alias("ends"),
    )


def contracted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Follows links as far as they stay in their batch.

    Each arc gets the sums from itself up to the first arc outside, and that arc as its
    next. ``head`` marks arcs that no other of the batch leads to.
    """
    for frame in frames:
        ids, out = frame["id"].to_numpy(), frame["next"].to_numpy().copy()
        sums = frame[["leaves", "saved"]].to_numpy(np.int64).copy()
        order = np.argsort(ids)
        at = np.minimum(np.searchsorted(ids, out, sorter=order), len(ids) - 1)
        jump = np.where(ids[order[at]] == out, order[at], -1)
        head = np.ones(len(ids), bool)
        head[jump[jump >= 0]] = False
        while True:
            going = np.flatnonzero(jump >= 0)
            if not len(going):
                break
            to = jump[going]
            added, ahead, further = sums[to], out[to], jump[to]
            sums[going] += added
            out[going], jump[going] = ahead, further
        yield frame.assign(next=out, leaves=sums[:, 0], saved=sums[:, 1], head=head)


def _whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = list(frames)
    return contracted(iter([pd.concat(held, ignore_index=True)] if held else []))


ARC = ["id", "next", "leaves", "saved"]


def _following(arcs: DataFrame, level: int) -> DataFrame:
    """``arcs`` led to the next splitter each, a few arcs ahead, by doubling their steps.

    A splitter is chosen by its number; the first arc of the list is one, too.
    """

    def splits(arc: Column) -> Column:
        return (arc == 0) | (F.pmod(F.xxhash64(arc, F.lit(level)), F.lit(SPLIT)) == 0)

    there = (F.col("next") == END) | splits(F.col("next"))
    state = stored(arcs.select(*ARC))
    while True:
        going = state.filter(~there)
        if going.isEmpty():
            return state.withColumn("head", splits(F.col("id")))
        ahead = state.select(F.col("id").alias("next"), *[F.col(c).alias(f"_{c}") for c in ARC[1:]])
        moved = going.join(ahead, "next").select(
            "id", F.col("_next").alias("next"), *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in ARC[2:]]
        )
        later = stored(moved.unionByName(state.filter(there)))
        discarded(state)
        state = later


def list_ranked(arcs: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """``(id, leaves, saved)``: sums of both weights from each arc to the end of the list.

    ``arcs`` has ``id, next`` (-1 at the end), the two weights, and ``conv_id, depth`` of
    the node. First arcs along one conversation are contracted, in blocks of its depths,
    then those of neighbours in the numbering, where siblings stand side by side. What is
    left shrinks sixteen-fold at a time, until at most ``at_once`` arcs are ranked in one
    task; then the sums go back through the levels.
    """
    schema = "id long, next long, leaves long, saved long, head boolean"
    along = arcs.repartition("conv_id", F.expr(f"depth div {BLOCK}")).sortWithinPartitions("conv_id", "depth")
    levels = [stored(along.select(*ARC).mapInPandas(contracted, schema))]
    beside = levels[0].filter("head").select(*ARC).repartition(F.expr(f"id div {2 * BLOCK}")).sortWithinPartitions("id")
    levels.append(stored(beside.mapInPandas(contracted, schema)))
    while (heads := levels[-1].filter("head")).count() > at_once:
        levels.append(_following(heads, len(levels)))
    known = heads.select(*ARC).repartition(1).mapInPandas(_whole, schema).select("id", "leaves", "saved")
    for level in reversed(levels):
        behind = known.select(F.col("id").alias("next"), *[F.col(c).alias(f"_{c}") for c in ARC[2:]])
        inner = level.filter("NOT head").join(behind, "next", "left")
        sums = [(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in ARC[2:]]
        known = stored(known.unionByName(inner.select("id", *sums)))
    return known


def _digests(ends: DataFrame) -> DataFrame:
    """``(a, b, ends_sha256)`` of the conversations that end at each node.

    Ids are joined to long strings where they are sorted; a node's digest reads these one
    after the other, so that many conversations ending at one node need no memory.
    """

    def joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            a, b = frame["a"].to_numpy(), frame["b"].to_numpy()
            new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            starts = np.flatnonzero(new)
            texts = frame["conv_id"].astype(str).to_numpy()
            parts = [",".join(texts[i:j]) for i, j in zip(starts, np.append(starts[1:], len(frame)), strict=True)]
            yield frame.iloc[starts].assign(ids=parts)

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node = digest = None
        for frame in frames:
            done = []
            for a, b, ids in zip(frame["a"], frame["b"], frame["ids"], strict=True):
                if (a, b) != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (a, b), hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            yield pd.DataFrame(done, columns=["a", "b", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, digest.hexdigest())], columns=["a", "b", "ends_sha256"])

    order = ["a", "b", "conv_id"]
    parts = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(joined, "a long, b long, conv_id long, ids string")
    return parts.repartition("a", "b").sortWithinPartitions(*order).mapInPandas(hashed, "a long, b long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, family: int | None = None, shared: int = 9, at_once: int = AT_ONCE) -> DataFrame:
    """A row for each distinct prefix of the conversations ``(conv_id, turn, role, text)``.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)``: the least conversation that starts with the prefix, its number of turns,
    the least conversation of the parent (null for the root), the conversations that start with it,
    its children, the childless nodes of its subtree, what serving the subtree's prefixes
    once would save (bytes of each node's last text times its conversations but one), and the
    SHA-256 of the ids of conversations that end here, ascending and comma-joined.

    Rows without a conv_id belong to no conversation; a null role or text counts as empty,
    a null turn comes first, and turns of equal number come in the order of their content's
    MD5. Repeated rows are turns of their own. Without any conversation there is no node.
    Other columns are ignored. ``family`` and ``shared`` are those of ``rebuilt``.

    Texts never travel, only their MD5 and length. Conversations and families of children of
    any size are cut in blocks by places in a sorted order, so no key gathers them.
    """
    on_workers(conversations.sparkSession)
    turns, whole = rebuilt(conversations, family, shared)
    named = stored(prefixes(turns))
    nodes = named.groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        *[F.any_value(c).alias(c) for c in ("pa", "pb", "bytes")],
        F.any_value("pos").alias("depth"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = whole.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select("*", *[zero.alias(c) for c in ("a", "b", "bytes", "depth")], none.alias("pa"), none.alias("pb"))
    # The children of a node stand side by side, the root before all.
    nodes = placed(nodes.unionByName(root), ["pa", "pb", "conv_id"], "place")
    kids = (
        nodes.filter("pa IS NOT NULL")
        .groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"))
        .agg(F.min("place").alias("first_child"), F.max("place").alias("last_child"))
    )
    nodes = stored(nodes.join(kids, ["a", "b"], "left").drop("pa", "pb"))
    parents = numbers(
        nodes.select(F.col("place").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "first_child", F.col("last_child").alias("last")),
        F.col("first_child"),
        F.col("last"),
        "place",
    )
    nodes = stored(nodes.join(parents.drop("first_child"), "place", "left"))

    leaf = F.col("first_child").isNull()
    enter, leave = F.col("place") * 2, F.col("place") * 2 + 1
    up = F.when(F.col("parent").isNull(), END).when(F.col("place") < F.col("last"), enter + 2).otherwise(F.col("parent") * 2 + 1)
    arcs = F.array(
        F.struct(
            enter.alias("id"),
            F.when(leaf, leave).otherwise(F.col("first_child") * 2).alias("next"),
            leaf.cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        ),
        F.struct(leave.alias("id"), up.cast("long").alias("next"), zero.alias("leaves"), zero.alias("saved")),
    )
    sums = list_ranked(nodes.select("conv_id", "depth", F.inline(arcs)), at_once)
    turned = F.when(F.col("id") % 2 == 0, 1).otherwise(-1)
    subtrees = sums.groupBy(F.expr("id div 2").alias("place")).agg(
        F.sum(turned * F.col("leaves")).alias("n_leaves"), F.sum(turned * F.col("saved")).alias("saved_tokens")
    )
    turnless = whole.filter("length = 0").select(zero.alias("a"), zero.alias("b"), "conv_id")
    ends = _digests(named.filter("ends").select("a", "b", "conv_id").unionByName(turnless))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return (
        nodes.join(subtrees, "place")
        .join(ends, ["a", "b"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce(F.col("last_child") - F.col("first_child") + 1, zero).alias("n_children"),
            "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )

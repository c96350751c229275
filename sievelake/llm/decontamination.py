"""Benchmark decontamination by a hash set of normalised test n-grams.

Every n-gram of a test item has an anchor, its longest word. A document's windows are only
looked at where a word is an anchor; these windows meet the set of n-grams by a hash join
and are compared word by word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.common import ascii_lower, fresh, stored

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
# Anchors known to one scan of the documents; a longer list is scanned for in several turns.
ANCHORS_AT_ONCE = 100_000


def words(text: Column) -> Column:
    """The normalised words of a text; null: none."""
    cut = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.filter(cut, lambda w: w != "")


def windows(benchmark: DataFrame, n: int) -> DataFrame:
    """``(item_id, anchor, at, gram)``: each distinct window, and where its anchor is in it."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (n - 1), F.lit(1)))
    grams = items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, n))).alias("gram"))
    longest = F.array_max(F.transform("gram", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))
    return (
        grams.distinct()
        .withColumn("anchor", longest["w"])
        .withColumn("at", F.array_position("gram", F.col("anchor")).cast("int"))
    )


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``(doc_id, text_hash, n_words, n_hit, items)`` for each row of ``docs (doc_id, text)``.

    A window is ``n`` consecutive words of an item of ``benchmark (item_id, text)``; an item
    of fewer words, but not none, is one window. ``n_hit`` counts the document's words
    inside any occurrence of a window, ``items`` are the sorted item ids, as strings, that
    have one. Null and empty texts have no words. An item without words gives no window; the
    windows of one with a null id count as any other, but name no item. Repeated rows get the same result each; other columns are ignored.
    ``text_hash`` tells apart documents with the same id.

    The documents' words are taken once and only the neighbourhoods of anchors are kept.
    """
    grams = stored(windows(benchmark, n))
    turns = max(1, -(-grams.select("anchor").distinct().count() // ANCHORS_AT_ONCE))
    w = F.col("w")
    base = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words(F.col("text")).alias("w"))
    scanned = []
    for turn in range(turns):
        # At most about ANCHORS_AT_ONCE words are at the driver, and in a plan, at a time.
        anchors = [
            r.anchor
            for r in grams.filter(F.pmod(F.xxhash64("anchor"), F.lit(turns)) == turn).select("anchor").distinct().collect()
        ]
        places = F.filter(
            F.transform(w, lambda x, i: F.when(x.isin(anchors), i)), lambda i: i.isNotNull()
        )
        around = F.transform(
            places,
            lambda i: F.struct(
                i.alias("place"),
                F.least(i, F.lit(n - 1)).alias("before"),
                F.slice(w, F.greatest(i - (n - 2), F.lit(1)), F.least(i, F.lit(n - 1)) + n).alias("near"),
            ),
        )
        scanned.append(stored(base.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"), around.alias("found"))))
    # Every turn has all documents.
    found = scanned[0]
    spots = reduce(
        DataFrame.unionByName,
        [part.filter(F.size("found") > 0).select("doc_id", "text_hash", F.explode("found").alias("s")) for part in scanned],
    ).select("doc_id", "text_hash", "s.*", F.element_at("s.near", F.col("s.before") + 1).alias("anchor"))
    first = F.col("before") + 2 - F.col("at")
    size = F.size("gram")
    hits = (
        spots.join(grams, "anchor")
        .filter((first >= 1) & (F.slice("near", F.greatest(first, F.lit(1)), size) == F.col("gram")))
        .select("doc_id", "text_hash", (F.col("place") + 1 - F.col("at")).alias("start"), size.alias("length"), F.col("item_id").cast("string").alias("item"))
    )
    # A window's occurrence is one row however many items have it, and a place of the text
    # counts once; both combine before the shuffle.
    key = ["doc_id", "text_hash"]
    places = hits.select(*key, "start", "length").distinct()
    covered = (
        places.select(*key, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("p"))
        .distinct()
        .groupBy(*key)
        .agg(F.count("*").alias("n_hit"))
    )
    items = hits.select(*key, "item").distinct().groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("items"))
    same = reduce(lambda a, b: a & b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key])
    hit = covered.alias("a").join(items.alias("b"), same).select("a.*", "b.items")
    return (
        found.alias("a")
        .join(hit.alias("b"), same, "left")
        .select(
            "a.doc_id",
            "a.text_hash",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """``docs`` without the documents in which a window of the benchmark occurs; all columns."""
    bad_id, bad_hash = fresh("id"), fresh("hash")
    bad = contamination(docs, benchmark, n).filter("n_hit > 0").select(
        F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash)
    ).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(bad_id)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(bad_hash))
    return docs.join(bad, same, "left_anti")

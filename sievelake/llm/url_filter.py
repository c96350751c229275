"""URL filter: a blocked Bloom filter of listed URLs in front of an exact hash join.

Every rule is a host and the beginning of a path. A rule fits its host, all subdomains of
it and all paths that start with its path; the longest rule that fits decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.common import ascii_lower

# The filter never grows beyond this many blocks (two words each, 4 MB), so it is safe to
# broadcast. A longer list only lets more false hits through to the exact join.
MAX_BLOCKS = 1 << 17
RULES_PER_BLOCK = 8
BITS = 5


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """What follows the host up to ``? #``; empty where there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _mask(key: Column) -> Column:
    """Five bits of a 64-bit block, out of a second hash."""
    spread = F.xxhash64(key, F.lit(1))
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        bit = F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """``(block, bits)``: the blocks of the filter over column ``key`` that have a bit set."""
    marked = keys.select(_block(F.col("key"), blocks).alias("block"), _mask(F.col("key")).alias("m"))
    return marked.groupBy("block").agg(F.bit_or("m").alias("bits"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for each row of ``pages (page_id, url)``.

    ``rules`` has ``host, path, verdict``; rows with a null in one of them are ignored, and
    of two equal rules the one with the greater verdict (block) counts. A URL on which no
    rule fits gets ``default`` and a null rule: so does a null or empty URL. Repeated rows
    are judged each. Other columns of either table are ignored.

    Each distinct URL is judged once. Its candidates are its host and parent domains, each
    with the beginnings of its path that are as long as some rule's path. They meet the
    filter, then the rules, and the longest hit is kept; nothing but distinct URLs and
    page ids is shuffled.
    """
    listed = (
        rules.select(ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
        .dropna()
        .groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("key", F.concat("rule_host", F.lit("\n"), "rule_path"))
    )
    # As many numbers as there are lengths of paths, at most the length of the longest URL.
    facts = listed.agg(
        F.count("*").alias("n"), F.array_sort(F.collect_set(F.length("rule_path"))).alias("lengths")
    ).first()
    blocks = min(MAX_BLOCKS, max(1, -(-facts["n"] // RULES_PER_BLOCK)))
    lengths = F.lit(facts["lengths"]).cast("array<int>") if facts["lengths"] else F.array().cast("array<int>")

    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    suffix = F.explode(
        F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        )
    )
    start = F.explode(F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)))
    urls = rows.select("host", "path").distinct()
    candidates = (
        urls.select("host", "path", suffix.alias("rule_host"))
        .select("host", "path", "rule_host", start.alias("rule_path"))
        .withColumn("key", F.concat("rule_host", F.lit("\n"), "rule_path"))
        .withColumn("block", _block(F.col("key"), blocks))
    )
    possible = candidates.join(F.broadcast(bloom(listed, blocks)), "block").filter(
        F.col("bits").bitwiseAND(_mask(F.col("key"))) == _mask(F.col("key"))
    )
    rule = F.concat("rule_host", "rule_path")
    best = (
        possible.join(listed.drop("rule_host", "rule_path"), "key")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length(rule), F.length("rule_host"), rule.alias("rule"), "verdict")).alias("best"))
    )
    return rows.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )

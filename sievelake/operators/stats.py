"""Run, validation and publish statistics as small aggregate tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.functions import domains
from sievelake.settings import ADS_TRACKERS, MALWARE, TOPICS


def _sum(column: str):
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(column)


def publish(entries: DataFrame) -> DataFrame:
    """Messages per source and overall (null source): malware, ads_trackers, total, failed.

    Counts first and rolls up the few per-source rows afterwards, so the input is neither
    expanded nor shuffled whole.
    """
    names = ["malware", "ads_trackers", "total", "failed"]
    sendable = F.coalesce(F.col("category").isin(list(TOPICS)), F.lit(False))
    counted = entries.groupBy("source").agg(
        F.count_if(F.col("category") == MALWARE).alias("malware"),
        F.count_if(F.col("category") == ADS_TRACKERS).alias("ads_trackers"),
        F.count_if(sendable).alias("total"),
        F.count_if(~sendable).alias("failed"),
    )
    overall = counted.agg(*[_sum(n) for n in names]).select(
        F.lit("overall").alias("level"), F.lit(None).cast("string").alias("source"), *names
    )
    return counted.select(F.lit("source").alias("level"), "source", *names).unionByName(overall)


def validation(entries: DataFrame, clean: bool = True, named: bool = False) -> DataFrame:
    """One row: total, valid, invalid, duplicates, uncleanable.

    With ``clean`` the total holds only entries that could be cleaned, so ``invalid`` is
    zero; without it entries are judged as they are. Entries are counted per source and
    domain first, so copies collapse before the shuffle. ``named`` tells that entries were
    parsed, so that their domains are valid names.
    """
    if clean:
        judged = entries.withColumn("domain", domains.clean(F.col("domain"), named))
        counts = judged.groupBy("source", "domain").agg(F.count("*").alias("n"))
        ok = F.col("domain").isNotNull()
        invalid, uncleanable = F.lit(0), F.sum(F.when(~ok, F.col("n")))
        total = F.sum(F.when(ok, F.col("n")))
    else:
        counts = (
            entries.groupBy("source", "domain")
            .agg(F.count("*").alias("n"))
            .withColumn("ok", domains.is_valid(F.col("domain")))
        )
        ok = F.col("ok")
        invalid, uncleanable = F.sum(F.when(~ok, F.col("n"))), F.lit(0)
        total = F.sum("n")
    return counts.agg(
        total.alias("total"),
        F.count_if(ok).alias("valid"),
        invalid.alias("invalid"),
        F.sum(F.when(ok, F.col("n") - 1)).alias("duplicates"),
        uncleanable.alias("uncleanable"),
    ).select(
        *[
            F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)
            for name in ("total", "valid", "invalid", "duplicates", "uncleanable")
        ]
    )


def entry_counts() -> list[Column]:
    """To be observed while parsed entries are written."""
    return [
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(domains.clean(F.col("domain"), named=True).isNull()).alias("uncleanable"),
    ]


def valid_counts() -> list[Column]:
    """To be observed while valid entries, each domain once for its source, are written."""
    return [
        F.count(F.lit(1)).alias("validated"),
        F.count_if(F.coalesce(F.col("category").isin(list(TOPICS)), F.lit(False))).alias("published"),
    ]


def observed_validation(entries: DataFrame, seen: Mapping[str, int]) -> DataFrame:
    """``validation`` of observed entries; what is neither kept nor uncleanable is a duplicate."""
    total = seen["fetched"] - seen["uncleanable"]
    row = {
        "total": total,
        "valid": seen["validated"],
        "invalid": 0,
        "duplicates": total - seen["validated"],
        "uncleanable": seen["uncleanable"],
    }
    return entries.sparkSession.range(1).select(*[F.lit(n).cast("bigint").alias(k) for k, n in row.items()])


def observed_run(entries: DataFrame, failures: DataFrame, seen: Mapping[str, int]) -> DataFrame:
    """``run`` of observed entries: only sources are looked for, in one column."""
    names = [
        "sources_processed",
        "sources_failed",
        "domains_fetched",
        "domains_validated",
        "domains_published",
    ]

    def part(rows: DataFrame, **values: int) -> DataFrame:
        return rows.select(*[F.lit(values.get(n, 0)).cast("bigint").alias(n) for n in names])

    counts = part(
        entries.sparkSession.range(1),
        domains_fetched=seen["fetched"],
        domains_validated=seen["validated"],
        domains_published=seen["published"],
    )
    processed = part(entries.select("source").distinct(), sources_processed=1)
    failed = part(failures.select("source").distinct(), sources_failed=1)
    return processed.unionByName(failed).unionByName(counts).agg(*[_sum(n) for n in names])


def run(entries: DataFrame, failures: DataFrame, named: bool = False) -> DataFrame:
    """One row on an ingest run, from parsed entries and failed documents.

    sources_processed, sources_failed, domains_fetched, domains_validated and
    domains_published come out of a single pass over the entries. All entries of a source
    have the category the registry gives it. ``named`` tells that entries were parsed, so that
    their domains are valid names.
    """
    sendable = F.coalesce(F.col("category").isin(list(TOPICS)), F.lit(False))
    kept = (
        entries.withColumn("domain", domains.clean(F.col("domain"), named))
        .groupBy("source", sendable.alias("sendable"), "domain")
        .agg(F.count("*").alias("n"))
    )
    validated = F.col("domain").isNotNull()
    published = validated & F.col("sendable")
    names = [
        "sources_processed",
        "sources_failed",
        "domains_fetched",
        "domains_validated",
        "domains_published",
    ]
    zero = F.lit(0).cast("bigint")
    per_source = kept.groupBy("source").agg(
        F.lit(1).cast("bigint").alias("sources_processed"),
        zero.alias("sources_failed"),
        F.sum("n").alias("domains_fetched"),
        F.count_if(validated).alias("domains_validated"),
        F.count_if(published).alias("domains_published"),
    )
    failed = (
        failures.select("source")
        .distinct()
        .select(
            "source",
            zero.alias("sources_processed"),
            F.lit(1).cast("bigint").alias("sources_failed"),
            zero.alias("domains_fetched"),
            zero.alias("domains_validated"),
            zero.alias("domains_published"),
        )
    )
    return per_source.unionByName(failed).agg(*[_sum(n) for n in names])

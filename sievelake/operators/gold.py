"""Flagged rows to one row per domain.

Work is split in three: ``partial`` reduces rows to mergeable per-domain state, ``fold``
merges any number of such states, ``finish`` turns a state into the published columns.
Because folding does not depend on order or grouping, late rows, restarts and replayed
batches give the same table as one pass over everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.functions.times import moment
from sievelake.settings import ACTIVE_DAYS, ADS_TRACKERS, MALWARE


def partial(silver: DataFrame, as_of=None) -> DataFrame:
    """Per-domain state of valid rows.

    All aggregates combine before the shuffle, so a domain with most of the rows still
    sends one row per map task. The array of sources is as small as the registry.
    """
    seen = F.col("ingestion_timestamp")
    first = F.struct(
        seen.alias("seen"),
        F.col("source"),
        F.col("bronze_offset").alias("offset"),
        F.sort_array(F.map_entries("metadata")).alias("entries"),
    )
    return (
        silver.groupBy("domain")
        .agg(
            F.max(F.coalesce(F.col("category") == MALWARE, F.lit(False))).alias("has_malware"),
            F.collect_set("source").alias("sources"),
            F.min(seen).alias("first_seen"),
            F.max(seen).alias("last_seen"),
            F.min(F.when(F.col("metadata").isNotNull(), first)).alias("earliest"),
        )
        .withColumn("sources", F.sort_array("sources"))
        .withColumn("updated", moment(as_of))
    )


# What ``combine`` makes of a row ``l`` and a row ``r`` of states, and of the states of a
# domain; also the text of the views that do it when they are read.
COMBINED = (
    "coalesce(l.domain, r.domain) AS domain",
    "greatest(l.has_malware, r.has_malware) AS has_malware",
    "sort_array(array_union(coalesce(l.sources, array()), coalesce(r.sources, array()))) AS sources",
    "least(l.first_seen, r.first_seen) AS first_seen",
    "greatest(l.last_seen, r.last_seen) AS last_seen",
    "least(l.earliest, r.earliest) AS earliest",
    "greatest(l.updated, r.updated) AS updated",
)
FOLDED = (
    "max(has_malware) AS has_malware",
    "sort_array(array_distinct(flatten(collect_set(sources)))) AS sources",
    "min(first_seen) AS first_seen",
    "max(last_seen) AS last_seen",
    "min(earliest) AS earliest",
    "max(updated) AS updated",
)


def fold(states: DataFrame) -> DataFrame:
    """One state per domain out of any number of them."""
    return states.groupBy("domain").agg(*[F.expr(e) for e in FOLDED])


def combine(left: DataFrame, right: DataFrame) -> DataFrame:
    """``fold`` of two tables of states that each hold a domain once, as a join.

    A side that is bucketed by domain is not shuffled.
    """
    joined = left.alias("l").join(right.alias("r"), F.col("l.domain") == F.col("r.domain"), "full")
    return joined.selectExpr(*COMBINED)


def is_active(last_seen: Column, as_of=None) -> Column:
    """ "true" when last seen within the activity window before the given time."""
    since = moment(as_of) - F.expr(f"INTERVAL {ACTIVE_DAYS} DAYS")
    return F.when(last_seen >= since, "true").otherwise("false")


def severest(has_malware: Column) -> Column:
    return F.when(has_malware, MALWARE).otherwise(ADS_TRACKERS)


def finished(as_of=None) -> tuple[str, ...]:
    """Published columns of a folded state; without ``as_of`` activity is judged when read."""
    now = "current_timestamp()" if as_of is None else f"CAST('{as_of}' AS TIMESTAMP)"
    return (
        "domain",
        f"CASE WHEN has_malware THEN '{MALWARE}' ELSE '{ADS_TRACKERS}' END AS category",
        "to_json(sources) AS source_list",
        "CAST(size(sources) AS BIGINT) AS source_count",
        "first_seen",
        "last_seen",
        "updated AS last_updated",
        f"CASE WHEN last_seen >= {now} - INTERVAL {ACTIVE_DAYS} DAYS THEN 'true' ELSE 'false' END AS is_active",
        "map_from_entries(earliest.entries) AS metadata",
        "CAST(hash(domain) AS BIGINT) AS domain_hash",
    )


def finish(states: DataFrame, as_of=None) -> DataFrame:
    """Published columns of folded states."""
    return states.selectExpr(*finished(as_of))


def aggregate(silver: DataFrame, as_of=None) -> DataFrame:
    """The per-domain table of all valid rows in one pass."""
    return finish(partial(silver, as_of), as_of)


def merge_upsert(target: DataFrame, updates: DataFrame, as_of=None) -> DataFrame:
    """The table after upserting ``updates`` (both in published columns, unique domains).

    Matched rows take the severest category, the union of sources, the widest time span,
    the update's metadata and keep their hash. A domain seen for the first time is always
    active. Rows of the target without an update stay as they are.
    """
    now = moment(as_of)
    old, new = "old", "new"
    joined = target.alias(old).join(
        updates.alias(new), F.col("old.domain") == F.col("new.domain"), "full_outer"
    )
    kept = F.col("new.domain").isNull()
    inserted = F.col("old.domain").isNull()

    def choose(name: str, matched: Column, fresh: Column | None = None) -> Column:
        fresh = F.col(f"new.{name}") if fresh is None else fresh
        return (
            F.when(kept, F.col(f"old.{name}"))
            .when(inserted, fresh)
            .otherwise(matched)
            .alias(name)
        )

    sources = F.sort_array(
        F.array_union(
            F.from_json("old.source_list", "array<string>"),
            F.from_json("new.source_list", "array<string>"),
        )
    )
    earlier = F.when(
        F.col("old.first_seen") < F.col("new.first_seen"), F.col("old.first_seen")
    ).otherwise(F.col("new.first_seen"))
    later = F.greatest("old.last_seen", "new.last_seen")
    either = F.coalesce(
        (F.col("new.category") == MALWARE) | (F.col("old.category") == MALWARE), F.lit(False)
    )
    return joined.select(
        F.coalesce("old.domain", "new.domain").alias("domain"),
        choose("category", severest(either)),
        choose("source_list", F.to_json(sources)),
        choose("source_count", F.size(sources).cast("bigint")),
        choose("first_seen", earlier),
        choose("last_seen", later),
        choose("last_updated", now, now),
        choose("is_active", is_active(later, as_of), F.lit("true")),
        choose("metadata", F.col("new.metadata")),
        choose("domain_hash", F.col("old.domain_hash")),
    )

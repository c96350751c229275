from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sievelake import schemas
from sievelake.operators import gold, silver

BASE = datetime(2024, 1, 31, 12)


def bronze_rows(spark, names):
    return spark.createDataFrame(
        [
            (n, "malware", "s", "hosts", f"0.0.0.0 {n}", BASE, {}, "t", 0, i, BASE, BASE, BASE.date())
            for i, n in enumerate(names)
        ],
        schemas.BRONZE,
    )


def test_silver_keeps_every_row(spark):
    names = ["Example.COM  ", "  valid-domain.net", "-invalid-start.com", "invalid..double-dot.com", "good-domain.com", None]
    out = silver.transform(bronze_rows(spark, names), "2024-02-01")
    assert [f.name for f in out.schema] == schemas.SILVER.fieldNames()
    rows = out.orderBy("bronze_offset").collect()
    assert [(r.domain, r.is_valid, r.validation_errors) for r in rows] == [
        ("example.com", "true", None),
        ("valid-domain.net", "true", None),
        (None, "false", "Invalid domain format"),
        (None, "false", "Invalid domain format"),
        ("good-domain.com", "true", None),
        (None, "false", "Invalid domain format"),
    ]


def sighting(domain, category, source, hours=0, metadata=None, valid="true", offset=0):
    at = BASE + timedelta(hours=hours)
    error = None if valid == "true" else "Invalid domain format"
    return (domain, category, source, "hosts", domain, at, at, at, metadata, valid, error, at.date(), offset)


def silver_rows(spark, rows):
    return spark.createDataFrame(rows, schemas.SILVER)


SIGHTINGS = [
    sighting("test-domain.com", "malware", "stevenblack", 0, {"source_priority": "high"}),
    sighting("test-domain.com", "malware", "urlhaus", 1, {"confidence": "high"}, offset=1),
    sighting("mixed-category.com", "ads_trackers", "easylist", 0, None, offset=2),
    sighting("mixed-category.com", "malware", "malwaredomainlist", 0.5, {"b": "2", "a": "1"}, offset=3),
    sighting("old-domain.net", None, "test", -240, {}, offset=4),
    sighting("invalid-domain", "malware", "test", 0, {}, "false", offset=5),
]


def test_gold_table(spark):
    rows = silver.valid_only(silver_rows(spark, SIGHTINGS))
    out = gold.aggregate(rows, "2024-02-01")
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.GOLD]
    got = {r.domain: r for r in out.collect()}
    assert set(got) == {"test-domain.com", "mixed-category.com", "old-domain.net"}
    test = got["test-domain.com"]
    assert (test.category, test.source_list, test.source_count) == ("malware", '["stevenblack","urlhaus"]', 2)
    assert (test.first_seen, test.last_seen) == (BASE, BASE + timedelta(hours=1))
    assert test.metadata == {"source_priority": "high"} and test.is_active == "true"
    assert got["mixed-category.com"].category == "malware"
    assert got["mixed-category.com"].metadata == {"a": "1", "b": "2"}
    old = got["old-domain.net"]
    assert (old.category, old.is_active, old.metadata) == ("ads_trackers", "false", {})
    hashes = spark.createDataFrame([(d,) for d in got], "domain string").select("domain", F.hash("domain"))
    assert {r[0]: r[1] for r in hashes.collect()} == {d: r.domain_hash for d, r in got.items()}


def same(a, b):
    a, b = (x.withColumn("metadata", F.to_json(F.sort_array(F.map_entries("metadata")))) for x in (a, b))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_folding_does_not_depend_on_grouping(spark):
    rows = silver.valid_only(silver_rows(spark, SIGHTINGS))
    whole = gold.aggregate(rows, "2024-02-01")
    parts = [gold.partial(rows.filter(F.col("bronze_offset") % 3 == i), "2024-02-01") for i in (2, 0, 1)]
    folded = gold.fold(gold.fold(parts[0].unionByName(parts[1])).unionByName(parts[2]))
    assert same(gold.finish(folded, "2024-02-01"), whole)
    twice = gold.fold(folded.unionByName(folded))
    assert same(gold.finish(twice, "2024-02-01"), whole)


def test_merge_follows_the_upsert_rules(spark):
    old = gold.aggregate(
        silver_rows(
            spark,
            [
                sighting("both.com", "malware", "b", 0, {"v": "old"}),
                sighting("both.com", "malware", "a", 5, {"v": "old"}),
                sighting("kept.com", "ads_trackers", "a", -500, {"v": "old"}),
            ],
        ),
        "2024-01-31",
    ).withColumn("domain_hash", F.lit(1).cast("bigint"))
    new = gold.aggregate(
        silver_rows(
            spark,
            [
                sighting("both.com", "ads_trackers", "c", -1, {"v": "new"}),
                sighting("both.com", "ads_trackers", "a", 2, {"v": "later"}),
                sighting("fresh.com", "ads_trackers", "z", -500, {"v": "new"}),
            ],
        ),
        "2024-02-01",
    )
    got = {r.domain: r for r in gold.merge_upsert(old, new, "2024-02-02").collect()}
    both = got["both.com"]
    assert (both.category, both.source_list, both.source_count) == ("malware", '["a","b","c"]', 3)
    assert (both.first_seen, both.last_seen) == (BASE - timedelta(hours=1), BASE + timedelta(hours=5))
    assert both.metadata == {"v": "new"} and both.domain_hash == 1
    assert both.last_updated == datetime(2024, 2, 2) and both.is_active == "true"
    kept = got["kept.com"]
    assert (kept.last_updated, kept.is_active, kept.domain_hash) == (datetime(2024, 1, 31), "false", 1)
    fresh = got["fresh.com"]
    # Seen long ago, but new domains always start out active.
    assert (fresh.is_active, fresh.last_updated) == ("true", datetime(2024, 2, 2))
    assert gold.merge_upsert(old, new).schema.fieldNames() == schemas.GOLD.fieldNames()

import logging
from datetime import datetime

from pyspark.sql import functions as F

from sievelake import schemas
from sievelake.operators import quality
from sievelake.sources import layers
from sievelake.sources.registry import registry
from sievelake.tables import catalog, folders, upkeep

BASE = datetime(2024, 1, 31)


def gold_rows(spark, n, hot=0):
    return spark.range(n + hot).select(
        F.when(F.col("id") < n, F.concat(F.lit("d"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit(".com")))
        .otherwise("hot.com")
        .alias("domain"),
        F.lit("malware").alias("category"),
        F.lit('["s"]').alias("source_list"),
        F.lit(1).cast("bigint").alias("source_count"),
        *[F.lit(BASE).alias(c) for c in ("first_seen", "last_seen", "last_updated")],
        F.lit("true").alias("is_active"),
        F.create_map(F.lit("n"), F.col("id").cast("string")).alias("metadata"),
        F.col("id").alias("domain_hash"),
    )


def same(a, b):
    a, b = (x.withColumn("metadata", F.to_json("metadata")) for x in (a, b))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ensure_table_once(spark, tmp_path):
    path = str(tmp_path / "bronze")
    assert catalog.ensure_table(spark, path, schemas.BRONZE, ["ingestion_date"])
    assert layers.table(spark, path, schemas.BRONZE).count() == 0
    assert not catalog.ensure_table(spark, path, schemas.BRONZE, ["ingestion_date"])


def test_register_query_and_prune(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(30).select(
        "id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int") % 3).alias("ingestion_date")
    )
    days.write.partitionBy("ingestion_date").parquet(path)
    args = ("reg", "days", path, days.schema, ["ingestion_date"], {"steward": "it's"})
    name = catalog.register_table(spark, *args)
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 30
    one = spark.sql(f"SELECT id FROM {name} WHERE ingestion_date = DATE '2024-01-02'")
    assert one.count() == 10
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan
    assert catalog.register_table(spark, *args) == name
    owner = spark.sql(f"SHOW TBLPROPERTIES {name} ('steward')").first()
    assert owner["value"] == "it's"


def test_other_location_warns_or_replaces(spark, tmp_path, caplog):
    for part in ("a", "b"):
        spark.range(1 if part == "a" else 2).write.parquet(f"{tmp_path}/{part}")
    schema = spark.range(1).schema
    catalog.register_table(spark, "reg", "moved", f"{tmp_path}/a", schema)
    with caplog.at_level(logging.WARNING):
        name = catalog.register_table(spark, "reg", "moved", f"{tmp_path}/b", schema)
    assert "is registered at" in caplog.text and spark.table(name).count() == 1
    catalog.register_table(spark, "reg", "moved", f"{tmp_path}/b", schema, replace=True)
    assert spark.table(name).count() == 2
    assert folders.exists(spark, f"{tmp_path}/a")


def test_cluster_keeps_rows_and_splits_a_hot_value(spark, tmp_path):
    gold_rows(spark, 1000, hot=2000).repartition(5).write.parquet(f"{tmp_path}/in")
    upkeep.cluster(spark, f"{tmp_path}/in", schemas.GOLD, f"{tmp_path}/out", files=6)
    out = layers.table(spark, f"{tmp_path}/out", schemas.GOLD)
    assert same(out, layers.table(spark, f"{tmp_path}/in", schemas.GOLD))
    spans = (
        out.groupBy(F.col("_metadata.file_path"))
        .agg(F.min("domain").alias("low"), F.max("domain").alias("high"), F.count("*").alias("n"))
        .orderBy("low", "high")
        .collect()
    )
    assert len(spans) == 6 and max(s.n for s in spans) < 1000
    assert all(a.high <= b.low for a, b in zip(spans, spans[1:]))


def test_a_curve_serves_lookups_on_each_column(spark, tmp_path):
    """A grid of two columns: sorting serves the first only, the curve both."""
    rows = spark.range(16_000).select(
        F.sha2((F.col("id") % 400).cast("string"), 256).alias("domain"),
        F.when(F.col("id") % 50 > 0, F.timestamp_seconds(F.col("id") * 7919 % 1_000_000)).alias("last_seen"),
        "id",
    )
    rows.repartition(3).write.parquet(f"{tmp_path}/in")
    opened = {}
    for case, columns in {"sorted": ["domain"], "curve": ["domain", "last_seen"]}.items():
        upkeep.cluster(spark, f"{tmp_path}/in", rows.schema, f"{tmp_path}/{case}", columns, files=64)
        out = layers.table(spark, f"{tmp_path}/{case}", rows.schema)
        assert out.exceptAll(rows).count() == 0 and out.count() == 16_000
        opened[case] = {r.column: (r.files, r.opened) for r in upkeep.lookups(out, ["domain", "last_seen"]).collect()}
    assert opened["sorted"]["domain"][1] < 3 and opened["sorted"]["last_seen"][1] > 50
    for files, on_average in opened["curve"].values():
        assert files == 64 and on_average <= 2 * 8


def test_a_curve_opens_little_more_than_the_root_of_the_files(spark, tmp_path):
    """Files span short pieces of both columns, whether these depend on each other or not."""
    at = [F.pmod(F.xxhash64("id", F.lit(n)), F.lit(1 << 40)) / float(1 << 40) for n in range(2)]
    cases = {"apart": at, "narrowing": [at[0], F.when(at[0] < 0.5, at[1]).otherwise(at[1] * 0.4)]}
    for case, (a, b) in cases.items():
        rows = spark.range(8000).select(a.alias("a"), b.alias("b"))
        rows.write.parquet(f"{tmp_path}/{case}")
        upkeep.cluster(spark, f"{tmp_path}/{case}", rows.schema, f"{tmp_path}/{case}-out", ["a", "b"], files=64)
        out = layers.table(spark, f"{tmp_path}/{case}-out", rows.schema)
        assert out.count() == 8000
        assert all(r.files == 64 and r.opened <= 1.25 * 8 for r in upkeep.lookups(out, ["a", "b"]).collect())


def test_curve_of_equal_null_and_no_rows(spark, tmp_path):
    for case, rows in {
        "equal": spark.range(500).select(F.lit("x").alias("domain"), F.lit(None).cast("date").alias("day")),
        "none": spark.range(0).select(F.lit("x").alias("domain"), F.lit(None).cast("date").alias("day")),
    }.items():
        rows.write.parquet(f"{tmp_path}/{case}")
        upkeep.cluster(spark, f"{tmp_path}/{case}", rows.schema, f"{tmp_path}/{case}-out", ["domain", "day"], files=4)
        out = layers.table(spark, f"{tmp_path}/{case}-out", rows.schema)
        assert out.count() == rows.count()
        assert out.groupBy(F.col("_metadata.file_path")).count().filter("count > 250").count() == 0


def test_compact_merges_small_files_and_keeps_rows(spark, tmp_path):
    rows = gold_rows(spark, 300).withColumn("category", F.when(F.col("domain_hash") % 3 == 0, "a").otherwise("b"))
    rows.repartition(12).write.partitionBy("category").parquet(f"{tmp_path}/in")
    upkeep.compact(spark, f"{tmp_path}/in", schemas.GOLD, f"{tmp_path}/out", ["category"])
    files = [upkeep.table_statistics(spark, f"{tmp_path}/{d}").first() for d in ("in", "out")]
    assert files[0].row_count == files[1].row_count == 300
    assert files[0].file_count == 24 and files[1].file_count == 2
    assert same(*[layers.table(spark, f"{tmp_path}/{d}", schemas.GOLD) for d in ("in", "out")])


def test_statistics_of_no_table(spark, tmp_path):
    row = upkeep.table_statistics(spark, f"{tmp_path}/nothing").first()
    assert row.row_count is None and "nothing" in row.error


def test_registry(spark):
    rows = {r.source: r for r in registry(spark).collect()}
    assert set(rows) == {"stevenblack", "urlhaus", "1hosts", "adwars"}
    assert (rows["urlhaus"].format, rows["urlhaus"].category) == ("adblock", "malware")
    assert [r.source for r in registry(spark, only="adwars").collect()] == ["adwars"]


def test_freshness_health_and_required_columns(spark):
    frame = spark.createDataFrame([(BASE, "x"), (None, None)], "t timestamp, v string")
    for as_of, fresh in (("2024-01-31 00:30:00", True), ("2024-01-31 00:30:01", False)):
        row = quality.freshness(frame, "bronze", "t", 30, as_of).first()
        assert (row.layer, row.latest, row.fresh) == ("bronze", BASE, fresh)
    assert quality.freshness(frame.limit(0), "bronze", "t", 30).first().fresh is False
    nulls = {r.column_name: r.nulls for r in quality.not_null(frame, ["t", "v"]).collect()}
    assert nulls == {"t": 1, "v": 1}
    flags = "component string, healthy boolean"
    row = quality.health(spark.createDataFrame([("kafka", True), ("spark", False), ("db", None)], flags)).first()
    assert (row.all_healthy, row.failed_count, row.failed) == (False, 2, '["db","spark"]')
    assert quality.health(spark.createDataFrame([("kafka", True)], flags)).first().all_healthy is True
    assert quality.health(spark.createDataFrame([], flags)).first().all_healthy is False

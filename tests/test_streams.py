from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sievelake import schemas
from sievelake.operators import bronze, gold, messages, silver
from sievelake.sinks.append import batch_stream, trigger
from sievelake.sinks.publish import publish
from sievelake.sources import layers
from sievelake.sources.topics import message_stream
from sievelake.streaming import gold_table, pipeline, progress
from sievelake.tables import batches, catalog, folders, upkeep

AS_OF = "2024-02-01"
BASE = datetime(2024, 1, 31)
ENTRY = (
    "domain string, category string, source string, source_format string, raw_entry string, "
    "ingestion_timestamp timestamp, metadata map<string,string>, offset bigint"
)


class Lake:
    """One set of folders, with every stream run until it has caught up."""

    def __init__(self, spark, root, **gold_options):
        self.spark, self.root, self.gold_options = spark, str(root), gold_options
        self.sent = 0

    def send(self, rows):
        frame = self.spark.createDataFrame(
            [
                (d, c, s, "hosts", f"0.0.0.0 {d}", BASE + timedelta(minutes=m), {"m": str(m)}, self.sent + i)
                for i, (d, c, s, m) in enumerate(rows)
            ],
            ENTRY,
        )
        self.sent += len(rows)
        publish(messages.to_messages(frame), path=f"{self.root}/topics")

    def catch_up(self, *names):
        root, spark = self.root, self.spark
        start = {
            "bronze": lambda: pipeline.bronze(
                message_stream(spark, path=f"{root}/topics", max_files_per_trigger=1),
                f"{root}/bronze", f"{root}/c/bronze", interval=None, as_of=AS_OF,
            ),
            "silver": lambda: pipeline.silver(
                spark, f"{root}/bronze", f"{root}/silver", f"{root}/c/silver", interval=None, as_of=AS_OF,
            ),
            "gold": lambda: pipeline.gold(
                spark, f"{root}/silver", f"{root}/gold", f"{root}/c/gold", interval=None, as_of=AS_OF,
                max_files_per_trigger=1, **self.gold_options,
            ),
        }
        for name in names or start:
            query = start[name]()
            query.awaitTermination()
            assert query.exception() is None

    def count(self, layer):
        schema = {"bronze": schemas.BRONZE, "silver": schemas.SILVER}[layer]
        return layers.table(self.spark, f"{self.root}/{layer}", schema).count()

    def gold(self):
        return gold_table.read(self.spark, f"{self.root}/gold", AS_OF)

    def batch_gold(self):
        """The same table in one batch job over all messages."""
        sent = self.spark.read.schema(schemas.TRANSPORT).parquet(f"{self.root}/topics")
        rows = silver.transform(bronze.transform(sent, AS_OF), AS_OF)
        return gold.aggregate(silver.valid_only(rows), AS_OF)


def same(a, b):
    a, b = (x.withColumn("metadata", F.to_json("metadata")) for x in (a, b))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


FIRST = [
    ("malware-site.com", "malware", "stevenblack", 0),
    ("phishing.example.com", "malware", "urlhaus", 0),
    ("Trojan.BadSite.net", "malware", "malwaredomainlist", 0),
    ("tracker.ads.com", "ads_trackers", "easylist", 0),
    ("not a domain", "ads_trackers", "easyprivacy", 0),
    ("malware-site.com", "malware", "urlhaus", 60),
]


def test_stream_equals_batch_and_restart_adds_only_new_rows(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.send(FIRST)
    lake.catch_up()
    assert (lake.count("bronze"), lake.count("silver"), lake.gold().count()) == (6, 6, 4)
    assert same(lake.gold(), lake.batch_gold())
    lake.catch_up()
    assert (lake.count("bronze"), lake.count("silver")) == (6, 6)
    # Late rows: earlier than anything seen, for a known and for a new domain.
    lake.send([("malware-site.com", "ads_trackers", "late", -6000), ("new.com", "malware", "late", -6000)])
    lake.catch_up()
    assert (lake.count("bronze"), lake.count("silver"), lake.gold().count()) == (8, 8, 5)
    assert same(lake.gold(), lake.batch_gold())
    counts = {n: spark.sql(f"SELECT count(*) FROM {n}.domains").first()[0] for n in ("bronze", "silver", "gold")}
    assert counts == {"bronze": 8, "silver": 8, "gold": 5}
    site = lake.gold().filter("domain = 'malware-site.com'").first()
    assert (site.category, site.source_count) == ("malware", 3)
    assert site.first_seen == BASE - timedelta(minutes=6000) and site.metadata == {"m": "-6000"}


def test_two_sources_and_both_categories(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.send([(f"d{i}.com", "malware", "one", i) for i in range(10)])
    lake.send([(f"d{i}.com", "ads_trackers", "two", i) for i in range(5, 15)])
    lake.catch_up()
    rows = lake.gold().collect()
    assert len(rows) == 15
    assert sorted(r.domain for r in rows if r.source_count == 2) == [f"d{i}.com" for i in range(5, 10)]
    assert {r.category for r in rows if r.source_count == 2} == {"malware"}
    assert sum(r.category == "ads_trackers" for r in rows) == 5


def test_gold_restarts_under_publishing(spark, tmp_path):
    """Small batches, a version every second one, and restarts in between."""
    published = f"{tmp_path}/published"
    lake = Lake(spark, tmp_path, published=published, publish_every=2, buckets=3)
    for day in range(5):
        lake.send([(f"d{i}.com", "malware" if i == day else "ads_trackers", f"s{day}", day * 1440 + i) for i in range(6)])
        lake.catch_up()
    path = f"{lake.root}/gold"
    assert same(lake.gold(), lake.batch_gold())
    now = gold_table.current(spark, path)
    n = len(folders.glob(spark, f"{path}/run=*/batch_id=*")) - 1
    assert n >= 5 and now.buckets == 3 and list(now.folded.values()) == [n // 2 * 2 - 1]
    spare = gold_table.superseded(spark, path, published)
    assert len(spare) == n // 2 - 1 + n // 2 * 2 and upkeep.vacuum(spark, spare) == []
    assert sorted(upkeep.vacuum(spark, spare, retention_hours=-1)) == sorted(spare)
    assert gold_table.superseded(spark, path, published) == []
    assert same(lake.gold(), lake.batch_gold())


def test_failed_publishing_stops_no_stream(spark, tmp_path, monkeypatch, caplog):
    def fail(*_, **__):
        raise OSError("no space")

    monkeypatch.setattr(gold_table, "publish", fail)
    lake = Lake(spark, tmp_path, published=f"{tmp_path}/published", publish_every=1)
    lake.send(FIRST)
    lake.catch_up()
    assert "publishing" in caplog.text and lake.gold().count() == 4


def silver_rows(spark, rows):
    return spark.createDataFrame(
        [
            (d, c, s, "hosts", d, BASE, BASE, BASE, {"m": str(m)}, "true", None, BASE.date(), m)
            for d, c, s, m in rows
        ],
        schemas.SILVER,
    )


def new_states(spark, path):
    gold_table.open_view(spark, path, AS_OF)
    return path


def test_replayed_batch_changes_nothing(spark, tmp_path):
    path, target = new_states(spark, f"{tmp_path}/states"), f"{tmp_path}/published"
    one = silver_rows(spark, [("a.com", "malware", "s", 1), ("b.com", "ads_trackers", "s", 2)])
    two = silver_rows(spark, [("a.com", "ads_trackers", "t", 3)])
    gold_table.append(one, path, "run", 0, AS_OF)
    gold_table.append(two, path, "run", 1, AS_OF)
    expected = sorted(gold_table.read(spark, path, AS_OF).collect())
    gold_table.append(two, path, "run", 1, AS_OF)
    assert sorted(gold_table.read(spark, path, AS_OF).collect()) == expected
    for _ in range(2):
        gold_table.publish(spark, path, target, buckets=2, as_of=AS_OF)
        gold_table.append(two, path, "run", 1, AS_OF)
        assert sorted(gold_table.read(spark, path, AS_OF).collect()) == expected
    # Another checkpoint counts from zero again, next to the first run.
    gold_table.append(silver_rows(spark, [("a.com", "malware", "u", 9)]), path, "again", 0, AS_OF)
    rows = {r.domain: r.source_count for r in gold_table.read(spark, path, AS_OF).collect()}
    assert rows == {"a.com": 3, "b.com": 1}
    assert gold_table.publish(spark, path, target, as_of=AS_OF).folded == {"run": 1, "again": 0}


def test_a_batch_appears_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(9).select("id", (F.col("id") % 3).alias("day"))

    def lost(*_):
        raise OSError("lost before the rename")

    with monkeypatch.context() as broken, pytest.raises(OSError):
        broken.setattr(batches.folders, "move", lost)
        batches.write_batch(rows, path, "run", 0, ["day"])
    assert not folders.exists(spark, f"{path}/run=run")
    assert batches.write_batch(rows, path, "run", 0, ["day"])
    files = folders.glob(spark, f"{path}/run=run/batch_id=0/day=*/*.parquet")
    assert len(files) == 3
    assert not batches.write_batch(rows, path, "run", 0, ["day"])
    assert folders.glob(spark, f"{path}/run=run/batch_id=0/day=*/*.parquet") == files
    assert spark.read.parquet(path).count() == 9


def test_a_date_with_most_rows_is_split(spark, tmp_path):
    path, advisory = str(tmp_path / "t"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(0, 200_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("x"), F.when(F.col("id") < 190_000, 1).otherwise(F.col("id") % 5).alias("day"))
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "1MB")
    try:
        batches.write_batch(rows, path, "run", 0, ["day"])
    finally:
        spark.conf.set(advisory, before)
    per_day = spark.read.parquet(path).groupBy("day", F.col("_metadata.file_path")).count().groupBy("day").agg(F.count("*").alias("files"), F.max("count").alias("most")).collect()
    found = {r.day: (r.files, r.most) for r in per_day}
    assert found[1][0] >= 4 and found[1][1] < 100_000
    assert sum(files for files, _ in found.values()) <= 5 + 200_000 * 70 // (1 << 20)


def prunes_dates(frame):
    """Whether every scan of the physical plan filters its folders by date."""
    executed = frame._jdf.queryExecution().executedPlan()
    scans = [executed.collectLeaves().apply(i) for i in range(executed.collectLeaves().size())]
    return bool(scans) and all("ingestion_date" in s.partitionFilters().toString() for s in scans)


def test_views_prune_dates_and_carry_properties(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.send([(f"d{i}.com", "malware", "s", i * 1440) for i in range(3)])
    lake.catch_up("bronze", "silver")
    one = spark.sql("SELECT domain FROM bronze.domains WHERE ingestion_date = DATE '2024-02-01'")
    assert [r.domain for r in one.collect()] == ["d1.com"]
    assert prunes_dates(one)
    assert [c.name for c in spark.catalog.listColumns("silver.domains")] == schemas.SILVER.fieldNames()
    batches.open_view(spark, "bronze.domains", f"{lake.root}/bronze", schemas.BRONZE, {"owner": "it's me"})
    assert catalog.properties_of(spark, "bronze.domains")["owner"] == "it's me"
    assert catalog.properties_of(spark, "bronze.nothing") == {}
    # A table without any batch can be read, too.
    assert catalog.ensure_table(spark, f"{tmp_path}/new", schemas.SILVER, ["run", "batch_id", "ingestion_date"])
    batches.open_view(spark, "silver.new", f"{tmp_path}/new", schemas.SILVER)
    assert spark.table("silver.new").count() == 0 and spark.table("silver.new").schema["ingestion_date"].dataType.typeName() == "date"


def files_of(spark, name):
    return spark.table(name).select(F.input_file_name()).distinct().count()


def test_compaction_between_batches_is_seen_by_readers_only(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    target, path = f"{tmp_path}/compacted", f"{lake.root}/bronze"
    send = lambda day: lake.send([(f"d{i}.com", "malware", "s", day * 1440 + i) for i in range(4)])
    for day in (0, 0, 1):
        send(day)
        lake.catch_up("bronze", "silver")
    batches.open_view(spark, "bronze.domains", path, schemas.BRONZE, {"owner": "me"})
    before, files = sorted(spark.table("bronze.domains").collect()), files_of(spark, "bronze.domains")
    spare = batches.compact(spark, "bronze.domains", schemas.BRONZE, target, ["ingestion_date"])
    assert sorted(spark.table("bronze.domains").collect()) == before
    assert files_of(spark, "bronze.domains") == 2 < files and len(spare) >= 3
    # The streams go on, from their checkpoints, and see nothing of it.
    send(1)
    lake.catch_up()
    rows = spark.table("bronze.domains")
    assert rows.count() == 16 and lake.count("silver") == 16 and lake.gold().count() == 4
    # Only what came since is rewritten the next time, and a failed attempt is not seen.
    folders.touch(spark, f"{target}/run=compacted/batch_id=1/ingestion_date=2024-01-01/part-half.parquet")
    batches.compact(spark, "bronze.domains", schemas.BRONZE, target, ["ingestion_date"])
    assert spark.table("bronze.domains").count() == 16 and files_of(spark, "bronze.domains") == 3
    one = spark.sql("SELECT * FROM bronze.domains WHERE ingestion_date = DATE '2024-01-31'")
    assert one.count() == 8 and prunes_dates(one)


def test_published_side_is_neither_shuffled_nor_read_for_other_names(spark, tmp_path):
    path, target = new_states(spark, f"{tmp_path}/states"), f"{tmp_path}/published"
    names = [f"d{i:05d}.com" for i in range(3000)]
    gold_table.append(silver_rows(spark, [(d, "malware", "s", 1) for d in names]), path, "run", 0, AS_OF)
    gold_table.publish(spark, path, target, buckets=4, as_of=AS_OF)
    gold_table.append(silver_rows(spark, [("d00007.com", "malware", "t", 2), ("new.com", "malware", "t", 2)]), path, "run", 1, AS_OF)
    found = gold_table.read(spark, path, AS_OF)
    version = gold_table.current(spark, path)
    folding = spark.sql(gold_table._folded(path, version, {"run": 1}))
    for frame in (found, folding):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = frame._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        scans = [line for line in plan.splitlines() if "version_" in line and "Scan" in line]
        assert scans and all("Bucketed: true" in line for line in scans)
        # Only the newer states are dealt, by the hint.
        assert all("REPARTITION_BY_NUM" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert found.count() == 3001
    rows = found.filter("domain IN ('d00007.com', 'new.com', 'nowhere.com')").collect()
    assert sorted((r.domain, r.source_count) for r in rows) == [("d00007.com", 2), ("new.com", 1)]
    plan = found.filter("domain = 'd00007.com'")._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of 4" in plan and "PushedFilters: [IsNotNull(domain), EqualTo(domain,d00007.com)]" in plan


def scanned(frame):
    """Rows that the scans of an executed frame gave out."""
    frame.collect()

    def total(plan):
        own = plan.metrics().get("numOutputRows").get().value() if "Scan" in plan.nodeName() else 0
        inner = plan.executedPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else None
        children = [inner] if inner is not None else [plan.children().apply(i) for i in range(plan.children().size())]
        return own + sum(map(total, children))

    return total(frame._jdf.queryExecution().executedPlan())


def test_bloom_filters_skip_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(gold_table, "ROW_GROUP_BYTES", 4096)
    path = new_states(spark, f"{tmp_path}/states")
    # Names in between, so that min and max alone skip nothing.
    names = [f"d{i:05d}.com" for i in range(0, 8000, 2)]
    gold_table.append(silver_rows(spark, [(d, "malware", "s", 1) for d in names]), path, "run", 0, AS_OF)
    version = gold_table.publish(spark, path, f"{tmp_path}/published", buckets=1, as_of=AS_OF)
    table = spark.table(version.table)
    missing = [scanned(table.filter(F.col("domain") == f"d{i:05d}.com")) for i in range(1001, 1041, 2)]
    there = [scanned(table.filter(F.col("domain") == f"d{i:05d}.com")) for i in range(1000, 1010, 2)]
    assert all(0 < n < 4000 for n in there)
    assert sum(n == 0 for n in missing) >= 18


def test_published_gold_is_a_catalog_name(spark, tmp_path):
    path = new_states(spark, f"{tmp_path}/gold")
    for number, domain in enumerate(("a.com", "b.com")):
        rows = silver_rows(spark, [(domain, "malware", "s", 1)])
        gold_table.append(rows, path, "run", number, AS_OF)
        gold_table.publish(spark, path, f"{tmp_path}/out", as_of=AS_OF)
        assert spark.sql("SELECT count(*) AS n FROM gold.domains").first().n == number + 1
    # The name follows the table it was opened for last.
    other = new_states(spark, f"{tmp_path}/other")
    assert spark.table("gold.domains").count() == 0 and gold_table.current(spark, path) == gold_table.Version()
    assert gold_table.publish(spark, other, f"{tmp_path}/out2", as_of=AS_OF).folded == {}


def test_any_mix_of_versions_and_batches(spark, tmp_path):
    """Four batches, versions after some of them, also with a new bucket count, against one pass."""
    batches = [
        silver_rows(spark, [(f"d{i}.com", "malware" if i == b else "ads_trackers", f"s{b}", b * 100 + i) for i in range(b, b + 9)])
        for b in range(4)
    ]
    for case, plan in enumerate(["", "p", " p p", "pppp"]):
        path = new_states(spark, f"{tmp_path}/{case}")
        everything = None
        for b, batch in enumerate(batches):
            gold_table.append(batch, path, "run", b, AS_OF)
            everything = batch if everything is None else everything.unionByName(batch)
            if plan[b : b + 1] == "p":
                gold_table.publish(spark, path, f"{tmp_path}/{case}p", buckets=3 + b % 2, as_of=AS_OF)
        table = gold_table.read(spark, path, AS_OF)
        assert same(table, gold.aggregate(everything, AS_OF)), plan
        assert table.count() == 12 and table.select("domain").distinct().count() == 12
        one = table.filter("domain = 'd5.com'").collect()
        assert [(r.domain, r.source_count) for r in one] == [("d5.com", 4)]


def test_valid_filter_reaches_the_scan(spark, tmp_path):
    silver_rows(spark, [("a.com", "malware", "s", 1)]).write.partitionBy("ingestion_date").parquet(f"{tmp_path}/s")
    frame = silver.valid_only(layers.table(spark, f"{tmp_path}/s", schemas.SILVER)).select("domain")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_valid,true)" in plan and "ReadSchema: struct<domain:string,is_valid:string>" in plan


def test_only_subscribed_topics(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.send(FIRST)
    stream = message_stream(spark, ["ads_trackers_domains"], path=f"{tmp_path}/topics")
    query = stream.writeStream.format("memory").queryName("ads_only").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("ads_only").count() == 2
    with pytest.raises(ValueError):
        message_stream(spark)


def test_processing_time_stream_has_a_name_and_stops(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.send(FIRST)
    query = pipeline.bronze(
        message_stream(spark, path=f"{tmp_path}/topics"), f"{tmp_path}/bronze", f"{tmp_path}/c",
        interval="1 second", name="named",
    )
    query.processAllAvailable()
    assert query.name == "named" and query.isActive
    query.stop()
    assert not query.isActive and lake.count("bronze") == 6


def test_triggers():
    assert trigger("5 seconds") == {"processingTime": "5 seconds"}
    assert trigger("1 Minute") == {"processingTime": "1 minutes"}
    assert trigger(None) == {"availableNow": True}
    for bad in ("2 hours", "soon", "", "seconds"):
        with pytest.raises(ValueError):
            trigger(bad)


def test_a_batch_tried_again_counts_its_rows_once(spark, tmp_path):
    rows = [("a.com", "malware"), ("-bad", "malware"), ("b.com", "ads_trackers")]
    spark.createDataFrame(rows, "domain string, category string").write.parquet(str(tmp_path / "in"))
    landed = spark.readStream.schema("domain string, category string").parquet(str(tmp_path / "in"))
    seen = landed.observe("landed", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("domain") == "-bad").alias("bad"))
    failing = []

    def write(batch, run, number):
        batch.write.mode("overwrite").parquet(str(tmp_path / "out"))
        if not failing:
            failing.append(number)
            raise ValueError("once")

    counts = progress.Counts()
    spark.streams.addListener(counts)
    try:
        first = batch_stream(seen, write, str(tmp_path / "checkpoint"), interval=None)
        with pytest.raises(StreamingQueryException):
            first.awaitTermination()
        assert counts.of(first) == {}
        again = batch_stream(seen, write, str(tmp_path / "checkpoint"), interval=None)
        again.awaitTermination()
        assert counts.of(again) == {"landed": {"rows": 3, "bad": 1}}
    finally:
        spark.streams.removeListener(counts)

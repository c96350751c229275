"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Times leave as text and maps as their values, so that the results of two engines can be
compared byte for byte.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake import schemas
from sievelake.functions import domains
from sievelake.operators import bronze, gold, lists, messages, quality, silver, stats, validate
from sievelake.plans import feeds, ingest
from sievelake.settings import FRESHNESS_MINUTES
from sievelake.sinks.publish import publish
from sievelake.sources import files, layers
from sievelake.sources.topics import message_stream
from sievelake.streaming import gold_table, pipeline, progress
from sievelake.tables import batches, catalog, folders, upkeep

CHECKED_AT = "2024-01-31 00:20:00"


def stamp(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


# Cleaning and validation


def clean_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = feeds.dirty_entries(spark, sf_dir)
    return names.select(
        F.col("offset").alias("page_id"), "kind", domains.clean(F.col("domain")).alias("domain")
    )


def valid_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = feeds.dirty_entries(spark, sf_dir)
    return names.select(
        F.col("offset").alias("page_id"), "kind", domains.is_valid(F.col("domain")).alias("valid")
    )


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains.register_sql(spark)
    feeds.dirty_entries(spark, sf_dir).createOrReplaceTempView("dirty_entries")
    return spark.sql(
        "SELECT kind, count(clean_domain(domain)) AS cleaned, "
        "count_if(is_valid_domain(domain)) AS valid FROM dirty_entries GROUP BY kind"
    )


def clean_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains among all words of the documents, with their number of mentions."""
    words = feeds.texts(spark, sf_dir, "documents").select(
        F.explode(F.split("text", "[^A-Za-z0-9.-]+", -1)).alias("word")
    )
    return (
        words.select(F.explode(domains.cleaned(F.col("word"))).alias("domain"))
        .groupBy("domain")
        .agg(F.count("*").alias("mentions"))
    )


def silver_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.silver_rows(feeds.dirty_entries(spark, sf_dir)).select(
        "domain",
        "category",
        "source",
        "source_format",
        "raw_entry",
        stamp("ingestion_timestamp"),
        stamp("bronze_timestamp"),
        stamp("silver_timestamp"),
        F.col("metadata")["page"].alias("page"),
        "is_valid",
        "validation_errors",
        day("ingestion_date"),
        "bronze_offset",
    )


def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th message is cut off, every 50th other one has an unreadable time."""
    turn = F.col("offset") % 50
    text = F.col("value").cast("string")
    broken = (
        F.when(turn == 0, F.substring(text, 1, 40))
        .when(turn == 1, F.replace(text, F.lit('"ingestion_timestamp":"20'), F.lit('"ingestion_timestamp":"x')))
        .otherwise(text)
    )
    rows = feeds.transport(feeds.events(spark, sf_dir)).withColumn("value", broken.cast("binary"))
    return bronze.transform(rows, feeds.AS_OF).select(
        "domain",
        "category",
        "source",
        "source_format",
        "raw_entry",
        stamp("ingestion_timestamp"),
        F.col("metadata")["k"].alias("k"),
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        stamp("kafka_timestamp"),
        stamp("bronze_timestamp"),
        day("ingestion_date"),
    )


# Lists


def list_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = feeds.texts(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("content")
    )
    return lists.lines(documents)


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.parse(
        lists.lines(feeds.list_documents(spark, sf_dir)),
        feeds.list_registry(spark),
        feeds.FETCHED,
    )


def _parsed(spark: SparkSession, sf_dir: str, source_format: str) -> DataFrame:
    return (
        _entries(spark, sf_dir)
        .filter(F.col("source_format") == source_format)
        .select(
            "domain",
            "category",
            "source",
            "source_format",
            "raw_entry",
            stamp("ingestion_timestamp"),
            F.col("path").alias("page_id"),
            "line_number",
            F.col("metadata")["line_number"].alias("metadata_line"),
            F.col("metadata")["http_status"].alias("http_status"),
        )
    )


def hosts_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "hosts")


def adblock_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "adblock")


def parse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = feeds.list_documents(spark, sf_dir).unionByName(feeds.faulty_documents(spark, sf_dir))
    failed = lists.failures(documents, feeds.list_registry(spark))
    return failed.select("source", F.col("path").alias("page_id"), "reason")


def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = validate.clean_and_validate(_entries(spark, sf_dir), named=True)
    return kept.select(
        "source", "domain", "raw_entry", F.col("path").alias("page_id"), "line_number"
    )


def dedupe_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed entries are all valid, so the strict mode lets them through."""
    kept = validate.strict(_entries(spark, sf_dir))
    return kept.groupBy("source", "category").agg(
        F.count("*").alias("domains"), F.sum("line_number").alias("line_numbers")
    )


def dedupe_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = feeds.dirty_entries(spark, sf_dir).select(
        "domain", "source", F.col("offset").alias("page_id"), "kind"
    )
    return validate.lenient(names, ["page_id", "kind"])


def validation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = feeds.dirty_entries(spark, sf_dir)
    cleaned = stats.validation(entries).withColumn("mode", F.lit("clean"))
    return cleaned.unionByName(
        stats.validation(entries, clean=False).withColumn("mode", F.lit("as_is"))
    )


def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = feeds.list_documents(spark, sf_dir).unionByName(feeds.faulty_documents(spark, sf_dir))
    job = ingest.plan(
        lists.lines(documents), documents, feeds.list_registry(spark), feeds.FETCHED
    )
    return job.statistics


def list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists landed as text files, scanned in splits, then parsed and validated."""
    landing = folders.scratch(spark, "landing")
    lists.lines(feeds.list_documents(spark, sf_dir)).select(
        F.col("line").alias("value"), "source"
    ).write.partitionBy("source").text(landing)
    numbered = files.scan_lists(spark, landing).lines
    per_file = numbered.groupBy("source", "path").agg(
        F.count("*").alias("n"), F.max("line_number").alias("last")
    )
    lines = per_file.groupBy("source").agg(
        F.sum("n").alias("lines"), F.sum("last").alias("line_numbers")
    )
    entries = lists.parse(numbered, feeds.list_registry(spark), feeds.FETCHED)
    kept = (
        entries.groupBy("source", "domain")
        .agg(F.count("*").alias("n"))
        .groupBy("source")
        .agg(F.sum("n").alias("entries"), F.count("*").alias("domains"))
    )
    return lines.join(kept, "source", "left").select(
        "source", "lines", "line_numbers", "entries", "domains"
    )


def ingest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists landed as files, ingested and sent: messages read back beside all statistics."""
    root = folders.scratch(spark, "ingest-run")
    documents = feeds.list_documents(spark, sf_dir).unionByName(feeds.faulty_documents(spark, sf_dir))
    lists.lines(documents).select(F.col("line").alias("value"), "source").write.partitionBy(
        "source"
    ).text(f"{root}/landing")
    job = ingest.run(
        spark, f"{root}/landing", feeds.list_registry(spark), path=f"{root}/topics",
        work=f"{root}/work", as_of=feeds.FETCHED,
    )

    def measured(part: str, frame: DataFrame, names: list[str]) -> DataFrame:
        return frame.unpivot([], names, "measure", "value").withColumn("part", F.lit(part))

    sent = spark.read.schema(schemas.TRANSPORT).parquet(f"{root}/topics")
    by_topic = sent.groupBy("topic").agg(F.count("*").alias("value"))
    overall = job.published.filter("level = 'overall'").drop("level", "source")
    return (
        by_topic.select(F.col("topic").alias("measure"), "value", F.lit("sent").alias("part"))
        .unionByName(measured("run", job.statistics, job.statistics.columns))
        .unionByName(measured("published", overall, overall.columns))
        .unionByName(measured("validation", job.validation, job.validation.columns))
    )


def _share(spark: SparkSession, pattern: str, batches: int) -> int:
    """Files a micro-batch takes, for so many of them."""
    return max(1, -(-len(folders.glob(spark, pattern)) // batches))


def list_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists landed as files and streamed, some files a batch: entries sent, by topic.

    As more files land, batches take more of them, and do not become more.
    """
    root = folders.scratch(spark, "list-stream")
    documents = feeds.list_documents(spark, sf_dir).unionByName(feeds.faulty_documents(spark, sf_dir))
    lists.lines(documents).select(F.col("line").alias("value"), "source").write.partitionBy(
        "source"
    ).text(f"{root}/landing")
    ingest.stream(
        spark, f"{root}/landing", feeds.list_registry(spark), f"{root}/checkpoint",
        path=f"{root}/topics", interval=None, as_of=feeds.FETCHED,
        max_files_per_trigger=max(16, _share(spark, f"{root}/landing/source=*/*", 4)),
    ).awaitTermination()
    sent = spark.read.schema(schemas.TRANSPORT).parquet(f"{root}/topics")
    value = F.from_json(F.col("value").cast("string"), schemas.MESSAGE_VALUE)
    return sent.select("topic", value.alias("v")).groupBy("topic").agg(
        F.countDistinct("v.source", "v.domain").alias("entries")
    )


# Messages


def to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.from_json(F.col("value").cast("string"), schemas.MESSAGE_VALUE)
    return (
        messages.to_messages(feeds.events(spark, sf_dir))
        .select(F.col("key").cast("string").alias("key"), "topic", "offset", value.alias("v"))
        .select("key", "topic", "offset", "v.*")
        .withColumn("k", F.col("metadata")["k"])
        .drop("metadata")
    )


def publish_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages sent to a folder and read back, by topic."""
    path = folders.scratch(spark, "topics")
    unrouted = F.when(F.col("source") == "signup", "unclassified").otherwise(F.col("category"))
    entries = feeds.sightings(spark, sf_dir).withColumn("category", unrouted)
    publish(feeds.transport(feeds.spread(spark, sf_dir, entries)), path=path)
    sent = spark.read.schema(schemas.TRANSPORT).parquet(path)
    return sent.groupBy("topic").agg(
        F.count("*").alias("messages"),
        F.sum("offset").alias("offsets"),
        F.min(F.col("key").cast("string")).alias("first_key"),
    )


def publish_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups carry a category without a topic, which counts as failed."""
    unrouted = F.when(F.col("source") == "signup", "unclassified").otherwise(F.col("category"))
    return stats.publish(feeds.sightings(spark, sf_dir).withColumn("category", unrouted))


# Reads of the layers


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.silver_rows(feeds.sightings(spark, sf_dir))
    return rows.groupBy("category").agg(F.count("*").alias("domains"))


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.silver_rows(feeds.sightings(spark, sf_dir))
    return rows.agg(F.count("*").alias("n"))


def sample_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rows of one day, by SQL over a registered partitioned table."""
    path = folders.scratch(spark, "bronze")
    feeds.bronze_rows(feeds.events(spark, sf_dir)).write.partitionBy("ingestion_date").parquet(path)
    table = catalog.register_table(
        spark, "bronze", "days", path, schemas.BRONZE, ["ingestion_date"], replace=True
    )
    return spark.sql(
        f"""
        SELECT domain, category, source, kafka_offset,
               date_format(ingestion_date, 'yyyy-MM-dd') AS ingestion_date
        FROM {table} WHERE ingestion_date = DATE '2024-01-10'
        ORDER BY kafka_offset LIMIT 10
        """
    )


# The per-domain table


def published(rows: DataFrame) -> DataFrame:
    return rows.select(
        "domain",
        "category",
        "source_list",
        "source_count",
        stamp("first_seen"),
        stamp("last_seen"),
        stamp("last_updated"),
        "is_active",
        F.col("metadata")["k"].alias("k"),
        F.col("metadata")["page"].alias("page"),
    )


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.silver_rows(feeds.sightings(spark, sf_dir))
    return gold.aggregate(silver.valid_only(rows), feeds.AS_OF)


def gold_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(_gold(spark, sf_dir))


def gold_domain_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir).select("domain", "domain_hash")


def gold_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of the first two weeks, upserted with the rows after them."""
    rows = silver.valid_only(feeds.silver_rows(feeds.sightings(spark, sf_dir)))
    split = F.lit("2024-01-15 00:00:00").cast("timestamp")
    target = gold.aggregate(rows.filter(F.col("ingestion_timestamp") < split), "2024-01-15 00:00:00")
    updates = gold.aggregate(rows.filter(F.col("ingestion_timestamp") >= split), feeds.AS_OF)
    return published(gold.merge_upsert(target, updates, feeds.AS_OF))


def streamed(spark: SparkSession, root: str, interval: str | None = None, files: int | None = None) -> None:
    """The three streams over ``root``, one after the other, until each has caught up.

    With an ``interval`` each is stopped once it has; it would go on otherwise.
    """
    steps = (
        lambda: pipeline.bronze(
            message_stream(spark, path=f"{root}/topics", max_files_per_trigger=files),
            f"{root}/bronze",
            f"{root}/checkpoints/bronze",
            interval=interval,
            as_of=feeds.AS_OF,
        ),
        lambda: pipeline.silver(
            spark,
            f"{root}/bronze",
            f"{root}/silver",
            f"{root}/checkpoints/silver",
            interval=interval,
            as_of=feeds.AS_OF,
        ),
        lambda: pipeline.gold(
            spark,
            f"{root}/silver",
            f"{root}/gold",
            f"{root}/checkpoints/gold",
            interval=interval,
            as_of=feeds.AS_OF,
        ),
    )
    for start in steps:
        query = start()
        if interval is None:
            query.awaitTermination()
        else:
            query.processAllAvailable()
            query.stop()


def _send(spark: SparkSession, sf_dir: str, entries: DataFrame, root: str) -> None:
    """Entries as messages in the topics below ``root``, each task with its own files."""
    publish(feeds.transport(feeds.spread(spark, sf_dir, entries)), path=f"{root}/topics")


def gold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages through all three streams, then read by the name in the catalog."""
    root = folders.scratch(spark, "stream")
    _send(spark, sf_dir, feeds.sightings(spark, sf_dir), root)
    streamed(spark, root)
    return published(spark.sql("SELECT * FROM gold.domains"))


def stream_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer half first; stopped streams go on from their checkpoints with the older half.

    The older rows are late ones by then, and a version is published in between.
    """
    root = folders.scratch(spark, "stream")
    entries = feeds.sightings(spark, sf_dir)
    newer = F.col("ingestion_timestamp") >= F.lit("2024-01-15").cast("timestamp")
    _send(spark, sf_dir, entries.filter(newer), root)
    streamed(spark, root, interval="1 second")
    gold_table.publish(spark, f"{root}/gold", f"{root}/published", as_of=feeds.AS_OF)
    _send(spark, sf_dir, entries.filter(~newer), root)
    streamed(spark, root)
    return published(gold_table.read(spark, f"{root}/gold", feeds.AS_OF))


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first two streams counted while they wrote, from the progress of their batches."""
    root = folders.scratch(spark, "stream")
    entries = feeds.sightings(spark, sf_dir).unionByName(feeds.dirty_entries(spark, sf_dir).drop("kind"))
    _send(spark, sf_dir, entries, root)
    share = _share(spark, f"{root}/topics/topic=*/*.parquet", 6)
    counts = progress.Counts()
    spark.streams.addListener(counts)
    try:
        raw = pipeline.bronze(
            message_stream(spark, path=f"{root}/topics", max_files_per_trigger=share),
            f"{root}/bronze", f"{root}/checkpoints/bronze", interval=None, as_of=feeds.AS_OF,
        )
        raw.awaitTermination()
        flagged = pipeline.silver(
            spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoints/silver",
            interval=None, as_of=feeds.AS_OF,
        )
        flagged.awaitTermination()
        found = {**counts.of(raw), **counts.of(flagged)}
    finally:
        spark.streams.removeListener(counts)
    rows = [(layer, measure, n) for layer, seen in found.items() for measure, n in seen.items()]
    return spark.createDataFrame(rows, "layer string, measure string, n bigint")


def layer_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three layers by SQL on their names while the streams' tables grow."""
    root = folders.scratch(spark, "stream")
    _send(spark, sf_dir, feeds.sightings(spark, sf_dir), root)
    streamed(spark, root)
    day = "DATE '2024-01-10'"
    return spark.sql(
        f"""
        SELECT 'bronze' AS layer, source AS what, count(*) AS n FROM bronze.domains
        WHERE ingestion_date = {day} GROUP BY source
        UNION ALL
        SELECT 'silver', source, count(*) FROM silver.domains
        WHERE ingestion_date = {day} AND is_valid = 'true' GROUP BY source
        UNION ALL
        SELECT 'gold', category, count(*) FROM gold.domains GROUP BY category
        """
    )


def stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream of several batches wrote, run twice: rows, and batches with spare files.

    A batch may have a file for each of its dates and one for each 256 MB.
    """
    root = folders.scratch(spark, "stream")
    entries = feeds.sightings(spark, sf_dir)
    _send(spark, sf_dir, entries, root)
    share = _share(spark, f"{root}/topics/topic=*/*.parquet", 3)
    for _ in range(2):
        pipeline.bronze(
            message_stream(spark, path=f"{root}/topics", max_files_per_trigger=share),
            f"{root}/bronze",
            f"{root}/checkpoint",
            interval=None,
            as_of=feeds.AS_OF,
        ).awaitTermination()
    place = F.struct("run", "batch_id")
    files = (
        spark.read.parquet(f"{root}/bronze")
        .groupBy(place.alias("batch"), "ingestion_date", F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("n"), F.any_value("_metadata.file_size").alias("bytes"))
    )
    batches = files.groupBy("batch").agg(
        F.sum("n").alias("n"),
        (F.count("*") > F.countDistinct("ingestion_date") + F.ceil(F.sum("bytes") / (256 << 20))).alias("spare"),
    )
    return batches.agg(
        F.sum("n").alias("n"),
        (F.count("*") > 1).alias("several"),
        F.count_if("spare").alias("with_spare_files"),
    )


def _halves(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """States of four batches, a version published after the second one, and its folder."""
    root = folders.scratch(spark, "gold")
    rows = silver.valid_only(feeds.silver_rows(feeds.sightings(spark, sf_dir)))
    cuts = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2025-01-01"]
    seen = F.col("ingestion_timestamp")
    gold_table.open_view(spark, f"{root}/states", feeds.AS_OF)
    for number in range(4):
        batch = rows.filter((seen >= cuts[number]) & (seen < cuts[number + 1]))
        gold_table.append(batch, f"{root}/states", "run", number, feeds.AS_OF)
        if number == 1:
            gold_table.publish(spark, f"{root}/states", f"{root}/published", as_of=feeds.AS_OF)
    return f"{root}/states", f"{root}/published"


def gold_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches in a published version, and two after it joined when read."""
    states, _ = _halves(spark, sf_dir)
    return published(gold_table.read(spark, states, feeds.AS_OF))


LOOKED_UP = ("d1.example.org", "d7.example.org", "d42.example.org", "nowhere.example.org", "d1.example.net")


def gold_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some names, listed and unlisted, in a version folded from an earlier one."""
    states, target = _halves(spark, sf_dir)
    gold_table.publish(spark, states, target, as_of=feeds.AS_OF)
    table = gold_table.read(spark, states, feeds.AS_OF)
    return published(table.filter(F.col("domain").isin(*LOOKED_UP)))


def gold_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folders.scratch(spark, "gold")
    _gold(spark, sf_dir).write.parquet(f"{path}/as_written")
    upkeep.cluster(spark, f"{path}/as_written", schemas.GOLD, f"{path}/clustered")
    return published(layers.table(spark, f"{path}/clustered", schemas.GOLD))


def gold_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-domain table along a curve of two columns: rows, and if lookups on each are cheap.

    They are where they open at most twice the square root of all files.
    """
    path = folders.scratch(spark, "gold")
    _gold(spark, sf_dir).write.parquet(f"{path}/as_written")
    columns = ["domain", "last_seen"]
    upkeep.cluster(spark, f"{path}/as_written", schemas.GOLD, f"{path}/clustered", columns, files=64)
    rows = layers.table(spark, f"{path}/clustered", schemas.GOLD)
    cheap = upkeep.lookups(rows, columns).select(
        "column", (F.col("opened") <= 2 * F.sqrt("files")).alias("cheap")
    )
    content = rows.agg(
        F.count("*").alias("n"),
        F.sum("source_count").alias("sources"),
        F.sum(F.col("last_seen").cast("long")).alias("last_seen"),
    )
    # One row beside two.
    return cheap.join(F.broadcast(content), F.lit(True))


def catalog_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-domain table published to the catalog and read by SQL."""
    root = folders.scratch(spark, "gold")
    rows = silver.valid_only(feeds.silver_rows(feeds.sightings(spark, sf_dir)))
    gold_table.open_view(spark, f"{root}/states", feeds.AS_OF)
    gold_table.append(rows, f"{root}/states", "run", 0, feeds.AS_OF)
    gold_table.publish(spark, f"{root}/states", f"{root}/published", as_of=feeds.AS_OF)
    return published(spark.sql("SELECT * FROM gold.domains"))


def silver_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folders.scratch(spark, "silver")
    rows = feeds.silver_rows(feeds.sightings(spark, sf_dir))
    rows.write.partitionBy("ingestion_date").parquet(f"{path}/as_written")
    upkeep.compact(
        spark, f"{path}/as_written", schemas.SILVER, f"{path}/compacted", ["ingestion_date"]
    )
    compacted = layers.table(spark, f"{path}/compacted", schemas.SILVER)
    return compacted.groupBy("ingestion_date", "source").agg(
        F.count("*").alias("n"), F.sum("bronze_offset").alias("offsets")
    ).select(day("ingestion_date"), "source", "n", "offsets")


def live_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer by its name, compacted between two runs of the streams."""
    root = folders.scratch(spark, "stream")
    entries = feeds.sightings(spark, sf_dir)
    even = F.col("offset") % 2 == 0
    _send(spark, sf_dir, entries.filter(even), root)
    share = _share(spark, f"{root}/topics/topic=*/*.parquet", 3)
    streamed(spark, root, files=share)

    def files() -> int:
        return spark.table("bronze.domains").select(F.input_file_name()).distinct().count()

    before = files()
    batches.compact(spark, "bronze.domains", schemas.BRONZE, f"{root}/compacted", ["ingestion_date"])
    fewer = files() < before
    _send(spark, sf_dir, entries.filter(~even), root)
    streamed(spark, root, files=share)
    counted = [
        spark.sql(f"SELECT '{layer}' AS layer, ingestion_date, source, {offset} AS off FROM {layer}.domains")
        for layer, offset in (("bronze", "kafka_offset"), ("silver", "bronze_offset"))
    ]
    return (
        counted[0]
        .unionByName(counted[1])
        .groupBy("layer", day("ingestion_date"), "source")
        .agg(F.count("*").alias("n"), F.sum("off").alias("offsets"), F.lit(fewer).alias("fewer_files"))
    )


# Statistics and quality


def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folders.scratch(spark, "silver")
    rows = feeds.silver_rows(feeds.sightings(spark, sf_dir))
    rows.write.partitionBy("ingestion_date").parquet(path)
    found = upkeep.table_statistics(spark, path)
    return found.select("row_count", "error")


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = feeds.sightings(spark, sf_dir)
    by_layer = {
        "bronze": (feeds.bronze_rows(entries), "ingestion_timestamp"),
        "silver": (silver.valid_only(feeds.silver_rows(entries)), "ingestion_timestamp"),
        "gold": (_gold(spark, sf_dir), "last_seen"),
    }
    checks = [
        quality.freshness(frame, layer, column, FRESHNESS_MINUTES[layer], CHECKED_AT)
        for layer, (frame, column) in by_layer.items()
    ]
    together = checks[0].unionByName(checks[1]).unionByName(checks[2])
    return together.select("layer", stamp("latest"), "fresh")


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources are the components; one is healthy if it was seen in the last half hour."""
    limit = F.lit(CHECKED_AT).cast("timestamp") - F.expr("INTERVAL 30 MINUTES")
    components = (
        feeds.events(spark, sf_dir)
        .groupBy(F.col("source").alias("component"))
        .agg((F.max("ingestion_timestamp") >= limit).alias("healthy"))
    )
    return quality.health(components)


def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.silver_rows(feeds.dirty_entries(spark, sf_dir))
    return quality.not_null(rows, schemas.REQUIRED["silver"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        clean_domains,
        valid_domains,
        sql_functions,
        clean_words,
        silver_flags,
        bronze_parse,
        list_lines,
        hosts_parse,
        adblock_parse,
        parse_failures,
        dedupe_first,
        dedupe_lenient,
        dedupe_strict,
        validation_stats,
        run_stats,
        list_files,
        ingest_run,
        list_stream,
        to_messages,
        publish_stats,
        publish_topics,
        category_counts,
        row_count,
        sample_day,
        gold_domains,
        gold_domain_hash,
        gold_merge,
        gold_stream,
        stream_recovery,
        stream_counts,
        stream_files,
        layer_views,
        gold_compacted,
        gold_lookup,
        gold_clustered,
        gold_curve,
        catalog_gold,
        silver_compacted,
        live_compaction,
        table_stats,
        freshness,
        health,
        not_null,
    )
}

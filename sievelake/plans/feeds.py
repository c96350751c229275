"""The given tables seen as blocklist input.

events are sightings of one domain per user, pages are sightings of dirty URLs, and each
page is also a list document whose lines are made of its words. Plain selects only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.functions.domains import ALNUM, LETTER
from sievelake.operators import messages, silver
from sievelake.sources.registry import registry
from sievelake.tables import folders

# Bytes of a table's files whose rows are taken apart, or made messages, by one task.
TASK_BYTES = 4 << 20
AS_OF = "2024-02-01 00:00:00"
FETCHED = "2024-01-31 12:00:00"

# The list sources. Pages are spread over the first four; the last has no known format and
# gets documents only where failures are asked for.
LIST_SOURCES = {
    "hosts-a": {"format": "hosts", "category": "malware"},
    "hosts-b": {"format": "hosts", "category": "ads_trackers"},
    "rules-a": {"format": "adblock", "category": "malware"},
    "rules-b": {"format": "adblock", "category": "ads_trackers"},
    "other": {"format": "csv", "category": "ads_trackers"},
}
PAGE_SOURCES = ("hosts-a", "hosts-b", "rules-a", "rules-b")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession, sf_dir: str, *names: str) -> int:
    """Tasks for work on some tables that makes their rows many or long: one for ``TASK_BYTES``."""
    size = sum(folders.size(spark, f"{sf_dir}/{name}.parquet") for name in names)
    return max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose long texts are to be taken apart, dealt out by its id.

    A row of text here becomes hundreds of rows, and splits of the file do not bound a task:
    a file may hold all its texts in one row group, which is read by one task.
    """
    table = load(spark, sf_dir, name)
    return table.repartition(tasks(spark, sf_dir, name), table.columns[0])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of events, with message offset and time."""
    domain = F.concat(F.lit("d"), F.col("user_id").cast("string"), F.lit(".example.org"))
    stamp = F.col("ts").cast("timestamp")
    return load(spark, sf_dir, "events").select(
        domain.alias("domain"),
        F.when(F.col("event_type") == "error", "malware")
        .otherwise("ads_trackers")
        .alias("category"),
        F.col("event_type").alias("source"),
        F.lit("hosts").alias("source_format"),
        F.concat(F.lit("0.0.0.0 "), domain).alias("raw_entry"),
        stamp.alias("ingestion_timestamp"),
        F.from_json("props", "map<string,string>").alias("metadata"),
        F.col("event_id").alias("offset"),
        stamp.alias("timestamp"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of pages: the URL is the dirty domain, its scheme the source."""
    minutes = (F.col("page_id") % 43200).cast("int")
    stamp = F.timestamp_add("MINUTE", minutes, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return load(spark, sf_dir, "pages").select(
        F.col("url").alias("domain"),
        F.when(F.col("page_id") % 3 == 0, "malware").otherwise("ads_trackers").alias("category"),
        F.substring_index("url", ":", 1).alias("source"),
        F.lit("adblock").alias("source_format"),
        F.concat(F.lit("||"), "url", F.lit("^")).alias("raw_entry"),
        stamp.alias("ingestion_timestamp"),
        F.create_map(F.lit("page"), F.col("page_id").cast("string")).alias("metadata"),
        F.col("page_id").alias("offset"),
        stamp.alias("timestamp"),
    )


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).unionByName(pages(spark, sf_dir))


def spread(spark: SparkSession, sf_dir: str, entries: DataFrame) -> DataFrame:
    """Sightings dealt out by their offset, since messages are many times as long as rows of events.

    Dealt by a key, no task sorts its rows first, as it does when they are dealt in turn.
    """
    return entries.repartition(tasks(spark, sf_dir, "events", "pages"), "offset")


def transport(entries: DataFrame) -> DataFrame:
    """Entries as message rows."""
    return messages.to_messages(entries).withColumn("partition", F.lit(0))


def bronze_rows(entries: DataFrame) -> DataFrame:
    """Entries as rows of the raw table, without the way through a message."""
    return entries.select(
        "domain",
        "category",
        "source",
        "source_format",
        "raw_entry",
        "ingestion_timestamp",
        "metadata",
        messages.topic_of(F.col("category")).alias("kafka_topic"),
        F.lit(0).cast("bigint").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.lit(AS_OF).cast("timestamp").alias("bronze_timestamp"),
        F.to_date("ingestion_timestamp").alias("ingestion_date"),
    )


def silver_rows(entries: DataFrame) -> DataFrame:
    return silver.transform(bronze_rows(entries), AS_OF)


def dirty_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of pages under many spellings of their URL and host, good and bad.

    Adds the ``kind`` of spelling; ``domain`` is the name as spelled.
    """
    url = F.col("domain")
    host = F.regexp_extract(url, "^[a-z]+://([^/?#]+)", 1)
    spellings = {
        "url": url,
        "upper": F.upper(url),
        "padded": F.concat(F.lit(" \t"), url, F.lit(" \n")),
        "port": F.concat(host, F.lit(":8080")),
        "two_ports": F.concat(host, F.lit(":1:2")),
        "schemes": F.concat(F.lit("https://http://"), host),
        "schemes_turned": F.concat(F.lit("http://https://"), host),
        "no_scheme": F.concat(F.lit("//"), host, F.lit("?q=1")),
        "www": F.concat(F.lit("www.www."), host),
        "dots": F.concat(host, F.lit("..")),
        "space_dot": F.concat(host, F.lit(" ./p")),
        "dot_space": F.concat(host, F.lit(". /p")),
        "hyphen": F.concat(F.lit("-"), host),
        "underscore": F.concat(F.lit("_"), host),
        "inner_hyphen": F.concat(F.lit("a.-"), host),
        "wildcard": F.concat(F.lit("*."), host),
        "reserved": F.concat(host, F.lit(".test")),
        "local": F.concat(host, F.lit(".localdomain")),
        "long_label": F.concat(F.repeat(F.lit("a"), 64), F.lit("."), host),
        "long_name": F.concat(F.repeat(F.lit("ab."), 90), host),
        "query": F.concat(host, F.lit("?a=b#c")),
        "host": host,
        "address": F.lit("192.168.1.1"),
        "empty": F.lit(""),
    }
    named = F.array(
        *[F.struct(F.lit(k).alias("kind"), v.alias("name")) for k, v in spellings.items()]
    )
    entries = pages(spark, sf_dir)
    kept = [c for c in entries.columns if c != "domain"]
    return entries.select(*kept, F.inline(named)).withColumnRenamed("name", "domain")


def list_registry(spark: SparkSession) -> DataFrame:
    return registry(spark, LIST_SOURCES)


def _around_words(before: str, after: Column) -> Column:
    """A line for each of the ``words`` between two texts; null without words."""
    between = F.concat(after, F.lit(f"\n{before}"))
    joined = F.call_function("array_join", F.col("words"), between)
    return F.when(F.size("words") > 0, F.concat(F.lit(before), joined, after))


def list_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as one list document of its source: all words of its HTML as names."""
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1)
    words = F.regexp_extract_all("html", F.lit(f"[{LETTER.upper()}{ALNUM}.-]+"), F.lit(0))
    id_text = F.col("page_id").cast("string")
    slot = F.col("page_id") % 4
    source = F.element_at(
        F.array(*[F.lit(name) for name in PAGE_SOURCES]), (slot + 1).cast("int")
    )
    # The words of a text are joined at once by what stands between them.
    hosts = [
        F.concat(F.lit("# list "), id_text),
        F.lit(""),
        F.lit("127.0.0.1 localhost"),
        _around_words("0.0.0.0 ", F.concat(F.lit("."), "host")),
        F.concat(F.lit("0.0.0.0 "), "host", F.lit(" # note")),
    ]
    rules = [
        F.lit("[Adblock Plus 2.0]"),
        F.concat(F.lit("! list "), id_text),
        F.lit(""),
        _around_words("||", F.concat(F.lit("."), "host", F.lit("^"))),
        F.concat(F.lit("||"), "host", F.lit("^$third-party")),
        F.lit("##.banner"),
        F.concat(F.lit("||"), "host", F.lit("/ads^")),
    ]
    body = F.when(F.col("words").isNull(), "").otherwise(
        F.when(slot < 2, F.concat_ws("\n", *hosts)).otherwise(F.concat_ws("\n", *rules))
    )
    documents = (
        texts(spark, sf_dir, "pages")
        .withColumns({"host": host, "words": words, "slot": slot, "source": source})
        .withColumn("content", body)
    )
    # Odd pages bring a line number of their own, which wins over ours.
    fetched = F.when(
        F.col("page_id") % 2 == 1,
        F.create_map(
            F.lit("http_status"), F.lit("200"), F.lit("line_number"), F.lit("fetched")
        ),
    ).otherwise(F.create_map(F.lit("http_status"), F.lit("200")))
    return documents.select(
        "source",
        F.col("page_id").alias("path"),
        "content",
        F.length("content").cast("bigint").alias("content_length"),
        fetched.alias("fetch_metadata"),
    )


def faulty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to fail beside the good ones: empty, of no known format, of no known source."""
    page = F.col("page_id")
    line = F.concat(F.lit("||"), "url", F.lit("^"))

    def document(when: Column, source: str, content: Column) -> Column:
        return F.when(when, F.struct(F.lit(source).alias("source"), content.alias("content")))

    faults = F.array(
        document(page % 25 == 7, "hosts-b", F.lit("")),
        document(page % 5 == 4, "other", line),
        document(page % 10 == 3, "stray", line),
    )
    return (
        load(spark, sf_dir, "pages")
        .select(page.alias("path"), F.explode(F.filter(faults, lambda f: f.isNotNull())).alias("f"))
        .select(
            "f.source",
            "path",
            "f.content",
            F.length("f.content").cast("bigint").alias("content_length"),
            F.create_map(F.lit("http_status"), F.lit("200")).alias("fetch_metadata"),
        )
    )

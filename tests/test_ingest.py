from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from sievelake import schemas
from sievelake.operators import bronze, stats
from sievelake.plans import ingest
from sievelake.sources import files
from sievelake.sources.registry import registry

SOURCES = {
    "h": {"format": "hosts", "category": "malware"},
    "a": {"format": "adblock", "category": "ads_trackers"},
    "odd": {"format": "csv", "category": "malware"},
    "void": {"format": "hosts", "category": "malware"},
    "gone": {"format": "hosts", "category": "malware"},
}
FILES = {
    "h": "# hosts\n0.0.0.0 www.one.com\n127.0.0.1 one.com\n0.0.0.0 two.com\n0.0.0.0 localhost\n",
    "a": "[Adblock]\n||one.com^\n||three.com^$third-party\n##.ad\n",
    "odd": "one.com,two.com\n",
    "void": "",
}


def test_landing_to_messages_and_statistics(spark, tmp_path):
    for source, content in FILES.items():
        (tmp_path / "landing" / f"source={source}").mkdir(parents=True)
        (tmp_path / "landing" / f"source={source}" / "list.txt").write_text(content)
    job = ingest.run(
        spark, str(tmp_path / "landing"), registry(spark, SOURCES), path=str(tmp_path / "topics"),
        as_of="2024-02-01",
    )
    assert {(r.source, r.reason) for r in job.failures.collect()} == {
        ("odd", "Unknown format type: csv"),
        ("void", "Empty content received from source"),
        ("gone", "No document fetched"),
    }
    assert job.statistics.first().asDict() == {
        "sources_processed": 2,
        "sources_failed": 3,
        "domains_fetched": 5,
        "domains_validated": 4,
        "domains_published": 4,
    }
    assert job.validation.first().asDict() == {
        "total": 5, "valid": 4, "invalid": 0, "duplicates": 1, "uncleanable": 0,
    }
    # Lines were parsed once: what is left reads the written entries.
    for frame in (job.messages, job.published, job.statistics):
        assert frame.inputFiles() and not any("/landing/" in f for f in frame.inputFiles())
    overall = job.published.filter("level = 'overall'").first()
    assert (overall.malware, overall.ads_trackers, overall.total) == (2, 2, 4)
    rows = bronze.transform(spark.read.schema(schemas.TRANSPORT).parquet(str(tmp_path / "topics")))
    got = {(r.source, r.domain, r.raw_entry, r.line) for r in rows.withColumn("line", F.col("metadata")["line_number"]).collect()}
    # www.one.com and one.com are the same domain; the first line wins.
    assert got == {
        ("h", "one.com", "0.0.0.0 www.one.com", "2"),
        ("h", "two.com", "0.0.0.0 two.com", "4"),
        ("a", "one.com", "||one.com^", "2"),
        ("a", "three.com", "||three.com^$third-party", "3"),
    }
    assert {r.metadata["content_length"] for r in rows.filter("source = 'h'").collect()} == {str(len(FILES["h"]))}


def test_written_entries_are_ranked_in_small_splits(spark, tmp_path, monkeypatch):
    """A task that ranks entries reads a bounded part of them; other reads are as the session says."""
    (tmp_path / "landing" / "source=h").mkdir(parents=True)
    lines = "".join(f"0.0.0.0 host{i}.example.org\n" for i in range(4000))
    (tmp_path / "landing" / "source=h" / "list.txt").write_text(lines)
    monkeypatch.setattr(ingest, "SPLIT_BYTES", 2000, raising=False)
    setting = "spark.sql.files.maxPartitionBytes"
    splits, before, parquet = {}, spark.conf.get(setting), DataFrameWriter.parquet

    def written(self, path, *args, **kwargs):
        if path.endswith("/valid"):
            entries = spark.read.parquet(str(tmp_path / "work" / "entries"))
            splits["ranked"] = entries.rdd.getNumPartitions(), len(entries.inputFiles())
        return parquet(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", written)
    job = ingest.run(
        spark, str(tmp_path / "landing"), registry(spark, SOURCES), path=str(tmp_path / "topics"),
        work=str(tmp_path / "work"), as_of="2024-02-01",
    )
    assert splits["ranked"][0] >= 8 > splits["ranked"][1]
    assert job.valid.count() == 4000 and spark.conf.get(setting) == before


def test_lists_stream_in_splits(spark, tmp_path):
    """Files of two batches, one of them in many splits, give what one run over all gives."""
    landing, topics = tmp_path / "landing", str(tmp_path / "topics")

    def land(source, name, content):
        (landing / f"source={source}").mkdir(parents=True, exist_ok=True)
        (landing / f"source={source}" / name).write_text(content)

    def start():
        job = ingest.stream(
            spark, str(landing), registry(spark, SOURCES), str(tmp_path / "checkpoint"), path=topics,
            interval=None, max_files_per_trigger=1, as_of="2024-02-01",
        )
        job.awaitTermination()

    lines = [f"0.0.0.0 host{i}.example.org" for i in range(4000)]
    land("h", "list [1]*.txt", "\n".join(["# long", *lines]))
    land("void", "empty.txt", "")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        start()
        lines_read = files.scan_lists(spark, str(landing)).lines
        assert lines_read.select(F.spark_partition_id()).distinct().count() >= 8
        land("a", "list.txt", "||late.example.net^\n")
        start()
        start()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    rows = bronze.transform(spark.read.schema(schemas.TRANSPORT).parquet(topics)).collect()
    got = {(r.source, r.domain, int(r.metadata["line_number"])) for r in rows}
    assert got == {("h", f"host{i}.example.org", i + 2) for i in range(4000)} | {("a", "late.example.net", 1)}
    assert len(rows) == 4001


def test_an_empty_landing_counts_nothing(spark, tmp_path):
    (tmp_path / "landing" / "source=void").mkdir(parents=True)
    (tmp_path / "landing" / "source=void" / "list.txt").write_text("")
    job = ingest.run(
        spark, str(tmp_path / "landing"), registry(spark, SOURCES), path=str(tmp_path / "topics"), as_of="2024-02-01"
    )
    assert set(job.validation.first().asDict().values()) == {0}
    assert job.statistics.first().asDict() == {
        "sources_processed": 0, "sources_failed": 5, "domains_fetched": 0, "domains_validated": 0, "domains_published": 0,
    }


def test_observed_statistics_equal_those_counted_from_the_entries(spark, tmp_path):
    for source, content in FILES.items():
        (tmp_path / "landing" / f"source={source}").mkdir(parents=True)
        (tmp_path / "landing" / f"source={source}" / "list.txt").write_text(content)
    job = ingest.run(
        spark, str(tmp_path / "landing"), registry(spark, SOURCES), path=str(tmp_path / "topics"), as_of="2024-02-01"
    )
    assert job.statistics.first() == stats.run(job.entries, job.failures).first()
    assert job.validation.first() == stats.validation(job.entries).first()
    # Counts came with the writes: no table is read for the validation.
    assert not job.validation.inputFiles()

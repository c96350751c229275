"""How the given tables are dealt out to tasks."""

import os

import pytest
from pyspark.sql import functions as F

from sievelake.plans import feeds, queries
from sievelake.tables import folders


def most(frame):
    """Rows of the largest task, and of all."""
    row = frame.groupBy(F.spark_partition_id()).count().agg(F.max("count").alias("most"), F.sum("count").alias("n")).first()
    return row.most, row.n


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    """Pages and events in files of one row group, which are cut into more splits than there are cores."""
    rows = spark.range(4000)
    rows.select(
        F.col("id").alias("page_id"),
        F.concat(F.lit("http://h"), "id", F.lit(".example.org/")).alias("url"),
        F.sha2(F.col("id").cast("string"), 512).alias("html"),
    ).coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    rows.select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("user_id"),
        F.when(F.col("id") % 2 == 0, "error").otherwise("view").alias("event_type"),
        F.lit('{"k": 1}').alias("props"),
    ).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(feeds, "TASK_BYTES", 16 << 10, raising=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield str(tmp_path)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_texts_of_one_row_group_are_dealt_out(spark, tables):
    largest, rows = most(feeds.texts(spark, tables, "pages"))
    assert rows == 4000 and largest < 800


def test_documents_of_one_row_group_are_dealt_out(spark, tables):
    largest, rows = most(feeds.list_documents(spark, tables))
    assert rows == 4000 and largest < 800


def test_messages_of_streams_are_dealt_out_by_size(spark, tables, monkeypatch):
    """Each task has files of its own, and their number leaves the batches as they are."""
    roots = []
    monkeypatch.setattr(
        queries.folders, "scratch", lambda s, label, f=folders.scratch: roots.append(f(s, label)) or roots[-1]
    )
    row = queries.stream_files(spark, tables).first()
    assert (row.n, row.several, row.with_spare_files) == (8000, True, 0)
    sent = folders.glob(spark, f"{roots[0]}/topics/topic=*/*.parquet")
    assert len(sent) >= 2 * 16
    batches = {os.path.basename(p) for p in folders.glob(spark, f"{roots[0]}/bronze/run=*/batch_id=*")}
    assert len({b for b in batches if not b.endswith("=-1")}) <= 3


def test_list_documents_hold_every_word(spark, tmp_path):
    """One line for each word; null texts stay empty, and a null host leaves out its lines."""
    pages = [
        (0, "http://h.org/", "a <b> C-1.x"), (1, "http://h.org/", ""), (2, "http://h.org/x", "é a"),
        (3, "http://h.org/", None), (4, None, "a"), (6, None, "a"),
    ]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    frame = feeds.list_documents(spark, str(tmp_path))
    assert {r.path: r.content for r in frame.collect()} == {
        0: "# list 0\n\n127.0.0.1 localhost\n0.0.0.0 a.h.org\n0.0.0.0 b.h.org\n0.0.0.0 C-1.x.h.org\n0.0.0.0 h.org # note",
        1: "# list 1\n\n127.0.0.1 localhost\n0.0.0.0 h.org # note",
        2: "[Adblock Plus 2.0]\n! list 2\n\n||a.h.org^\n||h.org^$third-party\n##.banner\n||h.org/ads^",
        3: "",
        4: "# list 4\n\n127.0.0.1 localhost",
        6: "[Adblock Plus 2.0]\n! list 6\n\n##.banner",
    }
    assert all(r.content_length == len(r.content) for r in frame.collect())
    assert "transform(" not in frame._jdf.queryExecution().optimizedPlan().toString()

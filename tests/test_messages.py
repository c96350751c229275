import json
from datetime import date, datetime

from pyspark.sql import functions as F

from sievelake import schemas
from sievelake.operators import bronze, messages, stats
from sievelake.sinks.publish import publish
from sievelake.sources import topics

ENTRY = (
    "domain string, category string, source string, source_format string, raw_entry string, "
    "ingestion_timestamp timestamp, metadata map<string,string>"
)


def entries(spark):
    at = datetime(2024, 1, 2, 3, 4, 5, 678901)
    return spark.createDataFrame(
        [
            ("bad.com", "malware", "s1", "hosts", "0.0.0.0 bad.com", at, {"line_number": "7"}),
            ("ads.com", "ads_trackers", "s2", "adblock", "||ads.com^", at.replace(microsecond=0), None),
            ("odd.com", "news", "s2", "adblock", "||odd.com^", at, {}),
        ],
        ENTRY,
    )


def test_envelope(spark):
    rows = {bytes(r.key).decode(): r for r in messages.to_messages(entries(spark)).collect()}
    assert {k: r.topic for k, r in rows.items()} == {
        "bad.com": "malware_domains",
        "ads.com": "ads_trackers_domains",
        "odd.com": None,
    }
    assert json.loads(bytes(rows["bad.com"].value)) == {
        "domain": "bad.com",
        "category": "malware",
        "source": "s1",
        "source_format": "hosts",
        "raw_entry": "0.0.0.0 bad.com",
        "ingestion_timestamp": "2024-01-02T03:04:05.678901+00:00",
        "metadata": {"line_number": "7"},
    }
    ads = json.loads(bytes(rows["ads.com"].value))
    assert ads["ingestion_timestamp"] == "2024-01-02T03:04:05+00:00"
    assert ads["metadata"] == {}


def test_empty_key_is_null(spark):
    frame = entries(spark).withColumn("domain", F.lit(""))
    assert [r.key for r in messages.to_messages(frame).collect()] == [None] * 3


def test_publish_statistics(spark):
    rows = {r.source: r for r in stats.publish(entries(spark)).collect()}
    assert (rows["s2"].malware, rows["s2"].ads_trackers, rows["s2"].total, rows["s2"].failed) == (0, 1, 1, 1)
    assert (rows[None].level, rows[None].total, rows[None].failed) == ("overall", 2, 1)
    nothing = stats.publish(entries(spark).limit(0)).collect()
    assert [(r.level, r.total) for r in nothing] == [("overall", 0)]


def test_round_trip_through_a_folder(spark, tmp_path):
    path = str(tmp_path / "topics")
    publish(messages.to_messages(entries(spark)), path=path)
    sent = spark.read.schema(schemas.TRANSPORT).parquet(path)
    rows = bronze.transform(sent, "2024-02-01")
    assert rows.schema == schemas.BRONZE
    back = rows.select(*entries(spark).columns)
    routed = entries(spark).filter("category != 'news'").withColumn(
        "metadata", F.coalesce("metadata", F.create_map().cast("map<string,string>"))
    )
    plain = [c for c in back.columns if c != "metadata"] + ["m"]
    back = back.withColumn("m", F.to_json("metadata")).select(plain)
    routed = routed.withColumn("m", F.to_json("metadata")).select(plain)
    assert back.exceptAll(routed).count() == 0 and routed.exceptAll(back).count() == 0
    assert rows.filter("kafka_topic IS NULL OR kafka_offset IS NULL").count() == 0


def raw(spark, values):
    return spark.createDataFrame(
        [(None, v, "malware_domains", 3, i, datetime(2024, 1, 1), 0) for i, v in enumerate(values)],
        schemas.TRANSPORT,
    )


def test_unreadable_messages_stay_as_nulls(spark):
    given = [
        b'{"invalid": "missing_required_fields"}',
        b'{"domain":"test.com"}',
        b"",
        None,
        b'{"domain":"","category":"malware","source":"test"}',
        b'{"domain":"cut.com","categ',
        b'{"domain":"x.com","ingestion_timestamp":"not a time","metadata":{"n":1,"b":true,"o":{"k":2}}}',
    ]
    rows = bronze.transform(raw(spark, given)).orderBy("kafka_offset").collect()
    assert len(rows) == len(given)
    assert [r.domain for r in rows] == [None, "test.com", None, None, "", None, "x.com"]
    assert rows[-1].ingestion_timestamp is None and rows[-1].ingestion_date is None
    assert rows[-1].metadata == {"n": "1", "b": "true", "o": '{"k":2}'}
    assert {r.kafka_partition for r in rows} == {3}


def test_times_are_read_with_their_offset(spark):
    value = b'{"domain":"x.com","ingestion_timestamp":"2025-10-04T23:30:45.123-02:00"}'
    row = bronze.transform(raw(spark, [value])).first()
    assert row.ingestion_date == date(2025, 10, 5)
    text = bronze.transform(raw(spark, [value])).select(F.col("ingestion_timestamp").cast("string"))
    assert text.first()[0] == "2025-10-05 01:30:45.123"


def test_kafka_feed():
    options = topics.KafkaFeed("k:9092", ["a", "b"], "earliest", 500).options()
    assert options["subscribe"] == "a,b"
    assert options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "500"
    assert options["kafka.max.poll.records"] == "500"
    assert "maxOffsetsPerTrigger" not in topics.KafkaFeed("k:9092").options()
    assert topics.KafkaFeed("k").options()["startingOffsets"] == "latest"
    assert topics.kafka_write_options("k", "t", "/c") == {
        "kafka.bootstrap.servers": "k",
        "topic": "t",
        "checkpointLocation": "/c",
    }


def test_dates_and_times_are_utc_in_any_session(spark):
    from pyspark.sql import functions as F

    from sievelake.functions.times import iso_text, utc

    stamp = F.timestamp_seconds(F.lit(1704848400))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.range(1).select(iso_text(stamp).alias("t"), F.to_date(utc(stamp)).alias("d")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.t == "2024-01-10T01:00:00+00:00" and str(row.d) == "2024-01-10"

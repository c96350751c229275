"""Joins and cuts in which one key or one moment holds most rows."""

import pytest
from pyspark.sql import functions as F

from sievelake.llm import simhash
from sievelake.llm.common import FEW, HOT_SHARE, components, dealt, looked_up
from sievelake.llm.mixing import mix


@pytest.fixture
def small_broadcasts(spark):
    """Spark may still choose to broadcast by its guess, and fails where a table is larger than this."""
    spark.conf.set("spark.sql.maxBroadcastTableSize", "12m")
    yield
    spark.conf.unset("spark.sql.maxBroadcastTableSize")


def test_many_keys_are_dealt_without_the_driver(spark, small_broadcasts):
    """The rows are many times as many as those that Spark guesses their number from."""

    def twice(frames):
        for frame in frames:
            for turn in range(40):
                yield frame.assign(key=frame["id"] // 2 * 40 + turn)

    rows = spark.range(20_000).mapInPandas(twice, "id long, key long")
    found = dealt(rows, "key", "id", 4096)
    assert found.columns == ["key", "id", "own", "part_a", "part_b"]
    assert found.agg(F.count("*"), F.countDistinct("key")).first()[:] == (800_000, 400_000)


def test_many_facts_are_looked_up_without_the_driver(spark, small_broadcasts):
    n = 3 * FEW
    rows = spark.range(n).select("id", (F.col("id") * 7).alias("k"))
    facts = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    found = looked_up(rows, facts, "k", "n", n)
    assert found.agg(F.count("*"), F.count_if(F.col("least") == F.col("id"))).first()[:] == (n, n)


def joins_of_roots(spark, capsys):
    docs = spark.createDataFrame([(i, f"word {i // 2}") for i in range(40)], "doc_id long, text string")
    _, classes = simhash._grouped(docs, simhash.exact_search())
    classes.explain()
    said = capsys.readouterr().out
    return said.count("SortMergeJoin [node") + said.count("SortMergeJoin [root"), classes.count()


def test_roots_are_joined_without_the_driver_unless_few(spark, monkeypatch, capsys):
    few, n = joins_of_roots(spark, capsys)
    monkeypatch.setattr("sievelake.llm.common.FEW", 3, raising=False)
    many, same = joins_of_roots(spark, capsys)
    assert few == 0 and many >= 2 and n == same == 20


def test_a_hot_key_is_dealt_out(spark):
    rows = spark.range(40_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    facts = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.lit(None).cast("string").alias("none"))
    found = looked_up(rows, facts, "k", "n", 40_000)
    assert found.columns == ["id", "k", "least", "none"]
    wrong = found.filter(F.col("least") != F.when(F.col("k") == "hot", 0).otherwise(F.col("id")))
    assert found.count() == 40_000 and wrong.isEmpty() and found.filter("none IS NOT NULL").isEmpty()
    # By the shuffle alone the hot key fills one partition.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        largest = looked_up(rows, facts, "k", "n", 40_000).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert largest < 2 * 40_000 / parts


def test_no_rows_and_no_hot_keys(spark):
    facts = spark.createDataFrame([("a", 1, 5)], "k string, n long, v long")
    assert looked_up(facts.select("k").limit(0), facts, "k", "n", 0).count() == 0
    many = spark.range(3 * HOT_SHARE).select(F.col("id").alias("k"))
    found = looked_up(many, many.withColumn("n", F.lit(1)).withColumn("v", -F.col("k")), "k", "n", 3 * HOT_SHARE)
    assert found.filter("v = -k").count() == 3 * HOT_SHARE


def test_a_hub_of_many_links(spark):
    hub = spark.range(1, 3_001).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    chain = spark.range(10_000, 10_040).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    # The chain's end hangs on the hub's last node.
    bridge = spark.createDataFrame([(10_040, 3_000)], "a long, b long")
    found = components(hub.unionByName(chain).unionByName(bridge))
    assert found.count() == 3_042 and found.filter("root <> 0").isEmpty()


def test_the_edge_of_the_mix_in_every_piece(spark):
    """One tick of time holds all copies of a source as large as this, cut anywhere."""
    docs = [(i, f"s{i % 3}", "w " * (1 + i % 7)) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, source string, text string")
    for share in (0.0001, 0.01, 0.5, 1.5):
        rows = mix(frame, share=share).collect()
        budget = share * sum(r["size"] for r in rows)
        taken = sum(r["taken"] for r in rows)
        assert taken <= budget and budget - taken < 7

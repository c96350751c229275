import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sievelake.operators import stats, validate


def entries(spark, names, source="test"):
    return spark.createDataFrame(
        [(n, source, "list", i) for i, n in enumerate(names, start=1)],
        "domain string, source string, path string, line_number bigint",
    )


def domains_of(frame):
    return [r.domain for r in frame.orderBy("line_number").collect()]


def test_lenient_drops_invalid_and_repeated(spark):
    given = entries(spark, ["valid1.com", "valid2.com", "localhost", "valid1.com", "127.0.0.1"])
    kept = validate.lenient(given)
    assert domains_of(kept) == ["valid1.com", "valid2.com"]
    assert [r.line_number for r in kept.orderBy("line_number").collect()] == [1, 2]


def test_statistics(spark):
    given = entries(spark, ["valid1.com", "valid2.com", "localhost", "valid1.com"])
    as_is = stats.validation(given, clean=False).first().asDict()
    assert as_is == {"total": 4, "valid": 2, "invalid": 1, "duplicates": 1, "uncleanable": 0}
    cleaned = stats.validation(given).first().asDict()
    assert cleaned == {"total": 3, "valid": 2, "invalid": 0, "duplicates": 1, "uncleanable": 1}
    nothing = stats.validation(given.limit(0)).first().asDict()
    assert set(nothing.values()) == {0}


def test_clean_and_validate(spark):
    given = entries(spark, ["www.example.com", "http://test.com", "https://another.org/", "x y", "TEST.com"])
    assert domains_of(validate.clean_and_validate(given)) == ["example.com", "test.com", "another.org"]


def test_dedupe_is_per_source(spark):
    both = entries(spark, ["a.com", "a.com"]).unionByName(entries(spark, ["a.com"], "other"))
    assert sorted(r.source for r in validate.lenient(both).collect()) == ["other", "test"]


def test_strict_fails_the_job(spark):
    assert domains_of(validate.strict(entries(spark, ["a.com", "b.com"]))) == ["a.com", "b.com"]
    with pytest.raises(PySparkException, match="Invalid domain format: localhost from test"):
        validate.strict(entries(spark, ["a.com", "localhost"])).collect()


def test_many_repeats(spark):
    given = spark.range(10000).select(
        F.concat(F.lit("domain"), (F.col("id") % 5000).cast("string"), F.lit(".com")).alias("domain"),
        F.lit("test").alias("source"),
        F.lit("list").alias("path"),
        F.col("id").alias("line_number"),
    )
    assert validate.lenient(given).filter("line_number < 5000").count() == 5000
    counted = stats.validation(given, clean=False).first()
    assert (counted.total, counted.valid, counted.duplicates) == (10000, 5000, 5000)


def test_dedupe_ranks_before_the_shuffle(spark):
    plan = validate.dedupe(entries(spark, ["a.com"]))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_run_statistics(spark):
    given = entries(spark, ["a.com", "a.com", "b.com"]).withColumn("category", F.lit("malware"))
    given = given.unionByName(entries(spark, ["c.com"], "odd").withColumn("category", F.lit("news")))
    failed = spark.createDataFrame([("x", None, "r"), ("x", "p", "r")], "source string, path string, reason string")
    assert stats.run(given, failed).first().asDict() == {
        "sources_processed": 2,
        "sources_failed": 1,
        "domains_fetched": 4,
        "domains_validated": 3,
        "domains_published": 2,
    }


def test_run_statistics_hold_no_category_by_domain(spark):
    given = entries(spark, ["www.a.com", "a.com", "www.com"]).withColumn("category", F.lit("malware"))
    failed = spark.createDataFrame([], "source string, path string, reason string")
    assert stats.run(given, failed, named=True).first() == stats.run(given, failed).first()
    assert stats.validation(given, named=True).first() == stats.validation(given).first()
    plan = stats.run(given, failed, named=True)._jdf.queryExecution().optimizedPlan().toString()
    keys = re.findall(r"Aggregate \[(source[^]]*domain[^]]*)\]", plan)
    assert keys and not any("category" in k for k in keys)

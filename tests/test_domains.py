import random

import duckdb
import pytest
from pyspark.sql import functions as F

from sievelake.functions import domains, text
from sievelake.plans import oracle

CASES = [
    ("  Example.COM  ", "example.com"),
    ("https://www.example.com/path", "example.com"),
    ("example.com:8080", "example.com"),
    ("x.com:1:2", None),
    ("https://http://x.com", "x.com"),
    ("http://https://x.com", None),
    ("www.www.a.co", "a.co"),
    ("www.com", None),
    ("x.com ./p", "x.com"),
    ("x.com. /p", None),
    ("example.com..", "example.com"),
    ("example..com", None),
    ("//x.com?q", "x.com"),
    ("x.com#f", "x.com"),
    ("a.-b.com", "a.-b.com"),
    ("-a.com", None),
    ("a-.com", None),
    ("a" * 63 + ".com", "a" * 63 + ".com"),
    ("a" * 64 + ".com", None),
    ("a." + "b" * 100, "a." + "b" * 100),
    ("a.b", None),
    ("test.com", "test.com"),
    ("a.test", None),
    ("a.local", None),
    ("a.localdomain", None),
    ("a.example", None),
    ("a.i2p", None),
    ("a.tests", "a.tests"),
    ("192.168.1.1", None),
    ("::1", None),
    ("localhost", None),
    ("xn--e1afmkfd.xn--p1ai", None),
    ("user@example.com", None),
    ("*.example.com", None),
    ("a_b.com", None),
    ("", None),
    (" ", None),
    (None, None),
    ("http:// www.x.com", "www.x.com"),
    (" x.com　", "x.com"),
    ("x.com\n", "x.com"),
    ("a.b\nc.com", None),
    ("ab." * 83 + "abcd", "ab." * 83 + "abcd"),
    ("ab." * 83 + "abcde", None),
    ("ab." * 83 + "abcd....", "ab." * 83 + "abcd"),
]


def test_cleaning_cases(spark):
    frame = spark.createDataFrame(CASES, "name string, expected string")
    rows = frame.withColumn("got", domains.clean(F.col("name"))).collect()
    assert [(r.name, r.got) for r in rows] == [(r.name, r.expected) for r in rows]


def test_sql_functions_agree_with_columns(spark):
    domains.register_sql(spark)
    frame = spark.createDataFrame([(name,) for name, _ in CASES], "name string").select(
        domains.clean(F.col("name")).alias("c1"),
        F.expr("clean_domain(name)").alias("c2"),
        domains.is_valid(F.col("name")).alias("v1"),
        F.expr("is_valid_domain(name)").alias("v2"),
    )
    assert all(r.c1 == r.c2 and r.v1 == r.v2 and r.v1 is not None for r in frame.collect())


@pytest.mark.parametrize(
    ("name", "valid"),
    [
        ("example.com", True),
        ("deep.sub.example.com", True),
        ("a.b.c.d.e.f.example.com", True),
        ("123.numeric.com", True),
        ("a.co", True),
        (" Example.Com\t", True),
        ("example.com.", False),
        ("exam ple.com", False),
        ("example", False),
        (".", False),
        ("example.com/path", False),
        ("http://example.com", False),
        ("example.com:8080", False),
        ("a" * 300 + ".com", False),
        (None, False),
    ],
)
def test_validity(spark, name, valid):
    frame = spark.createDataFrame([(name,)], "name string")
    assert frame.select(domains.is_valid(F.col("name"))).first()[0] is valid


def test_one_expression_equals_the_rules_step_by_step(spark):
    """Random spellings against the stepwise SQL of the same rules."""
    dice = random.Random(7)
    pieces = [
        "http://", "https://", "ftp://", "//", "www.", " ", "\t", "\n", ".", "..", "-", ":", ":80",
        "/", "?", "#", "/p?q#f", "a", "b1", "x-y", "com", "net", "test", "local", "onion", "i2p",
        "example", "A", "COM", "1", "_", "@", " ", " ", "é", "localhost", "ww", "0",
    ]
    names = ["".join(dice.choices(pieces, k=dice.randint(1, 9))) for _ in range(20000)]
    names += [a + ".com" + b for a in ("x", "a-b", "www.y") for b in names[:2000]]
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    ours = {r.i: (r.c, r.v) for r in frame.select(
        "i", domains.clean(F.col("name")).alias("c"), domains.is_valid(F.col("name")).alias("v")
    ).collect()}
    db = duckdb.connect()
    import pandas as pd

    db.register("given", pd.DataFrame({"i": range(len(names)), "domain": names}))
    sql = f"SELECT i, cleaned, valid FROM ({oracle.cleaned(f'({oracle.judged("given")})')})"
    theirs = {i: (c, v) for i, c, v in db.execute(sql).fetchall()}
    differ = [(names[i], ours[i], theirs[i]) for i in ours if ours[i] != theirs[i]]
    assert differ == []
    assert sum(c is not None for c, _ in ours.values()) > 500


def test_lines_and_strip_follow_unicode(spark):
    texts = [
        "a\n", "a\r\nb", "a\x0bb\x0cc\x1cd\x85e f ", "\n", "", "a\n\nb", "a\r\r\n\n",
        "no break", "a\r", "\r\n\r\n",
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in frame.select("t", text.split_lines(F.col("t")).alias("lines")).collect():
        assert row.lines == row.t.splitlines()
    padded = ["　 x \x1f", "\t\x85y\xa0\n", "z"]
    frame = spark.createDataFrame([(t,) for t in padded], "t string")
    assert [r[0] for r in frame.select(text.strip(F.col("t"))).collect()] == ["x", "y", "z"]


def test_names_of_parsers_are_cleaned_alike(spark):
    """A valid name loses no more than "www.", so that most need no second search."""
    names = {c for _, c in CASES if c} | {c for c, _ in CASES if c}
    names |= {f"{front}{n}" for n in list(names) for front in ("www.", "www.www.", "wwww.", "a.www.")}
    frame = spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    valid = frame.select(F.lower("name").alias("name")).filter(F.col("name").rlike(rf"\A{domains.NAME}\z"))
    rows = valid.select(
        domains.clean(F.col("name")).alias("full"),
        domains.clean(F.col("name"), named=True).alias("short"),
        domains.cleaned(F.col("name")).alias("all_full"),
        domains.cleaned(F.col("name"), named=True).alias("all_short"),
    ).collect()
    assert len(rows) > 50 and any(r.full is None for r in rows)
    assert all(r.full == r.short and r.all_full == r.all_short for r in rows)


def test_classes_of_names_are_spelled_out():
    """Ranges cost a call each for every character of every name."""
    assert not any(r in domains.NAME for r in ("a-z", "0-9"))

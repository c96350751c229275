import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sievelake.functions.text import split_lines
from sievelake.operators import lists
from sievelake.sources import files
from sievelake.sources.registry import registry

HOSTS = """127.0.0.1 localhost
0.0.0.0 kiln.pottery.org
# a remark between two names

\t127.0.0.1   glaze.net\t
0.0.0.0
0.0.0.0 -wheel.pottery.org
clay.pottery.org
0.0.0.0 Raku.Example.org
# 0.0.0.0 remark.org"""

ADBLOCK = """! expires: 2 days
||oven.bakery.fr^
[a header may stand anywhere]
||yeast.bakery.fr/crumb^
||Rye.Bakery.fr^$script,domain=flour.fr

##.crust
flour.fr##div
|https://salt.fr^
   ||sourdough.de^\t
! ||stale.de^"""

SOURCES = {
    "h": {"format": "hosts", "category": "malware"},
    "a": {"format": "adblock", "category": "ads_trackers"},
    "odd": {"format": "csv", "category": "malware"},
    "gone": {"format": "hosts", "category": "malware"},
}


def parse(spark, source, content, fetched=None, formats=lists.FORMATS):
    frame = spark.createDataFrame(
        [(source, "doc", content, fetched)],
        "source string, path string, content string, fetch_metadata map<string,string>",
    )
    entries = lists.parse(lists.lines(frame), registry(spark, SOURCES), "2024-02-01", formats)
    return entries.orderBy("line_number").collect()


def test_hosts_document(spark):
    rows = parse(spark, "h", HOSTS)
    assert [(r.line_number, r.domain) for r in rows] == [(2, "kiln.pottery.org"), (5, "glaze.net"), (9, "raku.example.org")]
    second = rows[1]
    assert (second.category, second.source, second.source_format) == ("malware", "h", "hosts")
    assert second.raw_entry == "127.0.0.1   glaze.net"
    assert second.metadata == {"line_number": "5"}


def test_adblock_document(spark):
    rows = parse(spark, "a", ADBLOCK)
    assert [(r.line_number, r.domain) for r in rows] == [(2, "oven.bakery.fr"), (5, "rye.bakery.fr"), (10, "sourdough.de")]
    assert rows[-1].raw_entry == "||sourdough.de^"
    assert {r.category for r in rows} == {"ads_trackers"}


@pytest.mark.parametrize(
    ("line", "domain"),
    [
        ("0.0.0.0 x.com # note", None),
        ("192.168.1.1 x.com", None),
        ("just-domain.com", None),
        ("127.0.0.1\t MixedCase.Example.Com", "mixedcase.example.com"),
        ("0.0.0.0 x.com", "x.com"),
        ("0.0.0.0 K.com", None),
        ("0.0.0.0 x.com y.com", None),
        ("0.0.0.0 " + "a" * 300 + ".com", None),
        ("0.0.0.0 domain-with-émojis.com", None),
    ],
)
def test_hosts_lines(spark, line, domain):
    assert [r.domain for r in parse(spark, "h", line)] == ([domain] if domain else [])


def test_fetch_metadata_wins_over_line_number(spark):
    rows = parse(spark, "h", "0.0.0.0 x.com", {"http_status": "200"})
    assert rows[0].metadata == {"line_number": "1", "http_status": "200"}
    rows = parse(spark, "h", "0.0.0.0 x.com", {"line_number": "given"})
    assert rows[0].metadata == {"line_number": "given"}


def test_large_list(spark):
    rows = parse(spark, "h", "\n".join(f"0.0.0.0 domain{i}.com" for i in range(10000)))
    assert len(rows) == 10000 and rows[-1].line_number == 10000


def test_further_format(spark):
    def plain(line):
        return F.when(line.rlike(r"^[a-z]+\.com$"), F.array(line)).otherwise(F.array())

    rows = parse(spark, "odd", "x.com\nnope", formats={**lists.FORMATS, "csv": plain})
    assert [r.domain for r in rows] == ["x.com"]


def test_failures_do_not_stop_other_sources(spark):
    documents = spark.createDataFrame(
        [("h", "1", "0.0.0.0 x.com"), ("a", "2", ""), ("odd", "3", "x,y")],
        "source string, path string, content string",
    ).withColumns(
        {
            "content_length": F.length("content"),
            "fetch_metadata": F.lit(None).cast("map<string,string>"),
        }
    )
    failed = lists.failures(documents, registry(spark, SOURCES)).collect()
    assert {(r.source, r.path, r.reason) for r in failed} == {
        ("a", "2", "Empty content received from source"),
        ("odd", "3", "Unknown format type: csv"),
        ("gone", None, "No document fetched"),
    }
    entries = lists.parse(lists.lines(documents), registry(spark, SOURCES))
    assert [r.domain for r in entries.collect()] == ["x.com"]


@pytest.fixture
def landing(tmp_path):
    contents = {
        "h/one.txt": "".join(f"# line {i}\r\n" if i % 7 else "\n" for i in range(400)),
        "h/two.txt": "a\x0cb\n\n c\x85d\re\r\n" * 60 + "last é",
        "a/three.txt": "x\n" * 5,
        "a/empty.txt": "",
    }
    for name, content in contents.items():
        file = tmp_path / f"source={name}"
        file.parent.mkdir(exist_ok=True)
        file.write_bytes(content.encode())
    return str(tmp_path), contents


def shuffled_lines(spark, path):
    """The same lines by the plan that Spark takes when the splits are too many to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = files.scan_lists(spark, path).lines
        assert "BroadcastHashJoin" not in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return frame


def test_line_numbers_of_split_files(spark, landing):
    """Files cut into many splits still number their lines as a whole."""
    path, contents = landing
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        frame = files.scan_lists(spark, path).lines
        by_shuffle = shuffled_lines(spark, path)
        blocks = files._pieces(spark, path).select("path", "block").distinct().count()
        rows = frame.collect()
        assert sorted(by_shuffle.select("path", "line_number", "line").collect()) == sorted(
            (r.path, r.line_number, r.line) for r in rows
        )
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert blocks > 20
    # The same frame under another cut of the files must not number them wrongly.
    with pytest.raises(PySparkException, match="cut differently"):
        frame.select("*").collect()
    got = {}
    for row in rows:
        name = row.source + "/" + row.path.rsplit("/", 1)[-1]
        got.setdefault(name, {})[row.line_number] = row.line
    for name, content in contents.items():
        expected = dict(enumerate(content.splitlines(), start=1))
        assert got.get(name, {}) == expected


def test_documents_know_their_length(spark, landing):
    path, contents = landing
    manifest = spark.createDataFrame(
        [("h", "200", "text/plain", "https://h.example.net/list")],
        "source string, http_status string, content_type string, source_url string",
    )
    rows = files.scan_lists(spark, path, manifest).documents.collect()
    lengths = {r.source + "/" + r.path.rsplit("/", 1)[-1]: r.content_length for r in rows}
    assert lengths == {name: len(content) for name, content in contents.items()}
    metadata = {r.source: r.fetch_metadata for r in rows if "one" in r.path or "three" in r.path}
    assert metadata["h"] == {
        "http_status": "200",
        "content_length": str(len(contents["h/one.txt"])),
        "content_type": "text/plain",
        "source_url": "https://h.example.net/list",
    }
    assert {r.path.rsplit("/", 1)[-1]: r.fetch_metadata for r in rows}["empty.txt"] == {
        "content_length": "0"
    }
    assert metadata["a"] == {"content_length": str(len(contents["a/three.txt"]))}


def test_document_stream(spark, landing, tmp_path):
    path, contents = landing
    rows = lists.lines(files.document_stream(spark, path))
    query = rows.writeStream.format("memory").queryName("doc_lines").trigger(availableNow=True)
    query.start().awaitTermination()
    for name, content in contents.items():
        file = name.split("/")[1]
        got = spark.table("doc_lines").filter(F.col("path").endswith(file)).collect()
        assert {r.line_number: r.line for r in got} == dict(
            enumerate(content.splitlines(), start=1)
        )


@pytest.mark.parametrize("option", [("maxPartitionBytes", "97"), ("minPartitionNum", "40")])
def test_smaller_splits_than_counted_lose_no_line(spark, landing, option):
    path, _ = landing
    frame = files.scan_lists(spark, path).lines
    counted = frame.count()
    spark.conf.set(f"spark.sql.files.{option[0]}", option[1])
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        cut = frame.select("*")
        try:
            assert cut.count() == counted and len(cut.collect()) == counted
        except PySparkException as e:
            assert "cut differently" in str(e)
    finally:
        spark.conf.unset(f"spark.sql.files.{option[0]}")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_repeated_manifest_rows_double_no_line(spark, landing):
    path, contents = landing
    plain = files.scan_lists(spark, path).lines.count()
    schema = "source string, http_status string, content_type string, source_url string"
    manifest = spark.createDataFrame([("h", "200", "t", "u"), ("h", "404", "t", "u")], schema)
    assert files.scan_lists(spark, path, manifest).lines.count() == plain
    name = next(r.path for r in files.scan_lists(spark, path).documents.collect() if "two" in r.path)
    by_path = spark.createDataFrame([(name, "201")], "path string, http_status string")
    found = files.scan_lists(spark, path, by_path).documents.collect()
    assert {r.path: r.fetch_metadata.get("http_status") for r in found if r.source == "h"}[name] == "201"
    assert sum("http_status" in r.fetch_metadata for r in found) == 1


def test_documents_of_an_unregistered_source_fail(spark):
    registry = spark.createDataFrame([("a", "hosts", "malware")], "source string, format string, category string")
    documents = spark.createDataFrame([("a", "p", 3), ("stray", "q", 3)], "source string, path string, content_length long")
    found = {(r.source, r.path, r.reason) for r in lists.failures(documents, registry).collect()}
    assert found == {("stray", "q", "Unknown source")}


def test_texts_with_line_feeds_alone_are_cut_alike(spark):
    """Plain searches for most texts, the expression for those with other line breaks."""
    texts = ["", "\n", "\n\n", "a", "a\n", "a\n\n", "\na", "a\nb", "é\nü\n", None]
    texts += [t.replace("\n", b) for t in texts if t for b in ("\r\n", "\r", "\x0b", "\x1e", "\x85", "\u2028", "\n\r", "\u2029\n")]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = frame.select("text", split_lines(F.col("text")).alias("lines")).collect()
    assert len(rows) == len(texts)
    assert all(r.lines == (None if r.text is None else r.text.splitlines()) for r in rows)
    plan = frame.select(split_lines(F.col("text")).alias("lines"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2

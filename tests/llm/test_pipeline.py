"""Every stage of the corpus pipeline on what the one before kept, and the whole run."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sievelake.llm import quality, queries, toxicity
from sievelake.llm.common import stored
from tests.llm.test_native import plain_contamination
from tests.llm.test_simhash import jaccard_groups

SF = "/root/testdata/sf0.001"
CLASHING = ["_bad_id", "_bad_hash", "_fp", "_root", "_id", "_hash", "_toxicity", "_quality", "text_hash", "root", "score", "found"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The given tables, with clashing columns and odd rows in the documents."""
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    some = docs.limit(1).select("text").first().text
    odd = [(9001, None, "en", None, 0), (9002, "", None, "src1", 0), (None, some + " and more", "en", "src1", 1), (9003, some, "en", "src2", 1), (9003, some, "en", "src2", 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    docs.select("*", *[F.lit("x").alias(c) for c in CLASHING]).write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="module")
def steps(spark, tables):
    """Input and output of each stage."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        kept = stored(stage(spark, docs, tables))
        out.append((name, docs, kept))
        docs = kept
    return out


def rows(frame):
    return sorted(map(str, frame.select("doc_id", "text", "lang", "source").collect()))


def test_columns_are_kept(steps):
    for _, docs, kept in steps[:-1]:
        assert kept.columns == docs.columns
    assert [c for c in steps[-1][2].columns if c in steps[-1][1].columns] == steps[-1][1].columns


@pytest.mark.parametrize("at,operator,label,keep", [(0, toxicity.toxicity, "toxic", lambda s: s < 0.5), (1, quality.quality, "quality", lambda s: s >= 0.3)])
def test_classifiers_decide_by_their_scores(spark, steps, at, operator, label, keep):
    _, docs, kept = steps[at]
    scored = operator(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert sorted(str(r.doc_id) for r in scored if keep(r.score)) == sorted(str(r.doc_id) for r in kept.collect())
    assert 0 < kept.count() < docs.count()


def test_one_document_of_each_group_stays(steps):
    _, docs, kept = steps[2]
    # Rows of equal id and text count once; the least id stays, a null id last.
    every = sorted({(r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs.collect()})
    texts = [t for *_, t in every]
    first = set(jaccard_groups(texts)[0])
    assert sorted(str((every[i][1], texts[i])) for i in first) == sorted(str((r.doc_id or 0, r.text or "")) for r in kept.collect())


def test_documents_with_benchmark_windows_go(spark, steps):
    _, docs, kept = steps[3]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    every = [(r.doc_id, r.text) for r in docs.collect()]
    found = plain_contamination(every, items)
    assert sorted(str(d) for d, f in zip(every, found, strict=True) if not f[2]) == sorted(str((r.doc_id, r.text)) for r in kept.collect())


def test_the_mix_equals_its_sql(steps):
    _, docs, kept = steps[4]
    documents = docs.select("doc_id", "text", "source").toPandas()
    db = duckdb.connect()
    db.register("documents", documents)
    sql = db.execute(f"SELECT doc_id, size, taken FROM ({queries.ORACLE['op8_source_mix']}) WHERE taken > 0").fetchall()
    assert sorted(map(str, sql)) == sorted(str((r.doc_id, r.size, r.taken)) for r in kept.collect())


def test_run_gives_the_last_stage(spark, tables, steps):
    assert rows(corpus_pipeline.run(spark, tables)) == rows(steps[-1][2]) != []

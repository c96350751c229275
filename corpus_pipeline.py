"""From documents to a training mix, in five stages over the whole corpus.

Every stage gets all rows that the one before it kept, and its result is written to the
shared folder and read again. The stages import from ``sievelake.llm``, which they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.llm import decontamination, mixing, quality, simhash, toxicity
from sievelake.llm.common import fresh, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    score = fresh("toxicity")
    scored = toxicity.with_score(docs, model, score)
    return scored.filter(F.col(score) < toxicity.THRESHOLD).drop(score)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    score = fresh("quality")
    scored = quality.with_score(docs, model, score)
    return scored.filter(F.col(score) >= quality.THRESHOLD).drop(score)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity of 0.8 or more."""
    return simhash.one_of_each_group(docs, simhash.SIMILAR)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontamination.clean(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their words taken."""
    return mixing.taken_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near duplicates", one_of_each_group),
    ("decontamination", drop_benchmark),
    ("mix", mix_sources),
]

# Trained models and XXH64 fingerprints have no SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

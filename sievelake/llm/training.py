"""What the two classifiers share: a bounded sample of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelake.llm.common import held_out, stored


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int) -> DataFrame:
    """``(doc_id, text, label)``: at most ``per_label`` labelled ids of each label, 0 and 1.

    Held-out ids, null ids and other labels are left out; of several labels of an id the
    largest counts. The ids with the least hashes are taken, so a rerun takes the same.
    Documents of the same text count once, with the least id and the largest label.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
    )
    order = F.xxhash64("doc_id")
    parts = [known.filter(F.col("label") == v).orderBy(order, "doc_id").limit(per_label) for v in (0, 1)]
    # Two times per_label rows of two numbers: small enough to broadcast.
    chosen = stored(parts[0].unionByName(parts[1]))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return stored(
        texts.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("h"))
        .agg(F.min("doc_id").alias("doc_id"), F.any_value("text").alias("text"), F.max("label").alias("label"))
        .drop("h")
    )

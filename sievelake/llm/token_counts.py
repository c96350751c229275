"""Token counts: pieces are counted once per distinct pre-token.

The tokenizer cuts a text into pre-tokens and never merges over their borders. So the count
of a document is the sum, over its distinct pre-tokens, of frequency times the pre-token's
pieces; ids of documents are never made.

The join of pieces and frequencies is made within a task. As a join in Spark, with frequent
pre-tokens broadcast and the rest shuffled, it needed over twice the input in disk.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelake.llm.common import on_workers

LIMIT = 512
# Counts of so many distinct pre-tokens are kept from batch to batch within a task.
KEPT = 400_000

# In these characters the pattern's classes are the same in every Unicode version at hand;
# texts with others are cut by the tokenizer's own code.
SETTLED = regex.compile(r"[\u0000-՗ -⁯]*")


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pre_tokens(tokenizer, pattern: regex.Pattern, text: str) -> list[str]:
    if SETTLED.fullmatch(text):
        return pattern.findall(text)
    return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for each row of ``docs (doc_id, text)``.

    ``path`` is a tokenizers file of the byte-level kind and ``pattern`` its pre-token
    pattern; the file must be at that path on every machine. Special strings in a text are
    tokens of their own, as is the library's default; nothing is added, cut or padded. A
    null text counts as empty: no bytes, no tokens. Repeated rows are counted each; other
    columns are ignored. Rows are counted where they are read: nothing is shuffled.
    """

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = _tokenizer(path)
        cut = regex.compile(pattern)
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        parts = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))) or "(?!)")
        pieces: dict[str, int] = {}
        for batch in batches:
            frequencies, specials = [], []
            for text in batch:
                text = text or ""
                spans = parts.split(text)
                specials.append(len(spans) - 1)
                seen: Counter = Counter()
                for span in spans:
                    seen.update(pre_tokens(tokenizer, cut, span))
                frequencies.append(seen)
            if len(pieces) > KEPT:
                pieces.clear()
            new = list(set().union(*frequencies) - pieces.keys())
            for at in range(0, len(new), 10_000):
                some = new[at : at + 10_000]
                for piece, found in zip(some, tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                    pieces[piece] = len(found.ids)
            yield pd.Series(
                [n + sum(map(int.__mul__, seen.values(), map(pieces.__getitem__, seen))) for seen, n in zip(frequencies, specials, strict=True)],
                dtype="int64",
            )

    on_workers(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    counted = docs.select(
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.pandas_udf(count, "long")(F.col("text")).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

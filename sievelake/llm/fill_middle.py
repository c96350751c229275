"""Fill-in-the-middle training texts, cut with an indexable skip list.

The tokens of a text are the nodes of a skip list. Every lane links some of them and carries
two widths for each link: how many tokens (units) and how many code points it skips. The
descent to a rank adds up unit widths until the next link would go beyond it, lane by lane,
and the code points added on the way are where the text is cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.common import on_workers

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Rates:
    """Shares in percent: of texts that are rearranged at all, and of those of suffix first."""

    seed: int = 42
    rearranged: int = 50
    suffix_first: int = 80


def token_ends(text: str) -> np.ndarray:
    """Code points up to the end of each token.

    A token is a run of white space (space, tab to carriage return) with the run of other
    characters after it; white space at the end of the text is a token of its own.
    """
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if not len(points):
        return np.zeros(0, np.int64)
    space = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    last = np.append(space[1:], True) & ~space
    if space[-1]:
        last[-1] = True
    return np.flatnonzero(last) + 1


def heights(n: int) -> np.ndarray:
    """How many express lanes each of ``n`` nodes is in: a fixed draw, one in four goes on."""
    mixed = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0xD1B54A32D192ED03)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    low = mixed >> np.uint64(32)
    # Pairs of zero bits at the end; a draw of zero is as high as can be.
    ones = low & (~low + np.uint64(1))
    return np.where(low > 0, np.log2(np.maximum(ones, 1).astype(np.float64)), 32).astype(np.int64) // 2


@dataclass(frozen=True)
class Lane:
    """Links between some nodes of a skip list, each with its two widths."""

    units: np.ndarray
    points: np.ndarray
    down: np.ndarray  # the place of each node in the lane below


class SkipList:
    """The tokens of a text; lane 0 links all of them, each higher lane about a quarter.

    Node 0 is the head before the first token, node ``i`` stands behind token ``i``.
    """

    def __init__(self, ends: np.ndarray):
        points = np.concatenate([[0], ends]).astype(np.int64)
        height = np.concatenate([[64], heights(len(ends))])
        nodes = below = np.arange(len(points))
        self.lanes: list[Lane] = []
        while True:
            self.lanes.append(Lane(np.diff(nodes), np.diff(points[nodes]), np.searchsorted(below, nodes)))
            higher = nodes[height[nodes] > len(self.lanes) - 1]
            if len(higher) < 2:
                break
            below, nodes = nodes, higher

    def cut(self, rank: int) -> int:
        """Code points before the token after ``rank`` tokens."""
        at = units = points = 0
        for lane in reversed(self.lanes):
            while at < len(lane.units) and units + lane.units[at] <= rank:
                units += int(lane.units[at])
                points += int(lane.points[at])
                at += 1
            at = int(lane.down[at])
        return points


def restore(output: str, form: str) -> str:
    """The text that ``output`` was made of; the marks occur in no text that is rearranged."""
    if form == PLAIN:
        return output
    first, second = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    between = output.index(second)
    end = output.index(MIDDLE, between)
    start, later, middle = output[len(first) : between], output[between + len(second) : end], output[end + len(MIDDLE) :]
    return start + middle + later if form == PSM else later + middle + start


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers out of the SHA-256 of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def rearranged(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` for each row of ``docs (doc_id, text)``.

    A text of ``n`` tokens is cut before the ranks ``h1 % (n + 1)`` and ``h2 % (n + 1)``; the
    draws ``h1`` to ``h4`` depend on seed and id only, so repeated ids are cut at the same draws and a
    null id draws as an empty one. It stays plain, with null widths, if it is empty (null
    counts as empty), holds one of the marks or is not drawn. Ranks may be equal, and parts
    empty. Rows are cut where they are read, each text by itself; other columns are ignored.
    """

    def apart(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, *numbers in batches:
            out = []
            for text, h1, h2, h3, h4 in zip(texts, *numbers, strict=True):
                ends = token_ends(text)
                n = len(ends)
                if not n or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rates.rearranged:
                    out.append((n, PLAIN, None, None, text))
                    continue
                lanes = SkipList(ends)
                a, b = sorted((lanes.cut(h1 % (n + 1)), lanes.cut(h2 % (n + 1))))
                if h4 % 100 < rates.suffix_first:
                    form, output = SPM, f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"
                else:
                    form, output = PSM, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"
                out.append((n, form, a, b - a, output))
            frame = pd.DataFrame(out, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield frame.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    on_workers(docs.sparkSession)
    cut = F.pandas_udf(apart, "n long, form string, prefix_chars long, middle_chars long, output string")
    made = cut(F.coalesce("text", F.lit("")), *draws(F.col("doc_id"), rates.seed))
    return docs.select("doc_id", made.alias("made")).select("doc_id", "made.*")


def digests(made: DataFrame) -> DataFrame:
    """``rearranged`` rows with SHA-256 digests in place of the output, and of what it restores to."""

    def back(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for outputs, forms in batches:
            yield pd.Series(
                [hashlib.sha256(restore(o, f).encode()).hexdigest() for o, f in zip(outputs, forms, strict=True)],
                dtype="string",
            )

    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.pandas_udf(back, "string")("output", "form").alias("restored_sha256"),
    )

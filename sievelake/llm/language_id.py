"""Language identification by prediction by partial matching (PPM).

Every language has a tree of byte contexts of up to three bytes. A byte is coded in the
longest context that the tree knows; where it was never seen there, an escape is coded and
the next shorter context tried, without the bytes that the longer one would have coded. The
counts are frozen after training, so the length of a text's code is exact and the same in
whatever order texts are read. The language with the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.common import on_workers, stored

ORDER = 3
# Windows of ORDER + 1 bytes that a model holds, shared out evenly among its languages; the
# most frequent are kept. At 12 bytes and three suffixes each, some 50 MB.
WINDOWS = 1 << 20
# Costs kept at hand while texts are scored, shared out among the languages, too.
SLOTS = 1 << 22
# Windows whose costs are looked up together, shared out likewise.
AT_ONCE = 1 << 20
# Code lengths are added in whole parts of a bit.
PARTS = 1 << 28
UNKNOWN = "und"

LETTER = regex.compile(r"\p{L}")
# Control characters and digits of ASCII are coded as spaces.
CODED = np.arange(256, dtype=np.uint8)
CODED[: ord(" ")] = CODED[ord("0") : ord("9") + 1] = ord(" ")


def coded_bytes(text: str) -> np.ndarray:
    """What is coded of a text: lower case in UTF-8, with runs of white space, control
    characters and digits (those of ASCII) as one space."""
    data = CODED[np.frombuffer(text.lower().encode(), np.uint8)]
    space = data == ord(" ")
    space[1:] &= space[:-1]
    space[:1] = False
    return data[~space]


def windows(data: np.ndarray) -> np.ndarray:
    """Each byte behind the three before it as one number; spaces stand before the text."""
    padded = np.concatenate([np.full(ORDER, 32, np.uint8), data]).astype(np.uint32)
    out = np.zeros(len(data), np.uint32)
    for i in range(ORDER + 1):
        out = (out << np.uint32(8)) | padded[i : i + len(data)]
    return out


@dataclass(frozen=True)
class Order:
    """All contexts of one length: their symbols with counts, totals, and after an escape
    into the shorter context what is left of that."""

    entries: np.ndarray  # context and symbol, sorted
    counts: np.ndarray
    contexts: np.ndarray  # sorted
    total: np.ndarray
    distinct: np.ndarray
    left_total: np.ndarray
    left_distinct: np.ndarray


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Tree:
    """The byte contexts of one language, of all lengths from ORDER down to 0."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.orders: list[Order] = []
        shorter = None
        for k in range(ORDER + 1):
            entries, where = np.unique(grams & np.uint32((1 << 8 * (k + 1)) - 1), return_inverse=True)
            n = np.bincount(where, counts, len(entries))
            contexts, of = np.unique(entries >> np.uint32(8), return_inverse=True)
            total, distinct = np.bincount(of, n, len(contexts)), np.bincount(of, minlength=len(contexts)).astype(float)
            left_total, left_distinct = np.zeros(len(contexts)), np.zeros(len(contexts))
            if shorter is not None:
                # Whatever follows a context follows its suffix, so these are always found.
                own, _ = _find(shorter.contexts, contexts & np.uint32((1 << 8 * (k - 1)) - 1))
                same, _ = _find(shorter.entries, entries & np.uint32((1 << 8 * k) - 1))
                left_total = shorter.total[own] - np.bincount(of, shorter.counts[same], len(contexts))
                left_distinct = shorter.distinct[own] - distinct
            shorter = Order(entries, n, contexts, total, distinct, left_total, left_distinct)
            self.orders.append(shorter)

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each window behind the bytes before it."""
        out = np.zeros(len(grams))
        open_ = np.ones(len(grams), bool)
        # Totals after the escape from the longer context; below zero where there was none.
        total, distinct = np.full(len(grams), -1.0), np.zeros(len(grams))
        for k in range(ORDER, -1, -1):
            order = self.orders[k]
            context, known = _find(order.contexts, (grams >> np.uint32(8)) & np.uint32((1 << 8 * k) - 1))
            if not len(order.contexts):
                continue
            entry, seen = _find(order.entries, grams & np.uint32((1 << 8 * (k + 1)) - 1))
            known &= open_
            seen &= known
            first = total < 0
            t, d = np.where(first, order.total[context], total), np.where(first, order.distinct[context], distinct)
            out[seen] -= np.log2(order.counts[entry[seen]] / (t + d)[seen])
            # Where a longer context has coded all that the shorter knows, the escape is free.
            escaped = known & ~seen & (t + d > 0)
            out[escaped] -= np.log2(d[escaped] / (t + d)[escaped])
            open_ &= ~seen
            total = np.where(known, order.left_total[context], total)
            distinct = np.where(known, order.left_distinct[context], distinct)
        used = len(self.orders[0].entries)
        out[open_] += np.log2(max(256 - used, 1))
        return out


@dataclass(frozen=True)
class Model:
    """Frozen statistics: for each language its windows with their counts."""

    languages: tuple[str, ...]
    grams: tuple[np.ndarray, ...]
    counts: tuple[np.ndarray, ...]

    @cached_property
    def trees(self) -> list[Tree]:
        return [Tree(g, c) for g, c in zip(self.grams, self.counts, strict=True)]

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """A row for each window, a column for each language."""
        return np.stack([tree.bits(grams) for tree in self.trees], axis=1)


class Coder:
    """Code lengths of texts, with the costs of windows seen before at hand."""

    def __init__(self, model: Model):
        self.model = model
        count = len(model.languages)
        self.bits = max(8, (SLOTS // count).bit_length() - 1)
        self.keys = np.zeros(1 << self.bits, np.uint32)
        self.filled = np.zeros(1 << self.bits, bool)
        self.costs = np.zeros((1 << self.bits, count), np.int64)
        self.at_once = max(1 << 12, AT_ONCE // count)

    def lengths(self, texts: Iterable[str]) -> np.ndarray:
        """Bits of each whole text's code, a column for each language; whole parts of a bit
        are added, so that the order of adding does not matter."""
        texts = list(texts)
        out = np.zeros((len(texts), len(self.model.languages)), np.int64)
        pending, owners, held = [], [], 0
        for i, text in enumerate(texts):
            data = coded_bytes(text)
            for start in range(0, len(data), self.at_once):
                # Cut for memory only: a piece begins with the bytes before it.
                before = min(start, ORDER)
                pending.append(windows(data[start - before : start + self.at_once])[before:])
                owners.append(i)
                held += len(pending[-1])
                if held >= self.at_once:
                    np.add.at(out, owners, self._sums(pending))
                    pending, owners, held = [], [], 0
        if pending:
            np.add.at(out, owners, self._sums(pending))
        return out / PARTS

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return (grams * np.uint32(2654435761)) >> np.uint32(32 - self.bits)

    def _sums(self, pieces: list[np.ndarray]) -> np.ndarray:
        """The costs of all windows of each piece, none of them empty."""
        grams = np.concatenate(pieces)
        slot = self._slot(grams)
        costs = self.costs[slot]
        missed = np.flatnonzero(~self.filled[slot] | (self.keys[slot] != grams))
        if len(missed):
            new, which = np.unique(grams[missed], return_inverse=True)
            found = np.rint(self.model.bits(new) * PARTS).astype(np.int64)
            costs[missed] = found[which]
            # Of windows for one slot the first stays.
            place, first = np.unique(self._slot(new), return_index=True)
            self.keys[place], self.costs[place], self.filled[place] = new[first], found[first], True
        return np.add.reduceat(costs, np.cumsum([0, *map(len, pieces[:-1])]), axis=0)


def held_out(doc_id: Column) -> Column:
    """True for rows that no statistics are taken from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Windows of each batch with their counts, by language."""
    for frame in frames:
        for lang, texts in frame.groupby("lang")["text"]:
            pending: list[np.ndarray] = []
            held = 0
            for i, text in enumerate(texts, 1):
                pending.append(windows(coded_bytes(text)))
                held += len(pending[-1])
                if held > 1 << 22 or i == len(texts):
                    grams, n = np.unique(np.concatenate(pending), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": grams.astype(np.int64), "n": n.astype(np.int64)})
                    pending, held = [], 0


def train(docs: DataFrame, max_windows: int = WINDOWS) -> Model:
    """Counts of all windows in all texts that are not held out and have a language.

    They are added up in Spark; the driver gets the most frequent ``max_windows`` in all, an
    even share for each language, ties by the window itself.
    """
    on_workers(docs.sparkSession)
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = stored(
        known.select("lang", "text")
        .mapInPandas(_counted, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    languages = sorted(r.lang for r in counts.select("lang").distinct().limit(max_windows).collect())
    share = max_windows // max(len(languages), 1)
    parts = [counts.filter(F.col("lang") == lang).orderBy(F.desc("n"), "gram").limit(share).toPandas() for lang in languages]
    parts = [p.sort_values("gram") for p in parts]
    return Model(
        tuple(languages),
        tuple(p["gram"].to_numpy(np.uint32) for p in parts),
        tuple(p["n"].to_numpy(np.float64) for p in parts),
    )


def judge(model: Model, lengths: np.ndarray) -> tuple[str, float]:
    """The language of the shortest code, and its share if each were as likely before."""
    best = int(np.argmin(lengths))
    return model.languages[best], float(1 / np.exp2(np.maximum(lengths[best] - lengths, -1000.0)).sum())


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``language``: a struct of ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = Coder(shared.value) if shared.value.languages else None
        for batch in batches:
            rows = [(UNKNOWN, 0.0)] * len(batch)
            asked = [i for i, text in enumerate(batch) if coder and text and LETTER.search(text)]
            if asked:
                found = coder.lengths(batch.iloc[asked])
                for i, lengths in zip(asked, found, strict=True):
                    rows[i] = judge(shared.value, lengths)
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return docs.withColumn("language", F.pandas_udf(score, "lang_pred string, score double")(F.col("text")))


def identify(docs: DataFrame, max_windows: int = WINDOWS) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for each row of ``docs (doc_id, text, lang)``.

    Languages and their statistics come from the rows that are not held out (three quarters, by
    the CRC-32 of the id as text; a null id is not) and have a text and a language. Whole texts are scored. A text
    that is null, empty or without a letter is ``und`` with score 0, and so is every text
    where no language was learned. Equal codes go to the first language by name. Repeated
    rows are counted and scored each; other columns are ignored.
    """
    scored = with_language(docs.select("doc_id", "text"), train(docs, max_windows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.*")

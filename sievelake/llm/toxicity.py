"""Toxicity by noisy-channel deobfuscation.

Tokens written in leetspeak, spaced out or stretched are character lattices. A Viterbi
search finds the likeliest letters under a character model of the whole corpus, and the
restored words are scored by evidence learned from labels.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelake.llm.common import held_out, on_workers, stored
from sievelake.llm.training import labelled_sample

# Labelled ids used for training, for each of the two labels.
SAMPLE = 10_000
# Evidence must occur in so many texts, be toxic in this share of them, and at most so many
# words or beginnings make up the model.
MIN_SUPPORT, MIN_PURITY, MAX_EVIDENCE = 3, 0.8, 2000
# Candidates that the labelled clean texts are searched for; the best supported come first.
MAX_CANDIDATES = 100_000
PREFIXES = (4, 5, 6)
THRESHOLD = 0.5

# Symbols of the character model: 0 for what is no letter, a-z, 27 for other letters.
SYMBOLS = 28
ORDER = 4
KEPT_TOKENS = 400_000

# Letters that a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou",
}
EDGE_SIGNS = "".join(c for c in SIGNS if not c.isalnum())
# Costs of the channel, in natural logs: a sign for a letter, a sign that means nothing, a
# letter written too often, and two words written as one.
SIGN_COST, DROP_COST, REPEAT_COST, GAP_COST = 1.0, 3.0, 1.0, 4.0

EDGES = re.compile(r"^[\W_]+|[\W_]+$")
PLAIN = re.compile(r"[^\W\d_]+")
STRETCHED = re.compile(r"(.)\1\1", re.S)
RUN = re.compile(r"(.)\1*", re.S)
BETWEEN = re.compile(r"[\W_]+")
SEPARATORS = re.compile(rf"[^\w{re.escape(EDGE_SIGNS)}]+|_+")
# Four or more equal characters mean what three do.
SAME = re.compile(r"(.)\1{3,}", re.S)
# Characters searched at once, and how many of them the next search takes again at least.
WINDOW, SHARED = 80, 20


def _symbol_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    for code in range(256):
        c = chr(code)
        table[code] = ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0
    return table


_SYMBOL = _symbol_table()


def symbols(text: str) -> np.ndarray:
    return _SYMBOL[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]


def _count_grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of four symbols in a row over all texts of a task."""
    counts = np.zeros(SYMBOLS**ORDER, np.int64)
    for frame in frames:
        for text in frame["text"]:
            s = np.concatenate([[0, 0, 0], symbols((text or "").lower()), [0]])
            grams = ((s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]) * SYMBOLS + s[3:]
            if len(grams) < 50_000:
                np.add.at(counts, grams, 1)
            else:
                counts += np.bincount(grams, minlength=len(counts))
    found = np.flatnonzero(counts)
    yield pd.DataFrame({"gram": found.astype(np.int32), "n": counts[found]})


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities of a symbol after three others, over every document.

    The counts are added up by Spark; their table has at most 28**4 rows, 5 MB.
    """
    rows = docs.select("text").mapInPandas(_count_grams, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SYMBOLS**ORDER)
    counts[rows["gram"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    counts = counts.reshape((SYMBOLS,) * ORDER)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for left in reversed(range(ORDER)):
        grams = counts.sum(axis=tuple(range(left)))
        weight = 5.0
        p = (grams + weight * p) / (grams.sum(axis=-1, keepdims=True) + weight)
    return np.log(p).astype(np.float32)


def _choices(text: str, gaps: bool) -> list[list[tuple[str, float]]]:
    """The lattice: for each run of equal characters, what may have been meant and its cost."""
    out = []
    for run in RUN.finditer(text):
        c, n = run[1], len(run[0])
        letters = [(c, 0.0)] if c.isalpha() else [(x, SIGN_COST) for x in SIGNS.get(c, "")]
        found = []
        for letter, cost in letters:
            # Two equal signs mean two letters or none, two equal letters perhaps one.
            if n != 2 or c.isalpha():
                found.append((letter, cost + (REPEAT_COST if n > 1 else 0.0)))
            if n == 2:
                found.append((letter * 2, cost))
            elif n > 2:
                found.append((letter * 2, cost + REPEAT_COST))
        if not c.isalpha():
            found.append(("", DROP_COST if letters else 0.0))
        if gaps:
            found += [(x + " ", cost + GAP_COST) for x, cost in found if x]
        out.append(found)
    return out


def restore(text: str, model: np.ndarray, gaps: bool = False) -> str:
    """The likeliest letters behind ``text``: a Viterbi search over its lattice.

    A state is the last three symbols. With ``gaps`` a space may come after any letter.
    """
    states = {(0, 0, 0): (0.0, "")}
    for choices in [*_choices(text, gaps), [(" ", 0.0)]]:
        following: dict[tuple, tuple[float, str]] = {}
        for (a, b, c), (score, sofar) in states.items():
            for letters, cost in choices:
                x, y, z, total = a, b, c, score - cost
                for s in symbols(letters).tolist():
                    total += float(model[x, y, z, s])
                    x, y, z = y, z, s
                best = following.get((x, y, z))
                if best is None or (total, sofar + letters) > best:
                    following[x, y, z] = (total, sofar + letters)
        states = following
    return max(states.values())[1].strip()


def windows(text: str, shared: int) -> list[str]:
    """Parts of a text of any length, each with the last ``shared`` characters of the one before."""
    step = max(WINDOW - shared, WINDOW // 2)
    return [text[start : start + step + shared] for start in range(0, max(1, len(text) - shared), step)]


def _may_be_word(text: str) -> bool:
    """Numbers and addresses of signs alone hold no word; one letter is enough among signs
    most of which stand for letters."""
    letters = sum(map(str.isalpha, text))
    return letters >= 2 or (letters == 1 and len(text) >= 3 and 2 * sum(c in SIGNS for c in text) > len(text) - 1)


def _restored(text: str, model: np.ndarray) -> list[str]:
    """The likeliest letters behind a text of any length, window by window."""
    return [restore(part, model) for part in windows(SAME.sub(r"\1\1\1", text), SHARED)]


def token_forms(token: str, model: np.ndarray) -> list[str]:
    """The words that a lower-case token may stand for."""
    if PLAIN.fullmatch(token) and not STRETCHED.search(token):
        return [token]
    core = EDGES.sub("", token)
    forms = set()
    if PLAIN.fullmatch(core) and not STRETCHED.search(core):
        forms.add(core)
    elif core:
        pieces = [p for p in BETWEEN.split(core) if p]
        forms.update(p for p in pieces if PLAIN.fullmatch(p))
        # The token as one word, without what separates its pieces, and each piece.
        for text in {core, "".join(pieces), *pieces, *SEPARATORS.split(core)}:
            if _may_be_word(text) and not (text in pieces and PLAIN.fullmatch(text) and not STRETCHED.search(text)):
                forms.update(_restored(text, model))
    # One or two signs at an edge may stand for letters; more in a row do not.
    head = len(token) - len(token.lstrip(EDGE_SIGNS))
    tail = len(token) - len(token.rstrip(EDGE_SIGNS))
    whole = token[head if head > 2 else 0 : len(token) - (tail if tail > 2 else 0)]
    if core and len(whole) >= 3 and (whole[0] in EDGE_SIGNS or whole[-1] in EDGE_SIGNS):
        forms.update(_restored(whole, model))
    return [f for f in forms if f]


def features(forms: list[str]) -> set[str]:
    """Whole words, marked ``=``, and beginnings of longer words, marked ``^``."""
    found = set()
    for word in forms:
        if len(word) >= 3:
            found.add("=" + word)
        found.update("^" + word[:n] for n in PREFIXES if len(word) > n)
    return found


def spaced_runs(tokens: list[str]) -> list[str]:
    """Three or more tokens of one character each in a row, joined."""
    single = np.fromiter(map(len, tokens), np.int64, len(tokens)) == 1
    if single.sum() < 3:
        return []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], single.view(np.int8), [0]])))
    return ["".join(tokens[a:b]) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a >= 3]


class Reader:
    """Features of texts, with the features of tokens seen before at hand.

    ``known`` limits the features to those of a model and lets plain tokens be dismissed at
    once. At most ``KEPT_TOKENS`` tokens are kept.
    """

    def __init__(self, model: np.ndarray, known: set[str] | None = None):
        self.model, self.known = model, known
        self.words = [k[1:] for k in known or () if k[0] == "=" and len(k) > 4]
        self.longest = max(map(len, self.words), default=0)
        self.seen: set[str] = set()
        self.hits: dict[str, frozenset] = {}

    def of_token(self, token: str) -> frozenset:
        found = features(token_forms(token, self.model))
        return frozenset(found if self.known is None else found & self.known)

    def of_run(self, run: str) -> set[str]:
        run = SAME.sub(r"\1\1\1", run)
        found: set[str] = set()
        for window in windows(run, max(SHARED, 2 * self.longest)):
            joined = restore(window, self.model)
            found |= features([*restore(window, self.model, gaps=True).split(), joined])
            found.update("=" + w for w in self.words if w in joined)
        return found if self.known is None else found & self.known

    def __call__(self, text: str | None) -> set[str]:
        tokens = (text or "").lower().split()
        different = set(tokens)
        if len(self.seen) > KEPT_TOKENS:
            self.seen.clear()
            self.hits.clear()
        new = different - self.seen
        for token in new:
            if found := self.of_token(token):
                self.hits[token] = found
        self.seen |= new
        out: set[str] = set()
        for token in different & self.hits.keys():
            out |= self.hits[token]
        for run in spaced_runs(tokens):
            out |= self.of_run(run)
        return out


@dataclass(frozen=True)
class Model:
    """Evidence with its probability of a toxic text, and the probability without any."""

    characters: np.ndarray
    evidence: dict[str, float]
    base: float

    def score(self, found: set[str]) -> float:
        clean = 1.0 - self.base
        for f in found:
            clean *= 1.0 - self.evidence[f]
        return 1.0 - clean


def _telling(support: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> list[str]:
    """Evidence that chance does not explain: with every candidate tried, less than 0.05 of
    them would be as toxic if toxic texts were spread evenly. The tail is bounded by
    Chernoff's inequality."""
    share = n_toxic / max(1, n_toxic + n_clean)
    out = []
    for f, a in support.items():
        n = a + clean.get(f, 0)
        p = a / n
        if p < MIN_PURITY or p <= share or a < MIN_SUPPORT:
            continue
        apart = p * math.log(p / share) + ((1 - p) * math.log((1 - p) / (1 - share)) if p < 1 else 0.0)
        if n * apart > math.log(len(support) / 0.05):
            out.append(f)
    return out


def _cover(texts: list[set[str]], clean: dict[str, int], support: dict[str, int]) -> list[str]:
    """Evidence one after the other: each time what explains most of the texts unexplained.

    So words that merely stand beside the telling ones, in copies of a text, are left out.
    """
    holders: dict[str, set[int]] = {}
    for number, found in enumerate(texts):
        for f in found:
            holders.setdefault(f, set()).add(number)
    chosen: list[str] = []
    while holders:
        # Among equals a whole word comes before a beginning, a shorter before a longer.
        best = max(holders, key=lambda f: (len(holders[f]), f[0] == "=", -len(f), f))
        gone = holders.pop(best)
        if len(gone) < MIN_SUPPORT:
            break
        chosen.append(best)
        for f in list(holders):
            holders[f] -= gone
            if len(holders[f]) < MIN_SUPPORT:
                del holders[f]
    return chosen


def _least_shingles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The least hash of a text's five-word shingles, for each of two hashes."""
    for frame in frames:
        least: list[list[int]] = [[], []]
        for text in frame["text"]:
            words = text.lower().split()
            shingles = [" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
            for seed in (0, 1):
                least[seed].append(min(xxhash.xxh32_intdigest(g, seed) for g in shingles))
        yield frame.assign(a=least[0], b=least[1])


def _first_of_near_copies(rows: DataFrame) -> DataFrame:
    """Sampled rows without near copies: one of those with the same least shingle hash, for
    each of two hashes. Copies would make each of their words look telling."""
    marked = rows.select("doc_id", "text", "label").mapInPandas(_least_shingles, "doc_id long, text string, label int, a long, b long")
    for c in ("a", "b"):
        first = marked.groupBy("label", c).agg(F.min(F.struct("doc_id", "text", *{"a", "b"} - {c})).alias("first"))
        marked = first.select("label", c, "first.*")
    return marked.drop("a", "b")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model out of all documents (the characters) and a bounded labelled sample.

    Without labels there is no evidence and every score is 0.
    """
    on_workers(docs.sparkSession)
    characters = character_model(docs)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(characters)
    rows = stored(_first_of_near_copies(labelled_sample(docs, labels, "toxic", sample)))

    def read(known: set[str] | None):
        def reading(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            reader = Reader(shared.value, known)
            for frame in frames:
                found = [sorted(reader(text)) for text in frame["text"]]
                yield pd.DataFrame({"doc_id": frame["doc_id"], "f": found})

        return reading

    per_doc = "doc_id long, f array<string>"
    toxic = rows.filter("label = 1").select("doc_id", "text")
    clean = rows.filter("label = 0").select("doc_id", "text")
    counts = toxic.mapInPandas(read(None), per_doc).select(F.explode("f").alias("f")).groupBy("f").count()
    counts = counts.filter(F.col("count") >= MIN_SUPPORT).orderBy(F.desc("count"), "f").limit(MAX_CANDIDATES)
    support = {r.f: r["count"] for r in counts.collect()}
    if not support:
        return Model(characters, {}, 0.0)
    candidates = set(support)
    seen = clean.mapInPandas(read(candidates), per_doc).select(F.explode("f").alias("f")).groupBy("f").count()
    in_clean = {r.f: r["count"] for r in seen.collect()}
    pure = {f for f in candidates if support[f] >= MIN_PURITY * (support[f] + in_clean.get(f, 0))}
    texts = [set(r.f) for r in toxic.mapInPandas(read(pure), per_doc).collect()]
    n_clean = clean.count()
    telling = _telling(support, in_clean, len(texts), n_clean)
    telling = sorted(telling, key=lambda f: (-support[f], f))[:MAX_EVIDENCE]
    # A beginning that one word accounts for says nothing more than the word.
    whole = [f for f in telling if f[0] == "="]
    telling = [f for f in telling if f[0] == "=" or not any(w[1:].startswith(f[1:]) and support[f] <= 1.2 * support[w] for w in whole)]
    chosen = {*telling, *_cover([t for t in texts if not t & set(telling)], in_clean, support)}
    evidence = {f: (support[f] + 0.5) / (support[f] + in_clean.get(f, 0) + 1.0) for f in chosen}
    missed = sum(not found & evidence.keys() for found in texts)
    base = min(0.4, (missed + 0.5) / (missed + n_clean + 1.0))
    return Model(characters, evidence, base)


def with_score(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with a double column ``name``: how likely the whole text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        told = shared.value
        reader = Reader(told.characters, set(told.evidence))
        for batch in batches:
            yield pd.Series([told.score(reader(text)) for text in batch], dtype="float64")

    return docs.withColumn(name, F.pandas_udf(score, "double")(F.col("text")))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs (doc_id, text)``.

    ``labels`` has ``doc_id, toxic``. Held-out ids (a fifth, by CRC-32 of the id as text)
    take no part in training; neither do null ids or labels. Null and empty texts have no
    evidence and get the score of a text without any; without labels that is 0. Repeated
    rows are scored each; other columns are ignored.
    """
    model = train(docs, labels, sample)
    scored = with_score(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

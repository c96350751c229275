"""Near-duplicate vectors by spherical-cap filters.

The filters are caps around the words of a structured random product code: a rotated vector
is cut into blocks, every block has its own code of random directions, and a word of the
code is one direction of each block. A vector is list-decoded to all words whose inner
product with it exceeds a threshold, without visiting the others. Vectors that share a word
meet, and their cosine is verified in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelake.llm.common import (
    PART,
    Forest,
    by_part,
    components,
    dealt,
    group_numbers,
    looked_up,
    on_workers,
    stored,
    whole_groups,
)

BUCKET_ROWS = 1024
CAPS_AT_ONCE = 1024
# Pairs of all buckets of up to so many rows are compared together.
SMALL_ROWS = 64
PAIRS_AT_ONCE = 1 << 14
# Random vectors of a label that meet by chance, for each of them, in a code of its size.
CHANCE = 0.5
MOST_DIRECTIONS = 1 << 14


@dataclass(frozen=True)
class Code:
    """``blocks`` codes of ``directions`` each; a vector lies in about ``lists`` caps.

    One code has 512**2 words by default. Some vectors are far from the directions of one
    code, so there are ``turns`` codes, each with a rotation of its own. ``sized`` gives the
    code for a number of vectors. Measured in 64 dimensions on 800 random pairs each, the
    share of vectors at cosine 0.93 and 0.95 that have a cap in common is 0.994 and 0.993 for 512 directions, and
    0.990 and 0.999 for 4096 with 16 lists.
    """

    blocks: int = 2
    directions: int = 512
    lists: float = 12.0
    turns: int = 4
    seed: int = 100

    @classmethod
    def sized(cls, vectors: int) -> Code:
        """The code for so many vectors of one label.

        Two random vectors share a cap with a probability of lists**2 / words in a turn, so
        with words in proportion to the vectors each of them meets ``CHANCE`` others for
        nothing, however many there are. Near vectors lose little by it: ``lists`` grows with
        a small power of the words. Beyond ``MOST_DIRECTIONS`` directions, which are enough
        for 400,000 vectors of a label, the code grows no more and chance meetings do.
        """
        words = vectors * cls.turns * cls.lists**2 / (2 * CHANCE)
        directions = int(min(max(cls.directions, np.ceil(words ** (1 / cls.blocks))), MOST_DIRECTIONS))
        return cls(directions=directions, lists=round(cls.lists * (directions / cls.directions) ** 0.14, 1))

    def caps(self, x: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the sorted numbers of its caps in all codes."""
        parts = [decode(x, *self.build(x.shape[1], turn)) for turn in range(self.turns)]
        words = self.directions**self.blocks
        return [np.concatenate([c + t * words for t, c in enumerate(own)]) for own in zip(*parts, strict=True)]

    @cache
    def build(self, dims: int, turn: int = 0) -> tuple[np.ndarray, list[np.ndarray], float]:
        """Rotation, one matrix of directions per block, threshold."""
        rng = np.random.default_rng(self.seed + turn)
        width = -(-dims // self.blocks)
        rotation, _ = np.linalg.qr(rng.standard_normal((width * self.blocks, width * self.blocks)))
        codes = []
        for _ in range(self.blocks):
            c = rng.standard_normal((self.directions, width))
            codes.append(c / np.linalg.norm(c, axis=1, keepdims=True))
        # The threshold that random unit vectors exceed for ``lists`` words on average: of
        # each probe the largest sums, made of the best directions of each block.
        sums = []
        for probe in rng.standard_normal((256, width * self.blocks)):
            probe /= np.linalg.norm(probe)
            top = np.zeros(1)
            for b, c in enumerate(codes):
                best = np.sort(c @ probe[b * width : (b + 1) * width])[-256:]
                top = np.sort((top[:, None] + best[None, :]).ravel())[-4096:]
            sums.append(top)
        found = np.sort(np.concatenate(sums))
        return rotation, codes, float(found[-min(len(found), round(self.lists * 256))])


def decode(x: np.ndarray, rotation: np.ndarray, codes: list[np.ndarray], threshold: float) -> list[np.ndarray]:
    """For each unit vector, the sorted numbers of all code words above the threshold.

    Block by block: a partial word is dropped once even the best directions of the blocks
    to come cannot lift it over the threshold.
    """
    width = codes[0].shape[1]
    rotated = np.zeros((len(x), rotation.shape[0]))
    rotated[:, : x.shape[1]] = x
    rotated = rotated @ rotation
    scores = [rotated[:, b * width : (b + 1) * width] @ c.T for b, c in enumerate(codes)]
    best = np.stack([s.max(axis=1) for s in scores], axis=1)
    rest = np.concatenate([np.cumsum(best[:, ::-1], axis=1)[:, ::-1][:, 1:], np.zeros((len(x), 1))], axis=1)
    out = []
    for i in range(len(x)):
        words, sums = np.zeros(1, np.int64), np.zeros(1)
        for b, s in enumerate(scores):
            row = s[i]
            able = np.flatnonzero(row > threshold - rest[i, b] - sums.max(initial=-9.0))
            total = sums[:, None] + row[able][None, :]
            a, c = np.nonzero(total > threshold - rest[i, b])
            words, sums = words[a] * len(row) + able[c], total[a, c]
        out.append(np.sort(words))
    return out


def _unit(rows: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Double-precision unit vectors, and which of the rows have one."""
    dims = max((len(v) for v in rows if v is not None), default=0)
    x = np.zeros((len(rows), dims))
    good = np.zeros(len(rows), bool)
    for i, v in enumerate(rows):
        if v is not None and len(v):
            x[i, : len(v)] = np.asarray(v, dtype=np.float64)
            good[i] = np.isfinite(x[i]).all() and x[i].any()
    x[~good] = 0
    # Scaled first, so that neither tiny nor huge components are lost in the squares.
    x /= np.maximum(np.abs(x).max(axis=1, initial=0), 1e-300)[:, None]
    return x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None], good


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    code: Code | None = None,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``vectors``.

    ``vectors`` has ``vec_id, embedding, label``. Two vectors are linked if their labels are
    equal and not null, they have as many dimensions, and their cosine, in double precision,
    reaches the threshold. ``n_links`` counts the other rows linked directly, copies among
    them; ``component_id`` is the least vec_id reachable; ``kept`` says that it is the
    vector's own. A vector that is null, empty or zero, or has a null or non-finite
    component, links with nothing; neither does one with a null label. A null vec_id is never
    the least. Repeated rows are vectors of their own. Other columns are ignored.

    Equal vectors of a label form one class and meet others once. A class carries its list
    of caps, so a pair that shares several is counted in the least of them only, and a
    bucket hands on counts and a spanning forest, never its pairs. A bucket of more than
    ``BUCKET_ROWS`` classes is dealt out in pairs of pieces. Without a ``code`` there is one
    sized by the classes of the largest label.
    """
    on_workers(vectors.sparkSession)
    sound = (
        F.col("label").isNotNull()
        & (F.size("embedding") > 0)
        & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists("embedding", lambda v: v != 0)
    )
    name = F.md5(F.concat_ws("|", F.col("label").cast("string"), F.to_json("embedding")).cast("binary"))
    rows = vectors.select("vec_id", "embedding", "label", F.when(sound, name).alias("class"))
    classes = stored(
        rows.filter("class IS NOT NULL")
        .groupBy("class")
        .agg(
            F.any_value("label").alias("label"),
            F.any_value("embedding").alias("embedding"),
            F.count("*").alias("copies"),
            F.min("vec_id").alias("first_id"),
        )
    )

    if code is None:
        code = Code.sized(classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0)

    def to_caps(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, some in frame.groupby(frame["embedding"].map(len)):
                x, _ = _unit(some["embedding"])
                yield some.assign(caps=[c.tolist() for c in code.caps(x)])

    kinds = dict(classes.dtypes)
    capped = stored(
        classes.select("class", "label", "copies", "embedding").mapInPandas(
            to_caps, f"class string, label {kinds['label']}, copies long, embedding {kinds['embedding']}, caps array<long>"
        )
    )
    spread = capped.select("class", "label", F.size("embedding").alias("dims"), F.explode("caps").alias("cap"))
    spread = spread.select("class", "cap", F.xxhash64("label", "dims", "cap").alias("key"))

    keys = ["key", *PART]

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, keys):
            group = group_numbers(frame, keys)
            size = np.bincount(group)[group]
            if (size == 1).all():
                continue
            small = (size > 1) & (size <= SMALL_ROWS)
            if small.any():
                yield _linked(frame[small], threshold, True)
            for _, large in frame[size > SMALL_ROWS].groupby(keys, sort=False):
                yield _linked(large, threshold, False)

    # Vectors travel only to the parts where they have company.
    parts = by_part(dealt(spread, "key", "class", BUCKET_ROWS).join(capped, "class"), "key", "class")
    seen = stored(parts.mapInPandas(verify, "class string, root string, links long"))
    linked = seen.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(seen.filter("root IS NOT NULL").select(F.col("class").alias("a"), F.col("root").alias("b")))
    known = classes.select("class", "copies", "first_id")
    in_groups = roots.join(known.select(F.col("class").alias("node"), "first_id"), "node")
    least = in_groups.groupBy("root").agg(F.min("first_id").alias("component"), F.count("*").alias("members"))
    sizes = classes.agg(F.count("*").alias("classes"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")).first()
    component = looked_up(in_groups, least, "root", "members", sizes["classes"]).select(F.col("node").alias("class"), "component")
    facts = (
        known.join(linked, "class", "left")
        .join(component, "class", "left")
        .select(
            "class",
            "copies",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "first_id").alias("component_id"),
        )
    )
    # Rows without a class stay out of the join, where they would meet in one task.
    ids = rows.select("vec_id", "class")
    whole = looked_up(ids.filter("class IS NOT NULL"), facts, "class", "copies", sizes["rows"]).drop("class")
    single = ids.filter("class IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return whole.unionByName(single).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _met_below(caps: list[np.ndarray], cap: np.ndarray) -> np.ndarray:
    """Which two rows share a cap below the one they are in; a matrix of flags.

    Products of 0-1 matrices of row and cap, ``CAPS_AT_ONCE`` columns each, count the shared
    caps of all pairs together.
    """
    who = np.repeat(np.arange(len(caps)), [len(c) for c in caps])
    every = np.concatenate([np.asarray(c, np.int64) for c in caps])
    low = every < cap[who]
    _, column, times = np.unique(every[low], return_inverse=True, return_counts=True)
    who = who[low][times[column] > 1]
    _, column = np.unique(column[times[column] > 1], return_inverse=True)
    met = np.zeros((len(caps), len(caps)), bool)
    for start in range(0, int(column.max(initial=-1)) + 1, CAPS_AT_ONCE):
        some = (column >= start) & (column < start + CAPS_AT_ONCE)
        holds = np.zeros((len(caps), CAPS_AT_ONCE), np.float32)
        holds[who[some], column[some] - start] = 1
        met |= holds @ holds.T > 0
    return met


def _pairs_met_below(caps: list[np.ndarray], cap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same for given pairs of rows, by sorting the caps of both."""
    met = np.zeros(len(a), bool)
    for start in range(0, len(a), PAIRS_AT_ONCE):
        some = slice(start, start + PAIRS_AT_ONCE)
        both = [np.asarray(caps[i], np.int64) for i in np.concatenate([a[some], b[some]])]
        n = len(both) // 2
        pair = np.repeat(np.concatenate([np.arange(n), np.arange(n)]), [len(c) for c in both])
        every = np.concatenate(both)
        low = every < cap[a[some]][pair]
        pair, every = pair[low], every[low]
        order = np.lexsort((every, pair))
        pair, every = pair[order], every[order]
        met[start + pair[1:][(pair[1:] == pair[:-1]) & (every[1:] == every[:-1])]] = True
    return met


def _pairs(starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of the same group; groups are runs that begin at ``starts``."""
    end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    later = end - np.arange(n) - 1
    a = np.repeat(np.arange(n), later)
    return a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(later) - later, later)


def _linked(rows: pd.DataFrame, threshold: float, small: bool) -> pd.DataFrame:
    """Links within one large bucket or many small ones.

    Per class the copies linked, and an edge to the root of a tree.
    """
    x, _ = _unit(rows["embedding"])
    n, label, dims = len(rows), rows["label"].to_numpy(), rows["embedding"].map(len).to_numpy(np.int64)
    cap, caps = rows["cap"].to_numpy(), rows["caps"].to_numpy()
    own, copies = rows["own"].to_numpy(), rows["copies"].to_numpy()
    across = (rows["part_a"] != rows["part_b"]).to_numpy()
    group = group_numbers(rows, ["key", *PART])
    if small:
        a, b = _pairs(np.flatnonzero(np.append(True, group[1:] != group[:-1])), n)
        near = [
            np.einsum("ij,ij->i", x[a[i : i + PAIRS_AT_ONCE]], x[b[i : i + PAIRS_AT_ONCE]]) >= threshold
            for i in range(0, len(a), PAIRS_AT_ONCE)
        ]
        near = np.concatenate([*near, np.zeros(0, bool)])
        a, b = a[near], b[near]
    else:
        a, b = np.nonzero(np.triu(x @ x.T >= threshold, 1))
    # The key is a hash of label, cap and size: equal keys are checked to mean all three.
    fits = (label[a] == label[b]) & (dims[a] == dims[b]) & (cap[a] == cap[b])
    fits &= ~across[a] | (own[a] != own[b])
    a, b = a[fits], b[fits]
    if len(a):
        if small:
            first = ~_pairs_met_below(caps, cap, a, b)
        else:
            met, row = np.unique(np.concatenate([a, b]), return_inverse=True)
            below = _met_below(list(caps[met]), cap[met])
            first = ~below[row[: len(a)], row[len(a) :]]
        a, b = a[first], b[first]
    links = np.zeros(n, np.int64)
    np.add.at(links, a, copies[b])
    np.add.at(links, b, copies[a])
    forest = Forest(n)
    forest.join(a, b)
    child, root = forest.edges()
    names = rows["class"].to_numpy()
    up = np.full(n, None, object)
    up[child] = names[root]
    some = links > 0
    return pd.DataFrame({"class": names[some], "root": up[some], "links": links[some]})

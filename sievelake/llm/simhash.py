"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that agree in one of several groups of bits, or whose texts agree in the least
hashes of their shingles, meet in a bucket. There their bits
are stored as vertical planes, one bit of 64 neighbours in each machine word, and the
distances of 64 pairs grow together in carry-save counters. A word of pairs is abandoned as
soon as all of its distances exceed the radius.

With a similarity, near fingerprints are only candidates. Every text that has one is compared
with its whole family of candidates, and linked where the sets of shingle hashes are so alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelake.llm.common import (
    Forest,
    by_merge,
    by_part,
    components,
    dealt,
    fresh,
    group_numbers,
    looked_up,
    on_workers,
    stored,
    whole_groups,
)

SEED = 42
BUCKET_ROWS = 4096
# A row of a family counts once more for each so many shingles that it brings along.
FAMILY_SHINGLES = 512
# Shingle hashes of pairs that are verified together.
VERIFIED_AT_ONCE = 1 << 21
PLANES_AT_ONCE = 8
# Pairs of rows whose distances grow together.
LANES_AT_ONCE = 1 << 18


@dataclass(frozen=True)
class Search:
    """What a fingerprint is and what must agree for two of them to be compared.

    ``keys`` are bit ranges ``(first, last + 1)`` counted from the highest bit; a bucket is
    one of ``keys`` with its value. With ``bands``, a bucket is instead one of so many bands
    with the least hashes of ``band_rows`` orders of the text's shingles. With a ``similarity``
    in thousandths, fingerprints are of distinct shingles, and texts are linked whose sets of
    shingles have at least that Jaccard similarity; ``radius`` then bounds the candidates.
    """

    words: int = 4
    bits: int = 64
    radius: int = 4
    keys: tuple[tuple[tuple[int, int], ...], ...] = field(default=())
    bands: int = 0
    band_rows: int = 3
    similarity: int = 0


def exact_search(words: int = 4, radius: int = 4, spare: int = 2) -> Search:
    """All pairs of 64-bit fingerprints within ``radius``.

    The bits are cut into ``radius + spare`` ranges. A pair that differs in ``radius`` bits
    at most leaves ``spare`` ranges untouched, so it meets in one of their combinations.
    """
    cuts = np.linspace(0, 64, radius + spare + 1).round().astype(int).tolist()
    ranges = list(zip(cuts[:-1], cuts[1:], strict=True))
    return Search(words, 64, radius, tuple(combinations(ranges, spare)))


# Five words and a similarity of 0.8. Two texts whose shingle sets have Jaccard 0.8 have a
# cosine of 0.89 and differ in 15 % of the bits: 155 of 1024, give or take 11, and sets of
# four and five shingles in 192, give or take 12. The radius takes three times that and more,
# so it loses less than 0.001 of the pairs; what is too far apart is told by the sets
# themselves. A band of two least hashes agrees with probability 0.8 ** 2, and one of eight
# bands with 0.9997. Texts without common shingles never share a band, so a bucket grows with
# its group of copies and not with the corpus.
SIMILAR = Search(5, 1024, 232, bands=8, band_rows=2, similarity=800)

# Shingles of one text that are mixed together.
SHINGLES_AT_ONCE = 4096
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def _mixed(h: np.ndarray, turns: range) -> np.ndarray:
    """Other 64 bits out of each 64-bit hash, a row per turn; turn 0 leaves it as it is."""
    if turns == range(1):
        return h[None, :]
    steps = np.array([0x9E3779B97F4A7C15 * turn % 2**64 for turn in turns], np.uint64)
    with np.errstate(over="ignore"):
        x = h + steps[:, None]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    x[steps == 0] = h
    return x


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of each shingle of a whole text, repeats included."""
    tokens = (text or "").encode().lower().split()  # on bytes: A-Z and ASCII white space only
    if not tokens:
        return np.zeros(0, np.uint64)
    line = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    last = ends[min(words, len(tokens)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    return np.frombuffer(
        b"".join([digest(line[a:b], SEED) for a, b in zip(starts, last, strict=False)]), ">u8"
    ).astype(np.uint64)


def _majority(hashes: np.ndarray, bits: int) -> bytes:
    """The bits set in more than half of the hashes; of no hashes, zero.

    All bytes are counted by place and value, and the values' bits weighed afterwards.
    """
    octets = bits // 8
    seen = np.zeros(octets * 256)
    for start in range(0, len(hashes), SHINGLES_AT_ONCE):
        some = _mixed(hashes[start : start + SHINGLES_AT_ONCE], range(bits // 64))
        value = some.astype(">u8").view(np.uint8).reshape(bits // 64, -1, 8)
        place = value + (np.arange(octets) * 256).reshape(bits // 64, 1, 8)
        seen += np.bincount(place.ravel(), minlength=octets * 256)
    return np.packbits((seen.reshape(octets, 256) @ _BYTE_BITS).ravel() * 2 > len(hashes)).tobytes()


def fingerprint(text: str | None, words: int, bits: int) -> bytes:
    """The fingerprint of a whole text; of a text without words, zero."""
    return _majority(shingle_hashes(text, words), bits)


def _bands(hashes: np.ndarray, search: Search) -> list[int]:
    """The text's bands; a text without words has none, and its fingerprint is zero."""
    if not search.bands or not len(hashes):
        return []
    first, rows = search.bits // 64, search.band_rows
    turns = range(first, first + search.bands * rows)
    least = np.min(
        [_mixed(hashes[a : a + SHINGLES_AT_ONCE], turns).min(axis=1) for a in range(0, len(hashes), SHINGLES_AT_ONCE)],
        axis=0,
    )
    return [
        xxhash.xxh64_intdigest(least[band * rows : (band + 1) * rows].tobytes(), band) - 2**63
        for band in range(search.bands)
    ]


def fingerprints(docs: DataFrame, search: Search) -> DataFrame:
    """``(doc_id, text_hash, fp, bands)`` of each row; ``text_hash`` tells rows of one id apart."""

    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            fps, bands = [], []
            for text in batch:
                hashes = shingle_hashes(text, search.words)
                if search.similarity:
                    hashes = np.unique(hashes)
                fps.append(_majority(hashes, search.bits))
                bands.append(_bands(hashes, search))
            yield pd.DataFrame({"fp": fps, "bands": bands})

    made = F.pandas_udf(of, "fp binary, bands array<long>")(F.col("text"))
    return docs.select("doc_id", _text_hash(docs).alias("text_hash"), made.alias("made")).select("doc_id", "text_hash", "made.*")


def _text_hash(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def _with_keys(search: Search):
    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            octets = np.frombuffer(b"".join(frame["fp"]), np.uint8).reshape(len(frame), -1)
            planes = np.unpackbits(octets, axis=1)
            for number, ranges in enumerate(search.keys):
                value = np.full(len(frame), number, np.int64)
                for first, end in ranges:
                    for bit in range(first, end):
                        value = value << 1 | planes[:, bit]
                yield pd.DataFrame({"key": value, "fp": frame["fp"]})

    return keyed


def _exceeding(counter: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count, in vertical binary, is greater than ``radius``."""
    greater, equal = over.copy(), ~over
    for place in reversed(range(len(counter))):
        if not radius >> place & 1:
            greater |= equal & counter[place]
            equal &= ~counter[place]
        else:
            equal &= counter[place]
    return greater


def near_pairs(
    octets: np.ndarray,
    group: np.ndarray,
    radius: int,
    own: np.ndarray | None = None,
    tree: np.ndarray | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows ``p`` and ``p + d`` of one group within ``radius`` bits, several d at a time.

    ``octets`` holds a fingerprint per row, ``group`` ascending numbers. Rows with the same
    ``own`` are not compared where their group's part says so, which is when ``own`` is given
    as a value of 0 or more. Rows with the same ``tree`` are known to be linked and not
    compared either; the caller may change it between two steps.
    """
    n = len(octets)
    lanes = -(-n // 64) * 64
    bits = np.zeros((octets.shape[1] * 8, lanes + 64), np.uint8)
    bits[:, :n] = np.unpackbits(octets, axis=1).T
    packed = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    planes = packed[:, : lanes // 64]
    width = packed.shape[1]
    places = radius.bit_length()
    d = 1
    while d < n:
        # Several distances in the list at once, few at first: they connect most copies.
        steps = np.arange(d, min(n, d + max(1, min(d, LANES_AT_ONCE // lanes))))
        d += len(steps)
        lane = np.zeros((len(steps), lanes // 64), np.uint64)
        together = False
        for number, step in enumerate(steps.tolist()):
            alive = np.zeros(lanes, np.uint8)
            alive[: n - step] = group[step:] == group[:-step]
            if not alive.any():
                break
            together = True
            if own is not None:
                alive[: n - step] &= (own[step:] < 0) | (own[step:] != own[:-step])
            if tree is not None:
                alive[: n - step] &= tree[step:] != tree[:-step]
            lane[number] = np.packbits(alive, bitorder="little").view(np.uint64)
        if not together:
            return
        number, live = np.nonzero(lane)
        if not len(live):
            continue
        by = steps[number]
        turn = (by % 64).astype(np.uint64)
        low = np.minimum(live + by // 64, width - 1)
        high = np.minimum(low + 1, width - 1)
        counter = [np.zeros(len(live), np.uint64) for _ in range(places)]
        over = ~lane[number, live]
        for start in range(0, len(planes), PLANES_AT_ONCE):
            rows = slice(start, start + PLANES_AT_ONCE)
            # Shifted by 64 - turn in two parts, as a shift by 64 is none.
            other = packed[rows, low] >> turn | packed[rows, high] << np.uint64(1) << (np.uint64(63) - turn)
            for carry in planes[rows, live] ^ other:
                for place in range(places):
                    count = counter[place]
                    counter[place], carry = count ^ carry, count & carry
                over |= carry
            over = _exceeding(counter, over, radius)
            keep = np.flatnonzero(~over)
            if len(keep) < len(live):
                live, low, high, over = live[keep], low[keep], high[keep], over[keep]
                by, turn = by[keep], turn[keep]
                counter = [c[keep] for c in counter]
            if not len(live):
                break
        if len(live):
            word, bit = np.nonzero(np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            p = live[word] * 64 + bit
            yield p, p + by[word]


def _links(radius: int):
    keys = ["key", "part_a", "part_b"]

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, keys):
            octets = np.frombuffer(b"".join(frame["fp"]), np.uint8).reshape(len(frame), -1)
            # Where two pieces meet, a piece's own rows have met before.
            own = np.where(frame["part_a"] == frame["part_b"], -1, frame["own"])
            forest = Forest(len(frame))
            every = np.arange(len(frame))
            tree = every.copy()
            for a, b in near_pairs(octets, group_numbers(frame, keys), radius, own, tree):
                forest.join(a, b)
                tree[:] = forest.roots(every)
            child, root = forest.edges()
            if len(child):
                fp = frame["fp"].to_numpy()
                yield pd.DataFrame({"a": fp[child], "b": fp[root]})

    return link


def _alike(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, similarity: int) -> np.ndarray:
    """Which pairs of sets, given as ascending numbers, have that Jaccard similarity."""
    sizes = np.array([len(sets[i]) for i in (*a, *b)]).reshape(2, -1)
    pair = np.repeat(np.tile(np.arange(len(a)), 2), sizes.ravel())
    value = np.concatenate([sets[i] for i in (*a, *b)])
    # A number that a pair has twice stands next to itself.
    order = np.lexsort((value, pair))
    pair, value = pair[order], value[order]
    twice = (value[1:] == value[:-1]) & (pair[1:] == pair[:-1])
    common = np.bincount(pair[1:][twice], minlength=len(a))
    return common * 1000 >= similarity * (sizes.sum(axis=0) - common)


def _verified_links(search: Search):
    """Links of texts of a family that are as alike as asked for: a spanning forest."""
    keys = ["root", "part_a", "part_b"]

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, keys):
            octets = np.frombuffer(b"".join(frame["fp"]), np.uint8).reshape(len(frame), -1)
            own = np.where(frame["part_a"] == frame["part_b"], -1, frame["own"])
            sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
            size = np.array([len(s) for s in sets])
            forest = Forest(len(frame))
            every = np.arange(len(frame))
            tree = every.copy()
            for a, b in near_pairs(octets, group_numbers(frame, keys), search.radius, own, tree):
                # Sets of too different sizes cannot be alike.
                fits = np.minimum(size[a], size[b]) * 1000 >= search.similarity * np.maximum(size[a], size[b])
                a, b = a[fits], b[fits]
                while len(a):
                    apart = tree[a] != tree[b]
                    a, b = a[apart], b[apart]
                    # A part at a time: pairs that link spare the comparison of others.
                    n = max(1, int(np.searchsorted(np.cumsum(size[a] + size[b]), VERIFIED_AT_ONCE)))
                    some_a, some_b = a[:n], b[:n]
                    a, b = a[n:], b[n:]
                    if len(some_a):
                        told = _alike(sets, some_a, some_b, search.similarity)
                        if told.any():
                            forest.join(some_a[told], some_b[told])
                            tree[:] = forest.roots(every)
            child, root = forest.edges()
            if len(child):
                fp = frame["fp"].to_numpy()
                yield pd.DataFrame({"a": fp[child], "b": fp[root]})

    return link


def _verified(docs: DataFrame, rows: DataFrame, links: DataFrame, search: Search) -> DataFrame:
    """The links between texts alike, of the families that ``links`` between near fingerprints make.

    A text's shingles travel once to its family, and again for each piece that a large
    family is dealt in.
    """
    family = stored(components(links))
    one = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("one"))
    one = one.join(family, one["fp"] == family["node"]).select(
        F.col("fp").alias("_fp"), F.col("root").alias("_root"), F.col("one.doc_id").alias("_id"), F.col("one.text_hash").alias("_hash")
    )
    docs = docs.select("doc_id", "text")
    found = docs["doc_id"].eqNullSafe(F.col("_id")) & (_text_hash(docs) == F.col("_hash"))
    texts = docs.join(one, found).select(F.col("_fp").alias("fp"), F.col("_root").alias("root"), docs["text"]).dropDuplicates(["fp"])

    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([np.unique(shingle_hashes(text, search.words)).tobytes() for text in batch])

    brought = stored(texts.select("fp", "root", F.pandas_udf(sets, "binary")(F.col("text")).alias("shingles")))
    weighed = brought.withColumn("weight", 1 + F.floor(F.length("shingles") / (8 * FAMILY_SHINGLES)))
    parts = by_part(dealt(weighed, "root", "fp", BUCKET_ROWS, "weight"), "root", "fp")
    return parts.mapInPandas(_verified_links(search), "a binary, b binary")


def _grouped(docs: DataFrame, search: Search) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, text_hash, fp)`` of each row and ``(fp, root, component_id)`` of each ``fp``."""
    on_workers(docs.sparkSession)
    rows = stored(fingerprints(docs, search))
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("members")))
    if search.bands:
        # Texts of one fingerprint may differ, so each keeps its bands.
        keyed = rows.select(F.explode("bands").alias("key"), "fp").distinct()
    else:
        keyed = classes.select("fp").mapInPandas(_with_keys(search), "key long, fp binary")
    parts = by_part(dealt(keyed, "key", "fp", BUCKET_ROWS), "key", "fp")
    links = parts.mapInPandas(_links(search.radius), "a binary, b binary")
    if search.similarity:
        links = _verified(docs, rows, links, search)
    total = classes.count()
    roots = by_merge(components(links), total)
    linked = roots.join(classes, roots["node"] == classes["fp"]).select("root", "fp", "first_id")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component"), F.count("*").alias("members"))
    merged = looked_up(linked, least, "root", "members", total).select("fp", "root", "component")
    classes = classes.join(merged, "fp", "left").select(
        "fp",
        F.coalesce("root", "fp").alias("root"),
        F.coalesce("component", "first_id").alias("component_id"),
        "members",
    )
    return rows, classes


def near_duplicates(docs: DataFrame, search: Search | None = None) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for each row of ``docs (doc_id, text)``.

    A bit of the fingerprint is set if it is set in more than half of the hashes of the
    text's word shingles, repeats included. Fingerprints within the radius are linked;
    ``component_id`` is the least doc_id reachable. Null, empty and blank texts have
    fingerprint zero and are linked as any other; a null doc_id is kept and never the least.
    Equal fingerprints are compared once, whatever the number of their documents. Repeated
    rows are kept; other columns are ignored.

    With a similarity, the fingerprint is of distinct shingles, and it is the texts that are
    compared, one for each fingerprint. A bucket of more than ``BUCKET_ROWS`` fingerprints is dealt out in pairs of pieces. A
    bucket hands on the edges of a spanning forest only.
    """
    rows, classes = _grouped(docs, search or exact_search())
    return looked_up(rows, classes, "fp", "members", rows.count()).select(
        "doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id"
    )


def one_of_each_group(docs: DataFrame, search: Search | None = None) -> DataFrame:
    """``docs`` with one row of each group of near copies: that with the least doc_id.

    A null id comes last, and of rows with the same id and text one stays. All columns are
    kept. What goes is looked up by id and text, so the ids alone travel.
    """
    rows, classes = _grouped(docs, search or exact_search())
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    own_id, own_hash = fresh("id"), fresh("hash")
    total = rows.count()
    with_root = looked_up(rows.select("fp", "doc_id", "text_hash"), classes, "fp", "members", total)
    grouped = stored(with_root.select("root", "doc_id", "text_hash"))
    first = grouped.groupBy("root").agg(F.min(place).alias("first"), F.count("*").alias("members"))
    told = stored(
        looked_up(grouped, first, "root", "members", total)
        .groupBy("doc_id", "text_hash")
        .agg(F.count("*").alias("n"), F.min("first").alias("first"))
        .select(
            F.col("doc_id").alias(own_id),
            F.col("text_hash").alias(own_hash),
            "n",
            (place == F.col("first")).alias("stays"),
        )
    )
    found = docs["doc_id"].eqNullSafe(F.col(own_id)) & (_text_hash(docs) == F.col(own_hash))
    gone = told.filter("NOT stays OR n > 1").select(own_id, own_hash)
    kept = docs.join(gone, found, "left_anti")
    again = told.filter("stays AND n > 1").select(own_id, own_hash)
    if again.isEmpty():
        return kept
    one = docs.join(again, found, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(one)

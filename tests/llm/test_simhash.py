"""SimHash near-duplicates against comparing all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sievelake.llm import simhash

SCHEMA = "doc_id long, text string, fp string, root string, component_id string"


def plain_fingerprint(text, words=4):
    tokens = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    grams = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, radius):
    distinct = sorted(set(prints))
    parent = {p: p for p in distinct}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[root(b)] = root(a)
    least = {}
    for i, p in zip(ids, prints, strict=True):
        if i is not None:
            least[root(p)] = min(i, least.get(root(p), i))
    return [least.get(root(p)) for p in prints]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    out = [None, "", " \t\n", "ONE two", "one TWO", "é É\x0b\x1cx", "the " * 30_000, "one two three four"]
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 20, 80, 200]))]
        out.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy))
    return out + out[8:14]


def test_equals_brute_force(spark, texts):
    rows = [(i + 10, t, "x", "y", "z") for i, t in enumerate(texts)] + [(None, texts[9], None, None, None), (10, texts[0], "", "", "")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    prints = [plain_fingerprint(r[1]) for r in rows]
    expected = zip([r[0] for r in rows], [f"{p:016x}" for p in prints], plain_components([r[0] for r in rows], prints, 4), strict=True)
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.one_of_each_group(empty).collect() == []


def test_two_of_six_ranges_find_every_pair_within_four_bits():
    rng = np.random.default_rng(3)
    keys = simhash.exact_search(4, 4).keys
    for _ in range(300):
        flipped = set(rng.choice(64, 4, replace=False).tolist())
        assert any(all(not flipped & set(range(a, b)) for a, b in ranges) for ranges in keys)


@pytest.mark.parametrize("radius,size", [(4, 8), (39, 32), (0, 8)])
def test_near_pairs_equals_popcount(radius, size):
    rng = np.random.default_rng(radius)
    group = np.sort(rng.integers(0, 9, 400))
    base = rng.integers(0, 256, (9, size), dtype=np.uint8)
    octets = base[group].copy()
    for row in octets:
        for bit in rng.integers(0, size * 8, rng.integers(0, radius + 3)):
            row[bit // 8] ^= 128 >> bit % 8
    own = np.where(group == 3, rng.integers(0, 2, 400), -1)
    found = {(a, b) for x, y in simhash.near_pairs(octets, group, radius, own) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    expected = {
        (a, b)
        for a in range(400)
        for b in range(a + 1, 400)
        if group[a] == group[b]
        and (group[a] != 3 or own[a] != own[b])
        and sum((octets[a] ^ octets[b]).tolist()[k].bit_count() for k in range(size)) <= radius
    }
    assert found == expected


def test_hot_bucket_is_dealt_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 7)
    # A chain: each text differs from the next in one word, all share most bits.
    words = [f"k{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words[i * 6] = f"new{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_fingerprint(t) for _, t in rows]
    assert [found[i] for i in range(60)] == plain_components(list(range(60)), prints, 4)


def test_one_of_each_group_keeps_the_least_and_all_columns(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(5000)}" for _ in range(300)]
    near = list(words)
    near[150] = "other"
    other = " ".join(f"v{rng.randrange(5000)}" for _ in range(300))
    rows = [
        (5, " ".join(near), "a"), (3, " ".join(words), "b"), (9, other, "c"), (9, other, "d"),
        (None, other, "e"), (3, "another text altogether with words", "f"), (None, "alone", "g"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = simhash.one_of_each_group(docs, simhash.SIMILAR).collect()
    assert docs.columns == list(kept[0].asDict())
    assert sorted((r.doc_id or -1, r.text[:7]) for r in kept) == sorted(
        [(3, rows[1][1][:7]), (9, other[:7]), (3, "another"), (-1, "alone")]
    )


def test_similar_search_finds_planted_copies_and_no_others(spark):
    rng = random.Random(8)
    rows, pairs = [], {}
    for i in range(150):
        n = rng.choice([100, 150, 400])
        words = [f"w{rng.randrange(9000)}" for _ in range(n)]
        rows.append((2 * i, " ".join(words)))
        # One word in a hundred changed: five-word shingles stay 0.9 alike, more or less.
        for _ in range(max(1, n // 100)):
            words[rng.randrange(n)] = "changed"
        if i % 2:
            rows.append((2 * i + 1, " ".join(words)))
            pairs[2 * i + 1] = 2 * i
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.one_of_each_group(docs, simhash.SIMILAR).collect()}
    gone = {r[0] for r in rows} - kept
    assert gone <= set(pairs)
    assert len(gone) >= 0.97 * len(pairs)


def border_texts():
    """Texts in families whose shingle sets are 0.75 to 0.85 alike, short ones among them."""
    rng = random.Random(21)
    out = []
    for family in range(90):
        n = rng.choice([8, 9, 30, 60, 150, 500])
        words = [f"f{family}w{k}" for k in range(n)]
        out.append(" ".join(words))
        for copy in range(3):
            # k words cut off the end leave (n - 4 - k) of n - 4 shingles.
            if copy == 0:
                out.append(" ".join(words[: n - round((n - 4) * rng.uniform(0.15, 0.25))]))
            else:
                changed = list(words)
                changed[n - round((n - 4) * rng.uniform(0.08, 0.14)) :] = [f"f{family}c{copy}x{k}" for k in range(rng.choice([1, n // 10]))]
                out.append(" ".join(changed))
    # A line that outweighs the rest: the same majority of shingles, quite different sets.
    for family in range(5):
        line = "one line again and again "
        out += [line * 400 + " ".join(f"g{family}{side}{k}" for k in range(100)) for side in "ab"]
    return out


def jaccard_groups(texts, words=5):
    sets = []
    for t in texts:
        tokens = t.lower().split()
        sets.append({tuple(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))})
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    border = 0
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            common = len(sets[i] & sets[j])
            whole = len(sets[i] | sets[j])
            border += 0.75 <= common / whole <= 0.85
            if common * 10 >= whole * 8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))], border


@pytest.mark.parametrize("bucket", [4096, 3])
def test_similar_search_equals_brute_force_at_the_border(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket)
    texts = border_texts()
    expected, border = jaccard_groups(texts)
    assert border > 100 and 0.2 * len(texts) < len(set(expected)) < 0.9 * len(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, simhash.SIMILAR).collect()}
    assert [found[i] for i in range(len(texts))] == expected
    kept = {r.doc_id for r in simhash.one_of_each_group(docs, simhash.SIMILAR).collect()}
    assert kept == set(expected)


def test_pipeline_stage_keeps_what_is_not_alike(spark):
    import corpus_pipeline

    texts = border_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()} == set(jaccard_groups(texts)[0])


def test_fingerprint_agrees_with_spark_hash(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("one two")).alias("h")).first()
    assert plain_fingerprint("one two") == row.h % 2**64
    assert int.from_bytes(simhash.fingerprint("One two", 4, 64), "big") == row.h % 2**64


def test_many_bits_and_chunks(monkeypatch):
    """The wide fingerprint against counting bit by bit, and the same whatever the chunk."""
    text = " ".join(f"w{i % 37} v{i % 11}" for i in range(150))
    hashes = simhash.shingle_hashes(text, 5)
    bits = "".join(
        str(int(2 * sum(int(h) >> place & 1 for h in simhash._mixed(hashes, range(turn, turn + 1))[0]) > len(hashes)))
        for turn in range(16)
        for place in range(63, -1, -1)
    )
    expected, bands = int(bits, 2).to_bytes(128, "big"), simhash._bands(hashes, simhash.SIMILAR)
    assert simhash.fingerprint(text, 5, 1024) == expected
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert simhash.fingerprint(text, 5, 1024) == expected
    assert simhash._bands(hashes, simhash.SIMILAR) == bands and len(set(bands)) == 8
    assert simhash._bands(simhash.shingle_hashes(" \t", 5), simhash.SIMILAR) == []

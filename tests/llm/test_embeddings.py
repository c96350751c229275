"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from sievelake.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, class string, copies string"


def plain(rows, threshold=0.93):
    def sound(v, label):
        return label is not None and v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)

    n = len(rows)
    ok = [i for i in range(n) if sound(rows[i][1], rows[i][2])]
    parent, links = list(range(n)), [0] * n
    by = {}
    for i in ok:
        by.setdefault((rows[i][2], len(rows[i][1])), []).append(i)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = 0
    for members in by.values():
        x = np.array([rows[i][1] for i in members], np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1)), strict=True):
            i, j = members[a], members[b]
            links[i] += 1
            links[j] += 1
            pairs += 1
            parent[root(i)] = root(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[root(i)] = min(rows[i][0], least.get(root(i), rows[i][0]))
    return [(r[0], links[i], least.get(root(i)), r[0] is not None and r[0] == least.get(root(i))) for i, r in enumerate(rows)], pairs


def near(v, cosine, rng):
    v = v / np.linalg.norm(v)
    w = rng.standard_normal(len(v))
    w -= (w @ v) * v
    return cosine * v + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def found(spark, rows, **more):
    frame = spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], label, "", "") for i, v, label in rows], SCHEMA)
    return [tuple(r) for r in embeddings.near_vectors(frame, **more).collect()]


def test_recall_against_all_pairs(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        v = rng.standard_normal(64).astype(np.float32)
        rows.append((len(rows), v, i % 3))
        for c in rng.uniform(0.93, 1.0, rng.integers(0, 3)):
            rows.append((len(rows), near(v.astype(float), c, rng).astype(np.float32), i % 3))
    expected, pairs = plain(rows)
    mine = found(spark, rows)
    assert sum(r[1] for r in mine) <= 2 * pairs
    assert sum(r[1] for r in mine) >= 0.97 * 2 * pairs
    assert len(set(mine) & set(expected)) >= 0.97 * len(rows)


def test_given_vectors(spark):
    # No two of the given vectors are that near; every eighth gets a neighbour at the border.
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    rng = np.random.default_rng(6)
    rows += [(100_000 + i, near(np.asarray(v, float), rng.uniform(0.93, 0.94), rng).astype(np.float32), label) for i, v, label in rows[::8]]
    expected, pairs = plain(rows)
    mine = found(spark, rows)
    assert pairs >= 200
    assert 0.95 * 2 * pairs <= sum(r[1] for r in mine) <= 2 * pairs
    assert len(set(mine) & set(expected)) >= 0.97 * len(rows)


@pytest.mark.parametrize("vectors", [500, 50_000, 300_000])
def test_recall_of_codes_of_all_sizes(vectors):
    code = embeddings.Code.sized(vectors)
    rng = np.random.default_rng(vectors)
    a = rng.standard_normal((500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = np.stack([near(v, c, rng) for v, c in zip(a, rng.uniform(0.93, 0.95, len(a)), strict=True)])
    mine, theirs = code.caps(a), code.caps(b)
    assert np.mean([len(np.intersect1d(x, y)) > 0 for x, y in zip(mine, theirs, strict=True)]) >= 0.97
    # Chance meetings: every two of ``a`` are random.
    every, times = np.unique(np.concatenate(mine), return_counts=True)
    chance = (times * (times - 1) / 2).sum() / (len(a) * (len(a) - 1) / 2)
    assert vectors / 2 * chance <= 4


def test_pairs_of_runs():
    a, b = embeddings._pairs(np.array([0, 3, 4]), 6)
    assert list(zip(a.tolist(), b.tolist(), strict=True)) == [(0, 1), (0, 2), (1, 2), (4, 5)]


@pytest.mark.parametrize("small", [2, 64])
def test_small_and_large_buckets_agree(spark, monkeypatch, small):
    monkeypatch.setattr(embeddings, "SMALL_ROWS", small)
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(12):
        v = rng.standard_normal(32)
        rows += [(len(rows) + i, near(v, rng.uniform(0.93, 1), rng).astype(np.float32), 1) for i in range(9)]
    expected, _ = plain(rows)
    mine = found(spark, rows)
    assert len(set(mine) & set(expected)) >= 0.95 * len(rows)
    assert all(m[1] <= e[1] for m, e in zip(sorted(mine), sorted(expected), strict=True))


@pytest.mark.parametrize("limit", [1024, 5])
def test_copies_and_hot_groups(spark, monkeypatch, limit):
    monkeypatch.setattr(embeddings, "BUCKET_ROWS", limit)
    rng = np.random.default_rng(2)
    v = rng.standard_normal(16)
    rows = [(100 + i, v, 1) for i in range(30)] + [(i, near(v, 0.999, rng), 1) for i in range(40)] + [(500 + i, v * 3, 2) for i in range(3)]
    rows = [(i, np.asarray(x, np.float32), y) for i, x, y in rows]
    expected, _ = plain(rows)
    assert sorted(found(spark, rows)) == sorted(expected)


def test_odd_vectors_link_with_nothing(spark):
    v = [1.0] * 8
    rows = [(1, v, 1), (2, v, None), (3, None, 1), (4, [0.0] * 8, 1), (5, [float("nan")] * 8, 1), (6, [None] + v[1:], 1), (7, [float("inf")] * 8, 1),
            (8, [], 1), (9, v[:4], 1), (10, [1e-30] * 8, 1), (1, v, 1), (None, v, 1), (11, [3e38] * 8, 1)]
    mine = found(spark, rows)
    singles = {r[0] for r in mine if r[1] == 0}
    assert singles == {2, 3, 4, 5, 6, 7, 8, 9}
    assert all(r[2] == 1 and r[1] == 4 for r in mine if r[0] not in singles)
    assert found(spark, []) == []


def test_decoding_lists_every_word_above_the_threshold():
    code = embeddings.Code(blocks=3, directions=8, lists=20)
    rotation, codes, threshold = code.build(12)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((20, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x @ rotation
    for got, row in zip(embeddings.decode(x, rotation, codes, threshold), y, strict=True):
        s = [c @ row[b * 4 : b * 4 + 4] for b, c in enumerate(codes)]
        total = s[0][:, None, None] + s[1][None, :, None] + s[2][None, None, :]
        assert got.tolist() == np.flatnonzero(total.ravel() > threshold).tolist()

"""Dual-tree Lloyd against comparing every part with every entry."""

import math
from collections import defaultdict

import numpy as np
import pytest

from tripkit.llm import product_codes, queries
from tripkit.llm.product_codes import LEAF_ROWS, compress_vectors, leaves, nearest_entries, ordered, with_label_error

SF = "/root/testdata/sf0.001"


def brute(vectors, size=256, rounds=4, scale=1024):
    """vectors: (id, list of floats) -> {index: (codes, error)}, codebooks."""
    kept = {i: v for i, (_, v) in enumerate(vectors) if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    width = -(-max(map(len, kept.values())) // 4)
    ints = {i: [math.floor(scale * x) for x in v] + [0] * (4 * width - len(v)) for i, v in kept.items()}
    first = sorted(ints, key=lambda i: (vectors[i][0] is None, vectors[i][0] or 0, ints[i]))[:size]
    rows = list(ints)
    table = np.array([ints[i] for i in rows], object).reshape(len(rows), 4, width)
    books = [np.array([ints[i][p * width : (p + 1) * width] for i in first], object) for p in range(4)]
    found = lambda p: ((table[:, p, None, :] - books[p][None]) ** 2).sum(axis=2)
    for _ in range(rounds):
        for p in range(4):
            chosen = found(p).argmin(axis=1)
            for k in set(chosen.tolist()):
                own = table[chosen == k, p]
                books[p][k] = own.sum(axis=0) // len(own)
    last = [found(p) for p in range(4)]
    codes = [d.argmin(axis=1) for d in last]
    result = {i: ([int(codes[p][n]) for p in range(4)], int(sum(last[p][n].min() for p in range(4)))) for n, i in enumerate(rows)}
    return result, [[list(map(int, e)) for e in b] for b in books]


def plain(points, entries):
    return ((points[:, None, :] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)


@pytest.mark.parametrize("seed", range(12))
def test_walk_of_two_trees(seed):
    rng = np.random.default_rng(seed)
    width, size, rows = int(rng.integers(1, 9)), int(rng.integers(1, 80)), int(rng.integers(1, 900))
    spread = int(rng.choice([1, 3, 40, 5000, 1 << 25]))
    centres = rng.integers(-spread, spread + 1, (5, width)) * 4
    points = centres[rng.integers(0, 5, rows)] + rng.integers(-spread, spread + 1, (rows, width))
    entries = points[rng.integers(0, rows, size)] + rng.integers(0, 2, (size, width))
    order, starts = ordered(points, LEAF_ROWS)
    assert sorted(order) == list(range(rows)) and np.diff(starts).max() <= LEAF_ROWS
    got = nearest_entries(points[order], leaves(points[order], starts), entries)
    want = plain(points[order], entries)
    assert got.entry.tolist() == want.tolist()
    assert got.counts.tolist() == np.bincount(want, minlength=size).tolist()
    sums = np.zeros_like(entries)
    np.add.at(sums, want, points[order])
    assert got.sums.tolist() == sums.tolist()


def test_far_groups_are_assigned_whole():
    rng = np.random.default_rng(3)
    entries = np.arange(64)[:, None] * 10_000 + np.zeros((1, 4), np.int64)
    points = entries[rng.integers(0, 64, 20_000)] + rng.integers(-20, 20, (20_000, 4))
    order, starts = ordered(points, LEAF_ROWS)
    got = nearest_entries(points[order], leaves(points[order], starts), entries)
    assert got.entry.tolist() == plain(points[order], entries).tolist()
    assert got.compared < 0.02 * len(points) * len(entries)


def test_table_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want, books = brute([(r.vec_id, r.embedding) for r in rows])
    got = queries.QUERIES["op12_compress_vectors"](spark, SF)
    assert dict(got.dtypes) == {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
    per_label = defaultdict(int)
    for i, (_, error) in want.items():
        per_label[rows[i].label] += error
    digest = product_codes.codebooks_digest(np.array(books))
    expected = [(rows[i].vec_id, "".join(f"{k:02x}" for k in codes), error, per_label[rows[i].label], digest) for i, (codes, error) in want.items()]
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(product_codes, "BLOCK_ROWS", 37)
    rng = np.random.default_rng(5)
    vectors = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 7)]) for i in range(200)] + [(i, [0.25] * 7) for i in range(200, 260)]
    vectors += [(260, None), (261, [None] * 7), (262, [float("nan")] * 7), (263, [float("-inf")] * 7), (None, [0.5] * 7), (3, [0.125] * 7), (264, []), (265, [0.75] * 3)]
    frame = spark.createDataFrame([(i, v, n % 3 or None, n, "c") for n, (i, v) in enumerate(vectors)], "vec_id long, embedding array<float>, label int, codes int, error string")
    want, books = brute(vectors, size=40, rounds=2)
    done = compress_vectors(spark, frame.withColumnRenamed("codes", "number").repartition(4), ["vec_id", "label", "number"], size=40, rounds=2)
    assert done.codebooks.tolist() == books
    got = done.rows.collect()
    assert {r.number: (r.codes, r.error) for r in got} == want
    labelled = {r.number: r.label_error for r in with_label_error(done.rows).collect()}
    assert all(labelled[n] == sum(e for m, (_, e) in want.items() if m % 3 == n % 3) for n in want)
    assert compress_vectors(spark, frame.limit(0), ["vec_id"]).rows.count() == 0
    few = compress_vectors(spark, frame.filter("vec_id < 3"), ["vec_id"])
    assert few.codebooks.shape[1] == 3 and all(r.error == 0 for r in few.rows.collect())
    twice = compress_vectors(spark, frame.union(frame).select("vec_id", "embedding"), ["vec_id"], size=40, rounds=1).rows
    assert twice.count() == 2 * len(want)
    with pytest.raises(ValueError):
        compress_vectors(spark, spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<float>"), ["vec_id"])

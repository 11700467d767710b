"""Collocations against counting in plain Python."""

import re
from collections import Counter

import numpy as np
import pytest

from tripkit.llm import coded, collocations, queries
from tripkit.llm.collocations import Order, count_runs

SF = "/root/testdata/sf0.001"


def brute(rows, least=10, best=2000):
    """rows: (text, lang) -> sorted (lang, rank, phrase, a, l, r, n, score)."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {g: a for g, a in counts.items() if len(g) > 2 and a >= least}
    inside = Counter()
    for (lang, *w), a in candidates.items():
        if len(w) == 3:
            for pair in (w[:2], w[1:]):
                inside[(lang, *pair)] = max(inside[(lang, *pair)], a)
    found = {}
    for (lang, *w), a in candidates.items():
        if 100 * inside[(lang, *w)] >= 50 * a:
            continue
        cuts = [(counts[(lang, *w[:k])], counts[(lang, *w[k:])]) for k in range(1, len(w))]
        score, _, left, right = min((10**6 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, k + 1, p.decode(), -a, x, y, totals[lang], -s) for lang, own in found.items() for k, (s, a, p, x, y) in enumerate(sorted(own)[:best])
    )


def shrink(monkeypatch):
    """Many batches, buckets, shards and parts for small data."""
    monkeypatch.setattr(collocations, "BATCH_BYTES", 5000)
    monkeypatch.setattr(coded, "SHARD_BYTES", 30_000)
    monkeypatch.setattr(coded, "MAX_BUCKETS", 6)
    monkeypatch.setattr(collocations, "PART_TOKENS", 2000)


@pytest.mark.parametrize("small", [False, True])
def test_the_table(spark, monkeypatch, small):
    if small:
        shrink(monkeypatch)
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.QUERIES["op11_mine_collocations"](spark, SF)
    assert dict(got.dtypes) == {"lang": "string", "phrase": "string"} | dict.fromkeys(["rank", "a", "l", "r", "n", "score"], "bigint")
    want = brute(rows)
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("small", [False, True])
def test_odd_rows(spark, monkeypatch, small):
    if small:
        shrink(monkeypatch)
    rng = np.random.default_rng(4)
    vocabulary = ["a", "b", "A", "x\x01", "x", "é", "É", "日本", "$$", "it's", "a\x1fb", "zz"]
    weights = np.array([30, 8, 8, 3, 3, 3, 3, 3, 3, 2, 2, 1]) / 69
    texts = [" ".join(rng.choice(vocabulary, 300, p=weights)) for _ in range(30)]
    texts += [None, "", " ", ".", "a b", "\t a\t\tb ,c", "a.b;a:b!a?b\na b\ra b\x0ba b\x0ca b", "hot pair " * 20_000, "w" * 50_000, "one\x00two one\x00two " * 30]
    langs = ["en", None, "und", "e n", "de"]
    rows = [(t, langs[i % 5]) for i, t in enumerate(texts)] + [(texts[0], "en")] * 3
    frame = spark.createDataFrame([(t, x, 1, "w") for t, x in rows], "text string, lang string, rank int, word string").repartition(5)
    got = collocations.collocations(spark, frame, best=40).collect()
    assert sorted(map(tuple, got)) == brute(rows, best=40)
    assert sorted(map(tuple, collocations.collocations(spark, frame, least=3, best=7).collect())) == brute(rows, least=3, best=7)
    assert collocations.collocations(spark, frame.limit(0)).count() == 0
    assert collocations.collocations(spark, frame, least=10**9).count() == 0


def test_parts_rise_with_pairs_and_split_hot_words():
    rng = np.random.default_rng(2)
    counts = rng.integers(10, 40, 500)
    counts[100] = 20_000  # most of all words
    ends = np.cumsum(counts)
    parts = 16
    order = Order(np.searchsorted(ends, np.arange(parts * 4) * ends[-1] // (parts * 4), "right").astype(np.uint64) + np.uint64(1), parts)
    pairs = np.array(sorted({(int(a), int(b)) for a, b in rng.integers(1, 501, (40_000, 2))}), np.uint64)
    part = order.part(pairs[:, 0], pairs[:, 1])
    assert (np.diff(part) >= 0).all() and part.max() < parts
    first, last = order.parts_of(pairs[:, 0])
    assert ((first <= part) & (part <= last)).all()
    assert len(set(part[pairs[:, 0] == 101])) > 4


def test_pairs_at_ends_are_counted():
    pairs, thirds, counts = count_runs([np.array([1, 2, 0, 1, 2, 3], np.uint32), np.array([1], np.uint32)])
    assert [(int(p) >> 32, int(p) & 0xFFFFFFFF, int(t), int(c)) for p, t, c in zip(pairs, thirds, counts)] == [(1, 2, 0, 1), (1, 2, 3, 1), (2, 3, 0, 1)]

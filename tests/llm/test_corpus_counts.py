"""Near duplicates and the language model against dictionaries of strings."""

import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripkit.llm import batches, kneser_ney, neardup, queries
from tripkit.llm.common import WORD

SF = "/root/testdata/sf0.001"


@pytest.fixture(params=[None, 3000])
def small(request, monkeypatch):
    """Once with the usual sizes, once with many batches and shards."""
    if request.param:
        monkeypatch.setattr(batches, "BATCH_BYTES", request.param)
        monkeypatch.setattr(batches, "MAX_BUCKETS", 5)  # more batches than buckets
        monkeypatch.setattr(batches, "SHARD_BYTES", 10 * request.param)


def test_packed_arrays_round_trip():
    keys = np.sort(np.random.default_rng(0).integers(0, 2**63, 1000).astype(np.uint64) * 2)
    assert np.array_equal(batches.unpack_keys(batches.pack_keys(keys)), keys)
    assert len(batches.unpack_keys(batches.pack_keys(keys[:0]))) == 0
    counts = np.random.default_rng(0).integers(0, 2**32, (50, 6))
    assert np.array_equal(batches.unpack_counts(batches.pack_counts(counts), 6), counts)


def test_packed_arrays_are_small():
    """Before, a key took 8 bytes and a count 4, all of which went through Spark's memory."""
    keys = np.sort(np.random.default_rng(2).integers(0, 2**40, 4000).astype(np.uint64))
    assert len(batches.pack_keys(keys)) <= 1 + 5 * len(keys)
    counts = 1 + (np.random.default_rng(2).random((4000, 5)) < 0.1).astype(np.int64)
    assert len(batches.pack_counts(counts)) < counts.size
    for some in (counts, counts[:0], counts[:1] * 0, counts * 2**33):
        assert np.array_equal(batches.unpack_counts(batches.pack_counts(some), 5), some)
    for some in (keys, keys[:0], keys[:1] * np.uint64(0)):
        assert np.array_equal(batches.unpack_keys(batches.pack_keys(some)), some)


def test_entries_are_owned_by_the_first_that_counts():
    rows = [([5, 9], [0, 2]), ([5, 7], [3, 0]), ([5, 7, 9], [1, 0, 4])]
    frame = [(batches.pack_keys(np.array(k, np.uint64)), batches.pack_counts(np.array(c)[:, None])) for k, c in rows]
    m = batches.merge_entries(pd.DataFrame(frame, columns=["keys", "counts"]), 1)
    assert m.keys.tolist() == [5, 7, 9] and m.sums[:, 0].tolist() == [4, 0, 6]
    assert m.first.tolist() == [False, True, True, False, False, False, False]


def naive_classes(docs, threshold=0.8, strength=neardup.IDF_STRENGTH):
    """docs: {id: text} -> {id: class id}."""
    sets, frequency = {}, Counter()
    for i, text in docs.items():
        words = re.findall(WORD, text or "")
        grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []
        sets[i] = Counter(grams)
        frequency.update(set(grams))
    n = len(docs)
    weigh = lambda i: {g: c * (1 + strength * math.log(n / frequency[g]) / math.log(n + 1)) for g, c in sets[i].items()}
    weights = {i: weigh(i) for i in docs}
    parent = {i: i for i in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    close = []
    for a, b in combinations(docs, 2):
        shared = weights[a].keys() & weights[b].keys()
        if shared:
            both = sum(min(weights[a][g], weights[b][g]) for g in shared)
            similarity = both / (sum(weights[a].values()) + sum(weights[b].values()) - both)
            if similarity >= threshold:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
            if abs(similarity - threshold) < 1e-6:
                close.append((a, b))
    assert not close
    return {i: find(i) for i in docs}


def variants():
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(160)]
    docs = {}
    for i in range(120):  # a large group of near copies
        words = list(base)
        words[int(rng.integers(0, 160))] = f"x{i}"
        docs[i] = " ".join(words)
    for i in range(120, 160):
        docs[i] = " ".join(base) + "\n" * (i % 3)  # exact copies but for white space
    for i in range(160, 200):  # share a passage only
        docs[i] = " ".join([f"u{i}_{k}" for k in range(100)] + base[:55])
    docs |= {200: None, 201: "", 202: " \n", 203: "two words", 204: "two  words", 205: "one", 206: "z " * 9000, 207: "z " * 9000, 208: "a b c d e", 209: "a b c d e f"}
    docs |= {210 + i: " ".join([f"c{k + 7 * i}" for k in range(200)]) for i in range(5)}  # a chain of shifted texts
    return docs


def test_near_duplicates_of_planted_groups(spark, small):
    docs = variants()
    frame = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs.items()], "doc_id long, text string, row string, batch int, keys string")
    got = neardup.near_duplicates(spark, frame.repartition(3)).collect()
    assert {r.doc_id: r.class_id for r in got} == naive_classes(docs) and len(got) == len(docs)
    kept = Counter(r.class_id for r in got if r.kept)
    assert set(kept) == {r.class_id for r in got} and set(kept.values()) == {1}
    left = neardup.without_near_duplicates(spark, frame)
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({r.class_id for r in got})


@pytest.mark.parametrize("block", [neardup.BLOCK, 3])
def test_links_beyond_the_leader_of_a_bucket(spark, monkeypatch, block):
    """Texts that drift away from one origin, one word at a time: most are similar to their neighbours only."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = np.random.default_rng(11)
    base = [f"w{k}" for k in range(150)]
    docs = {}
    for path in range(6):
        words = list(base)
        for step in range(25):
            words[int(rng.integers(0, 150))] = f"p{path}_{step}"
            docs[len(docs)] = " ".join(words)
    del docs[40], docs[41], docs[42], docs[43]  # a gap cuts the end of one path off
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark, frame).collect()}
    assert got == naive_classes(docs) and len(set(got.values())) > 1


def test_shingles_stay_with_their_batches(spark, small, monkeypatch):
    """Pairs come to the shingles of a row; only those of leaders move. Before, joins shuffled all shingles more than once."""
    plans, real = {}, neardup.saved

    def seen(session, frame, purpose):
        plans[purpose] = frame._jdf.queryExecution().executedPlan().toString()
        return real(session, frame, purpose)

    monkeypatch.setattr(neardup, "saved", seen)
    docs = {i: t for i, t in variants().items() if i > 100}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    got = neardup.near_duplicates(spark, frame).collect()
    assert {r.doc_id: r.class_id for r in got} == naive_classes(docs)
    assert "FlatMapCoGroupsInPandas" in plans["dedup-judged"] and "Join" not in plans["dedup-judged"]
    weights = np.random.default_rng(1).uniform(0, 9, 100).astype(np.float32)
    assert np.array_equal(neardup.unpack_weights(neardup.pack_weights(weights)), weights)


def test_near_duplicates_of_the_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op9_near_duplicates"](spark, SF).collect()
    assert {r.doc_id: r.class_id for r in got} == naive_classes(docs)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    frame = spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, None), (8, None), (8, None)], "doc_id long, text string")
    got = neardup.near_duplicates(spark, frame).collect()
    assert sorted((r.class_id or -1, r.class_size, r.kept) for r in got) == [(-1, 1, True), (7, 3, False), (7, 3, False), (7, 3, True), (8, 1, True), (8, 1, True)]
    assert sorted(str(r.doc_id) for r in neardup.without_near_duplicates(spark, frame).collect()) == ["7", "8", "8", "None"]
    assert neardup.near_duplicates(spark, frame.limit(0)).count() == 0


def test_samples_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 2**60, 400).astype(np.uint64))
    a, b = rng.uniform(0.5, 3, 300), rng.uniform(0.5, 3, 300)
    first = np.array([0, 300, 600])
    s = neardup.weighted_samples(np.concatenate([keys[:300], keys[100:]]), np.concatenate([a, b]), first, 3000)
    want = neardup.weighted_jaccard(keys[:300], a, keys[100:], b)
    assert abs((s[0] == s[1]).mean() - want) < 0.03


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 99), (99, 98)], "a long, b long")
    assert {r.row: r.label for r in neardup.components(spark, links).collect()} == {i: 0 for i in range(61)} | {98: 98, 99: 98, 100: 98}


def naive_model(texts, train):
    """Scores of each text by plain dictionaries."""
    tokens = {i: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(WORD, t or "")] + ["</s>"] for i, t in texts.items()}
    pairs, words = Counter(), Counter()
    for i in train:
        words.update(tokens[i])
        pairs.update(zip(["<s>", *tokens[i][:-1]], tokens[i]))
    history, followers, before = Counter(), defaultdict(Counter), Counter()
    for (v, w), c in pairs.items():
        history[v] += c
        followers[v][min(c, 3)] += 1
        before[w] += 1
    of = lambda counts: kneser_ney.discounts(*(sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)))
    d, e, types, vocabulary, total = of(pairs), of(before), len(pairs), len(words), sum(words.values())
    spread = sum(e[min(c, 3)] for c in before.values()) / types if types else 1.0

    def alone(w):
        return spread / (vocabulary + 1) + (max(before[w] - e[min(before[w], 3)], 0) / types if types else 0)

    def p(v, w):
        if not history[v]:
            return alone(w)
        c = pairs[v, w]
        back = sum(d[k] * followers[v][k] for k in (1, 2, 3)) / history[v]
        return max(c - d[min(c, 3)], 0) / history[v] + back * alone(w)

    if types:
        for v in [*list(history)[:5], "never seen"]:
            assert sum(p(v, w) for w in words) + p(v, "another") == pytest.approx(1)
    return {
        i: (len(t), sum(words[w] > 0 for w in t), total, sum(math.log10((words[w] + 1) / (total + vocabulary + 1)) for w in t),
            sum(math.log10(p(v, w)) for v, w in zip(["<s>", *t[:-1]], t)))
        for i, t in tokens.items()
    }


def check_scores(got, want):
    assert len(got) == len(want)
    for r in got:
        n, known, total, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_scores_of_the_table(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    got = queries.QUERIES["op10_score_language_model"](spark, SF).collect()
    check_scores(got, naive_model(texts, train))
    assert {r.doc_id for r in got if r.held_out} == set(texts) - set(train)
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_scores_of_odd_rows(spark, small):
    texts = {0: None, 1: "", 2: "A a\va B é É", 3: "never seen words", 4: "a " * 20_000, 5: " ", 6: "x" * 100_000, 7: "a a a b b c"}
    frame = spark.createDataFrame([(i, t, 1, "k", "p") for i, t in texts.items()], "doc_id long, text string, batch int, keys string, pair string")
    check_scores(kneser_ney.score_documents(spark, frame.repartition(2), F.col("doc_id") != 3).collect(), naive_model(texts, [i for i in texts if i != 3]))
    check_scores(kneser_ney.score_documents(spark, frame, F.lit(None).cast("boolean")).collect(), naive_model(texts, []))
    assert kneser_ney.score_documents(spark, frame.limit(0), F.lit(True)).count() == 0


def naive_triples(texts, train):
    """Scores of each text by triples, by plain dictionaries."""
    tokens = {i: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(WORD, t or "")] + ["</s>"] for i, t in texts.items()}
    grams = lambda t: list(zip(["<s>", "<s>", *t[:-2]] if len(t) > 1 else ["<s>"], ["<s>", *t[:-1]], t))
    triples = Counter(g for i in train for g in grams(tokens[i]))
    weighed = Counter((v, w) for _, v, w in triples)
    single = Counter(w for _, w in weighed)
    of = lambda counts: kneser_ney.discounts(*(sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)))
    vocabulary, types = len(single), len(weighed)
    levels = []
    for counts in (triples, weighed):
        history, classes = Counter(), defaultdict(Counter)
        for gram, c in counts.items():
            history[gram[:-1]] += c
            classes[gram[:-1]][min(c, 3)] += 1
        levels.append((counts, of(counts), history, classes))
    e = of(single)
    spread = sum(e[min(c, 3)] for c in single.values()) / types if types else 1.0

    def p(gram):
        if len(gram) == 1:
            return spread / (vocabulary + 1) + (max(single[gram[0]] - e[min(single[gram[0]], 3)], 0) / types if types else 0)
        counts, d, history, classes = levels[3 - len(gram)]
        h, c = gram[:-1], counts[gram]
        if not history[h]:
            return p(gram[1:])
        back = sum(d[k] * classes[h][k] for k in (1, 2, 3)) / history[h]
        return max(c - d[min(c, 3)], 0) / history[h] + back * p(gram[1:])

    for h in [*list(levels[0][2])[:5], ("never", "seen")]:
        assert sum(p((*h, w)) for w in single) + p((*h, "another")) == pytest.approx(1)
    return {i: sum(math.log10(p(g)) for g in grams(t)) for i, t in tokens.items()}


def test_triple_scores_of_the_table(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    got = queries.QUERIES["op10_score_language_model"](spark, SF).collect()
    assert {r.doc_id: r.triple_score for r in got} == pytest.approx(naive_triples(texts, train), rel=1e-9)
    assert sum(r.triple_score for r in got if r.held_out) > sum(r.score for r in got if r.held_out)


def test_triple_scores_of_odd_rows(spark, small):
    texts = {0: None, 1: "", 2: "A a\va B é É", 3: "never seen words", 4: "a " * 2_000, 5: " ", 6: "x" * 1_000, 7: "a a a b b c"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for train in ([i for i in texts if i != 3], []):
        got = kneser_ney.score_documents(spark, frame.repartition(2), F.col("doc_id").isin(train), order=3).collect()
        assert {r.doc_id: r.triple_score for r in got} == pytest.approx(naive_triples(texts, train), rel=1e-9)
    with pytest.raises(ValueError):
        kneser_ney.score_documents(spark, frame, F.lit(True), order=1)


def test_documents_are_scored_by_the_answers_of_the_fit(spark, small, monkeypatch):
    """Before, all n-grams were sent to the shards once more to look their counts up."""
    texts = {0: "a b a b c", 1: None, 2: "b c d a b", 3: "a b c, never seen", 4: "B A b a"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    monkeypatch.setattr(kneser_ney, "look_up", None)
    train = [0, 1, 2, 4]
    got = kneser_ney.score_documents(spark, frame, F.col("doc_id").isin(train), order=3).collect()
    check_scores(got, naive_model(texts, train))
    assert {r.doc_id: r.triple_score for r in got} == pytest.approx(naive_triples(texts, train), rel=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_a_stored_model_scores_other_documents(spark, order):
    texts = {0: "a b a b c", 1: None, 2: "b c d a b", 3: "a b c, never seen", 4: "B A b a", 5: ""}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("train", F.lit(True))
    old, new = (batches.save_batched(spark, frame.filter(c), "lm-batches") for c in ("doc_id < 3", "doc_id >= 3"))
    got = kneser_ney.score(spark, new, kneser_ney.fit(spark, old, order=order), ["doc_id"]).collect()
    want = naive_model(texts, [0, 1, 2])
    check_scores(got, {i: want[i] for i in (3, 4, 5)})
    if order > 2:
        assert {r.doc_id: r.triple_score for r in got} == pytest.approx({i: naive_triples(texts, [0, 1, 2])[i] for i in (3, 4, 5)}, rel=1e-9)

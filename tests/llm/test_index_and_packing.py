"""Exact top-k search and packing against plain computation and round trips."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripkit.llm import packing, queries, topk

SF = "/root/testdata/sf0.001"


def brute_top(rows, k=5):
    """rows: (vec_id, vector or None) -> sorted (query_id, rank, vec_id, score)."""
    fit = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in fit:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fit if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def test_top_products_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.QUERIES["op4_top_products"](spark, SF)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert sorted(map(tuple, got.collect())) == brute_top(rows)


def test_top_products_with_odd_rows_ties_and_many_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 3)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 6)]) for i in range(0, 300)]
    rows += [(i, [0.5] * 6) for i in range(300, 400)]  # one very common vector
    rows += [(400, None), (450, [1.0, None]), (500, [float("nan")] * 6), (550, [float("inf")] * 6), (None, [0.1] * 6), (600, []), (650, [0.3]), (-50, [1.0] * 6)]
    frame = spark.createDataFrame([(i, v, 1, "r", "a") for i, v in rows], "vec_id long, embedding array<float>, label int, row string, asked string")
    query = F.pmod("vec_id", F.lit(50)) == 0
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted(map(tuple, topk.top_products(spark, frame, query).collect())) == brute_top(rows)
    assert topk.top_products(spark, frame.limit(0), query).count() == 0
    assert topk.top_products(spark, frame.filter("vec_id = 300"), query).count() == 0
    doubled = topk.top_products(spark, frame.union(frame), query).collect()
    assert len(doubled) == 5 * 2 * len({q for q, *_ in brute_top(rows)})


def test_scoring_ends_early_but_exactly():
    rng = np.random.default_rng(2)
    matrix = rng.integers(-20, 20, (900, 16))
    matrix[:40] *= 10
    queries_ = rng.integers(-100, 100, (30, 16))
    a, b, score = topk.score_shard(np.arange(900), matrix, np.arange(10_000, 10_030), queries_, 5)
    for q in range(30):
        exact = matrix @ queries_[q]
        want = sorted(range(900), key=lambda i: (-exact[i], i))[:5]
        assert list(b[a == q]) == want and list(score[a == q]) == [exact[i] for i in want]


def ids_of(texts):
    from tokenizers import Tokenizer

    encoded = Tokenizer.from_file(packing.public_tokenizer()).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, 1], "<u4") for e in encoded]


TEXTS = [
    "", None, "a  b", " lead", "tail ", "a \n b c", "it's we'll 12 345", "<|endoftext|> x <|endoftext|>y", "\x1c \x1d a", "é 日本 ß", "x" * 5000,
    "one two\nthree\n\nfour \tfive", "a  b", "word " * 30_000, "\n", "a <|endoftext|>", " ",
]


def test_remembered_words_give_the_same_ids(spark):
    tokens = packing.Tokens(packing.public_tokenizer())
    real = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    for texts in (TEXTS, real, TEXTS):
        assert [e + np.array([1], "<u4").tobytes() for e in tokens.encode([t or "" for t in texts])] == [i.tobytes() for i in ids_of(texts)]


def check_packing(pieces, texts):
    """``texts`` by document id; pieces must hold each id once and fill each sequence without gaps."""
    whole = {d: ids for d, ids in zip(texts, ids_of(texts.values()))}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        ids = whole[p.doc_id][p.start : p.start + p.length]
        assert p.length == len(ids) > 0 and zlib.crc32(ids.tobytes()) == p.ids_crc32 and p.doc_tokens == len(whole[p.doc_id])
    assert set(by_doc) == set(texts)
    for d, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == len(whole[d])
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == own[0].context <= 2048 and at & (at - 1) == 0
    groups = defaultdict(int)
    for own in by_sequence.values():
        groups[own[0].step_group] += own[0].context
    return groups


def test_packing_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = queries.QUERIES["op7_pack_documents"](spark, SF).collect()
    groups = check_packing(pieces, {r.doc_id: r.text for r in docs.collect()})
    assert max(groups.values()) - min(groups.values()) <= 6 * 2048
    check_tiers(pieces)


def check_tiers(pieces):
    """Each tier has windows of its own size, with ids of documents of that tier only; opened windows are closed by shorter ones."""
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
    contexts = Counter(own[0].context for own in by_sequence.values())
    assert all(contexts[size] > 1 for size in (2048, *packing.TIERS))
    tail = set()
    for size in sorted(contexts):  # less than a window of each tier is left: one sequence of each power of two
        tail.add(max(s for s, own in by_sequence.items() if own[0].context == size))
    halves = {p.doc_id for p in pieces if p.offset == 0 and p.length == 1024 and p.context == 1024}
    for s, own in by_sequence.items():
        size = own[0].context
        if size == 2048 and len(own) > 1:
            lead = next(p for p in own if p.offset == 0)
            assert lead.length > 1024 and all(p.doc_tokens % 2048 <= 1024 or p.doc_id in halves for p in own if p is not lead)
        elif size < 2048 and s not in tail and not (size == 1024 and len(own) == 1):
            for p in own:
                rest = p.doc_tokens % 2048
                rest -= 1024 * (rest > 1024)
                upper = -(-rest // 32) * 32 if p.doc_tokens % 2048 > 1024 else rest
                assert min(t for t in packing.TIERS if t >= upper) == size


def test_tiers_share_the_ids():
    random = np.random.default_rng(3)
    for trial in range(200):
        total = {c: tuple(int(x) for x in random.integers(0, 10 ** (trial % 6) + 1, 3)) for c in range(-1, packing.CLASSES + 3) if random.random() < 0.7}
        layout = packing.lay_out_tiers(total)
        opened = set(layout.classes[layout.classes["opened"]]["class"])
        ids = sum(v[2] for c, v in total.items() if c >= 0 and c not in opened)
        assert layout.gaps == sum(v[1] for c, v in total.items() if c in opened) <= packing.GAP_SHARE * ids
        ends = [r.begin for r in layout.runs[1:]] + [ids]
        at, sequence = layout.gaps, sum(v[0] for c, v in total.items() if c < packing.CLASSES)
        for run, end in zip(layout.runs, ends):
            assert run.begin == at and (end - at) % run.size == 0 and run.sequence >= sequence
            at = end
        assert at == (ids if layout.runs else layout.gaps)


@pytest.mark.parametrize("block", [1 << 17, 700])
def test_packing_of_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(packing, "_BLOCK", block)
    long = ["ab " * n for n in (600, 700, 1000, 1023, 1024, 1365, 90, 40, 5, 2047, 300)]
    texts = dict(enumerate(TEXTS + long))
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in texts.items()], "doc_id long, text string, kind string, part int, class int")
    check_packing(packing.pack_documents(spark, frame.repartition(3), packing.public_tokenizer()).collect(), texts)
    only_long = {i: "ab " * 900 for i in range(7)}
    frame = spark.createDataFrame(list(only_long.items()), "doc_id long, text string")
    check_packing(packing.pack_documents(spark, frame, packing.public_tokenizer()).collect(), only_long)
    empties = {i: None for i in range(3000)}
    frame = spark.createDataFrame(list(empties.items()), "doc_id long, text string")
    check_packing(packing.pack_documents(spark, frame, packing.public_tokenizer()).collect(), empties)
    assert packing.pack_documents(spark, frame.limit(0), packing.public_tokenizer()).count() == 0

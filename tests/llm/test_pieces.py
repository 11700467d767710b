"""Encoding with a table of distinct marked words against the library on whole texts."""

import hashlib

import pytest
import sentencepiece

from tripkit.llm import coded, pieces, queries

SF = "/root/testdata/sf0.001"
TEXTS = [
    "", None, " ", "  ", "a", " a", "a ", "a  b", "a b " * 40, "\n", "\n \n", "tab\tand\x0bmore", "▁", "a▁b ▁ c", "<s> x </s> <0x41> <unk>", "é 日本 ß 𝒳   　",
    "x" * 70_000, " " * 5000, "日本語" * 4000, "one two three " * 20_000, "a  b", "\x00 null \x00", "don't re-join 12,345.67 words",
]


def digest(ids, text):
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def library(texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.public_model())
    return [(ids, sp.decode(ids)) for ids in (sp.encode(t or "") for t in texts)]


def test_the_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op13_encode_pieces"](spark, SF)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    want = [(r.doc_id, *digest(*x)) for r, x in zip(rows, library(r.text for r in rows))]
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("batch", [16 << 20, 3000])
def test_odd_rows(spark, monkeypatch, batch):
    monkeypatch.setattr(coded, "BATCH_BYTES", batch)
    monkeypatch.setattr(coded, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(coded, "MAX_BUCKETS", 5)  # more batches than buckets
    frame = spark.createDataFrame(
        [(None if i == 3 else i + (1 << 60), t, "r", None, "i", [i]) for i, t in enumerate(TEXTS)], "doc_id long, text string, batch string, shard int, ids string, c0 array<int>"
    )
    got = pieces.encode_documents(spark, frame.repartition(3), pieces.public_model(), ["doc_id", "c0", "batch"]).collect()
    want = library(TEXTS)
    assert len(got) == len(TEXTS)
    for row in got:
        i = row.c0[0]
        assert row.doc_id == (None if i == 3 else i + (1 << 60)) and row.batch == "r"
        assert (row.ids, row.decoded) == want[i]
    assert pieces.encode_documents(spark, frame.limit(0), pieces.public_model()).count() == 0
    assert pieces.encode_documents(spark, frame.union(frame), pieces.public_model()).count() == 2 * len(TEXTS)


def test_each_word_is_segmented_once(monkeypatch):
    import pandas as pd

    asked = []
    real = pieces.segment
    monkeypatch.setattr(pieces, "segment", lambda words, model: asked.append(words) or real(words, model))
    rows = pd.DataFrame({"batch": [1, 2], "shard": [0, 0], "tokens": [coded.pack_tokens([b" a", b" b"]), coded.pack_tokens([b" b", b" c"])]})
    pieces._answer_shard(rows, pieces.public_model())
    assert asked == [[b" a", b" b", b" c"]]


def test_models_that_cross_marks_are_refused(monkeypatch):
    class Crossing:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "▁a▁b"

    monkeypatch.setattr(pieces, "processor", lambda path: Crossing())
    with pytest.raises(ValueError):
        pieces.check_model("some.model")

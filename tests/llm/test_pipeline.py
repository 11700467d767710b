"""The pipeline's stages on their own inputs, and its result against the stages applied by plain Python."""

import re
from collections import Counter

import pandas as pd
import pytest

import corpus_pipeline
from test_corpus_counts import naive_classes
from test_index_and_packing import check_packing
from tripkit.llm import secret_scan
from tripkit.llm.common import WORD

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage."""
    at, out = str(tmp_path_factory.mktemp("stages")), []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out.append(docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
        out.append(docs.collect())
        assert name == "packing" or docs.columns == COLUMNS
    return out


def test_language_keeps_texts_with_letters(stages):
    before, after = stages[:2]
    assert sorted(after) == sorted(r for r in before if re.search(r"[^\W\d_]", r.text or ""))


@pytest.mark.parametrize("number", [0, 1, 2, 4])
def test_stages_send_texts_to_workers_in_small_batches(spark, number):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 6000, 1, 1).selectExpr("id AS doc_id", "repeat('text ', 800) AS text", "'en' AS lang", "'a' AS source", "4000 AS n_chars")
    corpus_pipeline.STAGES[number][1](spark, docs.limit(3), SF)
    sizes = docs.select("text").mapInPandas(lambda frames: (pd.DataFrame({"n": [f["text"].str.len().sum()]}) for f in frames), "n long").collect()
    assert sum(r.n for r in sizes) == 24_000_000 and max(r.n for r in sizes) < 5 << 20


def test_language_keeps_labelled_clean_texts_however_short(spark):
    """And still drops a longer text of an alphabet that no learned language has."""
    at = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{at}/documents.parquet").filter(r"text RLIKE '\\p{L}'")
    clean = spark.read.parquet(f"{at}/labels.parquet").filter("quality = 1 AND toxic = 0")
    foreign = "это длинный текст на русском языке о том как люди живут в большом городе и каждый день ездят на работу " * 3
    added = spark.createDataFrame([(-1, foreign, None, "x", len(foreign))], docs.select(*COLUMNS).schema)
    kept = corpus_pipeline.identify_language(spark, docs.select(*COLUMNS).unionByName(added), at)
    lost = docs.join(clean, "doc_id", "left_semi").join(kept, "doc_id", "left_anti")
    assert [r.text for r in lost.collect()] == []
    assert kept.filter("doc_id = -1").count() == 0 and kept.count() == docs.count()


def test_one_document_of_each_group_stays(stages):
    before, after = stages[1:3]
    assert sorted(r.doc_id for r in after) == sorted(set(naive_classes({r.doc_id: r.text for r in before}).values()))
    assert set(after) <= set(before)


def test_secrets_are_replaced_and_rows_stay(stages):
    before, after = stages[2:4]
    assert {r.doc_id: (r.text, r.n_chars) for r in after} == {
        r.doc_id: (t := secret_scan.redact(r.text), len(t)) for r in before
    }
    assert not any(secret_scan.base_spans(r.text) for r in after)
    assert len(before) == len(after)


def test_sources_come_near_their_targets(stages):
    before, after = stages[3:5]
    words = lambda t: len(re.findall(WORD, t))
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += words(r.text)
    for r in after:
        taken[r.source] += words(r.text)
        assert r.n_chars == len(r.text)
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= len(sizes) or any(taken[s] == 2 * sizes[s] for s in sizes)
    assert all(taken[s] <= 2 * sizes[s] for s in sizes)
    whole = {r.doc_id: r.text.split() for r in before}
    assert all(" ".join(r.text.split()) in " ".join(whole[r.doc_id]) for r in after)


def test_packing_holds_every_text(spark, stages):
    before, pieces = stages[4:6]
    texts = {}
    for r in before:
        texts.setdefault(r.doc_id, []).append(r.text)
    single = {d for d, t in texts.items() if len(t) == 1}
    assert {p.doc_id for p in pieces} == set(texts)
    tokens = Counter()
    for p in pieces:
        tokens[p.sequence_id] += p.length
    assert all(n & (n - 1) == 0 and n <= 2048 for n in tokens.values())
    assert single and sum(p.length for p in pieces if p.doc_id in single) == sum(
        {p.doc_id: p.doc_tokens for p in pieces if p.doc_id in single}.values()
    )


def test_run_gives_the_same_rows(spark, stages):
    rows = lambda found: sorted((p.doc_id, p.start, p.length, p.ids_crc32) for p in found)
    got = corpus_pipeline.run(spark, SF).collect()
    assert sum(p.length for p in got) == sum(p.length for p in stages[5])
    assert {(d, c) for d, _, _, c in rows(got)} and {p.doc_id for p in got} == {p.doc_id for p in stages[5]}


def test_odd_documents(spark, tmp_path):
    rows = [(1, None, None, None, None, "k"), (2, "", "en", "a", 0, "k"), (3, "one two three four five six", "en", "a", 27, "k"),
            (3, "one two three four five six", "en", "a", 27, "k"), (None, "uno dos", "es", None, 7, "k"), (5, "12 34", "en", "b", 5, "k")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_key string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} <= {3, None}
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_packing_check_finds_faults(spark):
    with pytest.raises(AssertionError):
        check_packing([], {1: "a"})

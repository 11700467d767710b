"""Encode and decode with a SentencePiece model whose pieces never cross a white-space mark.

Where every piece has its marks in front, a text is a sequence of marked words (blanks and what follows them) that are segmented
apart from each other. Each distinct marked word of the corpus is then segmented once, in the shard where all
batches ask for it, and its ids are put at the places of its occurrences.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tripkit.llm.coded import code_texts, pack_numbers, unpack_numbers, unpack_tokens

MARK = "▁"
_MARKED = re.compile(rb" +[^ ]*")
_ANSWERS = "batch long, shard int, lengths binary, ids binary"
_CHUNK = 4 << 20  # bytes of text that an output frame holds, or one longer text


def public_model() -> str:
    """Path of the model that is installed beside the libraries."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(2)
def processor(path: str):
    """The library's processor, once per Python worker."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_model(path: str) -> None:
    """Raise unless marked words of this model are independent: no piece goes on into the next mark, no text is rewritten.

    A few texts tell how the model treats blanks; one that strips, joins or does not put one in front can't be cut this way.
    """
    sp = processor(path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("pieces of this model cross white-space marks")
    probes = ["a", " a", "a  b ", "  ", " a　b", "ﬁ ½ é", "a\tb\n"]
    if sp.encode("") or any(sp.decode(sp.encode(p)) != p for p in probes):
        raise ValueError("this model rewrites texts before it segments them")


def marked_words(text: bytes) -> list[bytes]:
    """The text behind the blank that the library puts in front, cut before each run of blanks; a mark in it counts as a blank."""
    return _MARKED.findall(b" " + text.replace(MARK.encode(), b" ")) if text else []


def segment(words: list[bytes], model: str) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each marked word, and all ids in a row."""
    sp = processor(model)
    ids = sp.encode([w[1:].decode() for w in words], num_threads=1)  # the library puts the first blank back
    if b" " in words:  # it puts none before an empty text: take the ids of a last blank
        ids[words.index(b" ")] = sp.encode("a ")[len(sp.encode("a")) :]
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    return lengths, np.fromiter((x for one in ids for x in one), np.uint32, int(lengths.sum()))


def _answer_shard(asked: pd.DataFrame, model: str) -> pd.DataFrame:
    """Segment the distinct words of a shard, each once, and answer each batch in the order it asked."""
    parts = [unpack_tokens(t) for t in asked["tokens"]]
    table: dict[bytes, int] = {}
    places = [np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, len(words)) for words in parts]
    lengths, ids = segment(list(table), model)
    ends = np.cumsum(lengths)
    rows = []
    for batch, shard, place in zip(asked["batch"], asked["shard"], places):
        own = lengths[place]
        rows.append((batch, shard, pack_numbers(own), pack_numbers(_gather(ids, ends[place] - own, own))))
    return pd.DataFrame(rows, columns=["batch", "shard", "lengths", "ids"])


def _gather(values: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``values`` at ``begins``, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(begins - ends + lengths, lengths) + np.arange(total)]


def encode_documents(spark: SparkSession, docs: DataFrame, model: str, columns: list[str] = ("doc_id",)) -> DataFrame:
    """``columns`` of each document with ``ids`` (array<int>, as the library encodes the whole text) and ``decoded`` (string, what
    the library decodes from them).

    A null text is an empty one, which has no ids and decodes to "". Texts of any length are cut at blanks only; a text
    without a blank is one word of the table. Repeated rows are encoded each; ``docs`` may have any other columns, also ones
    named as those of the result as long as ``columns`` leaves them out. A shard of the table holds the words of a
    bounded amount of text, and a batch takes back the ids of its own words only.
    """
    check_model(model)
    columns = list(columns)
    renamed = {c: f"c{i}" for i, c in enumerate(columns)}
    carried = docs.select(F.col("text"), *(F.col(c).alias(r) for c, r in renamed.items()))
    coded = code_texts(spark, carried, marked_words, "marked-words", list(renamed.values()))
    answers = coded.entries.select("batch", "shard", "tokens").groupBy("shard").applyInPandas(lambda asked: _answer_shard(asked, model), _ANSWERS)
    kinds = ", ".join(f"{r} {carried.schema[r].dataType.simpleString()}" for r in renamed.values())

    result = pa.schema([*to_arrow_schema(carried.select(*renamed.values()).schema), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def join_back(streams: pa.Table, answers: pa.Table) -> pa.Table:
        got = sorted(zip(*(answers.column(c).to_pylist() for c in ("shard", "lengths", "ids"))))
        lengths = np.concatenate([np.zeros(1, np.int64), *(unpack_numbers(n).astype(np.int64) for _, n, _ in got)])
        ids = np.concatenate([np.zeros(0, np.int32), *(unpack_numbers(i).astype(np.int32) for *_, i in got)])
        begins = np.cumsum(lengths) - lengths
        sp, out = processor(model), []
        for frame in streams.to_batches():
            along, held, at, size = [frame.column(r) for r in renamed.values()], [], 0, 0
            for k in range(frame.num_rows):
                codes = unpack_numbers(frame.column("codes")[k].as_py()).astype(np.int64)
                own = _gather(ids, begins[codes], lengths[codes])
                held.append((own, sp.decode(own.tolist())))
                size += 8 * len(own)
                if size > _CHUNK or k + 1 == frame.num_rows:
                    arrays = [a.slice(at, len(held)) for a in along]
                    flat = np.concatenate([h[0] for h in held])
                    offsets = np.concatenate([[0], np.cumsum([len(h[0]) for h in held])]).astype(np.int32)
                    arrays += [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())), pa.array([h[1] for h in held], pa.string())]
                    out.append(pa.RecordBatch.from_arrays(arrays, [*renamed.values(), "ids", "decoded"]))
                    at, held, size = k + 1, [], 0
        return pa.Table.from_batches(out, result)

    joined = coded.streams.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        join_back, ", ".join([*([kinds] if kinds else []), "ids array<int>, decoded string"])
    )
    return joined.select(*(F.col(r).alias(c) for c, r in renamed.items()), "ids", "decoded")

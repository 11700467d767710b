"""Texts as streams of codes with a dictionary per batch; dictionary entries of all batches meet in shards.

A batch of documents replaces its tokens by codes and sends each shard the distinct tokens that belong there, in byte order. A
shard sees a token once per batch, answers in the order it was asked, and the answers come back to the batch, whose
codes are the places of the answers: position, not a key, joins them. Tokens are compared as bytes, never by a hash alone.
Codes are bucketed by batch, so they do not move again.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.session import shared_dir

BATCH_BYTES = 16 << 20  # text of a batch
SHARD_BYTES = 32 << 20  # text whose distinct tokens a shard answers
MAX_BUCKETS = 50_000  # several batches share a bucket beyond it
BREAK = 0  # the code between two runs of tokens


class Coded(NamedTuple):
    """``streams`` (``batch``, carried columns, ``space``, ``codes``), ``entries`` (``batch``, ``shard``, ``tokens``, ``counts``)."""

    streams: DataFrame
    entries: DataFrame
    shards: int


def pack_numbers(values: np.ndarray) -> bytes:
    """Integers from 0 below 2 ** 64, as few byte planes as the largest needs, compressed; the first byte tells how many."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zlib.compress(planes.tobytes(), 1)


def unpack_numbers(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(width, -1)
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, :width] = planes.T
    return whole.view("<u8").ravel()


def pack_tokens(tokens: list[bytes]) -> bytes:
    lengths = pack_numbers(np.fromiter(map(len, tokens), np.uint64, len(tokens)))
    return len(lengths).to_bytes(4, "little") + lengths + zlib.compress(b"".join(tokens), 1)


def unpack_tokens(data: bytes) -> list[bytes]:
    end = 4 + int.from_bytes(data[:4], "little")
    ends = np.cumsum(unpack_numbers(data[4:end])).tolist()
    joined = zlib.decompress(data[end:])
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


class _Batch:
    """Dictionaries and code streams of the batch being read."""

    def __init__(self, gap: bytes):
        self.size, self.known, self.streams, self.gap = 0, {}, [], gap

    def add(self, space: str, tokens: list) -> None:
        known = self.known.get(space)
        if known is None:
            known = self.known[space] = defaultdict()
            known.default_factory = known.__len__
            known[self.gap]  # takes the code of a break
        self.streams.append((space, np.fromiter(map(known.__getitem__, tokens), np.uint32, len(tokens))))

    def close(self, shards: int, joined: bool, counted: bool) -> tuple[list[tuple], list[tuple]]:
        """Entries (shard, tokens, counts) and streams (space, codes), whose codes number the entries from 1."""
        keys, spaces = [], {}
        for space, known in self.known.items():
            spaces[space] = len(keys)
            end = b" " + space.encode() if joined else b""
            keys += [w + end for w in known if w != self.gap]
        hashes = pd.util.hash_array(np.array(keys, object)) if keys else np.zeros(0, np.uint64)
        shard = (hashes % np.uint64(shards)).astype(np.int64)
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        order = order[np.argsort(shard[order], kind="stable")]
        codes = np.empty(len(keys), np.uint32)
        codes[order] = np.arange(1, len(keys) + 1, dtype=np.uint32)
        tables = {s: np.concatenate([[BREAK], codes[a : a + len(self.known[s]) - 1]]).astype(np.uint32) for s, a in spaces.items()}
        streams = [(s, tables[s][local]) for s, local in self.streams]
        if joined:
            apart = np.array([BREAK], np.uint32)
            streams = [(s, np.concatenate([x for t, c in streams if t == s for x in (c, apart)])) for s in spaces]
        counts = np.zeros(len(keys) + 1, np.int64)
        if counted:
            counts = sum((np.bincount(c, minlength=len(counts)) for _, c in streams), counts)
        entries = []
        cuts = [0, *(np.flatnonzero(np.diff(shard[order])) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                own = pack_tokens([keys[k] for k in order[a:b].tolist()])
                entries.append((int(shard[order[a]]), own, pack_numbers(counts[a + 1 : b + 1]) if counted else None))
        return entries, [(s, pack_numbers(c)) for s, c in streams]


def code_texts(
    spark: SparkSession, docs: DataFrame, tokens_of: Callable[[bytes], list], purpose: str, carried: list[str] = (), space: str | None = None,
    counted: bool = False, gap: bytes = b"", batch_bytes: int | None = None,
) -> Coded:
    """Saved codes of the ``text`` of ``docs`` (null: empty): a row per document, or per batch and value of ``space`` if that is given.

    ``tokens_of`` cuts UTF-8 text into tokens; ``gap`` is the one that stands for a break. ``carried`` columns go along with the documents. With ``space`` (never
    null), texts of a batch that share its value make one stream with breaks between them, and the value is part of each
    entry: ``token + b" " + value``. ``counted`` adds to the entries how often each occurs in the batch.
    Smaller batches take less memory of a task and repeat more tokens in their dictionaries.
    """
    limit = batch_bytes or BATCH_BYTES
    size, rows = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    shards = max(1, -(-(size + rows) // SHARD_BYTES))
    buckets = min(MAX_BUCKETS, max(1, -(-(size + rows) // limit)))
    wanted = docs.select(F.col("text").cast("binary").alias("__text"), (F.col(space) if space else F.lit("")).alias("space"), *carried)
    extra = [f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema[2:]] if carried else []
    schema = ", ".join(["batch long, shard int, tokens binary, counts binary, space string, codes binary", *extra])
    own = ["batch", "shard", "tokens", "counts", "space", "codes"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.binary()]

    def run(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, batch, slices = TaskContext.get().partitionId() << 33, _Batch(gap), []
        others: list[pa.Field] = []

        def rows_of(columns: list[list], along: list[pa.Array]) -> pa.RecordBatch:
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)] + along
            return pa.RecordBatch.from_arrays(arrays, own + [f.name for f in others])

        def closed() -> Iterator[pa.RecordBatch]:
            entries, streams = batch.close(shards, space is not None, counted)
            for shard, tokens, counts in entries:
                yield rows_of([[number], [shard], [tokens], [counts], [None], [None]], [pa.nulls(1, f.type) for f in others])
            along = pa.Table.from_batches(slices).combine_chunks() if others and slices else None
            step = 1 if space else 256
            for at in range(0, len(streams), step):
                part = streams[at : at + step]
                n = len(part)
                none = [None] * n
                arrays = [pa.concat_arrays(along.column(f.name).slice(at, n).chunks) for f in others] if along is not None else []
                yield rows_of([[number] * n, none, none, none, [s for s, _ in part], [c for _, c in part]], arrays)

        for frame in frames:
            others = [f for f in frame.schema if f.name not in ("__text", "space")]
            texts, spaces, begun = frame.column("__text"), frame.column("space"), 0
            for i in range(frame.num_rows):
                text = texts[i].as_py() or b""
                batch.add(spaces[i].as_py(), tokens_of(text))
                batch.size += len(text) + 1
                if batch.size >= limit or i + 1 == frame.num_rows:
                    slices.append(frame.select([f.name for f in others]).slice(begun, i + 1 - begun))
                    begun = i + 1
                if batch.size >= limit:
                    yield from closed()
                    number, batch, slices = number + 1, _Batch(gap), []
        if batch.streams:
            yield from closed()

    name = f"{purpose.replace('-', '_')}_{uuid.uuid4().hex}"
    table = wanted.mapInArrow(run, schema).write.bucketBy(buckets, "batch").option("compression", "zstd")
    table.option("path", shared_dir(spark, purpose)).saveAsTable(name)
    saved = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files of an external table stay
    streams = saved.filter(F.col("codes").isNotNull()).drop("shard", "tokens", "counts")
    entries = saved.filter(F.col("tokens").isNotNull()).select("batch", "shard", "tokens", "counts")
    return Coded(streams, entries, shards)

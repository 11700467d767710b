"""Batches of documents, and look-ups of their hashed keys in shards: rows hold packed arrays instead of single keys.

A table of batches is bucketed, so that answers come to the batches and the texts never move. Keys are sorted
hashes of ``bits`` bits; shard ``i`` of ``n`` holds the ``i``-th part of their range. A batch sends each shard its distinct keys
once, however often they occur, so a frequent key costs one entry per batch. Answers come back in the order of the keys.
"""

from __future__ import annotations

import tempfile
import time
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.session import shared_dir

BATCH_BYTES, SHARD_BYTES = 4 << 20, 8 << 20
MAX_BUCKETS = 50_000  # several batches share a bucket beyond it: Spark takes no more than 100,000
SPARE_BITS = 18  # a key shares its hash with another of the corpus with a chance below 2 ** -SPARE_BITS
ANSWERS = "batch long, shard int, answers binary"


class Batched(NamedTuple):
    """Documents by batch, the width of keys and the numbers of shards and buckets that suit their size."""

    docs: DataFrame
    bits: int
    shards: int
    rows: int
    buckets: int


def _pack_planes(values: np.ndarray) -> tuple[int, bytes]:
    """The byte planes of integers that are not all zero, one at least, lowest first: their number and the planes."""
    used = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    whole = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)
    return used, np.ascontiguousarray(whole[:, :used].T).tobytes()


def _unpack_planes(data: bytes, used: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(used, -1)
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, :used] = planes.T
    return whole.view("<u8").ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Rising 64-bit integers as differences, byte plane by byte plane."""
    used, planes = _pack_planes(np.diff(keys, prepend=np.zeros(1, np.uint64)))
    return bytes([used]) + planes


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack_planes(memoryview(data)[1:], data[0]), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """A matrix of counts, one row per key, byte plane by byte plane of each column: most are small, so they are entropy-coded."""
    packed = [_pack_planes(counts[:, c]) for c in range(counts.shape[1])]
    coder = zlib.compressobj(1, strategy=zlib.Z_RLE)
    return coder.compress(b"".join([bytes([used for used, _ in packed]), *(planes for _, planes in packed)])) + coder.flush()


def unpack_counts(data: bytes, columns: int) -> np.ndarray:
    data = zlib.decompress(data)
    ends = np.cumsum([0, *data[:columns]]).tolist()
    n = (len(data) - columns) // ends[-1]
    out = np.empty((n, columns), np.int64)
    for c, (a, b) in enumerate(zip(ends, ends[1:])):
        out[:, c] = _unpack_planes(memoryview(data)[columns + a * n : columns + b * n], b - a)
    return out


def collected(spark: SparkSession) -> None:
    """Ask the driver's JVM to collect garbage, so that Spark removes the shuffle files of finished jobs.

    The end of a job reaches Spark's listeners a little later; until then they hold its plan, so a second try follows.
    """
    for pause in (0.0, 0.5):
        time.sleep(pause)
        spark.sparkContext._jvm.System.gc()


def save_bucketed(spark: SparkSession, frame: DataFrame, buckets: int, purpose: str) -> DataFrame:
    """``frame`` (with ``batch``) bucketed by batch on shared storage: groups of batches are read without a shuffle."""
    name = f"{purpose.replace('-', '_')}_{uuid.uuid4().hex}"
    frame.write.bucketBy(buckets, "batch").option("path", shared_dir(spark, purpose)).saveAsTable(name)
    return spark.table(name)


def save_batched(spark: SparkSession, docs: DataFrame, purpose: str) -> Batched:
    """``docs`` (``text`` and whatever is to be carried along) with ``row`` and ``batch``, bucketed by batch, on shared storage.

    Consecutive rows of an input partition form a batch of about BATCH_BYTES; a longer text is a batch of its own.
    """
    rows, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    carried = docs.withColumn("text", F.col("text").cast("binary")).withColumn("row", F.monotonically_increasing_id())

    def number(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, base = 0, TaskContext.get().partitionId() << 33
        for frame in frames:
            sizes = np.fromiter((1 if t is None else len(t) + 1 for t in frame["text"]), np.int64, len(frame))
            ends = np.cumsum(sizes) + at
            yield frame.assign(batch=base + (ends - 1) // BATCH_BYTES)
            at = int(ends[-1]) if len(ends) else at

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema)
    buckets = int(min(MAX_BUCKETS, max(1, -(-(size + rows) // BATCH_BYTES))))
    saved = save_bucketed(spark, carried.mapInPandas(number, f"{fields}, batch long"), buckets, purpose)
    bits = min(64, max(32, int(size + rows).bit_length() + SPARE_BITS))
    return Batched(saved, bits, int(max(1, -(-(size + rows) // SHARD_BYTES))), rows, buckets)


def to_shards(batch: int, keys: np.ndarray, counts: np.ndarray | None, bits: int, shards: int) -> pd.DataFrame:
    """A row per shard with the batch's keys (rising, distinct) and their counts."""
    bounds = [(i << bits) // shards for i in range(shards + 1)]
    cuts = np.searchsorted(keys, np.array(bounds[:-1], np.uint64)).tolist() + [len(keys)]
    rows = [
        (i, batch, pack_keys(keys[a:b]), b"" if counts is None else pack_counts(counts[a:b]))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a
    ]
    return pd.DataFrame(rows, columns=["shard", "batch", "keys", "counts"])


SHARDED = "shard int, batch long, keys binary, counts binary"


class Merged(NamedTuple):
    """Entries of all batches of a shard: distinct keys, their summed counts, and each entry's place among them."""

    keys: np.ndarray
    sums: np.ndarray
    place: np.ndarray
    first: np.ndarray
    sizes: list[int]
    counts: np.ndarray


def merge_entries(frame: pd.DataFrame, columns: int) -> Merged:
    parts = [unpack_keys(k) for k in frame["keys"]]
    counts = np.concatenate([unpack_counts(c, columns) for c in frame["counts"]])
    keys, place = np.unique(np.concatenate(parts), return_inverse=True)
    sums = np.stack([np.bincount(place, counts[:, c], len(keys)) for c in range(columns)], axis=1).astype(np.int64)
    # The first entry of each key that counts something owns it.
    counting = np.flatnonzero(counts[:, 0] > 0)[::-1]
    owner = np.full(len(keys), -1)
    owner[place[counting]] = counting  # the last one set stays
    first = np.zeros(len(place), bool)
    first[owner[owner >= 0]] = True
    return Merged(keys, sums, place, first, [len(p) for p in parts], counts)


def answer_rows(frame: pd.DataFrame, answers: np.ndarray, sizes: list[int]) -> pd.DataFrame:
    """Answers to the entries of a shard, given in their order, as a row per batch."""
    cuts = np.cumsum([0, *sizes])
    packed = [pack_counts(answers[a:b]) for a, b in zip(cuts, cuts[1:])]
    return pd.DataFrame({"batch": frame["batch"].to_numpy(), "shard": frame["shard"].to_numpy(), "answers": packed})


def answers_of(frame: pd.DataFrame, columns: int) -> np.ndarray:
    """A batch's answers, in the order of its keys."""
    if not len(frame):
        return np.zeros((0, columns), np.int64)
    return np.concatenate([unpack_counts(a, columns) for a in frame.sort_values("shard")["answers"]])


def look_up(asked: DataFrame, model: DataFrame, columns: int) -> DataFrame:
    """Counts that ``model`` (``shard``, ``keys``, ``counts``) stores for the asked keys; zeros for unknown ones.

    A worker puts the sorted arrays of its shard into a file, maps it into memory and searches there.
    """

    def answer(queries: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        if not len(queries):
            return pd.DataFrame({"batch": [], "shard": [], "answers": []})
        parts = [unpack_keys(k) for k in queries["keys"]]
        out = []
        with tempfile.NamedTemporaryFile() as file:
            n = 0
            for keys, counts in zip(stored["keys"], stored["counts"]):
                known, values = unpack_keys(keys), unpack_counts(counts, columns)
                n = len(known)
                file.write(known.tobytes() + values.tobytes())
            file.flush()
            if n:
                known = np.memmap(file.name, np.uint64, "r", 0, (n,))
                values = np.memmap(file.name, np.int64, "r", 8 * n, (n, columns))
            for keys in parts:
                found = np.zeros((len(keys), columns), np.int64)
                if n:
                    at = np.minimum(np.searchsorted(known, keys), n - 1)
                    hit = known[at] == keys
                    found[hit] = values[at[hit]]
                out.append(found)
        return answer_rows(queries, np.concatenate(out), [len(k) for k in parts])

    return asked.groupBy("shard").cogroup(model.groupBy("shard")).applyInPandas(answer, ANSWERS)

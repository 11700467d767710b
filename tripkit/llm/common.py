"""Shared helpers: words and their hashes in numpy, saved intermediate tables, running totals over hot groups."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripkit.session import shared_dir

# White space that separates words: [\x20\x09-\x0D].
WORD = r"[^\x20\x09-\x0D]+"
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

CHUNK_BYTES = 2 << 20
_WINDOW = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = (np.ones(0, np.uint64), np.ones(0, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers[0][:n], _powers[1][:n]


class Words(NamedTuple):
    """Words of several texts: 64-bit hashes, byte spans in ``buffer``, first word and first byte of each text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray
    buffer: np.ndarray


def hash_words(texts: list, lower: bool = False) -> Words:
    """Split UTF-8 ``texts`` (None: empty) at ASCII white space and hash each word.

    All texts are treated as one byte buffer, so no Python code runs per word. ``lower`` folds A-Z.
    """
    parts = [t or b"" for t in texts]
    lengths = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    buffer = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    table = _BYTE_LOWER if lower else _BYTE
    hashes, starts, ends, at = [], [], [], 0
    while at < len(buffer):
        stop = min(at + _WINDOW, len(buffer))
        gaps = np.flatnonzero(SPACE[buffer[at:stop]])
        while not len(gaps):  # one word longer than a window
            stop = min(stop + _WINDOW, len(buffer))
            gaps = np.flatnonzero(SPACE[buffer[at:stop]])
        stop = at + int(gaps[-1]) + 1
        piece = buffer[at:stop]
        solid = np.concatenate([[False], ~SPACE[piece]])
        edges = np.flatnonzero(solid[1:] != solid[:-1])  # the last byte is white space, so edges pair up
        a, b = edges[::2], edges[1::2]
        up, down = _power_tables(len(piece))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[piece] * up)])
        hashes.append(mix((sums[b] - sums[a]) * down[a] ^ (b - a).astype(np.uint64) * np.uint64(_BASE)))
        starts.append(a + at)
        ends.append(b + at)
        at = stop
    join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
    begun = join(starts, np.int64)
    return Words(join(hashes, np.uint64), begun, join(ends, np.int64), np.searchsorted(begun, offsets), offsets, buffer)


def ngram_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n``-word windows inside each text, and the text each lies in."""
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    count = max(0, len(words.hashes) - n + 1)
    whole = text[:count] == text[n - 1 : n - 1 + count]
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(_BASE) + words.hashes[k : k + count])
    return out[whole], text[:count][whole]


def chunks(frames: Iterable[pd.DataFrame], column: str, limit: int = CHUNK_BYTES, rows: int | None = None) -> Iterator[pd.DataFrame]:
    """Frames cut so that the texts of each cover about ``limit`` bytes and ``rows`` rows at most; a longer text stands alone."""
    for frame in frames:
        sizes = np.fromiter((0 if t is None else len(t) + 1 for t in frame[column]), np.int64, len(frame))
        block = np.cumsum(sizes) // limit + (np.arange(len(frame)) // rows if rows else 0)
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(frame)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield frame.iloc[a:b]


def saved(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a fixed state that outlives lost executors."""
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(df: DataFrame) -> Column:
    """128 bits of hash over all columns of a row."""
    return F.concat(F.hex(F.xxhash64(*df.columns)), F.hex(F.xxhash64(F.lit(1), *df.columns)))


def slices_for(rows: int) -> int:
    """Slices of a table so that neither one slice nor the list of slices becomes large."""
    return max(64, 2 * math.isqrt(max(rows, 1)))


def running_total(df: DataFrame, group: list[str], part: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows of the group that come earlier.

    ``part`` is a slice number that rises with ``order``. Only one slice of one group is ever sorted in a task; the
    totals of the slices carry over, so a group that holds most of the rows is still spread over many tasks.
    """
    keys = [*group, part]
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = df.groupBy(*keys).agg(F.sum(value).alias("__sum")).select(
        *(F.col(k).alias(f"__{k}") for k in keys), F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__base")
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("__local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    matched = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    joined = local.join(bases, matched, "left")
    return joined.withColumn(name, F.col("__local") + F.col("__base")).drop("__local", "__base", *(f"__{k}" for k in keys))

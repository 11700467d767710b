"""Short codes for vectors: each part of a vector is replaced by the nearest entry of a codebook, trained by dual-tree Lloyd.

Blocks of vectors are saved with a tree over each part, whose leaves hold boxes and sums. A round walks a block's tree and a
tree over the codebook together: bounds on the distances between two nodes rule out combinations, a node with one entry left
is assigned whole by its cached sum, and leaves with several entries left compare integer distances. All results are those of
comparing every part with every entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.common import saved

BLOCK_ROWS = 1 << 14  # vectors below one tree
LEAF_ROWS = 64  # at most so many parts in a leaf
_FIRST_LOOK, _HARDLY = 2, 0.9  # from this depth on, two depths that keep more than this share of the pairs end the walk
_EXACT = 1 << 53  # whole numbers below it are exact as doubles, so that leaves can be compared by matrix products


class Level(NamedTuple):
    """Nodes of one depth: rows ``starts[i]`` to ``starts[i + 1]`` of the ordered points, their box and their sum."""

    starts: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray


def ordered(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the points in which equal halves of halves are compact, and where the leaves start."""
    order, starts = np.arange(len(points)), np.array([0, len(points)])
    while np.diff(starts).max(initial=0) > leaf:
        node = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        spread = np.zeros((len(starts) - 1, points.shape[1]), np.int64)
        full = np.diff(starts) > 0
        at = starts[:-1][full]
        moved = points[order]
        spread[full] = np.maximum.reduceat(moved, at) - np.minimum.reduceat(moved, at)
        widest = spread.argmax(axis=1) if points.shape[1] else np.zeros(len(spread), np.int64)
        key = moved[np.arange(len(order)), widest[node]] if points.shape[1] else np.zeros(len(order), np.int64)
        order = order[np.lexsort((key, node))]
        halves = np.empty(2 * len(starts) - 1, np.int64)
        halves[::2], halves[1::2] = starts, (starts[:-1] + starts[1:]) // 2
        starts = halves
    return order, starts


def leaves(points: np.ndarray, starts: np.ndarray) -> Level:
    """Boxes and sums of the leaves of ordered points; an empty leaf gets a box that nothing is near."""
    n, width = len(starts) - 1, points.shape[1]
    low, high = np.full((n, width), np.iinfo(np.int32).max, np.int64), np.full((n, width), -np.iinfo(np.int32).max, np.int64)
    sums, full = np.zeros((n, width), np.int64), np.diff(starts) > 0
    if full.any() and width:
        at = starts[:-1][full]
        low[full], high[full] = np.minimum.reduceat(points, at), np.maximum.reduceat(points, at)
        sums[full] = np.add.reduceat(points, at)
    return Level(starts, low, high, sums)


def levels(leaf: Level) -> list[Level]:
    """All depths above the leaves, the root first."""
    out = [leaf]
    while len(out[0].starts) > 2:
        below = out[0]
        out.insert(0, Level(
            below.starts[::2], np.minimum(below.low[::2], below.low[1::2]), np.maximum(below.high[::2], below.high[1::2]),
            below.sums[::2] + below.sums[1::2],
        ))
    return out


class Walked(NamedTuple):
    """Entry of each ordered point, and per entry how many points it has and their sum; ``compared`` counts point-entry pairs."""

    entry: np.ndarray
    counts: np.ndarray
    sums: np.ndarray
    compared: int


def nearest_entries(points: np.ndarray, leaf: Level, entries: np.ndarray) -> Walked:
    """The nearest entry of each ordered point by squared distance, the first of several equally near ones.

    Where the parts have no clusters, boxes overlap all entries and no bound can help: the walk then ends after a few depths, and its
    nodes are compared with the entries they have left, so that it costs little more than comparing all at once.
    """
    count, width = entries.shape
    order, starts = ordered(entries, 1)
    tree = levels(leaves(entries[order], starts))
    blocks = levels(leaf)
    chosen = np.full(len(points), -1, np.int64)
    counts, sums = np.zeros(count, np.int64), np.zeros((count, width), np.int64)
    nodes, others = np.zeros(1, np.int64), np.zeros(1, np.int64)  # pairs of nodes that may matter, by node
    deepest, idle = max(len(blocks), len(tree)) - 1, 0
    for depth in range(deepest + 1):
        here, there = blocks[min(depth, len(blocks) - 1)], tree[min(depth, len(tree) - 1)]
        if depth:
            if depth < len(blocks):
                nodes, others = np.repeat(2 * nodes, 2) + np.tile([0, 1], len(nodes)), np.repeat(others, 2)
            if depth < len(tree):
                nodes, others = np.repeat(nodes, 2), np.repeat(2 * others, 2) + np.tile([0, 1], len(others))
            filled = (there.starts[others + 1] > there.starts[others]) & (here.starts[nodes + 1] > here.starts[nodes])
            nodes, others = nodes[filled], others[filled]
            by_node = np.argsort(nodes, kind="stable")
            nodes, others = nodes[by_node], others[by_node]
        low, high, elow, ehigh = here.low[nodes], here.high[nodes], there.low[others], there.high[others]
        nearest = (np.maximum(0, np.maximum(elow - high, low - ehigh)) ** 2).sum(axis=1)
        farthest = (np.maximum(high - elow, ehigh - low) ** 2).sum(axis=1)
        begins = np.flatnonzero(np.diff(nodes, prepend=-1))
        sizes = np.diff(np.append(begins, len(nodes)))
        keep = nearest <= np.repeat(np.minimum.reduceat(farthest, begins), sizes)
        single = depth >= len(tree) - 1
        if single:  # each other is one entry: rule out those farther than the box's favourite from all of the box
            best = _first_least(farthest, begins, sizes)
            entry = order[there.starts[others]]
            favourite = entries[np.repeat(entry[best], sizes)]
            rival = entries[entry]
            apart = 2 * (rival - favourite)
            most = (favourite**2 - rival**2).sum(axis=1) + np.where(apart > 0, apart * high, apart * low).sum(axis=1)
            keep &= (most >= 0) | (entry == np.repeat(entry[best], sizes))
        nodes, others = nodes[keep], others[keep]
        idle = idle + 1 if depth >= _FIRST_LOOK and keep.mean() > _HARDLY else 0
        if idle == 2 and not single:
            break  # the bounds rule out hardly anything here: compare at this depth, with larger products
        if single:
            begins = np.flatnonzero(np.diff(nodes, prepend=-1))
            sizes = np.diff(np.append(begins, len(nodes)))
            sure = sizes == 1
            entry = order[there.starts[others[begins[sure]]]]
            whole = nodes[begins[sure]]
            np.add.at(counts, entry, here.starts[whole + 1] - here.starts[whole])
            np.add.at(sums, entry, here.sums[whole])
            for node, e in zip(whole.tolist(), entry.tolist()):
                chosen[here.starts[node] : here.starts[node + 1]] = e
            unsure = np.repeat(~sure, sizes)
            nodes, others = nodes[unsure], others[unsure]
            if not len(nodes):
                break
    compared = 0
    if len(nodes):
        largest = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
        kind = np.float64 if 4 * max(width, 1) * largest**2 < _EXACT else np.int64
        norms, doubled = (entries**2).sum(axis=1).astype(kind), (2 * entries).astype(kind)
        begins = np.flatnonzero(np.diff(nodes, prepend=-1)).tolist()
        for a, b in zip(begins, [*begins[1:], len(nodes)]):
            left = np.sort(np.concatenate([order[there.starts[o] : there.starts[o + 1]] for o in others[a:b].tolist()]))
            part = slice(here.starts[nodes[a]], here.starts[nodes[a] + 1])
            chosen[part] = left[(norms[left] - points[part].astype(kind) @ doubled[left].T).argmin(axis=1)]
            compared += len(left) * (part.stop - part.start)
        rest = np.concatenate([np.arange(here.starts[n], here.starts[n + 1]) for n in nodes[begins].tolist()])
        counts += np.bincount(chosen[rest], minlength=count)
        by_entry = rest[np.argsort(chosen[rest], kind="stable")]
        found, first = np.unique(chosen[by_entry], return_index=True)
        if width:
            sums[found] += np.add.reduceat(points[by_entry], first)
    return Walked(chosen, counts, sums, compared)


def _first_least(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Place of the least value of each run."""
    least = np.repeat(np.minimum.reduceat(values, begins), sizes)
    hits = np.flatnonzero(values == least)
    run = np.repeat(np.arange(len(begins)), sizes)[hits]
    return hits[np.unique(run, return_index=True)[1]]


class Compressed(NamedTuple):
    """``rows``: the carried columns with ``codes`` (array<int>, a number per part) and ``error`` (long); ``codebooks``: part, entry, component."""

    rows: DataFrame
    codebooks: np.ndarray


def compress_vectors(
    spark: SparkSession, vectors: DataFrame, carried: list[str], scale: int = 1024, parts: int = 4, size: int = 256, rounds: int = 4,
    vector: str = "embedding", order: str = "vec_id",
) -> Compressed:
    """Codes of the ``vector`` column with components ``floor(scale * x)``, and the codebooks they refer to.

    Vectors that are null or hold null or non-finite components take no part. Shorter vectors than the longest, and a length that
    is no multiple of ``parts``, are filled up with zeros. The codebooks start with the ``size`` first vectors by ``order`` (nulls last, equal
    ones by components; fewer vectors: fewer entries); entries that no part chose stay. Equal distances go to the lower entry. Repeated
    rows count each. No vectors at all: no rows, empty codebooks. Distances that do not fit 64 bits are refused.
    Only codebooks, sums per entry and one row of extremes reach the driver: ``parts * size`` rows, whatever the table's size.
    """
    clean = vectors.filter(F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    longest, largest = clean.agg(F.max(F.size(vector)), F.max(F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double")))))).first()
    width = -(-(longest or 0) // parts)
    bound = int((largest or 0) * scale) + 1
    if 4 * parts * max(width, 1) * bound**2 >= 1 << 62:
        raise ValueError(f"components of up to {largest} give distances beyond 64 bits")
    filled = F.concat(scaled, F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(0), parts * width - F.size(vector))))
    kept = clean.select(filled.alias("__v"), F.col(order).alias("__order"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carried)))
    first = [r[0] for r in kept.orderBy(F.col("__order").asc_nulls_last(), "__v").limit(size).select("__v").collect()]
    codebooks = np.array(first, np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    blocks = _blocks(spark, kept.drop("__order"), parts, width)
    for _ in range(rounds):
        codebooks = _improved(blocks, codebooks) if len(first) else codebooks
    rows = _assigned(blocks, codebooks).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carried)), "codes", "error")
    return Compressed(saved(spark, rows, "vector-codes"), codebooks)


def _blocks(spark: SparkSession, kept: DataFrame, parts: int, width: int) -> DataFrame:
    """Saved blocks: lists of the carried columns, and for each part its order, ordered points, starts, boxes and sums of leaves."""
    carried = kept.columns[1:]
    lists = ", ".join(f"{c} array<{kept.schema[c].dataType.simpleString()}>" for c in carried)

    def build(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def closed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            flat = table.column("__v").chunk(0).flatten().to_numpy(zero_copy_only=False)
            points = flat.reshape(table.num_rows, parts, width)
            trees = []
            for p in range(parts):
                own = np.ascontiguousarray(points[:, p])
                order, starts = ordered(own, LEAF_ROWS)
                leaf = leaves(own[order], starts)
                trees.append([x.astype("<i8").tobytes() for x in (order, own[order], leaf.starts, leaf.low, leaf.high, leaf.sums)])
            ends = pa.array([0, table.num_rows], pa.int32())
            along = [pa.ListArray.from_arrays(ends, table.column(c).chunk(0)) for c in carried]
            return pa.RecordBatch.from_arrays([pa.array([trees], pa.list_(pa.list_(pa.binary()))), *along], ["trees", *carried])

        for frame in frames:
            at = 0
            while at < frame.num_rows:
                held.append(frame.slice(at, BLOCK_ROWS - rows))
                at, rows = at + held[-1].num_rows, rows + held[-1].num_rows
                if rows == BLOCK_ROWS:
                    yield closed()
                    held, rows = [], 0
        if rows:
            yield closed()

    return saved(spark, kept.mapInArrow(build, f"trees array<array<binary>>, {lists}"), "vector-blocks")


def _tree(stored: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, Level]:
    order, points, starts, *rest = (np.frombuffer(x, "<i8") for x in stored)
    shaped = lambda x, n: x.reshape(n, width)
    return order, shaped(points, len(order)), Level(starts, *(shaped(x, len(starts) - 1) for x in rest))


def _improved(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Each entry replaced by the mean of its parts, rounded down."""
    parts, size, width = codebooks.shape
    columns = [f"s{j}" for j in range(width)]

    def walk(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, size), np.int64), np.zeros((parts, size, width), np.int64)
        for frame in frames:
            for trees in frame.column("trees"):
                for p, stored in enumerate(trees.as_py()):
                    _, points, leaf = _tree(stored, width)
                    walked = nearest_entries(points, leaf, codebooks[p])
                    counts[p] += walked.counts
                    sums[p] += walked.sums
        p, e = np.nonzero(counts)
        arrays = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e]), *(pa.array(sums[p, e, j]) for j in range(width))]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "entry", "n", *columns])

    schema = "part int, entry int, n long" + "".join(f", {c} long" for c in columns)
    moved = blocks.select("trees").mapInArrow(walk, schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in columns))
    better = codebooks.copy()
    for part, entry, n, *sums in moved.collect():  # a row per part and entry
        better[part, entry] = np.array(sums, np.int64) // n
    return better


def _assigned(blocks: DataFrame, codebooks: np.ndarray) -> DataFrame:
    parts, size, width = codebooks.shape
    carried = [f for f in blocks.schema if f.name != "trees"]

    def walk(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for k in range(frame.num_rows):
                along = [frame.column(f.name).slice(k, 1).flatten() for f in carried]
                trees = frame.column("trees")[k].as_py()
                codes = np.zeros((len(along[0]), parts), np.int32)
                error = np.zeros(len(along[0]), np.int64)
                for p, stored in enumerate(trees):
                    order, points, leaf = _tree(stored, width)
                    entry = nearest_entries(points, leaf, codebooks[p]).entry
                    codes[order, p] = entry
                    error[order] += ((points - codebooks[p][entry]) ** 2).sum(axis=1)
                listed = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, parts, dtype=np.int32)), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([*along, listed, pa.array(error)], [*(f.name for f in carried), "codes", "error"])

    kinds = ", ".join(f"{f.name} {f.dataType.elementType.simpleString()}" for f in carried)
    return blocks.mapInArrow(walk, f"{kinds}, codes array<int>, error long")


def codebooks_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, decimal and comma-joined."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def with_label_error(rows: DataFrame, label: str = "label") -> DataFrame:
    """Add ``label_error``: the sum of ``error`` over rows of equal labels, nulls together. Sums join back, so a hot label may be split."""
    sums = rows.groupBy(F.col(label).alias("__label")).agg(F.sum("error").alias("label_error"))
    return rows.join(sums, F.col(label).eqNullSafe(F.col("__label")), "left").drop("__label")

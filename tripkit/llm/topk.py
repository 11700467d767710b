"""Exact top-k inner products by an impact-ordered index, scored segment by segment."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripkit.llm.common import saved

SHARD_ROWS, BLOCK_ROWS, QUERIES_AT_ONCE = 1024, 4096, 512
LEVELS = 8  # quantised impacts
POSSIBLE = 4  # scoring ends once this many times k rows are left as possible members, for the mean query


def quantised(vectors: DataFrame, is_query: Column, scale: int = 256) -> DataFrame:
    """``row``, ``vec_id``, ``asked`` and ``v``, floor(scale * x) of each component; rows that take no part are left out."""
    fit = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.filter(fit).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"),
        F.coalesce(is_query, F.lit(False)).alias("asked"), whole.alias("v"),
    )


def _matrix(lists, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    return out


def segments(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Postings (flat cell numbers) in order of falling impact level, where each level begins, and per level the
    largest impact of each dimension that is still to come."""
    impact = np.abs(matrix)
    level = (LEVELS - 1) - impact * LEVELS // (int(impact.max(initial=0)) + 1)
    order = np.argsort(level, axis=None, kind="stable")
    order = order[matrix.ravel()[order] != 0]
    begins = np.searchsorted(level.ravel()[order], np.arange(LEVELS + 1))
    rest = np.array([np.where(level > k, impact, 0).max(axis=0, initial=0) for k in range(LEVELS)])
    return order, begins, rest


def score_shard(ids: np.ndarray, matrix: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(query, row, score) of each query's ``k`` best rows of a shard, ties to the smaller id.

    Segments add to all queries' partial scores in order of falling impact. What is missing of a score is at most the
    sum of |query| times the largest impact still to come, and at most the product of the lengths of the query and of
    the row's rest. Rows whose upper bound lies below the k-th lower bound can't be members; when few are left, they
    are scored exactly. With all segments read the bounds are 0, so the end is always a proof.
    """
    order, begins, rest = segments(matrix)
    q, size = queries.astype(float), np.abs(queries).astype(float)
    reach = size @ np.abs(matrix).max(axis=0, initial=0).astype(float)
    slack = np.where(reach < 2.0**52, 0.0, reach * 2.0**-40)[:, None]  # sums below 2^52 are exact
    lengths = np.linalg.norm(q, axis=1)[:, None]
    scores = np.zeros((len(q), len(ids)))
    own = query_ids[:, None] == ids[None, :]
    left = (matrix.astype(float) ** 2).sum(axis=1)
    flat = matrix.ravel()
    for level in range(LEVELS):
        cells = order[begins[level] : begins[level + 1]]
        if len(cells):
            segment = np.zeros(matrix.size)
            segment[cells] = flat[cells]
            segment = segment.reshape(matrix.shape)
            scores += q @ segment.T
            left = np.maximum(left - (segment**2).sum(axis=1), 0)
        bound = np.minimum((size @ rest[level].astype(float))[:, None], lengths * np.sqrt(left)[None, :] * (1 + 1e-9)) + slack
        low = np.where(own, -np.inf, scores - bound)
        kth = np.partition(low, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(q), -np.inf)
        possible = (scores + bound >= kth[:, None]) & ~own
        if possible.sum() <= POSSIBLE * k * len(q) or level == LEVELS - 1:
            break
    a, b = np.nonzero(possible)
    exact = np.einsum("ij,ij->i", queries[a], matrix[b])
    best = np.lexsort((ids[b], -exact, a))
    a, b, exact = a[best], b[best], exact[best]
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    return a[rank < k], b[rank < k], exact[rank < k]


def top_products(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each row with ``is_query`` its ``k`` best other rows.

    ``vectors``: ``vec_id``, ``embedding``; other columns may only be used by ``is_query``. Rows with the query's id are
    its own. Null ids, null vectors and such with null or non-finite components take no part; a shorter vector is
    zero beyond its end. Every row is indexed, in shards of some SHARD_ROWS vectors; blocks of queries meet each
    shard once, and only ``k`` rows per query and shard are compared in the end. Repeated rows each count, as queries too.
    """
    rows = saved(spark, quantised(vectors, is_query, scale), "topk-vectors")
    count, asked, width = rows.agg(F.count("*"), F.count_if("asked"), F.max(F.size("v"))).first()
    n_shards, n_blocks = max(1, -(-count // SHARD_ROWS)), max(1, -(-asked // BLOCK_ROWS))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        matrix = _matrix(frame["v"], width)
        return pd.DataFrame({"part": frame["part"].iloc[:1], "ids": [frame["vec_id"].to_numpy(np.int64).tobytes()],
                             "rows": [frame["row"].to_numpy(np.int64).tobytes()], "cells": [matrix.tobytes()]})

    packed = "part long, ids binary, rows binary, cells binary"
    part = lambda n: F.pmod(F.xxhash64("row"), F.lit(n))
    shards = rows.withColumn("part", part(n_shards)).groupBy("part").applyInPandas(pack, packed)
    blocks = rows.filter("asked").withColumn("part", part(n_blocks)).groupBy("part").applyInPandas(pack, packed)
    shards = shards.withColumnRenamed("part", "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    blocks = blocks.withColumnRenamed("part", "block").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    keys = [F.col("shard").cast("long"), F.col("block").cast("long")]

    def meet(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")]
        if len(shard) and len(block):
            ids = np.frombuffer(shard["ids"].iloc[0], np.int64)
            matrix = np.frombuffer(shard["cells"].iloc[0], np.int64).reshape(len(ids), -1)
            query_ids, query_rows = (np.frombuffer(block[c].iloc[0], np.int64) for c in ("ids", "rows"))
            queries = np.frombuffer(block["cells"].iloc[0], np.int64).reshape(len(query_ids), -1)
            for at in range(0, len(query_ids), QUERIES_AT_ONCE):
                some = slice(at, at + QUERIES_AT_ONCE)
                a, b, score = score_shard(ids, matrix, query_ids[some], queries[some], k)
                out.append(pd.DataFrame({"query_row": query_rows[some][a], "query_id": query_ids[some][a], "vec_id": ids[b], "score": score}))
        return pd.concat(out, ignore_index=True)

    found = shards.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInPandas(meet, "query_row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Online k-means over a stream of points.

Two forms. ``microbatch`` assigns all points of a micro-batch to the centroids the batch
started with and adds them up per cluster: parallel, a few rows of state. ``sequential``
updates the centroids after every single record and emits the moved centroid: the order of
records matters, so each stream key is one ordered sequence with its own centroids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tripkit.functions.geo import usable_point

# Starting centroids as (lat, lon); their weight is zero, so the first point
# of a cluster replaces its start.
SEEDS = [(40.7580, -73.9855), (40.7128, -74.0060), (40.730610, -73.935242)]


def nearest_centroid(lat: Column, lon: Column, centroids: list[tuple[int, float, float]]) -> Column:
    """Id of the closest centroid; equal distances go to the lower id."""
    options = []
    for cluster, c_lat, c_lon in centroids:
        dy, dx = F.lit(c_lat) - lat, F.lit(c_lon) - lon
        options.append(F.struct(F.sqrt(dy * dy + dx * dx).alias("d"), F.lit(cluster).alias("id")))
    return F.array_min(F.array(*options))["id"]


class MicroBatchKMeans:
    """``foreachBatch`` function; state is a small Parquet table, three versions kept."""

    def __init__(self, folder: str, lat: str, lon: str, seeds: list[tuple[float, float]] = SEEDS):
        self.folder, self.lat, self.lon, self.seeds = folder.rstrip("/"), lat, lon, seeds

    def _version(self, batch_id: int) -> str:
        # Three folders in turn: a repeated batch still finds the version before it.
        return f"{self.folder}/slot={batch_id % 3}"

    def centroids(self, spark, batch_id: int) -> DataFrame:
        """Centroids after a micro-batch: cluster_id, lat, lng, weight."""
        if batch_id < 0:
            rows = [(i, lat, lon, 0) for i, (lat, lon) in enumerate(self.seeds)]
            return spark.createDataFrame(rows, "cluster_id int, lat double, lng double, weight bigint")
        return spark.read.parquet(self._version(batch_id))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        state = self.centroids(batch.sparkSession, batch_id - 1)
        known = [(r.cluster_id, r.lat, r.lng) for r in state.orderBy("cluster_id").collect()]  # K rows
        points = batch.where(usable_point(F.col(self.lat), F.col(self.lon)))
        assigned = points.select(
            nearest_centroid(F.col(self.lat), F.col(self.lon), known).alias("cluster_id"),
            F.col(self.lat).alias("_lat"), F.col(self.lon).alias("_lon"),
        )
        sums = assigned.groupBy("cluster_id").agg(
            F.sum("_lat").alias("s_lat"), F.sum("_lon").alias("s_lon"), F.count(F.lit(1)).alias("n")
        )
        total = F.col("weight") + F.coalesce("n", F.lit(0))

        def merged(old, added):
            return F.when(F.coalesce("n", F.lit(0)) == 0, F.col(old)).otherwise(
                (F.col(old) * F.col("weight") + F.col(added)) / F.nullif(total, F.lit(0))
            )

        new = state.join(sums, "cluster_id", "left").select(
            "cluster_id", merged("lat", "s_lat").alias("lat"), merged("lng", "s_lon").alias("lng"),
            total.alias("weight"),
        )
        new.coalesce(1).write.mode("overwrite").parquet(self._version(batch_id))

    def run_available(self, stream: DataFrame, checkpoint: str) -> None:
        query = (
            stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()


def sequential_step(state: list[list[float]], lat: float, lon: float) -> int:
    """Move the nearest centroid of ``state`` (rows of lat, lon, weight); returns its id."""
    centres = np.asarray(state)
    cluster = int(np.argmin(np.hypot(centres[:, 0] - lat, centres[:, 1] - lon)))
    c_lat, c_lon, weight = state[cluster]
    state[cluster] = [
        (c_lat * weight + lat) / (weight + 1), (c_lon * weight + lon) / (weight + 1), weight + 1,
    ]
    return cluster


def sequential_kmeans(
    stream: DataFrame, key: str, order: list[str], lat: str, lon: str, seeds: list[tuple[float, float]] = SEEDS
) -> DataFrame:
    """One output row per point: the centroid it moved, in record order per key.

    Records of one key are one sequence and are handled by one task per micro-batch; the
    size of a micro-batch is bounded by the source's rate limit.
    """
    start = [[a, b, 0.0] for a, b in seeds]

    def update(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        flat = state.get[0] if state.exists else None
        centres = [list(flat[i : i + 3]) for i in range(0, len(flat), 3)] if flat else [list(row) for row in start]
        seen = int(state.get[1]) if state.exists else 0
        rows = pd.concat(list(batches)).sort_values(order, kind="stable")
        out = []
        for one_lat, one_lon in zip(rows[lat].tolist(), rows[lon].tolist()):
            cluster = sequential_step(centres, one_lat, one_lon)
            seen += 1
            out.append((group[0], seen, cluster, centres[cluster][0], centres[cluster][1]))
        state.update(([value for row in centres for value in row], seen))
        yield pd.DataFrame(out, columns=["key", "seq", "cluster_id", "lat", "lng"])

    points = stream.where(usable_point(F.col(lat), F.col(lon)))
    return points.groupBy(key).applyInPandasWithState(
        update,
        f"key {dict(stream.dtypes)[key]}, seq bigint, cluster_id int, lat double, lng double",
        "centres array<double>, seen bigint",
        "append",
        GroupStateTimeout.NoTimeout,
    )

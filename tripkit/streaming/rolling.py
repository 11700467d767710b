"""Rolling statistics over the last N records of every key, batch and stream.

A stream keeps, per key, the last N - 1 records and the number of records seen. Each
micro-batch puts those of its own keys in front of its new rows and runs the batch operator on both, so a
busy key is split over tasks just as in a batch job. A batch writes the state of the keys it touched, and
nothing of others: state is a handful of Parquet folders, each with the keys that some run of batches touched, and
runs of equal length merge like the digits of a binary counter. A key is so rewritten a few times, not in every batch.
A batch that is run again after a failure reads the same folders and overwrites its own output.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripkit.functions.temporal import micros
from tripkit.operators.selection import numbered, rolling_last_n

STATS_WINDOW = 100
AVERAGE_WINDOW = 5


@dataclass(frozen=True)
class RollingSpec:
    """What to keep and compute.

    The first ``order`` column is a time; rows are numbered in slices of ``bucket_seconds``, so
    the slice, not the key, is what one task sorts. ``values`` are the numeric columns (null counts as 0); ``aggregates`` makes result
    columns from a window; a row is emitted once its window holds ``min_rows`` rows.
    """

    key: str
    order: list[str]
    values: list[str]
    size: int
    aggregates: dict[str, callable]
    min_rows: int = 1
    bucket_seconds: int = 600
    keep: list[str] = field(default_factory=list)


def rolling_stats_spec(
    key: str, order: list[str], fare: str, passengers: str, distance: str, size: int = STATS_WINDOW
) -> RollingSpec:
    """Mean and sample deviation of fare, passengers and distance."""

    def over(function, column):
        return lambda frame: function(column).over(frame)

    aggregates = {}
    for short, column in (("fare", fare), ("psg", passengers), ("dist", distance)):
        aggregates[f"mean_{short}"] = over(F.avg, column)
        aggregates[f"std_{short}"] = over(F.stddev_samp, column)
    return RollingSpec(key, order, [fare, passengers, distance], size, aggregates, min_rows=2)


def rolling_average_spec(key: str, order: list[str], amount: str, size: int = AVERAGE_WINDOW) -> RollingSpec:
    return RollingSpec(
        key, order, [amount], size, {"rolling_avg": lambda frame: F.round(F.avg(amount).over(frame), 2)}
    )


def _rows(df: DataFrame, spec: RollingSpec) -> DataFrame:
    zeroed = {v: F.coalesce(F.nanvl(F.col(v).cast("double"), F.lit(0.0)), F.lit(0.0)) for v in spec.values}
    names = list(dict.fromkeys([spec.key, *spec.order, *spec.keep, *spec.values]))
    return df.select(*[zeroed[n].alias(n) if n in zeroed else F.col(n) for n in names])


def _bucket(spec: RollingSpec) -> Column:
    return F.floor(micros(F.col(spec.order[0])) / F.lit(spec.bucket_seconds * 1_000_000))


def rolling_batch(df: DataFrame, spec: RollingSpec) -> DataFrame:
    """All records in order: ``seq`` (records of the key so far) and the aggregates."""
    rows = numbered(_rows(df, spec), spec.key, spec.order, _bucket(spec))
    out = rolling_last_n(rows, spec.key, spec.size, spec.aggregates)
    return out.where(F.col("seq") >= spec.min_rows)


def last_rows(rows: DataFrame, key: str, count: int) -> DataFrame:
    """The ``count`` rows with the highest ``seq`` per key.

    ``seq`` has no gaps, so a comparison with the key's maximum selects them.
    """
    top = rows.groupBy(F.col(key).alias("_key")).agg(F.max("seq").alias("_top"))
    near = rows.join(top, F.col(key).eqNullSafe(F.col("_key")))
    return near.where(F.col("seq") > F.col("_top") - count).drop("_key", "_top")


STATE_BUCKETS = 64  # folders per run of batches; a batch reads those that its keys fall into


def live_runs(batches: int) -> list[tuple[int, int]]:
    """Level and number of the runs of batches that hold the state after so many batches: a run per binary digit, oldest first."""
    runs, start = [], 0
    for level in range(batches.bit_length() - 1, -1, -1):
        if batches >> level & 1:
            runs.append((level, start >> level))
            start += 1 << level
    return runs


class RollingStream:
    """``foreachBatch`` function that keeps rolling state in ``folder``.

    ``folder`` must be on storage that all executors share. Results go to ``output``, one
    sub-folder per micro-batch; ``emit`` may pass them on, for instance to a topic.
    """

    def __init__(self, spec: RollingSpec, folder: str, output: str, emit=None):
        self.spec, self.folder, self.output, self.emit = spec, folder.rstrip("/"), output.rstrip("/"), emit

    def _place(self, run: tuple[int, int]) -> str:
        # Three folders in turn per level: a run is overwritten only when no batch can need it again.
        level, number = run
        return f"{self.folder}/level={level}/slot={number % 3}"

    def _bucket(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", F.pmod(F.xxhash64(self.spec.key), F.lit(STATE_BUCKETS)).cast("int"))

    def state(self, spark, schema, runs: list[tuple[int, int]], buckets: list[int] | None = None) -> DataFrame:
        """Rows of ``runs`` (``_bucket`` and ``_version`` besides ``schema``), for each key those of its latest version."""
        kinds = f"{schema}, _version bigint, _bucket int"
        found = [spark.read.schema(kinds).parquet(self._place(run)) for run in runs]
        rows = reduce(lambda a, b: a.unionByName(b), found)
        if buckets is not None:
            rows = rows.where(F.col("_bucket").isin(buckets))
        latest = rows.groupBy(F.col(self.spec.key).alias("_key")).agg(F.max("_version").alias("_latest"))
        newest = F.col(self.spec.key).eqNullSafe(F.col("_key")) & (F.col("_version") == F.col("_latest"))
        return rows.join(latest, newest).drop("_key", "_latest")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spec, spark = self.spec, batch.sparkSession
        fresh = numbered(_rows(batch, spec), spec.key, spec.order, _bucket(spec))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.schema)
        before, after = live_runs(batch_id), live_runs(batch_id + 1)
        if before:
            keys = self._bucket(batch.select(spec.key).distinct())
            touched = [r[0] for r in keys.select("_bucket").distinct().collect()]  # at most STATE_BUCKETS numbers
            known = self.state(spark, schema, before, touched)
            keys = keys.select(F.col(spec.key).alias("_key"))
            state = known.join(keys, F.col(spec.key).eqNullSafe(F.col("_key")), "left_semi").drop("_version", "_bucket")
            seen = state.groupBy(F.col(spec.key).alias("_key")).agg(F.max("seq").alias("_seen"))
            fresh = (
                fresh.join(seen, F.col(spec.key).eqNullSafe(F.col("_key")), "left")
                .withColumn("seq", F.col("seq") + F.coalesce("_seen", F.lit(0)))
                .drop("_key", "_seen")
            )
            everything = state.withColumn("_new", F.lit(False)).unionByName(fresh.withColumn("_new", F.lit(True)))
        else:
            everything = fresh.withColumn("_new", F.lit(True))
        everything = everything.persist()  # written twice below
        results = (
            rolling_last_n(everything, spec.key, spec.size, spec.aggregates)
            .where(F.col("_new") & (F.col("seq") >= spec.min_rows))
            .drop("_new")
        )
        target = f"{self.output}/batch={batch_id}"
        results.write.mode("overwrite").parquet(target)
        # One row more than the window needs keeps the count of keys when size is 1.
        keep = last_rows(everything.drop("_new"), spec.key, max(spec.size - 1, 1)).withColumn("_version", F.lit(batch_id).cast("bigint"))
        keep = self._bucket(keep)
        merged = [run for run in before if run not in after]
        if merged:
            older = self.state(spark, schema, merged)
            own = keep.select(F.col(spec.key).alias("_key")).distinct()
            keep = older.join(own, F.col(spec.key).eqNullSafe(F.col("_key")), "left_anti").unionByName(keep)
        keep.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(self._place(after[-1]))
        everything.unpersist()
        if self.emit:
            self.emit(spark.read.parquet(target), batch_id)

    def run_available(self, stream: DataFrame, checkpoint: str) -> None:
        """Process what has arrived and stop."""
        query = (
            stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()

    def start(self, stream: DataFrame, checkpoint: str, every: str = "10 seconds"):
        return (
            stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
            .trigger(processingTime=every).start()
        )

"""Batch sinks: partitioned Parquet, small CSV / JSON results, format comparison, run records."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.session import saved
from tripkit.sources.readers import MANIFEST, MANIFEST_SCHEMA, VERSION, _entries, list_files, live_loads

MAX_ROWS_PER_FILE = 2_000_000


def write_by_year(
    df: DataFrame, root: str, partition: str = "year", files_per_year: int | None = None, load: str = "all", sources: list[str] = (),
) -> None:
    """Snappy Parquet partitioned by year, with a manifest that says which rows of which load count.

    ``load`` names what the rows come from, such as a month. A load that is written again replaces all its own rows, also
    in years that it no longer holds, and no others. Each write goes to a folder of its own; the manifest entry that
    names the folder is added last, so a failed write leaves what was there, and readers of `read_partitioned` never see
    half a load. ``sources`` (such as file names) may belong to one load only: a write that holds a source of another load is refused
    before anything is written. Tasks write the years they hold, so nothing is shuffled and no year lands in one task.
    ``files_per_year`` first spreads every year over that many tasks, for inputs of many small files.
    """
    spark = df.sparkSession
    taken = {source: entry.load for entry in live_loads(spark, root) if entry.load != load for source in entry.sources}
    shared = sorted(set(sources) & set(taken))
    if shared:
        raise ValueError(f"{shared[0]} already belongs to load {taken[shared[0]]}")
    if files_per_year:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c != partition]), F.lit(files_per_year))
        df = df.withColumn("_salt", salt).repartition(partition, "_salt").drop("_salt")
    version = uuid.uuid4().hex
    folder = f"{root}/{VERSION}={version}"
    writer = df.write.option("compression", "snappy").option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
    writer.partitionBy(partition).parquet(folder)
    held = spark.read.schema(df.schema).parquet(folder).groupBy(partition).agg(F.count(F.lit(1)).alias("n"))
    values = [(r[0], r[1]) for r in held.collect()]  # a row per year; counts come from footers
    entry = (load, version, time.time_ns(), [str(v) for v, _ in values], sum(n for _, n in values), list(sources))
    spark.createDataFrame([entry], MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/{MANIFEST}")


def drop_superseded(spark: SparkSession, root: str) -> int:
    """Empty the folders of writes that later ones have replaced; returns how many. Run it when no reader uses an old state."""
    kept = {entry.version for entry in live_loads(spark, root)}
    old = [entry for entry in _entries(spark, root) if entry.version not in kept and entry.rows]
    empty = spark.createDataFrame([], "nothing int")
    for entry in old:
        empty.write.mode("overwrite").parquet(f"{root}/{VERSION}={entry.version}")
        done = (entry.load, entry.version, entry.at, [], 0, list(entry.sources))
        spark.createDataFrame([done], MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(f"{root}/{MANIFEST}")
    return len(old)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_small_csv(df: DataFrame, path: str) -> None:
    """One CSV file, for results of a few rows such as yearly statistics."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_results(results: dict[str, DataFrame], root: str) -> None:
    """One JSON dataset per named result."""
    for name, df in results.items():
        df.write.mode("overwrite").json(f"{root.rstrip('/')}/{name}")


def append_record(spark: SparkSession, record: dict[str, object], path: str) -> None:
    """Append one run record (settings and metrics)."""
    spark.createDataFrame([record]).write.mode("append").parquet(path)


def _writers(df: DataFrame) -> dict[str, tuple]:
    w = df.write.mode("overwrite")
    return {
        "parquet": (lambda p: w.parquet(p), lambda r, p: r.parquet(p)),
        "orc": (lambda p: w.orc(p), lambda r, p: r.orc(p)),
        "json": (lambda p: df.write.mode("overwrite").json(p), lambda r, p: r.schema(df.schema).json(p)),
        "csv": (
            lambda p: df.write.mode("overwrite").option("header", True).csv(p),
            lambda r, p: r.schema(df.schema).option("header", True).csv(p),
        ),
        "csv_gzip": (
            lambda p: df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(p),
            lambda r, p: r.schema(df.schema).option("header", True).csv(p),
        ),
    }


FORMATS = ["parquet", "orc", "json", "csv", "csv_gzip"]
_TYPED = ("parquet", "orc")


def write_formats(df: DataFrame, root: str, formats: list[str] = FORMATS) -> dict[str, DataFrame]:
    """Write one frame in several formats; returns the read-back frame of each.

    The frame is computed once: the first format that keeps its types is written from it, the others from what that one holds.
    """
    spark, frames = df.sparkSession, {}
    first = next((name for name in formats if name in _TYPED), None)
    if first is None and len(formats) > 1:
        df = saved(spark, df, "formats")
    for name in sorted(formats, key=lambda name: name != first):
        write, read = _writers(df)[name]
        path = f"{root}/{name}"
        write(path)
        frames[name] = read(spark.read, path)
        if name == first:
            df = frames[name]
    return {name: frames[name] for name in formats}


def time_reads(frames: dict[str, DataFrame], root: str, repeats: int = 10) -> DataFrame:
    """Size in MB and one row per timed full scan of each format."""
    spark = next(iter(frames.values())).sparkSession
    timings = []
    for name, df in frames.items():
        for run in range(repeats):
            start = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            timings.append((name, run, time.perf_counter() - start))
    rows = spark.createDataFrame(timings, "format string, run int, seconds double")
    files = list_files(spark, root, "part-*")
    sizes = files.groupBy(
        F.element_at(F.split(F.regexp_replace("path", "/part-[^/]*$", ""), "/"), -1).alias("format")
    ).agg((F.sum("length") / F.lit(1024.0 * 1024.0)).alias("size_mb"))
    return rows.join(sizes, "format", "left")


def timing_summary(timings: DataFrame, by: list[str], seconds: str = "seconds") -> DataFrame:
    """Minimum, mean, maximum and sample standard deviation, rounded to 2 digits."""
    s = F.col(seconds)
    return timings.groupBy(*by).agg(
        F.round(F.min(s), 2).alias("read_min_s"),
        F.round(F.avg(s), 2).alias("read_avg_s"),
        F.round(F.max(s), 2).alias("read_max_s"),
        F.round(F.stddev_samp(s), 2).alias("read_std_s"),
    )

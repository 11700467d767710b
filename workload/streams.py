"""Rolling statistics, clusters and message handling, batch and streaming.

Streams replay the events table: it is cut into three spans of time, each span is written as
messages and then processed as one micro-batch, in time order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.session import shared_dir
from tripkit.streaming import messages as msg
from tripkit.streaming.clusters import MicroBatchKMeans, sequential_kmeans
from tripkit.streaming.rolling import RollingStream, rolling_average_spec, rolling_batch, rolling_stats_spec
from workload.registry import query
from workload.views import lat_of, lon_of, sql_lat, sql_lon, table

# The first span also takes null times; it and the last are open.
_SPANS = [(None, "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", None)]
_MESSAGE = (
    "event_id bigint, ts timestamp_ntz, event_type string, user_id bigint, fare double, passengers int, distance double"
)


def _records(spark, sf) -> DataFrame:
    """Events as trip records: some fares missing, passengers and distance derived.

    Amounts are divided so that their averages do not fall exactly on a rounding edge.
    """
    key = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id", "ts", "event_type", "user_id",
        F.when(key % 17 != 0, F.col("value") * 0.1234567).alias("fare"),
        (key % 5).cast("int").alias("passengers"), (F.col("value") * 0.0765433).alias("distance"),
    )


_RECORDS = """records AS (SELECT event_id, ts, event_type, user_id, CASE WHEN event_id % 17 = 0 THEN 0 ELSE value * CAST(0.1234567 AS DOUBLE) END AS fare,
  CAST(event_id % 5 AS DOUBLE) AS passengers, value * CAST(0.0765433 AS DOUBLE) AS distance FROM events)"""
_W = "OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS 99 PRECEDING)"
_STATS_SQL = f"""
WITH {_RECORDS}, w AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS seq,
  avg(fare) {_W} AS mean_fare, stddev_samp(fare) {_W} AS std_fare, avg(passengers) {_W} AS mean_psg,
  stddev_samp(passengers) {_W} AS std_psg, avg(distance) {_W} AS mean_dist, stddev_samp(distance) {_W} AS std_dist FROM records)
SELECT event_type, event_id, seq, round(mean_fare, 3) AS mean_fare, round(std_fare, 3) AS std_fare, round(mean_psg, 3) AS mean_psg,
  round(std_psg, 3) AS std_psg, round(mean_dist, 3) AS mean_dist, round(std_dist, 3) AS std_dist FROM w WHERE seq >= 2"""
_STATS = ["mean_fare", "std_fare", "mean_psg", "std_psg", "mean_dist", "std_dist"]
_AVERAGE_SQL = f"""
WITH {_RECORDS} SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS seq,
  round(avg(fare) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS 4 PRECEDING), 2) AS rolling_avg FROM records"""


def _stats_spec():
    return rolling_stats_spec("event_type", ["ts", "event_id"], "fare", "passengers", "distance")


def _average_spec():
    return rolling_average_spec("event_type", ["ts", "event_id"], "amount")


def _stats_columns(df: DataFrame) -> DataFrame:
    return df.select("event_type", "event_id", "seq", *[F.round(c, 3).alias(c) for c in _STATS])


@query("rolling_stats_batch", _STATS_SQL)
def rolling_stats_batch(spark, sf):
    return _stats_columns(rolling_batch(_records(spark, sf), _stats_spec()))


@query("rolling_avg_batch", _AVERAGE_SQL)
def rolling_avg_batch(spark, sf):
    rows = _records(spark, sf).withColumn("amount", F.col("fare"))
    return rolling_batch(rows, _average_spec()).select("event_type", "event_id", "seq", "rolling_avg")


def _replay(spark, rows: DataFrame, key: str, process) -> None:
    """Write each time span as messages and let ``process`` handle what has arrived."""
    folder = shared_dir(spark, "topic")
    for start, end in _SPANS:
        time = F.col("ts")
        late = F.lit(True) if end is None else time < F.lit(end).cast("timestamp_ntz")
        inside = late | time.isNull() if start is None else late & (time >= F.lit(start).cast("timestamp_ntz"))
        span = rows.where(inside)
        msg.to_keyed_json(span, key).write.mode("append").parquet(folder)
        process(msg.file_stream(spark, folder))


def _parsed(stream: DataFrame) -> DataFrame:
    from pyspark.sql import types as T

    return msg.parse_json(stream, T.StructType.fromDDL(_MESSAGE), keep_key=False)


def _rolling_stream(spark, rows: DataFrame, spec, prepare) -> DataFrame:
    state, output, checkpoint = (shared_dir(spark, p) for p in ("state", "output", "checkpoint"))
    job = RollingStream(spec, state, output)
    _replay(spark, rows, "event_type", lambda stream: job.run_available(prepare(_parsed(stream)), checkpoint))
    return spark.read.parquet(output)


@query("stream_rolling_stats", _STATS_SQL)
def stream_rolling_stats(spark, sf):
    return _stats_columns(_rolling_stream(spark, _records(spark, sf), _stats_spec(), lambda df: df))


@query("stream_rolling_avg", _AVERAGE_SQL)
def stream_rolling_avg(spark, sf):
    def amount(df):
        return df.withColumn("amount", F.col("fare"))

    out = _rolling_stream(spark, _records(spark, sf), _average_spec(), amount)
    return out.select("event_type", "event_id", "seq", "rolling_avg")


@query("to_keyed_json", """
SELECT event_type AS key, event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, value FROM events""")
def to_keyed_json(spark, sf):
    """Messages with the key and, read back from their JSON text, three fields."""
    sent = msg.to_keyed_json(table(spark, sf, "events"), "event_type", ["event_id", "ts", "value"])
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return sent.select(
        "key", field("event_id").cast("bigint").alias("event_id"), field("ts").alias("ts"), field("value").cast("double").alias("value")
    )


@query("stream_parse_json", """
SELECT event_id, ts, event_type, user_id, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value * CAST(0.1234567 AS DOUBLE) END AS fare,
  CAST(event_id % 5 AS INTEGER) AS passengers, value * CAST(0.0765433 AS DOUBLE) AS distance FROM events""")
def stream_parse_json(spark, sf):
    output, checkpoint = shared_dir(spark, "parsed"), shared_dir(spark, "checkpoint")
    _replay(spark, _records(spark, sf), "event_type", lambda s: msg.run_available(_parsed(s), output, checkpoint))
    return spark.read.parquet(output)


@query("latest_per_key", """
SELECT user_id, max(event_id) AS event_id, arg_max(ts, event_id) AS ts, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1""")
def latest_per_key(spark, sf):
    """Streaming aggregate in update mode; each micro-batch's updates are stored as a version."""
    output, checkpoint = shared_dir(spark, "latest"), shared_dir(spark, "checkpoint")

    def store(updates: DataFrame, batch_id: int) -> None:
        updates.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{output}/version={batch_id}")

    def process(stream: DataFrame) -> None:
        latest = msg.latest_per_key(_parsed(stream), "user_id", "event_id", ["ts", "event_type"])
        query = (
            latest.writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()

    _replay(spark, _records(spark, sf), "user_id", process)
    return msg.latest_per_key(spark.read.parquet(output), "user_id", "event_id", ["ts", "event_type"])


@query("replay_order", "SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id")
def replay_order(spark, sf):
    return msg.replay_order(table(spark, sf, "events").select("event_id", "ts", "event_type"), "ts", "event_id")


def _points(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("trip_id"), "ts", "user_id", lat_of("event_id").alias("lat"), lon_of("event_id").alias("lon")
    )


_POINTS = f"points AS (SELECT event_id AS trip_id, ts AS trip_ts, {sql_lat('event_id')} AS lat, {sql_lon('event_id')} AS lon FROM events)"


def _point_stream(stream: DataFrame) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("trip_id bigint, ts timestamp_ntz, user_id bigint, lat double, lon double")
    return msg.parse_json(stream, schema, keep_key=False)


@query("stream_kmeans", None)
def stream_kmeans(spark, sf):
    """Record-by-record clusters; every user is a sequence of its own."""
    output, checkpoint = shared_dir(spark, "centres"), shared_dir(spark, "checkpoint")

    def process(stream: DataFrame) -> None:
        moved = sequential_kmeans(_point_stream(stream), "user_id", ["ts", "trip_id"], "lat", "lon")
        msg.run_available(moved, output, checkpoint)

    _replay(spark, _points(spark, sf), "user_id", process)
    return spark.read.parquet(output)


def _assigned(i: int) -> str:
    """SQL of one micro-batch: assign to the centroids of step i - 1, then merge."""
    start, end = _SPANS[i - 1]
    late = "true" if end is None else f"trip_ts < TIMESTAMP '{end}'"
    inside = f"({late} OR trip_ts IS NULL)" if start is None else f"{late} AND trip_ts >= TIMESTAMP '{start}'"
    nearest = f"""SELECT trip_id, e.lat, e.lon, arg_min(c.cluster_id, (sqrt((c.lat - e.lat) * (c.lat - e.lat) + (c.lng - e.lon) * (c.lng - e.lon)), c.cluster_id)) AS cluster_id
      FROM points e CROSS JOIN c{i - 1} c WHERE {inside} GROUP BY 1, 2, 3"""
    return f"""a{i} AS ({nearest}), s{i} AS (SELECT cluster_id, sum(lat) AS slat, sum(lon) AS slon, count(*) AS n FROM a{i} GROUP BY 1),
    c{i} AS (SELECT c.cluster_id, CASE WHEN n IS NULL THEN c.lat ELSE (c.lat * weight + slat) / (weight + n) END AS lat,
      CASE WHEN n IS NULL THEN c.lng ELSE (c.lng * weight + slon) / (weight + n) END AS lng, weight + coalesce(n, 0) AS weight
      FROM c{i - 1} c LEFT JOIN s{i} s ON c.cluster_id = s.cluster_id)"""


@query("stream_kmeans_microbatch", f"""
WITH {_POINTS}, c0 AS (SELECT * FROM (VALUES (0, CAST(40.7580 AS DOUBLE), CAST(-73.9855 AS DOUBLE), 0), (1, 40.7128, -74.0060, 0),
  (2, 40.730610, -73.935242, 0)) t(cluster_id, lat, lng, weight)), {_assigned(1)}, {_assigned(2)}, {_assigned(3)}
SELECT cluster_id, round(lat, 5) AS lat, round(lng, 5) AS lng, CAST(weight AS BIGINT) AS weight FROM c3""")
def stream_kmeans_microbatch(spark, sf):
    job = MicroBatchKMeans(shared_dir(spark, "centroids"), "lat", "lon")
    checkpoint = shared_dir(spark, "checkpoint")
    _replay(spark, _points(spark, sf), "user_id", lambda s: job.run_available(_point_stream(s), checkpoint))
    final = job.centroids(spark, len(_SPANS) - 1)
    return final.select("cluster_id", F.round("lat", 5).alias("lat"), F.round("lng", 5).alias("lng"), "weight")

import math
import random
from datetime import datetime, timedelta

import pytest

from tripkit.streaming import messages as msg
from tripkit.streaming.clusters import SEEDS, MicroBatchKMeans, sequential_kmeans, sequential_step
from tripkit.session import shared_dir

BASE = datetime(2024, 1, 1)


def plain_kmeans(points, seeds=SEEDS):
    """The same in plain Python, one record at a time."""
    centres, out = [[a, b, 0] for a, b in seeds], []
    for lat, lon in points:
        distances = [math.sqrt((c[0] - lat) ** 2 + (c[1] - lon) ** 2) for c in centres]
        i = distances.index(min(distances))
        a, b, n = centres[i]
        centres[i] = [(a * n + lat) / (n + 1), (b * n + lon) / (n + 1), n + 1]
        out.append((i, centres[i][0], centres[i][1]))
    return out


def test_first_hit_replaces_the_seed():
    state = [[a, b, 0.0] for a, b in SEEDS]
    assert sequential_step(state, 40.76, -73.99) == 0
    assert state[0] == [40.76, -73.99, 1.0]


def test_ties_go_to_the_lower_cluster():
    state = [[0.0, 0.0, 1.0], [2.0, 0.0, 1.0]]
    assert sequential_step(state, 1.0, 0.0) == 0


def test_sequential_stream_equals_the_loop(spark):
    rng = random.Random(11)
    rows = [
        (i, BASE + timedelta(seconds=i), "ab"[i % 2], rng.uniform(40.6, 40.9), None if i % 13 == 0 else rng.uniform(-74.1, -73.7))
        for i in range(120)
    ]
    rows[5] = (*rows[5][:3], float("nan"), -73.9)
    schema = "i bigint, ts timestamp_ntz, k string, lat double, lon double"
    folder, out, check = (shared_dir(spark, p) for p in ("points", "moved", "check"))
    for part in (rows[:50], rows[50:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(folder)
        from pyspark.sql import types as T

        stream = spark.readStream.schema(T.StructType.fromDDL(schema)).parquet(folder)
        msg.run_available(sequential_kmeans(stream, "k", ["ts", "i"], "lat", "lon"), out, check)
    got = spark.read.parquet(out).orderBy("key", "seq").collect()
    for key in "ab":
        usable = [(r[3], r[4]) for r in rows if r[2] == key and r[4] is not None and not math.isnan(r[3])]
        mine = [(r["cluster_id"], r["lat"], r["lng"]) for r in got if r["key"] == key]
        want = plain_kmeans(usable)
        assert [m[0] for m in mine] == [w[0] for w in want]
        assert mine[-1][1:] == pytest.approx(want[-1][1:])


def test_microbatch_of_one_point_equals_the_loop(spark, tmp_path):
    points = [(40.76, -73.98), (40.71, -74.0), (40.72, -74.01), (40.73, -73.93)]
    job = MicroBatchKMeans(str(tmp_path), "lat", "lon")
    for i, p in enumerate(points):
        job(spark.createDataFrame([p], "lat double, lon double"), i)
    want = {i: (a, b) for i, a, b in plain_kmeans(points)}
    got = {r["cluster_id"]: (r["lat"], r["lng"]) for r in job.centroids(spark, len(points) - 1).collect()}
    assert got == {i: pytest.approx(v) for i, v in want.items()}


def test_microbatch_ignores_unusable_points(spark, tmp_path):
    job = MicroBatchKMeans(str(tmp_path), "lat", "lon")
    job(spark.createDataFrame([(None, 1.0), (float("nan"), -73.0)], "lat double, lon double"), 0)
    rows = job.centroids(spark, 0).orderBy("cluster_id").collect()
    assert [(r["lat"], r["lng"], r["weight"]) for r in rows] == [(a, b, 0) for a, b in SEEDS]


def test_messages_round_trip(spark):
    row = (datetime(2024, 1, 2, 3, 4, 5, 678), "Queens", 12.5, 2, None, 40.7, -73.9)
    df = spark.createDataFrame([row], msg.TRIP_MESSAGE)
    sent = msg.to_keyed_json(df, "pickup_borough")
    assert sent.first()["key"] == "Queens" and '"pickup_datetime":"2024-01-02T03:04:05.000678"' in sent.first()["value"]
    assert tuple(msg.parse_json(sent, keep_key=False).first()) == row
    bad = spark.createDataFrame([("k", "not json"), ("k", '{"total_amount": "x"}')], "key string, value string")
    assert [r["total_amount"] for r in msg.parse_json(bad).collect()] == [None, None]


def test_topic_reader_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        msg.topic_stream(spark, "broker:9092", "trips")

import random
import statistics
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripkit.operators import selection as sel
from tripkit.streaming.rolling import RollingStream, live_runs, rolling_average_spec, rolling_batch, rolling_stats_spec


def test_exact_median_matches_statistics(spark):
    rng = random.Random(7)
    rows = [("hot", rng.choice([5.0, 5.0, 7.25, rng.uniform(-1e6, 1e6)])) for _ in range(3000)]
    rows += [("even", v) for v in (1.0, 2.0, 10.0, 11.0)] + [("one", -3.5)] + [("tiny", v) for v in (1e-300, 2e-300, 5e-301)]
    rows += [(None, 4.0), (None, 6.0), ("hot", None), ("hot", float("nan")), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["m"] for r in sel.exact_median(df, "v", ["g"], name="m").collect()}
    groups = {}
    for g, v in rows:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    assert got == {g: pytest.approx(statistics.median(vs)) for g, vs in groups.items()}
    overall = sel.exact_median(df, "v", name="m").collect()
    assert [r["m"] for r in overall] == [pytest.approx(statistics.median([v for vs in groups.values() for v in vs]))]


def test_global_median_of_nothing_is_one_null_row(spark):
    df = spark.createDataFrame([], "v double")
    assert [tuple(r) for r in sel.exact_median(df, "v", name="m").collect()] == [(None,)]


def test_sample_is_the_smallest_by_order(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string").substr(1, 1)))
    order = sel.seeded_order("id")
    got = sel.sample_per_group(df, ["g"], 40, order=order, tie=["id"]).toPandas()
    everything = df.withColumn("o", order).toPandas().sort_values(["o", "id"])
    want = everything.groupby("g").head(40)
    assert set(got["id"]) == set(want["id"])


def test_sample_with_equal_order_values(spark):
    df = spark.range(100).withColumn("g", F.lit(1))
    got = sel.sample_per_group(df, ["g"], 7, order=F.lit(3).cast("bigint"), tie=["id"]).collect()
    assert sorted(r["id"] for r in got) == list(range(7))


def test_balanced_sample_skips_incomplete_batches(spark):
    rows = [(1, "a", i) for i in range(50)] + [(1, "b", i) for i in range(50, 60)] + [(2, "a", i) for i in range(60, 70)]
    df = spark.createDataFrame(rows, "batch int, kind string, id bigint")
    got = sel.balanced_sample(df, ["batch"], "kind", ["a", "b"], order=sel.seeded_order("id"), tie=["id"]).toPandas()
    assert got.groupby(["batch", "kind"]).size().to_dict() == {(1, "a"): 10, (1, "b"): 10}
    capped = sel.balanced_sample(df, ["batch"], "kind", ["a", "b"], order=sel.seeded_order("id"), tie=["id"], cap=4)
    assert capped.count() == 8


def test_top_k_ties_go_to_the_smaller_key(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), (None, 5)], "k string, n bigint")
    assert [r["k"] for r in sel.top_k(df, 3, "n", ["k"]).collect()] == ["c", "a", "b"]


def _records(n, seed=3):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 else rng.choice(["x", "y", None])
        amount = None if i % 11 == 0 else rng.uniform(0, 50)
        rows.append((i, start + timedelta(seconds=rng.randrange(0, 40 * 86400)), key, amount, rng.randrange(6), rng.uniform(0, 9)))
    return rows


SCHEMA = "id bigint, ts timestamp_ntz, key string, fare double, psg int, dist double"


def _expected(rows, size):
    frame = pd.DataFrame(rows, columns=["id", "ts", "key", "fare", "psg", "dist"]).sort_values(["ts", "id"])
    frame["fare"] = frame["fare"].fillna(0.0)
    out = {}
    for key, part in frame.groupby("key", dropna=False):
        rolled = part["fare"].rolling(size, min_periods=2)
        for seq, (i, mean, std) in enumerate(zip(part["id"], rolled.mean(), rolled.std()), start=1):
            if seq >= 2:
                out[i] = (seq, mean, std)
    return out


def test_rolling_batch_with_small_blocks(spark, monkeypatch):
    rows = _records(700)
    spec = rolling_stats_spec("key", ["ts", "id"], "fare", "psg", "dist", size=10)
    numbered = sel.numbered(
        spark.createDataFrame(rows, SCHEMA).fillna({"fare": 0.0}), "key", ["ts", "id"], F.to_date("ts")
    )
    got = sel.rolling_last_n(numbered, "key", 10, spec.aggregates, block=13).where("seq >= 2").collect()
    want = _expected(rows, 10)
    assert len(got) == len(want)
    for r in got:
        seq, mean, std = want[r["id"]]
        assert r["seq"] == seq and r["mean_fare"] == pytest.approx(mean) and r["std_fare"] == pytest.approx(std, abs=1e-9)


def test_rolling_batch_default_blocks(spark):
    rows = _records(400, seed=5)
    spec = rolling_stats_spec("key", ["ts", "id"], "fare", "psg", "dist")
    got = {r["id"]: r for r in rolling_batch(spark.createDataFrame(rows, SCHEMA), spec).collect()}
    want = _expected(rows, 100)
    assert set(got) == set(want)
    assert all(got[i]["mean_fare"] == pytest.approx(w[1]) for i, w in want.items())


def test_rolling_stream_replays_a_batch_after_a_failure(spark, tmp_path):
    """The same micro-batch run twice leaves the same state and output."""
    rows = sorted(_records(300, seed=9), key=lambda r: (r[1], r[0]))
    spec = rolling_average_spec("key", ["ts", "id"], "fare")
    job = RollingStream(spec, str(tmp_path / "state"), str(tmp_path / "out"))
    first, second = (spark.createDataFrame(part, SCHEMA) for part in (rows[:140], rows[140:]))
    job(first, 0)
    job(second, 1)
    job(second, 1)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("id").toPandas()
    want = rolling_batch(spark.createDataFrame(rows, SCHEMA), spec).orderBy("id").toPandas()
    assert got["id"].tolist() == want["id"].tolist()
    assert got["seq"].tolist() == want["seq"].tolist()
    assert got["rolling_avg"].tolist() == want["rolling_avg"].tolist()


def test_stream_state_follows_the_touched_keys(spark, tmp_path):
    """A batch of two keys writes the state of two keys; results stay those of one batch job, merges included."""
    spec = rolling_average_spec("key", ["ts", "id"], "fare")
    job = RollingStream(spec, str(tmp_path / "state"), str(tmp_path / "out"))
    start, rows, batches = datetime(2024, 1, 1), [], []
    for batch in range(7):
        keys = range(200) if batch == 0 else [batch, 7]
        part = [(len(rows) + i, start + timedelta(minutes=len(rows) + i), f"k{k}", float(k + i), 1, 1.0) for i, k in enumerate(list(keys) * 3)]
        rows += part
        batches.append(part)
    written = []
    for i, part in enumerate(batches):
        job(spark.createDataFrame(part, SCHEMA), i)
        written.append(spark.read.parquet(job._place(live_runs(i + 1)[-1])).count())
    assert written[0] == 600 and written[2] == written[4] == written[6] == 8  # two keys with four rows each
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("id").toPandas()
    want = rolling_batch(spark.createDataFrame(rows, SCHEMA), spec).orderBy("id").toPandas()
    assert got["seq"].tolist() == want["seq"].tolist() and got["rolling_avg"].tolist() == want["rolling_avg"].tolist()


def test_runs_of_batches_are_binary_digits():
    assert live_runs(0) == [] and live_runs(6) == [(2, 0), (1, 2)] and live_runs(7) == [(2, 0), (1, 2), (0, 6)]
    for n in range(1, 200):
        kept = [run for run in live_runs(n) if run in live_runs(n - 1)]
        assert live_runs(n)[:-1] == kept  # one new run, which ends with the last batch

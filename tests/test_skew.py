"""A third of all rows share one key: the work must still be spread, and the result whole."""

import re
import statistics

import pytest
from pyspark.sql import functions as F

from tripkit.operators.proximity import nearest_place, within_distance
from tripkit.operators import selection
from tripkit.operators.selection import exact_median, rolling_last_n, sample_per_group, seeded_order

ROWS = 120_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


@pytest.fixture()
def tight(spark):
    """Thresholds so low that tiny tables behave like huge ones."""
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_points(spark):
    """A third of the points inside one cell, the others spread wide."""
    r = spark.range(0, ROWS, 1, 8)
    hot = F.col("id") % 3 == 0
    return r.select(
        "id",
        F.when(hot, (F.col("id") % 97).cast("double")).otherwise(F.pmod(F.col("id") * 7919, F.lit(500_000)).cast("double")).alias("x"),
        F.when(hot, (F.col("id") % 89).cast("double")).otherwise(F.pmod(F.col("id") * 6271, F.lit(500_000)).cast("double")).alias("y"),
    )


def places(spark):
    return spark.range(0, 3000).select(
        F.col("id").alias("pid"),
        F.pmod(F.col("id") * 104_729, F.lit(500_000)).cast("double").alias("px"),
        F.pmod(F.col("id") * 15_485_863, F.lit(500_000)).cast("double").alias("py"),
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_cell_of_a_distance_join_is_split(tight):
    joined = within_distance(hot_points(tight), places(tight), 1000.0, point=("x", "y"), place=("px", "py"))
    assert re.search(r"skewed|isSkew=true|SortMergeJoin\(skew=true\)", final_plan(joined))
    assert joined.select("id").distinct().count() == ROWS


def test_nearest_place_keeps_every_point(tight):
    found = nearest_place(
        hot_points(tight), places(tight), point=("x", "y"), place=("px", "py"), place_id="pid", carry={"pid": "best"}, distance="d"
    )
    row = found.agg(F.count(F.lit(1)), F.count("best"), F.countDistinct("id")).first()
    assert tuple(row) == (ROWS, ROWS, ROWS)




def keyed(spark, rows):
    """Two keys, one of them with all but the last hundred rows."""
    key = F.when(F.col("id") < rows - 100, F.lit("hot")).otherwise(F.lit("cold"))
    return spark.range(0, rows, 1, 8).withColumn("key", key)


def test_rolling_blocks_spread_a_hot_key(spark):
    rows = keyed(spark, 60_100).select("key", (F.col("id") + 1).alias("seq"), (F.col("id") % 10).cast("double").alias("v"))
    hot = rows.where("seq <= 60000")
    out = rolling_last_n(hot, "key", 10, {"m": lambda frame: F.avg("v").over(frame)}, block=1000)
    assert re.search(r"hashpartitioning\(key#\d+, _blk#\d+", final_plan(out))
    assert tuple(out.where("seq >= 10").agg(F.min("m"), F.max("m"), F.count(F.lit(1))).first()) == (4.5, 4.5, 59_991)


def test_sample_ranks_slices_of_a_hot_group(spark):
    got = sample_per_group(keyed(spark, 60_000), ["key"], 500, order=seeded_order("id"), tie=["id"])
    assert re.search(r"hashpartitioning\(key#\d+, _b#\d+", final_plan(got))
    assert {r["key"]: r["count"] for r in got.groupBy("key").count().collect()} == {"hot": 500, "cold": 100}


def test_median_of_a_hot_group_narrows_to_few_rows(spark, monkeypatch):
    rows = keyed(spark, 60_101).withColumn("v", F.sqrt("id"))
    sizes, real = [], selection._open_groups
    monkeypatch.setattr(selection, "_open_groups", lambda bounds: sizes.append(real(bounds)) or sizes[-1])
    got = exact_median(rows, "v", ["key"], name="m", sorted_rows=200)
    assert {r["key"]: r["m"] for r in got.collect()}["hot"] == pytest.approx(30_000**0.5)
    assert sizes[0][1] > 200 >= sizes[-1][1]  # no more rows of a group than that are sorted in a task


@pytest.mark.parametrize("make", [
    lambda i: F.lit(1_700_000_000.0) + F.pmod(i * 7919, F.lit(40_000)) / 1000,  # a narrow range far from zero
    lambda i: F.when(i % 2 == 0, F.lit(1.0)).otherwise(F.lit(1.0000000000000002)),  # neighbouring numbers
    lambda i: F.exp(i / 30.0) * F.when(i % 3 == 0, -1).otherwise(1),  # many magnitudes
    lambda i: F.when(i % 10 < 7, F.lit(3.25)).otherwise(i.cast("double")),  # one value most of the time
    lambda i: F.when(i % 5 == 0, F.lit(float("inf"))).when(i % 5 == 1, F.lit(float("-inf"))).otherwise(-i.cast("double")),
])
def test_medians_of_hard_distributions(spark, make):
    for count in (4001, 4000):
        rows = spark.range(count).select(make(F.col("id")).cast("double").alias("v")).persist()
        want = statistics.median([r.v for r in rows.collect()])
        got = exact_median(rows, "v", name="m", sorted_rows=10).collect()
        assert [r["m"] for r in got] == [pytest.approx(want, rel=1e-15)]


def test_half_of_all_rows_at_one_time(spark):
    """Rows of one key and one stamp are ranked in many tasks, by their tie-break."""
    at = F.when(F.col("id") % 2 == 0, F.lit(7_000)).otherwise(F.col("id"))
    rows = spark.range(40_000).select("id", F.lit("k").alias("key"), at.alias("at"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("tie"))
    got = selection.numbered(rows, "key", ["at", "tie", "id"], F.floor(F.col("at") / 1000), slice_rows=1000)
    assert re.search(r"hashpartitioning\(key#\d+, _bkt#\d+L?, _sub#\d+", final_plan(got))
    found = sorted(map(tuple, got.select("seq", "id").collect()))
    want = sorted((r.at, r.tie, r.id) for r in rows.collect())
    assert [i for _, i in found] == [i for *_, i in want] and [n for n, _ in found] == list(range(1, 40_001))


def test_sample_of_equal_orders_is_cut_by_the_tie(spark):
    rows = spark.range(30_000).select("id", F.when(F.col("id") < 100, F.lit(None)).otherwise(F.lit("g")).alias("g"))
    got = sample_per_group(rows, ["g"], 1234, order=F.lit(5), tie=["id"], slice_rows=500)
    ids = {None: set(), "g": set()}
    for r in got.collect():
        ids[r.g].add(r.id)
    assert ids == {None: set(range(100)), "g": set(range(100, 1334))}

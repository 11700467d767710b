import math
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripkit.operators.proximity import TimeWindow, closest_event, nearest_place, spacetime_join, within_distance

BASE = datetime(2024, 1, 1)


def cloud(n, seed, spread=50_000.0):
    """Points of which a third sit in one spot and a third in one tiny cluster."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if i % 3 == 0:
            x, y = 1234.5, -777.25
        elif i % 3 == 1:
            x, y = 9000 + rng.uniform(0, 3), 9000 + rng.uniform(0, 3)
        else:
            x, y = rng.uniform(-spread, spread), rng.uniform(-spread, spread)
        out.append((i, x, y, BASE + timedelta(seconds=rng.randrange(0, 10 * 86400))))
    return out


def frames(spark, points, places):
    p = spark.createDataFrame(points, "id bigint, x double, y double, at timestamp_ntz")
    q = spark.createDataFrame([(*r, f"n{r[0]}") for r in places], "pid bigint, px double, py double, start timestamp_ntz, name string")
    return p, q


def d2(a, b):
    dx, dy = a[1] - b[1], a[2] - b[2]
    return dx * dx + dy * dy


@pytest.mark.parametrize("n_places", [1, 40, 900])
def test_nearest_equals_brute_force(spark, n_places):
    points = cloud(400, 1) + [(9001, None, 3.0, BASE), (9002, float("nan"), 3.0, BASE), (9003, 9e6, -8e6, BASE)]
    places = cloud(n_places, 2) + [(5000, None, 1.0, BASE), (5001, float("inf"), 1.0, BASE)]
    p, q = frames(spark, points, places)
    got = nearest_place(
        p, q, point=("x", "y"), place=("px", "py"), place_id="pid", carry={"pid": "best", "name": "label"}, distance="dist"
    ).collect()
    usable = [r for r in places if r[1] is not None and math.isfinite(r[1])]
    assert len(got) == len(points)
    for r in got:
        if r["id"] in (9001, 9002):
            assert r["best"] is None and r["dist"] is None
            continue
        me = (r["id"], r["x"], r["y"])
        best = min(usable, key=lambda c: (d2(me, c), c[0]))
        assert r["best"] == best[0] and r["label"] == f"n{best[0]}"
        assert r["dist"] == pytest.approx(math.sqrt(d2(me, best)))


def test_nearest_without_places(spark):
    p, q = frames(spark, cloud(5, 1), [(1, None, None, BASE)])
    got = nearest_place(p, q, point=("x", "y"), place=("px", "py"), place_id="pid", carry={"name": "n"}, distance="d")
    assert got.columns == ["id", "x", "y", "at", "d", "n"]
    assert all(r["n"] is None and r["d"] is None for r in got.collect())


@pytest.mark.parametrize("hours", [0.5, 30.0, 520 * 7 * 24.0])
def test_closest_event_equals_brute_force(spark, hours):
    points, events = cloud(250, 3), cloud(600, 4)
    p, q = frames(spark, points, events)
    found = closest_event(p, q, TimeWindow("at", "start", hours * 3600), point=("x", "y"), place=("px", "py"), event_id="pid").collect()
    assert len(found) == len(points)
    for r in found:
        me = (r["id"], r["x"], r["y"])
        near = [e for e in events if abs((e[3] - r["at"]).total_seconds()) <= hours * 3600]
        if not near:
            assert r["closest_event_id"] is None
            continue
        best = min(near, key=lambda e: (d2(me, e), e[0]))
        # Several events may share the place and differ in time; the id decides.
        assert r["closest_event_id"] == best[0]
        assert r["closest_event_time_diff"] == pytest.approx((best[3] - r["at"]).total_seconds() / 3600)


def test_window_edge_counts(spark):
    p, q = frames(spark, [(1, 0.0, 0.0, BASE)], [(7, 1.0, 0.0, BASE + timedelta(hours=2)), (8, 0.5, 0.0, BASE + timedelta(hours=2, microseconds=1))])
    r = closest_event(p, q, TimeWindow("at", "start", 7200), point=("x", "y"), place=("px", "py"), event_id="pid").first()
    assert r["closest_event_id"] == 7


@pytest.mark.parametrize("salts", [1, 5])
def test_within_distance_equals_brute_force(spark, salts):
    points, places = cloud(200, 5) + [(900, None, 0.0, BASE)], cloud(150, 6)
    p, q = frames(spark, points, places)
    radius = 4000.0
    want = {(a[0], b[0]) for a in points for b in places if a[1] is not None and d2(a, b) <= radius**2}
    alone = {a[0] for a in points} - {a for a, _ in want}
    got = within_distance(p, q, radius, point=("x", "y"), place=("px", "py"), salts=salts).select("id", "pid").collect()
    assert len(got) == len(want) + len(alone)
    assert {(r[0], r[1]) for r in got} == want | {(a, None) for a in alone}
    inner = within_distance(p, q, radius, point=("x", "y"), place=("px", "py"), how="inner", salts=salts)
    assert inner.count() == len(want)


def test_distance_exactly_radius(spark):
    p, q = frames(spark, [(1, 0.0, 0.0, BASE)], [(2, 100.0, 0.0, BASE), (3, 100.0001, 0.0, BASE)])
    got = within_distance(p, q, 100.0, point=("x", "y"), place=("px", "py")).collect()
    assert [r["pid"] for r in got] == [2]


@pytest.mark.parametrize("semantics", ["left", "inner", "filter_after"])
def test_spacetime_equals_brute_force(spark, semantics):
    points, events = cloud(150, 7), cloud(200, 8)
    p, q = frames(spark, points, events)
    radius, hours = 3000.0, 6.0
    got = spacetime_join(
        p, q, radius, TimeWindow("at", "start", hours * 3600), point=("x", "y"), place=("px", "py"), semantics=semantics
    ).select("id", "pid").collect()
    near = {(a[0], b[0]): abs((a[3] - b[3]).total_seconds()) <= hours * 3600 for a in points for b in events if d2(a, b) <= radius**2}
    want = {pair for pair, soon in near.items() if soon}
    if semantics == "left":
        want |= {(a[0], None) for a in points if a[0] not in {i for i, _ in want}}
    elif semantics == "filter_after":
        want |= {(a[0], None) for a in points if a[0] not in {i for i, _ in near}}
    assert {(r[0], r[1]) for r in got} == want and len(got) == len(want)


def test_listed_places_are_not_broadcast(spark):
    """20,000 places are listed 180,000 times and more; Spark sees only the places."""
    hour = F.timestamp_add("SECOND", (F.col("id") % 86_400).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    x, y = (F.col("id") * 7919 % 70_001).cast("double"), (F.col("id") * 6271 % 70_003).cast("double")
    p = spark.range(500).select("id", x.alias("x"), y.alias("y"), hour.alias("at"))
    q = spark.range(20_000).select(F.col("id").alias("pid"), x.alias("px"), y.alias("py"), hour.alias("start"))
    window = TimeWindow("at", "start", 3600)
    for semantics in ("left", "inner", "filter_after"):
        got = spacetime_join(p, q, 5000.0, window, point=("x", "y"), place=("px", "py"), semantics=semantics)
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "_gx" not in "".join(re.findall(r"BroadcastHashJoin.*", plan))


def test_filter_after_with_a_spot_just_out_of_reach(spark):
    """Points at a radius and the next number beyond it; places without a time, points without a position."""
    far = math.nextafter(100.0, 200.0)
    points = [(1, 0.0, 0.0, BASE), (2, -(far - 100.0), 0.0, BASE), (3, None, 0.0, BASE), (4, 5000.0, 0.0, BASE), (5, 300.0, 0.0, BASE)]
    p, q = frames(spark, points, [(7, 100.0, 0.0, BASE), (8, 4950.0, 0.0, None), (9, 350.0, 0.0, BASE + timedelta(days=2))])
    got = spacetime_join(p, q, 100.0, TimeWindow("at", "start", 3600), point=("x", "y"), place=("px", "py"), semantics="filter_after")
    assert got.columns == [*p.columns, *q.columns]
    assert {(r["id"], r["pid"]) for r in got.collect()} == {(1, 7), (2, None), (3, None), (4, 8)}


def test_places_are_listed_a_few_times(spark):
    """A shuffled place is one row per cell it reaches: 2 per dimension on average, 8 with time, not 27."""
    places = spark.range(3000).select(
        F.col("id").alias("pid"), (F.col("id") * 7919 % 70_001 / 1.0).alias("px"), (F.col("id") * 6271 % 70_003 / 1.0).alias("py"),
        F.timestamp_add("SECOND", (F.col("id") * 104_729 % 864_000).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("start"),
    )
    points = spark.createDataFrame([(1, 35_000.0, 35_000.0, BASE)], "id bigint, x double, y double, at timestamp_ntz")
    joined = within_distance(points, places, 5000.0, point=("x", "y"), place=("px", "py"), how="inner", time=TimeWindow("at", "start", 3600))
    listed = joined._jdf.queryExecution().analyzed()
    while not listed.toString().startswith("Join"):
        listed = listed.children().head()
    side = listed.children().last()
    rows = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, side).count()
    assert 3000 * 7 < rows < 3000 * 9


@pytest.mark.parametrize("radius", [0.001, 7.0, 1e6])
def test_edges_of_cells(spark, radius):
    """Points and places on the edges of cells and exactly a radius apart, near zero and far from it."""
    spots = [base + k * radius / 2 for base in (0.0, -3e7, 1e7 + 0.1) for k in range(-6, 7)]
    points = [(i, v, v / 2, BASE + timedelta(seconds=1800 * (i % 9))) for i, v in enumerate(spots)]
    places = [(i, v, v / 2, BASE + timedelta(seconds=1800 * (i % 7))) for i, v in enumerate(spots)]
    p, q = frames(spark, points, places)
    near = lambda a, b: (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 <= radius**2 and abs((a[3] - b[3]).total_seconds()) <= 3600
    got = within_distance(p, q, radius, point=("x", "y"), place=("px", "py"), how="inner", time=TimeWindow("at", "start", 3600)).select("id", "pid").collect()
    want = {(a[0], b[0]) for a in points for b in places if near(a, b)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)

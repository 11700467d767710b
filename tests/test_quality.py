from datetime import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tripkit.operators import quality as q
from tripkit.operators.analytics import yearly_market_share
from tripkit.schemas import FHV, FHVHV, GREEN, SERVICES, YELLOW, FareRule

P0 = dt(2020, 5, 1, 12)


def flags(spark, rule, schema, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(rule).collect()]


def test_timestamps(spark):
    rule = q.valid_timestamps("p", "d", (2011, 2025))
    rows = [
        (P0, P0), (dt(2019, 12, 31, 23, 50), dt(2020, 1, 1, 0, 10)), (dt(2019, 12, 31, 23), dt(2020, 1, 2)),
        (dt(2019, 12, 30), dt(2020, 1, 1)), (dt(2010, 6, 1), dt(2010, 6, 2)), (dt(2026, 1, 1), dt(2026, 1, 2)), (P0, None),
        (None, P0), (P0, P0 + timedelta(seconds=1)), (dt(2018, 12, 31), dt(2020, 1, 1)),
    ]
    want = [False, True, False, False, False, False, False, False, True, False]
    assert flags(spark, rule, "p timestamp_ntz, d timestamp_ntz", rows) == want


def test_distance(spark):
    rule = q.valid_distance("x", "p", "d")
    rows = [
        (P0, P0 + timedelta(seconds=60), 1.0), (P0, P0 + timedelta(hours=6), 1.0), (P0, P0 + timedelta(seconds=59), 0.5),
        (P0, P0 + timedelta(hours=6, seconds=1), 1.0), (P0, P0 + timedelta(hours=1), 0.0), (P0, P0 + timedelta(hours=1), 80.0),
        (P0, P0 + timedelta(hours=1), 79.9), (P0, P0 + timedelta(hours=1), None), (P0, P0 + timedelta(hours=1), float("nan")),
        (P0, None, 1.0),
    ]
    want = [True, True, False, False, False, False, True, False, False, False]
    assert flags(spark, rule, "p timestamp_ntz, d timestamp_ntz, x float", rows) == want


def test_distance_by_seconds(spark):
    rule = q.valid_distance("x", seconds="s")
    rows = [(60.0, 1.0), (21600.0, 1.0), (59.0, 0.1), (3600.0, 80.0), (float("nan"), 1.0), (None, 1.0)]
    assert flags(spark, rule, "s float, x float", rows) == [True, True, False, False, False, False]


def test_coordinates(spark):
    rule = q.valid_coordinates([("lon", "lat")])
    rows = [
        (-74.248064, 40.505232), (-73.708116, 40.908582), (-74.2481, 40.6), (-74.0, 40.9086), (None, 40.6),
        (float("nan"), 40.6), (-74.0, float("nan")), (-74.0, 40.7),
    ]
    assert flags(spark, rule, "lon float, lat float", rows) == [True, True, False, False, False, False, False, True]


PRICE = FareRule(flag="bad_prices", fare="fare", total="total", non_negative=("fee", "tip"), summed=("fare", "fee"))


def test_prices(spark):
    rows = [
        (2.5, 1.0, 0.0, 10.0), (2.6, 0.0, 0.0, 2.6), (490.0, 10.0, 0.0, 500.0), (490.0, 10.0, 0.0, 500.5), (5.0, 6.0, 0.0, 10.0),
        (5.0, None, 0.0, 10.0), (5.0, float("nan"), 0.0, 10.0), (5.0, -0.5, 0.0, 10.0), (5.0, 1.0, None, 10.0), (5.0, 1.0, 0.0, None),
        (5.0, 1.0, 9.0, 6.0),
    ]
    want = [False, True, True, False, False, False, False, False, False, False, True]
    assert flags(spark, q.valid_fares(PRICE), "fare float, fee float, tip float, total float", rows) == want


def test_fares_sum(spark):
    rule = q.valid_fares(FareRule(flag="bad_fares", non_negative=("a", "b"), summed=("a", "b")))
    rows = [(0.0, 0.0), (600.0, 400.0), (600.0, 400.5), (-1.0, 2.0), (None, 1.0)]
    assert flags(spark, rule, "a float, b float", rows) == [True, True, False, False, False]


def test_request_time(spark):
    day = timedelta(days=1)
    rows = [(P0, P0), (P0 - day, P0), (P0 - day - timedelta(seconds=1), P0), (P0 + timedelta(seconds=1), P0), (None, P0)]
    got = flags(spark, q.valid_request_time("r", "p"), "r timestamp_ntz, p timestamp_ntz", rows)
    assert got == [True, True, False, False, False]


def test_profiles_name_their_flags():
    assert YELLOW.issue_flags == ["bad_timestamps", "bad_distance", "bad_coordinates", "bad_prices"]
    assert GREEN.issue_flags == YELLOW.issue_flags
    assert FHV.issue_flags == ["bad_timestamps", "bad_coordinates"]
    assert FHVHV.issue_flags == ["bad_timestamps", "bad_distance", "bad_coordinates", "bad_fares", "bad_request_time"]
    assert [len(p.columns) for p in (YELLOW, GREEN, FHV, FHVHV)] == [27, 28, 14, 32]


def test_report_derives_clean_and_survives_zero(spark):
    stats = spark.createDataFrame([(2020, 0, 0, 0), (2020, 0, 0, 0)], "year int, total_trips bigint, bad_timestamps bigint, bad_fares bigint")
    rows = q.dq_report(stats).orderBy("position").collect()
    assert [(r["error_type"], r["trips"], r["pct_of_all"]) for r in rows] == [
        ("Timestamp issues", 0, 0.0), ("Pricing issues", 0, 0.0), ("Invalid trips", 0, 0.0), ("Clean trips", 0, 0.0),
    ]
    stats = spark.createDataFrame([(2020, 10, 2, 1)], "year int, total_trips bigint, bad_timestamps bigint, bad_fares bigint")
    assert [r["trips"] for r in q.dq_report(stats).orderBy("position").collect()] == [2, 1, 3, 7]


# Published clean trips of some years, and the market shares published for the same years.
CLEAN = [
    ("Yellow", 2014, 160317330), ("Green", 2014, 15315083), ("Yellow", 2017, 110254566), ("Green", 2017, 11372099),
    ("FHV", 2017, 92334557), ("Yellow", 2019, 82193460), ("Green", 2019, 6010483), ("FHV", 2019, 23014032),
    ("FHVHV", 2019, 225615343), ("Yellow", 2025, 17912604), ("Green", 2025, 227159), ("FHV", 2025, 1227427),
    ("FHVHV", 2025, 95741634), ("Yellow", 2011, 3),
]
SHARES = {
    2011: (100.0, 0.0, 0.0, 0.0), 2014: (91.28, 8.72, 0.0, 0.0), 2017: (51.53, 5.32, 43.15, 0.0),
    2019: (24.4, 1.78, 6.83, 66.98), 2025: (15.56, 0.2, 1.07, 83.17),
}


def test_market_share_matches_published_figures(spark):
    counts = spark.createDataFrame(CLEAN, "service string, year int, num_trips bigint")
    rows = yearly_market_share(counts, SERVICES).collect()
    assert {r["year"]: tuple(r[s] for s in SERVICES) for r in rows} == SHARES


def test_year_without_trips_has_zero_shares(spark):
    counts = spark.createDataFrame([("Yellow", 2020, 0)], "service string, year int, num_trips bigint")
    assert tuple(yearly_market_share(counts, SERVICES).first()) == (2020, 0.0, 0.0, 0.0, 0.0)


def test_flags_bound_the_invalid_rows(spark):
    df = spark.range(1000).select(
        F.timestamp_add("HOUR", (F.col("id") * 9).cast("int"), F.lit(dt(2010, 12, 1)).cast("timestamp_ntz")).alias("p"),
        F.timestamp_add("HOUR", (F.col("id") * 9 + F.col("id") % 9).cast("int"), F.lit(dt(2010, 12, 1)).cast("timestamp_ntz")).alias("d"),
        (F.col("id") % 50).cast("float").alias("x"), F.lit(2011).alias("year"),
    )
    rules = {"bad_timestamps": q.valid_timestamps("p", "d", (2011, 2025)), "bad_distance": q.valid_distance("x", "p", "d")}
    r = q.stats_by_year(q.flag_issues(df, rules), list(rules)).first()
    invalid = r["total_trips"] - r["clean_trips"]
    assert max(r["bad_timestamps"], r["bad_distance"]) <= invalid <= r["bad_timestamps"] + r["bad_distance"]
    assert q.keep_clean(df, rules).count() == r["clean_trips"]
    assert r["bad_timestamps"] > 0 and r["bad_distance"] > 0


def test_conform_names_what_differs(spark):
    from tripkit.operators.schema import conform

    with pytest.raises(ValueError, match="missing columns .*year.* unexpected columns .*extra_one"):
        conform(spark.range(1).withColumn("extra_one", F.lit(1)), FHV.schema)

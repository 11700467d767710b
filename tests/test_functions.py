from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripkit.functions import codes, geo, temporal


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "code, cases",
    [
        (codes.vendor_code, {"CMT": 1, "VTS": 2, "DDS": 2, "2": 2, "6.0": 6, "xyz": -1, None: -1, "NaN": -1, "3": -1}),
        (codes.rate_code, {"1": 1, "99": 99, "7": 99, "2.0": 2, None: 99}),
        (codes.store_and_forward_code, {"Y": 1, " Y": 1, "N ": 0, "0.5": 0, "1.9": 1, "2": -1, None: -1, "NaN": -1}),
        (codes.payment_code, {"No Charge": 3, " CSH ": 2, "crd": 1, "Dispute": 4, "NA": 5, "6": 6, "9": 5, "?": 5, None: 5}),
        (codes.trip_type_code, {"1": 1, "2.0": 2, "0": -1, None: -1}),
        (codes.yes_no_code, {" Y ": 1, "N": 0, "y": -1, "1": -1, None: -1}),
        (codes.operator_name, {"HV0003": "Uber", "HV0005": "Lyft", "HV9": "Other FHVHV", None: "Other FHVHV"}),
        (codes.first_token_int, {"14,18": 14, "7": 7, ",3": None, "x": None, None: None}),
        (codes.whole_number, {"10001": 10001, "10001.0": 10001, "N/A": None, "": None}),
    ],
)
def test_codes(spark, code, cases):
    assert values(spark, code, list(cases)) == list(cases.values())


def test_codes_accept_numbers(spark):
    assert values(spark, codes.vendor_code, [1.0, 2.0, float("nan"), None, -1.0], "double") == [1, 2, -1, -1, -1]
    assert values(spark, codes.rate_code, [1, 8, 99], "bigint") == [1, 99, 99]


def test_texts(spark):
    assert values(spark, codes.thousands, [1234567, 0], "bigint") == ["1,234,567", "0"]
    assert values(spark, codes.percent_text, [0.5, 1.5, 97.4], "double") == ["0%", "2%", "97%"]


def test_hour_rounding_ties_go_to_even(spark):
    rows = [
        dt(2024, 1, 1, 0, 30), dt(2024, 1, 1, 1, 30), dt(2024, 1, 1, 0, 30, 0, 1), dt(1969, 12, 31, 22, 30), dt(1969, 12, 31, 23, 29),
    ]
    want = [dt(2024, 1, 1, 0), dt(2024, 1, 1, 2), dt(2024, 1, 1, 1), dt(1969, 12, 31, 22), dt(1969, 12, 31, 23)]
    assert values(spark, temporal.round_to_hour, rows, "timestamp_ntz") == want


def test_daylight_saving(spark):
    rows = [dt(2024, 11, 3, 5), dt(2024, 11, 3, 6), dt(2024, 3, 10, 6, 59), dt(2024, 3, 10, 7)]
    want = [dt(2024, 11, 3, 1), dt(2024, 11, 3, 1), dt(2024, 3, 10, 1, 59), dt(2024, 3, 10, 3)]
    assert values(spark, temporal.utc_to_local, rows, "timestamp_ntz") == want


def test_skipped_local_hour_is_an_ordinary_time(spark):
    rows = [dt(2024, 3, 10, 2, 30)]  # an hour that New York clocks skip
    assert values(spark, temporal.round_to_hour, rows, "timestamp_ntz") == [dt(2024, 3, 10, 2)]
    assert values(spark, lambda v: temporal.from_micros(temporal.micros(v)), rows, "timestamp_ntz") == rows


def test_bad_datetime_raises_or_is_null(spark):
    assert values(spark, lambda v: temporal.parse_datetime(v, strict=False), ["2024-02-30", "2024-02-29"]) == [None, dt(2024, 2, 29)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, temporal.parse_datetime, ["2024-02-30"])


def test_nanosecond_range(spark):
    rows = [dt(1677, 9, 21), dt(1677, 9, 22), dt(2262, 4, 11), dt(2262, 4, 12), None]
    assert values(spark, temporal.in_nanosecond_range, rows, "timestamp_ntz") == [False, True, True, False, False]


def test_state_plane_known_point_and_inverse(spark):
    df = spark.createDataFrame([(-74.0, 40.0 + 10 / 60), (-73.9857, 40.7484)], "lon double, lat double")
    x, y = geo.STATE_PLANE.forward(F.col("lon"), F.col("lat"))
    back = geo.STATE_PLANE.inverse(F.col("x"), F.col("y"))
    rows = df.withColumns({"x": x, "y": y}).withColumns({"lon2": back[0], "lat2": back[1]}).orderBy("lat").collect()
    assert rows[0]["x"] == pytest.approx(984250.0) and rows[0]["y"] == pytest.approx(0.0, abs=1e-6)
    for r in rows:
        assert (r["lon2"], r["lat2"]) == (pytest.approx(r["lon"], abs=1e-9), pytest.approx(r["lat"], abs=1e-9))
    # A well-known landmark in state-plane feet.
    assert rows[1]["x"] == pytest.approx(988215, abs=30) and rows[1]["y"] == pytest.approx(211949, abs=150)


def test_polygon_centroids(spark):
    texts = [
        "{'type': 'Polygon', 'coordinates': [[[0, 0], [4, 0], [4, 2], [0, 2], [0, 0]]]}",
        '{"type": "MultiPolygon", "coordinates": [[[[0,0],[0,2],[2,2],[2,0],[0,0]]], [[[10,0],[12,0],[12,2],[10,2],[10,0]]]]}',
        "{'type': 'Polygon', 'coordinates': [((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ((2, 1), (2, 3), (3, 3), (3, 1), (2, 1))]}",
        "nonsense",
        None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    x, y = geo.polygons_centroid(F.col("p"))
    rows = df.withColumn("p", geo.parse_polygons(F.col("t"))).select("i", x.alias("x"), y.alias("y")).orderBy("i").collect()
    assert (rows[0]["x"], rows[0]["y"]) == (pytest.approx(2), pytest.approx(1))
    assert (rows[1]["x"], rows[1]["y"]) == (pytest.approx(6), pytest.approx(1))
    assert rows[2]["x"] == pytest.approx((16 * 2 - 2 * 2.5) / 14) and rows[2]["y"] == pytest.approx(2)
    assert rows[3]["x"] is None and rows[4]["x"] is None

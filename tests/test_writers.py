"""Loads of one dataset, and classes and pivots that must not depend on caps and lists."""

import pytest

from pyspark.sql import functions as F

from tripkit.operators import analytics, sketches
from tripkit.operators.metrics import majority_class
from tripkit.plans.trips import classifier_frame
from tripkit.sources import readers, writers


def test_loads_of_one_year_stay_side_by_side(spark, tmp_path):
    root = str(tmp_path / "trips")
    month = lambda first, n, year: spark.range(first, first + n).selectExpr("id", f"{year} AS year")
    stray = spark.createDataFrame([(900, 2023)], "id long, year int")
    january, february = month(0, 100, 2024).union(stray), month(1000, 50, 2024)
    writers.write_by_year(month(5000, 30, 2023), root, load="2023-12")
    writers.write_by_year(january, root, load="2024-01")
    writers.write_by_year(february, root, load="2024-02")
    writers.write_by_year(january, root, load="2024-01")
    got = readers.read_partitioned(spark, root)
    assert sorted(got.columns) == ["id", "year"]
    assert {r.year: r["count"] for r in got.groupBy("year").count().collect()} == {2023: 31, 2024: 150}
    assert readers.read_partitioned(spark, root, 2023).count() == 31


def test_a_load_written_again_leaves_no_year_behind(spark, tmp_path):
    root = str(tmp_path / "trips")
    rows = lambda *years: spark.createDataFrame([(y * 10 + i, y) for y in years for i in range(5)], "id int, year int")
    writers.write_by_year(rows(2021, 2022, 2023), root, load="a", sources=["a1", "a2"])
    writers.write_by_year(rows(2023), root, load="b", sources=["b1"])
    writers.write_by_year(rows(2021, 2023), root, load="a", sources=["a1"])
    count = lambda: {r.year: r["count"] for r in readers.read_partitioned(spark, root).groupBy("year").count().collect()}
    assert count() == {2021: 5, 2023: 10}
    with pytest.raises(ValueError):
        writers.write_by_year(rows(2020), root, load="c", sources=["b1", "c1"])
    writers.write_by_year(rows(2024), root, load="c", sources=["a2"])  # given up by load a
    assert count() == {2021: 5, 2023: 10, 2024: 5}
    assert readers.read_partitioned(spark, root, [2022]).count() == 0 and readers.read_partitioned(spark, root, 2024).count() == 5
    assert len(readers.read_partitioned(spark, root, 2024).inputFiles()) <= len(readers.read_partitioned(spark, root).inputFiles()) // 2
    assert writers.drop_superseded(spark, root) == 1 and writers.drop_superseded(spark, root) == 0
    assert count() == {2021: 5, 2023: 10, 2024: 5}
    writers.write_by_year(rows(), root, load="b")
    assert count() == {2021: 5, 2023: 5, 2024: 5}


def test_a_failed_write_leaves_the_load_as_it_was(spark, tmp_path):
    root = str(tmp_path / "trips")
    writers.write_by_year(spark.range(10).selectExpr("id", "2020 AS year"), root)
    broken = spark.range(10).selectExpr("IF(id < 9, id, raise_error('broken')) AS id", "2020 AS year")
    with pytest.raises(Exception, match="broken"):
        writers.write_by_year(broken, root)
    assert readers.read_partitioned(spark, root).count() == 10


def test_a_cap_would_change_the_majority(spark):
    frame = lambda n: spark.range(n).selectExpr(
        "timestamp_ntz'2020-01-01 10:00:00' AS pickup_datetime", "timestamp_ntz'2020-01-01 10:30:00' AS dropoff_datetime",
        "'A' AS pickup_borough", "'B' AS dropoff_borough", "CAST(3 + id % 7 AS FLOAT) AS trip_distance", "2020 AS year",
    )
    services = {"Yellow": frame(500), "FHVHV": frame(90)}
    assert majority_class(classifier_frame(services, 2020)).first()["service"] == "Yellow"
    assert majority_class(classifier_frame(services, 2020, cap=50)).first()["service"] == "FHVHV"


def test_pivots_show_all_that_occurs(spark):
    shares = spark.createDataFrame([("Y", "A", 0.5), ("Y", "new", 0.5), ("G", "A", 1.0)], "service string, borough string, share double")
    assert set(analytics.borough_share_matrix(shares).columns) == {"service", "A", "new"}
    operators = spark.createDataFrame([("d", "Uber", 0.5), ("d", "Other", 0.5)], "date string, operator string, share double")
    assert analytics.pivot_operator_share(operators).columns == ["date", "Other", "Uber"]


def test_stored_sketches_merge_over_loads(spark, tmp_path):
    root = str(tmp_path / "sketches")
    rows = spark.range(30_000).selectExpr("id", "2020 + id % 2 AS year", "IF(id % 10 = 0, NULL, IF(id % 11 = 0, double('NaN'), id / 7)) AS v", "CAST(NULL AS DOUBLE) AS none")
    values = {"v": F.col("v"), "none": F.col("none")}
    for load in (0, 1, 2, 0):
        sketches.store_sketches(rows.where(f"id % 3 = {load}"), values, root, load=str(load))
    for by in (["year"], []):
        for q in (0.1, 0.5, 0.9):
            got = {r[0] if by else None: r for r in sketches.stored_quantiles(spark, root, ["v", "none"], by, q).collect()}
            for key, r in got.items():
                known = sorted(x.v for x in rows.where("v IS NOT NULL AND NOT isnan(v)").collect() if key in (None, x.year))
                assert r.v_rows == len(known) and r.none_rows == 0 and r.none is None
                assert abs(sum(x < r.v for x in known) / len(known) - q) < 0.005

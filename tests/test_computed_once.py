"""What several passes read is computed once: a counted column runs once per row, whatever the number of passes."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripkit.operators import analytics, selection
from tripkit.operators import features as ft
from tripkit.sources import writers
from workload import learning


def counted(spark, df, column):
    """``df`` with ``column`` passed through a function that counts its calls, and the counter."""
    calls = spark.sparkContext.accumulator(0)
    same = F.udf(lambda value: calls.add(1) or value, df.schema[column].dataType)
    return df.withColumn(column, same(column)), calls


@pytest.mark.parametrize("formats", [writers.FORMATS, ["csv", "json"], ["json", "orc", "csv"]])
def test_formats(spark, tmp_path, formats):
    rows = [(i, f"n{i % 7}", i / 3, datetime(2024, 1, 1) + timedelta(seconds=i)) for i in range(200)] + [(200, None, None, None)]
    df, calls = counted(spark, spark.createDataFrame(rows, "id long, name string, x double, at timestamp_ntz"), "id")
    frames = writers.write_formats(df, str(tmp_path / "formats"), formats)
    assert list(frames) == list(formats) and calls.value == len(rows)
    for frame in frames.values():
        assert frame.columns == df.columns and sorted(map(tuple, frame.collect())) == rows


def test_medians(spark):
    plain = spark.range(5001).select(F.when(F.col("id") % 2 == 0, "a").alias("g"), F.sqrt("id").alias("v"), (-F.col("id")).alias("w"))
    df, calls = counted(spark, plain, "g")
    got = {r.g: r.m for r in selection.exact_median(df, "v", ["g"], name="m", sorted_rows=10).collect()}
    assert got == {"a": pytest.approx(2500**0.5), None: pytest.approx((2499**0.5 + 2501**0.5) / 2)} and calls.value == 5001
    df, calls = counted(spark, plain, "g")
    both = {r.g: (r.v, r.w) for r in selection.exact_medians(df, {"v": F.col("v"), "w": F.col("w")}, ["g"]).collect()}
    assert both["a"] == (pytest.approx(2500**0.5), -2500.0) and calls.value == 5001


def test_service_summary(spark):
    at = datetime(2024, 1, 1)
    rows = [("Yellow", float(i % 3), 5.0 + i, at, at + timedelta(minutes=i)) for i in range(300)] + [("Green", None, None, at, at), (None, 2.0, 1.0, at, at)]
    schema = "service string, tip_amount double, fare_amount double, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz"
    df, calls = counted(spark, spark.createDataFrame(rows, schema), "service")
    got = {r.service: r for r in analytics.service_summary(df).collect()}
    assert calls.value == len(rows) and set(got) == {"Yellow", "Green", None}
    yellow = got["Yellow"]
    assert (yellow.tipped_pct, yellow.median_tip, yellow.median_fare, yellow.median_duration_min) == (pytest.approx(200 / 3), 1.5, 154.5, 150.0)
    assert (got["Green"].tipped_pct, got["Green"].median_tip, got["Green"].median_fare) == (0.0, None, None)


@pytest.mark.parametrize("prepare", [learning._split, learning._training])
def test_training_rows(spark, monkeypatch, prepare):
    row = F.col("id")
    columns = {"l_orderkey": row, "l_partkey": row * 31, "l_linenumber": (row % 7).cast("int"), "year": (row % 4 + 1997).cast("int")}
    columns["service"] = F.element_at(F.array(*[F.lit(c) for c in ft.CLASSES]), (row.bitwiseXOR(F.shiftright(row, 2)) % len(ft.CLASSES) + 1).cast("int"))
    columns |= {name: (row * (i + 3) % 101).cast("double") for i, name in enumerate(ft.NUMERIC)} | {name: F.lit("NA") for name in ft.CATEGORICAL}
    df, calls = counted(spark, spark.range(4000).select(*[c.alias(name) for name, c in columns.items()]), "service")
    monkeypatch.setattr(learning, "_features", lambda spark, sf: df)
    train, valid = prepare(spark, "")
    sizes = {r.service: r["count"] for r in train.groupBy("service").count().collect()}
    assert set(sizes) == set(ft.CLASSES) and len(set(sizes.values())) == 1 and valid.count() == 1000
    assert calls.value == 2000  # the rows of two years, once

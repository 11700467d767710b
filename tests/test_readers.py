"""Footers of files whose schema drifts, and side tables."""

import json

from pyspark.sql import functions as F

from tripkit.sources import readers as rd


def months(spark, root):
    base = spark.range(20)
    base.select(F.col("id").alias("VendorID")).repartition(3).write.parquet(f"{root}/a")
    base.select(F.col("id").cast("double").alias("VendorID")).coalesce(1).write.parquet(f"{root}/b")
    base.select(F.col("id").alias("VendorID")).coalesce(1).write.parquet(f"{root}/c")
    base.select(F.col("id").cast("string").alias("vendor_name")).coalesce(2).write.mode("append").parquet(f"{root}/c")
    return [f"{root}/{name}" for name in "abc"]


def jobs(spark, act):
    tracker, group = spark.sparkContext.statusTracker(), f"count-{id(act)}"
    spark.sparkContext.setJobGroup(group, "counted")
    result = act()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group)), result


def test_all_footers_in_one_job(spark, tmp_path):
    paths = months(spark, str(tmp_path))
    count, groups = jobs(spark, lambda: rd.schema_groups(spark, paths))
    assert count == 1
    sizes = sorted((len(g), any("part-" in p for p in g)) for g in groups)
    assert len(groups) == 3 and (1, False) in sizes  # b alone; a with one file of c; the other files of c
    rows = rd.read_drifted(spark, paths, {"vendor_id": "double"})
    assert rows.columns == ["vendor_id"] and sorted(r.vendor_id for r in rows.collect()) == sorted([float(i) for i in range(20)] * 4)


def test_footers_hold_counts_and_fields(spark, tmp_path):
    paths = months(spark, str(tmp_path))
    read = rd.footers(rd.list_files(spark, paths)).collect()
    assert sum(r.num_rows for r in read) == 80 and all(r.row_groups >= 0 for r in read)
    assert {json.loads(r.fields)[0][0] for r in read} == {"VendorID", "vendor_name"}
    stored = rd.stored_rows(spark, {"one": paths[:1], "two": paths[1:]})
    assert {(r.service, r.num_rows) for r in stored.collect()} == {("one", 20), ("two", 60)}


def test_stores_that_only_spark_opens(spark, tmp_path, monkeypatch):
    paths = months(spark, str(tmp_path))
    unread = rd.list_files(spark, paths).selectExpr("path", "cast(null as string) fields", "cast(null as long) num_rows", "cast(null as int) row_groups")
    monkeypatch.setattr(rd, "footers", lambda files: unread)
    assert len(rd.schema_groups(spark, paths)) == 3
    assert rd._read_footer("nowhere://host/file.parquet") == (None, None, None)


def test_zones_and_projected_centroids(spark, tmp_path):
    (tmp_path / "zones.csv").write_text('LocationID,Borough,Zone,centroid_lat,centroid_lng\n1,Queens,"A, b",40.5,-73.9\nx,Bronx,C,,z\n')
    rows = rd.read_zones(spark, str(tmp_path / "zones.csv")).collect()
    assert [tuple(r) for r in rows] == [(1, "Queens", "A, b", 40.5, -73.9), (None, "Bronx", "C", None, None)]
    # A square of 2,000 by 1,000 feet in map units, with its middle known in the same units.
    x, y = 985_000.0, 205_000.0
    ring = [[x + a, y + b] for a, b in ((0, 0), (2000, 0), (2000, 1000), (0, 1000), (0, 0))]
    frame = spark.createDataFrame([(1, json.dumps({"type": "MultiPolygon", "coordinates": [[ring]]}))], "id int, shape string")
    got = rd.centroids_projected(frame, "shape").first()
    middle = rd.STATE_PLANE.inverse(F.lit(x + 1000.0), F.lit(y + 500.0))
    want = spark.range(1).select(middle[0].alias("a"), middle[1].alias("b")).first()
    assert abs(got.centroid_lng - want.a) < 1e-9 and abs(got.centroid_lat - want.b) < 1e-9
    assert -74.3 < got.centroid_lng < -73.6 and 40.4 < got.centroid_lat < 41.0

"""Whole jobs on tiny files: ingest, clean, explore, enrich, combine, count, classify."""

from datetime import datetime as dt
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tripkit.plans import trips as jobs
from tripkit.schemas import FHV, FHVHV, GREEN, YELLOW
from tripkit.sources import readers, writers

ZONES = [(1, "Queens", 40.70, -73.80), (2, "Manhattan", 40.75, -73.98), (3, "Unknown", 0.0, 0.0)]


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame(ZONES, "LocationID int, Borough string, centroid_lat double, centroid_lng double").withColumns(
        {"Zone": F.lit("z"), "service_zone": F.lit("s")}
    )


def write(df, path):
    df.write.mode("overwrite").parquet(str(path))
    return str(path)


def yellow_month(spark, year, month, names, vendor, kind):
    rows = [
        (
            vendor, dt(year, month, 1 + i % 27, 8 + i % 12), dt(year, month, 1 + i % 27, 8 + i % 12, 20 + i % 30), 1.0 + i % 3, 2.5 + i % 7,
            "1", "Y" if i % 2 else "N", 1 + i % 2, 2, "Credit" if i % 3 else "CSH", 10.0 + i, 0.5, None, float(i % 4), 0.0, 0.3, 30.0 + 2 * i,
        )
        for i in range(40)
    ]
    schema = (
        f"v {kind}, p timestamp_ntz, d timestamp_ntz, pc double, td double, rc string, sf string, PULocationID bigint, "
        "DOLocationID bigint, pt string, fare double, extra double, mta_tax double, tip double, tolls_amount double, "
        "improvement_surcharge double, total double"
    )
    return spark.createDataFrame(rows, schema).withColumnsRenamed(dict(zip(["v", "p", "d", "pc", "td", "rc", "sf", "pt", "fare", "tip", "total"], names)))


OLD = [
    "vendor_name", "Trip_Pickup_DateTime", "Trip_Dropoff_DateTime", "Passenger_Count", "Trip_Distance", "Rate_Code",
    "store_and_forward", "Payment_Type", "Fare_Amt", "Tip_Amt", "Total_Amt",
]
NEW = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance", "RatecodeID",
    "store_and_fwd_flag", "payment_type", "fare_amount", "tip_amount", "total_amount",
]


@pytest.fixture(scope="module")
def yellow_root(spark, zones, tmp_path_factory):
    raw, out = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("t1")
    paths = [
        write(yellow_month(spark, 2019, 3, OLD, "CMT", "string"), raw / "a"),
        write(yellow_month(spark, 2020, 4, NEW, 2, "bigint").withColumn("Airport_fee", F.lit(1.25)), raw / "b"),
    ]
    jobs.ingest(spark, paths, zones, YELLOW, str(out))
    jobs.ingest(spark, paths, zones, YELLOW, str(out))  # a re-run must not add rows
    return str(out / YELLOW.folder)


def test_ingest_yellow(spark, yellow_root):
    df = readers.read_partitioned(spark, yellow_root)
    assert df.count() == 80
    assert {(r["year"], r["vendor_id"], r["airport_fee"]) for r in df.select("year", "vendor_id", "airport_fee").distinct().collect()} == {
        (2019, 1, 0.0), (2020, 2, 1.25),
    }
    kinds = dict(df.dtypes)
    assert {name: kinds[name] for name in YELLOW.columns} == YELLOW.columns
    first = df.where("year = 2020").orderBy("fare_amount").first()
    assert (first["pickup_borough"], first["dropoff_borough"], first["payment_type"], first["store_and_fwd_flag"]) == ("Queens", "Manhattan", 2, 0)
    assert first["mta_tax"] == 0.0 and first["cbd_congestion_fee"] == 0.0


def test_year_filter_prunes_partitions(spark, yellow_root, capfd):
    readers.read_partitioned(spark, yellow_root, 2020).explain("formatted")
    assert "PartitionFilters: [isnotnull(year" in capfd.readouterr().out


@pytest.fixture(scope="module")
def yellow(spark, yellow_root):
    _, good = jobs.clean(readers.read_partitioned(spark, yellow_root), YELLOW)
    return good.cache()


def test_clean_writes_stats_and_rows(spark, yellow_root, tmp_path):
    jobs.clean_to(readers.read_partitioned(spark, yellow_root), YELLOW, str(tmp_path / "t2"), str(tmp_path / "stats"))
    stats = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "stats" / "yellow_tripdata_quality_stats"))
    assert stats.columns == ["year", "total_trips", *YELLOW.issue_flags, "clean_trips"]
    kept = spark.read.parquet(str(tmp_path / "t2" / "yellow_tripdata"))
    assert {r["year"]: r["clean_trips"] for r in stats.collect()} == {r["year"]: r["count"] for r in kept.groupBy("year").count().collect()}
    assert 0 < kept.count() <= 80


def test_explore(spark, yellow, tmp_path):
    results = jobs.explore(yellow, YELLOW)
    writers.write_results(results, str(tmp_path))
    names = [str(tmp_path / name) for name in results]
    back = readers.read_json_results(spark, [*names, str(tmp_path / "absent")])
    assert set(back) == set(names)
    total = yellow.count()
    assert sum(r["num_trips"] for r in results["trips_per_year"].collect()) == total
    assert sum(r["num_trips"] for r in results["od_matrix_ids"].collect()) == total
    assert sum(r["percentage"] for r in results["tip_percentage"].collect()) == pytest.approx(100)
    assert "median_fare" not in jobs.explore(yellow, FHV)


def test_other_services(spark, zones):
    t = dt(2023, 7, 1, 9)
    green = spark.createDataFrame(
        [(2, t, t + timedelta(minutes=9), None, None, "2", "N", 1, 2, "1", 9.0, 0.5, 0.5, 1.0, 0.0, 0.3, 12.0, 1.0)],
        "vendor_id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, passenger_count int, trip_distance double, "
        "rate_code_id string, store_and_fwd_flag string, PULocationID int, DOLocationID int, payment_type string, fare_amount double, "
        "extra double, mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, total_amount double, trip_type double",
    )
    row = jobs.normalise(green, zones, GREEN).first()
    assert (row["trip_distance"], row["passenger_count"], row["trip_type"], row["ehail_fee"]) == (-1.0, 0, 1, 0.0)

    fhv = spark.createDataFrame(
        [("B1", t, t + timedelta(hours=1), None, 2.0, None, "B2"), ("B1", dt(1500, 1, 1), t, 1.0, 2.0, 1, "B2")],
        "dispatching_base_num string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, PULocationID double, DOLocationID double, "
        "SR_flag int, affiliated_base_number string",
    )
    rows = jobs.normalise(fhv, zones, FHV).collect()
    assert len(rows) == 1 and (rows[0]["PULocationID"], rows[0]["SR_flag"], rows[0]["pickup_borough"]) == (0, 0, None)

    money = {c: F.lit(1.0) for c in ("base_passenger_fare", "bcf", "sales_tax", "tips", "tolls", "driver_pay", "airport_fee", "congestion_surcharge")}
    ready = spark.createDataFrame(
        [(" HV0003 ", None, "B3", t, t, t, t + timedelta(minutes=30), 1, 2, 3.0, 1800.0)],
        "hvfhs_license_num string, dispatching_base_num string, originating_base_num string, request_datetime timestamp_ntz, "
        "on_scene_datetime timestamp_ntz, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int, "
        "trip_distance double, trip_time double",
    ).withColumns({**money, **{c: F.lit(" Y") for c in jobs._FLAG_COLUMNS}})
    fhvhv = jobs.normalise(ready, zones, FHVHV)
    row = fhvhv.first()
    assert (row["hvfhs_license_num"], row["dispatching_base_num"], row["wav_match_flag"]) == ("HV0003", "", 1)
    stats, good = jobs.clean(fhvhv, FHVHV)
    assert stats.first()["clean_trips"] == 1 == good.count()
    counts = jobs.monthly_counts({"FHVHV": fhvhv})["FHVHV"].collect()
    assert [tuple(r) for r in counts] == [(2023, "HV0003", 7, 1)]


def test_enrich_and_events(spark, yellow, tmp_path):
    hours = [(dt(y, m, d) + timedelta(hours=h), float(h), h) for y, m in ((2019, 3), (2020, 4)) for d in range(1, 29) for h in range(24)]
    weather = spark.createDataFrame(hours, "time timestamp_ntz, Temperature double, `Weather Code` int")
    schools = spark.createDataFrame([("A", 40.75, -73.97), ("B", 40.60, -74.1), ("C", None, None)], "Name string, latitude double, longitude double")
    business = spark.createDataFrame([("Shop", 10001, None, None), ("Far", 1, 40.6, -74.2), ("Lost", 5, None, None)], "`Business Name` string, `ZIP Code` bigint, Latitude double, Longitude double")
    zips = spark.createDataFrame([(10001, "NY", 40.751, -73.98)], "`ZIP Code` bigint, State string, lat double, lng double")
    df = jobs.enrich(yellow, weather, schools, business, zips)
    assert df.count() == yellow.count()
    assert [tuple(r) for r in df.select("nearest_school_name", "nearest_business_name").distinct().collect()] == [("A", "Shop")]
    r = df.select("dropoff_datetime", "Temperature", "dist_from_business").first()
    assert r["Temperature"] is not None and 100 < r["dist_from_business"] < 200

    start = yellow.orderBy("dropoff_datetime").first()["dropoff_datetime"]
    events = spark.createDataFrame([("Fair", start, start, "14,18"), ("Late", start + timedelta(days=400), start, "14"), ("None", start, start, None)], "`Event Name` string, `Start Date/Time` timestamp_ntz, `End Date/Time` timestamp_ntz, `Police Precinct` string")
    precincts = spark.createDataFrame([(14, -73.98, 40.75)], "precinct bigint, lng double, lat double")
    near = jobs.nearby_events(yellow, events, precincts)
    named = near.where("`Event Name` is not null")
    assert {r["Event Name"] for r in named.collect()} == {"Fair"} and near.count() >= yellow.count()
    assert named.agg(F.max("time_diff")).first()[0] <= 1.0


def test_combine(spark, yellow):
    other = spark.createDataFrame([("HV0003", 2.5)], "hvfhs_license_num string, tips float")
    both = jobs.combine(yellow, other)
    assert both.columns == sorted({*YELLOW.columns, "hvfhs_license_num", "tips", "source"})
    assert set(dict(both.dtypes).values()) == {"string"}
    assert both.groupBy("source").count().collect()[0]["count"] in (1, yellow.count())
    assert dict(jobs.combine(yellow, other, as_string=False).dtypes)["tips"] == "float"


@pytest.mark.parametrize("trees", [False, True])
def test_classify_beats_the_majority(spark, trees, tmp_path):
    def service(fast, offset):
        rows = spark.range(600).select(
            F.timestamp_add("MINUTE", (F.col("id") * 700 + offset).cast("int"), F.lit(dt(2023, 1, 1)).cast("timestamp_ntz")).alias("pickup_datetime"),
            (F.lit(float(fast)) + (F.col("id") % 5) / 10).cast("float").alias("trip_distance"),
            F.lit("Queens" if fast > 5 else "Bronx").alias("pickup_borough"), F.lit(None).cast("string").alias("dropoff_borough"),
        )
        rows = rows.withColumn("dropoff_datetime", F.timestamp_add("MINUTE", F.lit(20), F.col("pickup_datetime")))
        later = rows.withColumns({c: F.timestamp_add("YEAR", F.lit(1), F.col(c)) for c in ("pickup_datetime", "dropoff_datetime")})
        return rows.unionByName(later).withColumn("year", F.year("pickup_datetime"))

    services = {"Yellow": service(2, 0), "Green": service(9, 5), "FHVHV": service(5, 9)}
    got = jobs.classify(
        services, train_year=2023, valid_year=2024, cap=60, trees=trees, rounds=3, slots=16, records=str(tmp_path / "runs")
    )
    model, base = got["metrics"].first(), got["baseline"].first()
    assert model["macro_accuracy"] > 0.9 > base["macro_accuracy"] == pytest.approx(1 / 3)
    assert model["log_loss"] < base["log_loss"]
    assert len(got["importance"]) == 6
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 2


def test_csv_side_tables(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    events = put("e.csv", 'Event Name,Start Date/Time,End Date/Time,Police Precinct,x\n"A, b",07/04/2024 02:30:00 PM,2024-07-04 16:00:00,"14,18",1\nC,bad,,,\n')
    rows = readers.read_events(spark, events).collect()
    assert rows[0]["Event Name"] == "A, b" and rows[0]["Start Date/Time"] == dt(2024, 7, 4, 14, 30) and rows[1]["Start Date/Time"] is None
    assert rows[0]["End Date/Time"] == dt(2024, 7, 4, 16) and rows[0]["Police Precinct"] == "14,18"
    precincts = put("p.csv", "precinct,the_geom\n14,\"{'type': 'MultiPolygon', 'coordinates': [[[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]]}\"\n")
    row = readers.read_precincts(spark, precincts).first()
    assert (row["precinct"], row["lng"], row["lat"]) == (14, pytest.approx(1), pytest.approx(1))
    schools = put("s.csv", "nta_name,location_category_description,latitude,longitude,z\nHarlem,High,40.8,-73.9,1\n,High,,,\n")
    assert [r["Name"] for r in readers.read_schools(spark, schools).collect()] == ["Harlem High", "nan High"]
    business = put("b.csv", "Business Name,ZIP Code,Latitude,Longitude\nX,10001,,\nY,ABC,40,-73\n")
    assert [r["ZIP Code"] for r in readers.read_businesses(spark, business).collect()] == [10001]
    zips = put("US.txt", "US\t10001\tNew York\tNew York\tNY\ta\tb\tc\td\t40.75\t-73.99\t4\n")
    assert [tuple(r) for r in readers.read_zip_table(spark, zips).collect()] == [(10001, "NY", 40.75, -73.99)]
    weather = put("w.csv", "time,Temperature,Weather Code\n2024-01-01T05:00,1.5,3\n")
    assert tuple(readers.read_weather(spark, weather).first()) == (dt(2024, 1, 1, 5), 1.5, 3)

"""Readers and writers, exercised on the test tables through files Spark writes itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.session import shared_dir
from tripkit.sources import readers as rd
from tripkit.sources import writers as wr
from workload.registry import query
from workload.views import RIDES, rides, table


@query("scan_drifted_union", """
SELECT CAST(o_custkey AS DOUBLE) AS vendor_id, o_orderdate AS pickup_datetime, CAST(o_totalprice AS DOUBLE) AS fare_amount,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS "SR_flag", CASE WHEN o_orderkey % 3 = 2 THEN 0.5::DOUBLE END AS airport_fee
FROM orders""")
def scan_drifted_union(spark, sf):
    """Three folders with different names, types and columns."""
    root, key = shared_dir(spark, "drifted"), F.col("o_orderkey")
    orders = table(spark, sf, "orders")
    months = [
        orders.where(key % 3 == 0).select(
            F.col("o_custkey").cast("string").alias("vendor_name"),
            F.col("o_orderdate").cast("string").alias("Trip_Pickup_DateTime"),
            F.col("o_totalprice").cast("string").alias("Fare_Amt"),
        ),
        orders.where(key % 3 == 1).select(
            F.col("o_custkey").alias("VendorID"), F.col("o_orderdate").alias("tpep_pickup_datetime"),
            F.col("o_totalprice").alias("fare_amount"), F.col("o_orderstatus").alias("SR_Flag"),
        ),
        orders.where(key % 3 == 2).select(
            F.col("o_custkey").cast("double").alias("VendorID"), F.col("o_orderdate").alias("lpep_pickup_datetime"),
            F.col("o_totalprice").alias("fare_amount"), F.col("o_orderstatus").alias("SR_flag"),
            F.lit(0.5).alias("Airport_fee"),
        ),
    ]
    for i, month in enumerate(months):
        wr.write_parquet(month, f"{root}/month={i}")
    kinds = {"vendor_id": "double", "pickup_datetime": "timestamp_ntz", "fare_amount": "double"}
    return rd.read_drifted(spark, [f"{root}/month={i}" for i in range(3)], kinds)


@query("partitioned_roundtrip", f"""
WITH {RIDES}
SELECT year, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys, round(sum(fare_amount), 2) AS fares FROM rides GROUP BY 1""")
def partitioned_roundtrip(spark, sf):
    """Written twice, as in a re-run: the second write replaces the first."""
    root = shared_dir(spark, "by-year")
    rows = rides(spark, sf).select("year", "l_orderkey", "fare_amount")
    wr.write_by_year(rows, root)
    wr.write_by_year(rows, root, files_per_year=2)
    back = rd.read_partitioned(spark, root)
    return back.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"), F.round(F.sum("fare_amount"), 2).alias("fares")
    )


@query("incremental_write", f"""
WITH {RIDES}
SELECT year, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM rides GROUP BY 1""")
def incremental_write(spark, sf):
    """Three loads that share years, one of them written twice; each load holds rows of every year."""
    root = shared_dir(spark, "incremental")
    rows = rides(spark, sf).select("year", "l_orderkey")
    part = F.pmod(F.col("l_orderkey"), F.lit(3))
    for i in (0, 1, 0, 2):
        wr.write_by_year(rows.where(part == i), root, load=f"load-{i}")
    back = rd.read_partitioned(spark, root)
    return back.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


@query("load_written_again", f"""
WITH {RIDES}
SELECT year, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM rides
WHERE l_orderkey % 2 = 1 OR year <> (SELECT min(year) FROM rides) GROUP BY 1""")
def load_written_again(spark, sf):
    """Two loads; the first is written again without its first year, whose rows of that load must go."""
    root = shared_dir(spark, "again")
    rows = rides(spark, sf).select("year", "l_orderkey")
    even, odd = rows.where("l_orderkey % 2 = 0"), rows.where("l_orderkey % 2 = 1")
    wr.write_by_year(even, root, load="even", sources=["even"])
    wr.write_by_year(odd, root, load="odd", sources=["odd"])
    first = rows.agg(F.min("year").alias("first"))
    wr.write_by_year(even.join(F.broadcast(first), F.col("year") != F.col("first")).drop("first"), root, load="even", sources=["even"])  # one row
    back = rd.read_partitioned(spark, root)
    return back.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


@query("partition_pruned_scan", f"""
WITH {RIDES} SELECT service, year, count(*) AS n FROM rides WHERE year IN (1997, 1999) GROUP BY 1, 2""")
def partition_pruned_scan(spark, sf):
    root = shared_dir(spark, "pruned")
    wr.write_by_year(rides(spark, sf).select("service", "l_orderkey", "year"), root)
    kept = rd.read_partitioned(spark, root, [1997, 1999])
    return kept.groupBy("service", "year").agg(F.count(F.lit(1)).alias("n"))


@query("rowcount_by_service", """
SELECT 'customer' AS service, count(*) AS num_rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def rowcount_by_service(spark, sf):
    return rd.row_counts({name: table(spark, sf, name) for name in ("customer", "orders", "lineitem")})


@query("stored_rows_by_service", """
SELECT 'customer' AS service, count(*) AS num_rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events""")
def stored_rows_by_service(spark, sf):
    """The same from footers alone, all services in one job."""
    files = {name: [f"{sf}/{name}.parquet"] for name in ("customer", "orders", "lineitem", "events")}
    return rd.stored_rows(spark, files).select("service", "num_rows")


@query("csv_typed_scan", """
SELECT c_custkey AS key, c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS balance, c_nationkey AS nation FROM customer""")
def csv_typed_scan(spark, sf):
    path = shared_dir(spark, "csv")
    raw = table(spark, sf, "customer").select(
        "c_mktsegment", F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit("unknown")).otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
        F.col("c_nationkey").alias("nation"),
    )
    wr.write_csv(raw, path)
    return rd.read_csv(spark, path, {"key": "bigint", "name": "string", "balance": "double", "nation": "int"})


@query("tsv_by_position", """
SELECT c_custkey AS zip, c_mktsegment AS state, c_acctbal AS lat FROM customer""")
def tsv_by_position(spark, sf):
    path = shared_dir(spark, "tsv")
    raw = table(spark, sf, "customer").select("c_name", "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    raw.write.option("sep", "\t").option("header", False).csv(path)
    return rd.read_csv(
        spark, path, {"zip": "bigint", "state": "string", "lat": "double"}, header=False, sep="\t",
        positions={1: "zip", 3: "state", 4: "lat"},
    )


def _monthly(spark, sf) -> DataFrame:
    return rides(spark, sf).groupBy("year", F.month("pickup_datetime").alias("month"), "hvfhs_license_num").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("flatten_nested_counts", f"""
WITH {RIDES}
SELECT CAST(year AS VARCHAR) AS year, hvfhs_license_num AS company, CAST(month(pickup_datetime) AS VARCHAR) AS month, count(*) AS trips
FROM rides GROUP BY 1, 2, 3""")
def flatten_nested_counts(spark, sf):
    """Counts are nested into one JSON document per year and flattened again."""
    month = F.map_from_entries(F.collect_list(F.struct(F.col("month").cast("string"), "n")))
    by_company = _monthly(spark, sf).groupBy("year", "hvfhs_license_num").agg(month.alias("m"))
    company = F.map_from_entries(F.collect_list(F.struct("hvfhs_license_num", "m")))
    nested = by_company.groupBy("year").agg(company.alias("c"))
    document = F.to_json(F.create_map(F.col("year").cast("string"), F.col("c"))).alias("document")
    return rd.flatten_counts(nested.select(document), "document", ["year", "company", "month"])


@query("json_results_roundtrip", f"""
WITH {RIDES} SELECT service, CAST(year AS BIGINT) AS year, count(*) AS num_trips FROM rides GROUP BY 1, 2""")
def json_results_roundtrip(spark, sf):
    root = shared_dir(spark, "results")
    counted = rides(spark, sf).groupBy("service", "year").agg(F.count(F.lit(1)).alias("num_trips"))
    wr.write_results({"trips_per_year": counted}, root)
    found = rd.read_json_results(spark, [f"{root}/trips_per_year", f"{root}/not_written"])
    return found[f"{root}/trips_per_year"].select("service", "year", "num_trips")


_CHECKSUM = "count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS keys, round(sum(fare_amount), 2) AS fares, max(pickup_datetime) AS last_pickup"


@query("format_roundtrip", f"""
WITH {RIDES}, s AS (SELECT {_CHECKSUM} FROM rides)
SELECT f AS format, rows, keys, fares, last_pickup FROM s, (SELECT unnest(['parquet', 'orc', 'json', 'csv', 'csv_gzip']) AS f)""")
def format_roundtrip(spark, sf):
    rows = rides(spark, sf).select("service", "pickup_datetime", "l_orderkey", "fare_amount", "tip_amount")
    frames = wr.write_formats(rows, shared_dir(spark, "formats"))
    out = [
        df.agg(
            F.count(F.lit(1)).alias("rows"), F.sum("l_orderkey").alias("keys"),
            F.round(F.sum("fare_amount"), 2).alias("fares"), F.max("pickup_datetime").alias("last_pickup"),
        ).select(F.lit(name).alias("format"), "*")
        for name, df in frames.items()
    ]
    result = out[0]
    for df in out[1:]:
        result = result.unionByName(df)
    return result


@query("timing_summary", f"""
WITH {RIDES}
SELECT service, year, round(min(fare_amount), 2) AS read_min_s, round(avg(fare_amount), 2) AS read_avg_s,
       round(max(fare_amount), 2) AS read_max_s, round(stddev_samp(fare_amount), 2) AS read_std_s FROM rides GROUP BY 1, 2""")
def timing_summary(spark, sf):
    return wr.timing_summary(rides(spark, sf), ["service", "year"], "fare_amount")


@query("format_read_times", None)
def format_read_times(spark, sf):
    root = shared_dir(spark, "timed")
    rows = rides(spark, sf).select("service", "pickup_datetime", "l_orderkey", "fare_amount", "tip_amount")
    timed = wr.time_reads(wr.write_formats(rows, root), root, repeats=3)
    return wr.timing_summary(timed, ["format", "size_mb"])


@query("experiment_records", f"""
WITH {RIDES} SELECT 'run' AS exp_name, service AS model, count(*) AS train_rows FROM rides GROUP BY 2""")
def experiment_records(spark, sf):
    """Run records appended one at a time, as after each experiment."""
    path = shared_dir(spark, "records")
    sizes = rides(spark, sf).groupBy("service").count().collect()  # one row per service
    for row in sizes:
        wr.append_record(spark, {"exp_name": "run", "model": row["service"], "train_rows": row["count"]}, path)
    return spark.read.parquet(path).select("exp_name", "model", "train_rows")

"""How the star-schema test tables stand in for trips, zones, places and events.

Every view exists twice, as a DataFrame and as a SQL common table expression of the same
name, so that a query and its check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.functions.geo import mercator_x, mercator_y


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(condition: str, value: Column) -> Column:
    return F.when(~F.expr(condition), value)


# rides: line items with their order, as trips without geography -----------------
def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.expr("CASE l_returnflag WHEN 'R' THEN 'Yellow' WHEN 'A' THEN 'Green' ELSE 'FHVHV' END").alias("service"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.year("o_orderdate").alias("year"),
        F.col("l_extendedprice").alias("fare_amount"),
        _pick("l_linenumber = 5", F.col("l_extendedprice") * F.col("l_discount")).alias("tip_amount"),
        F.col("l_quantity").alias("trip_distance"),
        F.concat(F.lit("HV000"), (F.col("l_suppkey") % 5 + 2).cast("string")).alias("hvfhs_license_num"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey", "l_discount", "l_tax",
    )


RIDES = """rides AS (
  SELECT CASE l_returnflag WHEN 'R' THEN 'Yellow' WHEN 'A' THEN 'Green' ELSE 'FHVHV' END AS service,
         o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         l_extendedprice AS fare_amount,
         CASE WHEN l_linenumber = 5 THEN NULL ELSE l_extendedprice * l_discount END AS tip_amount,
         l_quantity AS trip_distance,
         'HV000' || CAST(l_suppkey % 5 + 2 AS VARCHAR) AS hvfhs_license_num,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, l_discount, l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


# zones: nations with their region --------------------------------------------------
def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"), F.col("n_name").alias("Zone"), F.col("r_name").alias("Borough")
    )


ZONES = """zones AS (
  SELECT n_nationkey AS LocationID, n_name AS Zone, r_name AS Borough
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


# trips: rides with zones and boroughs; some boroughs are missing on purpose -----------
def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("pu_zone"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("do_zone"))
    z = zones(spark, sf_dir)
    origin = z.select(F.col("LocationID").alias("_pu"), F.col("Borough").alias("_pb"))
    destination = z.select(F.col("LocationID").alias("_do"), F.col("Borough").alias("_db"))
    return (
        rides(spark, sf_dir)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(origin, F.col("pu_zone") == F.col("_pu"))
        .join(destination, F.col("do_zone") == F.col("_do"))
        .withColumns({
            "pickup_borough": _pick("l_linenumber = 7", F.col("_pb")),
            "dropoff_borough": _pick("l_linenumber = 6", F.col("_db")),
        })
        .drop("_pu", "_do", "_pb", "_db", "c_custkey", "s_suppkey")
    )


TRIPS = f"""{RIDES}, {ZONES}, trips AS (
  SELECT rides.*, c_nationkey AS pu_zone, s_nationkey AS do_zone,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE o.Borough END AS pickup_borough,
         CASE WHEN l_linenumber = 6 THEN NULL ELSE d.Borough END AS dropoff_borough
  FROM rides JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN zones o ON c_nationkey = o.LocationID JOIN zones d ON s_nationkey = d.LocationID)"""


# Positions derived from a key, spread over a rectangle around the city -----------------
def lon_of(key: str) -> Column:
    return F.lit(-74.30).cast("double") + ((F.col(key) * 7919) % 650).cast("double") / F.lit(1000.0)


def lat_of(key: str) -> Column:
    return F.lit(40.45).cast("double") + ((F.col(key) * 6271) % 500).cast("double") / F.lit(1000.0)


def sql_lon(key: str) -> str:
    return f"(CAST(-74.30 AS DOUBLE) + CAST(({key} * 7919) % 650 AS DOUBLE) / CAST(1000 AS DOUBLE))"


def sql_lat(key: str) -> str:
    return f"(CAST(40.45 AS DOUBLE) + CAST(({key} * 6271) % 500 AS DOUBLE) / CAST(1000 AS DOUBLE))"


def sql_x(lon: str) -> str:
    return f"({lon} * CAST(0.017453292519943295 AS DOUBLE) * CAST(6378137 AS DOUBLE))"


def sql_y(lat: str) -> str:
    return (
        f"(ln(tan(CAST(0.7853981633974483 AS DOUBLE) + {lat} * CAST(0.017453292519943295 AS DOUBLE)"
        f" / CAST(2 AS DOUBLE))) * CAST(6378137 AS DOUBLE))"
    )


# otrips: orders as trips with a unique id and a position; a few have no position ---------
def otrips(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice", "o_custkey",
        _pick("o_orderkey % 97 = 0", lon_of("o_orderkey")).alias("lon"), lat_of("o_orderkey").alias("lat"),
    )
    return located.withColumns({"x": mercator_x(F.col("lon")), "y": mercator_y(F.col("lat"))})


OTRIPS = f"""otrips AS (
  SELECT *, {sql_x('lon')} AS x, {sql_y('lat')} AS y FROM (
    SELECT o_orderkey, o_orderdate, o_orderpriority, o_totalprice, o_custkey,
           CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE {sql_lon('o_orderkey')} END AS lon,
           {sql_lat('o_orderkey')} AS lat
    FROM orders))"""


# pois: suppliers as places; one in fifty lacks coordinates ---------------------------------
def pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name",
        _pick("s_suppkey % 50 = 49", lon_of("s_suppkey")).alias("lon"), lat_of("s_suppkey").alias("lat"),
    )
    return located.select(
        "s_suppkey", "s_name", mercator_x(F.col("lon")).alias("px"), mercator_y(F.col("lat")).alias("py")
    )


POIS = f"""pois AS (
  SELECT s_suppkey, s_name, {sql_x('lon')} AS px, {sql_y('lat')} AS py FROM (
    SELECT s_suppkey, s_name,
           CASE WHEN s_suppkey % 50 = 49 THEN NULL ELSE {sql_lon('s_suppkey')} END AS lon,
           {sql_lat('s_suppkey')} AS lat
    FROM supplier))"""


# shops: customers as a larger set of places ----------------------------------------------
def shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", mercator_x(lon_of("c_custkey")).alias("px"), mercator_y(lat_of("c_custkey")).alias("py")
    )


SHOPS = f"""shops AS (
  SELECT c_custkey, c_name, {sql_x(sql_lon('c_custkey'))} AS px, {sql_y(sql_lat('c_custkey'))} AS py
  FROM customer)"""


# etrips / happenings: events with even and odd ids as trips and happenings ---------------------------
def etrips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_id % 2 = 0").select(
        F.col("event_id").alias("trip_id"), F.col("ts").alias("trip_ts"), "user_id", "value",
        lon_of("event_id").alias("lon"), lat_of("event_id").alias("lat"),
        mercator_x(lon_of("event_id")).alias("x"), mercator_y(lat_of("event_id")).alias("y"),
    )


def happenings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_id % 2 = 1").select(
        F.col("event_id").alias("happening_id"), F.col("ts").alias("start_ts"),
        mercator_x(lon_of("event_id")).alias("hx"), mercator_y(lat_of("event_id")).alias("hy"),
    )


ETRIPS = f"""etrips AS (
  SELECT event_id AS trip_id, ts AS trip_ts, user_id, value,
         {sql_lon('event_id')} AS lon, {sql_lat('event_id')} AS lat,
         {sql_x(sql_lon('event_id'))} AS x, {sql_y(sql_lat('event_id'))} AS y
  FROM events WHERE event_id % 2 = 0)"""

HAPPENINGS = f"""happenings AS (
  SELECT event_id AS happening_id, ts AS start_ts,
         {sql_x(sql_lon('event_id'))} AS hx, {sql_y(sql_lat('event_id'))} AS hy
  FROM events WHERE event_id % 2 = 1)"""


# weather: event values averaged by UTC hour ------------------------------------------------
def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("time")
    return table(spark, sf_dir, "events").groupBy(hour).agg(
        F.avg("value").alias("temperature"), F.count(F.lit(1)).alias("readings")
    )


WEATHER = """weather AS (
  SELECT date_trunc('hour', ts) AS time, avg(value) AS temperature, count(*) AS readings
  FROM events GROUP BY 1)"""

LOCAL_WEATHER = f"""{WEATHER}, local_weather AS (
  SELECT timezone('America/New_York', timezone('UTC', time)) AS time, temperature, readings FROM weather)"""

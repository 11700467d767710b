"""Counts, medians, matrices, shares and monthly series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.functions import codes
from tripkit.operators import analytics as a
from tripkit.operators import sketches as sk
from tripkit.operators.quality import keep_clean, valid_distance, valid_timestamps
from tripkit.schemas import SERVICES
from tripkit.session import shared_dir
from workload.registry import query
from workload.views import RIDES, TRIPS, rides, table, trips



def _rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


@query("trips_per_year", f"""
WITH {RIDES}
SELECT year, count(*) AS num_trips FROM rides GROUP BY year ORDER BY year""")
def trips_per_year(spark, sf):
    return a.trips_per_year(rides(spark, sf))


@query("trips_per_zone", f"""
WITH {TRIPS}
SELECT pu_zone, count(*) AS num_trips FROM trips WHERE pu_zone IS NOT NULL
GROUP BY pu_zone ORDER BY num_trips DESC, pu_zone""")
def trips_per_zone(spark, sf):
    return a.trips_per_zone(trips(spark, sf), "pu_zone")


@query("trips_per_hour", """
SELECT CAST(extract('hour' FROM ts) AS INTEGER) AS hour_of_day, count(*) AS num_trips
FROM events GROUP BY 1 ORDER BY num_trips DESC, 1""")
def trips_per_hour(spark, sf):
    return a.trips_per_hour(table(spark, sf, "events"), "ts")


@query("median_fare_per_year", f"""
WITH {RIDES}
SELECT year, round(median(fare_amount), 6) AS median_fare FROM rides GROUP BY year""")
def median_fare_per_year(spark, sf):
    return _rounded(a.median_of(rides(spark, sf), "fare_amount", ["year"], name="median_fare"), "median_fare", digits=6)


@query("median_tip", f"""
WITH {RIDES}
SELECT round(median(tip_amount), 6) AS median_tip FROM rides WHERE tip_amount > 0""")
def median_tip(spark, sf):
    tipped = a.positive(rides(spark, sf), "tip_amount")
    return _rounded(a.median_of(tipped, "tip_amount", name="median_tip"), "median_tip", digits=6)


@query("median_fare", f"""
WITH {RIDES}
SELECT round(median(fare_amount), 6) AS median_fare_amount FROM rides WHERE fare_amount > 0""")
def median_fare(spark, sf):
    paid = a.positive(rides(spark, sf), "fare_amount")
    return _rounded(a.median_of(paid, "fare_amount", name="median_fare_amount"), "median_fare_amount", digits=6)


@query("median_duration", f"""
WITH {RIDES}
SELECT median(date_part('epoch', dropoff_datetime) - date_part('epoch', pickup_datetime)) AS median_trip_duration_sec
FROM rides WHERE dropoff_datetime > pickup_datetime""")
def median_duration(spark, sf):
    return a.median_duration(rides(spark, sf))


@query("approximate_median_fare", None)
def approximate_median_fare(spark, sf):
    return a.median_of(rides(spark, sf), "fare_amount", ["year"], name="median_fare", approximate=True)


@query("approximate_median_bound", f"""
WITH {RIDES} SELECT year, count(*) AS rows, true AS within_bound FROM rides WHERE fare_amount IS NOT NULL GROUP BY 1""")
def approximate_median_bound(spark, sf):
    """Whether the rank of the approximate median is within 1 / 10,000 of the middle, counted over all fares."""
    fares = rides(spark, sf).select("year", "fare_amount").where(F.col("fare_amount").isNotNull())
    found = a.median_of(fares, "fare_amount", ["year"], name="middle", approximate=True).withColumnRenamed("year", "_y")
    ranks = fares.join(found, F.col("year") == F.col("_y")).groupBy("year").agg(
        F.count("*").alias("rows"), F.count_if(F.col("fare_amount") < F.col("middle")).alias("below"),
        F.count_if(F.col("fare_amount") <= F.col("middle")).alias("upto"),
    )
    slack, middle = F.col("rows") / 10000 + 1, F.col("rows") / 2
    return ranks.select("year", "rows", ((F.col("below") <= middle + slack) & (F.col("upto") >= middle - slack)).alias("within_bound"))


@query("stored_median_bound", f"""
WITH {RIDES} SELECT year, count(fare_amount) AS rows, true AS within_bound FROM rides GROUP BY 1""")
def stored_median_bound(spark, sf):
    """Medians per year merged from the sketches of three loads, one of them written twice: ranks within 0.5 % of the middle."""
    root, r = shared_dir(spark, "sketches"), rides(spark, sf)
    for i in (0, 1, 2, 1):
        part = r.where(F.pmod("l_orderkey", F.lit(3)) == i)
        sk.store_sketches(part, {"fare": F.col("fare_amount")}, root, load=f"load-{i}", sources=[f"part-{i}"])
    found = sk.stored_quantiles(spark, root, ["fare"]).withColumnRenamed("year", "_y")
    fares = r.select("year", "fare_amount").where(F.col("fare_amount").isNotNull())
    ranks = fares.join(found, F.col("year") == F.col("_y")).groupBy("year").agg(
        F.max("fare_rows").alias("rows"), F.count_if(F.col("fare_amount") < F.col("fare")).alias("below"),
        F.count_if(F.col("fare_amount") <= F.col("fare")).alias("upto"),
    )
    slack, middle = F.col("rows") * 0.005 + 1, F.col("rows") / 2
    return ranks.select("year", "rows", ((F.col("below") <= middle + slack) & (F.col("upto") >= middle - slack)).alias("within_bound"))


@query("tip_percentage", f"""
WITH {RIDES}, s AS (
  SELECT avg(CASE WHEN tip_amount > 0 THEN 1.0 ELSE 0.0 END) * 100 AS p FROM rides)
SELECT 'Tipped' AS type, round(CAST(p AS DOUBLE), 4) AS percentage FROM s
UNION ALL SELECT 'No Tip', round(CAST(100 - p AS DOUBLE), 4) FROM s""")
def tip_percentage(spark, sf):
    return _rounded(a.tip_percentage(rides(spark, sf)), "percentage")


@query("trips_per_borough", f"""
WITH {TRIPS}
SELECT pickup_borough, count(*) AS num_trips FROM trips WHERE pickup_borough IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1""")
def trips_per_borough(spark, sf):
    return a.trips_per_borough(trips(spark, sf))


@query("od_matrix_borough", f"""
WITH {TRIPS}
SELECT pickup_borough, dropoff_borough, count(*) AS num_trips FROM trips
WHERE pickup_borough IS NOT NULL AND dropoff_borough IS NOT NULL GROUP BY 1, 2""")
def od_matrix_borough(spark, sf):
    return a.od_matrix(trips(spark, sf), "pickup_borough", "dropoff_borough")


@query("od_matrix_zone", f"""
WITH {TRIPS}
SELECT pu_zone, do_zone, count(*) AS num_trips FROM trips GROUP BY 1, 2""")
def od_matrix_zone(spark, sf):
    return a.od_matrix(trips(spark, sf), "pu_zone", "do_zone")


@query("top10_od_borough", f"""
WITH {TRIPS}
SELECT pickup_borough, dropoff_borough, count(*) AS num_trips FROM trips
WHERE pickup_borough IS NOT NULL AND dropoff_borough IS NOT NULL
GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""")
def top10_od_borough(spark, sf):
    return a.top_od(trips(spark, sf), "pickup_borough", "dropoff_borough")


@query("top10_od_zone", f"""
WITH {TRIPS}
SELECT pu_zone, do_zone, count(*) AS num_trips FROM trips GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""")
def top10_od_zone(spark, sf):
    return a.top_od(trips(spark, sf), "pu_zone", "do_zone")


@query("clean_top10_od_borough", f"""
WITH {TRIPS}
SELECT pickup_borough, dropoff_borough, count(*) AS num_trips FROM trips
WHERE pickup_datetime < dropoff_datetime
  AND (year(pickup_datetime) = year(dropoff_datetime)
       OR (year(dropoff_datetime) = year(pickup_datetime) + 1
           AND month(pickup_datetime) = 12 AND day(pickup_datetime) = 31
           AND month(dropoff_datetime) = 1 AND day(dropoff_datetime) = 1))
  AND year BETWEEN 1996 AND 2000
  AND date_diff('second', pickup_datetime, dropoff_datetime) BETWEEN 86400 AND 8640000
  AND trip_distance > 0
  AND trip_distance < date_diff('second', pickup_datetime, dropoff_datetime) / 3600.0 * 0.05
  AND pickup_borough IS NOT NULL AND dropoff_borough IS NOT NULL
GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""")
def clean_top10_od_borough(spark, sf):
    rules = {
        "bad_timestamps": valid_timestamps("pickup_datetime", "dropoff_datetime", (1996, 2000)),
        "bad_distance": valid_distance(
            "trip_distance", "pickup_datetime", "dropoff_datetime", limits=(86_400, 8_640_000), max_speed=0.05
        ),
    }
    return a.top_od(keep_clean(trips(spark, sf), rules), "pickup_borough", "dropoff_borough")


_OD_BY_SERVICE = f"""{TRIPS}, od AS (
  SELECT service, pickup_borough, dropoff_borough, count(*) AS num_trips FROM trips
  WHERE pickup_borough IS NOT NULL AND dropoff_borough IS NOT NULL GROUP BY 1, 2, 3)"""


@query("od_top5_labels", f"""
WITH {TRIPS}, od AS (
  SELECT service, pickup_borough AS pu, dropoff_borough AS de, count(*) AS n FROM trips GROUP BY 1, 2, 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY service ORDER BY n DESC, pu NULLS LAST, de NULLS LAST) AS r FROM od)
SELECT service, CAST(r AS INTEGER) AS rank,
       coalesce(pu, 'Unknown') || ' → ' || coalesce(de, 'Unknown') AS label, n AS trips
FROM ranked WHERE r <= 5""")
def od_top5_labels(spark, sf):
    counted = trips(spark, sf).groupBy("service", "pickup_borough", "dropoff_borough").agg(
        F.count(F.lit(1)).alias("num_trips")
    )
    return a.top_flows(counted, "pickup_borough", "dropoff_borough", ["service"])


@query("od_row_share", f"""
WITH {_OD_BY_SERVICE}, b AS (
  SELECT service, pickup_borough AS b FROM od UNION SELECT service, dropoff_borough FROM od),
grid AS (SELECT x.service, x.b AS pickup_borough, y.b AS dropoff_borough FROM b x JOIN b y ON x.service = y.service),
filled AS (SELECT grid.*, coalesce(num_trips, 0) AS num_trips FROM grid LEFT JOIN od USING (service, pickup_borough, dropoff_borough)),
shared AS (SELECT *, sum(num_trips) OVER (PARTITION BY service, pickup_borough) AS total FROM filled)
SELECT service, pickup_borough, dropoff_borough, CAST(num_trips AS BIGINT) AS num_trips,
       round(CASE WHEN total = 0 THEN 0.0 ELSE CAST(num_trips AS DOUBLE) / total END, 4) AS share FROM shared""")
def od_row_share(spark, sf):
    od = a.od_matrix(trips(spark, sf), "pickup_borough", "dropoff_borough", ["service"])
    return _rounded(a.od_row_share(od, "pickup_borough", "dropoff_borough", ["service"]), "share")


def _yearly(spark, sf) -> DataFrame:
    return rides(spark, sf).groupBy("service", "year").agg(F.count(F.lit(1)).alias("num_trips"))


@query("pivot_year_service", f"""
WITH {RIDES}
SELECT year, count(*) FILTER (service = 'Yellow') AS "Yellow", count(*) FILTER (service = 'Green') AS "Green",
       count(*) FILTER (service = 'FHV') AS "FHV", count(*) FILTER (service = 'FHVHV') AS "FHVHV"
FROM rides GROUP BY year ORDER BY year""")
def pivot_year_service(spark, sf):
    return a.pivot_counts(_yearly(spark, sf), "year", "service", SERVICES).orderBy("year")


@query("yearly_market_share", f"""
WITH {RIDES}, c AS (SELECT year, service, count(*) AS n FROM rides GROUP BY 1, 2),
t AS (SELECT year, sum(n) AS total FROM c GROUP BY 1)
SELECT year,
  round(CAST(coalesce(sum(n) FILTER (service = 'Yellow'), 0) AS DOUBLE) * 100 / any_value(total), 2) AS "Yellow",
  round(CAST(coalesce(sum(n) FILTER (service = 'Green'), 0) AS DOUBLE) * 100 / any_value(total), 2) AS "Green",
  round(CAST(coalesce(sum(n) FILTER (service = 'FHV'), 0) AS DOUBLE) * 100 / any_value(total), 2) AS "FHV",
  round(CAST(coalesce(sum(n) FILTER (service = 'FHVHV'), 0) AS DOUBLE) * 100 / any_value(total), 2) AS "FHVHV"
FROM c JOIN t USING (year) GROUP BY year ORDER BY year""")
def yearly_market_share(spark, sf):
    return a.yearly_market_share(_yearly(spark, sf), SERVICES)


_SHARES = f"""{TRIPS}, c AS (
  SELECT service, pickup_borough AS borough, count(*) AS n FROM trips WHERE pickup_borough IS NOT NULL GROUP BY 1, 2),
shares AS (SELECT service, borough, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY service) AS share FROM c)"""


def _shares(spark, sf) -> DataFrame:
    return a.borough_share(a.borough_counts(trips(spark, sf), by=["service"]))


@query("borough_share", f"WITH {_SHARES} SELECT service, borough, round(share, 4) AS share FROM shares")
def borough_share(spark, sf):
    return _rounded(_shares(spark, sf), "share")


_BOROUGHS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("borough_share_matrix", f"""
WITH {_SHARES}
SELECT service, {', '.join(f'''round(coalesce(sum(share) FILTER (borough = '{b}'), 0.0), 4) AS "{b}"''' for b in _BOROUGHS)}
FROM shares GROUP BY service""")
def borough_share_matrix(spark, sf):
    return _rounded(a.borough_share_matrix(_shares(spark, sf)), *_BOROUGHS)


@query("service_cosine", f"""
WITH {_SHARES}, n AS (SELECT service, sqrt(sum(share * share)) AS norm FROM shares GROUP BY 1),
d AS (SELECT p.service AS service_a, q.service AS service_b, sum(p.share * q.share) AS dot
      FROM shares p JOIN shares q ON p.borough = q.borough GROUP BY 1, 2)
SELECT service_a, service_b, round(dot / (na.norm * nb.norm), 4) AS cosine
FROM d JOIN n na ON na.service = service_a JOIN n nb ON nb.service = service_b""")
def service_cosine(spark, sf):
    return _rounded(a.service_cosine(_shares(spark, sf), SERVICES), "cosine")


@query("service_summary", f"""
WITH {RIDES}
SELECT service, round(CAST(avg(CASE WHEN tip_amount > 0 THEN 1.0 ELSE 0.0 END) * 100 AS DOUBLE), 6) AS tipped_pct,
       round(median(tip_amount) FILTER (tip_amount > 0), 6) AS median_tip,
       round(median(fare_amount) FILTER (fare_amount > 0), 6) AS median_fare,
       round(median(date_part('epoch', dropoff_datetime) - date_part('epoch', pickup_datetime))
             FILTER (dropoff_datetime > pickup_datetime) / 60.0, 6) AS median_duration_min
FROM rides GROUP BY service""")
def service_summary(spark, sf):
    columns = ["tipped_pct", "median_tip", "median_fare", "median_duration_min"]
    return _rounded(a.service_summary(rides(spark, sf)), *columns, digits=6)


@query("hourly_share", """
WITH c AS (SELECT event_type AS service, CAST(extract('hour' FROM ts) AS INTEGER) AS hour_of_day, count(*) AS n
           FROM events GROUP BY 1, 2)
SELECT service, hour_of_day, round(CAST(n AS DOUBLE) * 100 / sum(n) OVER (PARTITION BY service), 4) AS share_pct FROM c""")
def hourly_share(spark, sf):
    events = table(spark, sf, "events").withColumnRenamed("event_type", "service")
    return _rounded(a.hourly_share(events, "ts", ["service"]), "share_pct")


@query("monthly_rides", f"""
WITH {RIDES}
SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, service, CAST(month(pickup_datetime) AS INTEGER) AS month,
       count(*) AS trips FROM rides WHERE service <> 'FHVHV' GROUP BY 1, 2, 3""")
def monthly_rides(spark, sf):
    return a.monthly_rides(rides(spark, sf).where("service <> 'FHVHV'"), by=["service"])


@query("monthly_rides_by_company", f"""
WITH {RIDES}
SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, hvfhs_license_num, CAST(month(pickup_datetime) AS INTEGER) AS month,
       count(*) AS trips FROM rides WHERE service = 'FHVHV' GROUP BY 1, 2, 3""")
def monthly_rides_by_company(spark, sf):
    return a.monthly_rides(rides(spark, sf).where("service = 'FHVHV'"), by=["hvfhs_license_num"])


_OPERATOR = """CASE hvfhs_license_num WHEN 'HV0002' THEN 'Juno' WHEN 'HV0003' THEN 'Uber' WHEN 'HV0004' THEN 'Via'
  WHEN 'HV0005' THEN 'Lyft' ELSE 'Other FHVHV' END"""


@query("map_operator", f"""
WITH {RIDES}
SELECT hvfhs_license_num, {_OPERATOR} AS operator, count(*) AS trips FROM rides GROUP BY 1, 2""")
def map_operator(spark, sf):
    named = rides(spark, sf).withColumn("operator", codes.operator_name(F.col("hvfhs_license_num")))
    return named.groupBy("hvfhs_license_num", "operator").agg(F.count(F.lit(1)).alias("trips"))


_SERIES = f"""{RIDES}, m AS (
  SELECT year, CAST(month(pickup_datetime) AS INTEGER) AS month,
         CASE service WHEN 'Yellow' THEN 'Yellow Taxi' WHEN 'Green' THEN 'Green Taxi' ELSE {_OPERATOR} END AS operator,
         CASE WHEN service = 'FHVHV' THEN hvfhs_license_num END AS license, count(*) AS trips
  FROM rides GROUP BY 1, 2, 3, 4),
series AS (SELECT year, month, operator, trips, make_date(year, month, 1) AS date FROM m),
shared AS (SELECT *, sum(trips) OVER (PARTITION BY date) AS total_trips,
           CAST(trips AS DOUBLE) / sum(trips) OVER (PARTITION BY date) AS share FROM series)"""


def _series(spark, sf) -> DataFrame:
    r = rides(spark, sf)
    whole = {
        "Yellow Taxi": a.monthly_rides(r.where("service = 'Yellow'")),
        "Green Taxi": a.monthly_rides(r.where("service = 'Green'")),
    }
    licensed = a.monthly_rides(r.where("service = 'FHVHV'"), by=["hvfhs_license_num"])
    return a.monthly_share(a.operator_series(whole, licensed, "hvfhs_license_num"))


@query("monthly_share", f"""
WITH {_SERIES}
SELECT year, month, operator, trips, date, CAST(total_trips AS BIGINT) AS total_trips, round(share, 4) AS share FROM shared""")
def monthly_share(spark, sf):
    return _rounded(_series(spark, sf), "share")


_OPERATOR_NAMES = ["Green Taxi", "Juno", "Lyft", "Other FHVHV", "Uber", "Via", "Yellow Taxi"]


@query("pivot_operator_share", f"""
WITH {_SERIES}
SELECT date, {', '.join(f'''round(coalesce(avg(share) FILTER (operator = '{o}'), 0.0), 4) AS "{o}"''' for o in _OPERATOR_NAMES)}
FROM shared GROUP BY date ORDER BY date""")
def pivot_operator_share(spark, sf):
    return _rounded(a.pivot_operator_share(_series(spark, sf)), *_OPERATOR_NAMES)


@query("sql_view_trips_per_year", f"""
WITH {RIDES}
SELECT year, count(*) AS num_trips FROM rides GROUP BY year ORDER BY year""")
def sql_view_trips_per_year(spark, sf):
    from tripkit.sources.readers import register

    register({"rides_view": rides(spark, sf)})
    return spark.sql("SELECT year, count(*) AS num_trips FROM rides_view GROUP BY year ORDER BY year")


@query("explore_counts", f"""
WITH {TRIPS}
SELECT 'year' AS kind, CAST(year AS VARCHAR) AS a, CAST(NULL AS VARCHAR) AS b, count(*) AS num_trips FROM trips GROUP BY 2
UNION ALL SELECT 'borough', pickup_borough, NULL, count(*) FROM trips WHERE pickup_borough IS NOT NULL GROUP BY 2
UNION ALL SELECT 'zones', CAST(pu_zone AS VARCHAR), CAST(do_zone AS VARCHAR), count(*) FROM trips GROUP BY 2, 3
UNION ALL SELECT 'boroughs', pickup_borough, dropoff_borough, count(*) FROM trips
  WHERE pickup_borough IS NOT NULL AND dropoff_borough IS NOT NULL GROUP BY 2, 3""")
def explore_counts(spark, sf):
    """Several counts derived from one table of base counts."""
    zoned = trips(spark, sf).withColumnsRenamed({"pu_zone": "PULocationID", "do_zone": "DOLocationID"})
    base = a.base_counts(zoned)
    wanted = {
        "year": ["year"], "borough": ["pickup_borough"], "zones": ["PULocationID", "DOLocationID"],
        "boroughs": ["pickup_borough", "dropoff_borough"],
    }
    out = None
    for kind, keys in wanted.items():
        second = F.col(keys[1]).cast("string") if len(keys) > 1 else F.lit(None).cast("string")
        part = a.recount(base, keys).select(
            F.lit(kind).alias("kind"), F.col(keys[0]).cast("string").alias("a"), second.alias("b"), "num_trips"
        )
        out = part if out is None else out.unionByName(part)
    return out

"""Lookup joins, nearest places, distance and space-time joins, geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.functions.geo import mercator_x, mercator_y, parse_polygons, polygons_centroid
from tripkit.operators import lookups as lk
from tripkit.operators import proximity as px
from workload.registry import query
from workload.views import (
    ETRIPS,
    HAPPENINGS,
    LOCAL_WEATHER,
    OTRIPS,
    POIS,
    SHOPS,
    ZONES,
    etrips,
    happenings,
    lat_of,
    lon_of,
    otrips,
    pois,
    shops,
    sql_lat,
    sql_lon,
    sql_x,
    sql_y,
    table,
    weather,
    zones,
)

_POINT, _PLACE, _SHOP, _EVENT = ("x", "y"), ("px", "py"), ("px", "py"), ("hx", "hy")


@query("zone_lookup_join", f"""
WITH {ZONES}, t AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 99 ELSE c_nationkey END AS pu, c_custkey % 27 AS de FROM customer)
SELECT c_custkey, CAST(pu AS INTEGER) AS "PULocationID", CAST(de AS INTEGER) AS "DOLocationID", o.Borough AS pickup_borough, o.Zone AS pickup_zone,
       d.Borough AS dropoff_borough, d.Zone AS dropoff_zone
FROM t LEFT JOIN zones o ON pu = o.LocationID LEFT JOIN zones d ON de = d.LocationID""")
def zone_lookup_join(spark, sf):
    key = F.col("c_custkey")
    raw = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(key % 10 == 0, F.lit(99)).otherwise(F.col("c_nationkey")).alias("PULocationID"),
        (key % 27).cast("int").alias("DOLocationID"),
    )
    return lk.zone_lookup(raw, zones(spark, sf), {"Borough": "borough", "Zone": "zone"})


@query("zone_centroid_inner", f"""
WITH {ZONES}, c AS (SELECT CASE WHEN s_nationkey = 3 THEN 103 ELSE s_nationkey END AS LocationID, round(avg({sql_lon('s_suppkey')}), 6) AS centroid_lng,
  round(avg({sql_lat('s_suppkey')}), 6) AS centroid_lat FROM supplier GROUP BY 1)
SELECT LocationID, Zone, Borough, centroid_lng, centroid_lat FROM zones JOIN c USING (LocationID)""")
def zone_centroid_inner(spark, sf):
    zone = F.when(F.col("s_nationkey") == 3, F.lit(103)).otherwise(F.col("s_nationkey"))  # 103 is no known zone
    centroids = table(spark, sf, "supplier").groupBy(zone.alias("LocationID")).agg(
        F.round(F.avg(lon_of("s_suppkey")), 6).alias("centroid_lng"),
        F.round(F.avg(lat_of("s_suppkey")), 6).alias("centroid_lat"),
    )
    return lk.zone_centroids(zones(spark, sf), centroids)


_BUSINESSES = """businesses AS (
  SELECT c_custkey, c_nationkey + CASE WHEN c_custkey % 9 = 0 THEN 100 ELSE 0 END AS zip,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS lon,
         CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal / 2 END AS lat FROM customer)"""


def _businesses(spark, sf) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        "c_custkey",
        (F.col("c_nationkey") + F.when(key % 9 == 0, F.lit(100)).otherwise(F.lit(0))).alias("zip"),
        F.when(key % 3 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("lon"),
        F.when(key % 4 != 0, F.col("c_acctbal") / 2).alias("lat"),
    )


def _zips(spark, sf) -> DataFrame:
    """ZIP table from the nations; the codes of one region are listed twice, and one nation has a code of its own."""
    copies = F.when(F.col("n_regionkey") == 0, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.array(F.lit(1.0)))
    code = F.when(F.col("n_nationkey") == 7, F.lit(207)).otherwise(F.col("n_nationkey")).alias("code")
    return table(spark, sf, "nation").select(code, F.explode(copies).alias("copy")).select(
        "code", (F.col("code") + F.col("copy")).alias("zlat"), (F.col("code") * F.lit(-1.5) * F.col("copy")).alias("zlng")
    )


_ZIPS = """zips AS (SELECT code, code + copy AS zlat, code * CAST(-1.5 AS DOUBLE) * copy AS zlng FROM (
  SELECT CASE WHEN n_nationkey = 7 THEN 207 ELSE n_nationkey END AS code, unnest(CASE WHEN n_regionkey = 0 THEN [1::DOUBLE, 2::DOUBLE] ELSE [1::DOUBLE] END) AS copy
  FROM nation))"""


def _fill(spark, sf, dedupe: bool) -> DataFrame:
    return lk.fill_coordinates(
        _businesses(spark, sf), _zips(spark, sf), zip_key="zip", lon="lon", lat="lat",
        zips_key="code", zips_lon="zlng", zips_lat="zlat", dedupe=dedupe,
    )


@query("coalesce_join", f"""
WITH {_BUSINESSES}, {_ZIPS}
SELECT c_custkey, zip, CAST(coalesce(lon, zlng) AS DOUBLE) AS lon, CAST(coalesce(lat, zlat) AS DOUBLE) AS lat
FROM businesses LEFT JOIN zips ON zip = code WHERE coalesce(lon, zlng) IS NOT NULL AND coalesce(lat, zlat) IS NOT NULL""")
def coalesce_join(spark, sf):
    return _fill(spark, sf, dedupe=False)


@query("coalesce_join_deduped", f"""
WITH {_BUSINESSES}, {_ZIPS}, one AS (SELECT code, min(zlat) AS zlat, arg_min(zlng, zlat) AS zlng FROM zips GROUP BY 1)
SELECT c_custkey, zip, CAST(coalesce(lon, zlng) AS DOUBLE) AS lon, CAST(coalesce(lat, zlat) AS DOUBLE) AS lat
FROM businesses LEFT JOIN one ON zip = code WHERE coalesce(lon, zlng) IS NOT NULL AND coalesce(lat, zlat) IS NOT NULL""")
def coalesce_join_deduped(spark, sf):
    return _fill(spark, sf, dedupe=True)


@query("weather_join", f"""
WITH {LOCAL_WEATHER}, t AS (SELECT event_id, ts FROM events)
SELECT event_id, ts, round(temperature, 4) AS temperature, readings FROM t LEFT JOIN local_weather
ON make_timestamp(CAST(round_even(epoch_us(ts) / 3600000000.0, 0) AS BIGINT) * 3600000000) = time""")
def weather_join(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts")
    joined = lk.weather_join(rows, lk.local_weather(weather(spark, sf)), trip_time="ts")
    return joined.withColumn("temperature", F.round("temperature", 4))


_YEAR_WEATHER = "w AS (SELECT o_orderkey AS id, TIMESTAMP '2024-10-25 00:00:00' + INTERVAL 1 HOUR * CAST(o_orderkey % 400 AS INTEGER) AS time FROM orders)"


@query("local_weather_deduped", f"""
WITH {_YEAR_WEATHER}, h AS (SELECT time, min(id) AS id FROM w GROUP BY 1),
l AS (SELECT timezone('America/New_York', timezone('UTC', time)) AS local, time, id FROM h)
SELECT local AS time, arg_min(id, time) AS id FROM l GROUP BY 1""")
def local_weather_deduped(spark, sf):
    start = F.lit("2024-10-25 00:00:00").cast("timestamp_ntz")
    hour = F.timestamp_add("HOUR", (F.col("o_orderkey") % 400).cast("int"), start).alias("time")
    hours = table(spark, sf, "orders").groupBy(hour).agg(F.min("o_orderkey").alias("id"))
    return lk.local_weather(hours, dedupe=True)


def _permits(spark, sf) -> DataFrame:
    key = F.col("o_orderkey")
    place = F.when(key % 5 == 0, F.concat((key % 30).cast("string"), F.lit(",7"))).when(
        key % 5 == 1, F.lit("n/a")).when(key % 5 != 2, (key % 30).cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", place.alias("precincts"))


_PERMITS = """permits AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN (o_orderkey % 30)::VARCHAR || ',7' WHEN 1 THEN 'n/a'
  WHEN 2 THEN NULL ELSE (o_orderkey % 30)::VARCHAR END AS precincts FROM orders)"""


@query("event_place_join", f"""
WITH {_PERMITS}
SELECT o_orderkey, precincts, n_name AS place_name FROM permits LEFT JOIN nation ON TRY_CAST(split_part(precincts, ',', 1) AS BIGINT) = n_nationkey""")
def event_place_join(spark, sf):
    places = table(spark, sf, "nation").withColumnRenamed("n_name", "place_name")
    return lk.place_events(
        _permits(spark, sf), places, event_place="precincts", place_key="n_nationkey", columns=["place_name"]
    )


@query("event_place_join_matched", f"""
WITH {_PERMITS}
SELECT o_orderkey, precincts, n_name AS place_name FROM permits JOIN nation ON TRY_CAST(split_part(precincts, ',', 1) AS BIGINT) = n_nationkey""")
def event_place_join_matched(spark, sf):
    places = table(spark, sf, "nation").withColumnRenamed("n_name", "place_name")
    return lk.place_events(
        _permits(spark, sf), places, event_place="precincts", place_key="n_nationkey", columns=["place_name"],
        drop_unmatched=True,
    )


@query("first_per_key", """
SELECT user_id, min(ts) AS ts, arg_min(CASE WHEN event_id % 3 <> 0 THEN value END, event_id) FILTER (event_id % 3 <> 0) AS value,
       arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def first_per_key(spark, sf):
    rows = table(spark, sf, "events").select(
        "user_id", "event_id", "ts", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"), "event_type"
    )
    return lk.first_per_key(rows, ["user_id"], F.col("event_id")).drop("event_id")


# --- geometry -----------------------------------------------------------------------------

@query("web_mercator", f"""
WITH p AS (SELECT o_orderkey, {sql_lon('o_orderkey')} AS lon, {sql_lat('o_orderkey')} AS lat FROM orders)
SELECT o_orderkey, round({sql_x('lon')}, 3) AS x, round({sql_y('lat')}, 3) AS y FROM p""")
def web_mercator(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.round(mercator_x(lon_of("o_orderkey")), 3).alias("x"), F.round(mercator_y(lat_of("o_orderkey")), 3).alias("y"),
    )


@query("polygon_centroid", """
WITH p AS (SELECT s_suppkey AS id, CAST(s_suppkey % 100 AS DOUBLE) AS a, CAST(s_suppkey % 7 + 4 AS DOUBLE) AS w FROM supplier)
SELECT id,
  round((w * w * (a + w / 2) - 1 * (a + 1.5) + 4 * (a + 101)) / (w * w - 1 + 4), 5) AS lng,
  round((w * w * (w / 2) - 1 * 1.5 + 4 * 1) / (w * w - 1 + 4), 5) AS lat FROM p""")
def polygon_centroid(spark, sf):
    """A square of side w with a unit hole, and a second square of side 2, as quoted text."""
    parts = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 100).alias("a"), (F.col("s_suppkey") % 7 + 4).alias("w")
    )

    def ring(x1, y1, x2, y2):
        corners = [(x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1)]
        pairs = [F.concat(F.lit("["), x.cast("string"), F.lit(", "), y.cast("string"), F.lit("]")) for x, y in corners]
        return F.concat(F.lit("["), F.concat_ws(", ", *pairs), F.lit("]"))

    a, w, zero, one, two = F.col("a"), F.col("w"), F.lit(0), F.lit(1), F.lit(2)
    text = F.concat(
        F.lit("{'type': 'MultiPolygon', 'coordinates': [["), ring(a, zero, a + w, w), F.lit(", "),
        ring(a + 1, one, a + 2, two), F.lit("], ["), ring(a + 100, zero, a + 102, two), F.lit("]]}"),
    )
    lng, lat = polygons_centroid(F.col("polygons"))
    return parts.withColumn("polygons", parse_polygons(text)).select(
        "id", F.round(lng, 5).alias("lng"), F.round(lat, 5).alias("lat")
    )


# --- nearest places ---------------------------------------------------------------------------

def _d2(a: str, b: str, c: str, d: str) -> str:
    return f"(({a} - {c}) * ({a} - {c}) + ({b} - {d}) * ({b} - {d}))"


@query("nearest_neighbor", f"""
WITH {OTRIPS}, {POIS}, pairs AS (
  SELECT o_orderkey, s_suppkey, s_name, {_d2('x', 'y', 'px', 'py')} AS d2 FROM otrips CROSS JOIN pois
  WHERE x IS NOT NULL AND px IS NOT NULL),
best AS (SELECT o_orderkey, arg_min(s_name, (d2, s_suppkey)) AS nearest_name, min(d2) AS d2 FROM pairs GROUP BY 1)
SELECT o.o_orderkey, nearest_name, round(sqrt(d2), 3) AS dist FROM otrips o LEFT JOIN best b USING (o_orderkey)""")
def nearest_neighbor(spark, sf):
    found = px.nearest_place(
        otrips(spark, sf), pois(spark, sf), point=_POINT, place=_PLACE, place_id="s_suppkey",
        carry={"s_name": "nearest_name"}, distance="dist",
    )
    return found.select("o_orderkey", "nearest_name", F.round("dist", 3).alias("dist"))


@query("nearest_neighbor_grid", f"""
WITH {OTRIPS}, {SHOPS}, pairs AS (
  SELECT o_orderkey, c_custkey, {_d2('x', 'y', 'px', 'py')} AS d2 FROM otrips CROSS JOIN shops WHERE x IS NOT NULL),
best AS (SELECT o_orderkey, arg_min(c_custkey, (d2, c_custkey)) AS nearest_shop, min(d2) AS d2 FROM pairs GROUP BY 1)
SELECT o.o_orderkey, nearest_shop, round(sqrt(d2), 3) AS dist FROM otrips o LEFT JOIN best b USING (o_orderkey)""")
def nearest_neighbor_grid(spark, sf):
    found = px.nearest_place(
        otrips(spark, sf), shops(spark, sf), point=_POINT, place=_SHOP, place_id="c_custkey",
        carry={"c_custkey": "nearest_shop"}, distance="dist",
    )
    return found.select("o_orderkey", "nearest_shop", F.round("dist", 3).alias("dist"))


@query("nearest_first_per_time", f"""
WITH {OTRIPS}, {POIS}, pairs AS (
  SELECT o_orderkey, s_suppkey, s_name, {_d2('x', 'y', 'px', 'py')} AS d2 FROM otrips CROSS JOIN pois
  WHERE x IS NOT NULL AND px IS NOT NULL),
best AS (SELECT o_orderkey, arg_min(s_name, (d2, s_suppkey)) AS nearest_name, min(d2) AS d2 FROM pairs GROUP BY 1),
j AS (SELECT o.*, nearest_name, d2 FROM otrips o LEFT JOIN best b USING (o_orderkey))
SELECT o_orderdate, arg_min(nearest_name, o_orderkey) FILTER (nearest_name IS NOT NULL) AS nearest_name,
       round(sqrt(arg_min(d2, o_orderkey) FILTER (d2 IS NOT NULL)), 3) AS dist FROM j GROUP BY 1""")
def nearest_first_per_time(spark, sf):
    found = px.nearest_place(
        otrips(spark, sf), pois(spark, sf), point=_POINT, place=_PLACE, place_id="s_suppkey",
        carry={"s_name": "nearest_name"}, distance="dist",
    ).select("o_orderdate", "o_orderkey", "nearest_name", "dist")
    once = lk.first_per_key(found, ["o_orderdate"], F.col("o_orderkey"))
    return once.select("o_orderdate", "nearest_name", F.round("dist", 3).alias("dist"))


# --- distance and space-time joins -----------------------------------------------------------

@query("within_distance_join", f"""
WITH {OTRIPS}, {POIS}
SELECT o_orderkey, s_suppkey FROM otrips JOIN pois ON {_d2('x', 'y', 'px', 'py')} <= 1500.0 * 1500.0""")
def within_distance_join(spark, sf):
    joined = px.within_distance(otrips(spark, sf), pois(spark, sf), 1500.0, point=_POINT, place=_PLACE, how="inner")
    return joined.select("o_orderkey", "s_suppkey")


@query("within_distance_left", f"""
WITH {OTRIPS}, {POIS}
SELECT o_orderkey, s_suppkey, round(sqrt({_d2('x', 'y', 'px', 'py')}), 3) AS dist
FROM otrips LEFT JOIN pois ON {_d2('x', 'y', 'px', 'py')} <= 1000.0 * 1000.0""")
def within_distance_left(spark, sf):
    from tripkit.functions.geo import distance

    joined = px.within_distance(otrips(spark, sf), pois(spark, sf), 1000.0, point=_POINT, place=_PLACE, how="left")
    gap = distance(F.col("x"), F.col("y"), F.col("px"), F.col("py"))
    return joined.select("o_orderkey", "s_suppkey", F.round(gap, 3).alias("dist"))


@query("within_distance_salted", f"""
WITH {OTRIPS}, {POIS}
SELECT o_orderkey, s_suppkey FROM otrips LEFT JOIN pois ON {_d2('x', 'y', 'px', 'py')} <= 1000.0 * 1000.0""")
def within_distance_salted(spark, sf):
    joined = px.within_distance(
        otrips(spark, sf), pois(spark, sf), 1000.0, point=_POINT, place=_PLACE, how="left", salts=4
    )
    return joined.select("o_orderkey", "s_suppkey")


_NEAR = f"{_d2('x', 'y', 'hx', 'hy')} <= 5000.0 * 5000.0"
_SOON = "abs(epoch_us(start_ts) - epoch_us(trip_ts)) <= 3600000000"
_WINDOW = px.TimeWindow("trip_ts", "start_ts", 3600.0)


def _spacetime(spark, sf, semantics: str) -> DataFrame:
    joined = px.spacetime_join(
        etrips(spark, sf), happenings(spark, sf), 5000.0, _WINDOW, point=_POINT, place=_EVENT, semantics=semantics
    )
    return joined.select("trip_id", "happening_id", "start_ts")


@query("spacetime_join", f"""
WITH {ETRIPS}, {HAPPENINGS}
SELECT trip_id, happening_id, start_ts FROM etrips LEFT JOIN happenings ON {_NEAR} AND {_SOON}""")
def spacetime_join(spark, sf):
    return _spacetime(spark, sf, "left")


@query("spacetime_join_inner", f"""
WITH {ETRIPS}, {HAPPENINGS}
SELECT trip_id, happening_id, start_ts FROM etrips JOIN happenings ON {_NEAR} AND {_SOON}""")
def spacetime_join_inner(spark, sf):
    return _spacetime(spark, sf, "inner")


@query("spacetime_join_filter_after", f"""
WITH {ETRIPS}, {HAPPENINGS}
SELECT trip_id, happening_id, start_ts FROM etrips LEFT JOIN happenings ON {_NEAR} WHERE start_ts IS NULL OR {_SOON}""")
def spacetime_join_filter_after(spark, sf):
    return _spacetime(spark, sf, "filter_after")


@query("closest_event_in_window", f"""
WITH {ETRIPS}, {HAPPENINGS}, pairs AS (
  SELECT trip_id, happening_id, trip_ts, start_ts, {_d2('x', 'y', 'hx', 'hy')} AS d2
  FROM etrips JOIN happenings ON abs(epoch_us(start_ts) - epoch_us(trip_ts)) <= 43200000000),
best AS (SELECT trip_id, arg_min(happening_id, (d2, happening_id)) AS closest_event_id, min(d2) AS d2,
         arg_min((epoch_us(start_ts) - epoch_us(trip_ts)) / 3600000000.0, (d2, happening_id)) AS hours FROM pairs GROUP BY 1)
SELECT e.trip_id, closest_event_id, round(sqrt(d2), 3) AS closest_event_distance, round(CAST(hours AS DOUBLE), 4) AS closest_event_time_diff
FROM etrips e LEFT JOIN best USING (trip_id)""")
def closest_event_in_window(spark, sf):
    found = px.closest_event(
        etrips(spark, sf), happenings(spark, sf), px.TimeWindow("trip_ts", "start_ts", 12 * 3600.0),
        point=_POINT, place=_EVENT, event_id="happening_id",
    )
    return found.select(
        "trip_id", "closest_event_id", F.round("closest_event_distance", 3).alias("closest_event_distance"),
        F.round("closest_event_time_diff", 4).alias("closest_event_time_diff"),
    )

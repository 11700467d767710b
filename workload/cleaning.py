"""Code normalisers, schema operators and data-quality rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.functions import codes, temporal
from tripkit.operators import quality as q
from tripkit.operators import schema as s
from tripkit.schemas import Box, FareRule
from workload.registry import query
from workload.views import RIDES, lat_of, lon_of, rides, sql_lat, sql_lon, table


def _raw_code(values: list[str | None], key: str) -> Column:
    """One of the given spellings per row, chosen by a key of the table."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (F.col(key) % len(values) + 1).cast("int"))


def _sql_raw(values: list[str | None], key: str) -> str:
    listed = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"[{listed}][CAST({key} % {len(values)} + 1 AS INTEGER)]"


def _code_query(name: str, values: list[str | None], code, sql_code: str) -> None:
    """Normalise a derived raw column over all line items; count rows per spelling and code."""
    sql = f"""
    WITH r AS (SELECT {_sql_raw(values, 'l_partkey')} AS raw FROM lineitem)
    SELECT raw, CAST({sql_code} AS INTEGER) AS code, count(*) AS n FROM r GROUP BY 1, 2"""

    @query(name, sql)
    def run(spark, sf):
        raw = table(spark, sf, "lineitem").select(_raw_code(values, "l_partkey").alias("raw"))
        return raw.withColumn("code", code(F.col("raw"))).groupBy("raw", "code").agg(F.count(F.lit(1)).alias("n"))


_NUM = "TRY_CAST(raw AS DOUBLE)"

_code_query(
    "norm_vendor",
    ["CMT", "VTS", "DDS", "1", "2", "6.0", "7", "3", "xyz", "NaN", "2.5", None],
    codes.vendor_code,
    f"CASE WHEN raw = 'CMT' THEN 1 WHEN raw IN ('DDS', 'VTS') THEN 2 WHEN {_NUM} IN (1, 2, 6, 7) THEN {_NUM} ELSE -1 END",
)
_code_query(
    "norm_rate_code",
    ["1", "2.0", "6", "7", "99", "0", "abc", "NaN", None],
    codes.rate_code,
    f"CASE WHEN {_NUM} IN (1, 2, 3, 4, 5, 6, 99) THEN {_NUM} ELSE 99 END",
)
_code_query(
    "norm_flag",
    ["Y", "N", " Y", "N ", "0", "1", "1.0", "0.5", "1.9", "2", "*", "-0.4", "NaN", None],
    codes.store_and_forward_code,
    f"""CASE WHEN trim(raw) = 'Y' THEN 1 WHEN trim(raw) = 'N' THEN 0
        WHEN NOT isnan({_NUM}) AND trunc({_NUM}) IN (0, 1) THEN trunc({_NUM}) ELSE -1 END""",
)
_code_query(
    "norm_payment",
    ["Credit", " CRD ", "CRE", "Cash", "CSH", "cas", "No Charge", "noc", "No", "Dispute", "DIS", "NA", "3", "0.0", "6",
     "7", "bitcoin", None],
    codes.payment_code,
    f"""CASE WHEN lower(trim(raw)) IN ('credit', 'crd', 'cre') THEN 1 WHEN lower(trim(raw)) IN ('cash', 'csh', 'cas') THEN 2
        WHEN lower(trim(raw)) IN ('no charge', 'noc', 'no') THEN 3 WHEN lower(trim(raw)) IN ('dispute', 'dis') THEN 4
        WHEN {_NUM} IN (0, 1, 2, 3, 4, 5, 6) THEN {_NUM} ELSE 5 END""",
)
_code_query(
    "norm_trip_type",
    ["1", "2", "1.0", "3", "x", None],
    codes.trip_type_code,
    f"CASE WHEN {_NUM} IN (1, 2) THEN {_NUM} ELSE -1 END",
)
_code_query(
    "norm_yn_flag",
    ["Y", "N", " Y ", "N ", "y", "", "1", None],
    codes.yes_no_code,
    "CASE trim(raw) WHEN 'Y' THEN 1 WHEN 'N' THEN 0 ELSE -1 END",
)
_code_query(
    "first_token_int",
    ["14", "14,18", "7,", ",9", "abc", "120, 121", None],
    lambda raw: codes.first_token_int(raw).cast("int"),
    "TRY_CAST(split_part(raw, ',', 1) AS INTEGER)",
)


@query("issue_labels", f"""
WITH r AS (SELECT {_sql_raw(['bad_timestamps', 'bad_distance', 'bad_coordinates', 'bad_prices', 'bad_fares', 'bad_request_time', 'other'], 'l_partkey')} AS raw
           FROM lineitem)
SELECT raw, CASE raw WHEN 'bad_timestamps' THEN 'Timestamp issues' WHEN 'bad_distance' THEN 'Infeasible distances'
  WHEN 'bad_coordinates' THEN 'Invalid coordinates' WHEN 'bad_prices' THEN 'Pricing issues' WHEN 'bad_fares' THEN 'Pricing issues'
  WHEN 'bad_request_time' THEN 'Request time issues' END AS label, count(*) AS n FROM r GROUP BY 1, 2""")
def issue_labels(spark, sf):
    names = [*codes.ISSUE_LABELS, "other"]
    raw = table(spark, sf, "lineitem").select(_raw_code(names, "l_partkey").alias("raw"))
    return raw.groupBy("raw", codes.issue_label(F.col("raw")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


_ZIPS = ["10001", "1000", "N/A", "10013.0", "", "11201-33", None]


@query("zip_coerce", f"""
WITH r AS (SELECT l_orderkey, {_sql_raw(_ZIPS, 'l_partkey')} AS raw FROM lineitem)
SELECT CAST(TRY_CAST(raw AS DOUBLE) AS BIGINT) AS zip, count(*) AS n, sum(l_orderkey)::BIGINT AS keys
FROM r WHERE TRY_CAST(raw AS DOUBLE) IS NOT NULL GROUP BY 1""")
def zip_coerce(spark, sf):
    raw = table(spark, sf, "lineitem").select("l_orderkey", _raw_code(_ZIPS, "l_partkey").alias("raw"))
    coerced = raw.withColumn("zip", codes.whole_number(F.col("raw"))).dropna(subset=["zip"])
    return coerced.groupBy("zip").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


@query("clean_ids", f"""
WITH r AS (SELECT {_sql_raw([' B001', 'B002 ', 'B003', None], 'l_partkey')} AS raw FROM lineitem)
SELECT trim(coalesce(raw, '')) AS id, count(*) AS n FROM r GROUP BY 1""")
def clean_ids(spark, sf):
    raw = table(spark, sf, "lineitem").select(_raw_code([" B001", "B002 ", "B003", None], "l_partkey").alias("raw"))
    return raw.groupBy(codes.clean_id(F.col("raw")).alias("id")).agg(F.count(F.lit(1)).alias("n"))


@query("formatted_counts", f"""
WITH {RIDES}, c AS (SELECT service, count(*) AS n, (SELECT count(*) FROM rides) AS total FROM rides GROUP BY 1)
SELECT service, format('{{:,}}', n) AS trips, CAST(CAST(round_even(n * 100.0 / total, 0) AS BIGINT) AS VARCHAR) || '%' AS pct FROM c""")
def formatted_counts(spark, sf):
    from tripkit.operators.analytics import share_of_total

    counted = rides(spark, sf).groupBy("service").agg(F.count(F.lit(1)).alias("n"))
    shared = share_of_total(counted, "n", [], "pct", 100.0)
    return shared.select("service", codes.thousands(F.col("n")).alias("trips"), codes.percent_text(F.col("pct")).alias("pct"))


@query("joined_names", """
SELECT p_partkey, p_brand || ' ' || coalesce(CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_type END, 'nan') AS name FROM part""")
def joined_names(spark, sf):
    kind = F.when(F.col("p_size") % 5 != 0, F.col("p_type"))
    return table(spark, sf, "part").select(
        "p_partkey", codes.joined_name(F.col("p_brand"), kind, null_text="nan").alias("name")
    )


# --- projections ----------------------------------------------------------------------

@query("rename_chain", """
SELECT o_orderkey AS vendor_id, o_orderdate AS pickup_datetime, o_totalprice AS fare_amount, o_custkey AS "PULocationID",
       o_orderstatus AS untouched FROM orders""")
def rename_chain(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("vendor_name"), F.col("o_orderdate").alias("Trip_Pickup_DateTime"),
        F.col("o_totalprice").alias("Fare_Amt"), F.col("o_custkey").alias("PUlocationID"),
        F.col("o_orderstatus").alias("untouched"),
    )
    return s.rename_columns(raw)


@query("add_missing_columns", """
SELECT c_custkey, c_acctbal, CAST(0.0 AS DOUBLE) AS airport_fee, CAST(NULL AS VARCHAR) AS note FROM customer""")
def add_missing_columns(spark, sf):
    kept = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return s.add_missing(kept, {"c_acctbal": 0.0, "airport_fee": 0.0, "note": F.lit(None).cast("string")})


@query("fill_defaults", """
SELECT c_custkey, CASE WHEN c_custkey % 5 IN (0, 1) THEN 0.0 ELSE c_acctbal END AS fee,
       CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_nationkey END AS passengers,
       CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS base FROM customer""")
def fill_defaults(spark, sf):
    key = F.col("c_custkey")
    raw = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(key % 5 == 0, F.lit(float("nan"))).when(key % 5 != 1, F.col("c_acctbal")).alias("fee"),
        F.when(key % 3 != 0, F.col("c_nationkey")).alias("passengers"),
        F.when(key % 7 != 0, F.col("c_mktsegment")).alias("base"),
    )
    return s.fill_defaults(raw, {"fee": 0.0, "passengers": 0, "base": "", "absent": 1})


@query("conform_schema", """
SELECT CAST(o_orderkey AS INTEGER) AS trip, CAST(o_totalprice AS FLOAT) AS fare, o_orderdate AS at,
       CAST(o_custkey AS VARCHAR) AS rider FROM orders""")
def conform_schema(spark, sf):
    from pyspark.sql import types as T

    raw = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("rider"), F.col("o_orderdate").cast("string").alias("at"),
        F.col("o_totalprice").alias("fare"), F.col("o_orderkey").alias("trip"),
    )
    return s.conform(raw, T.StructType.fromDDL("trip int, fare float, at timestamp_ntz, rider string"))


@query("drop_columns", "SELECT s_suppkey, s_name FROM supplier")
def drop_columns(spark, sf):
    return s.drop_columns(table(spark, sf, "supplier"), "s_nationkey", "s_acctbal", "not_there")


@query("select_present_columns", "SELECT p_partkey, p_size FROM part")
def select_present_columns(spark, sf):
    return s.select_present(table(spark, sf, "part"), ["p_partkey", "missing", "p_size"])


@query("union_aligned", """
SELECT CAST(c_acctbal AS DOUBLE) AS acctbal, c_custkey AS key, c_name AS name, c_mktsegment AS segment, 'customer' AS source FROM customer
UNION ALL SELECT s_acctbal, s_suppkey, s_name, NULL, 'supplier' FROM supplier""")
def union_aligned(spark, sf):
    return s.union_aligned(_parties(spark, sf))


def _parties(spark, sf) -> dict[str, DataFrame]:
    return {
        "customer": table(spark, sf, "customer").select(
            F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"),
            F.col("c_mktsegment").alias("segment"),
        ),
        "supplier": table(spark, sf, "supplier").select(
            F.col("s_acctbal").alias("acctbal"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
        ),
    }


@query("union_as_string", """
SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, c_mktsegment AS segment, 'customer' AS source FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, 'supplier' FROM supplier""")
def union_as_string(spark, sf):
    frames = {name: df.drop("acctbal") for name, df in _parties(spark, sf).items()}
    return s.union_aligned(frames, as_string=True)


_DATES = ["2024-03-10 07:00:00", "not a date", "2024-02-30", "2023-12-31T23:59:59", None]


@query("parse_datetime_coerce", f"""
WITH r AS (SELECT {_sql_raw(_DATES, 'l_partkey')} AS raw FROM lineitem)
SELECT raw, TRY_CAST(raw AS TIMESTAMP) AS at, count(*) AS n FROM r GROUP BY 1, 2""")
def parse_datetime_coerce(spark, sf):
    raw = table(spark, sf, "lineitem").select(_raw_code(_DATES, "l_partkey").alias("raw"))
    parsed = raw.withColumn("at", temporal.parse_datetime(F.col("raw"), strict=False))
    return parsed.groupBy("raw", "at").agg(F.count(F.lit(1)).alias("n"))


@query("time_parts", """
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour,
       CAST((dayofweek(ts) + 6) % 7 AS INTEGER) AS dow FROM events""")
def time_parts(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", F.year(ts).alias("year"), F.month(ts).alias("month"), F.hour(ts).alias("hour"),
        temporal.weekday_monday_zero(ts).alias("dow"),
    )


@query("trip_duration", f"""
WITH {RIDES}
SELECT service, round(sum(date_diff('second', pickup_datetime, dropoff_datetime) / 3600.0)::DOUBLE, 4) AS hours,
       round(sum(date_diff('second', pickup_datetime, dropoff_datetime) / 60.0)::DOUBLE, 4) AS minutes,
       CAST(sum(date_diff('second', pickup_datetime, dropoff_datetime)) AS DOUBLE) AS seconds FROM rides GROUP BY 1""")
def trip_duration(spark, sf):
    p, d = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return rides(spark, sf).groupBy("service").agg(
        F.round(F.sum(temporal.hours_between(p, d)), 4).alias("hours"),
        F.round(F.sum(temporal.minutes_between(p, d)), 4).alias("minutes"),
        F.sum(temporal.seconds_between(p, d)).alias("seconds"),
    )


@query("round_to_hour", """
WITH t AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN date_trunc('hour', ts) + INTERVAL 30 MINUTE ELSE ts END AS moment FROM events)
SELECT event_id, moment, make_timestamp(CAST(round_even(epoch_us(moment) / 3600000000.0, 0) AS BIGINT) * 3600000000) AS rounded FROM t""")
def round_to_hour(spark, sf):
    half = F.timestamp_add("MINUTE", F.lit(30), F.date_trunc("HOUR", "ts").cast("timestamp_ntz"))
    at = F.when(F.col("event_id") % 4 == 0, half).otherwise(F.col("ts"))
    return table(spark, sf, "events").select("event_id", at.alias("moment")).withColumn(
        "rounded", temporal.round_to_hour(F.col("moment"))
    )


@query("utc_to_local", """
WITH t AS (SELECT event_id, ts + INTERVAL 1 HOUR * CAST(event_id % 8760 AS INTEGER) AS utc FROM events)
SELECT event_id, utc, timezone('America/New_York', timezone('UTC', utc)) AS local FROM t""")
def utc_to_local(spark, sf):
    shifted = F.timestamp_add("HOUR", (F.col("event_id") % 8760).cast("int"), F.col("ts")).alias("utc")
    return table(spark, sf, "events").select("event_id", shifted).withColumn("local", temporal.utc_to_local(F.col("utc")))


@query("month_start", f"""
WITH {RIDES}
SELECT make_date(year, month(pickup_datetime), 1) AS date, count(*) AS n FROM rides GROUP BY 1""")
def month_start(spark, sf):
    day = temporal.month_start(F.year("pickup_datetime"), F.month("pickup_datetime"))
    return rides(spark, sf).groupBy(day.alias("date")).agg(F.count(F.lit(1)).alias("n"))


_FAR = "CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate + INTERVAL 300 YEAR WHEN o_orderkey % 10 = 1 THEN NULL ELSE o_orderdate END"


@query("nanosecond_range", f"""
WITH t AS (SELECT o_orderkey, {_FAR} AS moment FROM orders)
SELECT o_orderkey, moment FROM t WHERE moment BETWEEN TIMESTAMP '1677-09-21 00:12:43.145225' AND TIMESTAMP '2262-04-11 23:47:16.854775'""")
def nanosecond_range(spark, sf):
    key = F.col("o_orderkey")
    at = F.when(key % 10 == 0, F.timestamp_add("YEAR", F.lit(300), F.col("o_orderdate"))).when(key % 10 != 1, F.col("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", at.alias("moment")).where(temporal.in_nanosecond_range(F.col("moment")))


# --- quality rules ------------------------------------------------------------------------
# Limits are scaled to the tables: trips last days and cost thousands.
_YEARS = (1996, 2000)
_BOX = Box(west=-74.248064, south=40.505232, east=-73.708116, north=40.908582)
_TIME_OK = """coalesce(pickup_datetime < dropoff_datetime
  AND (year(pickup_datetime) = year(dropoff_datetime)
       OR (year(dropoff_datetime) = year(pickup_datetime) + 1 AND month(pickup_datetime) = 12 AND day(pickup_datetime) = 31
           AND month(dropoff_datetime) = 1 AND day(dropoff_datetime) = 1))
  AND year(pickup_datetime) BETWEEN 1996 AND 2000, false)"""
_DIST_OK = """coalesce(date_diff('second', pickup_datetime, dropoff_datetime) BETWEEN 86400 AND 34560000
  AND trip_distance > 0
  AND trip_distance < date_diff('second', pickup_datetime, dropoff_datetime) / CAST(3600 AS DOUBLE) * CAST(0.01 AS DOUBLE), false)"""
_BOX_OK = """coalesce(CAST(lon AS FLOAT) BETWEEN CAST(-74.248064 AS FLOAT) AND CAST(-73.708116 AS FLOAT)
  AND CAST(lat AS FLOAT) BETWEEN CAST(40.505232 AS FLOAT) AND CAST(40.908582 AS FLOAT), false)"""
_PRICE_OK = """coalesce(fare_amount > 2500 AND tip_amount >= 0 AND tax >= 0 AND total > 0 AND total BETWEEN 2500 AND 90000
  AND fare_amount + tax > 0 AND fare_amount + tax <= total, false)"""

_DRIVES = f"""{RIDES}, drives AS (
  SELECT *, CAST(CASE WHEN l_linenumber = 4 THEN NULL ELSE {sql_lon('l_orderkey')} END AS FLOAT) AS lon,
         CAST({sql_lat('l_orderkey')} AS FLOAT) AS lat,
         CASE WHEN l_partkey % 11 = 0 THEN -1.0 ELSE l_tax END AS tax,
         CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE fare_amount * 1.05 END AS total FROM rides)"""


def _drives(spark, sf) -> DataFrame:
    """Rides with positions and money parts, some of them missing, NaN or negative."""
    part = F.col("l_partkey")
    return rides(spark, sf).withColumns({
        "lon": F.when(F.col("l_linenumber") == 4, F.lit(float("nan"))).otherwise(lon_of("l_orderkey")).cast("float"),
        "lat": lat_of("l_orderkey").cast("float"),
        "tax": F.when(part % 11 == 0, F.lit(-1.0)).otherwise(F.col("l_tax")),
        "total": F.when(part % 13 == 0, F.lit(float("nan"))).otherwise(F.col("fare_amount") * 1.05),
    })


def _rules() -> dict[str, Column]:
    money = FareRule(
        flag="bad_prices", fare="fare_amount", total="total", non_negative=("tip_amount", "tax"), summed=("fare_amount", "tax")
    )
    return {
        "bad_timestamps": q.valid_timestamps("pickup_datetime", "dropoff_datetime", _YEARS),
        "bad_distance": q.valid_distance(
            "trip_distance", "pickup_datetime", "dropoff_datetime", limits=(86_400, 34_560_000), max_speed=0.01
        ),
        "bad_coordinates": q.valid_coordinates([("lon", "lat")], _BOX),
        "bad_prices": q.valid_fares(money, min_fare=2500, max_total=90_000),
    }


_FLAGGED = f"""{_DRIVES}, flagged AS (
  SELECT *, NOT {_TIME_OK} AS bad_timestamps, NOT {_DIST_OK} AS bad_distance, NOT {_BOX_OK} AS bad_coordinates,
         NOT {_PRICE_OK} AS bad_prices, {_TIME_OK} AND {_DIST_OK} AND {_BOX_OK} AND {_PRICE_OK} AS clean FROM drives)"""
_STATS = f"""{_FLAGGED}, stats AS (
  SELECT year, count(*) AS total_trips, count(*) FILTER (bad_timestamps) AS bad_timestamps,
         count(*) FILTER (bad_distance) AS bad_distance, count(*) FILTER (bad_coordinates) AS bad_coordinates,
         count(*) FILTER (bad_prices) AS bad_prices, count(*) FILTER (clean) AS clean_trips FROM flagged GROUP BY year)"""


def _rule_query(name: str, flag: str, sql_ok: str) -> None:
    @query(name, f"""
    WITH {_DRIVES}
    SELECT service, year, NOT {sql_ok} AS {flag}, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM drives GROUP BY 1, 2, 3""")
    def run(spark, sf):
        flagged = q.flag_issues(_drives(spark, sf), {flag: _rules()[flag]})
        return flagged.groupBy("service", "year", flag).agg(
            F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys")
        )


_rule_query("dq_timestamps", "bad_timestamps", _TIME_OK)
_rule_query("dq_distance", "bad_distance", _DIST_OK)
_rule_query("dq_coordinates", "bad_coordinates", _BOX_OK)
_rule_query("dq_prices", "bad_prices", _PRICE_OK)


@query("dq_distance_by_seconds", f"""
WITH {RIDES}, t AS (SELECT *, CAST(CASE WHEN l_linenumber = 3 THEN NULL ELSE l_partkey * 40 END AS FLOAT) AS trip_time FROM rides)
SELECT service, NOT coalesce(trip_time BETWEEN 60 AND 21600 AND trip_distance > 0
    AND trip_distance < CAST(trip_time AS DOUBLE) / CAST(3600 AS DOUBLE) * CAST(80 AS DOUBLE), false) AS bad_distance,
  count(*) AS n FROM t GROUP BY 1, 2""")
def dq_distance_by_seconds(spark, sf):
    seconds = F.when(F.col("l_linenumber") != 3, F.col("l_partkey") * 40).cast("float")
    timed = rides(spark, sf).withColumn("trip_time", seconds)
    flagged = q.flag_issues(timed, {"bad_distance": q.valid_distance("trip_distance", seconds="trip_time")})
    return flagged.groupBy("service", "bad_distance").agg(F.count(F.lit(1)).alias("n"))


@query("dq_fares_sum", f"""
WITH {_DRIVES}
SELECT service, NOT coalesce(fare_amount >= 0 AND tip_amount >= 0 AND tax >= 0
    AND fare_amount + tip_amount + tax BETWEEN 0 AND 60000, false) AS bad_fares, count(*) AS n FROM drives GROUP BY 1, 2""")
def dq_fares_sum(spark, sf):
    parts = ("fare_amount", "tip_amount", "tax")
    good = q.valid_fares(FareRule(flag="bad_fares", non_negative=parts, summed=parts), max_sum=60_000.0)
    flagged = q.flag_issues(_drives(spark, sf), {"bad_fares": good})
    return flagged.groupBy("service", "bad_fares").agg(F.count(F.lit(1)).alias("n"))


@query("dq_request_time", """
WITH t AS (SELECT event_id, ts AS pickup, CASE event_id % 6 WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 1 DAY
    WHEN 2 THEN ts - INTERVAL 86401 SECOND WHEN 3 THEN ts + INTERVAL 1 SECOND WHEN 4 THEN ts - INTERVAL 5 MINUTE END AS request FROM events)
SELECT event_id, NOT coalesce(request <= pickup AND request >= pickup - INTERVAL 1 DAY, false) AS bad_request_time FROM t""")
def dq_request_time(spark, sf):
    ts, kind = F.col("ts"), F.col("event_id") % 6
    request = (
        F.when(kind == 0, ts).when(kind == 1, F.timestamp_add("DAY", F.lit(-1), ts))
        .when(kind == 2, F.timestamp_add("SECOND", F.lit(-86_401), ts)).when(kind == 3, F.timestamp_add("SECOND", F.lit(1), ts))
        .when(kind == 4, F.timestamp_add("MINUTE", F.lit(-5), ts))
    )
    timed = table(spark, sf, "events").select("event_id", ts.alias("pickup"), request.alias("request"))
    flagged = q.flag_issues(timed, {"bad_request_time": q.valid_request_time("request", "pickup")})
    return flagged.select("event_id", "bad_request_time")


@query("dq_clean_filter", f"""
WITH {_FLAGGED}
SELECT service, l_orderkey, l_linenumber, l_partkey, pickup_datetime, dropoff_datetime, round(fare_amount, 4) AS fare_amount FROM flagged WHERE clean""")
def dq_clean_filter(spark, sf):
    columns = ["service", "l_orderkey", "l_linenumber", "l_partkey", "pickup_datetime", "dropoff_datetime"]
    kept = q.keep_clean(_drives(spark, sf), _rules())
    return kept.select(*columns, F.round("fare_amount", 4).alias("fare_amount"))


def _stats(spark, sf) -> DataFrame:
    rules = _rules()
    return q.stats_by_year(q.flag_issues(_drives(spark, sf), rules), list(rules))


@query("dq_stats_by_year", f"WITH {_STATS} SELECT * FROM stats ORDER BY year")
def dq_stats_by_year(spark, sf):
    return _stats(spark, sf).orderBy("year")


@query("merge_partial_stats", f"WITH {_STATS} SELECT * FROM stats")
def merge_partial_stats(spark, sf):
    rules = _rules()
    flagged = q.flag_issues(_drives(spark, sf), rules)
    parts = [
        q.stats_by_year(flagged.where(F.col("service") == name), list(rules)) for name in ("Yellow", "Green", "FHVHV")
    ]
    return q.merge_stats(*parts)


@query("dq_report", f"""
WITH {_STATS}, t AS (SELECT sum(total_trips) AS n, sum(clean_trips) AS c, sum(bad_timestamps) AS b1, sum(bad_distance) AS b2,
    sum(bad_coordinates) AS b3, sum(bad_prices) AS b4 FROM stats),
rows AS (SELECT 1 AS position, 'Timestamp issues' AS error_type, b1 AS trips, n FROM t
  UNION ALL SELECT 2, 'Infeasible distances', b2, n FROM t UNION ALL SELECT 3, 'Invalid coordinates', b3, n FROM t
  UNION ALL SELECT 4, 'Pricing issues', b4, n FROM t UNION ALL SELECT 5, 'Invalid trips', n - c, n FROM t
  UNION ALL SELECT 6, 'Clean trips', c, n FROM t)
SELECT position, error_type, CAST(trips AS BIGINT) AS trips, round(CAST(trips AS DOUBLE) * 100 / n, 4) AS pct_of_all FROM rows""")
def dq_report(spark, sf):
    report = q.dq_report(_stats(spark, sf))
    return report.withColumn("pct_of_all", F.round("pct_of_all", 4))


@query("dq_yearly_pct", f"""
WITH {_STATS}
SELECT year, issue_type, round(CAST(bad AS DOUBLE) * 100 / total_trips, 4) AS pct_of_trips FROM (
  SELECT year, total_trips, 'Timestamp issues' AS issue_type, bad_timestamps AS bad FROM stats
  UNION ALL SELECT year, total_trips, 'Infeasible distances', bad_distance FROM stats
  UNION ALL SELECT year, total_trips, 'Invalid coordinates', bad_coordinates FROM stats
  UNION ALL SELECT year, total_trips, 'Pricing issues', bad_prices FROM stats) WHERE year BETWEEN 1996 AND 2000""")
def dq_yearly_pct(spark, sf):
    return q.dq_yearly_pct(_stats(spark, sf), _YEARS).withColumn("pct_of_trips", F.round("pct_of_trips", 4))


@query("finite_points", f"""
WITH {_DRIVES} SELECT service, count(*) AS n FROM drives WHERE lon IS NOT NULL AND lat IS NOT NULL GROUP BY 1""")
def finite_points(spark, sf):
    from tripkit.functions.geo import usable_point

    kept = _drives(spark, sf).where(usable_point(F.col("lon"), F.col("lat")))
    return kept.groupBy("service").agg(F.count(F.lit(1)).alias("n"))

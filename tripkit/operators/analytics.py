"""Trip counts, shares, matrices, pivots and summaries.

Every function groups first, so what is sorted, pivoted or windowed afterwards is a small
frame of counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripkit.functions.codes import flow_label, operator_name
from tripkit.functions.temporal import month_start
from tripkit.operators.selection import approximate_median, exact_median, exact_medians, top_k, top_k_per_group
from tripkit.session import saved


def _count(df: DataFrame, keys: list[str | Column], name: str = "num_trips") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


COUNT_KEYS = ["year", "hour_of_day", "PULocationID", "DOLocationID", "pickup_borough", "dropoff_borough"]


def base_counts(df: DataFrame, pickup: str = "pickup_datetime") -> DataFrame:
    """Trips per year, hour of day, zone pair and borough pair.

    A few million rows at most, whatever the number of trips: every plain count of the standard
    set is a sum over it, so trips need to be scanned only once.
    """
    return _count(df.withColumn("hour_of_day", F.hour(pickup)), COUNT_KEYS)


def recount(base: DataFrame, keys: list[str], keep_null: bool = False) -> DataFrame:
    """Sum counted trips over fewer keys; rows with a missing key are left out unless kept."""
    if not keep_null:
        base = base.dropna(subset=keys)
    return base.groupBy(*keys).agg(F.sum("num_trips").alias("num_trips"))


def trips_per_year(df: DataFrame, year: str = "year") -> DataFrame:
    return _count(df, [year]).orderBy(year)


def trips_per_zone(df: DataFrame, zone: str = "PULocationID") -> DataFrame:
    return _count(df.where(F.col(zone).isNotNull()), [zone]).orderBy(F.col("num_trips").desc(), zone)


def trips_per_hour(df: DataFrame, pickup: str = "pickup_datetime") -> DataFrame:
    counted = _count(df, [F.hour(pickup).alias("hour_of_day")])
    return counted.orderBy(F.col("num_trips").desc(), "hour_of_day")


def trips_per_borough(df: DataFrame, borough: str = "pickup_borough", by: list[str] | None = None) -> DataFrame:
    counted = borough_counts(df, borough, by)
    return counted.orderBy(F.col("num_trips").desc(), *(by or []), borough)


def borough_counts(df: DataFrame, borough: str = "pickup_borough", by: list[str] | None = None) -> DataFrame:
    """Trips per borough in no order, to compute further with."""
    return _count(df.where(F.col(borough).isNotNull()), [*(by or []), borough])


def od_matrix(df: DataFrame, origin: str, destination: str, by: list[str] | None = None) -> DataFrame:
    """Trips per origin and destination; rows with either missing are left out."""
    known = df.where(F.col(origin).isNotNull() & F.col(destination).isNotNull())
    return _count(known, [*(by or []), origin, destination])


def top_od(df: DataFrame, origin: str, destination: str, k: int = 10) -> DataFrame:
    return top_k(od_matrix(df, origin, destination), k, "num_trips", [origin, destination])


def top_flows(od: DataFrame, origin: str, destination: str, by: list[str], k: int = 5) -> DataFrame:
    """Largest flows per service with an ``origin → destination`` label."""
    ranked = top_k_per_group(od, k, by, "num_trips", [origin, destination])
    return ranked.select(
        *by, "rank", flow_label(F.col(origin), F.col(destination)).alias("label"), F.col("num_trips").alias("trips")
    )


def _known(column: str) -> Column:
    return F.nanvl(F.col(column), F.lit(None).cast("double"))


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.where(_known(column) > 0)


def median_of(
    df: DataFrame, value: str, by: list[str] | None = None, *, name: str, approximate: bool = False
) -> DataFrame:
    return (approximate_median if approximate else exact_median)(df, value, by, name=name)


def median_duration(
    df: DataFrame,
    pickup: str = "pickup_datetime",
    dropoff: str = "dropoff_datetime",
    by: list[str] | None = None,
    *,
    name: str = "median_trip_duration_sec",
    approximate: bool = False,
) -> DataFrame:
    """Median trip seconds over trips whose dropoff is after their pickup."""
    seconds = F.timestamp_diff("MICROSECOND", F.col(pickup), F.col(dropoff)) / F.lit(1e6)
    timed = df.where(F.col(dropoff) > F.col(pickup)).withColumn("_seconds", seconds)
    return median_of(timed, "_seconds", by, name=name, approximate=approximate)


def _has_tip(tip: str) -> Column:
    return F.coalesce(F.nanvl(F.col(tip), F.lit(0.0)) > 0, F.lit(False))


def _tipped(tip: str) -> Column:
    return F.avg(_has_tip(tip).cast("double")) * 100.0


def tip_percentage(df: DataFrame, tip: str = "tip_amount") -> DataFrame:
    """Percent of trips with and without a tip; a missing tip counts as none."""
    share = df.agg(_tipped(tip).alias("_p"))
    rows = F.array(
        F.struct(F.lit("Tipped").alias("type"), F.col("_p").alias("percentage")),
        F.struct(F.lit("No Tip").alias("type"), (100.0 - F.col("_p")).alias("percentage")),
    )
    return share.select(F.inline(rows))


def share_of_total(df: DataFrame, value: str, by: list[str], name: str, scale: float = 1.0) -> DataFrame:
    """``value`` divided by its group total; null when the total is zero."""
    total = F.sum(value).over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))
    return df.withColumn(name, F.col(value) * F.lit(scale) / F.nullif(total, F.lit(0)))


def occurring(counts: DataFrame, column: str) -> list[str]:
    """The distinct values of a column of counted rows, in order: as many as a pivot has columns."""
    return sorted(r[0] for r in counts.select(column).distinct().collect() if r[0] is not None)


def pivot_counts(counts: DataFrame, row: str, column: str, values: list[str] | None, value: str = "num_trips") -> DataFrame:
    """One row per ``row``, one column per value of ``column``, missing combinations as 0.

    Without ``values`` all that occur get a column; with them only these do.
    """
    if values is None:
        values = occurring(counts, column)
    return counts.groupBy(row).pivot(column, values).agg(F.sum(value)).fillna(0, subset=values)


def yearly_market_share(counts: DataFrame, services: list[str], year: str = "year", digits: int = 2) -> DataFrame:
    """Percent of a year's trips per service, rounded; all zero in a year without trips."""
    wide = pivot_counts(counts, year, "service", services)
    total = reduce(lambda a, b: a + b, [F.col(s) for s in services])
    return wide.select(
        year,
        *[
            F.when(total == 0, F.lit(0.0)).otherwise(F.round(F.col(s) * F.lit(100.0) / total, digits)).alias(s)
            for s in services
        ],
    ).orderBy(year)


def borough_share(counts: DataFrame, borough: str = "pickup_borough") -> DataFrame:
    """Share of each borough in its service's trips (``service``, borough, ``share``)."""
    shared = share_of_total(counts, "num_trips", ["service"], "share")
    return shared.where(F.col("share").isNotNull()).select("service", F.col(borough).alias("borough"), "share")


def borough_share_matrix(shares: DataFrame, boroughs: list[str] | None = None) -> DataFrame:
    """Service by borough; all boroughs that occur unless some are listed."""
    return pivot_counts(shares, "service", "borough", boroughs, "share")


def service_cosine(shares: DataFrame, services: list[str]) -> DataFrame:
    """Cosine similarity of every ordered pair of services over their borough shares.

    Pairs without a common borough, or with a zero norm, get 0; services without shares are left out. One pass over the shares.
    ``services`` is the short list of service names, which spans the result.
    """
    share, at = F.col("share"), range(len(services))
    wide = shares.groupBy("borough").agg(
        *[F.sum(F.when(F.col("service") == s, share)).alias(f"_s{i}") for i, s in enumerate(services)]
    )
    known = F.col("borough").isNotNull()
    sums = [F.sum(F.when(known, F.col(f"_s{i}") * F.col(f"_s{j}"))).alias(f"_d{i}_{j}") for i in at for j in at if i <= j]
    norms = [F.sqrt(F.sum(F.col(f"_s{i}") * F.col(f"_s{i}"))).alias(f"_n{i}") for i in at]
    pairs = F.array(*[
        F.struct(
            F.lit(services[i]).alias("service_a"), F.lit(services[j]).alias("service_b"),
            F.col(f"_d{min(i, j)}_{max(i, j)}").alias("dot"), F.col(f"_n{i}").alias("norm_a"), F.col(f"_n{j}").alias("norm_b"),
        )
        for i in at for j in at
    ])
    length = F.col("norm_a") * F.col("norm_b")
    return wide.agg(*sums, *norms).select(F.inline(pairs)).where(length.isNotNull()).select(
        "service_a", "service_b", F.coalesce(F.col("dot") / F.nullif(length, F.lit(0.0)), F.lit(0.0)).alias("cosine")
    )


def od_row_share(od: DataFrame, origin: str, destination: str, by: list[str]) -> DataFrame:
    """Destination split of every origin on the square of all places seen in the group.

    The squared grid is the result itself: places are dimension values such as boroughs, and
    the sets are built from the counted matrix, not from trips.
    """
    places = od.groupBy(*by).agg(
        F.array_union(F.collect_set(origin), F.collect_set(destination)).alias("_places")
    )
    grid = places.select(*by, F.explode("_places").alias(origin), "_places").select(
        *by, origin, F.explode("_places").alias(destination)
    )
    filled = grid.join(od, [*by, origin, destination], "left").fillna(0, subset=["num_trips"])
    shared = share_of_total(filled, "num_trips", [*by, origin], "share")
    return shared.withColumn("share", F.coalesce("share", F.lit(0.0)))


def hourly_share(df: DataFrame, pickup: str, by: list[str]) -> DataFrame:
    """Percent of a service's pickups per hour of day."""
    counted = _count(df, [*by, F.hour(pickup).alias("hour_of_day")]).where(F.col("hour_of_day").between(0, 23))
    return share_of_total(counted, "num_trips", by, "share_pct", 100.0).select(*by, "hour_of_day", "share_pct")


def service_summary(
    df: DataFrame,
    *,
    service: str = "service",
    tip: str = "tip_amount",
    fare: str = "fare_amount",
    pickup: str = "pickup_datetime",
    dropoff: str = "dropoff_datetime",
    approximate: bool = False,
) -> DataFrame:
    """Per service: percent tipped, median tip, median fare, median minutes; null where unknown.

    For exact medians, what is measured is saved once; all passes read that.
    """
    by = [service]
    seconds = F.timestamp_diff("MICROSECOND", F.col(pickup), F.col(dropoff)) / F.lit(1e6)
    measures = {
        "median_tip": F.when(_known(tip) > 0, F.col(tip)),
        "median_fare": F.when(_known(fare) > 0, F.col(fare)),
        "_seconds": F.when(F.col(dropoff) > F.col(pickup), seconds),
    }
    if approximate:
        tipped = _tipped(tip).alias("tipped_pct")
        middle = [F.percentile_approx(c.cast("double"), 0.5, 10000).alias(name) for name, c in measures.items()]
        joined = df.groupBy(*by).agg(tipped, *middle)
    else:
        measured = df.select(*by, _has_tip(tip).alias("_tipped"), *[c.cast("double").alias(name) for name, c in measures.items()])
        measured = saved(df.sparkSession, measured, "measures")
        tipped = (F.avg(F.col("_tipped").cast("double")) * 100.0).alias("tipped_pct")
        medians = exact_medians(measured, {name: F.col(name) for name in measures}, by, stored=True)
        joined = measured.groupBy(*by).agg(tipped).join(medians, by, "left")
    return joined.withColumn("median_duration_min", F.col("_seconds") / 60.0).drop("_seconds")


def monthly_rides(df: DataFrame, pickup: str = "pickup_datetime", by: list[str] | None = None) -> DataFrame:
    parsed = df.withColumn("_at", F.col(pickup).try_cast("timestamp_ntz")).where(F.col("_at").isNotNull())
    keys = [F.year("_at").alias("year"), *(by or []), F.month("_at").alias("month")]
    return _count(parsed, keys, "trips")


def operator_series(services: dict[str, DataFrame], licensed: DataFrame | None, license_column: str) -> DataFrame:
    """Monthly counts of whole services and of licensed operators as one long series."""
    frames = [
        counts.select("year", "month", F.lit(name).alias("operator"), "trips") for name, counts in services.items()
    ]
    if licensed is not None:
        frames.append(
            licensed.select("year", "month", operator_name(F.col(license_column)).alias("operator"), "trips")
        )
    series = reduce(lambda a, b: a.unionByName(b), frames)
    return series.withColumn("date", month_start(F.col("year"), F.col("month")))


def monthly_share(series: DataFrame) -> DataFrame:
    """Each row's share in the trips of its month."""
    total = F.sum("trips").over(Window.partitionBy("date"))
    return series.withColumn("total_trips", total).withColumn("share", F.col("trips") / F.col("total_trips"))


def pivot_operator_share(shares: DataFrame, operators: list[str] | None = None) -> DataFrame:
    """Date by operator, mean share, 0 where an operator has no trips; columns sorted. All operators unless listed."""
    names = occurring(shares, "operator") if operators is None else sorted(operators)
    return shares.groupBy("date").pivot("operator", names).agg(F.avg("share")).fillna(0.0, subset=names).orderBy("date")

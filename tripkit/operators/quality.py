"""Data-quality rules, per-year statistics, reports and the clean filter.

A rule is a boolean column that is true for a good row and never null: a comparison
with a missing or NaN value counts as failed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.functions.codes import issue_label
from tripkit.functions.temporal import seconds_between
from tripkit.schemas import (
    CITY_BOX,
    MAX_COMPONENT_SUM,
    MAX_SPEED_MPH,
    MAX_TOTAL,
    MAX_TRIP_SECONDS,
    MIN_FARE,
    MIN_TRIP_SECONDS,
    Box,
    FareRule,
    ServiceProfile,
)

ISSUE_ORDER = [
    "bad_timestamps", "bad_distance", "bad_coordinates", "bad_prices", "bad_fares", "bad_request_time",
]


def _known(name: str) -> Column:
    """The column with NaN turned into null (for float columns)."""
    return F.nanvl(F.col(name), F.lit(None).cast("double"))


def _certain(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def valid_timestamps(pickup: str, dropoff: str, years: tuple[int, int]) -> Column:
    """Pickup before dropoff, both in one year or across New Year's night, year in range."""
    p, d = F.col(pickup), F.col(dropoff)
    new_year = (
        (F.year(d) == F.year(p) + 1)
        & (F.month(p) == 12) & (F.dayofmonth(p) == 31)
        & (F.month(d) == 1) & (F.dayofmonth(d) == 1)
    )
    return _certain((p < d) & ((F.year(p) == F.year(d)) | new_year) & F.year(p).between(*years))


def valid_distance(
    distance: str,
    pickup: str | None = None,
    dropoff: str | None = None,
    *,
    seconds: str | None = None,
    limits: tuple[float, float] = (MIN_TRIP_SECONDS, MAX_TRIP_SECONDS),
    max_speed: float = MAX_SPEED_MPH,
) -> Column:
    """Duration inside ``limits`` seconds, distance positive and below duration times speed.

    The duration is the ``seconds`` column if given, else dropoff minus pickup.
    """
    duration = _known(seconds) if seconds else seconds_between(F.col(pickup), F.col(dropoff))
    duration = duration.cast("double")
    length = _known(distance).cast("double")
    reachable = duration / F.lit(3600.0) * F.lit(float(max_speed))
    return _certain(duration.between(float(limits[0]), float(limits[1])) & (length > 0) & (length < reachable))


def valid_coordinates(lon_lat_pairs: list[tuple[str, str]], box: Box = CITY_BOX) -> Column:
    """Every point present and inside the box, edges included."""

    def inside(name, low, high):
        value = F.col(name)
        kind = "float"  # bounds are compared at the precision the coordinates are stored in
        return F.nanvl(value, F.lit(None).cast("double")).cast(kind).between(
            F.lit(low).cast(kind), F.lit(high).cast(kind)
        )

    checks = []
    for lon, lat in lon_lat_pairs:
        checks += [inside(lon, box.west, box.east), inside(lat, box.south, box.north)]
    return _certain(_all(checks))


def valid_fares(
    rule: FareRule, min_fare: float = MIN_FARE, max_total: float = MAX_TOTAL, max_sum: float = MAX_COMPONENT_SUM
) -> Column:
    """Money rule of one service.

    All listed parts must be non-negative. With a total column the parts must add up to
    something positive that does not exceed the total, the total must lie in
    [min_fare, max_total] and the fare above min_fare; without one the sum of the parts must
    lie in [0, max_sum].
    """
    checks = [_known(name) >= 0 for name in rule.non_negative]
    added = reduce(lambda a, b: a + b, [F.col(name) for name in rule.summed])
    added = F.nanvl(added, F.lit(None).cast("double"))
    if rule.total is None:
        checks.append(added.between(0.0, max_sum))
    else:
        total = _known(rule.total)
        checks += [
            _known(rule.fare) > min_fare,
            total > 0,
            total.between(min_fare, max_total),
            (added > 0) & (added <= total),
        ]
    return _certain(_all(checks))


def valid_request_time(request: str, pickup: str) -> Column:
    """Requested at or before pickup, at most one day ahead."""
    r, p = F.col(request), F.col(pickup)
    return _certain((r <= p) & (r >= F.timestamp_add("DAY", F.lit(-1), p)))


def profile_rules(profile: ServiceProfile) -> dict[str, Column]:
    """The rules of a service by the name of the flag a failed row gets."""
    rules = {"bad_timestamps": valid_timestamps("pickup_datetime", "dropoff_datetime", profile.years)}
    if profile.has_distance:
        rules["bad_distance"] = valid_distance(
            "trip_distance", "pickup_datetime", "dropoff_datetime", seconds=profile.duration_column
        )
    rules["bad_coordinates"] = valid_coordinates(
        [("pickup_longitude", "pickup_latitude"), ("dropoff_longitude", "dropoff_latitude")]
    )
    if profile.fare_rule:
        rules[profile.fare_rule.flag] = valid_fares(profile.fare_rule)
    if profile.has_request_time:
        rules["bad_request_time"] = valid_request_time("request_datetime", "pickup_datetime")
    return rules


def flag_issues(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One boolean column per rule (true = bad) and ``clean``."""
    return df.withColumns({**{flag: ~good for flag, good in rules.items()}, "clean": _all(list(rules.values()))})


def keep_clean(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.where(_all(list(rules.values())))


def stats_by_year(flagged: DataFrame, flags: list[str], year: str = "year") -> DataFrame:
    """Per year: all trips, trips per issue, clean trips. One partial aggregate per task."""
    return flagged.groupBy(year).agg(
        F.count(F.lit(1)).alias("total_trips"),
        *[F.count_if(F.col(flag)).alias(flag) for flag in flags],
        F.count_if(F.col("clean")).alias("clean_trips"),
    )


def merge_stats(*partials: DataFrame, year: str = "year") -> DataFrame:
    """Add up stored partial statistics that share their columns."""
    together = reduce(lambda a, b: a.unionByName(b), partials)
    counts = [name for name in together.columns if name != year]
    return together.groupBy(year).agg(*[F.sum(name).cast("bigint").alias(name) for name in counts])


def _issues_in(stats: DataFrame) -> list[str]:
    return [flag for flag in ISSUE_ORDER if flag in stats.columns]


def _with_clean(stats: DataFrame) -> DataFrame:
    if "clean_trips" in stats.columns:
        return stats
    bad = reduce(lambda a, b: a + b, [F.col(flag) for flag in _issues_in(stats)])
    return stats.withColumn("clean_trips", F.col("total_trips") - bad)


def dq_report(stats: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows per issue, then invalid and clean trips: count and percent of all trips."""
    by = by or []
    issues = _issues_in(stats)
    names = ["total_trips", "clean_trips", *issues]
    totals = _with_clean(stats).groupBy(*by).agg(*[F.sum(name).cast("bigint").alias(name) for name in names])
    invalid = F.col("total_trips") - F.col("clean_trips")
    entries = [(issue_label(F.lit(flag)), F.col(flag)) for flag in issues]
    entries += [(F.lit("Invalid trips"), invalid), (F.lit("Clean trips"), F.col("clean_trips"))]
    base = F.when(F.col("total_trips") == 0, F.lit(1)).otherwise(F.col("total_trips"))
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                label.alias("error_type"),
                number.alias("trips"),
                (number * F.lit(100.0) / base).alias("pct_of_all"),
            )
            for i, (label, number) in enumerate(entries, start=1)
        ]
    )
    return totals.select(*by, F.inline(rows))


def dq_yearly_pct(stats: DataFrame, years: tuple[int, int], by: list[str] | None = None) -> DataFrame:
    """Percent of trips per year and issue, in long form."""
    keys = [*(by or []), "year"]
    issues = _issues_in(stats)
    summed = stats.groupBy(*keys).agg(
        *[F.sum(name).cast("bigint").alias(name) for name in ["total_trips", *issues]]
    )
    base = F.greatest(F.col("total_trips"), F.lit(1))
    rows = F.array(
        *[
            F.struct(issue_label(F.lit(flag)).alias("issue_type"), (F.col(flag) * F.lit(100.0) / base).alias("pct_of_trips"))
            for flag in issues
        ]
    )
    return summed.where(F.col("year").between(*years)).select(*keys, F.inline(rows))

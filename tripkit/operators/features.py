"""Feature columns and scaling for the service classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.functions.temporal import minutes_between, weekday_monday_zero

# Feature names, clip limits and classes of the classifier.
NUMERIC = ["trip_distance", "duration_min", "speed_mph", "hour", "dow"]
CATEGORICAL = ["pickup_borough", "dropoff_borough"]
CLASSES = ["Yellow", "Green", "FHVHV"]
DURATION_LIMITS = (0.1, 360.0)
SPEED_LIMITS = (0.0, 120.0)
HASH_SLOTS = 2**15


def clip(value: Column, low: float, high: float) -> Column:
    """Clip to [low, high]; null stays null and NaN becomes null."""
    known = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    return F.when(known.isNotNull(), F.least(F.greatest(known, F.lit(low)), F.lit(high)))


def engineer_features(
    df: DataFrame,
    *,
    service: str = "service",
    pickup: str = "pickup_datetime",
    dropoff: str = "dropoff_datetime",
    distance: str = "trip_distance",
    origin: str = "pickup_borough",
    destination: str = "dropoff_borough",
    keep: list[str] | None = None,
) -> DataFrame:
    """Distance, clipped minutes, clipped speed, hour, weekday (Monday 0) and boroughs."""
    minutes = clip(minutes_between(F.col(pickup), F.col(dropoff)), *DURATION_LIMITS)
    speed = F.col(distance).cast("double") / (minutes / 60.0)
    finite = F.when(F.abs(speed) < F.lit(float("inf")), speed)
    return df.select(
        *(keep or []),
        F.col(service).alias("service"),
        F.col(distance).cast("double").alias("trip_distance"),
        minutes.alias("duration_min"),
        clip(finite, *SPEED_LIMITS).alias("speed_mph"),
        F.hour(pickup).cast("smallint").alias("hour"),
        weekday_monday_zero(F.col(pickup)).cast("smallint").alias("dow"),
        F.coalesce(F.col(origin), F.lit("NA")).alias("pickup_borough"),
        F.coalesce(F.col(destination), F.lit("NA")).alias("dropoff_borough"),
    )


def finite_or_zero(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(F.abs(F.nanvl(value, F.lit(float("inf")))) < F.lit(float("inf")), value).otherwise(F.lit(0.0))


def scaler_params(df: DataFrame, columns: list[str] = NUMERIC) -> DataFrame:
    """Mean and population standard deviation per column, as one row per feature."""
    stats = df.agg(
        *[F.avg(finite_or_zero(c)).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(finite_or_zero(c)).alias(f"{c}_std") for c in columns],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"{c}_mean").alias("mean"), F.col(f"{c}_std").alias("std"))
            for c in columns
        ]
    )
    return stats.select(F.inline(rows))


def collected(params: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and deviation by feature as plain numbers: one small row per feature."""
    return {row["feature"]: (row["mean"], row["std"]) for row in params.collect()}


def scale_features(df: DataFrame, params: dict[str, tuple[float, float]], columns: list[str] = NUMERIC) -> DataFrame:
    """(value - mean) / std per column; a constant column is only centred."""
    return df.withColumns({c: (finite_or_zero(c) - params[c][0]) / (params[c][1] or 1.0) for c in columns})

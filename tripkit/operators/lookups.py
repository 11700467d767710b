"""Equi-joins with dimensions: zones, ZIP codes, weather hours, precincts.

No side is hinted: Spark broadcasts a dimension when its size is below the session's
threshold (by file statistics, or measured at run time) and otherwise shuffles both sides,
splitting hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.functions.codes import first_token_int
from tripkit.functions.temporal import round_to_hour, utc_to_local


def zone_lookup(
    trips: DataFrame,
    zones: DataFrame,
    columns: dict[str, str],
    *,
    zone_key: str = "LocationID",
    pickup: str = "PULocationID",
    dropoff: str = "DOLocationID",
) -> DataFrame:
    """Attach zone attributes for pickup and dropoff; trips with unknown zones are kept.

    ``columns`` maps a zone column to the suffix of the new columns, e.g.
    ``{"Borough": "borough"}`` gives ``pickup_borough`` and ``dropoff_borough``. A side whose
    key column is absent from the trips is skipped.
    """
    out = trips
    for side, key in (("pickup", pickup), ("dropoff", dropoff)):
        if key not in trips.columns:
            continue
        renamed = zones.select(
            F.col(zone_key).alias(f"_{side}_key"),
            *[F.col(source).alias(f"{side}_{suffix}") for source, suffix in columns.items()],
        )
        out = out.join(renamed, F.col(key) == F.col(f"_{side}_key"), "left").drop(f"_{side}_key")
    return out


def zone_centroids(lookup: DataFrame, centroids: DataFrame, key: str = "LocationID") -> DataFrame:
    """Zones that have both a lookup row and a centroid."""
    return lookup.join(centroids, key, "inner")


def one_row_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The row with the smallest ``order`` for each key."""
    others = [name for name in df.columns if name != key]
    first = F.min_by(F.struct(*others), order).alias("_row")
    return df.groupBy(key).agg(first).select(key, "_row.*").select(*df.columns)


def fill_coordinates(
    places: DataFrame,
    zips: DataFrame,
    *,
    zip_key: str,
    lon: str,
    lat: str,
    zips_key: str,
    zips_lon: str,
    zips_lat: str,
    dedupe: bool = False,
) -> DataFrame:
    """Fill missing coordinates from the ZIP table; places still without any are dropped.

    A ZIP listed twice doubles its places, as in any left join; ``dedupe`` keeps one row
    per ZIP instead (the one with the smallest latitude, then longitude).
    """
    side = zips.select(
        F.col(zips_key).alias("_zip"), F.col(zips_lon).alias("_zlon"), F.col(zips_lat).alias("_zlat")
    )
    if dedupe:
        side = one_row_per_key(side, "_zip", F.struct("_zlat", "_zlon"))

    def known(name):
        return F.nanvl(F.col(name), F.lit(None).cast("double"))

    joined = places.join(side, F.col(zip_key) == F.col("_zip"), "left")
    filled = joined.withColumns(
        {lon: F.coalesce(known(lon), F.col("_zlon")), lat: F.coalesce(known(lat), F.col("_zlat"))}
    )
    return filled.drop("_zip", "_zlon", "_zlat").dropna(subset=[lon, lat])


def local_weather(weather: DataFrame, time: str = "time", *, dedupe: bool = False) -> DataFrame:
    """Hourly weather moved from UTC to city time.

    In autumn two UTC hours share one local hour; ``dedupe`` keeps the earlier of them.
    """
    local = weather.withColumns({"_utc": F.col(time), time: utc_to_local(F.col(time))})
    if dedupe:
        local = one_row_per_key(local, time, F.col("_utc"))
    return local.drop("_utc")


def weather_join(trips: DataFrame, weather: DataFrame, *, trip_time: str, weather_time: str = "time") -> DataFrame:
    """Left join on the trip time rounded to the hour. ``weather`` is in local time."""
    side = weather.withColumnRenamed(weather_time, "_weather_hour")
    rounded = trips.withColumn("_trip_hour", round_to_hour(F.col(trip_time)))
    return rounded.join(side, F.col("_trip_hour") == F.col("_weather_hour"), "left").drop(
        "_trip_hour", "_weather_hour"
    )


def place_events(
    events: DataFrame,
    places: DataFrame,
    *,
    event_place: str,
    place_key: str,
    columns: list[str],
    drop_unmatched: bool = False,
) -> DataFrame:
    """Give each event the position of its place.

    The event's place is text that may list several numbers; the first one counts.
    """
    side = places.select(F.col(place_key).cast("bigint").alias("_place"), *columns)
    keyed = events.withColumn("_event_place", first_token_int(F.col(event_place)))
    how = "inner" if drop_unmatched else "left"
    return keyed.join(side, F.col("_event_place") == F.col("_place"), how).drop("_event_place", "_place")


def first_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """First non-null value of every column per key, in the given order."""
    others = [name for name in df.columns if name not in keys]
    return df.groupBy(*keys).agg(
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in others]
    )

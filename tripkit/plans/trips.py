"""Whole-dataset jobs for one trip service: ingest, clean, explore, enrich, combine, count, classify."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.functions import codes
from tripkit.functions.geo import mercator_x, mercator_y
from tripkit.functions.temporal import in_nanosecond_range, parse_datetime
from tripkit.operators import analytics
from tripkit.operators.features import CLASSES, collected, engineer_features, scale_features, scaler_params
from tripkit.operators.lookups import fill_coordinates, local_weather, place_events, weather_join, zone_lookup
from tripkit.operators.metrics import evaluate, majority_baseline
from tripkit.operators.models import feature_importance, fit, linear_model, score, tree_model
from tripkit.operators.proximity import TimeWindow, nearest_place, spacetime_join
from tripkit.operators.quality import flag_issues, keep_clean, profile_rules, stats_by_year
from tripkit.operators.schema import add_missing, conform, fill_defaults, select_present, union_aligned
from tripkit.operators.selection import balanced_sample, sample_per_group, seeded_order, top_k
from tripkit.schemas import ServiceProfile
from tripkit.session import shared_dir
from tripkit.sources.readers import read_drifted
from tripkit.sources.writers import append_record, write_by_year, write_parquet, write_small_csv

_CODE_COLUMNS = {
    "vendor_id": codes.vendor_code,
    "rate_code_id": codes.rate_code,
    "store_and_fwd_flag": codes.store_and_forward_code,
    "payment_type": codes.payment_code,
    "trip_type": codes.trip_type_code,
}
_FLAG_COLUMNS = [
    "access_a_ride_flag", "shared_request_flag", "shared_match_flag", "wav_request_flag", "wav_match_flag",
]
_ID_COLUMNS = ["hvfhs_license_num", "dispatching_base_num", "originating_base_num"]


def normalise(raw: DataFrame, zones: DataFrame, profile: ServiceProfile) -> DataFrame:
    """Raw trips, already renamed, to the target schema of the service."""
    df = raw
    for name, code in _CODE_COLUMNS.items():
        if name in profile.columns and name in df.columns:
            df = df.withColumn(name, code(F.col(name)))
    for name in _FLAG_COLUMNS:
        if name in profile.columns and name in df.columns:
            df = df.withColumn(name, codes.yes_no_code(F.col(name)))
    if profile.name == "FHVHV":
        df = df.withColumns({name: codes.clean_id(F.col(name)) for name in _ID_COLUMNS if name in df.columns})
    df = fill_defaults(add_missing(df, profile.defaults), profile.defaults)
    present = {c: F.col(c).cast("int") for c in ("PULocationID", "DOLocationID") if c in df.columns}
    df = df.withColumns(present) if present else df
    columns = {"centroid_lng": "longitude", "centroid_lat": "latitude", "Borough": "borough"}
    df = zone_lookup(df, zones, columns)
    times = [c for c, kind in profile.columns.items() if kind == "timestamp_ntz"]
    df = df.withColumns({c: parse_datetime(F.col(c)) for c in times})
    if profile.name == "FHV":
        df = df.where(in_nanosecond_range(F.col("pickup_datetime")) & in_nanosecond_range(F.col("dropoff_datetime")))
    return conform(df.withColumn("year", F.year("pickup_datetime")), profile.schema)


def raw_kinds(profile: ServiceProfile) -> dict[str, str]:
    """Types to give raw columns so that months with different types can be united.

    Codes come as text or number, so they are united as text; the rest as wide numbers.
    """
    kinds: dict[str, str] = {}
    for name, kind in profile.columns.items():
        if name in _CODE_COLUMNS or name in _FLAG_COLUMNS or kind == "string":
            kinds[name] = "string"
        elif kind == "timestamp_ntz":
            kinds[name] = kind
        elif name != "year":
            kinds[name] = "double"
    return kinds


def ingest(
    spark: SparkSession, paths: list[str], zones: DataFrame, profile: ServiceProfile, root: str
) -> None:
    """Raw monthly files of one service to one Parquet dataset by year, next to what other calls wrote.

    The set of file names is the load: the same call again replaces its own rows, whatever years they are of now. A file
    belongs to one set: a call with a file of another set is refused.
    """
    raw = read_drifted(spark, paths, raw_kinds(profile))
    names = sorted(p.rsplit("/", 1)[-1] for p in paths)
    load = hashlib.sha256("\n".join(names).encode()).hexdigest()[:16]
    write_by_year(normalise(raw, zones, profile), f"{root}/{profile.folder}", load=load, sources=names)


def clean(df: DataFrame, profile: ServiceProfile) -> tuple[DataFrame, DataFrame]:
    """Yearly issue statistics and the clean trips of one service.

    The year is derived from the pickup again, so it is right even in a copied partition.
    """
    dated = df.withColumn("year", F.year("pickup_datetime"))
    rules = profile_rules(profile)
    stats = stats_by_year(flag_issues(dated, rules), list(rules)).orderBy("year")
    return stats, conform(keep_clean(dated, rules), profile.schema)


def clean_to(df: DataFrame, profile: ServiceProfile, root: str, stats_root: str, load: str = "all") -> None:
    """Write statistics and clean trips; ``load`` names the part of the service that ``df`` holds."""
    stats, good = clean(df, profile)
    write_small_csv(stats, f"{stats_root}/{profile.folder}_quality_stats")
    write_by_year(good, f"{root}/{profile.folder}", load=load)


def explore(df: DataFrame, profile: ServiceProfile, approximate: bool = False) -> dict[str, DataFrame]:
    """The standard set of aggregates of one service, by name.

    All counts come from one table of base counts, written once to the shared folder; trips are
    scanned again only for medians and the share of tips.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"counts-{profile.folder}")
    write_parquet(analytics.base_counts(df), path)
    base = spark.read.parquet(path)
    boroughs, zones = ["pickup_borough", "dropoff_borough"], ["PULocationID", "DOLocationID"]
    od_boroughs, od_zones = analytics.recount(base, boroughs), analytics.recount(base, zones)
    most = F.col("num_trips").desc()
    results = {
        "trips_per_year": analytics.recount(base, ["year"]).orderBy("year"),
        "trips_per_PULocationID": analytics.recount(base, ["PULocationID"]).orderBy(most, "PULocationID"),
        "trips_per_hour": analytics.recount(base, ["hour_of_day"], keep_null=True).orderBy(most, "hour_of_day"),
        "median_duration": analytics.median_duration(df, approximate=approximate),
        "trips_per_borough": analytics.recount(base, ["pickup_borough"]).orderBy(most, "pickup_borough"),
        "od_matrix_borough": od_boroughs,
        "top10_od_boroughs": top_k(od_boroughs, 10, "num_trips", boroughs),
        "od_matrix_ids": od_zones,
        "top10_od_ids": top_k(od_zones, 10, "num_trips", zones),
    }
    if profile.tip:
        tipped, paid = analytics.positive(df, profile.tip), analytics.positive(df, profile.fare)
        results |= {
            "median_tip": analytics.median_of(tipped, profile.tip, name="median_tip", approximate=approximate),
            "median_fare": analytics.median_of(paid, profile.fare, name="median_fare_amount", approximate=approximate),
            "tip_percentage": analytics.tip_percentage(df, profile.tip),
        }
    if profile.name in ("Yellow", "Green"):
        results["median_fare_per_year"] = analytics.median_of(
            df, profile.fare, ["year"], name="median_fare", approximate=approximate
        )
    return results


def project(df: DataFrame, lon: str, lat: str, x: str, y: str) -> DataFrame:
    """Planar coordinates in metres next to longitude and latitude."""
    return df.withColumns({x: mercator_x(F.col(lon)), y: mercator_y(F.col(lat))})


def enrich(
    trips: DataFrame,
    weather: DataFrame,
    schools: DataFrame,
    businesses: DataFrame,
    zips: DataFrame,
    dedupe_weather: bool = False,
) -> DataFrame:
    """Weather at dropoff, nearest school and nearest business of the dropoff point."""
    coordinates = ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]
    df = trips.dropna(subset=coordinates)
    df = weather_join(df, local_weather(weather, dedupe=dedupe_weather), trip_time="dropoff_datetime")
    df = project(df, "dropoff_longitude", "dropoff_latitude", "_x", "_y")
    schools = project(schools, "longitude", "latitude", "_px", "_py")
    df = nearest_place(
        df, schools, point=("_x", "_y"), place=("_px", "_py"), place_id="Name",
        carry={"Name": "nearest_school_name"}, distance="dist_from_school",
    )
    filled = fill_coordinates(
        businesses, zips, zip_key="ZIP Code", lon="Longitude", lat="Latitude",
        zips_key="ZIP Code", zips_lon="lng", zips_lat="lat",
    )
    filled = project(filled, "Longitude", "Latitude", "_px", "_py")
    df = nearest_place(
        df, filled, point=("_x", "_y"), place=("_px", "_py"), place_id="Business Name",
        carry={"Business Name": "nearest_business_name"}, distance="dist_from_business",
    )
    return df.drop("_x", "_y")


def nearby_events(
    trips: DataFrame,
    events: DataFrame,
    precincts: DataFrame,
    *,
    trip_time: str = "dropoff_datetime",
    lon: str = "dropoff_longitude",
    lat: str = "dropoff_latitude",
    radius: float = 100.0,
    hours: float = 1.0,
    semantics: str = "left",
    drop_unplaced: bool = False,
) -> DataFrame:
    """Trips with the events near them in space and time, and ``time_diff`` in hours."""
    placed = place_events(
        events, precincts, event_place="Police Precinct", place_key="precinct", columns=["lng", "lat"],
        drop_unmatched=drop_unplaced,
    )
    placed = project(placed, "lng", "lat", "_ex", "_ey").drop("lng", "lat", "Police Precinct")
    df = project(trips, lon, lat, "_x", "_y")
    window = TimeWindow(trip_time, "Start Date/Time", hours * 3600.0)
    joined = spacetime_join(
        df, placed, radius, window, point=("_x", "_y"), place=("_ex", "_ey"), semantics=semantics
    )
    gap = F.timestamp_diff("MICROSECOND", F.col(trip_time), F.col("Start Date/Time")) / F.lit(3.6e9)
    return joined.withColumn("time_diff", F.abs(gap)).drop("_x", "_y", "_ex", "_ey")


def combine(yellow: DataFrame, fhvhv: DataFrame, as_string: bool = True) -> DataFrame:
    """Two services in one frame with the columns of both."""
    return union_aligned({"yellow": yellow, "fhvhv": fhvhv}, as_string=as_string)


def monthly_counts(services: dict[str, DataFrame], years: tuple[int, int] | None = None) -> dict[str, DataFrame]:
    """Rides per month of each service, of all years or those from ``years[0]`` to ``years[1]``; licensed services also
    per company."""
    out = {}
    for name, df in services.items():
        by = ["hvfhs_license_num"] if "hvfhs_license_num" in df.columns else None
        out[name] = analytics.monthly_rides(df.where(F.col("year").between(*years)) if years else df, by=by)
    return out


def classifier_frame(services: dict[str, DataFrame], year: int, cap: int | None = None, seed: int = 42) -> DataFrame:
    """Feature rows of one year with ``service``, ``month`` and a stable row order.

    ``cap`` keeps at most that many rows per service and month, drawn by a seeded hash.
    """
    wanted = ["pickup_datetime", "dropoff_datetime", "pickup_borough", "dropoff_borough", "trip_distance"]
    frames = []
    for name, df in services.items():
        part = select_present(df.where(F.col("year") == year), wanted)
        missing = {c: F.lit(None).cast("string" if "borough" in c else "double") for c in wanted[2:]}
        part = add_missing(part, missing).select(*wanted)
        part = part.withColumns({"month": F.month("pickup_datetime"), "service": F.lit(name)})
        frames.append(part.withColumn("trip_distance", F.col("trip_distance").cast("float")))
    rows = frames[0]
    for df in frames[1:]:
        rows = rows.unionByName(df)
    if cap:
        rows = sample_per_group(rows, ["service", "month"], cap, order=seeded_order(*wanted, seed=seed), tie=wanted)
    return engineer_features(rows, keep=["month"])


def classify(
    services: dict[str, DataFrame],
    *,
    train_year: int,
    valid_year: int,
    cap: int | None = 10_000,
    trees: bool = False,
    rounds: int = 50,
    slots: int | None = None,
    records: str | None = None,
    experiment: str = "experiment",
) -> dict[str, object]:
    """Train on balanced months of one year, score another year, compare with the majority class.

    ``cap`` only bounds the rows the model is fitted on: the majority class is counted over all training rows, and all
    rows of the validation year are scored. The scaler is fitted on the balanced rows. Tree models use fewer hash slots by default:
    every slot costs a histogram per tree node, and boroughs are few.
    """
    train = classifier_frame(services, train_year, cap)
    order = [c for c in train.columns if c not in ("month", "service")]
    balanced = balanced_sample(
        train, ["month"], "service", CLASSES, order=seeded_order(*order), tie=order
    )
    params = collected(scaler_params(balanced))
    valid = classifier_frame(services, valid_year)
    slots = slots or (2**8 if trees else 2**15)
    model = fit(scale_features(balanced, params), tree_model(rounds) if trees else linear_model(), slots)
    scored = score(model, scale_features(valid, params))
    results = {
        "model": model,
        "scored": scored,
        "metrics": evaluate(scored, CLASSES),
        "baseline": evaluate(majority_baseline(valid, classifier_frame(services, train_year), CLASSES), CLASSES),
        "importance": feature_importance(model),
        "train_rows": balanced.count(),
    }
    if records:
        spark = scored.sparkSession
        for name, frame in (("model", results["metrics"]), ("majority baseline", results["baseline"])):
            row = frame.first().asDict()  # one row of metrics
            append_record(
                spark,
                {"exp_name": experiment, "model": name, "cap": cap or 0, "train_rows": results["train_rows"], **row},
                records,
            )
    return results


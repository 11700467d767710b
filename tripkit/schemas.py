"""Target schemas, column renames and data-quality limits of the four services."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values: target columns and types per service ----------------------
# Types in Spark terms: codes that fit a byte are tinyint, unsigned bytes smallint,
# unsigned 16-bit values int, measures and money float, times timestamp_ntz.
_GEO = {
    "pickup_longitude": "float",
    "pickup_latitude": "float",
    "dropoff_longitude": "float",
    "dropoff_latitude": "float",
    "pickup_borough": "string",
    "dropoff_borough": "string",
    "year": "int",
}
_YELLOW = {
    "vendor_id": "tinyint",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "passenger_count": "smallint",
    "trip_distance": "float",
    "rate_code_id": "smallint",
    "store_and_fwd_flag": "tinyint",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "smallint",
    "fare_amount": "float",
    "extra": "float",
    "mta_tax": "float",
    "tip_amount": "float",
    "tolls_amount": "float",
    "improvement_surcharge": "float",
    "total_amount": "float",
    "cbd_congestion_fee": "float",
    "congestion_surcharge": "float",
    "airport_fee": "float",
    **_GEO,
}
_GREEN = {
    "vendor_id": "tinyint",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "passenger_count": "smallint",
    "trip_distance": "float",
    "trip_type": "smallint",
    "rate_code_id": "smallint",
    "store_and_fwd_flag": "tinyint",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "smallint",
    "fare_amount": "float",
    "extra": "float",
    "ehail_fee": "float",
    "mta_tax": "float",
    "tip_amount": "float",
    "tolls_amount": "float",
    "improvement_surcharge": "float",
    "total_amount": "float",
    "cbd_congestion_fee": "float",
    "congestion_surcharge": "float",
    **_GEO,
}
_FHV = {
    "dispatching_base_num": "string",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "PULocationID": "int",
    "DOLocationID": "int",
    "SR_flag": "tinyint",
    "affiliated_base_number": "string",
    **_GEO,
}
_FHVHV = {
    "DOLocationID": "int",
    "PULocationID": "int",
    "access_a_ride_flag": "tinyint",
    "shared_request_flag": "tinyint",
    "shared_match_flag": "tinyint",
    "wav_request_flag": "tinyint",
    "wav_match_flag": "tinyint",
    "airport_fee": "float",
    "base_passenger_fare": "float",
    "bcf": "float",
    "cbd_congestion_fee": "float",
    "congestion_surcharge": "float",
    "dispatching_base_num": "string",
    "driver_pay": "float",
    "hvfhs_license_num": "string",
    "on_scene_datetime": "timestamp_ntz",
    "originating_base_num": "string",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "request_datetime": "timestamp_ntz",
    "sales_tax": "float",
    "tips": "float",
    "tolls": "float",
    "trip_distance": "float",
    "trip_time": "float",
    **_GEO,
}

# --- fixed values: column names that changed over the years -------------------
# A value may itself be a key; chains are followed to their end.
RENAMES = {
    "End_Lat": "dropoff_latitude",
    "End_Lon": "dropoff_longitude",
    "Start_Lat": "pickup_latitude",
    "Start_Lon": "pickup_longitude",
    "Fare_Amt": "fare_amount",
    "Tip_Amt": "tip_amount",
    "Tolls_Amt": "tolls_amount",
    "Total_Amt": "total_amount",
    "Passenger_Count": "passenger_count",
    "Payment_Type": "payment_type",
    "Rate_Code": "rate_code_id",
    "rate_code": "rate_code_id",
    "RatecodeID": "rate_code_id",
    "Trip_Distance": "trip_distance",
    "Trip_Dropoff_DateTime": "tpep_dropoff_datetime",
    "Trip_Pickup_DateTime": "tpep_pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "tpep_pickup_datetime": "pickup_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
    "lpep_pickup_datetime": "pickup_datetime",
    "dropOff_datetime": "dropoff_datetime",
    "Airport_fee": "airport_fee",
    "VendorID": "vendor_id",
    "vendor_name": "vendor_id",
    "surcharge": "extra",
    "store_and_forward": "store_and_fwd_flag",
    "Affiliated_base_number": "affiliated_base_number",
    "SR_Flag": "SR_flag",
    "PUlocationID": "PULocationID",
    "DOlocationID": "DOLocationID",
    "trip_miles": "trip_distance",
}

# --- fixed values: limits of the data-quality rules ----------------------------
LAST_YEAR = 2025
MAX_SPEED_MPH = 80.0
MIN_TRIP_SECONDS = 60
MAX_TRIP_SECONDS = 6 * 60 * 60
MIN_FARE, MAX_TOTAL = 2.5, 500.0
MAX_COMPONENT_SUM = 1000.0


@dataclass(frozen=True)
class Box:
    """Longitude / latitude rectangle."""

    west: float
    south: float
    east: float
    north: float


# The outermost coordinates of the city.
CITY_BOX = Box(west=-74.248064, south=40.505232, east=-73.708116, north=40.908582)


@dataclass(frozen=True)
class FareRule:
    """Which money columns must be non-negative, which are summed, and the allowed sum."""

    flag: str
    non_negative: tuple[str, ...]
    summed: tuple[str, ...]
    fare: str | None = None
    total: str | None = None


@dataclass(frozen=True)
class ServiceProfile:
    name: str
    folder: str
    columns: dict[str, str]
    first_year: int
    chart_years: tuple[int, int]
    fare_rule: FareRule | None = None
    duration_column: str | None = None
    has_distance: bool = True
    has_request_time: bool = False
    tip: str | None = None
    fare: str | None = None
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in self.columns.items()))

    @property
    def years(self) -> tuple[int, int]:
        return self.first_year, LAST_YEAR

    @property
    def issue_flags(self) -> list[str]:
        flags = ["bad_timestamps"]
        if self.has_distance:
            flags.append("bad_distance")
        flags.append("bad_coordinates")
        if self.fare_rule:
            flags.append(self.fare_rule.flag)
        if self.has_request_time:
            flags.append("bad_request_time")
        return flags


YELLOW = ServiceProfile(
    name="Yellow",
    folder="yellow_tripdata",
    columns=_YELLOW,
    first_year=2011,
    chart_years=(2012, LAST_YEAR),
    tip="tip_amount",
    fare="fare_amount",
    fare_rule=FareRule(
        flag="bad_prices",
        fare="fare_amount",
        total="total_amount",
        non_negative=(
            "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
            "congestion_surcharge", "airport_fee",
        ),
        summed=(
            "fare_amount", "mta_tax", "improvement_surcharge", "tolls_amount",
            "congestion_surcharge", "airport_fee",
        ),
    ),
    defaults={
        "mta_tax": 0.0, "airport_fee": 0.0, "congestion_surcharge": 0.0, "improvement_surcharge": 0.0,
        "extra": 0.0, "cbd_congestion_fee": 0.0, "passenger_count": 0,
    },
)
GREEN = ServiceProfile(
    name="Green",
    folder="green_tripdata",
    columns=_GREEN,
    first_year=2013,
    chart_years=(2014, LAST_YEAR),
    tip="tip_amount",
    fare="fare_amount",
    fare_rule=FareRule(
        flag="bad_prices",
        fare="fare_amount",
        total="total_amount",
        non_negative=(
            "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
            "congestion_surcharge", "cbd_congestion_fee", "ehail_fee",
        ),
        summed=(
            "fare_amount", "mta_tax", "improvement_surcharge", "tolls_amount",
            "congestion_surcharge", "cbd_congestion_fee", "ehail_fee",
        ),
    ),
    defaults={
        "mta_tax": 0.0, "ehail_fee": 0.0, "congestion_surcharge": 0.0, "improvement_surcharge": 0.0,
        "extra": 0.0, "cbd_congestion_fee": 0.0, "passenger_count": 0, "trip_distance": -1.0,
    },
)
FHV = ServiceProfile(
    name="FHV",
    folder="fhv_tripdata",
    columns=_FHV,
    first_year=2014,
    chart_years=(2015, LAST_YEAR),
    has_distance=False,
    defaults={"PULocationID": 0, "DOLocationID": 0, "SR_flag": 0},
)
_FHVHV_MONEY = (
    "base_passenger_fare", "bcf", "sales_tax", "tips", "tolls", "driver_pay",
    "airport_fee", "congestion_surcharge", "cbd_congestion_fee",
)
FHVHV = ServiceProfile(
    name="FHVHV",
    folder="fhvhv_tripdata",
    columns=_FHVHV,
    first_year=2019,
    chart_years=(2019, LAST_YEAR),
    duration_column="trip_time",
    has_request_time=True,
    tip="tips",
    fare="base_passenger_fare",
    fare_rule=FareRule(flag="bad_fares", non_negative=_FHVHV_MONEY, summed=_FHVHV_MONEY),
    defaults={
        "PULocationID": 0, "DOLocationID": 0, "trip_distance": 0.0, "trip_time": 0.0,
        **{column: 0.0 for column in _FHVHV_MONEY},
    },
)

PROFILES = {profile.name: profile for profile in (YELLOW, GREEN, FHV, FHVHV)}
SERVICES = list(PROFILES)

"""Normalisers for code columns whose spelling changed over the years.

Each takes a column of any type and returns a small integer that is never null.
Text and numbers are both accepted, because one column may be text in one month
and a number in the next.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: words and numbers accepted for each code -------------------
VENDOR_WORDS = {"CMT": 1, "DDS": 2, "VTS": 2}
VENDOR_IDS = (1, 2, 6, 7)
RATE_CODES = (1, 2, 3, 4, 5, 6, 99)
PAYMENT_WORDS = {
    "credit": 1, "crd": 1, "cre": 1,
    "cash": 2, "csh": 2, "cas": 2,
    "noc": 3, "no charge": 3, "no": 3,
    "dis": 4, "dispute": 4,
    "na": 5,
}
PAYMENT_IDS = (0, 1, 2, 3, 4, 5, 6)
TRIP_TYPES = (1, 2)
YES_NO = {"Y": 1, "N": 0}
OPERATORS = {"HV0002": "Juno", "HV0003": "Uber", "HV0004": "Via", "HV0005": "Lyft"}
OTHER_OPERATOR = "Other FHVHV"
ISSUE_LABELS = {
    "bad_timestamps": "Timestamp issues",
    "bad_distance": "Infeasible distances",
    "bad_coordinates": "Invalid coordinates",
    "bad_prices": "Pricing issues",
    "bad_fares": "Pricing issues",
    "bad_request_time": "Request time issues",
}


def lookup(key: Column, table: dict) -> Column:
    """Literal-map lookup; null when the key is absent."""
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def _number(value: Column) -> Column:
    return value.try_cast("double")


def _one_of(value: Column, allowed: tuple[int, ...]) -> Column:
    number = _number(value)
    return F.when(number.isin(*[float(item) for item in allowed]), number.cast("int"))


def vendor_code(value: Column) -> Column:
    return F.coalesce(lookup(value.cast("string"), VENDOR_WORDS), _one_of(value, VENDOR_IDS), F.lit(-1))


def rate_code(value: Column) -> Column:
    return F.coalesce(_one_of(value, RATE_CODES), F.lit(99))


def store_and_forward_code(value: Column) -> Column:
    """Y / N, or a number that truncates to 0 or 1; everything else is -1."""
    number = _number(value)
    return F.coalesce(
        lookup(F.trim(value.cast("string")), YES_NO),
        F.when((number > -1.0) & (number < 2.0), number.cast("int")),
        F.lit(-1),
    )


def payment_code(value: Column) -> Column:
    word = F.lower(F.trim(value.cast("string")))
    return F.coalesce(lookup(word, PAYMENT_WORDS), _one_of(value, PAYMENT_IDS), F.lit(5))


def trip_type_code(value: Column) -> Column:
    return F.coalesce(_one_of(value, TRIP_TYPES), F.lit(-1))


def yes_no_code(value: Column) -> Column:
    return F.coalesce(lookup(F.trim(value.cast("string")), YES_NO), F.lit(-1))


def operator_name(license_number: Column) -> Column:
    return F.coalesce(lookup(license_number, OPERATORS), F.lit(OTHER_OPERATOR))


def issue_label(flag: Column) -> Column:
    return lookup(flag, ISSUE_LABELS)


def clean_id(value: Column) -> Column:
    return F.trim(F.coalesce(value.cast("string"), F.lit("")))


def first_token_int(value: Column) -> Column:
    """Integer in front of the first comma; null when it is not a number."""
    return F.split_part(value, F.lit(","), F.lit(1)).try_cast("double").try_cast("bigint")


def whole_number(value: Column) -> Column:
    """Text to bigint; null for text that is not a number."""
    return value.try_cast("double").try_cast("bigint")


def thousands(value: Column) -> Column:
    return F.format_number(value.cast("bigint"), 0)


def percent_text(value: Column) -> Column:
    """Percent rounded half to even, with its sign."""
    return F.concat(F.bround(value, 0).cast("bigint").cast("string"), F.lit("%"))


def joined_name(*parts: Column, null_text: str | None = None) -> Column:
    """Parts separated by a blank; ``null_text`` stands for missing parts if given."""
    if null_text is not None:
        parts = tuple(F.coalesce(part, F.lit(null_text)) for part in parts)
    return F.concat_ws(" ", *parts)


def flow_label(origin: Column, destination: Column) -> Column:
    return F.concat(
        F.coalesce(origin, F.lit("Unknown")), F.lit(" → "), F.coalesce(destination, F.lit("Unknown"))
    )

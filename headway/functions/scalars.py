"""Column expressions on timetable and arrival fields. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv


def _part(text: Column, sep: str, index: int) -> Column:
    return F.get(F.split(text, sep), F.lit(index))


def gtfs_seconds(text: Column) -> Column:
    """`HH:MM:SS` to seconds; hours may exceed 24, malformed text gives NULL."""
    h, m, s = (_part(text, ":", i).try_cast("int") for i in range(3))
    return h * 3600 + m * 60 + s


def stop_number(stop_id: Column) -> Column:
    """Station number at the head of a platform id; NULL where it is not a number."""
    return _part(stop_id, ":", 0).try_cast("bigint")


def clean_status(status: Column) -> Column:
    return F.when(status == "", F.lit("PROGNOSE")).otherwise(status)


def mode_from_transport(transport: Column, product: Column) -> Column:
    code = F.upper(transport)
    return (
        F.when(code.isin(*fv.TRAIN_CODES), "Zug")
        .when(code.isin(*fv.BUS_CODES), "Bus")
        .when(code.isin(*fv.TRAM_CODES), "Tram")
        .when(code.isin(*fv.METRO_CODES), "Metro")
        .when(code.isin(*fv.BOAT_CODES), "Schiff")
        .when(code.isin(*fv.RACK_CODES), "Zahnradbahn")
        .when(code.isin(*fv.TAXI_CODES), "Taxi")
        .otherwise(F.initcap(F.lower(product)))
    )


def _cases(pairs: list[tuple[Column, str]], default: str | None = None) -> Column:
    chain = F
    for condition, value in pairs:
        chain = chain.when(condition, F.lit(value))
    return chain if default is None else chain.otherwise(F.lit(default))


def mode_from_route_type(route_type: Column) -> Column:
    return _cases([(route_type.between(lo, hi), mode) for mode, lo, hi in fv.MODE_RANGES])


def vehicle_type(route_type: Column) -> Column:
    return _cases([(route_type.isin(*codes), word) for word, codes in fv.VEHICLE_TYPES], "unknown")


def route_label(route_type: Column, line_text: Column) -> Column:
    return F.concat_ws(" ", vehicle_type(route_type), line_text)


def display_label(label: Column, line_text: Column, trip_id: Column) -> Column:
    """Label shown for a trip; an empty text counts as missing."""
    def present(c: Column) -> Column:
        return F.when(c != "", c)
    return F.coalesce(present(label), present(line_text), trip_id.cast("string"))


def operator_number(operator_id: Column) -> Column:
    return F.regexp_replace(operator_id, "^85:", "")


def dow_bucket(day_of_week: Column) -> Column:
    """Bucket of a day number with 1 = Sunday."""
    return F.when(day_of_week == 1, "sunday").when(day_of_week == 7, "saturday").otherwise(F.lit("weekday"))


def dow_bucket_monday0(weekday: Column) -> Column:
    """Bucket of a day number with 0 = Monday."""
    return F.when(weekday == 5, "saturday").when(weekday == 6, "sunday").otherwise(F.lit("weekday"))


def dow_bucket_of_name(day: Column) -> Column:
    name = F.lower(day)
    return F.when(name.isin("saturday", "sunday"), name).otherwise(F.lit("weekday"))


def delay_seconds(actual: Column, scheduled: Column) -> Column:
    return (F.unix_timestamp(actual) - F.unix_timestamp(scheduled)).cast("long")


def service_hour(seconds: Column) -> Column:
    return F.pmod(F.floor(seconds / 3600), F.lit(24)).cast("int")


def parse_hhmm(text: Column) -> Column:
    return _part(text, ":", 0).try_cast("int") * 3600 + _part(text, ":", 1).try_cast("int") * 60


def format_hhmm(seconds: Column) -> Column:
    """`HH:MM`, with hours above 23 kept."""
    hours = F.floor(seconds / 3600).cast("string")
    hours = F.when(F.length(hours) < 2, F.lpad(hours, 2, "0")).otherwise(hours)
    minutes = F.floor(F.pmod(seconds, F.lit(3600)) / 60).cast("string")
    return F.concat(hours, F.lit(":"), F.lpad(minutes, 2, "0"))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres between two points given in degrees."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half_lat, half_lon = F.sin((p2 - p1) / 2), F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = half_lat * half_lat + F.cos(p1) * F.cos(p2) * half_lon * half_lon
    return F.lit(2.0 * fv.EARTH_RADIUS_M) * F.asin(F.sqrt(chord))


def walk_seconds_stored(metres: Column, speed_m_per_min: float = 50.0) -> Column:
    """Whole seconds rounded up, as kept on walking edges."""
    return F.ceil(metres / F.lit(speed_m_per_min) * F.lit(60.0)).cast("long")


def walk_seconds_search(metres: Column) -> Column:
    """Whole seconds rounded down, as used by the itinerary search."""
    return F.floor(metres / F.lit(fv.WALK_M_PER_SEC)).cast("long")


def walk_metres_within(seconds: Column) -> Column:
    """No walk of so many seconds, as the itinerary search counts them, is longer."""
    return (seconds + 1) * F.lit(fv.WALK_M_PER_SEC)


def active_on(day: Column) -> Column:
    """The weekday flag of the row for the day named in another column."""
    chain = F.when(F.lit(False), F.lit(False))
    for name in fv.DAYS:
        chain = chain.when(F.lower(day) == name, F.col(name))
    return F.coalesce(chain, F.lit(False))


def fixed(value: Column, digits: int = 6) -> Column:
    """Double rounded for reports, without a negative zero."""
    return F.round(value.cast("double"), digits) + F.lit(0.0)

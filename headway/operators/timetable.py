"""From published timetable tables to the search network."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import scalars as sc

SEQUENCE_BLOCK = 256


def trips_touching_region(stop_times: DataFrame, region_stops: DataFrame) -> DataFrame:
    """Trips that call at a region stop; ``stop_times.stop_id`` is a platform id."""
    calls = stop_times.select("trip_id", sc.stop_number(F.col("stop_id")).alias("stop_id"))
    return calls.join(region_stops.select("stop_id"), "stop_id", "left_semi").select("trip_id").distinct()


def region_stop_times(stop_times: DataFrame, trips: DataFrame, calendar: DataFrame, routes: DataFrame,
                      region_stops: DataFrame) -> DataFrame:
    """All calls of the trips that touch the region, with service days and route texts."""
    route_type = F.col("route_type")
    route_texts = routes.select("route_id", F.col("route_short_name").alias("line_text"), "route_type").distinct()
    route_texts = route_texts.select(
        "route_id", "line_text", sc.route_label(route_type, F.col("line_text")).alias("route_label"))
    services = calendar.select("service_id", *fv.DAYS)
    # Trips are narrowed and described first, so that the large table of calls is joined once.
    described = (
        trips.select("trip_id", "route_id", "service_id")
        .join(trips_touching_region(stop_times, region_stops), "trip_id", "left_semi")
        .join(services, "service_id")
        .join(route_texts, "route_id", "left")
    )
    calls = stop_times.select(
        "trip_id", sc.stop_number(F.col("stop_id")).alias("stop_id"), F.col("stop_sequence").cast("int").alias("stop_sequence"),
        sc.gtfs_seconds(F.col("arrival_time")).alias("arrival_time_sec"),
        sc.gtfs_seconds(F.col("departure_time")).alias("departure_time_sec"),
    ).dropna(subset=["stop_id", "arrival_time_sec", "departure_time_sec"])
    return calls.join(described, "trip_id").select(
        "trip_id", "route_id", "line_text", "route_label", "service_id", "stop_id", "stop_sequence",
        "arrival_time_sec", "departure_time_sec", *fv.DAYS)


def connections(stop_times: DataFrame) -> DataFrame:
    """Rides between calls whose sequence numbers follow each other; a missing number yields none.

    One window instead of a self join. A trip is cut into blocks of sequence numbers, with each block's first call
    repeated at the end of the block before, so a trip of any length is spread over many tasks.
    """
    seq = F.col("stop_sequence")
    own = F.floor(seq / SEQUENCE_BLOCK)
    at = F.explode(F.when(seq % SEQUENCE_BLOCK == 0, F.array(own, own - 1)).otherwise(F.array(own)))
    calls = stop_times.select("*", own.alias("own_block"), at.alias("block"))
    following = Window.partitionBy("trip_id", "block").orderBy("stop_sequence")
    calls = calls.select(
        "*", F.lead("stop_sequence").over(following).alias("next_sequence"),
        F.lead("stop_id").over(following).alias("arr_stop_id"),
        F.lead("arrival_time_sec").over(following).alias("arr_time_sec"))
    return calls.where(
        (F.col("block") == F.col("own_block")) & (F.col("next_sequence") == seq + 1)
        & (F.col("arr_time_sec") >= F.col("departure_time_sec"))
    ).select("trip_id", "route_id", "line_text", "route_label", F.col("stop_id").alias("dep_stop_id"), "arr_stop_id",
             F.col("departure_time_sec").alias("dep_time_sec"), "arr_time_sec", *fv.DAYS)


def trip_attributes(rides: DataFrame) -> DataFrame:
    """Line text and route label per trip, from its first departure."""
    first = F.min_by(F.struct("line_text", "route_label"),
                     F.struct("dep_time_sec", "arr_time_sec", "dep_stop_id", "arr_stop_id"))
    return rides.groupBy("trip_id").agg(first.alias("t")).select("trip_id", "t.line_text", "t.route_label")


def active_on_day(rides: DataFrame, day: str) -> DataFrame:
    if day.lower() not in fv.DAYS:
        raise ValueError(f"day must be one of {fv.DAYS}")
    return rides.where(F.col(day.lower()))


def network_size(stops: DataFrame, rides: DataFrame, edges: DataFrame) -> DataFrame:
    return (
        stops.agg(F.count("*").alias("n")).select(F.lit("stops").alias("what"), "n")
        .unionAll(rides.agg(F.count("*").alias("n")).select(F.lit("connections"), "n"))
        .unionAll(edges.agg(F.count_distinct("a_stop_id").alias("n")).select(F.lit("stops_with_walks"), "n"))
    )


def landings_at_stops(rides: DataFrame, stop_ids: DataFrame, day: str, keep: int = 5) -> DataFrame:
    """Per watched stop: how many rides land there on a day, and the latest of them."""
    landing = active_on_day(rides, day).join(
        stop_ids.select(F.col("stop_id").alias("arr_stop_id")), "arr_stop_id", "left_semi"
    ).select("arr_stop_id", "dep_stop_id", "dep_time_sec", "arr_time_sec", "trip_id")
    totals = landing.groupBy("arr_stop_id").agg(F.count("*").alias("n_landings"))
    latest = Window.partitionBy("arr_stop_id").orderBy(
        F.desc("arr_time_sec"), F.desc("dep_time_sec"), "dep_stop_id", "trip_id")
    top = landing.withColumn("rank", F.row_number().over(latest)).where(F.col("rank") <= keep)
    return top.join(totals, "arr_stop_id")

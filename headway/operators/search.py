"""Itineraries for many origin-destination requests at once, as joins and aggregations per boarding.

A request is a row of ``requests(query_id, start_id, end_id, deadline_sec, day, q, max_routes, min_transfer_secs,
max_walk_m)``, with a ``date`` where services are known by date (calls then carry ``service_bits``). The search runs backwards from the destination: a label says "be at this stop by t to arrive in time".
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import cut_lineage
from ..functions import fixed_values as fv
from ..functions import probability as pr
from ..functions import scalars as sc
from . import distributions as ds
from . import service_days
from .skyline import undominated

CONF_DIGITS = 9
WALK_DIGITS = 3
LINE_JOINT = " > "

LEG = ("struct<kind:string,from_stop:bigint,to_stop:bigint,trip_id:string,label:string,line_text:string,dep_sec:bigint,"
       "arr_sec:bigint,walk_m:double>")


def validate_requests(requests: DataFrame, stops: DataFrame) -> DataFrame:
    """Every request with a ``status``: 'ok' or the first rule that it breaks."""
    known = stops.select("stop_id").distinct()
    rows = requests.join(known.select(F.col("stop_id").alias("start_id"), F.lit(True).alias("_start")), "start_id", "left")
    rows = rows.join(known.select(F.col("stop_id").alias("end_id"), F.lit(True).alias("_end")), "end_id", "left")
    status = (
        F.when(F.col("_start").isNull(), "unknown start").when(F.col("_end").isNull(), "unknown end")
        .when(~F.lower("day").isin(*fv.DAYS), "unknown day")
        .when(~F.col("max_walk_m").between(0, 500), "walk limit out of range").otherwise("ok")
    )
    return rows.withColumn("status", status).drop("_start", "_end").select(*requests.columns, "status")


def paired_requests(stops: DataFrame, buckets: int | None = None, seed: str = "od") -> DataFrame:
    """Reproducible random origin-destination pairs: every stop is once an origin.

    Stops are ordered by a digest inside digest buckets (about 1,000 stops each unless ``buckets`` is given) and each
    stop's destination is the next one; day and confidence come from other digits.
    """
    if buckets is None:
        buckets = max(4, -(-stops.count() // 1000))
    digest = F.md5(F.concat(F.lit(seed), F.col("stop_id").cast("string")))

    def digit(start: int) -> Column:
        return F.conv(F.substring("digest", start, 2), 16, 10).cast("int")

    rows = stops.select("stop_id", digest.alias("digest")).withColumn(
        "bucket", digit(1) % buckets if buckets <= 256 else F.conv(F.substring("digest", 7, 8), 16, 10).cast("long") % buckets)
    ordered = Window.partitionBy("bucket").orderBy("digest")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("end_id", F.coalesce(F.lead("stop_id").over(ordered), F.first("stop_id").over(whole)))
    return rows.where(F.col("end_id") != F.col("stop_id")).select(
        F.col("stop_id").alias("query_id"), F.col("stop_id").alias("start_id"), "end_id",
        F.element_at(F.array(F.lit("monday"), F.lit("tuesday"), F.lit("wednesday")), digit(3) % 3 + 1).alias("day"),
        F.element_at(F.array(F.lit(0.5), F.lit(0.7), F.lit(0.8), F.lit(0.9)), digit(5) % 4 + 1).alias("q"))


def as_requests(pairs: DataFrame, deadline: str = "09:00", max_routes: int = 3, min_transfer_secs: int = 120,
                max_walk_m: float = 500.0, date: Column | str | None = None) -> DataFrame:
    """``pairs`` with defaults for what they lack. A ``date`` (or a column of that name) sets the weekday too."""
    if date is not None:
        pairs = pairs.withColumn("date", (F.lit(date) if isinstance(date, str) else date).cast("date"))
    if "date" in pairs.columns:
        pairs = pairs.withColumn("day", F.element_at(F.array(*[F.lit(d) for d in fv.DAYS]), F.weekday("date") + 1))
    defaults = {"deadline_sec": sc.parse_hhmm(F.lit(deadline)).cast("long"), "max_routes": F.lit(max_routes),
                "min_transfer_secs": F.lit(min_transfer_secs), "max_walk_m": F.lit(float(max_walk_m))}
    return pairs.withColumns({c: v for c, v in defaults.items() if c not in pairs.columns})


def _day_mask() -> Column:
    return sum((F.when(F.col(d), 1 << i).otherwise(0) for i, d in enumerate(fv.DAYS)), F.lit(0))


def _day_bit(day: Column) -> Column:
    chain = F
    for i, d in enumerate(fv.DAYS):
        chain = chain.when(F.lower(day) == d, 1 << i)
    return chain.otherwise(0)


def _asked_day(requests: DataFrame) -> Column:
    """What is tested against a call's service days: the number of the date, or the weekday's bit."""
    if "date" in requests.columns:
        return service_days.day_number(F.col("date")).alias("day_bit")
    return _day_bit(F.col("day")).alias("day_bit")


def _runs(calls: DataFrame, day_bit: str = "day_bit") -> Column:
    """Whether a call's service runs on the asked day: one bit of its dates, or of its weekdays."""
    if isinstance(calls.schema["day_mask"].dataType, StructType):
        return service_days.runs_on("day_mask", F.col(day_bit))
    return F.col("day_mask").bitwiseAND(F.col(day_bit)) != 0


def calls_by_day(stop_times: DataFrame) -> DataFrame:
    """Calls with their service days (a weekday bit mask, or ``service_bits`` where there are some) and the label that travellers see."""
    days = F.col("service_bits") if "service_bits" in stop_times.columns else _day_mask()
    label = sc.display_label(F.col("route_label"), F.col("line_text"), F.col("trip_id"))
    return stop_times.select(
        F.col("trip_id").cast("string").alias("trip_id"), F.col("stop_sequence").alias("seq"), "stop_id",
        F.col("arrival_time_sec").cast("long").alias("arr"), F.col("departure_time_sec").cast("long").alias("dep"),
        label.alias("label"), "line_text", days.alias("day_mask"))


def _block(seconds: Column) -> Column:
    return F.floor(seconds / 3600).cast("int")


# ---- one and two vehicles, by schedule only ----------------------------------------------------------------------


def direct_itineraries(requests: DataFrame, stop_times: DataFrame) -> DataFrame:
    """All single-vehicle itineraries that arrive by the deadline."""
    calls = calls_by_day(stop_times)
    ask = requests.select("query_id", "start_id", "end_id", "deadline_sec", _asked_day(requests))
    alight = ask.join(calls, F.col("stop_id") == F.col("end_id")).where(_runs(calls) & (F.col("arr") <= F.col("deadline_sec")))
    alight = alight.select("query_id", "start_id", "trip_id", "label", F.col("seq").alias("alight_seq"), "arr")
    board = calls.select("trip_id", F.col("stop_id").alias("start_id"), F.col("seq").alias("board_seq"), "dep")
    return alight.join(board, ["trip_id", "start_id"]).where(F.col("board_seq") < F.col("alight_seq")).select(
        "query_id", "trip_id", "label", "board_seq", "alight_seq", "dep", "arr")


_FIRST_RIDE = ["trip_1", "label_1", "board_seq_1", "alight_seq_1", "dep_1", "arr_1"]
_SECOND_RIDE = ["trip_2", "label_2", "board_seq_2", "alight_seq_2", "dep_2", "arr_2"]


def _two_rides(requests: DataFrame, stop_times: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rides from the origin with the time from which one can leave their last stop, and rides to the destination with the
    time by which one has to leave a stop where the change begins (their own, or one within walking distance)."""
    calls = calls_by_day(stop_times)
    ask = requests.select("query_id", "start_id", "end_id", "deadline_sec", "min_transfer_secs", "max_walk_m",
                          _asked_day(requests))
    last = ask.join(calls, F.col("stop_id") == F.col("end_id")).where(_runs(calls) & (F.col("arr") <= F.col("deadline_sec")))
    last = last.select(*ask.columns, F.col("trip_id").alias("trip_2"), F.col("label").alias("label_2"),
                       F.col("seq").alias("alight_seq_2"), F.col("arr").alias("arr_2"))
    board_2 = calls.select(F.col("trip_id").alias("trip_2"), F.col("seq").alias("board_seq_2"),
                           F.col("stop_id").alias("board_stop_2"), F.col("dep").alias("dep_2"))
    last = last.join(board_2, "trip_2").where(
        (F.col("board_seq_2") < F.col("alight_seq_2")) & (F.col("board_stop_2") != F.col("end_id"))
        & (F.col("board_stop_2") != F.col("start_id")))
    last = cut_lineage(last)
    first = ask.select("query_id", "start_id", "day_bit", "end_id", "deadline_sec", "min_transfer_secs").join(
        calls, F.col("stop_id") == F.col("start_id")).where(_runs(calls) & (F.col("dep") <= F.col("deadline_sec"))).select(
        "query_id", "end_id", "start_id", "min_transfer_secs", F.col("trip_id").alias("trip_1"), F.col("label").alias("label_1"),
        F.col("seq").alias("board_seq_1"), F.col("dep").alias("dep_1"))
    alight_1 = calls.select(F.col("trip_id").alias("trip_1"), F.col("seq").alias("alight_seq_1"),
                            F.col("stop_id").alias("alight_stop_1"), F.col("arr").alias("arr_1"))
    first = first.join(alight_1, "trip_1").where(
        (F.col("board_seq_1") < F.col("alight_seq_1")) & (F.col("alight_stop_1") != F.col("start_id"))
        & (F.col("alight_stop_1") != F.col("end_id")))
    first = first.select("query_id", "alight_stop_1", *_FIRST_RIDE, (F.col("arr_1") + F.col("min_transfer_secs")).alias("ready"))
    first = cut_lineage(first)
    # The later vehicle is reached from its own stop or from a stop within walking distance.
    here = last.withColumns({"alight_stop_1": F.col("board_stop_2"), "walk_m": F.lit(0.0), "walk_sec": F.lit(0).cast("long")})
    walks = edges.select(F.col("b_stop_id").alias("board_stop_2"), F.col("a_stop_id").alias("alight_stop_1"),
                         F.col("distance_m").alias("walk_m"), sc.walk_seconds_search(F.col("distance_m")).alias("walk_sec"))
    # Only walks between two stops that rides of the same request call at, the first one early enough: a destination's rides
    # are not multiplied by everything around their stops.
    left = first.groupBy("query_id", "alight_stop_1").agg(F.min("ready").alias("soonest"))
    asked = last.groupBy("query_id", "board_stop_2").agg(F.max("dep_2").alias("latest"))
    between = left.join(asked, "query_id").where(F.col("soonest") <= F.col("latest")).select("query_id", "alight_stop_1", "board_stop_2")
    between = between.join(walks, ["alight_stop_1", "board_stop_2"])
    near = last.join(between, ["query_id", "board_stop_2"]).where(F.col("walk_m") <= F.col("max_walk_m"))
    near = near.select(*here.columns)
    reach = here.unionByName(near)
    return first, reach.select("query_id", "alight_stop_1", "board_stop_2", "walk_m", "walk_sec", *_SECOND_RIDE,
                               (F.col("dep_2") - F.col("walk_sec")).alias("leave"))


def one_transfer_itineraries(requests: DataFrame, stop_times: DataFrame, edges: DataFrame, max_wait_secs: int | None = None) -> DataFrame:
    """All itineraries of two vehicles with a change at one stop or over one walk.

    ``max_wait_secs`` bounds the wait beyond walk and minimum change time. Rides then meet within time blocks of that length
    only, so work and output grow with the departures of a wait and not with those of the day; a busy stop is split by block.
    """
    first, reach = _two_rides(requests, stop_times, edges)
    keys = ["query_id", "alight_stop_1"]
    if max_wait_secs is not None:
        if max_wait_secs < 0:
            raise ValueError("max_wait_secs must not be negative")
        block = lambda c: F.floor(F.col(c) / (max_wait_secs + 1)).cast("long")
        first = first.withColumn("block", F.explode(F.array(block("ready"), block("ready") + 1)))
        reach, keys = reach.withColumn("block", block("leave")), [*keys, "block"]
    met = first.join(reach, keys).where((F.col("trip_1") != F.col("trip_2")) & (F.col("ready") <= F.col("leave")))
    if max_wait_secs is not None:
        met = met.where(F.col("leave") - F.col("ready") <= max_wait_secs)
    return met.select("query_id", *_FIRST_RIDE, "alight_stop_1", "board_stop_2", "walk_m", *_SECOND_RIDE)


def latest_transfers(requests: DataFrame, stop_times: DataFrame, edges: DataFrame) -> DataFrame:
    """For each ride to the destination the best ride from the origin that meets it: the one that departs last.

    Ties go to the shorter walk, then the earlier arrival, then the greater trip id, boarding and alighting, then the
    smaller stop of the change. No ride meets another: both are put in order of time per request and stop, and a running maximum
    gives what is ready by then. Only where that is the later vehicle itself do the other rides of the stop have to be
    looked at one by one. The result has at most one row per ride to the destination.
    """
    first, reach = _two_rides(requests, stop_times, edges)
    keys = ["query_id", "alight_stop_1"]
    # Greater is better.
    worth = F.struct("dep_1", (-F.col("arr_1")).alias("early"), "trip_1", "board_seq_1", "alight_seq_1", "label_1", "arr_1")
    ride = F.struct("board_stop_2", "walk_m", "walk_sec", *_SECOND_RIDE, "leave")
    ready = first.select(*keys, F.col("ready").alias("at"), worth.alias("one"), F.lit(None).alias("two"))
    asked = reach.select(*keys, F.col("leave").alias("at"), F.lit(None).alias("one"), ride.alias("two"))
    # With the frame by range, rides that are ready at the very second of leaving count.
    so_far = Window.partitionBy(*keys).orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    found = ready.unionByName(asked).withColumn("one", F.max("one").over(so_far)).where("two is not null and one is not null")
    found = found.select(*keys, "one", "two.*")
    own = found.where(F.col("one.trip_1") == F.col("trip_2")).drop("one")
    others = own.join(first.withColumn("one", worth), keys).where((F.col("trip_1") != F.col("trip_2")) & (F.col("ready") <= F.col("leave")))
    others = others.groupBy(*keys, "board_stop_2", "walk_m", "walk_sec", *_SECOND_RIDE).agg(F.max("one").alias("one"))
    every = found.where(F.col("one.trip_1") != F.col("trip_2")).drop("leave").unionByName(others)
    rank = F.struct(F.col("one.dep_1"), (-F.col("walk_sec")).alias("walk"), F.col("one.early"), F.col("one.trip_1"), F.col("one.board_seq_1"),
                    F.col("one.alight_seq_1"), (-F.col("alight_stop_1")).alias("stop"))
    best = every.groupBy("query_id", *_SECOND_RIDE, "board_stop_2").agg(
        F.max_by(F.struct("one", "alight_stop_1", "walk_m"), rank).alias("best"))
    return best.select("query_id", *(F.col(f"best.one.{c}").alias(c) for c in _FIRST_RIDE), "best.alight_stop_1", "board_stop_2", "best.walk_m",
                       *_SECOND_RIDE)


# ---- latest departures, by schedule only -------------------------------------------------------------------------


def ride_profile(calls: DataFrame, horizon: Column) -> DataFrame:
    """For any time at a stop the latest departure at every stop from which one ride arrives there by then.

    Per pair of stops and set of service days, only rides that no later departure with an earlier or equal arrival beats
    are kept. In order of arrival each of them is then the best from its own arrival (``arr``) until the next one's
    (``until``, null for the last), and stands once in every hour ``block`` of that time up to ``horizon`` (seconds). A time at a
    stop so meets one block and, of each pair, one ride, however many run in a day. Rides that arrive after ``horizon``
    or before they depart are left out.

    The table grows with the pairs of calls of a trip. Rides with equal arrival are combined before the shuffle.
    """
    alight = calls.where(F.col("arr") <= horizon).select("trip_id", "seq", "stop_id", "arr", "day_mask")
    rides = alight.join(_boardings(calls), "trip_id").where((F.col("b_seq") < F.col("seq")) & (F.col("b_dep") <= F.col("arr")))
    pair = ["stop_id", "b_stop", "day_mask"]
    rides = rides.groupBy(*pair, "arr").agg(F.max("b_dep").alias("b_dep"))
    in_order = Window.partitionBy(*pair).orderBy("arr")
    beaten_by = F.max("b_dep").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    rides = rides.withColumn("_before", beaten_by).where(F.col("_before").isNull() | (F.col("b_dep") > F.col("_before")))
    rides = rides.drop("_before").withColumn("until", F.lead("arr").over(in_order))
    last = F.least(F.coalesce(F.col("until") - 1, horizon), horizon)
    return rides.withColumn("block", F.explode(F.sequence(_block(F.col("arr")), _block(last))))

def latest_departures(requests: DataFrame, stop_times: DataFrame, edges: DataFrame, max_boardings: int | None = None) -> DataFrame:
    """Latest time to be at each stop per request and number of boardings used.

    One round per boarding, until no label improves (or ``max_boardings`` are used, if given). Only labels that improved are
    followed. Each looks up the best ride from every other stop (:func:`ride_profile`), and takes it unless the previous
    label of the same stop did, so nothing is expanded twice; the maximum per stop is taken before anything is shuffled.
    """
    deadline = requests.agg(F.max("deadline_sec").cast("long")).scalar()
    profile = cut_lineage(ride_profile(calls_by_day(stop_times), deadline))
    ask = requests.select("query_id", "end_id", "min_transfer_secs", "max_walk_m", _asked_day(requests))
    walks = edges.select(F.col("b_stop_id").alias("stop_id"), F.col("a_stop_id"), F.col("distance_m"),
                         sc.walk_seconds_search(F.col("distance_m")).alias("walk_sec"))
    vehicle = requests.select("query_id", F.col("end_id").alias("stop_id"), F.col("deadline_sec").alias("t"))
    reached = vehicle.select("query_id", "stop_id", F.lit(None).cast("long").alias("t")).limit(0)
    result, boardings = None, 0
    while True:
        walked = vehicle.join(walks, "stop_id").join(ask.select("query_id", "end_id", "max_walk_m"), "query_id").where(
            (F.col("distance_m") <= F.col("max_walk_m")) & (F.col("a_stop_id") != F.col("end_id"))
        ).select("query_id", F.col("a_stop_id").alias("stop_id"), (F.col("t") - F.col("walk_sec")).alias("t"))
        best = vehicle.unionByName(walked.where(F.col("t") >= 0)).groupBy("query_id", "stop_id").agg(F.max("t").alias("t"))
        before = reached.select("query_id", "stop_id", F.col("t").alias("t_before"))
        better = best.join(before, ["query_id", "stop_id"], "left").where(
            F.col("t_before").isNull() | (F.col("t") > F.col("t_before")))
        better = cut_lineage(better)
        found = better.select("query_id", "stop_id", F.lit(boardings).alias("boardings"), "t")
        result = found if result is None else result.unionByName(found)
        reached = result.groupBy("query_id", "stop_id").agg(F.max("t").alias("t"))
        if boardings == max_boardings or better.isEmpty():
            break
        boardings += 1
        change = F.when(F.col("stop_id") == F.col("end_id"), 0).otherwise(F.col("min_transfer_secs"))
        open_labels = better.join(ask, "query_id").withColumns(
            {"latest": F.col("t") - change, "after": F.coalesce(F.col("t_before") - change, F.lit(-1).cast("long"))})
        open_labels = open_labels.where((F.col("latest") >= 0) & (F.col("latest") > F.col("after"))).withColumn(
            "block", _block(F.col("latest")))
        rides = open_labels.join(profile, ["stop_id", "block"]).where(
            _runs(profile) & (F.col("arr") <= F.col("latest")) & (F.col("until").isNull() | (F.col("until") > F.col("latest")))
            & (F.col("arr") > F.col("after")) & (F.col("b_stop") != F.col("end_id")))
        vehicle = rides.groupBy("query_id", F.col("b_stop").alias("stop_id")).agg(F.max("b_dep").alias("t"))
    return result


# ---- labels with confidence --------------------------------------------------------------------------------------


def scored_arrivals(stop_times: DataFrame, levels: DataFrame | None, requests: DataFrame,
                    features: DataFrame | None = None,
                    resolve: Callable[[DataFrame], DataFrame] | None = None, until: Column | None = None) -> DataFrame:
    """Calls with the delay distribution of their stop, hour, line and each requested kind of day; with ``until``, arrivals by then.

    Without levels the normal model of ``features`` is attached, where there is one. ``last_dep`` is the latest departure
    of an earlier call of the trip: nobody who alights here boarded after it.
    """
    earlier = Window.partitionBy("trip_id").orderBy("seq").rangeBetween(Window.unboundedPreceding, -1)
    calls = calls_by_day(stop_times).withColumns(
        {"block": _block(F.col("arr")), "hour_of_day": sc.service_hour(F.col("arr")), "last_dep": F.max("dep").over(earlier)})
    if until is not None:
        calls = calls.where(F.col("arr") <= until)
    kinds = requests.select(sc.dow_bucket_of_name(F.col("day")).alias("dow_bucket")).distinct()
    kinds = kinds.agg(F.collect_set("dow_bucket").alias("kinds")).scalar()  # at most three values
    calls = calls.select("*", F.explode(kinds).alias("dow_bucket"))
    asked = calls.select(F.col("stop_id").alias("bpuic"), "hour_of_day", "dow_bucket", "line_text",
                         F.lit(None).cast("string").alias("product_id_clean")).distinct()
    if resolve is not None:
        resolved = resolve(asked)
    elif levels is not None:
        resolved = ds.resolve_distributions(asked, levels)
    else:
        resolved = asked.select("*", *[F.lit(None).cast("string").alias("source_level")],
                                *[F.lit(None).cast("double").alias(c) for c in ds.DIST_COLS])
    resolved = resolved.select(F.col("bpuic").alias("stop_id"), "hour_of_day", "dow_bucket",
                               F.col("line_text").alias("_line"), "source_level",
                               *[F.col(c).alias(f"d_{c}") for c in ds.DIST_COLS])
    right = resolved.select(F.col("stop_id").alias("_stop"), F.col("hour_of_day").alias("_hour"),
                            F.col("dow_bucket").alias("_dow"), "_line", "source_level", *[f"d_{c}" for c in ds.DIST_COLS])
    same = ((F.col("stop_id") == F.col("_stop")) & (F.col("hour_of_day") == F.col("_hour"))
            & (F.col("dow_bucket") == F.col("_dow")) & F.col("line_text").eqNullSafe(F.col("_line")))
    scored = calls.join(right, same, "left").drop("_stop", "_hour", "_dow", "_line")
    if features is None:
        return scored.withColumns({"avg_sec": F.lit(None).cast("double"), "std_sec": F.lit(None).cast("double")})
    normal = features.select(F.col("bpuic").alias("stop_id"), "hour_of_day",
                             (F.col("hist_avg_delay_mins") * 60.0).alias("avg_sec"),
                             (F.col("hist_std_delay_mins") * 60.0).alias("std_sec"))
    return scored.join(normal, ["stop_id", "hour_of_day"], "left")


_REQUEST = ("query_id", "start_id", "end_id", "day_bit", "dow_bucket", "q", "min_transfer_secs", "max_walk_m", "max_routes",
            "floor_sec")
_LABEL = (*_REQUEST, "stop_id", "t", "conf", "boardings", "walk_m", "next_label", "trail", "path")
# Labels of a search for all alternatives also know the lines that follow, equal neighbours once, and the first of them.
_LINES = ("lines", "first_line")


def _leg(kind: str, from_stop: Column, to_stop: Column, trip: Column, label: Column, line: Column, dep: Column, arr: Column,
         walk: Column) -> Column:
    values = [F.lit(kind), from_stop, to_stop, trip, label, line, dep, arr, walk]
    return F.struct(*values).cast(LEG)


def _known_lines(labels: DataFrame) -> tuple[str, ...]:
    return _LINES if "lines" in labels.columns else ()


def destination_labels(requests: DataFrame) -> DataFrame:
    """A label at each destination; requests may carry the ``floor_sec`` below which nothing is followed."""
    ask = requests.where(F.col("start_id") != F.col("end_id"))
    floor = F.col("floor_sec") if "floor_sec" in requests.columns else F.lit(0)
    return ask.select(
        "query_id", "start_id", "end_id", _asked_day(requests),
        sc.dow_bucket_of_name(F.col("day")).alias("dow_bucket"), "q", "min_transfer_secs", "max_walk_m", "max_routes",
        floor.cast("long").alias("floor_sec"), F.col("end_id").alias("stop_id"), F.col("deadline_sec").cast("long").alias("t"),
        F.lit(1.0).alias("conf"), F.lit(0).alias("boardings"), F.lit(0.0).alias("walk_m"),
        F.lit(None).cast("string").alias("next_label"), F.lit("").alias("trail"),
        F.array().cast(f"array<{LEG}>").alias("path"))


RING_M, RINGS = 50.0, 20


def _ring(metres: Column) -> Column:
    return F.least(F.floor(metres / RING_M), F.lit(RINGS)).cast("int")


def walk_back(labels: DataFrame, edges: DataFrame, walk_limit: str = "total", spare: Column | None = None) -> DataFrame:
    """Labels at the stops from which one walk leads to a labelled stop.

    With ``spare`` only those that many seconds above their floor: a label then meets the walks of the rings that it reaches
    in its time, so labels near their floor are not multiplied by everything around their stop.
    """
    limit = F.col("max_walk_m")
    within = (F.col("new_walk") <= limit) if walk_limit == "total" else (F.col("distance_m") <= limit)
    steps = edges.select(F.col("b_stop_id").alias("stop_id"), F.col("a_stop_id"), F.col("distance_m"),
                         sc.walk_seconds_search(F.col("distance_m")).alias("walk_sec"))
    labels, keys = labels.where(F.col("stop_id") != F.col("start_id")), ["stop_id"]
    if spare is not None:
        steps, keys = steps.withColumn("_ring", _ring(F.col("distance_m"))), ["stop_id", "_ring"]
        seconds = F.col("t") - F.col("floor_sec") - spare
        metres = F.least(limit - (F.col("walk_m") if walk_limit == "total" else 0.0) + 0.01, sc.walk_metres_within(seconds))
        labels = labels.where((seconds >= 0) & (metres >= 0)).withColumn(
            "_ring", F.explode(F.sequence(F.lit(0), _ring(metres))))
        within = within & (F.col("new_t") - spare >= F.col("floor_sec"))
    walked = labels.join(steps, keys).withColumns({
        "new_walk": F.round(F.col("walk_m") + F.col("distance_m"), WALK_DIGITS),
        "new_t": F.col("t") - F.col("walk_sec")})
    walked = walked.where(within & (F.col("new_t") >= F.col("floor_sec")) & (F.col("a_stop_id") != F.col("end_id")))
    nothing = F.lit(None).cast("string")
    leg = _leg("walk", F.col("a_stop_id"), F.col("stop_id"), nothing, nothing, nothing, F.col("new_t"), F.col("t"), F.col("distance_m"))
    step = F.concat(F.lit("w"), F.col("a_stop_id").cast("string"), F.lit(">"), F.col("stop_id").cast("string"), F.lit("|"))
    return walked.select(
        *_REQUEST, F.col("a_stop_id").alias("stop_id"), F.col("new_t").alias("t"), "conf", "boardings",
        F.col("new_walk").alias("walk_m"), nothing.alias("next_label"), F.concat(step, F.col("trail")).alias("trail"),
        F.concat(F.array(leg), F.col("path")).alias("path"), *_known_lines(labels))


def _change_secs() -> Column:
    return F.when(F.col("stop_id") == F.col("end_id"), 0).otherwise(F.col("min_transfer_secs"))


_ARRIVAL = ["trip_id", "seq", "arr", "label", "line_text", "day_mask"]
_DISTRIBUTION = [*[f"d_{c}" for c in ds.DIST_COLS], "avg_sec", "std_sec"]


def _keep_confident(events: DataFrame, final_leg: str) -> DataFrame:
    """Alightings (label columns, call columns, ``slack``) with the new confidence, at least the requested one."""
    score = pr.with_p_connection_clamped if final_leg == "clamped" else pr.with_p_connection
    events = score(events, "p_dist", F.col("slack"), "d_", "d_")
    if final_leg == "cdf":
        events = pr.with_delay_cdf(events, {"p_final": F.col("slack") / 60.0}, "d_")
        events = events.withColumn("p_dist", F.when((F.col("stop_id") == F.col("end_id")) & F.col("d_mean").isNotNull(),
                                                    F.col("p_final")).otherwise(F.col("p_dist"))).drop("p_final")
    p = pr.p_transfer(F.col("q"), F.col("p_dist"), pr.p_connection_normal(F.col("slack"), F.col("avg_sec"), F.col("std_sec")))
    stays = (F.col("stop_id") != F.col("end_id")) & F.coalesce(F.col("next_label") == F.col("label"), F.lit(False))
    conf = F.round(F.col("conf") * F.when(stays, 1.0).otherwise(p), CONF_DIGITS)
    return events.withColumn("conf", conf).where(F.col("conf") >= F.col("q")).drop("p_dist", "slack", *_DISTRIBUTION)


def _boarded(events: DataFrame) -> DataFrame:
    """Alightings with a boarding call (b_stop, b_dep) as labels of that stop."""
    step = F.concat(F.col("trip_id"), F.lit(":"), F.col("b_stop").cast("string"), F.lit(">"), F.col("stop_id").cast("string"), F.lit("|"))
    leg = _leg("ride", F.col("b_stop"), F.col("stop_id"), F.col("trip_id"), F.col("label"), F.col("line_text"), F.col("b_dep"),
               F.col("arr"), F.lit(0.0))
    lines = []
    if _known_lines(events):
        longer = F.when(F.col("first_line") == F.col("label"), F.col("lines")).otherwise(F.concat_ws(LINE_JOINT, "label", F.nullif("lines", F.lit(""))))
        lines = [longer.alias("lines"), F.col("label").alias("first_line")]
    return events.select(
        *_REQUEST, F.col("b_stop").alias("stop_id"), F.col("b_dep").alias("t"), "conf",
        (F.col("boardings") + 1).alias("boardings"), "walk_m", F.col("label").alias("next_label"),
        F.concat(step, F.col("trail")).alias("trail"), F.concat(F.array(leg), F.col("path")).alias("path"), *lines)


def _boardings(arrivals: DataFrame) -> DataFrame:
    return arrivals.select("trip_id", F.col("seq").alias("b_seq"), F.col("stop_id").alias("b_stop"), F.col("dep").alias("b_dep"))


def _best_alightings(events: DataFrame) -> DataFrame:
    """Of the labels that one call of a vehicle serves in a round, those with more confidence or less walking than others.

    All of them lead to the same boardings at the same times, so the others would be dominated at each of these. Labels
    that know the lines that follow are compared with those of the same lines only.
    """
    best_first = Window.partitionBy("query_id", "trip_id", "seq", *_known_lines(events)).orderBy(F.desc("conf"), "walk_m", "trail")
    least = F.min("walk_m").over(best_first.rowsBetween(Window.unboundedPreceding, -1))
    return events.withColumn("_least", least).where(F.col("_least").isNull() | (F.col("walk_m") < F.col("_least"))).drop("_least")


def _alightings(labels: DataFrame, arrivals: DataFrame, final_leg: str) -> DataFrame:
    """Calls of vehicles that arrive in time for a labelled stop, with the new confidence."""
    open_labels = labels.where(F.col("stop_id") != F.col("start_id")).withColumn("latest", F.col("t") - _change_secs())
    open_labels = open_labels.where(F.col("latest") >= F.col("floor_sec")).withColumn(
        "block", F.explode(F.sequence(_block(F.col("floor_sec")), _block(F.col("latest")))))
    events = open_labels.join(arrivals, ["stop_id", "block", "dow_bucket"]).where(
        _runs(arrivals) & F.col("arr").between(F.col("floor_sec"), F.col("latest")) & (F.col("last_dep") >= F.col("floor_sec")))
    events = events.withColumn("slack", F.col("latest") - F.col("arr")).select(
        *_LABEL, *_known_lines(labels), *_ARRIVAL, "slack", *_DISTRIBUTION)
    return _best_alightings(_keep_confident(events, final_leg))


def _with_boardings(events: DataFrame, calls: DataFrame) -> DataFrame:
    return events.join(_boardings(calls), "trip_id").where(
        (F.col("b_seq") < F.col("seq")) & (F.col("b_stop") != F.col("stop_id")) & (F.col("b_stop") != F.col("end_id"))
        & F.col("b_dep").between(F.col("floor_sec"), F.col("arr")))


def ride_back(labels: DataFrame, arrivals: DataFrame, calls: DataFrame, final_leg: str = "connection") -> DataFrame:
    """Labels at every stop where a vehicle can be boarded that alights in time for a labelled stop."""
    return _boarded(_with_boardings(_alightings(labels, arrivals, final_leg), calls))


def ride_back_to_start(labels: DataFrame, arrivals: DataFrame, calls: DataFrame, edges: DataFrame,
                       final_leg: str = "connection") -> DataFrame:
    """As :func:`ride_back`, only for boardings at the origin or one walk from it: the last round needs no others."""
    asks = labels.select("query_id", "start_id", "end_id", "day_bit", "dow_bucket", "max_walk_m", "floor_sec").distinct()
    near = asks.join(edges.select(F.col("a_stop_id").alias("start_id"), F.col("b_stop_id").alias("b_stop"),
                                  F.col("distance_m").alias("first_walk_m")), "start_id").where(
        F.col("first_walk_m") <= F.col("max_walk_m"))
    zone = asks.withColumns({"b_stop": F.col("start_id"), "first_walk_m": F.lit(0.0)}).unionByName(near)
    zone = zone.where(F.col("b_stop") != F.col("end_id"))
    board = zone.join(_boardings(calls), "b_stop").where(F.col("b_dep") >= F.col("floor_sec")).select(
        F.col("query_id").alias("z_query"), F.col("dow_bucket").alias("z_dow"), F.col("day_bit").alias("z_bit"), "b_stop",
        "b_seq", "b_dep", "first_walk_m", "trip_id")
    rides = board.join(arrivals.withColumnRenamed("dow_bucket", "a_dow"), "trip_id").where(
        (F.col("z_dow") == F.col("a_dow")) & (F.col("b_seq") < F.col("seq")) & (F.col("b_stop") != F.col("stop_id"))
        & (F.col("b_dep") <= F.col("arr")) & _runs(arrivals, "z_bit"))
    rides = rides.select(F.col("z_query").alias("query_id"), "stop_id", "b_stop", "b_seq", "b_dep", "first_walk_m",
                         *_ARRIVAL, *_DISTRIBUTION)
    open_labels = labels.where(F.col("stop_id") != F.col("start_id")).withColumn("latest", F.col("t") - _change_secs())
    events = open_labels.join(rides, ["query_id", "stop_id"]).where(
        F.col("arr").between(F.col("floor_sec"), F.col("latest"))
        & (F.col("walk_m") + F.col("first_walk_m") <= F.col("max_walk_m") + 1e-3))
    events = events.withColumn("slack", F.col("latest") - F.col("arr")).select(
        *_LABEL, *_known_lines(labels), *_ARRIVAL, "b_stop", "b_dep", "slack", *_DISTRIBUTION)
    return _boarded(_keep_confident(events, final_leg))


def line_sequence(path: Column) -> Column:
    """Labels of the vehicles in order, equal neighbours once."""
    labels = F.transform(F.filter(path, lambda leg: leg["kind"] == "ride"), lambda leg: leg["label"])
    kept = F.filter(labels, lambda x, i: (i == 0) | (x != F.get(labels, i - 1)))
    return F.concat_ws(LINE_JOINT, kept)


def _best_per_sequence(found: DataFrame) -> DataFrame:
    order = [F.desc("t"), "n_transfers", "walk_m", F.desc("conf"), "trail"]
    first = F.row_number().over(Window.partitionBy("query_id", "lines").orderBy(*order))
    return found.withColumn("_n", first).where(F.col("_n") == 1).drop("_n")


def _ranked(found: DataFrame) -> DataFrame:
    order = [F.desc("t"), "n_transfers", "walk_m", F.desc("conf"), "trail"]
    return found.withColumn("option", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))


_FOUND = ("query_id", "start_id", "end_id", "q", "max_routes", "t", "conf", "boardings", "walk_m", "trail", "path")


def _at_start(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("stop_id") == F.col("start_id")).select(
        *_FOUND, line_sequence(F.col("path")).alias("lines"),
        F.greatest(F.col("boardings") - 1, F.lit(0)).alias("n_transfers"))


def _raise_floor(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels of requests that already have all their routes cannot matter before the last of these departs."""
    full = _ranked(found).where(F.col("option") == F.col("max_routes")).select("query_id", F.col("t").alias("_t"))
    raised = labels.join(full, "query_id", "left").withColumn("floor_sec", F.coalesce(F.col("_t"), F.col("floor_sec")))
    return raised.where(F.col("t") >= F.col("floor_sec")).drop("_t").select(*labels.columns)


def _walked_to_start(labels: DataFrame, edges: DataFrame, walk_limit: str) -> DataFrame:
    """Routes of labels from which one walk leads to their origin."""
    last = labels.select("start_id").distinct().select(F.col("start_id").alias("a_stop_id"))
    return _at_start(walk_back(labels, edges.join(last, "a_stop_id", "left_semi"), walk_limit))


def _repeated(rows: DataFrame, *keys: str) -> bool:
    return not rows.groupBy(*keys).count().where(F.col("count") > 1).isEmpty()


def _at_stops_of(older: DataFrame | None, labels: DataFrame) -> DataFrame | None:
    """Of the ``older`` labels those at a request and stop of ``labels``."""
    if older is None:
        return None
    at = labels.select(F.col("query_id").alias("_id"), F.col("stop_id").alias("_stop")).distinct()
    return older.join(at, F.col("query_id").eqNullSafe(F.col("_id")) & (F.col("stop_id") == F.col("_stop")), "left_semi")


def _routes_from(requests: DataFrame, arrivals: DataFrame, calls: DataFrame, edges: DataFrame, max_boardings: int | None,
                 walk_limit: str, final_leg: str, all_alternatives: bool) -> DataFrame:
    """The best route per sequence of lines of each request, of those that leave no earlier than its ``floor_sec``.

    Only the best ``max_routes`` of a request are sure to be there. Labels at stops within a walk of the origin go before
    the others of a round: their routes raise the floor, and what leaves before it is neither compared nor walked from.
    """
    apart = {"class_column": "next_label", "keys": ("query_id", "stop_id", *(["lines"] if all_alternatives else []))}
    zone = edges.select(F.col("a_stop_id").alias("start_id"), F.col("b_stop_id").alias("stop_id"))
    # No ride is shorter; a label whose change and ride do not fit in above the floor leads nowhere, nor does what it dominates.
    least_ride = F.greatest(F.lit(arrivals.agg(F.min(F.col("arr") - F.col("last_dep"))).first()[0] or 0), F.lit(0))
    rides_on = F.col("t") - _change_secs() - least_ride >= F.col("floor_sec")
    # One row per key needs no comparison.
    single = not _repeated(requests, "query_id") and not _repeated(edges, "a_stop_id", "b_stop_id")
    vehicle = destination_labels(requests)
    if all_alternatives:
        vehicle = vehicle.withColumns({"lines": F.lit(""), "first_line": F.lit(None).cast("string")})
    found = cut_lineage(_best_per_sequence(_walked_to_start(vehicle, edges, walk_limit)))
    older_vehicle = older_any = None
    boardings = 0
    while boardings != max_boardings:
        live = _raise_floor(vehicle, found).where(rides_on)
        walked = walk_back(live, edges, walk_limit, least_ride + F.col("min_transfer_secs"))
        away = live.unionByName(walked.where(F.col("stop_id") != F.col("start_id"))).where(rides_on)
        if boardings or not single:
            away = cut_lineage(away)
            if away.isEmpty():
                break
            labels = cut_lineage(undominated(away, older=_at_stops_of(older_any, away), **apart))
        else:
            labels = away
        older_any = labels if older_any is None else older_any.unionByName(labels)
        boardings += 1
        if boardings == max_boardings:
            boarded = cut_lineage(ride_back_to_start(labels, arrivals, calls, edges, final_leg))
        else:
            boarded = cut_lineage(ride_back(labels, arrivals, calls, final_leg))
        if boarded.isEmpty():
            break
        found = _best_per_sequence(found.unionByName(_at_start(boarded)))
        away = _raise_floor(boarded.where(F.col("stop_id") != F.col("start_id")), found)
        near = away.join(zone, ["start_id", "stop_id"], "left_semi").select(*away.columns)
        near = cut_lineage(undominated(near, older=older_vehicle, **apart))
        found = cut_lineage(_best_per_sequence(found.unionByName(_walked_to_start(near, edges, walk_limit))))
        # From elsewhere a walk doesn't lead to the origin: only another ride does.
        far = _raise_floor(away.join(zone, ["start_id", "stop_id"], "left_anti").select(*away.columns), found)
        far = undominated(far.where(rides_on), older=older_vehicle, **apart)
        vehicle = cut_lineage(_raise_floor(near, found).unionByName(far))
        older_vehicle = vehicle if older_vehicle is None else older_vehicle.unionByName(vehicle)
    return found


# The last stretch of time before the deadlines is searched first: as long as it is expected to have so many alightings
# near the destinations of all requests, and so many seconds at least. Requests that miss routes get one at least twice as long.
ALIGHTINGS_AT_ONCE = 4_000_000
LEAST_STRETCH_SECS = 1200


def _walks_per_stop(edges: DataFrame) -> float:
    return edges.agg((F.count("*") / F.greatest(F.count_distinct("b_stop_id"), F.lit(1))).alias("n")).first()["n"]


def _alightings_a_second(calls: DataFrame, walks: float) -> float:
    """Calls at a stop and those within a walk of it, on average; ``walks``: stops within a walk of one."""
    per_day = calls.agg((F.count("*") / F.greatest(F.count_distinct("stop_id"), F.lit(1))).alias("n")).first()["n"]
    return (1 + walks) * per_day / 86_400


# Before a search that is more than one stretch, rides without a change are looked for between the stops near the origin and near the destination: so many on
# average, in the time before the deadlines first and for requests that miss routes twice as long, so often.
NEAR_STOPS = 100
DIRECT_STRETCH_SECS = 2400
DIRECT_STRETCHES = 3


def direct_floors(requests: DataFrame, arrivals: DataFrame, calls: DataFrame, edges: DataFrame, near: DataFrame, walk_limit: str = "total",
                  final_leg: str = "connection") -> DataFrame:
    """(query_id, ``direct_sec``) of requests for which walking alone and rides without a change have ``max_routes`` lines or more:
    the departure of the last of these.

    Walks at either end are those of ``near``. Whatever it leaves out, the search finds as many sequences of lines that leave no
    earlier: a label that dominates another here has the same line, so its route has too. What leaves before is of no use to it.
    """
    first = destination_labels(requests)
    labels = first.unionByName(walk_back(first, near, walk_limit).where(F.col("stop_id") != F.col("start_id")))
    rides = _with_boardings(_alightings(labels, arrivals, final_leg), calls).select(
        "query_id", "start_id", "max_walk_m", "max_routes", "floor_sec", "walk_m", "b_stop", "b_dep", F.col("label").alias("lines"))
    starts = requests.select("start_id").distinct()
    zone = near.select(F.col("a_stop_id").alias("start_id"), F.col("b_stop_id").alias("b_stop"), F.col("distance_m"),
                       sc.walk_seconds_search(F.col("distance_m")).alias("walk_sec")).join(starts, "start_id", "left_semi")
    zone = zone.unionByName(starts.select("start_id", F.col("start_id").alias("b_stop"), F.lit(0.0).alias("distance_m"),
                                          F.lit(0).cast("long").alias("walk_sec")))
    walked = F.round(F.col("walk_m") + F.col("distance_m"), WALK_DIGITS) if walk_limit == "total" else F.col("distance_m")
    routes = rides.join(zone, ["start_id", "b_stop"]).withColumn("t", F.col("b_dep") - F.col("walk_sec")).where(
        ((F.col("distance_m") == 0) | (walked <= F.col("max_walk_m"))) & (F.col("t") >= F.col("floor_sec")))
    routes = routes.select("query_id", "max_routes", "lines", "t").unionByName(
        _walked_to_start(first, edges, walk_limit).select("query_id", "max_routes", "lines", "t"))
    best = routes.groupBy("query_id", "max_routes", "lines").agg(F.max("t").alias("t"))
    latest_first = Window.partitionBy("query_id").orderBy(F.desc("t"))
    return best.withColumn("_n", F.row_number().over(latest_first)).where(F.col("_n") == F.col("max_routes")).select(
        "query_id", F.col("t").alias("direct_sec"))


def _with_direct_floors(waiting: DataFrame, arrivals: DataFrame, calls: DataFrame, edges: DataFrame, walks: float, walk_limit: str,
                        final_leg: str) -> DataFrame:
    """``waiting`` with ``direct_sec`` of :func:`direct_floors`, null for requests that have none and for ids of several rows."""
    reach = edges.agg(F.max("distance_m")).first()[0] or 0.0
    near = edges.where(F.col("distance_m") <= reach * min(1.0, (NEAR_STOPS / max(walks, 1e-6)) ** 0.5))
    still, stretch, floors = waiting.where((F.col("_rows") == 1) & F.col("query_id").isNotNull()), DIRECT_STRETCH_SECS, []
    for _ in range(DIRECT_STRETCHES):
        asked = still.withColumn("floor_sec", F.greatest(F.col("_end") - stretch, F.lit(0).cast("long")))
        floors.append(cut_lineage(direct_floors(asked, arrivals, calls, edges, near, walk_limit, final_leg)))
        still = cut_lineage(still.join(floors[-1], "query_id", "left_anti"))
        if still.isEmpty():
            break
        stretch *= 2
    return cut_lineage(waiting.join(reduce(DataFrame.unionByName, floors), "query_id", "left"))


def ranked_routes(requests: DataFrame, stop_times: DataFrame, edges: DataFrame, levels: DataFrame | None,
                  features: DataFrame | None = None, max_boardings: int | None = None, walk_limit: str = "total",
                  final_leg: str = "connection", resolve: Callable[[DataFrame], DataFrame] | None = None,
                  all_alternatives: bool = False) -> DataFrame:
    """Up to ``max_routes`` itineraries per request with at least the requested confidence, latest departure first.

    One round per boarding, until no label is left to follow; ``max_boardings`` is for callers who want fewer vehicles.
    Routes differ in their sequence of lines. Columns: query_id, start_id, end_id, q, option, dep_sec (``t``), conf,
    boardings, n_transfers, walk_m, lines, trail, path.

    ``final_leg``: "connection" scores the arrival at the destination like a change of vehicle, "cdf" by the arrival
    delay alone, "clamped" scores all without distribution tails. ``resolve`` replaces the level lookup.

    A label is dominated by labels of the same next line. With a large ``max_routes`` that can hide a route whose lines
    differ further on; ``all_alternatives`` compares only labels that are followed by the same sequence of lines, so that
    the best ``max_routes`` sequences are found, whatever their number. Its labels grow with the sequences that leave no
    earlier than the last route a request still needs: once it has all its routes, that departure bounds every label.
    """
    # What arrives after the last deadline serves no request.
    last = requests.agg(F.max("deadline_sec").cast("long")).scalar()
    arrivals = cut_lineage(scored_arrivals(stop_times, levels, requests, features, resolve, last))
    calls = calls_by_day(stop_times)
    # Rows of one id are ranked together, so they are searched down to the same time.
    ends = requests.groupBy(F.col("query_id").alias("_id")).agg(
        F.max("deadline_sec").cast("long").alias("_end"), F.max("max_routes").alias("_wanted"), F.count("*").alias("_rows"))
    waiting = cut_lineage(requests.join(ends, F.col("query_id").eqNullSafe(F.col("_id"))).drop("_id"))
    walks, direct = _walks_per_stop(edges), F.lit(None).cast("long")
    rate, stretch, done = _alightings_a_second(calls, walks), 0, []
    # A search that takes the whole day at once is small and needs no bounds.
    n, end = waiting.agg(F.count("*"), F.max("_end")).first()
    if (max_boardings is None or max_boardings > 0) and ALIGHTINGS_AT_ONCE < rate * n * (end or 0):
        waiting, direct = _with_direct_floors(waiting, arrivals, calls, edges, walks, walk_limit, final_leg), F.col("direct_sec")
    while True:
        bound = waiting.agg(F.count_if(direct.isNull())).first()[0]
        stretch = max(LEAST_STRETCH_SECS, 2 * stretch, int(ALIGHTINGS_AT_ONCE / max(rate * bound, 1e-6)))
        asked = waiting.withColumn("floor_sec", F.coalesce(direct, F.greatest(F.col("_end") - stretch, F.lit(0).cast("long"))))
        ranked = _ranked(_routes_from(asked, arrivals, calls, edges, max_boardings, walk_limit, final_leg, all_alternatives))
        ranked = cut_lineage(ranked.where(F.col("option") <= F.col("max_routes")))
        done.append(ranked)
        counts = ranked.groupBy(F.col("query_id").alias("_id")).agg(F.count("*").alias("_found"))
        more = asked.join(counts, F.col("query_id").eqNullSafe(F.col("_id")), "left").where(
            (F.col("floor_sec") > 0) & ~F.coalesce(F.col("_found") >= F.col("_wanted"), F.lit(False)))
        waiting, direct = cut_lineage(more.select(*requests.columns, "_end", "_wanted")), F.lit(None).cast("long")
        if waiting.isEmpty():
            break
        again = waiting.select(F.col("query_id").alias("_id")).distinct()
        done[-1] = ranked.join(again, F.col("query_id").eqNullSafe(F.col("_id")), "left_anti")
    return reduce(DataFrame.unionByName, done).select(
        "query_id", "start_id", "end_id", "q", "option", F.col("t").alias("dep_sec"), "conf", "boardings", "n_transfers",
        "walk_m", "lines", "trail", "path")

"""Routes as legs, transfers, summaries and confidence after the search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import probability as pr
from ..functions import scalars as sc
from . import distributions as ds

ROUTE = ("query_id", "option")


def route_legs(routes: DataFrame) -> DataFrame:
    """One row per leg of every route, in travel order."""
    return routes.select("query_id", "start_id", "end_id", "q", "option", F.posexplode("path").alias("n", "leg")).select(
        "query_id", "start_id", "end_id", "q", "option", (F.col("n") + 1).alias("leg_no"), "leg.*")


def collapse_legs(legs: DataFrame) -> DataFrame:
    """Neighbouring rides on one trip or under one label become one ride; walks stay."""
    order = Window.partitionBy(*ROUTE).orderBy("leg_no")
    joined = (F.col("kind") == "ride") & (F.lag("kind").over(order) == "ride") & (
        (F.col("trip_id") == F.lag("trip_id").over(order)) | (F.col("label") == F.lag("label").over(order)))
    marked = legs.withColumn("_starts", F.when(joined, 0).otherwise(1))
    marked = marked.withColumn("part", F.sum("_starts").over(order).cast("int"))
    first = F.min_by(F.struct("kind", "from_stop", "trip_id", "label", "line_text", "dep_sec"), "leg_no")
    last = F.max_by(F.struct("to_stop", "arr_sec"), "leg_no")
    return marked.groupBy(*ROUTE, "start_id", "end_id", "q", "part").agg(
        first.alias("f"), last.alias("l"), F.sum("walk_m").alias("walk_m")).select(
        *ROUTE, "start_id", "end_id", "q", "part", "f.*", "l.*", "walk_m")


def first_last_event(parts: DataFrame) -> DataFrame:
    """Departure of the first event and the last alighting; a route on foot arrives, so to say, when it leaves."""
    alight = F.max(F.when(F.col("kind") == "ride", F.col("arr_sec")))
    return parts.groupBy(*ROUTE).agg(F.min("dep_sec").alias("dep_sec"), F.coalesce(alight, F.max("dep_sec")).alias("arr_sec"))


def endpoint_stops(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*ROUTE).agg(F.min_by("from_stop", "part").alias("first_stop"), F.max_by("to_stop", "part").alias("last_stop"))


def line_sequences(parts: DataFrame) -> DataFrame:
    """Labels of the rides in order, equal neighbours once, as one text per route."""
    rides = parts.where(F.col("kind") == "ride")
    order = Window.partitionBy(*ROUTE).orderBy("part")
    rides = rides.withColumn("_before", F.lag("label").over(order)).where(
        F.col("_before").isNull() | (F.col("_before") != F.col("label")))
    ordered = F.sort_array(F.collect_list(F.struct("part", "label")))
    return rides.groupBy(*ROUTE).agg(F.concat_ws(" > ", ordered["label"]).alias("lines"))


def route_summary(routes: DataFrame, parts: DataFrame, stops: DataFrame) -> DataFrame:
    """What a traveller is shown: texts of both times, duration, changes, walking, and names of both ends."""
    names = stops.select("stop_id", "stop_name")
    out = routes.select(*ROUTE, "start_id", "end_id", "conf", "n_transfers", "walk_m").join(first_last_event(parts), list(ROUTE))
    out = out.join(names.select(F.col("stop_id").alias("start_id"), F.col("stop_name").alias("start_name")), "start_id", "left")
    out = out.join(names.select(F.col("stop_id").alias("end_id"), F.col("stop_name").alias("end_name")), "end_id", "left")
    return out.select(
        *ROUTE, sc.format_hhmm(F.col("dep_sec")).alias("departs"), sc.format_hhmm(F.col("arr_sec")).alias("arrives"),
        F.floor((F.col("arr_sec") - F.col("dep_sec")) / 60).cast("bigint").alias("minutes"), "conf", "n_transfers", "walk_m",
        F.coalesce("start_name", F.col("start_id").cast("string")).alias("start_name"),
        F.coalesce("end_name", F.col("end_id").cast("string")).alias("end_name"))


def transfers(parts: DataFrame) -> DataFrame:
    """Changes of vehicle: where and when the earlier one is left, and when the next one departs."""
    order = Window.partitionBy(*ROUTE).orderBy("part")
    rides = parts.where(F.col("kind") == "ride").withColumns({
        "alight_stop": F.lag("to_stop").over(order), "alight_sec": F.lag("arr_sec").over(order),
        "before": F.lag("trip_id").over(order)})
    return rides.where(F.col("before").isNotNull() & (F.col("before") != F.col("trip_id"))).select(
        *ROUTE, "part", "alight_stop", "alight_sec", F.col("from_stop").alias("board_stop"), F.col("dep_sec").alias("board_sec"),
        "trip_id", "line_text", (F.col("dep_sec") - F.col("alight_sec")).alias("slack_sec"))


def replayed_success(routes: DataFrame, changes: DataFrame, holdout: DataFrame) -> DataFrame:
    """Success of each route over recorded delays: per change the share of delays it bears, multiplied.

    The expected value of independent draws, so nothing is drawn. Delays are counted per stop, hour and second first:
    a busy stop adds at most one row per delay second, however many arrivals it has. No record means no delay.
    """
    counts = ds.value_counts(holdout, ["bpuic", "hour_of_day"], "arr_delay_sec")
    asked = changes.select(F.col("alight_stop").alias("bpuic"), sc.service_hour(F.col("alight_sec")).alias("hour_of_day"),
                           "slack_sec").distinct()
    caught = F.sum(F.when(F.col("arr_delay_sec") <= F.col("slack_sec"), F.col("n")).otherwise(0)) / F.sum("n")
    shares = asked.join(counts, ["bpuic", "hour_of_day"]).groupBy("bpuic", "hour_of_day", "slack_sec").agg(caught.alias("share"))
    scored = changes.withColumns({"bpuic": F.col("alight_stop"), "hour_of_day": sc.service_hour(F.col("alight_sec"))}).join(
        shares, ["bpuic", "hour_of_day", "slack_sec"], "left")
    share = F.coalesce(F.col("share"), F.when(F.col("slack_sec") >= 0, 1.0).otherwise(0.0))
    per_route = scored.groupBy(*ROUTE).agg(F.product(share).alias("success"), F.count("*").alias("n_changes"))
    return routes.join(per_route, list(ROUTE), "left").withColumns({
        "success": F.coalesce("success", F.lit(1.0)), "n_changes": F.coalesce("n_changes", F.lit(0).cast("long"))})


def _checks(parts: DataFrame, requests: DataFrame) -> DataFrame:
    """Changes and the final arrival of every route as rows with a slack."""
    mid = transfers(parts).select(*ROUTE, "part", F.lit("change").alias("what"), F.col("alight_stop").alias("bpuic"),
                                  "alight_sec", "slack_sec", "line_text")
    rides = parts.where(F.col("kind") == "ride")
    last = rides.groupBy(*ROUTE).agg(F.max_by(F.struct("to_stop", "arr_sec", "line_text", "part"), "part").alias("r"))
    final = last.join(requests.select("query_id", "deadline_sec"), "query_id").select(
        *ROUTE, (F.col("r.part") + 1000).alias("part"), F.lit("arrival").alias("what"), F.col("r.to_stop").alias("bpuic"),
        F.col("r.arr_sec").alias("alight_sec"), (F.col("deadline_sec") - F.col("r.arr_sec")).alias("slack_sec"),
        F.col("r.line_text").alias("line_text"))
    days = requests.select("query_id", sc.dow_bucket_of_name(F.col("day")).alias("dow_bucket"))
    return mid.unionByName(final).join(days, "query_id").withColumns({
        "hour_of_day": sc.service_hour(F.col("alight_sec")), "product_id_clean": F.lit(None).cast("string")})


def _normal_model(rows: DataFrame, features: DataFrame | None, stop: str, hour: Column) -> DataFrame:
    """Mean and deviation of the delay at the stop and hour, in seconds; NULL without features."""
    if features is None:
        return rows.withColumns({"avg_sec": F.lit(None).cast("double"), "std_sec": F.lit(None).cast("double")})
    normal = features.select(F.col("bpuic").alias("_stop"), F.col("hour_of_day").alias("_hour"), (F.col("hist_avg_delay_mins") * 60.0).alias("avg_sec"),
                             (F.col("hist_std_delay_mins") * 60.0).alias("std_sec"))
    return rows.join(normal, (F.col(stop) == F.col("_stop")) & (hour == F.col("_hour")), "left").drop("_stop", "_hour")


def confidence_breakdown(parts: DataFrame, requests: DataFrame, levels: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """Every change and the final arrival with its probability and the product so far.

    The probability comes from the delay distribution, else from the normal model of ``features``, else it is 1.

    The slack is the plain time between two events: it leaves out the minimum change time that the search sets aside.
    """
    rows = _checks(parts, requests)
    rows = ds.attach_distribution(rows, ds.resolve_distributions(rows, levels), "d_", {k: k for k in ds.KEYS})
    rows = _normal_model(pr.with_p_connection(rows, "p_known", F.col("slack_sec"), "d_", "d_"), features, "bpuic", F.col("hour_of_day"))
    rows = rows.withColumn("p", F.coalesce("p_known", pr.p_connection_normal(F.col("slack_sec"), F.col("avg_sec"), F.col("std_sec"))))
    so_far = Window.partitionBy(*ROUTE).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("p_so_far", F.product("p").over(so_far)).select(
        *ROUTE, "part", "what", "bpuic", "alight_sec", "slack_sec", "p", "p_so_far")


def route_confidence(routes: DataFrame, parts: DataFrame, requests: DataFrame, levels: DataFrame, features: DataFrame | None = None) -> DataFrame:
    product = confidence_breakdown(parts, requests, levels, features).groupBy(*ROUTE).agg(F.product("p").alias("recomputed"))
    return routes.join(product, list(ROUTE), "left").withColumn("recomputed", F.coalesce("recomputed", F.lit(1.0)))


def legs_with_coords(parts: DataFrame, stops: DataFrame) -> DataFrame:
    """Legs with the position of both ends; NULL for stops outside the prepared region."""
    out = parts
    for side in ("from", "to"):
        at = stops.select(F.col("stop_id").alias(f"{side}_stop"), F.col("stop_lat").alias(f"{side}_lat"),
                          F.col("stop_lon").alias(f"{side}_lon"), F.col("stop_name").alias(f"{side}_name"))
        out = out.join(at, f"{side}_stop", "left")
    return out


# ---- map data ----------------------------------------------------------------------------------------------------


def route_segments(parts: DataFrame, stops: DataFrame) -> DataFrame:
    """One straight segment per leg whose ends have positions."""
    return legs_with_coords(parts, stops).where(F.col("from_lat").isNotNull() & F.col("to_lat").isNotNull()).select(
        *ROUTE, "part", "kind", "label", "from_lat", "from_lon", "to_lat", "to_lon")


def _events(parts: DataFrame, stops: DataFrame) -> DataFrame:
    """Boardings, alightings and both ends of walks in drawing order, with positions."""
    pieces = F.array(
        F.struct(F.lit(0).alias("side"), F.col("from_stop").alias("stop_id"), F.col("dep_sec").alias("sec")),
        F.struct(F.lit(1).alias("side"), F.col("to_stop").alias("stop_id"), F.when(
            F.col("kind") == "ride", F.col("arr_sec")).otherwise(F.col("dep_sec")).alias("sec")))
    rows = parts.select(*ROUTE, "part", "kind", "trip_id", F.explode(pieces).alias("e")).select(
        *ROUTE, "part", "kind", "trip_id", "e.*")
    return rows.join(stops.select("stop_id", "stop_name", "stop_lat", "stop_lon"), "stop_id")


def transfer_points(parts: DataFrame, stops: DataFrame) -> DataFrame:
    """Stops where the vehicle changes, except both ends of the first option; the first option that has one shows it.

    An alighting follows the boarding of its own trip, so only boardings and walks change the vehicle.
    """
    ends = endpoint_stops(parts).where(F.col("option") == 1).select("query_id", "first_stop", "last_stop")
    order = Window.partitionBy(*ROUTE).orderBy("part")
    before = parts.select(*ROUTE, "part", F.coalesce("trip_id", F.lit("walk")).alias("_trip"))
    before = before.withColumn("_before", F.lag("_trip").over(order))
    events = _events(parts, stops).join(before, [*ROUTE, "part"])
    changed = (F.col("_before").isNull() & (F.col("kind") == "ride")) | (F.col("_before") != F.col("_trip"))
    shown = changed & ((F.col("kind") == "walk") | (F.col("side") == 0))
    events = events.where(shown).join(ends, "query_id").where(
        (F.col("stop_id") != F.col("first_stop")) & (F.col("stop_id") != F.col("last_stop")))
    first = F.min_by(F.struct("option", "sec", "stop_name", "stop_lat", "stop_lon"), F.struct("option", "part", "side"))
    return events.groupBy("query_id", "stop_id").agg(first.alias("p")).select("query_id", "stop_id", "p.*")


def map_extent(parts: DataFrame, stops: DataFrame, margin: float = 0.002) -> DataFrame:
    events = _events(parts, stops)
    return events.groupBy("query_id").agg(
        F.avg("stop_lat").alias("center_lat"), F.avg("stop_lon").alias("center_lon"),
        (F.min("stop_lat") - margin).alias("south"), (F.min("stop_lon") - margin).alias("west"),
        (F.max("stop_lat") + margin).alias("north"), (F.max("stop_lon") + margin).alias("east"))


# ---- audits ------------------------------------------------------------------------------------------------------


def network_walk_seed(requests: DataFrame, edges: DataFrame) -> DataFrame:
    """Stops one walk from the destination, with the latest time to start that walk."""
    return requests.join(edges.withColumnRenamed("a_stop_id", "stop_id"), F.col("end_id") == F.col("b_stop_id")).where(
        F.col("distance_m") <= F.col("max_walk_m")).select(
        "query_id", "stop_id", "distance_m",
        (F.col("deadline_sec") - sc.walk_seconds_search(F.col("distance_m"))).alias("latest_sec"))


def feasibility_audit(requests: DataFrame, rides: DataFrame, latest: DataFrame, scored: DataFrame) -> DataFrame:
    """Rides that land at each request's destination, counted by the reason for which the last leg is or is not used.

    ``latest`` has the latest time per (request, stop); ``scored`` the delay distribution of every call.
    """
    day = F.col("day")
    flags = F
    for name in fv.DAYS:
        flags = flags.when(F.lower(day) == name, F.col(name))
    landing = requests.join(rides, F.col("arr_stop_id") == F.col("end_id")).where(flags.otherwise(F.lit(False)))
    landing = landing.select("query_id", "q", "deadline_sec", F.col("trip_id").cast("string").alias("trip_id"), "dep_stop_id",
                             "arr_stop_id", F.col("dep_time_sec").cast("long").alias("dep"), F.col("arr_time_sec").cast("long").alias("arr"),
                             sc.dow_bucket_of_name(day).alias("dow_bucket"))
    at = scored.select("trip_id", F.col("stop_id").alias("arr_stop_id"), "arr", "dow_bucket",
                       *[F.col(f"d_{c}") for c in ds.DIST_COLS], "avg_sec", "std_sec").dropDuplicates(["trip_id", "arr_stop_id", "arr", "dow_bucket"])
    rows = landing.join(at, ["trip_id", "arr_stop_id", "arr", "dow_bucket"], "left")
    best = latest.groupBy("query_id", "stop_id").agg(F.max("t").alias("best"))
    rows = rows.join(best.withColumnRenamed("stop_id", "dep_stop_id"), ["query_id", "dep_stop_id"], "left")
    rows = pr.with_p_connection(rows, "p", F.col("deadline_sec") - F.col("arr"), "d_", "d_")
    p = pr.p_transfer(F.col("q"), F.col("p"), pr.p_connection_normal(F.col("deadline_sec") - F.col("arr"), F.col("avg_sec"), F.col("std_sec")))
    reason = (
        F.when(F.col("arr") > F.col("deadline_sec"), "too late").when(F.round(p, 9) < F.col("q"), "confidence below Q")
        .when(F.col("best").isNull(), "unreachable").when(F.col("dep") < F.col("best"), "not better").otherwise("accepted"))
    return rows.groupBy("query_id", reason.alias("reason")).agg(F.count("*").alias("n"))


def feasibility_at_stops(requests: DataFrame, rides: DataFrame, latest: DataFrame, scored: DataFrame, watched: DataFrame) -> DataFrame:
    """Rides that touch a watched stop on each request's day, counted by the reason for which they are or are not used.

    A ride is judged at the stop where it lands, against the request's final label there (``latest``: the latest time to
    be at a stop): without a label it is "unreachable", after it (with the time to change) "too late", with too little
    slack "confidence below Q"; then at the stop where it departs: earlier than the label there it is "not better", else
    "accepted". A ride between two watched stops counts at both. Rides without a label are counted as the difference to
    all rides of the day, so requests meet rides only over a label that they share.
    """
    stops = watched.select(F.col("stop_id").alias("watched_id")).distinct()
    landing = rides.join(stops, F.col("arr_stop_id") == F.col("watched_id"))
    leaving = rides.where(F.col("arr_stop_id") != F.col("dep_stop_id")).join(stops, F.col("dep_stop_id") == F.col("watched_id"))
    touch = landing.unionByName(leaving)
    ask = requests.select("query_id", "end_id", "q", "min_transfer_secs", F.lower("day").alias("day"), sc.dow_bucket_of_name(F.col("day")).alias("dow_bucket"))
    best = latest.groupBy("query_id", "stop_id").agg(F.max("t").alias("t"))
    runs = F
    for name in fv.DAYS:
        runs = runs.when(F.col("day") == name, F.col(name))
    rows = touch.join(best.select("query_id", F.col("stop_id").alias("arr_stop_id"), F.col("t").alias("label")), "arr_stop_id")
    rows = rows.join(ask, "query_id").where(runs.otherwise(F.lit(False))).select(
        "query_id", "watched_id", "q", "dow_bucket", "dep_stop_id", "arr_stop_id", F.col("trip_id").cast("string").alias("trip_id"),
        F.col("dep_time_sec").cast("long").alias("dep"), F.col("arr_time_sec").cast("long").alias("arr"),
        (F.col("label") - F.when(F.col("arr_stop_id") == F.col("end_id"), 0).otherwise(F.col("min_transfer_secs")) - F.col("arr_time_sec")).alias("slack"))
    at = scored.select("trip_id", F.col("stop_id").alias("arr_stop_id"), "arr", "dow_bucket", *[F.col(f"d_{c}") for c in ds.DIST_COLS],
                       "avg_sec", "std_sec").dropDuplicates(["trip_id", "arr_stop_id", "arr", "dow_bucket"])
    rows = rows.join(at, ["trip_id", "arr_stop_id", "arr", "dow_bucket"], "left")
    rows = rows.join(best.select("query_id", F.col("stop_id").alias("dep_stop_id"), F.col("t").alias("best")), ["query_id", "dep_stop_id"], "left")
    rows = pr.with_p_connection(rows, "p", F.col("slack"), "d_", "d_")
    p = pr.p_transfer(F.col("q"), F.col("p"), pr.p_connection_normal(F.col("slack"), F.col("avg_sec"), F.col("std_sec")))
    reason = (F.when(F.col("slack") < 0, "too late").when(F.round(p, 9) < F.col("q"), "confidence below Q")
              .when(F.col("dep") < F.col("best"), "not better").otherwise("accepted"))
    judged = rows.groupBy("query_id", "watched_id", reason.alias("reason")).agg(F.count("*").alias("n"))
    of_day = touch.groupBy("watched_id").agg(*[F.count(F.when(F.col(d), 1)).alias(d) for d in fv.DAYS])
    of_day = of_day.select("watched_id", F.explode(F.array(*[F.struct(F.lit(d).alias("day"), F.col(d).alias("n")) for d in fv.DAYS])).alias("d"))
    every = ask.select("query_id", "day").join(of_day.select("watched_id", "d.day", "d.n"), "day")
    known = judged.groupBy("query_id", "watched_id").agg(F.sum("n").alias("known"))
    rest = every.join(known, ["query_id", "watched_id"], "left").select(
        "query_id", "watched_id", F.lit("unreachable").alias("reason"), (F.col("n") - F.coalesce("known", F.lit(0))).alias("n"))
    return judged.unionByName(rest.where(F.col("n") > 0)).withColumnRenamed("watched_id", "stop_id")

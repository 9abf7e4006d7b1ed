"""Stops inside regions, walking edges between stops, and stop search by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import scalars as sc

BAND_DEGREES = 0.01


def valid_stops(stops: DataFrame) -> DataFrame:
    """Numbered, non-parent stops with the station number in place of the platform id."""
    head = F.get(F.split("stop_id", ":"), F.lit(0))
    return stops.where(
        (F.col("location_type").isNull() | (F.col("location_type") != 1)) & head.rlike("^85[0-9]{5}$")
    ).select(
        sc.stop_number(F.col("stop_id")).alias("stop_id"), "stop_name",
        F.col("stop_lat").cast("double").alias("stop_lat"), F.col("stop_lon").cast("double").alias("stop_lon"),
    )


def _band(degrees: Column) -> Column:
    return F.floor(degrees / BAND_DEGREES).cast("int")


def stop_region_pairs(stops: DataFrame, edges: DataFrame) -> DataFrame:
    """(stop point, region) pairs where the point lies strictly inside the region.

    A point meets only the edges of its own latitude band (an equi join); an odd number of edges to its right means
    inside, which covers holes and several polygons per region alike.
    """
    points = stops.select("stop_id", "stop_name", "stop_lat", "stop_lon").distinct()
    points = points.withColumn("band", _band(F.col("stop_lat")))
    edges = edges.withColumn(
        "band", F.explode(F.sequence(_band(F.least("y1", "y2")), _band(F.greatest("y1", "y2")))))
    x, y = F.col("stop_lon"), F.col("stop_lat")
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    spans = (y1 > y) != (y2 > y)
    at_x = x1 + F.try_divide((x2 - x1) * (y - y1), y2 - y1)
    on_edge = ((x2 - x1) * (y - y1) == (y2 - y1) * (x - x1)) & x.between(F.least(x1, x2), F.greatest(x1, x2)) \
        & y.between(F.least(y1, y2), F.greatest(y1, y2))
    hits = points.join(edges, "band").where(x <= F.greatest(x1, x2)).select(
        "stop_id", "stop_name", "stop_lat", "stop_lon", "uuid",
        F.when(spans & (x < at_x), 1).otherwise(0).alias("crossing"), on_edge.alias("on_edge"))
    return (
        hits.groupBy("stop_id", "stop_name", "stop_lat", "stop_lon", "uuid")
        .agg(F.sum("crossing").alias("crossings"), F.max("on_edge").alias("on_edge"))
        .where((F.col("crossings") % 2 == 1) & ~F.col("on_edge"))
        .drop("crossings", "on_edge")
    )


def stops_in_regions(stops: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per valid stop inside any region: greatest name, mean position of its distinct points."""
    inside = stop_region_pairs(valid_stops(stops), edges)
    inside = inside.select("stop_id", "stop_name", "stop_lat", "stop_lon").distinct()
    return inside.groupBy("stop_id").agg(
        F.max("stop_name").alias("stop_name"), F.avg("stop_lat").alias("stop_lat"), F.avg("stop_lon").alias("stop_lon"))


def _cell(metres: Column, size: float) -> Column:
    return F.floor(metres / F.lit(size)).cast("int")


def walking_edges(stops: DataFrame, max_walk_m: float = 500.0, walk_speed_m_per_min: float = 50.0) -> DataFrame:
    """Directed pairs of different stops at most ``max_walk_m`` apart; none if no walking is allowed.

    Stops are put into cubes of that size on the sphere, so partners lie in neighbouring cubes: an equi join on the
    cube instead of a comparison of every pair, valid at any latitude and across the date line.
    """
    size = float(max_walk_m) or 1.0
    lat, lon = F.radians("stop_lat"), F.radians("stop_lon")
    radius = F.lit(fv.EARTH_RADIUS_M)
    cells = stops.select(
        "stop_id", "stop_lat", "stop_lon",
        _cell(radius * F.cos(lat) * F.cos(lon), size).alias("cx"),
        _cell(radius * F.cos(lat) * F.sin(lon), size).alias("cy"),
        _cell(radius * F.sin(lat), size).alias("cz"))
    near = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    a = cells.select(F.col("stop_id").alias("a_stop_id"), F.col("stop_lat").alias("a_lat"),
                     F.col("stop_lon").alias("a_lon"), "cx", "cy", "cz")
    for axis in ("cx", "cy", "cz"):
        a = a.withColumn("step", F.explode(near)).withColumn(axis, F.col(axis) + F.col("step")).drop("step")
    b = cells.select(F.col("stop_id").alias("b_stop_id"), F.col("stop_lat").alias("b_lat"),
                     F.col("stop_lon").alias("b_lon"), "cx", "cy", "cz")
    metres = sc.haversine_m(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    return (
        a.join(b, ["cx", "cy", "cz"])
        .where(F.col("a_stop_id") != F.col("b_stop_id"))
        .select("a_stop_id", "b_stop_id", metres.alias("distance_m"))
        .where((F.col("distance_m") <= float(max_walk_m)) & F.lit(max_walk_m > 0))
        .withColumn("walk_time_sec", sc.walk_seconds_stored(F.col("distance_m"), walk_speed_m_per_min))
    )


def stop_name_search(stops: DataFrame, fragment: str, top: int = 10) -> DataFrame:
    """Stops whose name contains the text (any case): exact names first, then the shortest."""
    name, wanted = F.lower("stop_name"), fragment.lower()
    hits = stops.where(F.instr(name, wanted) > 0).select(
        "stop_id", "stop_name", (name == F.lit(wanted)).alias("is_exact"), F.length("stop_name").alias("name_length"))
    return hits.orderBy(F.desc("is_exact"), "name_length", "stop_name", "stop_id").limit(top)


def match_names(names: DataFrame, stops: DataFrame) -> DataFrame:
    """``names(name)`` to one stop each: an exact match in any case, else the shortest name that contains the text.

    Exact matches are an equi join. The other texts are looked up by their rarest piece of up to three letters: a name
    that contains the text contains that piece, so the comparison stays an equi join on short lists.
    """
    wanted = names.select("name", F.lower("name").alias("text")).where(F.length("text") > 0).distinct()
    known = stops.select("stop_id", F.lower("stop_name").alias("known"))
    exact = wanted.join(known, F.col("text") == F.col("known")).groupBy("name").agg(F.min("stop_id").alias("stop_id"))
    rest = wanted.join(exact.select("name"), "name", "left_anti")

    def pieces(text: str, size: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - size + 1)
        return F.array_distinct(F.transform(starts, lambda i: F.substr(F.col(text), i, size)))

    sizes = [F.when(F.length("known") >= k, pieces("known", F.lit(k))).otherwise(F.array().cast("array<string>"))
             for k in (1, 2, 3)]
    index = known.select("stop_id", "known", F.explode(F.concat(*sizes)).alias("piece"))
    frequency = index.groupBy("piece").agg(F.count("*").alias("n_names"))
    asked = rest.select("name", "text", F.explode(pieces("text", F.least(F.lit(3), F.length("text")))).alias("piece"))
    rarest = asked.join(frequency, "piece").groupBy("name", "text").agg(
        F.min_by("piece", F.struct("n_names", "piece")).alias("piece"))
    found = rarest.join(index, "piece").where(F.instr(F.col("known"), F.col("text")) > 0)
    best = found.groupBy("name").agg(F.min(F.struct(F.length("known").alias("size"), "known", "stop_id")).alias("best"))
    return exact.unionByName(best.select("name", F.col("best.stop_id").alias("stop_id")))

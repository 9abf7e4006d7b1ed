"""Regions, walking edges, timetable preparation and windows over it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..operators import actuals as ac
from ..operators import places, timetable
from . import shared
from .registry import query
from .shared import DAY_LIST, rounded, rounded_sql


@query("stops_in_regions", f"SELECT stop_id, stop_name, {rounded_sql(['stop_lat', 'stop_lon'])} FROM ox_region_stops")
def stops_in_regions(t):
    return shared.region_stops(t).select("stop_id", "stop_name", *rounded(["stop_lat", "stop_lon"]))


@query("walking_edges", f"SELECT a_stop_id, b_stop_id, {rounded_sql(['distance_m'], 4)}, walk_time_sec FROM ox_edges")
def walking_edges(t):
    return shared.edges(t).select("a_stop_id", "b_stop_id", *rounded(["distance_m"], 4), "walk_time_sec")


@query("trips_touching_region", "SELECT trip_id FROM ox_region_trips")
def trips_touching_region(t):
    return timetable.trips_touching_region(t.view("fx_stop_times_text"), shared.region_stops(t))


@query("region_stop_times", f"""
SELECT trip_id, route_id, line_text, route_label, service_id, stop_id, stop_sequence, arrival_time_sec, departure_time_sec,
       {DAY_LIST} FROM ox_stop_times""")
def region_stop_times(t):
    return shared.stop_times(t)


@query("connections", f"""
SELECT trip_id, route_id, line_text, route_label, dep_stop_id, arr_stop_id, dep_time_sec, arr_time_sec, {DAY_LIST}
FROM ox_connections""")
def connections(t):
    return shared.rides(t)


@query("actuals_with_route_type", """
SELECT event_id, operator_id_clean, line_text, transport, route_type, product_id_clean, transport_clean, arr_delay_sec,
       hour_of_day, day_of_week, month, 'all' AS variant FROM ox_clean
UNION ALL
SELECT event_id, operator_id_clean, line_text, transport, min(route_type), min_by(product_id_clean, coalesce(route_type, 0)),
       transport_clean, arr_delay_sec, hour_of_day, day_of_week, month, 'one' FROM ox_clean
GROUP BY event_id, operator_id_clean, line_text, transport, transport_clean, arr_delay_sec, hour_of_day, day_of_week, month""")
def actuals_with_route_type(t):
    def part(dedupe, variant):
        return ac.clean_actuals(t.view("fx_actuals"), t.view("fx_routes"), dedupe).select(
            "event_id", "operator_id_clean", "line_text", "transport", "route_type", "product_id_clean", "transport_clean",
            "arr_delay_sec", "hour_of_day", "day_of_week", "month", F.lit(variant).alias("variant"))
    return part(False, "all").unionByName(part(True, "one"))


@query("actuals_in_region", """
SELECT event_id, bpuic, operating_day FROM fx_actuals WHERE bpuic IN (SELECT stop_id FROM ox_region_stops)""")
def actuals_in_region(t):
    return ac.actuals_in_region(t.view("fx_actuals"), shared.region_stops(t)).select("event_id", "bpuic", "operating_day")


@query("network_size", """
SELECT 'stops' AS what, count(*) AS n FROM ox_region_stops UNION ALL SELECT 'connections', count(*) FROM ox_connections
UNION ALL SELECT 'stops_with_walks', count(DISTINCT a_stop_id) FROM ox_edges""")
def network_size(t):
    return timetable.network_size(shared.region_stops(t), shared.rides(t), shared.edges(t))


@query("landings_at_stop", """
SELECT c.arr_stop_id, rank, dep_stop_id, dep_time_sec, arr_time_sec, trip_id, n_landings FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY arr_stop_id ORDER BY arr_time_sec DESC, dep_time_sec DESC, dep_stop_id, trip_id) AS INTEGER)
         AS rank, count(*) OVER (PARTITION BY arr_stop_id) AS n_landings
  FROM ox_connections WHERE tuesday AND arr_stop_id IN (SELECT stop_id FROM ox_region_stops)) c WHERE rank <= 5""")
def landings_at_stop(t):
    return timetable.landings_at_stops(shared.prepared(t).connections, shared.prepared(t).stops, shared.DAY)


@query("trip_attributes", """
SELECT trip_id, line_text, route_label FROM (
  SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY dep_time_sec, arr_time_sec, dep_stop_id, arr_stop_id) AS r
  FROM ox_connections) c WHERE r = 1""")
def trip_attributes(t):
    return timetable.trip_attributes(shared.prepared(t).connections)

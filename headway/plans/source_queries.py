"""Scans, sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..config import NetworkConfig, shared_folder
from ..functions import fixed_values as fv
from ..sources import artifacts, snapshots
from . import shared
from .registry import query


@query("latest_snapshot", """
SELECT 'trips' AS source, pub_date, count(*) AS n, sum(trip_id) AS key_sum FROM fx_trip_snapshots
WHERE pub_date = (SELECT max(pub_date) FROM fx_trip_snapshots) GROUP BY ALL
UNION ALL SELECT 'stop_times', pub_date, count(*), sum(trip_id) FROM fx_stop_time_snapshots
WHERE pub_date = (SELECT max(pub_date) FROM fx_stop_time_snapshots) GROUP BY ALL
UNION ALL SELECT 'trips_1998', pub_date, count(*), sum(trip_id) FROM fx_trip_snapshots
WHERE pub_date = DATE '1998-10-03' GROUP BY ALL""".replace("sum(trip_id)", "CAST(sum(trip_id) AS BIGINT)"))
def latest_snapshot(t):
    trips, calls = t.view("fx_trip_snapshots"), t.view("fx_stop_time_snapshots")
    parts = (("trips", snapshots.latest_snapshot(trips)), ("stop_times", snapshots.latest_snapshot(calls)),
             ("trips_1998", snapshots.latest_snapshot(trips, "1998-10-03")))
    out = None
    for name, rows in parts:
        part = rows.groupBy("pub_date").agg(F.count("*").alias("n"), F.sum("trip_id").alias("key_sum")).select(
            F.lit(name).alias("source"), "pub_date", "n", "key_sum")
        out = part if out is None else out.unionByName(part)
    return out


@query("latest_operating_day", "SELECT max(operating_day) AS operating_day FROM fx_actuals")
def latest_operating_day(t):
    return snapshots.latest_operating_day(t.view("fx_actuals"))


@query("actuals_date_range", """
SELECT event_id, operating_day, bpuic FROM fx_actuals
WHERE operating_day >= DATE '2024-01-10' AND operating_day <= DATE '2024-01-20'""")
def actuals_date_range(t):
    return snapshots.actuals_between(t.view("fx_actuals"), "2024-01-10", "2024-01-20").select(
        "event_id", "operating_day", "bpuic")


@query("weather_stations_scan", """
SELECT CAST(s_suppkey AS VARCHAR) AS station, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_acctbal END AS lat,
       CAST(s_nationkey AS DOUBLE) AS lon FROM {supplier}""")
def weather_stations_scan(t):
    path = f"{shared_folder(t.spark)}/stations-{uuid.uuid4().hex}"
    t.sql("""SELECT s_suppkey AS station, CASE WHEN s_suppkey % 7 = 0 THEN 'n/a' ELSE CAST(s_acctbal AS STRING) END AS lat,
                    s_nationkey AS lon FROM {supplier}""").write.option("header", True).csv(path)
    return snapshots.weather_stations(t.spark, path)


def _config(t) -> NetworkConfig:
    return shared.network_config(f"{shared_folder(t.spark)}/artifacts-{uuid.uuid4().hex}")


_SIZES = """
SELECT 'stops' AS artifact, count(*) AS n FROM ox_region_stops UNION ALL SELECT 'walking_edges', count(*) FROM ox_edges
UNION ALL SELECT 'stop_times', count(*) FROM ox_stop_times UNION ALL SELECT 'connections', count(*) FROM ox_connections
UNION ALL SELECT 'actuals', count(*) FROM ox_clean UNION ALL SELECT 'delay_training', count(*) FROM ox_training
UNION ALL SELECT 'delay_features', count(*) FROM (SELECT DISTINCT bpuic, hour_of_day FROM ox_training) d
UNION ALL SELECT 'delay_levels', count(*) FROM ox_levels"""


def _sizes(prepared: artifacts.PreparedNetwork):
    out = None
    for name in artifacts.CORE + artifacts.OPTIONAL:
        part = getattr(prepared, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("artifact"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("prepared_write", _SIZES)
def prepared_write(t):
    return _sizes(shared.build_prepared(t, _config(t)))


@query("prepared_read", f"""
SELECT trip_id, dep_stop_id, arr_stop_id, dep_time_sec, arr_time_sec, route_label, {shared.DAY_LIST} FROM ox_connections""")
def prepared_read(t):
    cfg = _config(t)
    artifacts.write_prepared(
        artifacts.PreparedNetwork(shared.region_stops(t), shared.edges(t), shared.stop_times(t), shared.rides(t)), cfg)
    return artifacts.read_prepared(t.spark, cfg).connections.select(
        "trip_id", "dep_stop_id", "arr_stop_id", "dep_time_sec", "arr_time_sec", "route_label", *fv.DAYS)


@query("prepare_or_load", _SIZES)
def prepare_or_load(t):
    cfg = _config(t)
    artifacts.prepare_or_load(t.spark, cfg, lambda: shared.build_prepared(t, cfg))

    def fail():
        raise AssertionError("prepared tables were not found again")
    return _sizes(artifacts.prepare_or_load(t.spark, cfg, fail))


@query("region_shapes_by_uuid", """
SELECT uuid, name, level FROM fx_shapes WHERE uuid IN (md5('shape3'), md5('shape14'), md5('shape15'))""")
def region_shapes_by_uuid(t):
    import hashlib
    wanted = [hashlib.md5(f"shape{i}".encode()).hexdigest() for i in (3, 14, 15)]
    return snapshots.shapes_by_uuid(t.view("fx_shapes"), wanted)


@query("region_shapes_by_name", """
SELECT uuid, name, level FROM fx_shapes WHERE regexp_matches(name, '(?i)^NATION_[0-9]*7$') AND level = 'district'""")
def region_shapes_by_name(t):
    return snapshots.shapes_by_name(t.view("fx_shapes"), "(?i)^NATION_[0-9]*7$")


@query("temporal_holdout_split", f"""
SELECT count(DISTINCT CASE WHEN operating_day < DATE '{shared.SPLIT}' THEN operating_day END) AS n_train_days,
       count(DISTINCT CASE WHEN operating_day >= DATE '{shared.SPLIT}' THEN operating_day END) AS n_holdout_days,
       count(CASE WHEN operating_day < DATE '{shared.SPLIT}' THEN 1 END) AS n_train_rows,
       count(CASE WHEN operating_day >= DATE '{shared.SPLIT}' THEN 1 END) AS n_holdout_rows FROM ox_clean""")
def temporal_holdout_split(t):
    return snapshots.split_day_counts(shared.clean(t), shared.SPLIT)


@query("capped_training_sample", """
SELECT * EXCLUDE (dow_bucket) FROM ox_training WHERE bpuic IN (SELECT stop_id FROM ox_region_stops) AND CAST('0x' || substr(md5(concat_ws('|', CAST(operating_day AS VARCHAR),
  CAST(trip_id AS VARCHAR), CAST(bpuic AS VARCHAR), CAST(hour_of_day AS VARCHAR), CAST(arr_delay_sec AS VARCHAR), '42')), 1, 8) AS BIGINT) % 1000000 < 50000""")
def capped_training_sample(t):
    from ..operators.actuals import actuals_in_region
    rows = actuals_in_region(shared.training(t), shared.region_stops(t))
    keys = ("operating_day", "trip_id", "bpuic", "hour_of_day", "arr_delay_sec")
    return snapshots.capped_sample(rows, keys, 0.05, 200_000)

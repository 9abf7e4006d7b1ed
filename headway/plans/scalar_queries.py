"""Scalar functions, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import probability as pr
from ..functions import scalars as sc
from ..operators import actuals as ac
from ..operators import distributions as ds
from ..operators import places, timetable
from . import shared
from .registry import ORACLE_BLOCKS, query
from .shared import rounded, rounded_sql, seconds_sql, transport_mode_sql, route_mode_sql, vehicle_sql


@query("gtfs_time_to_seconds", f"""
SELECT trip_id, stop_sequence, {seconds_sql('arrival_time')} AS arrival_time_sec,
       {seconds_sql('departure_time')} AS departure_time_sec FROM fx_stop_times_text""")
def gtfs_time_to_seconds(t):
    return t.view("fx_stop_times_text").select(
        "trip_id", "stop_sequence", sc.gtfs_seconds(F.col("arrival_time")).alias("arrival_time_sec"),
        sc.gtfs_seconds(F.col("departure_time")).alias("departure_time_sec"))


@query("stop_id_to_number", """
SELECT stop_id AS platform_id, TRY_CAST(split_part(stop_id, ':', 1) AS BIGINT) AS stop_number FROM fx_stops_raw""")
def stop_id_to_number(t):
    return t.view("fx_stops_raw").select(F.col("stop_id").alias("platform_id"),
                                         sc.stop_number(F.col("stop_id")).alias("stop_number"))


@query("normalize_status", """
SELECT event_id, CASE WHEN arr_status = '' THEN 'PROGNOSE' ELSE arr_status END AS status FROM fx_actuals""")
def normalize_status(t):
    return t.view("fx_actuals").select("event_id", sc.clean_status(F.col("arr_status")).alias("status"))


@query("mode_from_transport", f"""
SELECT event_id, transport, {transport_mode_sql('transport', 'product_id')} AS mode FROM fx_actuals""")
def mode_from_transport(t):
    return t.view("fx_actuals").select(
        "event_id", "transport", sc.mode_from_transport(F.col("transport"), F.col("product_id")).alias("mode"))


# Every route type from 0 to 1599 as the parts table grows.
_TYPES = "SELECT p_partkey, CAST((p_partkey * 37) % 1600 AS INT) AS route_type FROM {part}"


@query("mode_from_route_type", f"SELECT p_partkey, route_type, {route_mode_sql('route_type')} AS mode FROM ({_TYPES}) p")
def mode_from_route_type(t):
    return t.sql(_TYPES).select("p_partkey", "route_type", sc.mode_from_route_type(F.col("route_type")).alias("mode"))


@query("vehicle_type", f"SELECT p_partkey, route_type, {vehicle_sql('route_type')} AS vehicle FROM ({_TYPES}) p")
def vehicle_type(t):
    return t.sql(_TYPES).select("p_partkey", "route_type", sc.vehicle_type(F.col("route_type")).alias("vehicle"))


_LABELS = """SELECT p_partkey, CAST((p_partkey * 37) % 1600 AS INT) AS route_type,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'L' || CAST(p_partkey % 40 AS STRING) END AS line_text FROM {part}"""


@query("route_label", f"""
SELECT p_partkey, label, coalesce(nullif(CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN '' ELSE label END, ''),
       nullif(line_text, ''), CAST(p_partkey AS VARCHAR)) AS shown
FROM (SELECT *, concat_ws(' ', {vehicle_sql('route_type')}, line_text) AS label FROM ({_LABELS}) p) q""")
def route_label(t):
    rows = t.sql(_LABELS).withColumn("label", sc.route_label(F.col("route_type"), F.col("line_text")))
    patchy = F.when(F.col("p_partkey") % 3 == 0, None).when(F.col("p_partkey") % 7 == 0, "").otherwise(F.col("label"))
    return rows.select("p_partkey", "label", sc.display_label(patchy, F.col("line_text"), F.col("p_partkey")).alias("shown"))


@query("operator_clean", "SELECT event_id, regexp_replace(operator_id, '^85:', '') AS operator_clean FROM fx_actuals")
def operator_clean(t):
    return t.view("fx_actuals").select("event_id", sc.operator_number(F.col("operator_id")).alias("operator_clean"))


@query("calendar_fields", """
SELECT event_id, CAST(hour(arr_time) AS INTEGER) AS hour_of_day, CAST(dayofweek(operating_day) + 1 AS INTEGER) AS day_of_week,
       CAST(month(operating_day) AS INTEGER) AS month FROM fx_actuals""")
def calendar_fields(t):
    return t.view("fx_actuals").select("event_id", F.hour("arr_time").alias("hour_of_day"),
                                       F.dayofweek("operating_day").alias("day_of_week"),
                                       F.month("operating_day").alias("month"))


@query("dow_bucket", """
SELECT event_id, CASE dayofweek(operating_day) WHEN 0 THEN 'sunday' WHEN 6 THEN 'saturday' ELSE 'weekday' END AS by_number,
       CASE isodow(operating_day) WHEN 7 THEN 'sunday' WHEN 6 THEN 'saturday' ELSE 'weekday' END AS by_monday0,
       CASE dayname(operating_day) WHEN 'Sunday' THEN 'sunday' WHEN 'Saturday' THEN 'saturday' ELSE 'weekday' END AS by_name
FROM fx_actuals""")
def dow_bucket(t):
    day = F.col("operating_day")
    return t.view("fx_actuals").select(
        "event_id", sc.dow_bucket(F.dayofweek(day)).alias("by_number"),
        sc.dow_bucket_monday0(F.weekday(day)).alias("by_monday0"),
        sc.dow_bucket_of_name(F.date_format(day, "EEEE")).alias("by_name"))


@query("arrival_delay", """
SELECT event_id, CAST(epoch(arr_actual) - epoch(arr_time) AS BIGINT) AS arr_delay_sec,
       round(CAST(epoch(arr_actual) - epoch(arr_time) AS BIGINT) / 60e0, 6) + 0e0 AS arr_delay_mins FROM fx_actuals""")
def arrival_delay(t):
    seconds = sc.delay_seconds(F.col("arr_actual"), F.col("arr_time"))
    return t.view("fx_actuals").select("event_id", seconds.alias("arr_delay_sec"),
                                       sc.fixed(seconds / 60.0).alias("arr_delay_mins"))


@query("service_hour", """
SELECT trip_id, stop_sequence, CAST((arrival_time_sec // 3600) % 24 AS INTEGER) AS service_hour FROM fx_stop_times""")
def service_hour(t):
    return t.view("fx_stop_times").select("trip_id", "stop_sequence",
                                          sc.service_hour(F.col("arrival_time_sec")).alias("service_hour"))


@query("parse_hhmm", """
SELECT trip_id, stop_sequence, CAST(split_part(arrival_time, ':', 1) AS INTEGER) * 3600
       + CAST(split_part(arrival_time, ':', 2) AS INTEGER) * 60 AS deadline_sec FROM fx_stop_times""")
def parse_hhmm(t):
    return t.view("fx_stop_times").select(
        "trip_id", "stop_sequence", sc.parse_hhmm(F.substring("arrival_time", 1, 5)).alias("deadline_sec"))


@query("format_hhmm", "SELECT trip_id, stop_sequence, substr(arrival_time, 1, 5) AS hhmm FROM fx_stop_times")
def format_hhmm(t):
    return t.view("fx_stop_times").select("trip_id", "stop_sequence", sc.format_hhmm(F.col("arrival_time_sec")).alias("hhmm"))


_PAIRS = """SELECT o_orderkey AS pair_id, CAST(46.0 AS DOUBLE) + (o_orderkey % 1000) * CAST(0.001 AS DOUBLE) AS lat1,
  CAST(6.0 AS DOUBLE) + (o_custkey % 997) * CAST(0.001 AS DOUBLE) AS lon1,
  CAST(46.0 AS DOUBLE) + (o_custkey % 811) * CAST(0.001 AS DOUBLE) AS lat2,
  CAST(6.0 AS DOUBLE) + (o_orderkey % 701) * CAST(0.001 AS DOUBLE) AS lon2 FROM {orders}"""


@query("haversine_m", f"""
SELECT pair_id, round({shared.haversine_sql('lat1', 'lon1', 'lat2', 'lon2')}, 4) + 0e0 AS metres FROM ({_PAIRS}) p""")
def haversine_m(t):
    metres = sc.haversine_m(*[F.col(c) for c in ("lat1", "lon1", "lat2", "lon2")])
    return t.sql(_PAIRS).select("pair_id", sc.fixed(metres, 4).alias("metres"))


_METRES = "SELECT o_orderkey, o_totalprice / 1000 AS metres FROM {orders}"


@query("walk_seconds", f"""
SELECT o_orderkey, CAST(ceil(metres / 50e0 * 60e0) AS BIGINT) AS stored_sec,
       CAST(floor(metres / (50e0 / 60e0)) AS BIGINT) AS search_sec FROM ({_METRES}) m""")
def walk_seconds(t):
    return t.sql(_METRES).select("o_orderkey", sc.walk_seconds_stored(F.col("metres")).alias("stored_sec"),
                                 sc.walk_seconds_search(F.col("metres")).alias("search_sec"))


# ---- probability -------------------------------------------------------------------------------------------------


def _poly_sql(x: str, coefficients) -> str:
    value = repr(coefficients[0]) + ("" if "e" in repr(coefficients[0]) else "e0")
    for c in coefficients[1:]:
        text = repr(float(c))
        value = f"({value} * {x} + ({text if 'e' in text else text + 'e0'}))"
    return value


def norm_cdf_sql(z: str) -> str:
    x = f"abs({z})"
    tail = f"exp(-{x} * {x} / 2) * {_poly_sql(x, fv.CDF_TOP)} / {_poly_sql(x, fv.CDF_BOTTOM)}"
    return f"(CASE WHEN {z} > 0 THEN 1e0 - {tail} ELSE {tail} END)"


def norm_ppf_sql(p: str) -> str:
    def tail(mass):
        q = f"sqrt(-2e0 * ln({mass}))"
        return f"{_poly_sql(q, fv.PPF_C)} / {_poly_sql(q, fv.PPF_D + (1.0,))}"
    r = f"(({p} - 0.5e0) * ({p} - 0.5e0))"
    return (f"(CASE WHEN {p} < 0.02425e0 THEN {tail(p)} WHEN {p} > 1e0 - 0.02425e0 THEN -({tail('(1e0 - ' + p + ')')}) "
            f"ELSE {_poly_sql(r, fv.PPF_A)} * ({p} - 0.5e0) / {_poly_sql(r, fv.PPF_B + (1.0,))} END)")


def lognormal_cdf_sql(x: str, d: str = "") -> str:
    z = f"((ln(CASE WHEN {x} + 10e0 > 0 THEN {x} + 10e0 END) - {d}ln_mu) / nullif({d}ln_sigma, 0))"
    return (f"(CASE WHEN {x} + 10e0 <= 0 THEN 0e0 WHEN {d}ln_sigma <= 0 THEN CASE WHEN {x} >= {d}mean THEN 1e0 ELSE 0e0 END "
            f"ELSE {norm_cdf_sql(z)} END)")


def _interp_sql(x: str, xs: list[str], ys: list[str]) -> str:
    whens = " ".join(
        f"WHEN {x} < {xs[i + 1]} THEN {ys[i]} + ({ys[i + 1]} - {ys[i]}) * ({x} - {xs[i]}) / nullif({xs[i + 1]} - {xs[i]}, 0)"
        for i in range(len(xs) - 1))
    return f"CASE {whens} ELSE {ys[-1]} END"


_PROBS = [f"{q}e0" for q in fv.QUANTILES]


def delay_cdf_sql(x: str, d: str = "") -> str:
    qs = [d + c for c in fv.QUANTILE_COLS]
    return (f"(CASE WHEN {x} <= {qs[0]} OR {x} >= {qs[6]} THEN {lognormal_cdf_sql(x, d)} "
            f"ELSE {_interp_sql(x, qs, _PROBS)} END)")


def delay_quantile_sql(p: str, d: str = "") -> str:
    qs = [d + c for c in fv.QUANTILE_COLS]
    tail = (f"CASE WHEN {d}ln_sigma <= 0 THEN {d}mean ELSE exp({d}ln_mu + {d}ln_sigma * "
            f"{norm_ppf_sql(f'least(greatest({p}, 1e-12), 1e0 - 1e-12)')}) - 10e0 END")
    return f"(CASE WHEN {p} > 0.05e0 AND {p} < 0.95e0 THEN {_interp_sql(p, _PROBS, qs)} ELSE {tail} END)"


def clamped_cdf_sql(x: str, d: str = "") -> str:
    qs = [d + c for c in fv.QUANTILE_COLS]
    return f"(CASE WHEN {x} < {qs[0]} THEN 0.05e0 ELSE {_interp_sql(x, qs, _PROBS)} END)"


def p_connection_sql(slack: str, a: str, d: str, cdf=None) -> str:
    """Trapezoid over the departure quantiles, written out term by term."""
    cdf = cdf or delay_cdf_sql
    fa = [cdf(f"({d}{c} + {slack} / 60e0)", a) for c in fv.QUANTILE_COLS]
    # Name the eight values once: a list keeps the text short.
    ps = fv.QUANTILES
    steps = " + ".join(f"(v[{i + 1}] + v[{i + 2}]) / 2e0 * ({ps[i + 1]}e0 - {ps[i]}e0)" for i in range(len(ps) - 1))
    return (f"(SELECT least(greatest({steps} + v[1] * {ps[0]}e0 + v[8] * (1e0 - {ps[-1]}e0), 0e0), 1e0) "
            f"FROM (SELECT [{', '.join(fa)}] AS v))")


_Z = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_extendedprice % 1600) / 100 - 8 AS z FROM {lineitem}"


@query("norm_cdf", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round({norm_cdf_sql('z')}, 9) + 0e0 AS p FROM ({_Z}) q")
def norm_cdf(t):
    return t.sql(_Z).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sc.fixed(pr.norm_cdf(F.col("z")), 9).alias("p"))


_P = "SELECT o_orderkey, (o_totalprice % 1000 + CAST(0.005 AS DOUBLE)) / CAST(1000.01 AS DOUBLE) AS p FROM {orders}"


@query("norm_ppf", f"SELECT o_orderkey, round({norm_ppf_sql('p')}, 6) + 0e0 AS z FROM ({_P}) q")
def norm_ppf(t):
    return t.sql(_P).select("o_orderkey", sc.fixed(pr.norm_ppf(F.col("p"))).alias("z"))


# One row per level bucket and probe point: the probability functions on every trained distribution.
ORACLE_BLOCKS["ox_probes"] = """
SELECT l.*, x.x FROM ox_levels l CROSS JOIN (VALUES (-10.5e0), (-10e0), (-2e0), (0e0), (1.5e0), (4e0), (10e0), (59e0)) x(x)"""
ORACLE_BLOCKS["ox_prob_probes"] = """
SELECT l.*, x.p FROM ox_levels l CROSS JOIN (VALUES (0e0), (0.01e0), (0.05e0), (0.06e0), (0.5e0), (0.93e0), (0.95e0), (0.999e0), (1e0)) x(p)"""
_ID = ["level", *ds.KEYS]
_ID_SQL = ", ".join(_ID)


def _probes(t, column, values):
    return shared.prepared(t).delay_levels.withColumn(column, F.explode(F.array(*[F.lit(float(v)) for v in values])))


def _x_probes(t):
    return _probes(t, "x", (-10.5, -10, -2, 0, 1.5, 4, 10, 59))


def _p_probes(t):
    return _probes(t, "p", (0, 0.01, 0.05, 0.06, 0.5, 0.93, 0.95, 0.999, 1))


def _fit():
    d = pr.dist_columns()
    return d["mu"], d["sigma"], d["mean"]


@query("lognormal_cdf", f"SELECT {_ID_SQL}, x, round({lognormal_cdf_sql('x')}, 9) + 0e0 AS p FROM ox_probes")
def lognormal_cdf(t):
    return _x_probes(t).select(*_ID, "x", sc.fixed(pr.lognormal_cdf(F.col("x"), *_fit()), 9).alias("p"))


@query("lognormal_ppf", f"""
SELECT {_ID_SQL}, p, round(CASE WHEN ln_sigma <= 0 THEN mean ELSE exp(ln_mu + ln_sigma *
       {norm_ppf_sql('least(greatest(p, 1e-12), 1e0 - 1e-12)')}) - 10e0 END, 5) + 0e0 AS x FROM ox_prob_probes""")
def lognormal_ppf(t):
    return _p_probes(t).select(*_ID, "p", sc.fixed(pr.lognormal_ppf(F.col("p"), *_fit()), 5).alias("x"))


@query("delay_cdf", f"SELECT {_ID_SQL}, x, round({delay_cdf_sql('x')}, 9) + 0e0 AS p FROM ox_probes")
def delay_cdf(t):
    return pr.with_delay_cdf(_x_probes(t), {"p": F.col("x")}).select(*_ID, "x", sc.fixed(F.col("p"), 9).alias("p"))


@query("delay_quantile", f"SELECT {_ID_SQL}, p, round({delay_quantile_sql('p')}, 5) + 0e0 AS x FROM ox_prob_probes")
def delay_quantile(t):
    return _p_probes(t).select(*_ID, "p", sc.fixed(pr.delay_quantile(F.col("p"), **pr.dist_columns()), 5).alias("x"))


ORACLE_BLOCKS["ox_slacks"] = """
SELECT l.*, s.slack_sec FROM ox_levels l CROSS JOIN (VALUES (-600), (0), (45), (180), (600), (3600)) s(slack_sec)"""


def _slacks(t):
    return shared.prepared(t).delay_levels.withColumn("slack_sec", F.explode(F.array(*[F.lit(v) for v in (-600, 0, 45, 180, 600, 3600)])))


@query("p_connection", f"""
SELECT {_ID_SQL}, slack_sec, round({p_connection_sql('slack_sec', 's.', 's.')}, 9) + 0e0 AS p FROM ox_slacks s""")
def p_connection(t):
    rows = pr.with_p_connection(_slacks(t), "p", F.col("slack_sec"), "", "")
    return rows.select(*_ID, "slack_sec", sc.fixed(F.col("p"), 9).alias("p"))


def p_normal_sql(slack: str, avg: str, std: str) -> str:
    return (f"(CASE WHEN {avg} IS NULL THEN 1e0 WHEN {std} <= 0 THEN CASE WHEN {slack} >= {avg} THEN 1e0 ELSE 0e0 END "
            f"ELSE {norm_cdf_sql(f'(({slack} - {avg}) / nullif({std}, 0))')} END)")


ORACLE_BLOCKS["ox_features"] = """
SELECT bpuic, hour_of_day, count(*) AS n_observations, CAST(sum(arr_delay_sec) AS DOUBLE) / count(*) / 60e0 AS hist_avg_delay_mins,
       coalesce(stddev_samp(CAST(arr_delay_sec AS DOUBLE)), 0e0) / 60e0 AS hist_std_delay_mins,
       quantile_disc(arr_delay_sec, 0.5) / 60e0 AS hist_p50_delay_mins, quantile_disc(arr_delay_sec, 0.9) / 60e0 AS hist_p90_delay_mins
FROM ox_training GROUP BY bpuic, hour_of_day"""

# Calls of the timetable as transfer requests: slack grows with the sequence number.
ORACLE_BLOCKS["ox_calls"] = """
SELECT trip_id, stop_sequence, stop_id, CAST((arrival_time_sec // 3600) % 24 AS INTEGER) AS hour_of_day, line_text,
       CAST(60 * stop_sequence - 60 AS INTEGER) AS slack_sec, CASE WHEN trip_id % 4 = 0 THEN 0e0 ELSE 0.8e0 END AS q FROM ox_stop_times"""


def _calls(t):
    return shared.prepared(t).stop_times.select(
        "trip_id", "stop_sequence", "stop_id", sc.service_hour(F.col("arrival_time_sec")).alias("hour_of_day"), "line_text",
        (60 * F.col("stop_sequence") - 60).cast("int").alias("slack_sec"),
        F.when(F.col("trip_id") % 4 == 0, 0.0).otherwise(0.8).alias("q"))


@query("p_connection_normal", f"""
SELECT trip_id, stop_sequence, round({p_normal_sql('slack_sec', 'hist_avg_delay_mins * 60e0', 'hist_std_delay_mins * 60e0')}, 9)
       + 0e0 AS p
FROM ox_calls c LEFT JOIN ox_features f ON f.bpuic = c.stop_id AND f.hour_of_day = c.hour_of_day""")
def p_connection_normal(t):
    features = shared.prepared(t).delay_features.withColumnRenamed("bpuic", "stop_id")
    p = pr.p_connection_normal(F.col("slack_sec"), F.col("hist_avg_delay_mins") * 60.0, F.col("hist_std_delay_mins") * 60.0)
    return _calls(t).join(features, ["stop_id", "hour_of_day"], "left").select("trip_id", "stop_sequence", sc.fixed(p, 9).alias("p"))


def resolve_sql(source: str, alias: str = "r") -> str:
    """Rows of ``source`` (with the five keys) and the most specific level row as columns of ``h``, level by level."""
    joins, names = [], []
    for name in fv.LEVELS:
        on = " AND ".join(f"{name}_.{k} = {alias}.{k}" for k in ds.LEVEL_KEYS[name])
        joins.append(f"LEFT JOIN ox_levels {name}_ ON {name}_.level = '{name}'" + (f" AND {on}" if on else ""))
        names.append(f"{name}_")
    picked = ", ".join(f"coalesce({', '.join(n + '.' + c for n in names)}) AS {'source_level' if c == 'level' else c}"
                       for c in ("level", *ds.DIST_COLS))
    # A level's columns are all set or all NULL, so column-wise coalesce picks one row.
    return f"SELECT {alias}.*, {picked} FROM {source} {alias} {' '.join(joins)}"


ORACLE_BLOCKS["ox_policy_rows"] = """
SELECT trip_id, stop_sequence, slack_sec, q, stop_id AS bpuic, hour_of_day, 'weekday' AS dow_bucket, line_text,
       CAST(NULL AS VARCHAR) AS product_id_clean FROM ox_calls"""
ORACLE_BLOCKS["ox_policy"] = resolve_sql("ox_policy_rows")


@query("p_transfer_policy", f"""
SELECT trip_id, stop_sequence, source_level, round(CASE WHEN q = 0 THEN 1e0 ELSE coalesce({p_connection_sql('slack_sec', 'd.', 'd.')},
  {p_normal_sql('slack_sec', 'hist_avg_delay_mins * 60e0', 'hist_std_delay_mins * 60e0')}, 1e0) END, 9) + 0e0 AS p
FROM ox_policy d LEFT JOIN ox_features f ON f.bpuic = d.bpuic AND f.hour_of_day = d.hour_of_day""")
def p_transfer_policy(t):
    calls = _calls(t).select(
        "trip_id", "stop_sequence", "slack_sec", "q", F.col("stop_id").alias("bpuic"), "hour_of_day",
        F.lit("weekday").alias("dow_bucket"), "line_text", F.lit(None).cast("string").alias("product_id_clean"))
    resolved = ds.resolve_distributions(calls, shared.prepared(t).delay_levels)
    rows = ds.attach_distribution(calls, resolved, "d_", {k: k for k in ds.KEYS})
    features = shared.prepared(t).delay_features
    rows = rows.join(features, ["bpuic", "hour_of_day"], "left")
    rows = pr.with_p_connection(rows, "p_dist", F.col("slack_sec"), "d_", "d_")
    p = pr.p_transfer(
        F.col("q"), F.col("p_dist"),
        pr.p_connection_normal(F.col("slack_sec"), F.col("hist_avg_delay_mins") * 60.0, F.col("hist_std_delay_mins") * 60.0))
    return rows.select("trip_id", "stop_sequence", F.col("d_source_level").alias("source_level"), sc.fixed(p, 9).alias("p"))


@query("stop_name_search", """
SELECT stop_id, stop_name, lower(stop_name) = 'stop 00007' AS is_exact, CAST(length(stop_name) AS INTEGER) AS name_length
FROM ox_valid_stops WHERE instr(lower(stop_name), 'stop 00007') > 0 GROUP BY ALL
ORDER BY is_exact DESC, name_length, stop_name, stop_id LIMIT 10""")
def stop_name_search(t):
    return places.stop_name_search(places.valid_stops(t.view("fx_stops_raw")).dropDuplicates(["stop_id", "stop_name"]),
                                   "STOP 00007")


# ---- filters -----------------------------------------------------------------------------------------------------


@query("valid_stops", "SELECT stop_id, stop_name, round(stop_lat, 6) + 0e0 AS stop_lat, round(stop_lon, 6) + 0e0 AS stop_lon FROM ox_valid_stops")
def valid_stops(t):
    return places.valid_stops(t.view("fx_stops_raw")).select("stop_id", "stop_name", *rounded(["stop_lat", "stop_lon"]))


@query("reliable_actuals", "SELECT event_id, bpuic, arr_time, arr_actual, arr_status_clean FROM ox_reliable")
def reliable_actuals(t):
    return ac.reliable_actuals(t.view("fx_actuals")).select("event_id", "bpuic", F.col("arr_time").cast("timestamp_ntz").alias("arr_time"),
                                                          F.col("arr_actual").cast("timestamp_ntz").alias("arr_actual"), "arr_status_clean")


@query("trim_delays", "SELECT event_id, route_type, arr_delay_sec FROM ox_clean WHERE arr_delay_mins BETWEEN -10 AND 60")
def trim_delays(t):
    return ac.trim_delays(shared.clean(t)).select("event_id", "route_type", "arr_delay_sec")


@query("min_observations", f"SELECT {_ID_SQL}, n FROM ox_all_levels WHERE n >= 30")
def min_observations(t):
    return ds.trusted_levels(ds.delay_levels(shared.training(t))).select(*_ID, "n")


@query("active_on_day", """
SELECT trip_id, dep_stop_id, arr_stop_id, dep_time_sec, arr_time_sec FROM ox_connections WHERE tuesday""")
def active_on_day(t):
    return timetable.active_on_day(shared.rides(t), shared.DAY).select(
        "trip_id", "dep_stop_id", "arr_stop_id", "dep_time_sec", "arr_time_sec")

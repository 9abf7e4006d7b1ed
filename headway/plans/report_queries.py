"""Calibration, backtests, quality and agreement reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import cut_lineage
from ..functions import fixed_values as fv
from ..functions import probability as pr
from ..operators import distributions as ds
from ..operators import legs as lg
from ..operators import places, search
from ..validate import calibration as cal
from ..validate import quality as qu
from ..validate import tree_model
from . import shared
from .registry import ORACLE_BLOCKS as B
from .registry import query
from .route_queries import parts
from .scalar_queries import clamped_cdf_sql, delay_cdf_sql, p_connection_sql, resolve_sql
from .search_queries import requests, routes
from .shared import haversine_sql, rounded, rounded_sql

_KEY_LIST = ", ".join(ds.KEYS)

# ---- distribution calibration ------------------------------------------------------------------------------------

B["ox_holdout_counts"] = f"SELECT {_KEY_LIST}, arr_delay_sec, count(*) AS n_rows FROM ox_holdout GROUP BY ALL"
B["ox_holdout_resolved"] = resolve_sql("ox_holdout_counts")
B["ox_pits"] = f"""
SELECT *, round({delay_cdf_sql('(arr_delay_sec / 60e0)')}, 9) + 0e0 AS pit FROM ox_holdout_resolved WHERE source_level IS NOT NULL"""


def pits(t):
    return cal.pit_values(shared.holdout_part(t), shared.prepared(t).delay_levels)


@query("pit_values", f"SELECT {_KEY_LIST}, arr_delay_sec, n_rows, source_level, pit FROM ox_pits")
def pit_values(t):
    return pits(t).select(*ds.KEYS, "arr_delay_sec", "n_rows", F.col("d_source_level").alias("source_level"), *rounded(["pit"], 9))


@query("pit_histogram", """
SELECT CAST(least(floor(pit * 20), 19) AS INTEGER) AS bin, CAST(sum(n_rows) AS BIGINT) AS n FROM ox_pits GROUP BY 1""")
def pit_histogram(t):
    return cal.pit_histogram(pits(t))


B["ox_curve"] = """
SELECT pit AS value, n, rank, total, rank / total AS ecdf FROM (
  SELECT pit, n, sum(n) OVER (ORDER BY pit) AS rank, sum(n) OVER () AS total
  FROM (SELECT pit, sum(n_rows) AS n FROM ox_pits GROUP BY pit) v) c"""
_CURVE = f"""SELECT {rounded_sql(['value'], 9)}, CAST(n AS BIGINT) AS n, CAST(rank AS BIGINT) AS rank, CAST(total AS BIGINT) AS total,
  {rounded_sql(['ecdf'], 9)} FROM ox_curve"""


def curve(t):
    return cal.ecdf(pits(t), "pit", "n_rows")


@query("calibration_curve", _CURVE)
def calibration_curve(t):
    return curve(t).select(*rounded(["value"], 9), "n", "rank", "total", *rounded(["ecdf"], 9))


@query("ecdf_rank", """
SELECT value, CAST(n AS BIGINT) AS n, CAST(rank AS BIGINT) AS rank, CAST(total AS BIGINT) AS total, round(rank / total, 9) + 0e0 AS ecdf FROM (
  SELECT value, n, sum(n) OVER (ORDER BY value) AS rank, sum(n) OVER () AS total
  FROM (SELECT l_discount AS value, count(*) AS n FROM {lineitem} GROUP BY 1) v) c""")
def ecdf_rank(t):
    return cal.ecdf(t.sql("SELECT l_discount AS v, 1 AS w FROM {lineitem}"), "v", "w").select(
        "value", "n", "rank", "total", *rounded(["ecdf"], 9))


@query("ks_uniform", """
SELECT CAST(n AS BIGINT) AS n, round(ks, 9) + 0e0 AS ks, round(least(greatest((SELECT sum(CASE WHEN k % 2 = 1 THEN 2e0 ELSE -2e0 END * exp(-2e0 * k * k * ks * ks * n))
  FROM range(1, 101) r(k)), 0e0), 1e0), 9) + 0e0 AS p_value, ks < 0.05 AS passes
FROM (SELECT max(total) AS n, max(greatest(rank / total - value, value - (rank - n) / total)) AS ks FROM ox_curve) d""")
def ks_uniform(t):
    return cal.ks_uniform(curve(t)).select("n", *rounded(["ks", "p_value"], 9), "passes")


_LOSS = " UNION ALL ".join(f"SELECT {q}e0 AS quantile, arr_delay_sec / 60e0 - {c} AS gap, n_rows FROM ox_pits"
                           for q, c in zip(fv.QUANTILES, fv.QUANTILE_COLS))


@query("pinball_loss", f"""
SELECT quantile, round(sum(greatest(quantile * gap, (quantile - 1) * gap) * n_rows) / sum(n_rows), 6) + 0e0 AS loss
FROM ({_LOSS}) l GROUP BY GROUPING SETS ((quantile), ())""")
def pinball_loss(t):
    return cal.pinball_loss(pits(t)).select("quantile", *rounded(["loss"]))


_BRIER = " UNION ALL ".join(f"SELECT {m} AS minutes, {delay_cdf_sql(f'{m}e0')} AS p, arr_delay_sec, n_rows FROM ox_pits" for m in fv.BRIER_MINUTES)


@query("brier_score", f"""
SELECT CAST(minutes AS INTEGER) AS minutes, round(sum(pow(p - CASE WHEN arr_delay_sec <= minutes * 60 THEN 1e0 ELSE 0e0 END, 2) * n_rows) / sum(n_rows), 9)
       + 0e0 AS brier FROM ({_BRIER}) b GROUP BY minutes""")
def brier_score(t):
    return cal.brier_score(pits(t)).select("minutes", *rounded(["brier"], 9))


# ---- backtest ----------------------------------------------------------------------------------------------------


def replayed(t, panel="own"):
    out = lg.replayed_success(routes(t, panel), lg.transfers(parts(t, panel)), shared.holdout_part(t))
    return out.where(F.col("option") == 1)


B["ox_replayed"] = "SELECT * FROM ox_own_success WHERE option = 1"
_CO = ["claimed", "observed"]


@query("backtest_by_q", f"""
SELECT q, count(*) AS n, round(avg(conf), 9) + 0e0 AS claimed, round(avg(success), 9) + 0e0 AS observed, avg(success) >= q - 0.10e0 AS passes
FROM ox_replayed GROUP BY q""")
def backtest_by_q(t):
    return cal.backtest_by_q(replayed(t)).select("q", "n", *rounded(_CO, 9), "passes")


B["ox_bins"] = """
SELECT CAST(b.bin AS INTEGER) AS bin, count(r.q) AS n, CASE WHEN count(r.q) >= 3 THEN avg(conf) END AS claimed,
       CASE WHEN count(r.q) >= 3 THEN avg(success) END AS observed,
       CASE WHEN count(r.q) >= 3 THEN 1.96e0 * stddev_samp(success) / sqrt(count(r.q)) END AS half_width
FROM range(10) b(bin) LEFT JOIN ox_replayed r ON floor(r.conf * 10) = b.bin AND r.conf < 1 GROUP BY b.bin"""


@query("reliability_bins", f"SELECT bin, n, {rounded_sql([*_CO, 'half_width'], 6)} FROM ox_bins")
def reliability_bins(t):
    return cal.reliability_bins(replayed(t)).select("bin", "n", *rounded([*_CO, "half_width"], 6))


@query("calibration_bias", """
SELECT round(avg(observed - claimed), 9) + 0e0 AS bias, CASE WHEN avg(observed - claimed) < 0 THEN 'over-confident' ELSE 'under-confident' END AS direction
FROM ox_bins""")
def calibration_bias(t):
    return cal.calibration_bias(cal.reliability_bins(replayed(t))).select(*rounded(["bias"], 9), "direction")


@query("binomial_test_by_q", """
SELECT q, n, k, round(least(p, 1e0), 8) + 0e0 AS p_value, p < 0.05 AS significant FROM (
  SELECT q, n, k, (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(q) + (n - i) * ln(1 - q)))
                   FROM range(0, 100000) r(i) WHERE i BETWEEN k AND n) AS p
  FROM (SELECT q, count(*) AS n, count(CASE WHEN success >= q THEN 1 END) AS k FROM ox_replayed GROUP BY q) g) b""")
def binomial_test_by_q(t):
    return cal.binomial_test_by_q(replayed(t)).select("q", "n", "k", *rounded(["p_value"], 8), "significant")


_RD = ["success_robust", "success_plain", "share_plain_later"]


@query("robust_vs_deterministic", f"""
SELECT n, {rounded_sql(_RD, 9)} FROM (
  SELECT count(*) AS n, avg(a.success) AS success_robust, avg(b.success) AS success_plain,
         avg(CASE WHEN b.dep_sec >= a.dep_sec THEN 1e0 ELSE 0e0 END) AS share_plain_later
  FROM ox_ladder_success a JOIN ox_ladder_success b ON a.start_id = b.start_id AND a.end_id = b.end_id
  WHERE a.q = 0.8e0 AND b.q = 0 AND a.option = 1 AND b.option = 1) x""", slow=True)
def robust_vs_deterministic(t):
    return cal.robust_vs_deterministic(replayed(t, "ladder")).select("n", *rounded(_RD, 9))


@query("monotonicity_check", """
SELECT start_id, end_id, bool_and(coalesce(dep <= before, true)) AS is_monotone,
       max(CASE WHEN q = 0 THEN dep END) >= max(CASE WHEN q = 0.8e0 THEN dep END) AS plain_not_earlier,
       bool_and(CASE WHEN q = 1 THEN conf IS NULL OR conf >= 0.999e0 END) AS strict_ok
FROM (SELECT *, lag(dep) OVER (PARTITION BY start_id, end_id ORDER BY q) AS before FROM (
  SELECT r.start_id, r.end_id, r.q, coalesce(f.t, -1) AS dep, f.conf FROM ox_requests_ladder r
  LEFT JOIN ox_ladder_routes f ON f.query_id = r.query_id AND f.option = 1) a) b GROUP BY start_id, end_id""", slow=True)
def monotonicity_check(t):
    return cal.monotonicity_check(requests(t, "ladder"), routes(t, "ladder"))


# ---- coverage and plausibility -----------------------------------------------------------------------------------


def best(t):
    return qu.best_routes(requests(t, "own"), routes(t), lg.first_last_event(parts(t)))


B["ox_best"] = """
SELECT r.query_id, r.start_id, r.end_id, f.conf, CAST(f.n_transfers AS INTEGER) AS n_transfers, f.walk_m, e.dep_sec, (e.arr_sec - e.dep_sec) / 60e0 AS travel_min
FROM ox_requests_own r LEFT JOIN ox_own_routes f ON f.query_id = r.query_id AND f.option = 1
LEFT JOIN ox_own_times e ON e.query_id = r.query_id AND e.option = 1"""
_COVER = ["coverage", "mean_min", "median_min", "p05_min", "p95_min", "mean_walk_m"]


@query("coverage_summary", f"""
SELECT n, n_found, {rounded_sql(_COVER)} FROM (
  SELECT count(*) AS n, count(dep_sec) AS n_found, avg(CASE WHEN dep_sec IS NOT NULL THEN 1e0 ELSE 0e0 END) AS coverage, avg(travel_min) AS mean_min,
         quantile_cont(travel_min, 0.5) AS median_min, quantile_cont(travel_min, 0.05) AS p05_min, quantile_cont(travel_min, 0.95) AS p95_min,
         avg(walk_m) AS mean_walk_m FROM ox_best) c""")
def coverage_summary(t):
    return qu.coverage_summary(best(t)).select("n", "n_found", *rounded(_COVER))


@query("transfer_histogram", "SELECT n_transfers, count(*) AS n FROM ox_best WHERE dep_sec IS NOT NULL GROUP BY n_transfers")
def transfer_histogram(t):
    return qu.transfer_histogram(best(t))


B["ox_ratios"] = f"""
SELECT query_id, d AS distance_m, travel_min, travel_min / greatest(d / 333e0, 1e0) AS ratio
FROM (SELECT b.query_id, b.travel_min, {haversine_sql('a.stop_lat', 'a.stop_lon', 'z.stop_lat', 'z.stop_lon')} AS d
      FROM ox_best b JOIN ox_region_stops a ON a.stop_id = b.start_id JOIN ox_region_stops z ON z.stop_id = b.end_id WHERE b.dep_sec IS NOT NULL) x"""


@query("plausibility_ratio", f"""
SELECT query_id, round(distance_m, 4) + 0e0 AS distance_m, {rounded_sql(["travel_min", "ratio"])}, ratio <= 10 AS plausible FROM ox_ratios""")
def plausibility_ratio(t):
    return qu.plausibility(best(t), shared.prepared(t).stops).select(
        "query_id", *rounded(["distance_m"], 4), *rounded(["travel_min", "ratio"]), "plausible")


@query("plausibility_summary", f"""
SELECT n, {rounded_sql(["mean_ratio", "median_ratio"])}, n_outliers FROM (
  SELECT count(*) AS n, avg(ratio) AS mean_ratio, quantile_cont(ratio, 0.5) AS median_ratio, count(CASE WHEN ratio > 10 THEN 1 END) AS n_outliers
  FROM ox_ratios) s""")
def plausibility_summary(t):
    return qu.plausibility_summary(qu.plausibility(best(t), shared.prepared(t).stops)).select(
        "n", *rounded(["mean_ratio", "median_ratio"]), "n_outliers")


@query("travel_time_bounds", """
SELECT start_id, end_id, 0e0 AS lo_min, 10e0 + 20 * (start_id % 3) AS hi_min, round(travel_min, 6) + 0e0 AS travel_min,
       CASE WHEN travel_min IS NULL THEN 'no route' WHEN travel_min BETWEEN 0 AND 10e0 + 20 * (start_id % 3) THEN 'as expected' ELSE 'outside' END AS verdict
FROM ox_best""")
def travel_time_bounds(t):
    expected = requests(t, "own").select("start_id", "end_id", F.lit(0.0).alias("lo_min"), (F.lit(10.0) + 20 * (F.col("start_id") % 3)).alias("hi_min"))
    return qu.travel_time_bounds(best(t), expected).select("start_id", "end_id", "lo_min", "hi_min", *rounded(["travel_min"]), "verdict")


_RC = ["coverage", "mean_min", "mean_transfers"]


@query("region_comparison", f"""
SELECT uuid, n, {rounded_sql(_RC)} FROM (
  SELECT p.uuid, count(*) AS n, avg(CASE WHEN b.dep_sec IS NOT NULL THEN 1e0 ELSE 0e0 END) AS coverage, avg(travel_min) AS mean_min,
         avg(n_transfers) AS mean_transfers
  FROM ox_best b JOIN (SELECT DISTINCT stop_id, uuid FROM ox_region_pairs) p ON p.stop_id = b.start_id GROUP BY p.uuid) c""")
def region_comparison(t):
    pairs = places.stop_region_pairs(places.valid_stops(t.view("fx_stops_raw")), shared.region_edges(t))
    return qu.region_comparison(best(t), pairs).select("uuid", "n", *rounded(_RC))


@query("walk_constraint_check", """
SELECT CAST(count(CASE WHEN query_id % 1000 = 0 THEN 1 END) AS BIGINT) AS no_walk, CAST(count(CASE WHEN query_id % 1000 = 500 THEN 1 END) AS BIGINT) AS walk,
       CAST(count(CASE WHEN query_id % 1000 = 999 THEN 1 END) AS BIGINT) AS same_stop,
       count(CASE WHEN query_id % 1000 = 0 THEN 1 END) <= count(CASE WHEN query_id % 1000 = 500 THEN 1 END)
         AND count(CASE WHEN query_id % 1000 = 999 THEN 1 END) = 0 AS holds FROM ox_walks_routes""")
def walk_constraint_check(t):
    kind = F.col("query_id") % 1000
    found = routes(t, "walks").groupBy(F.when(kind == 0, "no walk").when(kind == 500, "walk").otherwise("same stop").alias("kind")).agg(
        F.count("*").alias("n_routes"))
    return qu.walk_constraint_check(found)


# ---- another planner ---------------------------------------------------------------------------------------------


def _clock_sql(c):
    return f"CAST(substr({c}, 12, 2) AS INTEGER) * 3600 + CAST(substr({c}, 15, 2) AS INTEGER) * 60 + CAST(substr({c}, 18, 2) AS INTEGER)"


B["ox_ext_sections"] = """
SELECT query_id, body, dur, unnest([j for j in secs if json_extract(j, '$.journey') IS NOT NULL]) AS sec,
       generate_subscripts([j for j in secs if json_extract(j, '$.journey') IS NOT NULL], 1) AS leg_no,
       len([j for j in secs if json_extract(j, '$.journey') IS NOT NULL]) AS n_rides
FROM (SELECT query_id, body, json_extract_string(body, '$.connections[0].duration') AS dur,
             json_extract(body, '$.connections[0].sections[*]') AS secs FROM fx_external_json) x"""
B["ox_ext_plain"] = f"""
SELECT query_id, CAST(leg_no AS INTEGER) AS leg_no, CAST(split_part(dur, 'd', 1) AS INTEGER) * 1440
         + CAST(split_part(split_part(dur, 'd', 2), ':', 1) AS INTEGER) * 60 + CAST(split_part(dur, ':', 2) AS INTEGER)
         + CAST(split_part(dur, ':', 3) AS INTEGER) / 60e0 AS travel_min, CAST(n_rides - 1 AS INTEGER) AS n_transfers,
       json_extract_string(sec, '$.journey.name') AS name, json_extract_string(sec, '$.departure.station.name') AS from_name,
       json_extract_string(sec, '$.arrival.station.name') AS to_name,
       {_clock_sql("json_extract_string(sec, '$.departure.departure')")} AS dep_sec,
       {_clock_sql("json_extract_string(sec, '$.arrival.arrival')")} AS arr_sec
FROM ox_ext_sections"""
B["ox_ext_names"] = """
SELECT name, coalesce((SELECT min(stop_id) FROM ox_region_stops s WHERE lower(s.stop_name) = lower(n.name)),
  (SELECT arg_min(stop_id, lpad(CAST(length(stop_name) AS VARCHAR), 9, '0') || lower(stop_name) || CAST(stop_id AS VARCHAR))
   FROM ox_region_stops s WHERE contains(lower(s.stop_name), lower(n.name)))) AS stop_id
FROM (SELECT DISTINCT from_name AS name FROM ox_ext_plain UNION SELECT to_name FROM ox_ext_plain) n"""
B["ox_ext_legs"] = """
SELECT e.*, a.stop_id AS from_id, z.stop_id AS to_id FROM ox_ext_plain e LEFT JOIN ox_ext_names a ON a.name = e.from_name
LEFT JOIN ox_ext_names z ON z.name = e.to_name"""


def external(t):
    return qu.external_legs(t.view("fx_external_json"), shared.prepared(t).stops)


@query("external_journeys_to_legs", """
SELECT query_id, leg_no, travel_min, n_transfers, name, from_name, to_name, dep_sec, arr_sec, from_id, to_id FROM ox_ext_legs""")
def external_journeys_to_legs(t):
    return external(t)


# All answers of the other planner for the pairs of the panel, which are the answers' own; rows go by the answer's id.
B["ox_other_pick"] = """
SELECT r.query_id, e.query_id AS answer_id FROM ox_requests_external r JOIN fx_external_json e ON e.orig_id = r.start_id AND e.dest_id = r.end_id"""
B["ox_external_best"] = """
SELECT f.query_id, CAST(f.n_transfers AS INTEGER) AS n_transfers, (e.arr_sec - e.dep_sec) / 60e0 AS travel_min
FROM ox_external_routes f JOIN ox_external_times e ON e.query_id = f.query_id AND e.option = 1 WHERE f.option = 1"""
B["ox_agree"] = """
SELECT p.answer_id, b.query_id AS own_id, b.travel_min AS our_min, b.n_transfers AS our_transfers, e.travel_min AS other_min,
       e.n_transfers AS other_transfers, b.travel_min - e.travel_min AS diff_min
FROM ox_external_best b JOIN ox_other_pick p USING (query_id) JOIN ox_ext_legs e ON e.query_id = p.answer_id AND e.leg_no = 1
WHERE b.travel_min - e.travel_min IS NOT NULL"""


def _picked(t):
    """(query_id, answer_id) of all answers for the panel's pairs."""
    answers = t.view("fx_external_json").select(F.col("query_id").alias("answer_id"), F.col("orig_id").alias("start_id"), F.col("dest_id").alias("end_id"))
    return requests(t, "external").select("query_id", "start_id", "end_id").join(answers, ["start_id", "end_id"]).select("query_id", "answer_id")


def _by_answer(t, rows):
    """Rows of our requests once for each answer, under the answer's id."""
    return rows.join(_picked(t), "query_id").drop("query_id").withColumnRenamed("answer_id", "query_id")


def _other(t):
    """Legs of the other planner's answers for the panel's pairs."""
    chosen = t.view("fx_external_json").select("query_id", "body").join(_picked(t).select(F.col("answer_id").alias("query_id")), "query_id", "left_semi")
    return qu.external_legs(chosen, shared.prepared(t).stops)


def _agreement(t, legs):
    own = qu.best_routes(requests(t, "external"), routes(t, "external"), lg.first_last_event(parts(t, "external")))
    return qu.agreement_rows(_by_answer(t, own.select("query_id", "travel_min", "n_transfers")), legs.where(F.col("leg_no") == 1))


_SHARES = ["exact", "within_5", "within_10", "mean_abs_diff", "mean_diff", "transfers_match"]


@query("itinerary_agreement", f"""
SELECT n, n_mismatches, {rounded_sql(_SHARES)} FROM (
  SELECT count(*) AS n, count(CASE WHEN abs(diff_min) > 5 THEN 1 END) AS n_mismatches, avg(CASE WHEN diff_min = 0 THEN 1e0 ELSE 0e0 END) AS exact,
         avg(CASE WHEN abs(diff_min) <= 5 THEN 1e0 ELSE 0e0 END) AS within_5, avg(CASE WHEN abs(diff_min) <= 10 THEN 1e0 ELSE 0e0 END) AS within_10,
         avg(abs(diff_min)) AS mean_abs_diff, avg(diff_min) AS mean_diff,
         avg(CASE WHEN our_transfers = other_transfers THEN 1e0 ELSE 0e0 END) AS transfers_match FROM ox_agree) a""")
def itinerary_agreement(t):
    return qu.itinerary_agreement(_agreement(t, _other(t))).select("n", "n_mismatches", *rounded(_SHARES))


B["ox_other_changes"] = """
SELECT * FROM (SELECT a.answer_id AS query_id, e.leg_no, lag(e.to_id) OVER w AS alight_stop, lag(e.arr_sec) OVER w AS alight_sec, lag(e.name) OVER w AS before,
                      e.name, e.dep_sec FROM ox_agree a JOIN ox_ext_legs e ON e.query_id = a.answer_id WHERE abs(a.diff_min) > 5
               WINDOW w AS (PARTITION BY a.answer_id ORDER BY e.leg_no)) c WHERE before IS NOT NULL AND before <> name"""
# The share of delays that a change bears, once for each stop, hour and slack.
B["ox_other_success"] = """
SELECT c.query_id, product(s.share) AS success
FROM ox_other_changes c JOIN (
  SELECT k.alight_stop, k.hour, k.slack, coalesce(avg(CASE WHEN h.arr_delay_sec IS NULL THEN NULL WHEN k.slack >= h.arr_delay_sec THEN 1e0 ELSE 0e0 END),
         CASE WHEN k.slack >= 0 THEN 1e0 ELSE 0e0 END) AS share
  FROM (SELECT DISTINCT alight_stop, (alight_sec // 3600) % 24 AS hour, dep_sec - alight_sec AS slack FROM ox_other_changes) k
  LEFT JOIN ox_holdout h ON h.bpuic = k.alight_stop AND h.hour_of_day = k.hour GROUP BY k.alight_stop, k.hour, k.slack) s
  ON s.alight_stop IS NOT DISTINCT FROM c.alight_stop AND s.hour = (c.alight_sec // 3600) % 24 AND s.slack = c.dep_sec - c.alight_sec
GROUP BY c.query_id"""
B["ox_duel"] = """
SELECT a.answer_id, s.success AS our_success, coalesce(o.success, 1e0) AS other_success
FROM ox_agree a JOIN ox_external_success s ON s.query_id = a.own_id AND s.option = 1
LEFT JOIN ox_other_success o ON o.query_id = a.answer_id WHERE abs(a.diff_min) > 5"""
_WINNER = """CASE WHEN round(our_success - other_success, 9) > 0.02e0 THEN 'ours'
  WHEN round(our_success - other_success, 9) < -0.02e0 THEN 'other' ELSE 'tie' END"""


def duels(t):
    legs = cut_lineage(_other(t))
    differ = cut_lineage(_agreement(t, legs).where(F.abs("diff_min") > 5).select("query_id"))
    legs = legs.join(differ, "query_id", "left_semi")
    theirs = legs.select("query_id", F.lit(1).alias("option")).distinct()
    other = lg.replayed_success(theirs, qu.external_changes(legs), shared.holdout_part(t))
    own = _by_answer(t, replayed(t, "external").select("query_id", "success"))
    return qu.reliability_duel(own.join(differ, "query_id", "left_semi"), other)


@query("reliability_duel", f"""
SELECT answer_id AS query_id, {rounded_sql(['our_success', 'other_success'], 9)}, {_WINNER} AS winner FROM ox_duel""")
def reliability_duel(t):
    return duels(t).select("query_id", *rounded(["our_success", "other_success"], 9), "winner")


@query("reliability_duel_summary", f"""
SELECT winner, count(*) AS n, round(avg(our_success), 9) + 0e0 AS our_success, round(avg(other_success), 9) + 0e0 AS other_success
FROM (SELECT *, {_WINNER} AS winner FROM ox_duel) d GROUP BY winner""")
def reliability_duel_summary(t):
    return qu.duel_summary(duels(t)).select("winner", "n", *rounded(["our_success", "other_success"], 9))


# ---- tree model --------------------------------------------------------------------------------------------------


@query("tree_quantile_model")
def tree_quantile_model(t):
    tree = tree_model.fit(cut_lineage(shared.train_part(t)))
    return tree.leaves.select("leaf", "n", *rounded(["mean", "std", *fv.QUANTILE_COLS]))


@query("p_connection_grid", f"""
SELECT level, {_KEY_LIST}, slack_sec, round({p_connection_sql('slack_sec', 's.', 's.', clamped_cdf_sql)}, 9) + 0e0 AS p FROM ox_slacks s""")
def p_connection_grid(t):
    rows = shared.prepared(t).delay_levels.withColumn("slack_sec", F.explode(F.array(*[F.lit(v) for v in (-600, 0, 45, 180, 600, 3600)])))
    return pr.with_p_connection_clamped(rows, "p", F.col("slack_sec"), "", "").select("level", *ds.KEYS, "slack_sec", *rounded(["p"], 9))


@query("model_comparison")
def model_comparison(t):
    p = shared.prepared(t)
    tree = tree_model.fit(cut_lineage(shared.train_part(t)))
    second = cut_lineage(search.ranked_routes(
        search.as_requests(requests(t, "own").drop("max_routes"), max_routes=1), p.stop_times, p.walking_edges, None,
        final_leg="clamped", resolve=lambda asked: tree_model.resolve(asked, tree)))
    changes = lg.transfers(lg.collapse_legs(lg.route_legs(second)))
    replay = lg.replayed_success(second, changes, shared.holdout_part(t))
    return cal.model_comparison(replayed(t), replay, ("lookup", "tree")).select(
        "model", "q", "n", *rounded(["claimed", "observed", "bias"], 9), "winner")

import random
import struct

import pytest
from pyspark.sql import functions as F

from headway.config import NetworkConfig
from headway.functions import fixed_values as fv
from headway.operators import distributions as ds
from headway.operators import places, search, timetable
from headway.operators.skyline import undominated
from headway.sources import artifacts, geometry
from headway.validate import quality

DAYS = ", ".join(f"{d} boolean" for d in fv.DAYS)
CALLS = f"trip_id string, route_id string, line_text string, route_label string, stop_id bigint, stop_sequence int, arrival_time_sec int, departure_time_sec int, {DAYS}"


def calls(spark, rows):
    return spark.createDataFrame([(t, "r", line, label, stop, seq, arr, arr + 30, *[True] * 7) for t, line, label, stop, seq, arr in rows], CALLS)


def test_connections_need_consecutive_numbers_and_long_trips_are_whole(spark):
    rows = [("gap", "1", "bus 1", 1, 1, 100), ("gap", "1", "bus 1", 2, 3, 200), ("gap", "1", "bus 1", 3, 4, 300)]
    rows += [("long", "2", "bus 2", i, i, 1000 + 60 * i) for i in range(1, 1101)]
    got = timetable.connections(calls(spark, rows)).groupBy("trip_id").count().collect()
    assert {r["trip_id"]: r["count"] for r in got} == {"gap": 1, "long": 1099}


def ring(points):
    return struct.pack("<I", len(points)) + b"".join(struct.pack("<dd", *p) for p in points)


def test_multipolygon_with_hole(spark):
    def box(x, y, w):
        return [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
    first = struct.pack("<BII", 1, 3, 2) + ring(box(0, 0, 10)) + ring(box(4, 4, 2))
    second = struct.pack("<BII", 1, 3, 1) + ring(box(20, 0, 5))
    wkb = struct.pack("<BII", 1, 6, 2) + first + second
    edges = geometry.ring_edges(spark.createDataFrame([("u", bytearray(wkb))], "uuid string, wkb_geometry binary"))
    points = [(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 22.0, 2.0), (4, 15.0, 2.0), (5, 0.0, 5.0), (6, 10.0, 5.0), (7, 5.0, 10.0)]
    stops = spark.createDataFrame([(i, f"s{i}", y, x) for i, x, y in points], "stop_id bigint, stop_name string, stop_lat double, stop_lon double")
    # Inside, in the hole, in the second part, outside; then three points on the border, which do not count.
    assert {r["stop_id"] for r in places.stop_region_pairs(stops, edges).collect()} == {1, 3}


def test_walking_edges_against_all_pairs(spark):
    rng = random.Random(5)
    rows = [(i, f"s{i}", 46.5 + rng.random() * 0.03, 6.6 + rng.random() * 0.03) for i in range(120)]
    rows += [(900, "a", 10.0, 179.999), (901, "b", 10.0, -179.999), (902, "c", 89.9999, 0.0), (903, "d", 89.9999, 180.0)]
    stops = spark.createDataFrame(rows, "stop_id bigint, stop_name string, stop_lat double, stop_lon double")
    got = {(r["a_stop_id"], r["b_stop_id"]) for r in places.walking_edges(stops).collect()}
    import math

    def metres(a, b):
        p, q = math.radians(a[2]), math.radians(b[2])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
        return 2 * fv.EARTH_RADIUS_M * math.asin(math.sqrt(h))
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] != b[0] and metres(a, b) <= 500}
    assert got == want and (900, 901) in got and (902, 903) in got


def test_name_match_prefers_exact_then_shortest(spark):
    stops = spark.createDataFrame([(1, "Main"), (2, "Main Street"), (3, "Old Main Street"), (4, "X")], "stop_id bigint, stop_name string")
    names = spark.createDataFrame([("MAIN",), ("street",), ("ai",), ("nowhere",)], "name string")
    assert {r["name"]: r["stop_id"] for r in places.match_names(names, stops).collect()} == {"MAIN": 1, "street": 2, "ai": 1}


def test_skyline_against_all_pairs(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(3), 1, rng.randrange(30), rng.randrange(6) / 5, 1 + rng.randrange(3), float(rng.randrange(6)), str(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "query_id int, stop_id int, t bigint, conf double, boardings int, walk_m double, trail string")
    got = {r["trail"] for r in undominated(df, max_boardings=3).collect()}

    def beats(x, r):
        if x[:2] != r[:2] or not (x[2] >= r[2] and x[3] >= r[3] and x[4] <= r[4] and x[5] <= r[5]):
            return False
        return x[2:6] != r[2:6] or x[6] < r[6]
    assert got == {r[6] for r in rows if not any(beats(x, r) for x in rows)}


def test_lookup_order_and_missing_global(spark):
    rows = [("2024-01-01", f"t{i}", "11", "11", 1, "L1", "B", "Bus", 8, 2, 1, 60 * (i % 3), float(i % 3)) for i in range(6)]
    rows += [("2024-01-01", "t", "11", "11", 2, None, "T", "Tram", 9, 1, 1, 120, 2.0) for _ in range(6)]
    schema = ("operating_day string, trip_id string, operator_id string, operator_id_clean string, bpuic bigint, line_text string, transport_clean string, "
              "product_id_clean string, hour_of_day int, day_of_week int, month int, arr_delay_sec bigint, arr_delay_mins double")
    levels = ds.trusted_levels(ds.delay_levels(spark.createDataFrame(rows, schema)), 5)
    asked = spark.createDataFrame([(1, 8, "weekday", None, None), (1, 9, "weekday", "L1", None), (7, 8, "weekday", "L1", "Tram"),
                                   (7, 3, "sunday", "L1", None), (7, 9, "sunday", "L9", "Tram"), (7, 1, "sunday", None, "Tram"),
                                   (7, 1, "sunday", None, None)],
                                  "bpuic bigint, hour_of_day int, dow_bucket string, line_text string, product_id_clean string")
    got = {tuple(r)[:5]: r["source_level"] for r in ds.resolve_distributions(asked, levels).collect()}
    assert list(got[tuple(r)] for r in asked.collect()) == ["bpuic_hour_dow", "bpuic", "line_hour_dow", "line", "prod_hour_dow", "prod", "global"]
    none = ds.resolve_distributions(asked, levels.where("level like 'bpuic%'")).where("source_level is null").count()
    assert none == 5


def test_search_agrees_with_latest_departures(spark):
    rng = random.Random(11)
    rows = []
    for trip in range(60):
        start, stops = rng.randrange(20000, 30000), rng.sample(range(1, 13), 4)
        rows += [(f"t{trip}", f"{trip % 5}", f"bus {trip % 5}", s, i + 1, start + 400 * i) for i, s in enumerate(stops)]
    table = calls(spark, rows)
    edges = spark.createDataFrame([(1, 2, 120.0), (2, 1, 120.0), (5, 6, 300.0), (6, 5, 300.0)], "a_stop_id bigint, b_stop_id bigint, distance_m double")
    pairs = spark.createDataFrame([(i, a, b, "monday", 0.0) for i, (a, b) in enumerate([(1, 9), (3, 12), (6, 2), (10, 4), (7, 8), (5, 5)])],
                                  "query_id bigint, start_id bigint, end_id bigint, day string, q double")
    requests = search.as_requests(pairs, max_routes=2)
    latest = search.latest_departures(requests, table, edges, 3)
    best = {r["query_id"]: r["t"] for r in latest.join(requests, "query_id").where("stop_id = start_id and start_id <> end_id").groupBy(
        "query_id").agg(F.max("t").alias("t")).collect()}
    routes = search.ranked_routes(requests, table, edges, None, max_boardings=3, walk_limit="edge")
    found = {r["query_id"]: r["dep_sec"] for r in routes.where("option = 1").collect()}
    assert found == best and len(best) >= 3


def test_artifact_path_depends_on_settings(spark, tmp_path):
    a = NetworkConfig(region_uuids=("a",), artifact_root=str(tmp_path))
    b = NetworkConfig(region_uuids=("b",), artifact_root=str(tmp_path))
    assert a.artifact_path() != b.artifact_path()
    try:
        artifacts.read_prepared(spark, a)
    except RuntimeError as error:
        assert "run the preparation first" in str(error)
    else:
        raise AssertionError("missing artifacts were not reported")


def small_network(spark):
    stops = spark.createDataFrame([(1, "a", 46.5, 6.6), (2, "b", 46.501, 6.6)], "stop_id bigint, stop_name string, stop_lat double, stop_lon double")
    return artifacts.PreparedNetwork(stops, places.walking_edges(stops), stops, stops)


def test_artifacts_of_other_settings_or_half_written_are_not_used(spark, tmp_path):
    cfg = NetworkConfig(region_uuids=("a",), artifact_root=str(tmp_path), split_day="2024-01-01")
    assert cfg.artifact_path() != NetworkConfig(region_uuids=("a",), artifact_root=str(tmp_path), split_day="2024-02-01").artifact_path()
    assert cfg.artifact_path() != NetworkConfig(region_uuids=("a",), artifact_root=str(tmp_path), split_day="2024-01-01", min_observations=3).artifact_path()
    built = []

    def build():
        built.append(1)
        artifacts.write_prepared(small_network(spark), cfg)

    artifacts.prepare_or_load(spark, cfg, build)
    artifacts.prepare_or_load(spark, cfg, build)
    assert len(built) == 1
    artifacts.mark(spark, cfg, ())  # as a preparation leaves it that stopped on its way
    assert artifacts.prepare_or_load(spark, cfg, build).stops.count() == 2 and len(built) == 2


def test_no_walking_gives_no_edges(spark):
    assert places.walking_edges(small_network(spark).stops, 0.0).count() == 0
    assert places.walking_edges(small_network(spark).stops, 500.0).count() == 2


def test_capped_sample_keeps_whole_slots(spark):
    from headway.sources import snapshots

    rows = spark.range(2000).select(F.col("id").alias("k"))
    assert snapshots.capped_sample(rows, ("k",), 1.0, 5000).count() == 2000
    some = snapshots.capped_sample(rows, ("k",), 1.0, 300)
    assert 250 <= some.count() <= 300 and some.exceptAll(snapshots.capped_sample(rows.repartition(5), ("k",), 1.0, 300)).count() == 0


def test_confidence_falls_back_to_the_normal_model(spark):
    from headway.operators import legs as lg

    rows = [("2024-01-01", f"t{i}", "11", "11", 1, "L1", "B", "Bus", 8, 2, 1, 60 * (i % 3), float(i % 3)) for i in range(6)]
    schema = ("operating_day string, trip_id string, operator_id string, operator_id_clean string, bpuic bigint, line_text string, transport_clean string, "
              "product_id_clean string, hour_of_day int, day_of_week int, month int, arr_delay_sec bigint, arr_delay_mins double")
    levels = ds.trusted_levels(ds.delay_levels(spark.createDataFrame(rows, schema)), 5).where("level like 'bpuic%'")
    parts = spark.createDataFrame([(q, 1, "a", 1, 7, 1, 0.5, "ride", "t", "bus 1", "1", 5, stop, 28000, 28800, 0.0) for q, stop in ((1, 7), (2, 8))],
                                  "query_id bigint, option int, x string, start_id bigint, end_id bigint, part bigint, q double, kind string, trip_id string, "
                                  "label string, line_text string, from_stop bigint, to_stop bigint, dep_sec bigint, arr_sec bigint, walk_m double")
    requests = spark.createDataFrame([(1, "monday", 28920), (2, "monday", 28920)], "query_id bigint, day string, deadline_sec bigint")
    features = spark.createDataFrame([(7, 8, 1.0, 1.0)], "bpuic bigint, hour_of_day int, hist_avg_delay_mins double, hist_std_delay_mins double")
    p = {r["query_id"]: r["p"] for r in lg.confidence_breakdown(parts, requests, levels, features).collect()}
    assert abs(p[1] - 0.8413447) < 1e-4 and p[2] == 1.0


def test_exact_percentile(spark):
    rng = random.Random(8)
    values = [rng.lognormvariate(0, 3) for _ in range(500)] + [0.0] * 7 + [-1.7e308, 1.7e308, 5e-324, 1.0, 1.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(4)
    ordered = sorted(values)
    for share in (0.0, 0.05, 0.5, 0.77, 1.0):
        at = share * (len(ordered) - 1)
        k, part = int(at), at - int(at)
        want = ordered[k] if not part else (1 - part) * ordered[k] + part * ordered[k + 1]
        assert quality.exact_percentile(df, "v", share, bins=16) == want
    assert quality.exact_percentile(df.where("v is null"), "v", 0.5) is None
    million = spark.range(1_000_000).select(((F.col("id") * 7919) % 1_000_003 / 3.0).alias("v"))
    assert quality.exact_percentile(million, "v", 0.5) == million.agg(F.percentile("v", F.lit(0.5))).first()[0]
    with pytest.raises(ValueError, match="finite"):
        quality.exact_percentile(spark.sql("SELECT double('NaN') AS v"), "v", 0.5)


def test_tables_on_demand_bring_only_what_they_are_made_of(spark, tmp_path):
    import struct

    from headway.operators.prepare import NetworkOnDemand, RawTables

    stops = spark.createDataFrame([("8500001:0:1", "a", 0.5, 0.5, 0), ("8500002:0:1", "b", 0.501, 0.5, 0), ("8500003:0:1", "far", 9.0, 9.0, 0)],
                                  "stop_id string, stop_name string, stop_lat double, stop_lon double, location_type int")
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    wkb = struct.pack("<BIII", 1, 3, 1, len(ring)) + b"".join(struct.pack("<dd", *point) for point in ring)
    shapes = spark.createDataFrame([("a", bytearray(wkb))], "uuid string, wkb_geometry binary")
    cfg = NetworkConfig(region_uuids=("a",), artifact_root=str(tmp_path))
    reads = []

    def raw():
        reads.append(1)
        return RawTables(stops, None, None, None, None, shapes)

    network = NetworkOnDemand(spark, cfg, raw)
    assert network.stops.count() == 2 and artifacts.complete_tables(spark, cfg) == {"stops"}
    assert network.stops.count() == 2 and len(reads) == 1  # read from disk
    assert network.walking_edges.count() == 2 and artifacts.complete_tables(spark, cfg) == {"stops", "walking_edges"}
    assert network.delay_levels is None  # no recorded arrivals
    with pytest.raises(AttributeError):
        network.no_such_table
    with pytest.raises(RuntimeError, match="run the preparation first"):  # not all of them
        artifacts.read_prepared(spark, cfg)


def test_shuffles_are_split_by_size_whatever_the_number_of_partitions(spark):
    from headway.config import tune_session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        rows = tune_session(spark).range(3_000_000).groupBy(F.xxhash64("id").alias("h")).agg(F.sum("id").alias("s"))
        assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

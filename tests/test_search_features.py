"""Service days, searches by date, all alternatives and the audit of watched stops, against brute force on built networks."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from headway.functions import fixed_values as fv
from headway.operators import legs, search, service_days, timetable

CALENDAR = "service_id string, " + ", ".join(f"{d} boolean" for d in fv.DAYS) + ", start_date date, end_date date"
EXCEPTIONS = "service_id string, date date, exception_type int"


def plain_days(calendar, exceptions):
    found = {}
    for service, *flags, first, last in calendar:
        if service and first and last:
            for k in range((last - first).days + 1):
                day = first + dt.timedelta(k)
                if flags[day.weekday()]:
                    found.setdefault(service, set()).add(day)
    for kind in (2, 1):
        for service, day, what in exceptions:
            if service and day and what == kind:
                (found.setdefault(service, set()).add if kind == 1 else found.setdefault(service, set()).discard)(day)
    return {s: sorted(d) for s, d in found.items() if d}


def test_service_days_against_dates(spark):
    rng, base = random.Random(4), dt.date(1969, 11, 20)
    calendar = [(f"s{k % 25}", *(rng.random() < 0.4 for _ in range(7)), a := base + dt.timedelta(rng.randint(0, 300)), a + dt.timedelta(rng.choice([-3, 0, 1, 63, 64, 65, 400])))
                for k in range(40)]
    calendar += [("never", *[False] * 7, base, base + dt.timedelta(30)), ("nulls", *[None] * 7, base, base), ("open", *[True] * 7, base, None),
                 (None, *[True] * 7, base, base), ("off", *[True] * 7, base, base)]
    exceptions = [(f"s{rng.randint(0, 28)}", base + dt.timedelta(rng.randint(-100, 700)), rng.choice([1, 2])) for _ in range(300)]
    exceptions += [("both", base, 1), ("both", base, 2), ("off", base, 2), ("s1", None, 1), (None, base, 1), ("s2", base, None), ("far", dt.date(2030, 1, 1), 1)]
    made = service_days.service_days(spark.createDataFrame(calendar, CALENDAR), spark.createDataFrame(exceptions, EXCEPTIONS))
    got = {r.service_id: r.dates for r in made.select("service_id", service_days.dates_of("service_bits").alias("dates")).collect()}
    assert got == plain_days(calendar, exceptions)
    asked = spark.range(-200, 1200).select(F.date_add(F.lit(base), F.col("id").cast("int")).alias("date"))
    hits = made.crossJoin(asked).where(service_days.runs_on("service_bits", service_days.day_number(F.col("date"))))
    assert Counter(r.service_id for r in hits.collect() if r.date < dt.date(1973, 1, 1)) == Counter({s: len(d) for s, d in got.items() if s != "far"})
    empty = service_days.service_days(spark.createDataFrame([], CALENDAR), spark.createDataFrame([], EXCEPTIONS))
    assert empty.count() == 0


def test_totals_of_service_days_by_word(spark):
    rng, base = random.Random(8), dt.date(1969, 12, 1)
    days = {f"s{k}": sorted(rng.sample(range(-200, 700), rng.choice([1, 2, 60, 500]))) for k in range(30)}
    days |= {"ends": [0, 63, 64, 127], "word": list(range(64)), "one": [63]}
    exceptions = [(s, base + dt.timedelta(d), 1) for s, some in days.items() for d in some]
    made = service_days.service_days(spark.createDataFrame([], CALENDAR), spark.createDataFrame(exceptions, EXCEPTIONS))
    got = made.select("service_id", *[c.alias(n) for n, c in service_days.date_totals("service_bits").items()]).collect()
    zero = (base - dt.date(1970, 1, 1)).days
    assert {tuple(r) for r in got} == {(s, len(d), base + dt.timedelta(d[0]), base + dt.timedelta(d[-1]), sum(d) + zero * len(d)) for s, d in days.items()}


def network(spark, trips, services=None):
    """Calls of ``trips``: (trip, line, [(stop, arrival, departure)]), daily unless ``services`` names one for each."""
    rows = [(trip, "R", line, line, (services or {}).get(trip, "S"), stop, seq, arr, dep, *[True] * 7)
            for trip, line, calls in trips for seq, (stop, arr, dep) in enumerate(calls, 1)]
    return spark.createDataFrame(rows, "trip_id string, route_id string, line_text string, route_label string, service_id string, stop_id long, "
                                 "stop_sequence int, arrival_time_sec int, departure_time_sec int, " + ", ".join(f"{d} boolean" for d in fv.DAYS))


def some_trips(rng, n, stops, lines):
    trips = []
    for k in range(n):
        path, t, calls = rng.sample(range(1, stops + 1), rng.randint(2, min(4, stops))), rng.randint(0, 3000), []
        for stop in path:
            calls.append((stop, t, t + 20))
            t += rng.randint(100, 500)
        trips.append((f"t{k}", f"L{rng.randint(0, lines - 1)}", calls))
    return trips


NO_WALKS = "a_stop_id long, b_stop_id long, distance_m double, walk_time_sec long"


def asked(spark, rows, **more):
    return search.as_requests(spark.createDataFrame(rows, "query_id long, start_id long, end_id long, day string, q double"), deadline="01:10", **more)


def plain_routes(trips, walks, start, end, deadline, change, limit):
    """Best departure of every sequence of lines, by following every chain of rides and walks back from the destination."""
    best, seen = {}, {}

    def back(stop, t, lines, n, walked, rode, trail):
        key = (stop, lines, rode)
        # Later, with fewer boardings and less walking is as good for every way that begins the same.
        if any(a >= t and b <= n and c <= walked for a, b, c in seen.setdefault(key, [])):
            return
        seen[key].append((t, n, walked))
        if stop == start:
            rank = (-t, max(n - 1, 0), walked)
            if lines not in best or rank < best[lines]:
                best[lines] = rank
            return
        if rode or n == 0:
            for a, b, m in walks:
                if b == stop and a != end and walked + m <= limit and t - int(m / (50 / 60)) >= 0:
                    back(a, t - int(m / (50 / 60)), lines, n, walked + m, False, trail)
        latest = t - (0 if stop == end else change)
        for trip, line, calls in trips:
            for j, (s, arr, _) in enumerate(calls):
                if s == stop and arr <= latest:
                    for b, _, dep in calls[:j]:
                        if b not in (stop, end) and dep <= arr:
                            back(b, dep, lines if lines[:1] == (line,) else (line, *lines), n + 1, walked, True, trail)

    if start != end:
        back(end, deadline, (), 0, 0.0, False, "")
    return sorted((rank, " > ".join(lines)) for lines, rank in best.items())


@pytest.mark.parametrize("seed", [1])
def test_all_alternatives_against_every_chain(spark, seed):
    rng = random.Random(seed)
    trips = some_trips(rng, 14, 5, 4)
    walks = [(1, 2, 100.0), (2, 1, 100.0), (3, 4, 150.0), (4, 3, 150.0)]
    pairs = [(a * 10 + b, a, b, "monday", 0.0) for a in range(1, 6) for b in range(1, 6) if a != b]
    calls, edges = network(spark, trips), spark.createDataFrame([(*w, 0) for w in walks], NO_WALKS)
    for k in (3, 30):
        found = search.ranked_routes(asked(spark, pairs, max_routes=k), calls, edges, None, all_alternatives=True).collect()
        for query, start, end, _, _ in pairs:
            mine = sorted((r for r in found if r.query_id == query), key=lambda r: r.option)
            want = plain_routes(trips, walks, start, end, 4200, 120, 500.0)
            ranks = [(-r.dep_sec, r.n_transfers, r.walk_m) for r in mine]
            assert len(mine) == min(k, len(want)) and ranks == [rank for rank, _ in want[:k]]
            assert all(((-r.dep_sec, r.n_transfers, r.walk_m), r.lines) in want for r in mine)


def test_parallel_lines_that_differ_further_on(spark):
    """The first ride is the same line for all; only what follows differs, so labels of one next line would hide each other."""
    trips = [("a", "A", [(1, 0, 0), (2, 600, 600)]), ("b", "B", [(2, 900, 900), (4, 1500, 1500)]), ("c", "C", [(2, 1000, 1000), (3, 1200, 1200)]),
             ("d", "D", [(3, 1400, 1400), (4, 2000, 2000)]), ("e", "E", [(2, 950, 950), (4, 2500, 2500)])]
    ask = asked(spark, [(1, 1, 4, "monday", 0.0)], max_routes=10)
    none = spark.createDataFrame([], NO_WALKS)
    lines = {r.lines for r in search.ranked_routes(ask, network(spark, trips), none, None, all_alternatives=True).collect()}
    assert lines == {"A > B", "A > E", "A > C > D"}


def test_search_by_date_is_the_search_of_that_days_trips(spark):
    rng = random.Random(9)
    trips = some_trips(rng, 30, 6, 5)
    services = {t: f"s{k % 4}" for k, (t, _, _) in enumerate(trips)}
    base = dt.date(2024, 2, 26)
    calendar = [("s0", *[True] * 5, False, False, base, base + dt.timedelta(9)), ("s1", *[False] * 5, True, True, base, base + dt.timedelta(30)),
                ("s2", *[True] * 7, base + dt.timedelta(4), base + dt.timedelta(8))]
    exceptions = [("s0", base + dt.timedelta(1), 2), ("s3", base + dt.timedelta(1), 1), ("s3", base + dt.timedelta(5), 1), ("s2", base + dt.timedelta(6), 2)]
    bits = service_days.service_days(spark.createDataFrame(calendar, CALENDAR), spark.createDataFrame(exceptions, EXCEPTIONS))
    calls, running = network(spark, trips, services), plain_days(calendar, exceptions)
    edges = spark.createDataFrame([(1, 2, 100.0, 0), (2, 1, 100.0, 0)], NO_WALKS)
    dates = [base + dt.timedelta(k) for k in (1, 5)]
    pairs = [(k * 100 + a * 10 + b, a, b, d) for k, d in enumerate(dates) for a in range(1, 7) for b in range(1, 7) if a != b]
    ask = search.as_requests(spark.createDataFrame(pairs, "query_id long, start_id long, end_id long, date date").withColumn("q", F.lit(0.0)), deadline="01:10")
    dated = service_days.with_service_days(calls, bits)

    def rows(df, *columns):
        return sorted(tuple(r) for r in df.select(*columns).collect())

    for k, day in enumerate(dates):
        assert {r.day for r in ask.where(F.col("date") == F.lit(day)).collect()} == {fv.DAYS[day.weekday()]}
    whole = {"latest": rows(search.latest_departures(ask, dated, edges), "query_id", "stop_id", "boardings", "t"),
             "direct": rows(search.direct_itineraries(ask, dated), "query_id", "trip_id", "dep", "arr"),
             "change": rows(search.one_transfer_itineraries(ask, dated, edges), "query_id", "trip_1", "trip_2", "dep_1", "arr_2"),
             "routes": rows(search.ranked_routes(ask, dated, edges, None), "query_id", "option", "dep_sec", "trail")}
    apart = {name: [] for name in whole}
    for day in dates:
        trips_today = [s for s, d in running.items() if day in d]
        own, mine = calls.where(F.col("service_id").isin(trips_today)), ask.where(F.col("date") == F.lit(day)).drop("date")
        apart["latest"] += rows(search.latest_departures(mine, own, edges), "query_id", "stop_id", "boardings", "t")
        apart["direct"] += rows(search.direct_itineraries(mine, own), "query_id", "trip_id", "dep", "arr")
        apart["change"] += rows(search.one_transfer_itineraries(mine, own, edges), "query_id", "trip_1", "trip_2", "dep_1", "arr_2")
        apart["routes"] += rows(search.ranked_routes(mine, own, edges, None), "query_id", "option", "dep_sec", "trail")
    for name in whole:
        assert whole[name] == sorted(apart[name]) and whole[name], name


def test_audit_at_watched_stops_counts_every_ride(spark):
    rng = random.Random(5)
    calls, edges = network(spark, some_trips(rng, 25, 6, 5)), spark.createDataFrame([(1, 2, 100.0, 0), (2, 1, 100.0, 0)], NO_WALKS)
    rides = timetable.connections(calls)
    ask = asked(spark, [(a, a, 7 - a, "friday", 0.0) for a in range(1, 7)])
    latest = search.latest_departures(ask, calls, edges)
    watched = spark.createDataFrame([(1,), (3,), (3,), (99,)], "stop_id long")
    got = {(r.query_id, r.stop_id, r.reason): r.n for r in
           legs.feasibility_at_stops(ask, rides, latest, search.scored_arrivals(calls, None, ask), watched).collect()}
    best = {}
    for r in latest.collect():
        best[r.query_id, r.stop_id] = max(best.get((r.query_id, r.stop_id), -1), r.t)
    want = Counter()
    for a in range(1, 7):
        for r in rides.collect():
            for stop in {r.dep_stop_id, r.arr_stop_id} & {1, 3}:
                label = best.get((a, r.arr_stop_id))
                change = 0 if r.arr_stop_id == 7 - a else 120
                reason = ("unreachable" if label is None else "too late" if r.arr_time_sec + change > label
                          else "not better" if r.dep_time_sec < best.get((a, r.dep_stop_id), -1) else "accepted")
                want[a, stop, reason] += 1
    assert got == dict(want) and {"accepted", "too late"} <= {k[2] for k in got}


def test_changes_with_a_wait_bound_and_latest_changes(spark):
    rng, columns = random.Random(21), ["query_id", "trip_1", "board_seq_1", "alight_seq_1", "board_stop_2", "trip_2", "board_seq_2", "alight_seq_2", "alight_stop_1"]
    trips = []
    for k in range(60):  # trips may call at a stop twice, with waits long enough to change from a trip to itself
        t, calls = rng.randint(0, 1500), []
        for stop in rng.choices(range(1, 7), k=rng.randint(2, 6)):
            calls.append((stop, t, t + rng.choice([20, 60, 200])))
            t = calls[-1][2] + rng.choice([100, 200, 300])
        trips.append((f"t{k:02}", f"L{k % 5}", calls))
    trips.append(("loop", "L0", [(1, 0, 10), (3, 100, 110), (1, 200, 210), (3, 300, 310), (3, 900, 910), (2, 1000, 1010)]))
    walks = [(3, 4, 100.0, 120), (4, 3, 100.0, 120), (5, 6, 400.0, 480), (6, 5, 400.0, 480)]
    edges = spark.createDataFrame(walks, NO_WALKS)
    pairs = [(1, 1, 2, "monday", 0.5), (2, 3, 6, "monday", 0.5), (3, 5, 1, "monday", 0.5), (4, 9, 2, "monday", 0.5)]
    ask, table = asked(spark, pairs), network(spark, trips)
    limit, change = 70 * 60, 120
    near = [(a, b, d, int(d / (50 / 60))) for a, b, d, _ in walks] + [(s, s, 0.0, 0) for s in range(1, 10)]
    every = {}
    for query, start, end, *_ in pairs:
        rides = [(name, i, j, calls) for name, _, calls in trips for i in range(len(calls)) for j in range(i + 1, len(calls))]
        for n1, i1, j1, c1 in rides:
            if c1[i1][0] != start or c1[i1][2] > limit or c1[j1][0] in (start, end):
                continue
            for n2, i2, j2, c2 in rides:
                if n1 == n2 or c2[j2][0] != end or c2[j2][1] > limit or c2[i2][0] in (start, end):
                    continue
                for a, b, _, secs in near:
                    wait = c2[i2][2] - secs - change - c1[j1][1]
                    if a == c1[j1][0] and b == c2[i2][0] and wait >= 0:
                        row = (query, n1, i1 + 1, j1 + 1, b, n2, i2 + 1, j2 + 1, a)
                        every[row] = (wait, (-c1[i1][2], secs, c1[j1][1], [-ord(x) for x in n1], -i1, -j1, a))

    def rows(df):
        return sorted(tuple(r) for r in df.select(*columns).collect())

    assert len(every) > 100 and rows(search.one_transfer_itineraries(ask, table, edges)) == sorted(every)
    for bound in (0, 59, 300, 100_000):
        got = rows(search.one_transfer_itineraries(ask, table, edges, max_wait_secs=bound))
        assert got == sorted(row for row, (wait, _) in every.items() if wait <= bound)
    best = {}
    for row, (_, rank) in every.items():
        key = (row[0], *row[5:8])
        if key not in best or rank < best[key][0]:
            best[key] = (rank, row)
    assert rows(search.latest_transfers(ask, table, edges)) == sorted(row for _, row in best.values())
    assert search.latest_transfers(ask.limit(0), table, edges).count() == 0 and search.latest_transfers(ask, table.limit(0), edges).count() == 0
    with pytest.raises(ValueError, match="negative"):
        search.one_transfer_itineraries(ask, table, edges, max_wait_secs=-1)


def test_ride_profile_gives_the_latest_departure_by_any_time(spark):
    rng = random.Random(11)
    trips = []
    for k in range(60):
        stops, t = rng.sample(range(6), rng.randint(2, 5)), rng.randint(0, 4) * 1800
        if k % 7 == 0:
            stops.append(stops[0])
        calls = []
        for stop in stops:
            arr = t = t + rng.choice([0, 300, 900, 4000])
            dep = t = t + rng.choice([0, 60, 600])
            calls.append((stop, arr, dep))
        trips += [(f"t{k}", "L", calls)] * (2 if k % 20 == 0 else 1)
    horizon = 14_000
    made = search.ride_profile(search.calls_by_day(network(spark, trips)), F.lit(horizon).cast("long")).collect()
    assert len({(r.stop_id, r.b_stop, r.arr, r.block) for r in made}) == len(made)
    for now in range(0, horizon + 1, 350):
        want = {}
        for _, _, calls in trips:
            for j, (stop, arr, _) in enumerate(calls):
                for start, _, dep in calls[:j]:
                    if arr <= now:
                        want[stop, start] = max(want.get((stop, start), -1), dep)
        got = [((r.stop_id, r.b_stop), r.b_dep) for r in made
               if r.block == now // 3600 and r.arr <= now and (r.until is None or r.until > now)]
        assert len(got) == len(dict(got)) and dict(got) == want
    assert search.ride_profile(search.calls_by_day(network(spark, trips)).limit(0), F.lit(horizon).cast("long")).count() == 0


def test_walks_of_a_change_only_between_stops_that_rides_call_at(spark):
    trips = [("a", "A", [(1, 0, 0), (2, 600, 600)]), ("b", "B", [(3, 1500, 1500), (4, 2000, 2000)]), ("early", "B", [(3, 100, 100), (4, 500, 500)])]
    walks = [(s, 3, 100.0, 120) for s in (2, *range(10, 60))]
    ask, edges = asked(spark, [(1, 1, 4, "monday", 0.0)]), spark.createDataFrame(walks, NO_WALKS)
    reach = search._two_rides(ask, network(spark, trips), edges)[1].where("walk_m > 0").collect()
    assert {(r.alight_stop_1, r.board_stop_2) for r in reach} == {(2, 3)} and len(reach) == 2
    assert [r.trip_2 for r in search.one_transfer_itineraries(ask, network(spark, trips), edges).collect()] == ["b"]


def test_routes_shortly_before_the_deadline_need_no_search_of_the_day(spark, monkeypatch):
    early = [(f"e{k}", f"E{k % 7}", [(100 + k % 50, 1000 + 10 * k, 1020 + 10 * k), (9, 1300 + 10 * k, 1320 + 10 * k)]) for k in range(300)]
    late = [(f"l{k}", f"L{k}", [(1 + k // 3, 9000 + 50 * k, 9010 + 50 * k), (9, 9300 + 50 * k, 9320 + 50 * k)]) for k in range(4)]
    stop_times = network(spark, early + late)
    edges = spark.createDataFrame([(1, 2, 100.0), (2, 1, 100.0)], "a_stop_id long, b_stop_id long, distance_m double")

    def run(least, *pairs):
        written, ask = [], search.as_requests(spark.createDataFrame(
            [(k, start, 9, "monday", 0.0) for k, start in pairs], "query_id long, start_id long, end_id long, day string, q double"), deadline="02:46")

        def counted(df):
            out = real(df)
            if "trail" in out.columns and "stop_id" in out.columns:
                written.append(out.count())
            return out
        real = search.cut_lineage
        with monkeypatch.context() as m:
            m.setattr(search, "ALIGHTINGS_AT_ONCE", 1, raising=False)
            m.setattr(search, "LEAST_STRETCH_SECS", least, raising=False)
            m.setattr(search, "cut_lineage", counted)
            found = search.ranked_routes(ask, stop_times, edges, None).drop("path").collect()
        return sorted(map(tuple, found), key=str), max(written)

    routes, most = run(1200, (1, 1))
    assert [r[0] for r in routes] == [1] * 3 and most < 30
    # The second has early routes only, which takes another stretch; the third one has no id.
    got = {(r[0], r[5]) for r in run(6000, (1, 1), (2, 100), (None, 2))[0]}
    assert got == {(1, 9110), (1, 9060), (1, 9040), (2, 3520), (2, 3020), (2, 2520), (None, 9160), (None, 8990), (None, 8940)}


def test_rides_without_a_change_bound_the_search(spark, monkeypatch):
    """Three lines run from the origin shortly before the deadline, so no label of the search goes below the third's departure."""
    trips = [(f"x{k}", f"X{k % 5}", [(1, 60 * k, 60 * k), (2, 60 * k + 300, 60 * k + 300)]) for k in range(60)]
    trips += [(f"y{k}", f"Y{k}", [(4, 50 * k, 50 * k), (2, 50 * k + 200, 50 * k + 200)]) for k in range(60)]
    walks = [(1, 3, 50.0, 0), (3, 1, 50.0, 0)]
    calls, edges = network(spark, trips), spark.createDataFrame(walks, NO_WALKS)
    ask = asked(spark, [(1, 1, 2, "monday", 0.0), (2, 3, 2, "monday", 0.0)], max_routes=3)
    floors, ridden = [], search.ride_back

    def seen(labels, *rest):
        floors.append({(r.query_id, r.floor_sec) for r in labels.select("query_id", "floor_sec").distinct().collect()})
        return ridden(labels, *rest)

    monkeypatch.setattr(search, "ride_back", seen)
    monkeypatch.setattr(search, "ALIGHTINGS_AT_ONCE", 1)
    found = search.ranked_routes(ask, calls, edges, None).orderBy("query_id", "option").collect()
    assert [(r.query_id, r.dep_sec, r.lines) for r in found] == [
        (1, 3540, "X4"), (1, 3480, "X3"), (1, 3420, "X2"), (2, 3480, "X4"), (2, 3420, "X3"), (2, 3360, "X2")]
    assert floors[0] == {(1, 3420), (2, 3360)}
    # The bound never changes what is found.
    monkeypatch.setattr(search, "_with_direct_floors", lambda waiting, *rest: waiting.withColumn("direct_sec", F.lit(None).cast("long")))
    assert search.ranked_routes(ask, calls, edges, None).orderBy("query_id", "option").collect() == found

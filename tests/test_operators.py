import math
import random

import pytest
from pyspark.sql import functions as F

from mobspark.operators import asof, compare, joins, moments, nearest, rank, shape, skim_tiles, tours, vehicle_day


def rows(df, *sort):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, v) for v in r))


# ---- joins ------------------------------------------------------------------------------------------

def test_null_spreading_join_equals_left_join(spark, frame):
    left = frame("folder string, id bigint, k bigint", *[("a" if i % 2 else "b", i, None if i % 3 == 0 else i % 10) for i in range(300)])
    right = frame("folder string, rk bigint, v string", *[(f, k, f"{f}{k}") for f in "ab" for k in range(7)], ("a", None, "null"))
    got = joins.left_join_spreading_nulls(left, right, "k", "rk", "id").select("folder", "id", "k", "v")
    want = left.join(right, (left.folder == right.folder) & (left.k == right.rk), "left").select(left.folder, "id", "k", "v")
    assert rows(got) == rows(want)


def test_null_keys_are_salted_in_the_shuffle(spark, frame):
    left = frame("folder string, id bigint, k bigint", ("a", 1, None))
    right = frame("folder string, rk bigint, v string", ("a", 1, "x"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.left_join_spreading_nulls(left, right, "k", "rk", "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("_salt") > 2 and "hashpartitioning(folder" in plan
    assert any("hashpartitioning" in line and "_salt" in line for line in plan.splitlines())


def test_case_rows_attach(frame):
    fact = frame("folder string, v bigint", *[("abc"[i % 3], i) for i in range(90)])
    case = frame("folder string, m double", ("a", 2.0), ("b", 4.0))
    got = joins.attach_case_rows(fact, case, "left")
    assert rows(got.select("folder", "v", "m")) == rows(fact.join(case, "folder", "left").select("folder", "v", "m"))


def test_one_row_per_case(frame):
    a = frame("folder string, x bigint", ("a", 1), ("b", 2))
    b = frame("folder string, y double", ("b", 0.5), ("c", 1.5))
    assert rows(joins.one_row_per_case([a, b])) == [("a", 1, None), ("b", 2, 0.5), ("c", None, 1.5)]


# ---- tours ------------------------------------------------------------------------------------------

TRIP = "folder string, vehicle bigint, tour bigint, tnc_trip_id_int bigint, start_s double, passengers bigint"


def test_sub_tours_of_one_vehicle(frame):
    legs = frame(TRIP, *[("f", 1, 1, i, 100.0 * i, p) for i, p in enumerate([0, 2, 0, 1, 0])])
    got = tours.add_sub_tours(legs).orderBy("tnc_trip_id_int")
    assert [r.sub_tour for r in got.collect()] == [0, 0, 1, 1, 2]


def test_sub_tours_ties_missing_keys_and_null_passengers(frame):
    legs = frame(TRIP, ("f", 1, 1, 2, 5.0, 0), ("f", 1, 1, 1, 5.0, 0), ("f", 1, 1, 3, None, 0), ("f", 1, 1, 4, 6.0, None), ("f", None, 1, 5, 0.0, 0), ("f", 1, None, 6, 0.0, 0))
    got = {r.tnc_trip_id_int: r.sub_tour for r in tours.add_sub_tours(legs).collect()}
    assert got == {1: 0, 2: 1, 4: 1, 3: 2}


@pytest.mark.parametrize("bucket_s", [1, 60, 100_000])
def test_sub_tours_of_a_very_long_tour(frame, bucket_s):
    rng = random.Random(3)
    legs = [("f", 1, 1, i, float(rng.randrange(0, 5000)), rng.choice([0, 0, 1, 2])) for i in range(2000)]
    legs += [("g", v, v % 2, i, float(rng.randrange(0, 900)), rng.choice([0, 1])) for v in range(20) for i in range(5)]
    want, counter, seen = {}, {}, set()
    for f, v, t, i, s, p in sorted(legs, key=lambda r: (r[0], r[1], r[2], r[4], r[3])):
        if p == 0 and (f, v, t) in seen:
            counter[f, v, t] = counter.get((f, v, t), 0) + 1
        seen.add((f, v, t))
        want[f, v, t, i] = counter.get((f, v, t), 0)
    got = tours.add_sub_tours(frame(TRIP, *legs), bucket_s).collect()
    assert {(r.folder, r.vehicle, r.tour, r.tnc_trip_id_int): r.sub_tour for r in got} == want


# ---- as-of ------------------------------------------------------------------------------------------

MOVE = "folder string, vehicle bigint, tnc_trip_id_int bigint, start_s double, origin_zone bigint, kind string"


def found(df):
    return {r.tnc_trip_id_int: (r.next_trip, r.next_origin_zone) for r in df.collect()}


def test_next_service_trip_bounds(frame):
    moves = frame(
        MOVE, ("f", 1, 1, 100.0, 9, "p"), ("f", 1, 2, 100.0, 5, "s"), ("f", 2, 3, 0.0, 9, "p"), ("f", 2, 4, 3600.0, 6, "s"),
        ("f", 3, 5, 0.0, 9, "p"), ("f", 3, 6, 3600.000001, 7, "s"), ("f", 4, 7, 0.0, 9, "p"), ("f", 4, 9, 10.0, 1, "s"),
        ("f", 4, 8, 10.0, 2, "s"), ("g", 4, 10, 1.0, 3, "s"),
    )
    got = found(asof.next_service_trip(moves, F.col("kind") == "p", F.col("kind") == "s"))
    assert got == {1: (None, None), 3: (4, 6), 5: (None, None), 7: (8, 2)}


@pytest.mark.parametrize("bucket_s", [1, 60, 100_000])
def test_next_service_trip_of_a_busy_vehicle(frame, bucket_s):
    rng = random.Random(5)
    data = [("f", 1 if i % 3 else i % 7, i, float(rng.randrange(0, 40_000)), i % 11, rng.choice("ps-b")) for i in range(1500)]
    moves = frame(MOVE, *data)
    probe, service = F.col("kind").isin("p", "b"), F.col("kind").isin("s", "b")
    want = {}
    for f, v, i, s, z, k in data:
        if k in "pb":
            later = [(s2, i2, z2) for f2, v2, i2, s2, z2, k2 in data if k2 in "sb" and (f2, v2) == (f, v) and s < s2 <= s + 600]
            want[i] = min(later)[1:] if later else (None, None)
    assert found(asof.next_service_trip(moves, probe, service, horizon_s=600, bucket_s=bucket_s)) == want


def test_skim_lookup_periods(frame):
    skim = frame("folder string, period int, origin_zone bigint, destination_zone bigint, time_min double, dist_m double",
                 *[("f", p, 1, 2, p / 10, 1609.34) for p in (360, 900, 1440)])
    req = frame("folder string, id bigint, request_time double, origin_zone bigint, destination_zone bigint",
                ("f", 1, 360 * 60.0, 1, 2), ("f", 2, 360.5 * 60, 1, 2), ("f", 3, 1441 * 60.0, 1, 2), ("f", 4, 0.0, 2, 1), ("g", 5, 0.0, 1, 2))
    got = {r.id: (r.skim_period, r.skim_time) for r in asof.skim_lookup(req, skim).collect()}
    assert got == {1: (360, 36.0), 2: (900, 90.0), 3: (None, None), 4: (360, None), 5: (None, None)}
    last = {r.id: r.skim_period for r in asof.skim_lookup(req, skim, mode="last").collect()}
    assert last == {1: 1440, 2: 1440, 3: 1440, 4: 1440, 5: None}


# ---- nearest ----------------------------------------------------------------------------------------

def brute(homes, stops):
    out = {}
    for f, x, y in homes:
        options = [((x - sx) ** 2 + (y - sy) ** 2, s) for sf, s, sx, sy in stops if sf == f]
        if options:
            d2, s = min(options)
            out[f, x, y] = (s, math.sqrt(d2))
    return out


def check_nearest(frame, homes, stops):
    got = nearest.nearest_stop(frame("folder string, x double, y double", *homes), frame("folder string, stop_id bigint, x double, y double", *stops))
    assert {(r.folder, r.x, r.y): (r.stop_id, pytest.approx(r.distance)) for r in got.collect()} == brute(set(homes), stops)


def test_nearest_ties_far_homes_and_missing_stops(frame):
    stops = [("f", 7, 0.0, 0.0), ("f", 3, 10.0, 0.0), ("f", 5, 10.0, 0.0), ("h", 1, 5.0, 5.0)]
    homes = [("f", 5.0, 0.0), ("f", 5.0, 0.0), ("f", 1e6, -1e6), ("f", 0.0, 0.0), ("g", 1.0, 1.0), ("h", -3.0, 2.0)]
    check_nearest(frame, homes, stops)


def test_nearest_random_and_clustered(frame):
    rng = random.Random(1)
    spread = [("f", i, rng.uniform(0, 1e5), rng.uniform(0, 1e5)) for i in range(200)]
    cluster = [("f", 1000 + i, 500 + rng.uniform(0, 3), 700 + rng.uniform(0, 3)) for i in range(100)]
    grid = [("g", i, float(i % 10), float(i // 10)) for i in range(100)]
    homes = [("f", rng.uniform(-2e4, 1.2e5), rng.uniform(-2e4, 1.2e5)) for _ in range(200)]
    homes += [("f", 500 + rng.uniform(-5, 8), 700 + rng.uniform(-5, 8)) for _ in range(100)]
    homes += [("g", rng.randrange(-2, 24) / 2, rng.randrange(-2, 24) / 2) for _ in range(150)]
    check_nearest(frame, homes, spread + cluster + grid)


# ---- shape ------------------------------------------------------------------------------------------

def test_describe_long_single_value_and_empty_metric(frame):
    d = frame("folder string, a double, b double, keep boolean", ("f", 2.0, None, True), ("f", 5.0, 1.0, False))
    got = {r.Metric: (r.Sum, r.Mean, r.StdDev, r.SampleSize) for r in shape.describe_long(d, ["folder"], ["a", "b"], F.col("keep"), {"n": F.count(F.lit(1))}).collect()}
    assert got == {"a": (2.0, 2.0, None, 1.0), "b": (0.0, None, None, 0.0), "n": (2.0, None, None, None)}


def test_histogram_zero_fill_and_overflow(frame):
    d = frame("k string, v double", ("x", 0.04), ("x", 0.25), ("x", 0.35), ("x", 5.01), ("x", 5.0), ("x", None), ("y", 1.0))
    got = {(r.k, r.v): r.Count for r in shape.capped_histogram(d, ["k"], "v").collect()}
    assert len(got) == 52 + 51 and sum(got.values()) == 6
    assert (got["x", "0.0"], got["x", "0.2"], got["x", "0.4"], got["x", "5.0"], got["x", "5.0+"]) == (1, 1, 1, 1, 1)
    assert ("y", "5.0+") not in got and got["y", "1.0"] == 1


def test_pivot_has_a_fixed_schema(frame):
    d = frame("k string, m string, v double", ("x", "A", 1.0), ("x", "A", 2.0), ("y", "C", 3.0))
    got = shape.pivot_expected(d, ["k"], "m", ["A", "B"], "v")
    assert got.columns == ["k", "A", "B"] and rows(got) == [("x", 3.0, 0.0), ("y", 0.0, 0.0)]


# ---- comparison -------------------------------------------------------------------------------------

def test_baseline_values_stand_beside_treatments(frame):
    d = frame("folder string, c string, s string, v double", ("a1", "a", "base", 2.0), ("a2", "a", "new", 3.0), ("b2", "b", "new", 5.0), ("a0", "a", "base", 4.0), ("a3", "a", "old", 9.0))
    got = compare.with_baseline(d, ["c"], "s", ["base"], ["v"], ["new"], "b ")
    assert {r.folder: r["b v"] for r in got.collect()} == {"a1": None, "a0": None, "a2": 4.0, "b2": None}
    assert "a3" in {r.folder for r in compare.with_baseline(d, ["c"], "s", ["base"], ["v"]).collect()}


# ---- skew -------------------------------------------------------------------------------------------

def test_a_dominant_traveller_is_split_by_the_adaptive_join(spark, frame):
    """Row-level joins on a real key keep a plan shape in which the skew join may split the hot key."""
    from mobspark.plans import modes

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    trips = spark.range(60_000).repartition(12).selectExpr(
        "'f' AS folder", "id AS trip_id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 500 END AS person", "id % 50 AS origin", "id % 40 AS destination",
        "id % 10 AS mode", "0D AS start_s", "100D AS end_s", "CAST(id AS DOUBLE) AS travel_distance", "0 AS has_artificial_trip")
    people = spark.range(500).selectExpr(
        "'f' AS folder", "id AS person", "id AS household", "id % 90 AS age", "id % 40 AS work_location_id", "0D AS income", "0L AS education",
        "0 AS gender", "0L AS race", "false AS disability", "0L AS marital_status")
    homes = spark.range(500).selectExpr("'f' AS folder", "id AS household", "id % 50 AS location", "0D AS income", "1L AS vehicles", "1L AS persons", "1L AS workers")
    places = spark.range(50).selectExpr("'f' AS folder", "id AS location", "id AS zone", "0D AS x", "0D AS y")
    params = frame("folder string, trip_multiplier double", ("f", 1.0))
    tables = {"trip": trips, "person": people, "household": homes, "location": places}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = modes.mode_distribution_counts(tables, params)
        total = sum(r.total for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert total == 60_000 and "skew=true" in plan


def test_histogram_counts_values_below_zero(frame):
    df = frame("folder string, v double", ("a", -1.0), ("a", -0.3), ("a", 1.0), ("a", None))
    got = {r.v: r.Count for r in shape.capped_histogram(df, ["folder"], "v").collect()}
    assert got["-1.0"] == 1 and got["-0.3"] == 1 and got["1.0"] == 1 and got["0.0"] == 0 and sum(got.values()) == 3


def test_nearest_with_a_stray_stop(frame):
    import random

    rnd = random.Random(3)
    stops = [("a", i, rnd.random() * 100, rnd.random() * 100) for i in range(400)] + [("a", 400, 1e9, 1e9), ("b", 1, 5.0, 5.0)]
    homes = [("a", rnd.random() * 100, rnd.random() * 100) for _ in range(60)] + [("b", 0.0, 0.0)]
    got = nearest.nearest_stop(frame("folder string, x double, y double", *homes), frame("folder string, stop_id bigint, x double, y double", *stops))
    for r in got.collect():
        want = min(((x - r.x) ** 2 + (y - r.y) ** 2, i) for f, i, x, y in stops if f == r.folder)
        assert r.stop_id == want[1]
    assert got.count() == len(homes)


def test_homes_meet_few_coarse_cells(frame, monkeypatch):
    rnd = random.Random(5)
    stops = [("a", i, rnd.random() * 1000, rnd.random() * 1000) for i in range(20_000)]
    homes = [("a", rnd.random() * 1000, rnd.random() * 1000) for _ in range(100)]
    met = []

    def counted(left, right, on, how="inner"):
        if list(on) == ["folder", "pcx", "pcy"]:
            met.append(left.count())
        return joins.join_by_shuffle(left, right, on, how)

    monkeypatch.setattr(nearest, "join_by_shuffle", counted)
    check_nearest(frame, homes, stops)
    assert len(met) == 1 and met[0] < 2 * len(homes)


def test_building_plans_starts_no_job(spark, frame):
    import __spark_entry__ as entry

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning-only", "plans")
    try:
        for name in ("closest_stops", "nearest_stop", "requests_sum", "repositioning_success_rate", "mode_dist_combo_proactive", "skim_lookup"):
            entry.queries()[name](spark, "/root/testdata/sf0.001")
        # reading a Parquet schema is Spark's own job; the plans add none, so nothing but those shows
        jobs = tracker.getJobIdsForGroup("planning-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in jobs for s in tracker.getJobInfo(j).stageIds]
    assert all(s is None or s.name.startswith("parquet at") for s in stages)


def test_parts_are_even_and_in_order(spark):
    rows = spark.range(20_000).selectExpr(
        "CASE WHEN id % 10 < 8 THEN 'hot' ELSE concat('c', id % 10) END AS folder", "id",
        # strays, very many equal values, and dense ones
        "CASE WHEN id % 7 = 0 THEN 5D WHEN id = 3 THEN 1e12D ELSE pow(id % 9973, 1.5) END AS x", "CAST(hash(id) AS DOUBLE) AS y")
    parted = rank.add_parts(rows, {"px": "x", "py": "y"}, "id")
    assert set(parted.columns) == {"folder", "id", "x", "y", "px", "py"}
    got = parted.toPandas()
    assert len(got) == 20_000
    for folder, g in got.groupby("folder"):
        for part, by in (("px", ["x", "id"]), ("py", ["y", "id"])):
            assert g.sort_values(by)[part].is_monotonic_increasing
            assert g[part].between(0, rank.CLASSES).all() and g.groupby(part).size().max() < len(g) / 20, folder
    again = rank.add_parts(rows.orderBy(F.desc("y")).repartition(7), {"px": "x", "py": "y"}, "id").toPandas()
    assert got.sort_values("id").px.tolist() == again.sort_values("id").px.tolist()
    assert rank.add_parts(rows.limit(0), {"p": "x"}, "id").collect() == []


def test_vehicle_day_is_sub_tours_and_next_trips(spark, frame):
    rnd = random.Random(8)
    legs = []
    for i in range(3000):
        vehicle = None if rnd.random() < 0.03 else (0 if rnd.random() < 0.4 else rnd.randrange(6))
        start = None if rnd.random() < 0.03 else float(rnd.choice([rnd.randrange(40_000), rnd.randrange(300), 59.9999999, 60.0, 120.00000049]))
        legs.append(("ab"[i % 2], i, vehicle, None if rnd.random() < 0.02 else rnd.randrange(3), start, rnd.choice([0, 0, 1, 2, None]),
                     rnd.choice([-3, -2, 1, None]), rnd.randrange(4)))
    df = frame("folder string, tnc_trip_id_int bigint, vehicle bigint, tour bigint, start_s double, passengers bigint, init_status int, origin_zone bigint", *legs)
    status = F.col("init_status")
    rules = {"one": (status == -3, ~status.eqNullSafe(-3)), "two": (status == -2, status == 1)}
    got = vehicle_day.add_vehicle_day(df.repartition(4), rules, 1800)
    assert set(got.columns) == {*df.columns, "sub_tour", "seq", *(f"{r}_{x}" for r in rules for x in ("probe", "next"))}
    want = {r.tnc_trip_id_int: (r.sub_tour, r.seq) for r in tours.add_sub_tours(df).collect()}
    got = got.collect()
    assert {r.tnc_trip_id_int: r.sub_tour for r in got} == {k: v[0] for k, v in want.items()}
    by_tour = {}
    for r in got:
        by_tour.setdefault((r.folder, r.vehicle, r.tour), []).append((r.seq, r.tnc_trip_id_int))
    for members in by_tour.values():
        ids = [i for _, i in sorted(members)]
        assert ids == sorted(ids, key=lambda i: (legs[i][4] is None, legs[i][4] or 0, i))
    with_tour = df.where("tour IS NOT NULL")
    for rule, (probe, service) in rules.items():
        nxt = {r.tnc_trip_id_int: (r.next_trip, r.next_origin_zone) for r in asof.next_service_trip(with_tour, probe, service, 1800).collect()}
        mine = {r.tnc_trip_id_int: r[f"{rule}_next"] for r in got if r[f"{rule}_probe"]}
        assert {k: (v.id, v.zone) if v else (None, None) for k, v in mine.items()} == nxt
        assert all(r[f"{rule}_next"] is None for r in got if not r[f"{rule}_probe"])


def test_moments_merge_in_any_steps(spark, frame):
    rnd = random.Random(4)
    values = [("ab"[i % 2], i % 5, rnd.choice([None, rnd.gauss(1e9, 1e-2)]), float(i)) for i in range(4000)]
    df = frame("k string, part int, far double, near double", *values, ("lone", 0, 2.5, None), ("none", 0, None, None))
    direct = {(r.k, r.Metric): r for r in shape.describe_long(df, ["k"], ["far", "near"]).collect()}
    states = moments.moment_states(df, ["k", "part"], ["far", "near"])
    first = moments.merge_states(states.where("part < 2"), ["k"])
    stored = moments.states_of(moments.describe_states(moments.merge_states(states.where("part >= 2"), ["k"])))
    merged = moments.merge_states(first.unionByName(stored), ["k"])
    got = {(r.k, r.Metric): r for r in moments.describe_states(merged).collect()}
    assert got.keys() == direct.keys()
    for key, r in got.items():
        want = direct[key]
        assert r.SampleSize == want.SampleSize
        for c, close in (("Sum", 1e-12), ("Mean", 1e-14), ("StdDev", 1e-4 if key[1] == "far" else 1e-12)):
            assert (r[c] is None) == (want[c] is None) and (r[c] is None or r[c] == pytest.approx(want[c], rel=close)), (key, c)
    assert got["lone", "far"].StdDev is None and got["none", "far"].Mean is None and got["none", "far"].Sum == 0.0
    far = [v[2] for v in values if v[0] == "a" and v[2] is not None]
    mean = sum(x - 1e9 for x in far) / len(far)
    exact = math.sqrt(sum((x - 1e9 - mean) ** 2 for x in far) / (len(far) - 1))
    assert got["a", "far"].StdDev == pytest.approx(exact, rel=1e-3)  # squares of the values have lost all of it
    assert moments.merge_states(states.limit(0), ["k"]).collect() == []


@pytest.mark.parametrize("side", [1, 4, 16])
def test_tiled_look_up_equals_the_join(spark, frame, side):
    rnd = random.Random(side)
    zones = [*range(-3, 20), 1000, 10**12]
    pairs = [(o, d) for o in zones for d in zones if rnd.random() < 0.9 or (0 <= o < 16 and 0 <= d < 16)]
    skim = frame("folder string, period int, origin_zone bigint, destination_zone bigint, time_min double, dist_m double",
                 *[(f, p, o, d, rnd.choice([None, rnd.random()]), rnd.random()) for f in "ab" for p in (360, 600) for o, d in pairs], ("a", 600, None, 1, 1.0, 1.0))
    requests = frame("folder string, id bigint, request_time double, origin_zone bigint, destination_zone bigint",
                     *[(rnd.choice("abc"), i, rnd.choice([None, 3600.0 * rnd.randrange(14)]), rnd.choice([None, 77, *zones]), rnd.choice([None, -9, *zones])) for i in range(800)])
    tiles = skim_tiles.tile_skim(skim, side)
    got = skim_tiles.tiled_lookup(requests, tiles, side=side)
    want = asof.skim_lookup(requests, skim)
    assert got.columns == [*requests.columns, "skim_period", "skim_time", "skim_dist"]
    assert rows(got) == rows(want.select(*got.columns))
    last = skim_tiles.tiled_lookup(requests, tiles, "last", side=side)
    assert rows(last) == rows(asof.skim_lookup(requests, skim, "last").select(*last.columns))
    full = {r.full for r in tiles.collect()}
    assert full == ({True} if side == 1 else {True, False}) and tiles.count() <= skim.count() / (side if side > 1 else 1)
    assert skim_tiles.tile_skim(skim.limit(0)).count() == 0


def test_join_by_shuffle_broadcasts_neither_side(spark, frame, tmp_path):
    left = frame("folder string, k bigint, a int", ("f", 1, 1), ("f", 1, 2), ("f", 2, 3), ("f", None, 4))
    right = frame("folder string, k bigint, b int", ("f", 1, 10), ("f", 1, 11), ("f", None, 12), ("g", 2, 13))
    right.write.parquet(f"{tmp_path}/right")
    right = spark.read.parquet(f"{tmp_path}/right")  # files have a small estimate
    assert "BroadcastExchange" in left.join(right, ["folder", "k"])._jdf.queryExecution().executedPlan().toString()
    for how in ("inner", "left"):
        got = joins.join_by_shuffle(left, right, ["folder", "k"], how)
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
        assert rows(got) == rows(left.join(right, ["folder", "k"], how))

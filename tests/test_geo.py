import math
import random


from mediafeat.functions.geo import EARTH_RADIUS_M
from mediafeat.operators import geo as G


def hav(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    dp, dl = math.radians(c) - math.radians(a), math.radians(d) - math.radians(b)
    x = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(min(1.0, x)))


def _brute(places, points, r):
    return {pid: sum(1 for _, a, b in points if hav(la, lo, a, b) <= r) for pid, la, lo in places}


def _check(spark, places, points, r):
    pl = spark.createDataFrame(places, "id long, lat double, lng double")
    pt = spark.createDataFrame(points, "bid long, lat double, lng double")
    got = {row["id"]: row["n"] for row in G.radius_count(pl, pt, r, out_col="n").collect()}
    assert got == _brute(places, points, r)


def test_random_cluster_matches_brute_force(spark):
    rnd = random.Random(5)
    places = [(i, 37 + rnd.random() * 0.05, -122 - rnd.random() * 0.05) for i in range(150)]
    points = [(i, 37 + rnd.random() * 0.05, -122 - rnd.random() * 0.05) for i in range(400)]
    points += [(1000 + i, points[0][1], points[0][2]) for i in range(50)]  # a hot location
    _check(spark, places, points, 1000.0)


def test_edges_poles_and_antimeridian(spark):
    rnd = random.Random(11)
    places, points = [], []
    for i, (la, lo) in enumerate([(0, 179.999), (0, -179.999), (89.995, 10), (-89.999, -50), (60, 0), (45, 90)]):
        places.append((i, float(la), float(lo)))
        for j in range(60):
            points.append((i * 100 + j, float(max(-90, min(90, la + rnd.uniform(-0.02, 0.02)))),
                           ((lo + rnd.uniform(-0.05, 0.05) + 180) % 360) - 180))
    g = G.Grid(1000.0)
    places.append((50, g.dlat * 3 - 90, 0.0))  # exactly on a band edge
    points.append((9999, g.dlat * 3 - 90 + 0.005, 0.0))
    _check(spark, places, points, 1000.0)


def test_no_neighbour_keeps_zero_and_cap(spark):
    places = [(1, 10.0, 10.0), (2, 37.0, -122.0)]
    points = [(i, 37.0 + i * 1e-6, -122.0) for i in range(80)]
    pl = spark.createDataFrame(places, "id long, lat double, lng double")
    pt = spark.createDataFrame(points, "bid long, lat double, lng double")
    got = {r["id"]: r["n"] for r in G.radius_count(pl, pt, 1000.0, cap=50, out_col="n").collect()}
    assert got == {1: 0, 2: 50}


def test_no_nested_loop_in_plan(spark):
    pl = spark.createDataFrame([(1, 1.0, 1.0)], "id long, lat double, lng double")
    pt = spark.createDataFrame([(1, 1.0, 1.0)], "bid long, lat double, lng double")
    plan = G.radius_count(pl, pt, 500.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_nearby_limit_and_order(spark):
    places = [(1, 37.0, -122.0)]
    points = [(i, 37.0 + i * 1e-5, -122.0) for i in range(70)]
    pl = spark.createDataFrame(places, "id long, lat double, lng double")
    pt = spark.createDataFrame(points, "bid long, lat double, lng double")
    rows = G.nearby(pl, pt, 1000.0, "id", "bid", limit=50).orderBy("rank").collect()
    assert [r["bid"] for r in rows] == list(range(50))


def test_nearby_hot_coordinates_exact(spark):
    rnd = random.Random(2)
    places = [(i, 37 + rnd.random() * 0.01, -122 - rnd.random() * 0.01) for i in range(40)]
    places += [(100 + i, places[0][1], places[0][2]) for i in range(30)]  # many places at one spot
    points = [(i, 37 + rnd.random() * 0.01, -122 - rnd.random() * 0.01) for i in range(60)]
    points += [(1000 + i, 37.005, -122.005) for i in range(200)]  # a hot point location
    pl = spark.createDataFrame(places, "id long, lat double, lng double")
    pt = spark.createDataFrame(points, "bid long, lat double, lng double")
    got = {(r["id"], r["rank"]): r["bid"] for r in G.nearby(pl, pt, 800.0, "id", "bid", limit=25).collect()}
    want = {}
    for pid, la, lo in places:
        cand = sorted((hav(la, lo, a, b), bid) for bid, a, b in points if hav(la, lo, a, b) <= 800.0)
        for rk, (_, bid) in enumerate(cand[:25], start=1):
            want[(pid, rk)] = bid
    assert got == want


def _check_adaptive(spark, places, points, r, **kw):
    pl = spark.createDataFrame(places, "id long, lat double, lng double")
    pt = spark.createDataFrame(points, "bid long, lat double, lng double")
    got = {row["id"]: row["n"] for row in G.radius_count_adaptive(pl, pt, r, out_col="n", **kw).collect()}
    assert got == _brute(places, points, r)


def test_adaptive_dense_area_matches_brute_force(spark):
    rnd = random.Random(8)
    places = [(i, 37 + rnd.random() * 0.03, -122 - rnd.random() * 0.03) for i in range(120)]
    # a dense cluster of distinct points (a third of all points in a few hundred metres)
    points = [(i, 37.01 + rnd.random() * 0.004, -122.01 - rnd.random() * 0.004) for i in range(600)]
    points += [(1000 + i, 37 + rnd.random() * 0.03, -122 - rnd.random() * 0.03) for i in range(1200)]
    _check_adaptive(spark, places, points, 1000.0, levels=6, pair_limit=8)
    _check_adaptive(spark, places, points, 1000.0)  # defaults


def test_adaptive_edges_and_poles(spark):
    rnd = random.Random(13)
    places, points = [], []
    for i, (la, lo) in enumerate([(0, 179.999), (0, -179.999), (89.995, 10), (-89.999, -50), (60, 0), (45, 90)]):
        places.append((i, float(la), float(lo)))
        for jj in range(80):
            points.append((i * 100 + jj, float(max(-90, min(90, la + rnd.uniform(-0.02, 0.02)))),
                           ((lo + rnd.uniform(-0.05, 0.05) + 180) % 360) - 180))
    _check_adaptive(spark, places, points, 1000.0, levels=5, pair_limit=4)


def test_auto_switches_on_budget(spark):
    rnd = random.Random(21)
    places = [(i, 37 + rnd.random() * 0.02, -122 - rnd.random() * 0.02) for i in range(60)]
    points = [(i, 37.005 + rnd.random() * 0.002, -122.005 - rnd.random() * 0.002) for i in range(400)]
    pl = spark.createDataFrame(places, "id long, lat double, lng double")
    pt = spark.createDataFrame(points, "bid long, lat double, lng double")
    est = G.grid_pairs_estimate(pl, pt, 1000.0)
    assert 0 < est <= 60 * 400
    want = _brute(places, points, 1000.0)
    for budget in (10**12, 1):  # grid, then forced adaptive
        got = {r["id"]: r["n"] for r in G.radius_count(pl, pt, 1000.0, out_col="n", pair_budget=budget).collect()}
        assert got == want


def _page_brute(places, points, r, limit):
    want = {}
    for pid, la, lo in places:
        cand = sorted((hav(la, lo, a, b), bid) for bid, a, b in points if hav(la, lo, a, b) <= r)
        for rk, (_, bid) in enumerate(cand[:limit], start=1):
            want[(pid, rk)] = bid
    return want


def test_nearby_adaptive_dense_matches_brute_force(spark):
    rnd = random.Random(31)
    places = [(i, 37 + rnd.random() * 0.02, -122 - rnd.random() * 0.02) for i in range(50)]
    places += [(100 + i, places[0][1], places[0][2]) for i in range(5)]
    points = [(i, 37.008 + rnd.random() * 0.004, -122.008 - rnd.random() * 0.004) for i in range(1500)]
    points += [(5000 + i, 37 + rnd.random() * 0.02, -122 - rnd.random() * 0.02) for i in range(500)]
    points += [(9000 + i, 37.01, -122.01) for i in range(40)]  # identical coordinates
    pl = spark.createDataFrame(places, "id long, lat double, lng double")
    pt = spark.createDataFrame(points, "bid long, lat double, lng double")
    want = _page_brute(places, points, 900.0, 20)
    for kw in ({"levels": 6, "pair_limit": 16}, {}):
        got = {(r["id"], r["rank"]): r["bid"]
               for r in G.nearby_adaptive(pl, pt, 900.0, "id", "bid", limit=20, **kw).collect()}
        assert got == want
    got = {(r["id"], r["rank"]): r["bid"] for r in G.nearby(pl, pt, 900.0, "id", "bid", limit=20, pair_budget=1).collect()}
    assert got == want

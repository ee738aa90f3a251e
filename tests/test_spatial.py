import math
import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import spatial as sp


def metres(a, b):
    la, lo, lb, lp = map(math.radians, (a[1], a[2], b[1], b[2]))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * sp.EARTH_M * math.asin(min(1, math.sqrt(h)))


def frame(spark, rows):
    return spark.createDataFrame(rows, "point_id long, lat double, lon double")


def test_pairs_as_brute_force_at_poles_and_date_line(spark):
    rnd, rows, m = random.Random(3), [], 1 / 111_195
    for lat, lon in [(52.0, 13.0), (89.9999, 0.0), (-89.99995, 10.0), (0.0, 180.0), (60.0, -180.0), (0.0, 0.0)]:
        for _ in range(60):
            x = lon + rnd.uniform(-60, 60) * m / max(1e-6, math.cos(math.radians(lat))) if abs(lat) < 89 else rnd.uniform(-180, 180)
            rows.append((len(rows), max(-90.0, min(90.0, lat + rnd.uniform(-60, 60) * m)), (x + 180) % 360 - 180))
    rows += [(len(rows) + i, 52.5, 13.5) for i in range(5)]
    got = {tuple(r) for r in sp.near_pairs(frame(spark, rows), 25).collect()}
    want = {(a[0], b[0]) for i, a in enumerate(rows) for b in rows[i + 1 :] if metres(a, b) <= 25}
    assert got == want and len(want) > 100


def test_hot_cells_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(sp, "HOT_POINTS", 20)
    rows = [(i, 50.0 + i * 1e-7, 8.0) for i in range(150)] + [(1000 + i, 10.5 + i, 8.0) for i in range(50)]
    assert sp.near_pairs(frame(spark, rows), 25).distinct().count() == 150 * 149 // 2 == sp.near_pairs(frame(spark, rows), 25).count()


def test_only_the_latest_sound_location_counts(spark):
    nan = float("nan")
    rows = [(1, 1.0, 1.0, 1, "x"), (1, 2.0, 2.0, 3, "x"), (1, 2.0, 2.0, 3, "x"), (2, None, 5.0, 2, "x"), (2, 5.0, 5.0, 1, "x"), (3, nan, 1.0, 1, "x"), (4, 0.0, 0.0, 1, "x"), (5, 91.0, 0.0, 1, "x"), (6, 0.0, 1.0, None, "x"), (None, 1.0, 1.0, 1, "x"), (7, 1.0, -180.0, 1, "x")]
    df = spark.createDataFrame(rows, "point_id long, lat double, lon double, version long, r string")
    assert {tuple(r) for r in sp.current_locations(df).collect()} == {(1, 2.0, 2.0), (6, 0.0, 1.0), (7, 1.0, -180.0)}


def inside(p, rings):
    n = 0
    for ring in rings:
        odd = False
        for (y1, x1), (y2, x2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y1 > p[1]) != (y2 > p[1]) and p[2] < (x2 - x1) * (p[1] - y1) / (y2 - y1) + x1:
                odd = not odd
        n += odd
    return n % 2 == 1


@pytest.mark.parametrize("limit", [10**9, 0])
def test_areas_as_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(sp, "BROADCAST_EDGES", limit)
    monkeypatch.setattr(sp, "HOT_POINTS", 50)
    rnd, areas, rows = random.Random(5), {}, []
    for a in range(40):
        cy, cx, r = rnd.uniform(-60, 60), rnd.uniform(-170, 170), rnd.choice([0.003, 0.05, 1, 20])
        ring = lambda s, cy=cy, cx=cx: [(cy + s * math.sin(k / 9 * 2 * math.pi) * rnd.uniform(0.5, 1), cx + s * math.cos(k / 9 * 2 * math.pi) * rnd.uniform(0.5, 1)) for k in range(9)]
        areas[a] = [ring(r), ring(r * 0.4)]
        for n, vs in enumerate(areas[a]):
            rows += [(a, n, i, y, x) for i, (y, x) in enumerate(vs)]
    rows += rows[:30] + [(99, 0, 0, None, 1.0), (98, 0, 0, 1.0, 1.0)]
    rnd.shuffle(rows)
    points = [(i, rnd.uniform(-70, 70), rnd.uniform(-180, 180)) for i in range(300)] + [(1000 + i, y + 1e-4, x + 1e-4) for i, (y, x) in enumerate(v for a in areas.values() for v in a[1])] + [(5000 + i, areas[0][0][0][0], areas[0][0][0][1] - 1e-5) for i in range(80)]
    got = {tuple(r) for r in sp.containing_areas(frame(spark, points), spark.createDataFrame(rows, "area_id long, ring_no int, vertex_no int, lat double, lon double")).collect()}
    want = {(p[0], a) for p in points for a, rings in areas.items() if inside(p, rings)}
    assert got == want and len(want) > 50


def test_empty_tables(spark):
    none = frame(spark, [])
    areas = spark.createDataFrame([], "area_id long, ring_no int, vertex_no int, lat double, lon double")
    assert sp.near_pairs(none, 25).count() == 0 and sp.containing_areas(none, areas).count() == 0 and sp.containing_areas(frame(spark, [(1, 2.0, 3.0)]), areas).count() == 0


def test_distance(spark):
    one = spark.range(1).select(sp.great_circle_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("m")).first().m
    assert one == pytest.approx(math.pi * sp.EARTH_M)


def test_classes_and_their_pairs_say_what_all_pairs_say(spark):
    rows = [(i, 50.0 + (i % 4) * 1e-4, 8.0) for i in range(40)] + [(100, 50.0, 8.5), (101, 0.0, 8.0), (102, -0.0, 8.0)]
    points = spark.createDataFrame(rows, "point_id long, lat double, lon double")
    of = {r.point_id: r.class_id for r in sp.co_located(points).collect()}
    near = {(r.left_id, r.right_id) for r in sp.near_pairs(sp.class_points(points), 12.0).collect()}
    said = {(a, b) for a in of for b in of if a < b and (of[a] == of[b] or tuple(sorted((of[a], of[b]))) in near)}
    assert said == {(r.left_id, r.right_id) for r in sp.near_pairs(points, 12.0).collect()} and len(of) == len(rows)


def test_radius_zero(spark):
    points = spark.createDataFrame([(1, 50.0, 8.0), (2, 50.0, 8.0), (3, 50.0, 8.1)], "point_id long, lat double, lon double")
    assert [(r.left_id, r.right_id) for r in sp.near_pairs(points, 0.0).collect()] == [(1, 2)]
    with pytest.raises(ValueError, match="radius"):
        sp.near_pairs(points, -1.0)

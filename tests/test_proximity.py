import math
import random
from math import atan2, cos, radians, sin, sqrt

import pytest
from hypothesis import given, settings, strategies as st

from seawarden import fixed_values as fixed
from seawarden.functions.geo import distance_km
from seawarden.operators import cells, proximity
from seawarden.sources import reference, schemas
from tests.conftest import plan_of

COORDINATES = "a double, b double, c double, d double"


def haversine(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(h)))


def distances(spark, points):
    df = spark.createDataFrame(points, COORDINATES)
    return [r.km for r in df.selectExpr(f"{distance_km('a', 'b', 'c', 'd')} AS km").collect()]


points = st.tuples(st.floats(-89, 89), st.floats(-179, 179), st.floats(-89, 89), st.floats(-179, 179))


@settings(max_examples=8, deadline=None)
@given(st.lists(points, min_size=1, max_size=30))
def test_distance(spark, chosen):
    there = distances(spark, chosen)
    back = distances(spark, [(c, d, a, b) for a, b, c, d in chosen])
    assert there == pytest.approx([haversine(*p) for p in chosen], abs=0.01)
    assert there == pytest.approx(back, abs=1e-6)
    assert distances(spark, [(a, b, a, b) for a, b, _, _ in chosen]) == [0.0] * len(chosen)


def test_null_in_null_out(spark):
    assert distances(spark, [(None, 1.0, 2.0, 3.0), (1.0, 1.0, 2.0, None)]) == [None, None]


def test_unknown_port_keeps_the_vessel(spark):
    df = spark.createDataFrame([(1, "Nowhere", 30.0, -90.0), (2, None, 30.0, -90.0), (3, "Houston", 29.35, -94.85)], "MMSI long, PortZone string, latest_lat double, latest_lon double")
    got = {r.MMSI: r.distance_to_port_km for r in proximity.add_port_distance(df, reference.port_zones(spark)).collect()}
    assert got == {1: None, 2: None, 3: 0.0}


def boxes_holding(lat, lon, boxes):
    held = [(haversine(lat, lon, b[1], b[2]), b[0]) for b in boxes if b[3] <= lat <= b[4] and b[5] <= lon <= b[6]]
    return min(held)[1] if held else None


@pytest.mark.parametrize("cell", [1.0, 0.3, 25.0])
def test_boxes_equal_brute_force(spark, cell):
    pick = random.Random(7)
    boxes = []
    for i in range(40):
        lat, lon = pick.uniform(20, 60), pick.uniform(-130, -65)
        high, wide = pick.uniform(0.1, 6), pick.uniform(0.1, 6)
        boxes.append((f"P{i:02d}", lat + high / 2, lon + wide / 2, lat, lat + high, lon, lon + wide, ""))
    at = [(i, pick.uniform(20, 60), pick.uniform(-130, -65)) for i in range(400)]
    # corners and edges count as inside
    at += [(1000 + i, b[3], b[5]) for i, b in enumerate(boxes)] + [(2000 + i, b[4], b[6]) for i, b in enumerate(boxes)]
    df = spark.createDataFrame(at, "id long, LAT double, LON double")
    table = spark.createDataFrame(boxes, schemas.PORT_ZONES)
    got = {r.id: r.box_port for r in proximity.assign_box(df, table, cell_degrees=cell).collect()}
    assert got == {i: boxes_holding(lat, lon, boxes) for i, lat, lon in at}


def test_equal_distance_goes_by_name(spark):
    boxes = [("B", 30.0, -90.0, 29.0, 31.0, -91.0, -89.0, ""), ("A", 30.0, -90.0, 29.5, 30.5, -91.0, -89.0, "")]
    df = spark.createDataFrame([(30.1, -90.1)], "LAT double, LON double")
    assert proximity.assign_box(df, spark.createDataFrame(boxes, schemas.PORT_ZONES)).first().box_port == "A"


def test_port_lookup_moves_no_positions(spark, tmp_path):
    """Ports are small enough to be sent to the positions; nothing hints so, their size is known."""
    from tests.conftest import plan_of

    df = spark.range(10).selectExpr("30 + id / 100 AS LAT", "-90 - id / 100 AS LON")
    plan = plan_of(proximity.assign_box(df, reference.port_zones(spark)))
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
    assert len(fixed.PORT_ZONES) == 6


def test_dense_boxes_stay_rows(spark):
    """100,000 overlapping boxes: the same ports as by comparison, and no list of boxes in the plan."""
    boxes = spark.range(100000).selectExpr(
        "concat('B', id) AS port_zone", "30.5D + id % 317 / 1000 AS center_lat", "-80.5D + id % 311 / 1000 AS center_lon",
        "30.1D AS lat_min", "30.2D + id % 700 / 1000 AS lat_max", "-80.9D AS lon_min", "-80.8D + id % 600 / 1000 AS lon_max",
    )
    spots = [(i, 30.0 + i * 0.09, -80.95 + i * 0.07) for i in range(12)] + [(99, 30.45, -80.53), (99, 30.45, -80.53)]
    df = spark.createDataFrame(spots, "MMSI long, LAT double, LON double")
    found = proximity.assign_box(df, boxes)
    assert "collect_list" not in found._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.MMSI, r.box_port) for r in found.collect())
    listed = boxes.collect()

    def nearest(lat, lon):
        held = [b for b in listed if b.lat_min <= lat <= b.lat_max and b.lon_min <= lon <= b.lon_max]
        return min(((km(lat, lon, b.center_lat, b.center_lon), b.port_zone) for b in held), default=(0, None))[1]

    def km(a, b, c, d):
        h = sin(radians(c - a) / 2) ** 2 + cos(radians(a)) * cos(radians(c)) * sin(radians(d - b) / 2) ** 2
        return round(2 * 6371 * atan2(sqrt(h), sqrt(1 - h)), 9)

    assert [name for name, _ in got] == sorted(i for i, _, _ in spots)
    centres = {b.port_zone: b for b in listed}
    for (i, lat, lon), (_, port) in zip(sorted(spots), got):
        expected = nearest(lat, lon)
        assert (port is None) == (expected is None)
        if port:
            at, best = centres[port], centres[expected]
            assert km(lat, lon, at.center_lat, at.center_lon) == km(lat, lon, best.center_lat, best.center_lon)


def around(lon, low, high):
    return low <= lon <= high if low <= high else lon >= low or lon <= high


@pytest.mark.parametrize("cell", [1.0, 0.25, 40.0])
def test_boxes_of_any_size_and_across_the_date_line(spark, cell):
    pick = random.Random(3)
    boxes = []
    for i in range(60):
        lat, lon = pick.uniform(-80, 80), pick.uniform(-180, 180)
        high, wide = pick.choice([0.01, 0.4, 3, 9]), pick.choice([0.01, 0.7, 5, 60, 150])
        low, top = lon - wide, lon + wide
        boxes.append((f"P{i:02d}", lat, lon, max(lat - high, -90.0), min(lat + high, 90.0), low + 360 if low < -180 else low, top - 360 if top > 180 else top, ""))
    boxes += [("world", 0.0, 0.0, -90.0, 90.0, -180.0, 180.0, ""), ("line", 10.0, 180.0, 5.0, 15.0, 179.0, -179.0, "")]
    boxes += [("none", 0.0, 0.0, 5.0, 1.0, 0.0, 1.0, ""), ("unknown", None, None, None, None, None, None, "")]
    at = [(i, pick.uniform(-90, 90), pick.uniform(-180, 180)) for i in range(400)]
    at += [(1000 + i, b[3], b[5]) for i, b in enumerate(boxes[:60])] + [(2000 + i, b[4], b[6]) for i, b in enumerate(boxes[:60])]
    at += [(3000, 10.0, 180.0), (3001, 10.0, -180.0), (3002, 10.0, 179.5), (3003, 10.0, -179.5), (3004, None, 1.0)]
    df = spark.createDataFrame(at, "id long, LAT double, LON double")
    real = [b for b in boxes if b[1] is not None]

    def best(lat, lon):
        held = [(haversine(lat, lon, b[1], b[2]), b[0]) for b in real if b[3] <= lat <= b[4] and around(lon, b[5], b[6])]
        return min(held)[1] if held else None

    got = {r.id: r.box_port for r in proximity.assign_box(df, spark.createDataFrame(boxes, schemas.PORT_ZONES), cell_degrees=cell).collect()}
    assert got == {i: None if lat is None else best(lat, lon) for i, lat, lon in at}
    assert got[3002] == got[3003] == "line" and got[3004] is None


def test_a_box_is_listed_in_four_cells_at_most(spark):
    boxes = [(f"B{i}", 0.0, 0.0, -80.0 + i, -80.0 + i + 0.3 * 1.3**i % 90, -170.0, -170.0 + 0.01 * 1.5**i % 340, "") for i in range(25)]
    listed = cells.cover(spark.createDataFrame(boxes, schemas.PORT_ZONES), 1.0).groupBy("port_zone").count().collect()
    assert len(listed) == 25 and max(r["count"] for r in listed) <= 4


def test_no_boxes(spark):
    df = spark.createDataFrame([(30.1, -90.1)], "LAT double, LON double")
    assert proximity.assign_box(df, spark.createDataFrame([], schemas.PORT_ZONES)).first().box_port is None


def test_circles_equal_all_pairs(spark):
    """Circles of any size, at the poles and across the date line."""
    pick = random.Random(5)
    circles = [(f"C{i}", pick.uniform(-90, 90), pick.uniform(-180, 180), pick.choice([0.0, 1.0, 30.0, 400.0, 3000.0])) for i in range(80)]
    circles += [("north", 89.9, 10.0, 500.0), ("south", -90.0, 0.0, 50.0), ("line", 0.0, 179.99, 100.0), ("half", 10.0, 20.0, 11000.0)]
    circles += [("all", 1.0, 2.0, 30000.0), ("unknown", None, 1.0, 5.0), ("endless", 1.0, 1.0, None)]
    at = [(i, pick.uniform(-90, 90), pick.uniform(-180, 180)) for i in range(300)] + [(400 + i, c[1], c[2]) for i, c in enumerate(circles[:80])]
    at += [(900, 0.0, -179.9), (901, 90.0, 0.0), (902, -90.0, 77.0), (903, 89.0, -170.0), (904, None, 0.0)]
    df = spark.createDataFrame(at, "id long, latest_lat double, latest_lon double")
    table = spark.createDataFrame(circles, "name string, center_lat double, center_lon double, radius_km double")
    found = proximity.within_radius(df, table)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    got = sorted((r.id, r.name) for r in found.collect())
    expected = [
        (i, name)
        for i, lat, lon in at
        for name, a, b, radius in circles
        if lat is not None and a is not None and radius is not None and haversine(lat, lon, a, b) <= radius + 1e-9
    ]
    assert got == sorted(expected)

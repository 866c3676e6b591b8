import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from urbanlake.operators import spatial

ZONES = [
    (1, "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"),
    (2, "MULTIPOLYGON (((20 0, 22 0, 22 2, 20 2, 20 0)), ((30 0, 32 0, 31 2, 30 0)))"),
    (3, "POLYGON ((8 8, 12 8, 12 12, 8 12, 8 8))"),
    (4, None),
]
POINTS = [
    ("inside", 1.0, 1.0, [1]),
    ("hole", 5.0, 5.0, [None]),
    ("hole_edge", 4.0, 5.0, [None]),
    ("edge", 0.0, 5.0, [None]),
    ("corner", 10.0, 0.0, [None]),
    ("overlap", 9.0, 9.0, [1, 3]),
    ("edge_of_one", 10.0, 9.0, [3]),
    ("second_part", 31.0, 1.0, [2]),
    ("between_parts", 25.0, 1.0, [None]),
    ("beside_vertex", 29.0, 0.0, [None]),
    ("far", -50.0, 70.0, [None]),
]


@pytest.mark.parametrize("cell", [None, 0.7, 5.0, 500.0])
def test_within(spark, cell):
    points = spark.createDataFrame([*(p[:3] for p in POINTS), ("nowhere", None, 1.0), ("twin", 1.0, 1.0)], "id string, lon double, lat double")
    zones = spark.createDataFrame(ZONES, "zone int, wkt string")
    out = spatial.within_join(points, zones, "lon", "lat", "wkt", cell)
    want = [*((p[0], z) for p in POINTS for z in p[3]), ("nowhere", None), ("twin", 1)]
    assert rows(out, "id", "zone") == sorted(want, key=repr)


def test_cells_carry_no_edges_and_no_hint_is_given(spark):
    points = spark.createDataFrame([p[:3] for p in POINTS], "id string, lon double, lat double")
    text = plan(spatial.within_join(points, spark.createDataFrame(ZONES, "zone int, wkt string"), "lon", "lat", "wkt"))
    exploded = [line for line in text.split("\n") if "Generate explode(sequence" in line]
    assert exploded and not any("_edges" in line for line in exploded)
    assert "ResolvedHint" not in text and "strategy=broadcast" not in text


def test_zones_of_all_sizes_meet_few_cells(spark):
    sizes = [10.0**k for k in range(-6, 3)]
    zones = [(i, f"POLYGON (({i} {i}, {i + s} {i}, {i + s} {i + s}, {i} {i + s}, {i} {i}))") for i, s in enumerate(sizes)]
    known = spatial.numbered_zones(spark.createDataFrame([*zones, (99, "POLYGON ((1 1, 1 1, 1 1))")], "zone int, wkt string"), "wkt")
    base, levels, level = spatial.grid_levels(known)
    assert base == pytest.approx(1e-6, rel=1e-6) and len(levels) <= 10
    for row in known.select("_x0", "_x1", level.alias("level")).collect():
        cell = base * spatial.LEVEL_FACTOR**row.level
        assert row._x1 // cell - row._x0 // cell <= 1


def inside(x, y, ring):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * (y - y1) / (y2 - y1):
            hit = not hit
    return hit


def test_random_polygons_against_brute_force(spark):
    rnd = random.Random(7)
    rings = []
    for i in range(30):
        cx, cy, size = rnd.uniform(-20, 20), rnd.uniform(-20, 20), rnd.choice([0.5, 2, 15])
        ring = [(cx + rnd.uniform(-size, size), cy + rnd.uniform(-size, size)) for _ in range(rnd.randint(3, 9))]
        rings.append([*ring, ring[0]])
    zones = [(i, "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in r) + "))") for i, r in enumerate(rings)]
    points = [(i, rnd.uniform(-25, 25), rnd.uniform(-25, 25)) for i in range(400)]
    want = []
    for i, x, y in points:
        hits = [z for z, r in enumerate(rings) if inside(x, y, r)]
        want += [(i, z) for z in hits or [None]]
    out = spatial.within_join(
        spark.createDataFrame(points, "id int, lon double, lat double"),
        spark.createDataFrame(zones, "zone int, wkt string"),
        "lon",
        "lat",
        "wkt",
    )
    assert rows(out, "id", "zone") == sorted(want, key=repr)


def test_sensors_are_deduplicated_first(spark):
    locations = spark.createDataFrame(
        [(1, 7, "pm25", 1.0, 1.0, "2024-01-01"), (1, 7, "pm25", 1.0, 50.0, "2024-02-01"), (1, 8, "pm25", 9.0, 9.0, "2024-01-01")],
        "location_id bigint, sensor_id bigint, p_name string, latitude double, longitude double, loaded_at string",
    )
    zones = spark.createDataFrame(ZONES, "zone_id int, geometry_wkt string")
    zones = zones.withColumns({"zone_name": F.lit("z"), "borough": F.lit("b")})
    mapped = spatial.sensor_zones(locations, zones)
    assert rows(mapped, "sensor_id", "zone_id") == [(7, None), (8, 1), (8, 3)]
    assert tuple(spatial.map_stats(mapped).first()) == (2, 1, 3)


def test_a_hot_position_is_dealt_to_many_tasks(spark, monkeypatch):
    """Tasks follow the rows that the join makes, not the bytes of the points."""
    monkeypatch.setattr(spatial, "TASK_ROWS", 4000)
    points = spark.range(2000).select("id", F.lit(1.0).alias("lon"), F.lit(1.0).alias("lat"))
    squares = [(i, f"POLYGON ((0 0, {2 + i} 0, {2 + i} {2 + i}, 0 {2 + i}, 0 0))") for i in range(20)]
    out = spatial.within_join(points, spark.createDataFrame(squares, "zone int, wkt string"), "lon", "lat", "wkt")
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40000 and max(sizes) <= 16000
    assert out.distinct().count() == 40000


def test_no_zones(spark):
    points = spark.createDataFrame([("a", 1.0, 1.0)], "id string, lon double, lat double")
    zones = spark.createDataFrame([], "zone int, wkt string")
    assert rows(spatial.within_join(points, zones, "lon", "lat", "wkt"), "id", "zone") == [("a", None)]

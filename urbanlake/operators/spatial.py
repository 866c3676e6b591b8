"""Point-in-polygon joins over WKT zones."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from urbanlake.operators.merge import dedupe_latest
from urbanlake.session import stage

LEVEL_FACTOR = 8
#: Rows that a task of the last join makes, on average; a key makes a quarter of that at most.
TASK_ROWS = 1 << 21
#: Degrees; zones that are smaller still lie on level 0.
SMALLEST_CELL = 1e-9


def polygon_edges(wkt: Column) -> Column:
    """Edges of all rings of a POLYGON or MULTIPOLYGON as (x1, y1, x2, y2) structs."""
    rings = F.transform(
        F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1)),
        lambda ring: F.transform(
            F.split(ring, ","),
            lambda point: F.struct(
                F.split(F.trim(point), r"\s+")[0].cast("double").alias("x"),
                F.split(F.trim(point), r"\s+")[1].cast("double").alias("y"),
            ),
        ),
    )

    def ring_edges(ring: Column) -> Column:
        heads, tails = F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1)
        return F.zip_with(
            heads, tails, lambda a, b: F.struct(a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2"))
        )

    return F.flatten(F.transform(rings, ring_edges))


def strictly_within(x: Column, y: Column, edges: Column) -> Column:
    """True for a point in the interior: an odd number of crossings and on no edge."""
    crossings = F.filter(
        edges,
        lambda e: ((e.y1 > y) != (e.y2 > y)) & (x < e.x1 + (e.x2 - e.x1) * (y - e.y1) / F.nullif(e.y2 - e.y1, F.lit(0.0))),
    )
    on_edge = F.exists(
        edges,
        lambda e: ((x - e.x1) * (e.y2 - e.y1) == (y - e.y1) * (e.x2 - e.x1))
        & x.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2))
        & y.between(F.least(e.y1, e.y2), F.greatest(e.y1, e.y2)),
    )
    return (F.size(crossings) % 2 == 1) & ~on_edge


def numbered_zones(zones: DataFrame, wkt: str) -> DataFrame:
    """The zones with a number, their edges, and the box ``_x0, _x1, _y0, _y1`` around them; parsed once and stored."""
    attributes = [c for c in zones.columns if c != wkt]
    parsed = zones.withColumn("_edges", polygon_edges(F.col(wkt))).select(
        *attributes,
        "_edges",
        F.array_min(F.transform("_edges", lambda e: e.x1)).alias("_x0"),
        F.array_max(F.transform("_edges", lambda e: e.x1)).alias("_x1"),
        F.array_min(F.transform("_edges", lambda e: e.y1)).alias("_y0"),
        F.array_max(F.transform("_edges", lambda e: e.y1)).alias("_y1"),
    )
    return stage(parsed.withColumn("_zone", F.monotonically_increasing_id()), "zones")


def grid_levels(boxes: DataFrame, cell_deg: float | None = None) -> tuple[float, list[int], Column]:
    """The cell size of level 0, the levels that have zones, and the expression for a zone's level.

    Cells grow ``LEVEL_FACTOR`` times from level to level, and a zone lies on the first whose cells are no smaller than its
    longer side: so it meets two cells a side at most, however its size compares with the others. Level 0 is that of the
    smallest zone, unless ``cell_deg`` gives its size.
    """
    side = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"))
    smallest = cell_deg or boxes.agg(F.min(F.when(side > 0, side))).first()[0] or 1.0
    smallest = max(smallest, SMALLEST_CELL)
    steps = F.log(side / F.lit(smallest)) / F.lit(math.log(LEVEL_FACTOR))
    level = F.when(side > F.lit(smallest), F.ceil(steps)).otherwise(0).cast("int")
    # At most one row per level, of which there are few: log(360 / SMALLEST_CELL) / log(LEVEL_FACTOR).
    found = [row[0] for row in boxes.where("_x0 is not null").select(level.alias("level")).distinct().collect()]
    return smallest, sorted(found), level


def within_join(
    points: DataFrame, zones: DataFrame, lon: str, lat: str, wkt: str, cell_deg: float | None = None
) -> DataFrame:
    """Points left-joined to the zones that strictly contain them.

    Zones lie on a grid of several levels by their size, under four cells at most; a position has one key per level, and
    meets the zones by an equi-join on level and cell, with their boxes as its condition. Cells carry boxes only: the edges
    are joined to what is left, by the zone's number, for the exact test. Every position is decided once, whatever the
    number of points that share it, and points take the zones of their position. Overlapping zones give one row each; an
    unmatched point, or one without coordinates, keeps one row.

    The result has the points of a position times its zones, so its size does not follow from the bytes that are shuffled.
    Both numbers are known by then: a position's points are dealt to as many parts as its rows need, each part meets
    the position's zones, and the parts are dealt to as many tasks as all rows need (``TASK_ROWS``).
    """
    attributes = [c for c in zones.columns if c != wkt]
    known = numbered_zones(zones, wkt)
    base, levels, level = grid_levels(known, cell_deg)

    def index(value: Column, level: Column) -> Column:
        return F.floor(value / (F.lit(base) * F.pow(F.lit(float(LEVEL_FACTOR)), level)))

    def span(low: str, high: str) -> Column:
        return F.explode(F.sequence(index(F.col(low), F.col("_level")), index(F.col(high), F.col("_level"))))

    boxes = known.where("_x0 is not null").select("_zone", "_x0", "_x1", "_y0", "_y1", level.alias("_level"))
    cells = boxes.withColumn("_cx", span("_x0", "_x1")).withColumn("_cy", span("_y0", "_y1"))
    x, y = F.col("_x"), F.col("_y")
    placed = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    counted = placed.groupBy(F.col(lon).cast("double").alias("_x"), F.col(lat).cast("double").alias("_y")).agg(F.count("*").alias("_points"))
    spots = stage(counted.withColumn("_spot", F.monotonically_increasing_id()), "spots")
    on_levels = spots.withColumn("_level", F.explode(F.array(*(F.lit(n) for n in levels)).cast("array<int>")))
    on_levels = on_levels.select("_spot", "_x", "_y", "_level", index(x, F.col("_level")).alias("_cx"), index(y, F.col("_level")).alias("_cy"))
    in_box = (x > F.col("_x0")) & (x < F.col("_x1")) & (y > F.col("_y0")) & (y < F.col("_y1"))
    near = on_levels.join(cells, ["_level", "_cx", "_cy"]).where(in_box).select("_spot", "_x", "_y", "_zone")
    shapes = known.select("_zone", "_edges", *attributes)
    within = near.join(shapes, "_zone").where(strictly_within(x, y, F.col("_edges")))
    hits = stage(within.select("_spot", *(F.col(c).alias(f"_z_{c}") for c in attributes)), "hits")
    counts = spots.join(hits.groupBy("_spot").agg(F.count("*").alias("_zones")), "_spot")
    parts = F.least("_points", F.ceil(F.col("_points") * F.col("_zones") * 4 / TASK_ROWS)).cast("int")
    counts = stage(counts.select("_spot", "_x", "_y", "_points", "_zones", parts.alias("_parts")), "spot-parts")
    made = counts.agg(F.sum(F.col("_points") * F.col("_zones"))).first()[0] or 0
    tasks = int(made) // TASK_ROWS + 1

    known_spots = counts.select("_spot", "_x", "_y", "_parts")
    dealt = placed.join(known_spots, (F.col(lon) == x) & (F.col(lat) == y), "left")
    # A part follows from the row's values, so that a repeated task deals its rows alike; maps have no hash.
    values = [f.name for f in points.schema.fields if "map<" not in f.dataType.simpleString()]
    part = F.pmod(F.xxhash64(*values), F.col("_parts")).cast("int")
    mine = dealt.where("_spot is not null").withColumn("_part", part).repartition(tasks, "_spot", "_part")
    zones_of = hits.join(counts.select("_spot", "_parts"), "_spot").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    zones_of = zones_of.drop("_parts").repartition(tasks, "_spot", "_part")
    found = mine.join(zones_of, ["_spot", "_part"]).select(*points.columns, *(F.col(f"_z_{c}").alias(c) for c in attributes))
    nothing = [F.lit(None).cast(zones.schema[c].dataType).alias(c) for c in attributes]
    lonely = dealt.where("_spot is null").select(*points.columns, *nothing)
    # Points without coordinates would all meet in one task of a join.
    nowhere = points.where(F.col(lon).isNull() | F.col(lat).isNull()).select("*", *nothing)
    return found.unionByName(lonely).unionByName(nowhere)


def sensor_zones(locations: DataFrame, zones: DataFrame, cell_deg: float | None = None) -> DataFrame:
    """The latest position of each sensor with its zone, null when it has none."""
    cols = ["location_id", "sensor_id", "p_name", "latitude", "longitude", "loaded_at"]
    latest = dedupe_latest(locations.select(*cols), ["sensor_id"], ["loaded_at"], ["location_id", "p_name"])
    shapes = zones.select("zone_id", "zone_name", "borough", "geometry_wkt")
    return within_join(latest, shapes, "longitude", "latitude", "geometry_wkt", cell_deg).select(
        "sensor_id", "location_id", "p_name", "latitude", "longitude", "zone_id", "zone_name", "borough", "loaded_at"
    )


def map_stats(df: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Mapped, unmapped and total rows."""
    return df.agg(
        F.count_if(F.col(zone).isNotNull()).alias("mapped"),
        F.count_if(F.col(zone).isNull()).alias("unmapped"),
        F.count("*").alias("total_sensors"),
    )

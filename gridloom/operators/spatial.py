"""Points near other points, and the areas that contain them: grid hashing, then exact checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.skew import salted_join
from gridloom.session import cut

#: Mean radius of the earth in metres.
EARTH_M = 6_371_008.8
#: A grid cell's edge as a multiple of the search radius; a ball of the radius touches 1 to 8 cells, 3.4 on average.
CELL_OF_RADIUS = 4.0
#: Least edge of a cell in metres; with it a cell's number fits an int.
LEAST_CELL_M = 0.01
#: Finest cell of the area grid in degrees; level n has cells of 2^n times that, an area is filed at the level where it covers few.
AREA_CELL_DEG = 1 / 64
AREA_CELLS = 4
#: Filed border edges (as often as they are filed, about 40 bytes each) up to which the area side is broadcast; beyond it is joined by shuffle.
BROADCAST_EDGES = 1_000_000
#: A cell is hot from this share of the points (so there are at most its inverse) and this many points on.
HOT_SHARE, HOT_POINTS = 1 / 1000, 2000


def current_locations(points: DataFrame) -> DataFrame:
    """(point_id, lat, lon): of each point_id the row of the greatest version, if that row has a location.

    A location needs lat within -90..90 and lon within -180..180, neither null nor NaN, not both 0. A null version is the
    least; of rows equal in version the greatest (lat, lon) counts. Rows without point_id are left out: they name no point.
    """
    rows = points.filter(F.col("point_id").isNotNull()).select("point_id", F.struct(F.coalesce("version", F.lit(-(2**63))).alias("v"), "lat", "lon").alias("r"))
    top = rows.groupBy("point_id").agg(F.max("r").alias("r")).select("point_id", "r.lat", "r.lon")
    return top.filter(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180) & ~F.isnan("lat") & ~F.isnan("lon") & ~((F.col("lat") == 0) & (F.col("lon") == 0)))


def great_circle_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres by the haversine formula, exact enough at small and large distances."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def _salts(hot_at: float) -> Column:
    """Over how many tasks a cell is spread: 1 for a cell that is not hot (n is null)."""
    return F.when(F.col("n").isNull(), F.lit(1)).otherwise(F.ceil(F.col("n") / hot_at) + 1).cast("int")


def near_pairs(points: DataFrame, radius_m: float) -> DataFrame:
    """(left_id, right_id): ids of located points at most radius_m apart, smaller id first, each pair once.

    points: (point_id, lat, lon), one row per point. The grid lies in space, not on the map: a point's cell is that of its
    place on the sphere in x, y, z, so that poles and the 180th meridian need no special case. A chord is never longer than
    its arc, hence a partner lies in a cell that the ball around the point touches. The smaller id goes to those cells, the
    other one only to its own: each pair meets once. Hot cells are split: their visitors are spread over salts.
    """
    if not radius_m >= 0:
        raise ValueError("a radius is at least 0")
    edge = max(CELL_OF_RADIUS * radius_m, LEAST_CELL_M)
    lat, lon = F.radians("lat"), F.radians("lon")
    axes = {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}
    placed = points.select("point_id", "lat", "lon", *((EARTH_M * c).alias(k) for k, c in axes.items()))
    reach = radius_m * (1 + 1e-9) + 1e-6
    cell = lambda c: F.floor(c / edge).cast("int")

    own = placed.select(F.col("point_id").alias("right_id"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), *(cell(F.col(k)).alias(f"c{k}") for k in axes))
    visits = placed.select(F.col("point_id").alias("left_id"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"), *axes)
    for k in axes:
        visits = visits.withColumn(f"c{k}", F.explode(F.array_distinct(F.array(cell(F.col(k) - reach), cell(F.col(k) + reach)))))
    cells = [f"c{k}" for k in axes]

    total = own.count()
    hot_at = max(HOT_POINTS, total * HOT_SHARE)
    hot = own.groupBy(*cells).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= hot_at)
    salts = _salts(hot_at)
    hot = F.broadcast(hot)
    own = own.join(hot, cells, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("n")
    visits = visits.join(hot, cells, "left").withColumn("salt", F.pmod(F.xxhash64("left_id"), salts).cast("int")).drop("n", *axes)
    met = visits.join(own, [*cells, "salt"]).filter(F.col("left_id") < F.col("right_id"))
    return met.filter(great_circle_m(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")) <= radius_m).select("left_id", "right_id")


def co_located(points: DataFrame) -> DataFrame:
    """(point_id, class_id): points at exactly the same place are one class, named by its least id.

    Pairs between classes (near_pairs of class_points) and this membership say what near_pairs says, without a pair for every
    two points of one place: points are near if their classes are the same or near.
    """
    classes = class_points(points).select(F.col("point_id").alias("class_id"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    places = points.select("point_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    return salted_join(places, classes, ["_lat", "_lon"]).select("point_id", "class_id")


def class_points(points: DataFrame) -> DataFrame:
    """(point_id, lat, lon): the least point of each place. -0.0 and 0.0 are the same place."""
    return points.groupBy("lat", "lon").agg(F.min("point_id").alias("point_id")).select("point_id", "lat", "lon")


def border_edges(areas: DataFrame) -> DataFrame:
    """(area_id, y1, x1, y2, x2): the straight edges of all rings, joined by vertex_no and closed.

    Repeated rows count once; vertices without coordinates or number are left out.
    """
    v = areas.select("area_id", "ring_no", "vertex_no", "lat", "lon").dropna().distinct()
    ring = Window.partitionBy("area_id", "ring_no").orderBy("vertex_no", "lat", "lon")
    first = F.min(F.struct("vertex_no", "lat", "lon")).over(Window.partitionBy("area_id", "ring_no"))
    v = v.select("area_id", F.col("lat").alias("y1"), F.col("lon").alias("x1"), F.lead(F.struct("vertex_no", "lat", "lon")).over(ring).alias("next"), first.alias("first"))
    v = v.withColumn("to", F.coalesce("next", "first"))
    return v.select("area_id", "y1", "x1", F.col("to.lat").alias("y2"), F.col("to.lon").alias("x2"))


def containing_areas(points: DataFrame, areas: DataFrame) -> DataFrame:
    """(point_id, area_id): the point is inside an odd number of the area's rings.

    points: (point_id, lat, lon), one row per point. Each area is filed under the grid cells that its box covers, at the
    level where these are few, and in each cell with the edges that cross the cell's strip of latitude. A point looks up its
    cell at each level in use and counts the edges east of it: odd means inside (of an odd number of rings, because ring
    parities add up). The area side is broadcast if it is small, else the hot cells' points are spread over salts.
    """
    edges = border_edges(areas)
    box = edges.groupBy("area_id").agg(
        F.min(F.least("y1", "y2")).alias("south"), F.max(F.greatest("y1", "y2")).alias("north"),
        F.min(F.least("x1", "x2")).alias("west"), F.max(F.greatest("x1", "x2")).alias("east"), F.count(F.lit(1)).alias("n"),
    )
    span = F.greatest(F.col("north") - F.col("south"), F.col("east") - F.col("west"), F.lit(AREA_CELL_DEG))
    box = box.withColumn("level", F.greatest(F.lit(0), F.ceil(F.log2(span / (AREA_CELL_DEG * AREA_CELLS)))).cast("int"))
    use = box.groupBy("level").agg(F.sum("n").alias("n")).collect()  # at most 16 levels: a degree range has only that many doublings
    if not use:
        return points.select("point_id", F.lit(None).cast("long").alias("area_id")).limit(0)
    size = lambda level: F.lit(AREA_CELL_DEG) * F.pow(F.lit(2.0), level)
    at = lambda c, level: F.floor(c / size(level)).cast("int")

    level = F.col("level")
    strips = (
        edges.join(box.select("area_id", "level"), "area_id")
        .filter(F.col("y1") != F.col("y2"))
        .withColumn("iy", F.explode(F.sequence(at(F.least("y1", "y2"), level), at(F.greatest("y1", "y2"), level))))
        .groupBy("area_id", "level", "iy")
        .agg(F.collect_list(F.struct("y1", "x1", "y2", "x2")).alias("edges"))
    )
    strips = cut(strips.join(box.select("area_id", "west", "east"), "area_id").select("area_id", "level", "iy", "edges", at(F.col("west"), level).alias("x1"), at(F.col("east"), level).alias("x2")))
    n_filed = strips.agg(F.sum(F.size("edges") * (F.col("x2") - F.col("x1") + 1)).alias("n")).first().n
    filed = strips.withColumn("ix", F.explode(F.sequence("x1", "x2"))).select("level", "iy", "ix", "area_id", "edges")

    levels = F.array(*(F.lit(r.level) for r in use))
    looks = points.withColumn("level", F.explode(levels)).withColumn("iy", at(F.col("lat"), level)).withColumn("ix", at(F.col("lon"), level))
    key = ["level", "iy", "ix"]
    if (n_filed or 0) <= BROADCAST_EDGES:
        met = looks.join(F.broadcast(filed), key)
    else:
        total = looks.count()
        hot_at = max(HOT_POINTS, total * HOT_SHARE)
        hot = F.broadcast(looks.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= hot_at))
        salts = _salts(hot_at)
        a = looks.join(hot, key, "left").withColumn("salt", F.pmod(F.xxhash64("point_id"), salts).cast("int")).drop("n")
        b = filed.join(hot, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("n")
        met = a.join(b, [*key, "salt"])
    y, x = F.col("lat"), F.col("lon")
    crossed = F.size(F.filter("edges", lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])))
    return met.filter(crossed % 2 == 1).select("point_id", "area_id")

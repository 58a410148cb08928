"""Grid cells, distances and points of interest near listings.

Cells are squares of a latitude-longitude grid named by level and indices. They
stand in for hexagonal cells, for which no library is installed.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from heddle.plans.durable import Scratch
from heddle.plans.joins import sent_if_small

EARTH_KM = 6371.0088
#: Degrees of latitude in a kilometre.
KM = 1 / 111.195


def cell(latitude: Column, longitude: Column, level: int = 8) -> Column:
    """A cell of 180 / 2**(level + 5) degrees, null for null or impossible coordinates."""
    size = 180 / 2 ** (level + 5)
    inside = latitude.between(-90, 90) & longitude.between(-180, 180)
    return F.when(inside, F.concat(F.lit(f"{level}:"), F.floor((latitude + 90) / size).cast("string"), F.lit(":"), F.floor((longitude + 180) / size).cast("string")))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """The great-circle distance, null if any coordinate is."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    # least() would pass over a null
    return F.when(a.isNotNull(), 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(a))))


def with_precision(df: DataFrame, centroids: DataFrame, by: str) -> DataFrame:
    """``df`` with coordinates of its group's centroid where it has none, and ``geo_precision``: exact, district or null."""
    own = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    joined = df.join(centroids.select(by, F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon")), by, "left")
    return joined.select(
        *(c for c in df.columns if c not in ("latitude", "longitude")),
        F.when(own, F.col("latitude")).otherwise(F.col("_lat")).alias("latitude"),
        F.when(own, F.col("longitude")).otherwise(F.col("_lon")).alias("longitude"),
        F.when(own, "exact").when(F.col("_lat").isNotNull(), "district").alias("geo_precision"),
    )


def points_within(listings: DataFrame, points: DataFrame, key: str, radius_km: float = 1.0) -> DataFrame:
    """(key, poi_count, nearest_km) over the points within the radius of each listing; 0 and null without any.

    Grid-cell equi-join: bands of latitude as tall as the radius, each cut around
    the globe into cells as wide as the radius or wider there, so it holds at any
    latitude and across the date line. A listing looks into the cells beside its
    own in its band and the two next to it. Both have latitude and longitude.
    """
    tall = radius_km * KM * 1.001

    def cells(band: Column) -> Column:
        """How many cells a band has: their width fits its edge nearest a pole."""
        edge = F.least(F.greatest(F.abs(band), F.abs(band + 1)) * tall, F.lit(90.0))
        return F.greatest(F.floor(F.cos(F.radians(edge)) * (360 / tall)), F.lit(1))

    def place(longitude: Column, band: Column) -> Column:
        return F.pmod(F.floor((longitude + 180) / (360 / cells(band))), cells(band))

    lat, lon = F.col("latitude"), F.col("longitude")
    bands = F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: F.floor(lat / tall) + d)
    asked = listings.select(key, lat.alias("lat"), lon.alias("lon"), F.explode(bands).alias("y"))
    beside = F.array_distinct(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: F.pmod(place(F.col("lon"), F.col("y")) + d, cells(F.col("y")))))
    asked = asked.select(key, "lat", "lon", "y", F.explode(beside).alias("x"))
    placed = points.select(lat.alias("plat"), lon.alias("plon"), F.floor(lat / tall).alias("y")).withColumn("x", place(F.col("plon"), F.col("y")))
    met = asked.join(placed, ["y", "x"]).withColumn("km", haversine_km(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon"))).where(F.col("km") <= radius_km)
    found = met.groupBy(key).agg(F.count("*").alias("poi_count"), F.min("km").alias("nearest_km"))
    return listings.select(key).join(found, key, "left").select(key, F.coalesce("poi_count", F.lit(0)).cast("long").alias("poi_count"), "nearest_km")


def distance_km(latitude: Column, longitude: Column, place: tuple[float, float]) -> Column:
    """The distance to one fixed place, such as a city's centre; null for null coordinates."""
    return haversine_km(latitude, longitude, F.lit(float(place[0])), F.lit(float(place[1])))


#: Levels of the cubes that nearest points are searched in, each cut in four along an edge; level 2 has at most 64, level 20 an edge of 12 metres.
STEP, FINEST, LEAF = 2, 20, 64


def _cube(point: Column, level: int) -> Column:
    """The cube of level ``level``, of those that halve the unit sphere's box ``level`` times, that holds a point."""
    places = [F.least(F.floor((point[c] + 1) * 2 ** (level - 1)), F.lit(2**level - 1)).cast("long") for c in "xyz"]
    return F.shiftleft(places[0], 40).bitwiseOR(F.shiftleft(places[1], 20)).bitwiseOR(places[2])


def _unit(lat: Column, lon: Column) -> Column:
    """A place as a point of the unit sphere, where neither poles nor the date line matter."""
    lat, lon = F.radians(lat), F.radians(lon)
    return F.struct((F.cos(lat) * F.cos(lon)).alias("x"), (F.cos(lat) * F.sin(lon)).alias("y"), F.sin(lat).alias("z"))


def _at_least(p: Column, low: Column, high: Column) -> Column:
    """The squared chord from a point to a box."""
    return sum(F.pow(F.greatest(low[c] - p[c], p[c] - high[c], F.lit(0.0)), 2) for c in "xyz")


def _levels(points: DataFrame, leaf: int, scratch: Scratch) -> list[DataFrame]:
    """Occupied cubes from coarse to fine: (parent, cube, low, high, some), the box of their points and one of them.

    The finest level is the first of each second one whose cubes hold at most ``leaf`` points.
    """
    for finest in range(8, FINEST + 1, 2 * STEP):
        if not points.groupBy(_cube(F.col("p"), finest)).count().where(F.col("count") > leaf).limit(1).count():
            break

    def box(df: DataFrame, level: int, low: str, high: str, some: str) -> DataFrame:
        ends = [F.struct(*(end(f"{side}.{c}").alias(c) for c in "xyz")).alias(name) for end, side, name in ((F.min, low, "low"), (F.max, high, "high"))]
        found = df.groupBy(_cube(F.col(some), level).alias("cube")).agg(*ends, F.min(some).alias("some"))
        return scratch.keep(found.withColumn("parent", _cube(F.col("some"), level - STEP) if level > STEP else F.lit(0).cast("long")), "cubes")

    found = [box(points, finest, "p", "p", "p")]
    for level in range(finest - STEP, 0, -STEP):
        found.insert(0, box(found[0], level, "low", "high", "some"))
    return found


def _leaf_pairs(asked: DataFrame, placed: DataFrame, leaf: int) -> DataFrame:
    """(latitude, longitude, plat, plon): places with the points of the finest cubes that can hold the nearest one.

    Descends through cubes: of each level those stay that can hold a nearer point than one known.

    A place keeps the few cubes at about its nearest point's distance, however far that is.
    """
    scratch = Scratch(asked.sparkSession, "nearest")
    lat, lon = F.col("latitude"), F.col("longitude")
    points = scratch.keep(placed.distinct().withColumn("p", _unit(lat, lon)), "points")
    levels = _levels(points, leaf, scratch)
    rows = asked.withColumn("q", _unit(lat, lon)).withColumn("cube", F.lit(0).cast("long"))
    for cubes in levels:
        told = sent_if_small(cubes.withColumnRenamed("cube", "child"))
        met = rows.join(told, F.col("cube") == F.col("parent")).select(
            "latitude", "longitude", "q", F.col("child").alias("cube"), _at_least(F.col("q"), F.col("low"), F.col("high")).alias("least"), _at_least(F.col("q"), F.col("some"), F.col("some")).alias("most")
        )
        bound = F.min("most").over(Window.partitionBy("latitude", "longitude"))
        # chords are off by some 1e-16, a margin of micrometres
        rows = met.withColumn("bound", bound).where(F.sqrt("least") <= F.sqrt("bound") + 1e-12).select("latitude", "longitude", "q", "cube")
    finest = len(levels) * STEP
    leaves = points.select(_cube(F.col("p"), finest).alias("cube"), lat.alias("plat"), lon.alias("plon"))
    return rows.join(sent_if_small(leaves), "cube").select("latitude", "longitude", "plat", "plon")


def nearest_km(listings: DataFrame, points: DataFrame, key: str, few: int = 2000, leaf: int = LEAF) -> DataFrame:
    """(key, km): the distance to the nearest point, however far; null for null coordinates or without points.

    Few points are one array that every listing scans. Among more, distinct places
    descend through a tree of cubes around the globe (``_leaf_pairs``): work
    follows the places and the depth, not the points around them, for remote ones too.
    """
    known = "latitude is not null and longitude is not null"
    placed = points.where(known).select(F.col("latitude").cast("double"), F.col("longitude").cast("double"))
    if placed.limit(few + 1).count() <= few:
        spots = placed.agg(F.collect_list(F.struct("latitude", "longitude")).alias("spots"))
        km = F.array_min(F.transform("spots", lambda p: haversine_km(F.col("latitude"), F.col("longitude"), p["latitude"], p["longitude"])))
        return listings.join(F.broadcast(spots)).select(key, km.alias("km"))
    own = listings.select(key, F.col("latitude").cast("double"), F.col("longitude").cast("double"))
    pairs = _leaf_pairs(own.where(known).select("latitude", "longitude").distinct(), placed, leaf)
    km = haversine_km(F.col("latitude"), F.col("longitude"), F.col("plat"), F.col("plon"))
    found = pairs.groupBy("latitude", "longitude").agg(F.min(km).alias("km"))
    return own.join(found, ["latitude", "longitude"], "left").select(key, "km")

import random
from math import cos, radians

from pyspark.sql import functions as F

from heddle.operators import hexagons as h


def test_rings_distances_and_centres(spark):
    chance = random.Random(3)
    places = [(i, chance.uniform(-80, 80), chance.uniform(-170, 170)) for i in range(300)] + [(900, None, 1.0), (901, 91.0, 0.0), (902, float("nan"), 0.0)]
    df = spark.createDataFrame(places, "i int, lat double, lon double").withColumn("cell", h.hexagon(F.col("lat"), F.col("lon"), 9))
    assert [r["i"] for r in df.where("cell is null").orderBy("i").collect()] == [900, 901, 902]
    df = df.where("cell is not null")
    lat, lon = h.centre(F.col("cell"), 9)
    told = df.select(
        "*", *(h.ring(F.col("cell"), k, 9).alias(f"ring{k}") for k in range(3)), h.disk(F.col("cell"), 2, 9).alias("disk"), lat.alias("clat"), lon.alias("clon"),
        h.hexagon(lat, lon, 9).alias("again"),
    )
    for r in told.collect():
        assert [len(r[f"ring{k}"]) for k in range(3)] == [1, 6, 12] and len(set(r["disk"])) == 19 and r["again"] == r["cell"]
        # no place is further from its cell's centre than a corner, in the projection's kilometres
        east = radians(r["lon"] - r["clon"]) * h.EARTH_KM * cos(radians(16))
        assert abs(east) <= h.side_km(9) * 0.8661
    for k in range(3):
        steps = told.select("cell", F.explode(f"ring{k}").alias("other")).select(h.distance(F.col("cell"), F.col("other")).alias("d")).distinct().collect()
        assert [s["d"] for s in steps] == [k]


def test_neighbours_touch_and_cells_have_one_area(spark):
    """Counts of even places: a seventh of a disk's lie in its middle, at any latitude."""
    chance = random.Random(4)
    for south in (0, 40):
        places = [(chance.uniform(south, south + 0.4), chance.uniform(100, 100.4)) for _ in range(40_000)]
        df = spark.createDataFrame(places, "lat double, lon double").select(h.hexagon(F.col("lat"), F.col("lon"), 5).alias("cell"))
        here = {r["cell"]: r["count"] for r in df.groupBy("cell").count().collect()}
        rings = {r["cell"]: r["ring"] for r in df.select("cell").distinct().select("cell", h.ring(F.col("cell"), 1, 5).alias("ring")).collect()}
        inner = [c for c, ring in rings.items() if all(o in here and all(x in here for x in rings[o]) for o in ring)]
        assert inner
        for c in inner:
            assert abs(here[c] - sum(here[o] for o in rings[c]) / 6) < 0.25 * here[c]


def test_each_parent_has_four_children_worth_of_cells(spark):
    """Every cell of a patch has one parent, next to or around it, and a parent holds four cells on the whole."""
    cells = spark.range(40).crossJoin(spark.range(40).withColumnRenamed("id", "r")).select(F.concat_ws(":", F.lit("6"), F.col("id") - 20, F.col("r") - 20).alias("cell"))
    told = cells.select("cell", h.parent(F.col("cell"), 6).alias("parent"))
    lat, lon = h.centre(F.col("cell"), 6)
    assert told.where(h.hexagon(lat, lon, 5) != F.col("parent")).count() <= 0.5 * told.count()  # a centre on an edge may go either way
    sizes = [r["count"] for r in told.groupBy("parent").count().collect()]
    assert 3.5 < sum(sizes) / len(sizes) <= 4.5 and max(sizes) <= 7

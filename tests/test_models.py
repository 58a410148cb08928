import math

from pyspark.sql import functions as F

from heddle.functions import web
from heddle.operators import evaluation, geo, models


def test_split_and_leak_guard(spark):
    df = spark.createDataFrame([(1, "2026-01-01", "a"), (2, "2026-02-01", "a"), (3, "2026-02-01", "b"), (4, "2026-02-02", None)], "id int, day string, cluster string")
    train, test = evaluation.temporal_split(df, "day", "2026-02-01", "cluster")
    assert [r["id"] for r in train.collect()] == [1] and sorted(r["id"] for r in test.collect()) == [3, 4]


def test_baseline_and_errors(spark):
    df = spark.createDataFrame([("q1", 10.0, 100), ("q1", 20.0, 300), ("q1", 10.0, 110), ("q2", 0.0, 5)], "district string, area double, rent long")
    found = evaluation.median_baseline(df, "district", "area", "rent")
    assert sorted(r["predicted"] for r in found.collect() if r["predicted"] is not None) == [110.0, 110.0, 220.0]
    assert evaluation.errors(found, "rent", "predicted").first()["rows"] == 3


def test_concordance_against_pairs(spark):
    rows = [(d, d % 3 != 0, (d * 7) % 5) for d in (1, 2, 2, 3, 4, 4, 5, 8, 8)]
    found = evaluation.concordance_index(spark.createDataFrame(rows, "d int, e boolean, r int"), "d", "e", "r").first()
    pairs = [(a, b) for a in rows for b in rows if a[1] and a[0] < b[0]]
    assert found["comparable"] == len(pairs)
    assert (found["concordant"], found["tied"]) == (sum(a[2] > b[2] for a, b in pairs), sum(a[2] == b[2] for a, b in pairs))
    none = evaluation.concordance_index(spark.createDataFrame([], "d int, e boolean, r int"), "d", "e", "r").first()
    assert (none["comparable"], none["c_index"]) == (0, None)


def test_best_price(spark):
    curve = spark.createDataFrame([("u", 6_000_000, 5), ("u", 7_000_000, 12), ("u", 9_000_000, 60)], "unit string, rent long, expected_days int")
    assert evaluation.pick_optimal(curve, 90, "unit").first()["rent"] == 7_000_000


def test_survival_model_and_price_curve(spark):
    rows = [(g / 20, 25.0 + i % 7, float(max(1, round(10 + 30 * g / 20 + i % 5))), i % 4 != 0) for g in range(-6, 7) for i in range(8)]
    df = spark.createDataFrame(rows + [(0.0, 30.0, 0.0, True)], "price_gap double, area double, duration_days double, event_observed boolean")
    model, used = models.fit_aft(df, ["price_gap", "area"])
    assert used.count() == len(rows)
    curve = models.price_days_curve(model, {"price_gap": 0.0, "area": 30.0}, 7_000_000, [0.8, 0.9, 1.0, 1.1, 1.2], spark).orderBy("rent").collect()
    days = [r["expected_days"] for r in curve]
    assert days == sorted(days) and days[0] < days[-1]


def test_rent_model_and_features(spark):
    rows = [("ab"[i % 2], "sáng sủa rộng" if i % 3 else "cũ", 20.0 + i % 30, 1, 100.0 * (20 + i % 30) * (1 + i % 2)) for i in range(200)]
    df = models.derived_numbers(spark.createDataFrame(rows, "kind string, text string, area double, rooms int, rent double"), "area", "rooms", "rent")
    made = models.feature_pipeline(["kind"], ["log_area", "rooms_per_sqm", "area"], "text", 64).fit(df).transform(df)
    model = models.fit_rent_model(made, "rent", depth=4, rounds=15)
    assert evaluation.errors(model.transform(made), "rent", "prediction").first()["mape"] < 0.1
    assert models.cross_validate(made, "rent", (2, 3), 3, 2).avgMetrics


def test_equal_listings_are_learnt_as_one_row(spark):
    """A row for each distinct listing, weighted, gives the trees of all rows."""
    from pyspark.ml.functions import array_to_vector

    rows = [(float(i % 12), float(i // 12 % 5), (i % 12) * 3.0 + (i // 12 % 5) ** 2 + i % 7) for i in range(900)]
    df = spark.createDataFrame([*rows, (1.0, 1.0, None)], "a double, b double, y double")
    alike = models.collapsed(df, ["a", "b"], "y")
    assert {(r["a"], r["b"]): (round(r["y"], 6), r["weight"]) for r in alike.collect()} == {
        (a, b): (round(sum(y) / len(y), 6), len(y)) for a in range(12) for b in range(5) for y in [[r[2] for r in rows if r[:2] == (a, b)]]
    }
    vectors = lambda d: d.withColumn("features", array_to_vector(F.array("a", "b")))
    whole, few = models.fit_rent_model(vectors(df.where("y is not null")), "y", 3, 5), models.fit_rent_model(models.spread(vectors(alike)), "y", 3, 5, weight="weight")
    told = {(r["a"], r["b"]): r["prediction"] for r in whole.transform(vectors(alike)).collect()}
    assert all(math.isclose(told[r["a"], r["b"]], r["prediction"], rel_tol=1e-6) for r in few.transform(vectors(alike)).collect())


def test_target_means_know_no_label_of_their_own_fold(spark):
    rows = [(1, "a", 0, 10.0), (2, "a", 0, 20.0), (3, "a", 1, 40.0), (4, "b", 1, 70.0), (5, "a", None, 1e9), (6, "new", None, 1e9), (7, None, 0, 60.0), (8, "b", 0, None)]
    df = spark.createDataFrame(rows, "id int, cell string, fold int, y double")
    found = {r["id"]: r["cell_mean"] for r in models.target_means(df, "cell", "y", "fold", weight=2.0).collect()}
    overall = (10 + 20 + 40 + 70 + 60) / 5
    blend = lambda *ys: (sum(ys) + 2 * overall) / (len(ys) + 2)
    wanted = {1: blend(40), 2: blend(40), 3: blend(10, 20), 4: overall, 5: blend(10, 20, 40), 6: overall, 7: overall, 8: blend(70)}
    assert found.keys() == wanted.keys() and all(math.isclose(found[k], v) for k, v in wanted.items())


def test_folds_keep_clusters_whole(spark):
    """A feature that names the cluster says nothing of clusters left out; over folds that part them it seems to."""
    from pyspark.ml.functions import array_to_vector

    rows = [(float(c), (c * 37 % 100) / 10 + i / 100, c % 3, i % 3) for c in range(30) for i in range(12)]
    df = spark.createDataFrame(rows, "name double, y double, whole int, parted int").withColumn("features", array_to_vector(F.array("name")))
    whole, parted = (models.cross_validate(df, "y", (5,), 10, 3, fold).avgMetrics[0] for fold in ("whole", "parted"))
    assert whole > 2 * parted


def test_depth_by_all_folds_at_once(spark):
    """The depth that cross-validation finds, deep trees or shallow ones, weighted rows or not."""
    import random

    from pyspark.ml.functions import array_to_vector

    chance = random.Random(5)
    rows = [(float(i % 16), i // 16 % 3, float(1 + i % 4), (i % 16 * 7 % 16) + i * 31 % 5 / 10, chance.gauss(0, 1)) for i in range(96)]
    df = spark.createDataFrame(rows, "a double, fold int, weight double, deep double, noise double").withColumn("features", array_to_vector(F.array("a")))
    for label, weight, wanted in (("deep", "weight", 4), ("noise", None, 1)):
        tried = models.cross_validate(df, label, (1, 4), 3, 3, "fold", weight)
        assert models.best_depth(df, label, "fold", (1, 4), 3, 3, weight) == tried.bestModel.getMaxDepth() == wanted


def test_places_without_a_word_are_left_out(spark):
    """Trees tell the same of all rows from the words' places that vary as from all of them; a text of one word has none."""
    rows = [("ab"[i % 2], ("mới " if i % 3 else "cũ ") + ("to" if i % 5 else "nhỏ"), float(i % 30), (3.0 if i % 3 else 1.0) * (i % 30) + (i % 2) * 9 + i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "kind string, text string, area double, rent double")
    told, sizes = [], []
    for varied in (False, True):
        made = models.feature_pipeline(["kind"], ["area"], "text", 64, varied=varied).fit(df).transform(df)
        sizes.append(len(made.first()["features"]))
        told.append([r["prediction"] for r in models.fit_rent_model(made, "rent", 3, 5).transform(made).select("prediction").collect()])
    assert sizes == [2 + 1 + 64, 2 + 1 + 4]
    assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(*told))
    alike = df.withColumn("text", F.lit("cũ"))
    assert len(models.feature_pipeline(["kind"], ["area"], "text", 64, varied=True).fit(alike).transform(alike).first()["features"]) == 3


def test_cells_and_distances(spark):
    df = spark.createDataFrame([(1, 10.7769, 106.7009), (2, None, None), (3, 10.7800, 106.7009), (4, 95.0, 10.0)], "id int, latitude double, longitude double")
    cells = [r[0] for r in df.select(geo.cell(F.col("latitude"), F.col("longitude"))).collect()]
    assert cells[0].startswith("8:") and cells[1] is None and cells[3] is None
    found = {r["id"]: r for r in geo.points_within(df, df.where("id = 3").select("latitude", "longitude"), "id").collect()}
    assert (found[1]["poi_count"], found[2]["poi_count"], found[2]["nearest_km"]) == (1, 0, None)
    assert math.isclose(found[1]["nearest_km"], 0.0031 * 111.195, rel_tol=1e-3)


def test_neighbours_at_any_place(spark):
    """Against all distances: towns, poles, the date line."""
    import random

    chance = random.Random(2)
    spots = [(lat + chance.gauss(0, 0.02), ((lon + chance.gauss(0, 0.02) / max(0.02, math.cos(math.radians(lat))) + 180) % 360) - 180) for lat, lon in ((10.7, 106.7), (0, 180), (-0.0, 0.0), (60, -180), (89.98, 10), (-89.99, 100), (83, 179.9)) for _ in range(30)]
    spots = [(max(-90.0, min(90.0, a)), b) for a, b in spots]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "id int, latitude double, longitude double")
    def km(p, q):
        a = math.sin(math.radians(q[0] - p[0]) / 2) ** 2 + math.cos(math.radians(p[0])) * math.cos(math.radians(q[0])) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2
        return 2 * geo.EARTH_KM * math.asin(min(1.0, math.sqrt(a)))
    places = df.where("id % 7 = 0").select("latitude", "longitude")
    for few in (2, 1000):
        nearest = {r["id"]: r["km"] for r in geo.nearest_km(df.unionByName(spark.createDataFrame([(-1, None, 1.0)], df.schema)), places, "id", few).collect()}
        assert nearest.pop(-1) is None and all(abs(nearest[i] - min(km(p, q) for q in spots[::7])) < 1e-6 for i, p in enumerate(spots))
    assert [r["km"] for r in geo.nearest_km(df.limit(2), places.limit(0), "id").collect()] == [None, None]
    for radius in (1.0, 3.0):
        found = {r["id"]: r["poi_count"] for r in geo.points_within(df, df.select("latitude", "longitude"), "id", radius).collect()}
        assert found == {i: sum(km(p, q) <= radius for q in spots) for i, p in enumerate(spots)}


def test_remote_places_meet_few_cubes(spark):
    """A town's points and listings an ocean away: every distance right, and the points a listing is held against are few."""
    import random

    chance = random.Random(8)
    town = [(10.7 + chance.gauss(0, 0.05), 106.7 + chance.gauss(0, 0.05)) for _ in range(4000)] + [(10.7, 106.7)] * 500
    points = spark.createDataFrame(town, "latitude double, longitude double")
    far = [(i, chance.uniform(-89, 89), chance.uniform(-180, 180)) for i in range(200)] + [(200, 10.7, 106.7), (201, 10.7, 106.7), (202, None, 1.0), (203, -10.7, -73.3)]
    df = spark.createDataFrame(far, "id int, latitude double, longitude double")
    exact = {r["id"]: r["km"] for r in geo.nearest_km(df, points, "id", few=10_000).collect()}
    found = {r["id"]: r["km"] for r in geo.nearest_km(df, points, "id", few=10, leaf=8).collect()}
    assert found.keys() == exact.keys() and found[202] is None and found[200] == found[201] == 0
    assert all(found[k] == exact[k] for k in exact)
    places = df.where("latitude is not null").select("latitude", "longitude").distinct()
    met = [r["count"] for r in geo._leaf_pairs(places, points, 8).groupBy("latitude", "longitude").count().collect()]
    assert len(met) == places.count() and sum(met) / len(met) < 40  # of 4001 points


def test_links(spark):
    html = """<a href="1"><A  class=x HREF='2'><a href=3 id=y><a data-href="no"><abbr href="no"><a\nhref = "4">"""
    assert spark.createDataFrame([(html,)], "h string").select(web.links(F.col("h"))).first()[0] == ["1", "2", "3", "4"]


def test_probes(spark):
    rows = [(200, "<p>ok"), (200, "Tin ĐÃ HẾT HẠN"), (404, "x"), (503, "x"), (200, ""), (200, None), (None, "x")]
    df = spark.createDataFrame(rows, "s int, h string")
    present, reason = web.classify_probe(F.col("s"), F.col("h"))
    assert [tuple(r) for r in df.select(present, reason).collect()] == [(True, None), (False, "soft_delete"), (False, "http_status:404"), (False, "http_status:503"), (True, None), (True, None), (False, "http_status:none")]
    assert [r[0] for r in df.select(web.classify_probe(F.col("s"), F.col("h"), "inconclusive")[0]).collect()][3] is None


def test_sitemaps(spark):
    xml = ['<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> https://x/cho-thue-1 </loc></url><url><loc>https://x/mua-2</loc></url></urlset>', "<sitemapindex><sitemap><loc>https://x/s.xml</loc></sitemap></sitemapindex>"]
    df = spark.createDataFrame([(x,) for x in xml], "xml string")
    assert sorted(r["url"] for r in web.sitemap_urls(df, "xml", "/cho-thue-").collect()) == ["https://x/cho-thue-1", "https://x/s.xml"]

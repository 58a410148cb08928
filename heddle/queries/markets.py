"""Frontier, split, baseline, ranking, place and model queries over the trade tables."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heddle.operators import distributions, evaluation, frontier, geo, hexagons, models
from heddle.plans import ranks
from heddle.plans.durable import Scratch
from heddle.plans.joins import sent_if_small
from heddle.queries.panels import survival_labels
from heddle.sources import table
from heddle.sources.bucketed import buckets_for
from heddle.sources.frontier_store import FrontierStore

CUTOFF = "1999-01-01"
CENTRE = (10.7769, 106.7009)


def _frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a frontier: fetch times, panel membership and gone days follow from page_id."""
    p = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        F.concat("url", F.lit("#"), p).alias("url"), F.regexp_extract("url", r"://([^/]+)", 1).alias("source"),
        F.timestamp_seconds(1_700_000_000 + p * 60).alias("first_seen"),
        F.when(p % 3 != 0, F.timestamp_seconds(1_710_000_000 - p * 30)).alias("last_fetch_ts"),
        F.when(p % 3 != 0, F.lit(200)).alias("last_status"), F.lit(None).cast("string").alias("content_hash"),
        F.when(p % 7 == 0, 1).otherwise(0).alias("consecutive_failures"), (p % 2 == 0).alias("in_panel"),
        F.when(p % 11 == 0, F.to_date(F.lit("2024-03-01"))).alias("gone_date"),
    )


def _fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fetches each of every page but each fifth; success follows from page_id."""
    p = F.col("page_id")
    pages = table(spark, sf_dir, "pages").where(p % 5 != 0).select(p, F.concat("url", F.lit("#"), p).alias("url"), F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    ok = (p + F.col("k")) % 3 == 0
    return pages.select("url", F.timestamp_seconds(1_720_000_000 + F.col("k") * 86_400).alias("ts"), F.when(ok, 200).otherwise(500).alias("status"), ok.alias("ok"), F.when(ok, F.md5(F.concat("url", "k"))).alias("content_hash"))


def frontier_new_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even pages known, all pages found twice: the odd ones are new, with their earlier sighting."""
    pages = _frontier(spark, sf_dir)
    found = pages.select("url", "source", F.explode(F.array("first_seen", F.col("first_seen") - F.expr("INTERVAL 1 DAY"))).alias("first_seen"))
    return frontier.new_urls(found, pages.where("in_panel"))


def frontier_after_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.apply_fetches(_frontier(spark, sf_dir), _fetches(spark, sf_dir)).select("url", "last_fetch_ts", "last_status", "content_hash", "consecutive_failures", "gone_date")


def frontier_stored_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a frontier on disk that is opened again for each of the two days' batches."""
    path = f"{Scratch(spark, 'stored').root}/frontier"
    pages, log = _frontier(spark, sf_dir), _fetches(spark, sf_dir)
    # a host's share of the rows, were it all of them, is in buckets of bounded size
    FrontierStore(spark, path, hosts=16, parts=buckets_for(pages.count())).update(pages, lambda batch, state: batch.unionByName(state))
    for day in log.select(F.to_date("ts").alias("day")).distinct().orderBy("day").collect():
        FrontierStore(spark, path).apply_fetches(log.where(F.to_date("ts") == F.lit(day["day"])))
    return FrontierStore(spark, path).state().select("url", "last_fetch_ts", "last_status", "content_hash", "consecutive_failures", "gone_date")


def frontier_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next 20 of the panel and the next 20 to discover."""
    state = _frontier(spark, sf_dir)
    panel, new = frontier.panel_batch(state, 20), frontier.discovery_batch(state, 20)
    return panel.select("url", F.lit("panel").alias("batch")).unionByName(new.select("url", F.lit("discovery").alias("batch")))


def panel_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.panel_due(_frontier(spark, sf_dir))


def freeze_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.freeze_cohort(_frontier(spark, sf_dir), 25).select("url")


def freeze_cohort_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.freeze_cohort(_frontier(spark, sf_dir), 2, by="source").select("source", "url")


def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders on both sides of the cutoff, by status."""
    train, test = evaluation.temporal_split(table(spark, sf_dir, "orders"), "o_orderdate", CUTOFF)
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.groupBy("side", "o_orderstatus").agg(F.count("*").alias("orders"))


def cluster_leak_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test orders of customers without an order before the cutoff."""
    return evaluation.temporal_split(table(spark, sf_dir, "orders"), "o_orderdate", CUTOFF, "o_custkey")[1].select("o_orderkey", "o_custkey")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their part: price for a quantity, by type."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return lines.join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand"), "l_partkey")


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.median_baseline(_lines(spark, sf_dir), "p_type", "l_quantity", "l_extendedprice")


def median_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predicted(spark, sf_dir).groupBy("p_type").agg(F.count("*").alias("rows"), F.round(F.first(F.col("predicted") / F.col("l_quantity")), 4).alias("rate"))


def mape_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.errors(_predicted(spark, sf_dir), "l_extendedprice", "predicted", "p_brand").select("p_brand", "rows", "mape", "rmse")


def price_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = evaluation.price_gap(F.col("l_extendedprice"), F.col("predicted"))
    return _predicted(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", F.round(gap, 6).alias("price_gap"))


def bargain_top100(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws("-", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.lpad(F.col("l_linenumber").cast("string"), 3, "0"), F.lpad(F.col("l_partkey").cast("string"), 12, "0"))
    return evaluation.bargains(price_gap(spark, sf_dir).withColumn("key", key), "price_gap", "key").select("key", "price_gap")


def gap_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines by quartile of their price gap: rows and bounds."""
    ranked = evaluation.gap_quartiles(price_gap(spark, sf_dir), "price_gap")
    return ranked.groupBy("gap_quartile").agg(F.count("*").alias("rows"), F.min("price_gap").alias("lowest"), F.max("price_gap").alias("highest"))


def gap_ntiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in four groups of equal size by price gap, ties in the order of their keys."""
    keys = ["price_gap", "l_orderkey", "l_linenumber", "l_partkey"]
    return ranks.ntile(price_gap(spark, sf_dir), 4, keys)


def gap_ntiles_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same within each brand, in tenths: rows and bounds."""
    rows = _predicted(spark, sf_dir).withColumn("price_gap", F.round(evaluation.price_gap(F.col("l_extendedprice"), F.col("predicted")), 6))
    tiled = ranks.ntile(rows, 10, ["price_gap", "l_orderkey", "l_linenumber", "l_partkey"], "p_brand")
    return tiled.groupBy("p_brand", "tile").agg(F.count("*").alias("rows"), F.min("price_gap").alias("lowest"), F.max("price_gap").alias("highest"))


def r_squared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of the prices' spread the baseline explains, by type."""
    return evaluation.errors(_predicted(spark, sf_dir), "l_extendedprice", "predicted", "p_type").select("p_type", "rows", F.round("r2", 5).alias("r2"))


def derived_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs and ratios of part sizes and prices."""
    parts = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") - 1).alias("area"), F.col("p_partkey").alias("rooms"), F.col("p_retailprice").alias("price"))
    made = models.derived_numbers(parts, "area", "rooms", "price")
    return made.select("p_partkey", *(F.round(c, 6).alias(c) for c in ("log_area", "rooms_per_sqm", "log_price")))


def error_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors by decile of the actual price."""
    ranked = evaluation.quantile_groups(_predicted(spark, sf_dir), "l_extendedprice", 10)
    return evaluation.errors(ranked, "l_extendedprice", "predicted", "quantile").select("quantile", "rows", "mape")


SHARES = [0.1, 0.5, 0.9]


def price_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines' prices and suppliers by flag, from sketches stored by month and flag and merged; and whether these hold.

    Each answer is held against all rows: a quantile's rank, the number of distinct
    suppliers and the count of the most frequent one lie within the sketches' errors.
    Where no supplier stands out the sketch names none: then no count is beyond the
    error. Lines without a flag are a group, and one without values has nothing to miss.
    """
    lines = table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("dt"), F.col("l_returnflag").alias("source"), F.col("l_extendedprice").alias("price"), F.col("l_suppkey").cast("string").alias("supplier"))
    stored = Scratch(spark, "profiles").keep(distributions.profile(lines, ["dt", "source"], ["price"], ["supplier"]), "profiles")
    whole = distributions.merged(stored, "source")
    told = whole.select(
        "source", "rows", "nulls_price", "least_price", "most_price", distributions.quantiles(F.col("kll_price"), SHARES).alias("q"), distributions.distinct(F.col("hll_supplier")).alias("suppliers"),
        F.get(distributions.frequent(F.col("top_supplier"), 1), F.lit(0)).alias("top"),
    )
    price = F.col("price")
    ranks_of = [f(price, F.get("q", F.lit(i))) for i in range(len(SHARES)) for f in (lambda p, q: p < q, lambda p, q: p <= q)]
    bounds = sent_if_small(told.select(F.col("source").alias("_source"), "q"))
    exact = lines.join(bounds, F.col("source").eqNullSafe(F.col("_source"))).groupBy("source").agg(F.array(*(F.count_if(r) for r in ranks_of)).alias("ranks"))
    # suppliers are counted before they are ranked, so no group gathers its rows
    counts = lines.groupBy("source", "supplier").agg(F.count("supplier").alias("n"))
    counts = counts.groupBy("source").agg(F.count("supplier").alias("distinct"), F.max("n").alias("most"))
    error, apart = distributions.rank_error(), distributions.distinct_error()
    n = F.col("rows") - F.col("nulls_price")
    holds = [(F.get("ranks", F.lit(2 * i)) <= (s + error) * n) & (F.get("ranks", F.lit(2 * i + 1)) >= (s - error) * n) for i, s in enumerate(SHARES)]
    joined = told
    for side in (exact, counts):
        joined = joined.join(side.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return joined.select(
        "source", "rows", "nulls_price", "least_price", "most_price", ((n == 0) | (holds[0] & holds[1] & holds[2])).alias("quantiles_hold"),
        (F.abs(F.col("suppliers") - F.col("distinct")) <= F.greatest(F.lit(1.0), apart * F.col("distinct"))).alias("distinct_holds"),
        # a frequent value's count is off by at most 3.5 parts in as many as are tracked
        (F.abs(F.coalesce(F.col("top.count"), F.lit(0)) - F.col("most")) <= 3.5 / distributions.TRACKED * F.col("rows")).alias("top_holds"),
    )


def pick_optimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each part size the best of its parts' prices, dearer ones letting later."""
    curve = table(spark, sf_dir, "part").groupBy("p_size", F.round("p_retailprice", 0).cast("long").alias("rent")).agg(F.round(F.max("p_retailprice") / 30, 0).cast("int").alias("expected_days"))
    best = evaluation.pick_optimal(curve, 90, "p_size")
    return best.withColumn("revenue", F.round("revenue", 4))


def _place(key: str) -> tuple[Column, Column]:
    """A made-up place in a city for each key: latitude and longitude."""
    k = F.col(key)
    return 10.7 + (k * 7919 % 1000) / 5000, 106.6 + (k * 104_729 % 1000) / 5000


def _placed(df: DataFrame, key: str) -> DataFrame:
    latitude, longitude = _place(key)
    return df.select(key, latitude.alias("latitude"), longitude.alias("longitude"))


def hex_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's hexagon, its parent, and the customers in it and in the six around it."""
    placed = _placed(table(spark, sf_dir, "customer"), "c_custkey")
    cells = placed.select("c_custkey", hexagons.hexagon(F.col("latitude"), F.col("longitude")).alias("cell"))
    held = cells.groupBy("cell").agg(F.count("*").alias("n"))
    # counted cells meet, not customers: seven rows for each
    around = held.select(F.explode(hexagons.disk(F.col("cell"))).alias("cell"), "n").groupBy("cell").agg(F.sum("n").alias("around"))
    joined = cells.join(sent_if_small(held.join(around, "cell")), "cell")
    return joined.select("c_custkey", "cell", hexagons.parent(F.col("cell")).alias("parent"), F.col("n").alias("here"), "around")


def poi_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers within a kilometre of each customer."""
    found = geo.points_within(_placed(table(spark, sf_dir, "customer"), "c_custkey"), _placed(table(spark, sf_dir, "supplier"), "s_suppkey"), "c_custkey")
    return found.withColumn("nearest_km", F.round("nearest_km", 6))


def place_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's distances to a city's centre, to the nearest of the few large suppliers and to the nearest of all."""
    customers = _placed(table(spark, sf_dir, "customer"), "c_custkey")
    suppliers = _placed(table(spark, sf_dir, "supplier"), "s_suppkey")
    large, any_one = geo.nearest_km(customers, suppliers.where("s_suppkey % 25 = 0"), "c_custkey"), geo.nearest_km(customers, suppliers, "c_custkey", few=5)
    centre = customers.select("c_custkey", F.round(geo.distance_km(F.col("latitude"), F.col("longitude"), CENTRE), 6).alias("centre_km"))
    both = large.select("c_custkey", F.round("km", 6).alias("large_km")).join(any_one.select("c_custkey", F.round("km", 6).alias("supplier_km")), "c_custkey")
    return centre.join(both, "c_custkey")


def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _placed(table(spark, sf_dir, "customer"), "c_custkey")
    lat = F.when(F.col("c_custkey") % 10 != 0, F.col("latitude"))
    return placed.select("c_custkey", geo.cell(lat, F.col("longitude")).alias("cell"))


def geo_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without a place of their own at their nation's centroid, counted."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    own = _placed(customers, "c_custkey").join(customers, "c_custkey")
    hidden = own.withColumn("latitude", F.when(F.col("c_custkey") % 3 != 0, F.col("latitude")))
    centroids = own.groupBy("c_nationkey").agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))
    return geo.with_precision(hidden, centroids, "c_nationkey").groupBy("geo_precision").agg(F.count("*").alias("customers"), F.round(F.avg("latitude"), 6).alias("latitude"))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    lines = _lines(spark, sf_dir).select("l_orderkey", "l_quantity", "l_extendedprice", "p_type")
    kind = F.array(*((F.col("p_type") == t).cast("double") for t in ("ECONOMY", "STANDARD", "PROMO", "MEDIUM", "LARGE", "SMALL")))
    return lines.withColumn("features", array_to_vector(F.concat(F.array("l_quantity"), kind)))


def rent_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices by boosted trees, learnt from four fifths of the orders: rows and errors of the others by type."""
    rows = _features(spark, sf_dir)
    model = models.fit_rent_model(rows.where("l_orderkey % 5 <> 0"), "l_extendedprice", depth=4, rounds=10)
    return evaluation.errors(model.transform(rows.where("l_orderkey % 5 = 0")), "l_extendedprice", "prediction", "p_type")


def _rents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as listings whose rent follows from area, kind, a word, the way to the centre and a tenth of noise.

    Lines of one part are one cluster: each fifth part is held out, the others are in three folds.
    """
    part = F.col("l_partkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") + 10).alias("area"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_name", (F.col("p_size") % 4 + 1).alias("rooms"))
    # what follows from the part is worked out for each part, not for each of its lines
    place = _place("l_partkey")
    parts = parts.withColumns({"centre_km": geo.distance_km(*place, CENTRE), "cell": hexagons.hexagon(*place, 6)})
    word = F.when(F.col("p_name").startswith("new "), 1.3).when(F.col("p_name").startswith("old "), 0.75).otherwise(1.0)
    noise = 1 + ((F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 31) % 201 - 100) / 1000
    rows = lines.join(parts, "l_partkey").withColumn("rent", 200_000 * F.col("area") * (0.5 + F.length("p_type") / 10) * word * F.exp(-F.col("centre_km") / 20) * noise)
    return rows.withColumn("fold", F.when(part % 5 != 0, (F.floor(part / 5) % 3).cast("int")))


def rent_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rents by boosted trees over categories, words, numbers and cells' mean rents, on parts held out, beside the median's error.

    The depth is the one that does best across folds of whole parts. Trees learn the
    log of the rent; errors are those of the rent. Listings with equal features are
    learnt as one row that counts as so many.
    """
    scratch, numbers = Scratch(spark, "rents"), ["log_area", "rooms_per_sqm", "centre_km", "cell_mean"]
    features = ["p_type", "p_name", *numbers]
    # lines meet their parts once; numbers that follow from the others are worked out again where they are read
    rents = scratch.keep(_rents(spark, sf_dir).select("p_type", "p_name", "area", "rooms", "centre_km", "cell", "rent", "fold"), "rents")
    rows = models.target_means(models.derived_numbers(rents, "area", "rooms", "rent"), "cell", "log_price", "fold")
    alike = models.spread(scratch.keep(models.collapsed(rows.where("fold is not null"), features, "log_price", "fold"), "alike"))
    # words are weighed by the distinct listings: trees split alike whatever a feature's scale
    made = models.feature_pipeline(["p_type"], numbers, "p_name", 64, varied=True).fit(alike)
    learned = made.transform(alike).select("features", "log_price", "weight", "fold").persist()  # read for each fold and depth
    depth = models.best_depth(learned, "log_price", "fold", (3, 5), 8, 3, "weight")
    model = models.fit_rent_model(learned, "log_price", depth, rounds=30, step=0.2, weight="weight")
    learned.unpersist()
    # equal listings have one prediction, and those without a feature none
    held = rows.where("fold is null")
    asked = models.spread(scratch.keep(held.select(*features).distinct(), "asked"))
    told = scratch.keep(model.transform(made.transform(asked)).select(*features, F.exp("prediction").alias("fair")), "told")
    held = held.join(sent_if_small(told), features).select("p_type", "area", "rent", "fair")
    held = scratch.keep(evaluation.median_baseline(held, "p_type", "area", "rent", rents.where("fold is not null")), "held")
    plain = evaluation.errors(held, "rent", "predicted", "p_type").select("p_type", F.col("mape").alias("baseline_mape"))
    return evaluation.errors(held, "rent", "fair", "p_type").join(plain, "p_type").withColumn("depth", F.lit(depth))


def aft_survival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected durations of users by their mean event value."""
    values = table(spark, sf_dir, "events").groupBy("user_id").agg(F.avg("value").alias("mean_value"), F.count("*").cast("double").alias("n_events"))
    model, rows = models.fit_aft(survival_labels(spark, sf_dir).join(values, "user_id"), ["mean_value", "n_events"])
    return model.transform(rows).select("user_id", "duration_days", "event_observed", F.round("prediction", 3).alias("expected_days"))


def text_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as features of language, length and TF-IDF: the vectors' sizes."""
    from pyspark.ml.functions import vector_to_array

    rows = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("kind"))
    rows = rows.withColumn("chars", F.length("text").cast("double"))
    fitted = models.feature_pipeline(["kind"], ["chars"], "text").fit(rows)
    return fitted.transform(rows).select("doc_id", F.size(F.filter(vector_to_array("features"), lambda x: x != 0)).alias("filled"))


def isotonic_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "part").groupBy(F.col("p_size").alias("x")).agg(F.round(F.avg("p_retailprice"), 4).alias("y"))
    return models.isotonic_curve(points, "x", "y").withColumn("smooth", F.round("smooth", 4))


_CUSTOMER_Q, _CUSTOMER_R = hexagons.cell_sql("(10.7 + (c_custkey * 7919 % 1000) / 5000)", "(106.6 + (c_custkey * 104729 % 1000) / 5000)", 8)
_PARENT_Q, _PARENT_R = hexagons.rounded_sql("(c.q / 2)", "(c.r / 2)")

QUERIES = {
    "hex_cells": hex_cells,
    "price_distributions": price_distributions,
    "frontier_new_urls": frontier_new_urls, "frontier_after_fetches": frontier_after_fetches, "frontier_stored_fetches": frontier_stored_fetches, "frontier_batch": frontier_batch, "panel_due": panel_due, "freeze_cohort": freeze_cohort,
    "freeze_cohort_by_source": freeze_cohort_by_source, "temporal_split": temporal_split, "cluster_leak_guard": cluster_leak_guard, "median_baseline": median_baseline,
    "mape_by_group": mape_by_group, "price_gap": price_gap, "bargain_top100": bargain_top100, "error_deciles": error_deciles,
    "gap_quartiles": gap_quartiles, "gap_ntiles": gap_ntiles, "gap_ntiles_by_brand": gap_ntiles_by_brand, "r_squared": r_squared, "derived_numbers": derived_numbers, "pick_optimal": pick_optimal, "poi_radius": poi_radius, "place_distances": place_distances,
    "grid_cells": grid_cells, "geo_precision": geo_precision, "rent_gbt": rent_gbt, "rent_learned": rent_learned, "aft_survival": aft_survival, "text_idf": text_idf, "isotonic_curve": isotonic_curve,
}

_FRONTIER = """f AS (SELECT page_id AS p, url || '#' || page_id AS url, regexp_extract(url, '://([^/]+)', 1) AS source,
    make_timestamp((1700000000 + page_id * 60) * 1000000) AS first_seen, CASE WHEN page_id % 3 <> 0 THEN make_timestamp((1710000000 - page_id * 30) * 1000000) END AS last_fetch_ts,
    CASE WHEN page_id % 7 = 0 THEN 1 ELSE 0 END AS fails, page_id % 2 = 0 AS in_panel, CASE WHEN page_id % 11 = 0 THEN DATE '2024-03-01' END AS gone_date FROM pages)"""
_LINES = "l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, p_type, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey)"
_PREDICTED = f"{_LINES}, r AS (SELECT p_type, median(l_extendedprice / l_quantity) AS rate FROM l GROUP BY 1), q AS (SELECT l.*, rate * l_quantity AS predicted FROM l JOIN r USING (p_type))"
_KEY = "lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || '-' || lpad(CAST(l_partkey AS VARCHAR), 12, '0')"
_PLACE = "10.7 + ({k} * 7919 % 1000) / 5000 AS lat, 106.6 + ({k} * 104729 % 1000) / 5000 AS lon"
_MAPE = "round(avg(abs(l_extendedprice - predicted) / l_extendedprice), 6) AS mape"

ORACLE_SQL = {
    "hex_cells": f"""WITH c AS (SELECT c_custkey, {_CUSTOMER_Q} AS q, {_CUSTOMER_R} AS r FROM customer), h AS (SELECT q, r, count(*) AS n FROM c GROUP BY ALL),
        a AS (SELECT x.q, x.r, x.n AS here, CAST(sum(y.n) AS BIGINT) AS around FROM h x JOIN h y ON abs(x.q - y.q) <= 1 AND abs(x.r - y.r) <= 1 AND abs(x.q - y.q + x.r - y.r) <= 1 GROUP BY ALL)
        SELECT c_custkey, concat_ws(':', 8, c.q, c.r) AS cell, concat_ws(':', 7, {_PARENT_Q}, {_PARENT_R}) AS parent, here, around FROM c JOIN a ON a.q = c.q AND a.r = c.r""",
    "price_distributions": """SELECT l_returnflag AS source, count(*) AS rows, count(*) FILTER (WHERE l_extendedprice IS NULL) AS nulls_price, min(CAST(l_extendedprice AS DOUBLE)) AS least_price,
        max(CAST(l_extendedprice AS DOUBLE)) AS most_price, true AS quantiles_hold, true AS distinct_holds, true AS top_holds FROM lineitem GROUP BY 1""",
    "frontier_new_urls": f"WITH {_FRONTIER} SELECT url, source, first_seen - INTERVAL 1 DAY AS first_seen FROM f WHERE NOT in_panel",
    "frontier_after_fetches": f"""WITH {_FRONTIER}, t AS (SELECT p, url, k, (p + k) % 3 = 0 AS ok FROM f, (VALUES (0), (1)) AS v(k) WHERE p % 5 <> 0),
        g AS (SELECT p, max(k) FILTER (WHERE ok) AS okk, count(*) FILTER (WHERE ok) AS oks, min(k) FILTER (WHERE ok) AS firstok FROM t GROUP BY 1)
        SELECT f.url, CASE WHEN okk IS NOT NULL THEN make_timestamp((1720000000 + CAST(okk AS BIGINT) * 86400) * 1000000) ELSE last_fetch_ts END AS last_fetch_ts,
            CAST(CASE WHEN okk IS NOT NULL OR p % 3 <> 0 THEN 200 END AS INTEGER) AS last_status, CASE WHEN okk IS NOT NULL THEN md5(f.url || okk) END AS content_hash,
            CAST(CASE WHEN p % 5 = 0 THEN fails WHEN okk = 1 THEN 0 WHEN okk = 0 THEN 1 ELSE fails + 2 END AS INTEGER) AS consecutive_failures,
            CASE WHEN p % 5 <> 0 AND okk IS NULL THEN DATE '2024-07-04' WHEN p % 5 <> 0 AND okk = 1 AND fails = 1 THEN DATE '2024-07-03' ELSE gone_date END AS gone_date
        FROM f LEFT JOIN g USING (p)""",
    "frontier_batch": f"""WITH {_FRONTIER} (SELECT url, 'panel' AS batch FROM f WHERE in_panel ORDER BY last_fetch_ts ASC NULLS FIRST, url LIMIT 20)
        UNION ALL (SELECT url, 'discovery' AS batch FROM f WHERE last_fetch_ts IS NULL AND gone_date IS NULL ORDER BY first_seen, url LIMIT 20)""",
    "panel_due": f"WITH {_FRONTIER} SELECT url FROM f WHERE in_panel AND gone_date IS NULL",
    "freeze_cohort": f"WITH {_FRONTIER} SELECT url FROM f WHERE last_fetch_ts IS NOT NULL AND gone_date IS NULL AND NOT in_panel ORDER BY sha256('cohort:' || url), url LIMIT 25",
    "freeze_cohort_by_source": f"""WITH {_FRONTIER} SELECT source, url FROM f WHERE last_fetch_ts IS NOT NULL AND gone_date IS NULL AND NOT in_panel
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY sha256('cohort:' || url), url) <= 2""",
    "temporal_split": f"SELECT CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN 'train' ELSE 'test' END AS side, o_orderstatus, count(*) AS orders FROM orders GROUP BY ALL",
    "cluster_leak_guard": f"SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{CUTOFF}' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '{CUTOFF}')",
    "median_baseline": f"WITH {_PREDICTED} SELECT p_type, count(*) AS rows, round(any_value(predicted / l_quantity), 4) AS rate FROM q GROUP BY 1",
    "mape_by_group": f"WITH {_PREDICTED} SELECT p_brand, count(*) AS rows, {_MAPE}, round(sqrt(avg((l_extendedprice - predicted) ** 2)), 4) AS rmse FROM q GROUP BY 1",
    "price_gap": f"WITH {_PREDICTED} SELECT l_orderkey, l_linenumber, l_partkey, round((l_extendedprice - predicted) / predicted, 6) AS price_gap FROM q",
    "bargain_top100": f"WITH {_PREDICTED}, g AS (SELECT {_KEY} AS key, round((l_extendedprice - predicted) / predicted, 6) AS price_gap FROM q) SELECT * FROM g WHERE price_gap < 0 ORDER BY price_gap, key LIMIT 100",
    "error_deciles": f"""WITH {_PREDICTED}, b AS (SELECT quantile_cont(l_extendedprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS bounds FROM q),
        d AS (SELECT q.*, CAST(1 + len(list_filter(bounds, lambda x: x < l_extendedprice)) AS INTEGER) AS quantile FROM q CROSS JOIN b) SELECT quantile, count(*) AS rows, {_MAPE} FROM d GROUP BY 1""",
    "pick_optimal": """WITH c AS (SELECT p_size, CAST(round(p_retailprice) AS BIGINT) AS rent, CAST(round(max(p_retailprice) / 30) AS INTEGER) AS expected_days FROM part GROUP BY ALL)
        SELECT p_size, rent, expected_days, round(rent * (90 - expected_days) / 30, 4) AS revenue FROM c
        QUALIFY row_number() OVER (PARTITION BY p_size ORDER BY rent * (90 - expected_days) DESC, rent) = 1""",
    "poi_radius": f"""WITH c AS (SELECT c_custkey, {_PLACE.format(k="c_custkey")} FROM customer), s AS (SELECT {_PLACE.format(k="s_suppkey")} FROM supplier),
        d AS (SELECT c_custkey, {2 * geo.EARTH_KM} * asin(least(1.0, sqrt(sin(radians(s.lat - c.lat) / 2) ** 2 + cos(radians(c.lat)) * cos(radians(s.lat)) * sin(radians(s.lon - c.lon) / 2) ** 2))) AS km FROM c CROSS JOIN s)
        SELECT c_custkey, count(*) FILTER (WHERE km <= 1) AS poi_count, round(min(km) FILTER (WHERE km <= 1), 6) AS nearest_km FROM d GROUP BY 1""",
    "place_distances": f"""WITH c AS (SELECT c_custkey, {_PLACE.format(k="c_custkey")} FROM customer), s AS (SELECT s_suppkey, {_PLACE.format(k="s_suppkey")} FROM supplier),
        d AS (SELECT c_custkey, s_suppkey, {2 * geo.EARTH_KM} * asin(least(1.0, sqrt(sin(radians(s.lat - c.lat) / 2) ** 2 + cos(radians(c.lat)) * cos(radians(s.lat)) * sin(radians(s.lon - c.lon) / 2) ** 2))) AS km,
            {2 * geo.EARTH_KM} * asin(least(1.0, sqrt(sin(radians({CENTRE[0]} - c.lat) / 2) ** 2 + cos(radians(c.lat)) * cos(radians({CENTRE[0]})) * sin(radians({CENTRE[1]} - c.lon) / 2) ** 2))) AS centre FROM c CROSS JOIN s)
        SELECT c_custkey, round(any_value(centre), 6) AS centre_km, round(min(km) FILTER (WHERE s_suppkey % 25 = 0), 6) AS large_km, round(min(km), 6) AS supplier_km FROM d GROUP BY 1""",
    "grid_cells": f"""SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN '8:' || CAST(floor((lat + 90) / {180 / 2**13}) AS BIGINT) || ':' || CAST(floor((lon + 180) / {180 / 2**13}) AS BIGINT) END AS cell
        FROM (SELECT c_custkey, {_PLACE.format(k="c_custkey")} FROM customer)""",
    "geo_precision": f"""WITH c AS (SELECT c_custkey, c_nationkey, {_PLACE.format(k="c_custkey")} FROM customer), m AS (SELECT c_nationkey, avg(lat) AS mid FROM c GROUP BY 1)
        SELECT CASE WHEN c_custkey % 3 <> 0 THEN 'exact' ELSE 'district' END AS geo_precision, count(*) AS customers, round(avg(CASE WHEN c_custkey % 3 <> 0 THEN lat ELSE mid END), 6) AS latitude FROM c JOIN m USING (c_nationkey) GROUP BY 1""",
    "gap_quartiles": f"""WITH {_PREDICTED}, g AS (SELECT round((l_extendedprice - predicted) / predicted, 6) AS price_gap FROM q), b AS (SELECT quantile_cont(price_gap, [0.25, 0.5, 0.75]) AS bounds FROM g)
        SELECT CAST(1 + len(list_filter(bounds, lambda x: x < price_gap)) AS INTEGER) AS gap_quartile, count(*) AS rows, min(price_gap) AS lowest, max(price_gap) AS highest FROM g CROSS JOIN b GROUP BY 1""",
    "gap_ntiles": f"""WITH {_PREDICTED}, g AS (SELECT l_orderkey, l_linenumber, l_partkey, round((l_extendedprice - predicted) / predicted, 6) AS price_gap FROM q)
        SELECT *, CAST(ntile(4) OVER (ORDER BY price_gap, l_orderkey, l_linenumber, l_partkey) AS INTEGER) AS tile FROM g""",
    "gap_ntiles_by_brand": f"""WITH {_PREDICTED}, g AS (SELECT *, round((l_extendedprice - predicted) / predicted, 6) AS price_gap FROM q),
        t AS (SELECT *, CAST(ntile(10) OVER (PARTITION BY p_brand ORDER BY price_gap, l_orderkey, l_linenumber, l_partkey) AS INTEGER) AS tile FROM g)
        SELECT p_brand, tile, count(*) AS rows, min(price_gap) AS lowest, max(price_gap) AS highest FROM t GROUP BY ALL""",
    "r_squared": f"WITH {_PREDICTED} SELECT p_type, count(*) AS rows, round(1 - avg((l_extendedprice - predicted) ** 2) / var_pop(l_extendedprice), 5) AS r2 FROM q GROUP BY 1",
    "isotonic_curve": """WITH p AS (SELECT p_size AS x, round(avg(p_retailprice), 4) AS y, row_number() OVER (ORDER BY p_size) AS i FROM part GROUP BY 1),
        m AS (SELECT a.i AS a, b.i AS b, avg(p.y) AS mean FROM p a JOIN p b ON b.i >= a.i JOIN p ON p.i BETWEEN a.i AND b.i GROUP BY 1, 2),
        l AS (SELECT p.i, m.a, min(m.mean) AS least FROM p JOIN m ON m.a <= p.i AND m.b >= p.i GROUP BY 1, 2)
        SELECT x, y, round(smooth, 4) AS smooth FROM p JOIN (SELECT i, max(least) AS smooth FROM l GROUP BY 1) USING (i)""",
    "derived_numbers": """SELECT p_partkey, round(CASE WHEN p_size > 1 THEN ln(p_size - 1) END, 6) AS log_area, round(CASE WHEN p_size <> 1 THEN p_partkey / (p_size - 1) END, 6) AS rooms_per_sqm,
        round(CASE WHEN p_retailprice > 0 THEN ln(p_retailprice) END, 6) AS log_price FROM part""",
}
ORACLE_SQL["frontier_stored_fetches"] = ORACLE_SQL["frontier_after_fetches"]

"""Mixing documents to target weights of domains, with soft membership.

A naive Bayes classifier over hashed words, trained on a bounded sample of a
labelled table, gives each document a posterior over domains. Rates r >= 0 then
solve a least-squares problem: the expected tokens of domain d, the sum over
documents of r * tokens * posterior(d), shall be its target. Projected gradient
steps need only one vector of domain totals from the data each, so a step is one
aggregation of a narrow table, and a document's rate is an expression over the
steps' gradients. Everything is DataFrame expressions; the driver sees sums over
domains alone.
"""

import warnings
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heddle.plans.durable import Scratch
from heddle.plans.joins import sent_if_small
from heddle.sources import table

#: Buckets that words are hashed to; the classifier is a table of this many rows.
BUCKETS = 4096
#: Labelled documents that the classifier is trained on, at most.
FIT_ROWS = 3000
SMOOTHING = 0.1
#: Words that a posterior rests on at most: longer texts are judged by their mean word,
#: as if this long, which keeps mixed texts soft.
EVIDENCE_WORDS = 40
STEPS = 40
#: Steps between durable copies of the rates, which bound the expressions' length.
FOLD = 8
TOLERANCE = 1e-6
#: Shares of tokens by language.
TARGETS = {"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.15}


def _words(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """A row per word of each document, keyed by id and text hash; wordless documents have one row with a null bucket.

    ``copies`` is 1 on the first row of each occurrence of a document.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(F.lower(F.translate(text, "\n\t\r", "   ")), " "), lambda w: w != "")
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), words.alias("words"), *more)
    rows = keyed.select("doc_id", "text_hash", *more, F.posexplode_outer("words").alias("place", "word"))
    bucket = F.when(F.col("word").isNotNull(), F.pmod(F.xxhash64("word"), F.lit(BUCKETS)))
    return rows.select("doc_id", "text_hash", *more, bucket.alias("bucket"), (F.coalesce("place", F.lit(0)) == 0).cast("long").alias("copies"))


def word_table(labelled: DataFrame, domains: list[str]) -> tuple[DataFrame, list[float]]:
    """(bucket, w0, w1, ...), each domain's log-likelihood of the buckets seen, and the logs of the domains' shares.

    ``labelled`` has doc_id, text and domain. At most BUCKETS rows.
    """
    words = _words(labelled, "doc_id", "text", "domain")
    seen = words.groupBy("bucket").agg(
        *(F.count_if((F.col("domain") == d) & F.col("bucket").isNotNull()).alias(f"c{i}") for i, d in enumerate(domains)),
        *(F.sum(F.when(F.col("domain") == d, F.col("copies"))).alias(f"d{i}") for i, d in enumerate(domains)),
    )
    k = range(len(domains))
    sums = seen.agg(*(F.sum(f"c{i}").alias(f"c{i}") for i in k), *(F.sum(f"d{i}").alias(f"d{i}") for i in k)).first()
    totals = [float(sums[f"c{i}"] or 0) for i in k]
    counts = np.array([float(sums[f"d{i}"] or 0) + 1 for i in k])
    rate = [F.log((F.col(f"c{i}") + SMOOTHING) / (totals[i] + SMOOTHING * BUCKETS)) for i in k]
    return seen.where("bucket is not null").select("bucket", *(rate[i].alias(f"w{i}") for i in k)), np.log(counts / counts.sum()).tolist()


def posteriors(docs: DataFrame, weights: DataFrame, priors: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, copies, tokens, p0, p1, ...) for the distinct documents of ``docs``.

    Words of buckets that training has not seen count as tokens but weigh
    nothing. A document without words has the priors.
    """
    k = range(len(priors))
    words = _words(docs, id_col, text_col).join(F.broadcast(weights), "bucket", "left")
    sums = words.groupBy("doc_id", "text_hash").agg(
        F.sum("copies").alias("copies"), F.count("bucket").alias("words"), F.count("w0").alias("known"), *(F.sum(f"w{i}").alias(f"s{i}") for i in k)
    )
    tokens = (F.col("words") / F.col("copies")).cast("long")
    scale = F.least(F.lit(1.0) / F.col("copies"), F.lit(float(EVIDENCE_WORDS)) / F.greatest("known", F.lit(1)))
    sums = sums.select("doc_id", "text_hash", "copies", tokens.alias("tokens"), *((F.lit(priors[i]) + F.coalesce(F.col(f"s{i}") * scale, F.lit(0.0))).alias(f"s{i}") for i in k))
    sums = sums.withColumn("top", F.greatest(*(f"s{i}" for i in k)) if len(priors) > 1 else F.col("s0"))
    sums = sums.withColumns({f"e{i}": F.exp(F.col(f"s{i}") - F.col("top")) for i in k})
    whole = reduce(Column.__add__, (F.col(f"e{i}") for i in k))
    return sums.select("doc_id", "text_hash", "copies", "tokens", *((F.col(f"e{i}") / whole).alias(f"p{i}") for i in k))


def fit_rates(members: DataFrame, targets: list[float], budget: float | None, scratch: Scratch, steps: int = STEPS) -> DataFrame:
    """``members``, as ``posteriors`` gives them, with a column ``rate``.

    ``targets`` are the domains' shares. ``budget`` is the tokens wanted in all;
    None takes the least with which no domain's tokens shrink, and rates are
    projected at 1 instead of 0, so that no document does. The objective weighs each domain's error by the inverse
    of its own curvature; steps are taken in the metric of tokens, so documents
    of equal posterior have equal rates whatever their length. Rates that leave a
    domain off its target by more than ``TOLERANCE`` of the budget after ``steps``
    steps, as without documents of it they must, are given with a warning that says by how much.
    """
    k = range(len(targets))
    p = [F.col(f"p{i}") for i in k]
    mass = F.col("copies") * F.col("tokens")
    first = members.agg(*(F.sum(mass * p[i]).alias(f"t{i}") for i in k), *(F.sum(mass * p[i] * p[j]).alias(f"h{i}_{j}") for i in k for j in k)).first()
    now = np.array([first[f"t{i}"] or 0.0 for i in k])
    curve = np.array([[first[f"h{i}_{j}"] or 0.0 for j in k] for i in k])
    share = np.array(targets) / sum(targets)
    positive = share > 0
    floor = 1.0 if budget is None else 0.0
    if budget is None:
        budget = float((now[positive] / share[positive]).max()) if positive.any() else 0.0
    wanted = budget * share
    weight = 1 / np.maximum(np.diag(curve), 1e-9)
    size = 1 / max(np.linalg.eigvalsh(np.sqrt(weight)[:, None] * curve * np.sqrt(weight)).max(), 1e-12)
    current, rate = members.withColumn("rate", F.lit(1.0)), F.col("rate")
    for step in range(1, steps + 1):
        error = now - wanted
        if np.abs(error).max() <= TOLERANCE * max(budget, 1.0):
            break
        pull = reduce(Column.__add__, (p[i] * float(size * weight[i] * error[i]) for i in k))
        rate = F.greatest(F.lit(floor), rate - pull)
        if step % FOLD == 0:
            before, current, rate = current, scratch.keep(current.withColumn("rate", rate), "rates"), F.col("rate")
            if step > FOLD:
                scratch.drop(before)
        sums = current.agg(*(F.sum(rate * mass * p[i]).alias(f"t{i}") for i in k)).first()
        now = np.array([sums[f"t{i}"] or 0.0 for i in k])
    if (off := np.abs(now - wanted) / max(budget, 1.0)).max(initial=0.0) > TOLERANCE:
        warnings.warn(f"fit_rates: domains are off their targets by {', '.join(f'{x:.2g}' for x in off)} of the budget after {steps} steps", RuntimeWarning, stacklevel=2)
    return current.withColumn("rate", rate)


def labelled_languages(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, text, domain) of at most ``rows`` labelled documents, the least by a hash of the id, their language as domain."""
    ids = labels.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text", F.col("lang").alias("domain")).join(F.broadcast(ids), "doc_id")


def mixing_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: float | None = -1.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, copies, tokens, p0, ..., rate) for the distinct documents of ``docs``.

    ``labelled`` (doc_id, text, domain) trains the classifier; rows of other
    domains are not used. A negative budget is the tokens there are now; for
    None see ``fit_rates``. Tokens are blank-separated words. Null texts are
    empty: no tokens, the priors as posterior. Null ids are ids like others.
    Rows that repeat id and text are one row here, weighed by ``copies``. A
    domain without documents misses its target. Other columns are not read; an
    empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    domains = list(targets)
    weights, priors = word_table(labelled.where(F.col("domain").isin(domains)), domains)
    weights = scratch.keep(weights, "weights")
    members = scratch.keep(posteriors(docs, weights, priors, id_col, text_col), "members")
    if budget is not None and budget < 0:
        budget = float(members.agg(F.sum(F.col("copies") * F.col("tokens"))).first()[0] or 0)
    return fit_rates(members, list(targets.values()), budget, scratch)


def apply_rates(docs: DataFrame, rates: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, each row as often as its rate says.

    The whole part of the rate is taken, and once more if a hash of id and text
    falls below the rest, so that reruns agree. Rates that are few are sent to the
    documents' tasks; else both are shuffled.
    """
    known = rates.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "rate")
    text, rate = F.xxhash64(F.coalesce(docs[text_col], F.lit(""))), known["rate"]
    joined = docs.join(sent_if_small(known), docs[id_col].eqNullSafe(known["_id"]) & (text == known["_hash"]))
    chance = F.pmod(F.xxhash64(F.lit("mix"), known["_id"], known["_hash"]), F.lit(1_000_000)) / 1_000_000
    times = F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")
    # the copies' number comes last, whatever the columns before are called
    repeated = joined.select(*(docs[c] for c in docs.columns), F.explode(F.when(times > 0, F.sequence(F.lit(1), times))).alias(_unused(docs, "_times")))
    return repeated.drop(repeated.columns[-1])


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, with marks behind until no column has it."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates that bring all documents' languages to TARGETS at the present number of tokens."""
    docs = table(spark, sf_dir, "documents")
    rates = mixing_rates(docs, labelled_languages(docs, table(spark, sf_dir, "labels")), TARGETS)
    return rates.select("doc_id", "tokens", *(F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(TARGETS)), "rate")


QUERIES = {"op1_mixing": op1_mixing}
ORACLE_SQL: dict[str, str] = {}

"""Nearest neighbours by a forest of random-projection trees with a shared queue.

Every vector is indexed in one leaf of each tree. A query walks all trees with
one priority queue keyed by how unlikely its neighbours are to lie behind the
splits passed, so the most promising leaves of the whole forest come first. How
many leaves it visits is measured on the fitted sample: as many as find the wanted
share of its nearest, so clustered vectors need few leaves and unstructured ones most.

Leaves are tasks in groups, the subtrees of up to 64 leaves: a query is sent once
to a group, with a bit for each leaf it visits, and the group answers with its
best over those leaves. Large groups are cut into blocks of stored vectors, and
queries stream past a block batch by batch, so a task's memory is bounded and a
vector is sent once for each tree, however many queries there are. Answers are
ranked by the exact product of the original vectors.

For inner products of vectors of unequal norms the trees see one more component,
sqrt(largest² - norm²), under which the largest product is the smallest angle.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from heddle.llm.forest import Tree, block_of, component_kind, dimensions, fit_sample, fit_tree, keys, matrix, packed, sound, unit_rows, unpacked
from heddle.plans.durable import Scratch
from heddle.sources import table

NEIGHBOURS = 20
TREES = 4
LEAF_ROWS = 128
#: Share of the true nearest of a sample's queries that their visits have to find.
RECALL = 0.96
#: Sampled queries that the visits are measured on, at most.
MEASURED = 300
#: Leaves of a group: the bits of a mask.
GROUP_LEAVES = 64
#: Stored vectors of a group in one task, about; more are dealt to more tasks.
STORED_BLOCK = 16_384
#: Steepness at which the logistic function is nearest to the normal distribution's.
LOGISTIC = 1.702
#: Pairs scored at once.
SCORED = 200_000


@dataclass
class Outlook:
    """Where a query's neighbours are expected: at ``share`` of its own projection on a split's direction, give or take ``spread``."""

    share: float
    spread: float

    @classmethod
    def of(cls, sample: np.ndarray, queries: np.ndarray, k: int) -> "Outlook":
        """From the cosines of some of the sample's rows with their ``k`` nearest others."""
        asked = np.unique(np.linspace(0, len(sample) - 1, min(100, len(sample))).astype(np.int64))
        products = queries[asked] @ sample.T
        products[np.arange(len(asked)), asked] = -np.inf
        k = min(k, len(sample) - 1)
        near = -np.partition(-products, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((1, 1))
        square = max(float(np.einsum("ij,ij->i", sample, sample).max(initial=0.0)), np.finfo(np.float64).tiny)
        share = float(np.clip(near.mean() / square, 0.0, 0.999))
        return cls(share, float(np.sqrt(square * (1 - share * share) / sample.shape[1])))

    def costs(self, tree: Tree, vector: np.ndarray) -> np.ndarray:
        """For each node the costs, negative log-likelihoods, of its left and its right side."""
        z = LOGISTIC * (self.share * (tree.directions @ vector) - tree.thresholds) / self.spread
        return np.stack((np.logaddexp(0, z), np.logaddexp(0, -z)), axis=1)


def search(forest: list[Tree], outlook: Outlook, vector: np.ndarray, visits: int) -> list[tuple[int, int]]:
    """The (tree, leaf) pairs that a query visits, most promising first."""
    costs = [outlook.costs(tree, vector).tolist() for tree in forest]
    sides = [tree.children.tolist() for tree in forest]
    queue, found = [(0.0, number, tree.root) for number, tree in enumerate(forest)], []
    while queue and len(found) < visits:
        cost, number, node = heapq.heappop(queue)
        if node < 0:
            found.append((number, -node - 1))
            continue
        for side, more in zip(sides[number][node], costs[number][node]):
            heapq.heappush(queue, (cost + more, number, side))
    return found


def needed_visits(forest: list[Tree], outlook: Outlook, sample: np.ndarray, queries: np.ndarray, n: int, k: int, recall: float = RECALL) -> int:
    """Leaves to visit so that the sample's queries find ``recall`` of their nearest in the mean.

    ``queries`` are the sample's rows as they are when they ask. The sample's k * (its share of n) nearest stand for the k nearest of all.
    """
    total = sum(tree.leaves for tree in forest)
    if len(sample) < 2:
        return total
    asked = np.unique(np.linspace(0, len(sample) - 1, min(MEASURED, len(sample))).astype(np.int64))
    k = min(len(sample) - 1, max(1, round(k * len(sample) / n)))
    homes = []
    for tree in forest:
        rows, leaves = tree.route(sample)
        home = np.empty(len(sample), dtype=np.int64)
        home[rows] = leaves
        homes.append(home)
    when = []
    for q in asked.tolist():
        order = search(forest, outlook, queries[q], total)
        rank = [np.zeros(tree.leaves, dtype=np.int64) for tree in forest]
        for place, (number, leaf) in enumerate(order):
            rank[number][leaf] = place + 1
        scores = sample @ queries[q]
        scores[q] = -np.inf
        near = np.flatnonzero(scores >= -np.partition(-scores, k - 1)[k - 1] - 1e-9)  # with all that tie
        when.append(np.min([r[h[near]] for r, h in zip(rank, homes)], axis=0))
    when = np.sort(np.concatenate(when))
    return int(when[min(len(when) - 1, int(np.ceil(recall * len(when))) - 1)])


def leaf_groups(tree: Tree, leaves: int = GROUP_LEAVES) -> tuple[np.ndarray, np.ndarray]:
    """Each leaf's group and its place there: leaves are numbered in the order of the tree, so neighbours are near."""
    number = np.arange(tree.leaves)
    return number // leaves, number % leaves


def _least_ids(rows: DataFrame, most: int) -> DataFrame:
    """(k0, k1, v, ids, node): distinct vectors with their ``most`` least ids, in order and repeats included; node is the least.

    Partitions reduce first, so a vector met everywhere brings few rows to its task.
    """

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}
        for batch in batches:
            for k0, k1, number, v in zip(batch["k0"].tolist(), batch["k1"].tolist(), batch["vec_id"].tolist(), batch["v"]):
                ids = held.setdefault((k0, k1), [v, []])[1]
                ids.append(number)
                if len(ids) > 4 * most:
                    ids[:] = sorted(ids)[:most]
            if len(held) > 20_000:
                yield flush(held)
                held = {}
        if held:
            yield flush(held)

    def flush(held: dict) -> pd.DataFrame:
        k0, k1 = zip(*held)
        return pd.DataFrame({"k0": k0, "k1": k1, "v": [v for v, _ in held.values()], "ids": [sorted(ids)[:most] for _, ids in held.values()]})

    kind = rows.schema["v"].dataType.simpleString()
    reduced = rows.select("k0", "k1", "vec_id", "v").mapInPandas(reduce, f"k0 long, k1 long, v {kind}, ids array<long>")
    merged = reduced.groupBy("k0", "k1").agg(F.first("v").alias("v"), F.flatten(F.collect_list("ids")).alias("ids"))
    return merged.select("k0", "k1", "v", F.slice(F.sort_array("ids"), 1, most).alias("ids")).withColumn("node", F.col("ids")[0])


def nearest(
    vectors: DataFrame, every: int = 20, k: int = NEIGHBOURS, trees: int = TREES, leaf_rows: int = LEAF_ROWS, recall: float = RECALL,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found for each query.

    Queries are the rows whose id is divisible by ``every``, candidates all
    other rows; ties go to the smaller id. Rows that are null, empty or zero, hold
    null or non-finite components or have no id take no part. Vectors of different
    lengths have no product; each length is searched by itself. Rows that repeat
    an id are rows of their own: each is a query, and a candidate of all but
    itself. Other columns are not read; an empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "ann")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    if component_kind(rows, "v") == "<f8":
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    rows = rows.where(sound(F.col("v")) & F.col("vec_id").isNotNull()).select("vec_id", "v", *keys(F.col("v")))
    points = scratch.keep(_least_ids(rows, k + 1), "points")
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", "k0", "k1").join(points.select("k0", "k1", "node"), ["k0", "k1"])
    queries = scratch.keep(queries.select("vec_id", "node"), "queries")
    asked = points.join(queries.select("node").distinct(), "node", "left_semi").select("node", "v")
    best = None
    for dim in dimensions(points, "v"):
        found = _search_all(points.where(F.size("v") == dim).select("node", "v"), asked.where(F.size("v") == dim), k, trees, leaf_rows, recall)
        best = found if best is None else best.unionByName(found)
    if best is None:
        best = points.select("node", F.lit(b"").alias("scores"), F.lit(b"").alias("others"))
    # a query vector's best vectors, each once, then the least ids among those
    answers = best.groupBy("node").agg(F.collect_list("scores").alias("scores"), F.collect_list("others").alias("others"))
    hits = _best_of(answers, k + 1)
    named = hits.join(points.select(F.col("node").alias("other"), "ids"), "other")
    single = named.select("node", F.transform("ids", lambda i: F.struct(F.col("down").alias("down"), i.alias("id"), F.col("other").alias("other"))).alias("ids"))
    found = single.groupBy("node").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("found"))
    # one entry with the query's own id and vector is the query itself
    own = F.array_position(F.transform("found", lambda f: (f["id"] == F.col("vec_id")) & (f["other"] == F.col("node"))), True).cast("int")
    others = F.when(own > 0, F.concat(F.slice("found", F.lit(1), own - 1), F.slice("found", own + 1, F.size("found")))).otherwise(F.col("found"))
    ranked = queries.join(found, "node").select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("place", "hit"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.down")).alias("score"))


def _best_of(answers: DataFrame, most: int) -> DataFrame:
    """(node, down, other): the ``most`` best of each node's answers by (-score, other), each other once.

    A row holds what a query's groups have answered, ``most`` for each.
    """

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for node, scores, others in zip(batch["node"], batch["scores"], batch["others"]):
                others, first = np.unique(np.frombuffer(b"".join(others), dtype="<i8"), return_index=True)
                down = -np.frombuffer(b"".join(scores), dtype="<f8")[first]
                order = np.lexsort((others, down))[:most]
                parts.append((np.full(len(order), node), down[order], others[order]))
            if parts:
                node, down, other = (np.concatenate(x) for x in zip(*parts))
                yield pd.DataFrame({"node": node, "down": down, "other": other})

    return answers.mapInPandas(merge, "node long, down double, other long")


def _extended(vectors: np.ndarray, top: float | None) -> np.ndarray:
    """``vectors`` with the component that evens norms out; unchanged if top is None."""
    if top is None or not vectors.size:
        return vectors
    return np.column_stack((vectors, np.sqrt(np.maximum(top - np.einsum("ij,ij->i", vectors, vectors), 0))))


def _asking(vectors: np.ndarray, top: float | None) -> np.ndarray:
    """``vectors`` as queries: of the stored vectors' norm, with 0 where those have the component that evens norms out."""
    if top is None or not vectors.size:
        return vectors
    return np.column_stack((unit_rows(vectors) * np.sqrt(top), np.zeros(len(vectors))))


class Stored:
    """A block's vectors in the order of their leaves."""

    def __init__(self, vectors: np.ndarray, nodes: np.ndarray, leaves: np.ndarray):
        order = np.argsort(leaves, kind="stable")
        self.vectors, self.nodes = vectors[order], nodes[order]
        self.cuts = np.searchsorted(leaves[order], np.arange(GROUP_LEAVES + 1))

    def best(self, wanted: np.ndarray, masks: np.ndarray, most: int, step: int = 256) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, scores, nodes): the ``most`` best vectors in the leaves of each query's mask, ties to the smaller node."""
        for start in range(0, len(wanted), step):
            some, bits = wanted[start : start + step], masks[start : start + step]
            rough = np.full((len(some), len(self.vectors)), -np.inf)
            for leaf in range(GROUP_LEAVES):
                a, b = self.cuts[leaf], self.cuts[leaf + 1]
                asking = np.flatnonzero(bits >> np.uint64(leaf) & np.uint64(1))
                if b > a and len(asking):
                    rough[asking, a:b] = some[asking] @ self.vectors[a:b].T
            keep = min(most, len(self.vectors))
            # all that reach the last kept product, up to rounding: more than are kept where products tie
            last = -np.partition(-rough, keep - 1, axis=1)[:, keep - 1]
            bound = np.where(last > -np.inf, last - 1e-9 * (1 + np.abs(last)), np.finfo(np.float64).min)
            q, at = np.nonzero(rough >= bound[:, None])
            # products summed in one order wherever a pair meets, so that equal pairs have equal scores
            scores = np.concatenate([np.zeros(0), *((some[q[k : k + SCORED]] * self.vectors[at[k : k + SCORED]]).sum(axis=1) for k in range(0, len(q), SCORED))])
            order = np.lexsort((self.nodes[at], -scores, q))
            cuts = np.searchsorted(q, np.arange(len(some) + 1))
            for i in range(len(some)):
                own = order[cuts[i] : cuts[i + 1]][:most]
                if len(own):
                    yield start + i, scores[own], self.nodes[at[own]]


def _search_all(points: DataFrame, asked: DataFrame, k: int, trees: int, leaf_rows: int, recall: float) -> DataFrame:
    """(node, scores, others): each query's best of each group that it visits, as packed numbers."""
    square = F.aggregate(F.transform("v", lambda x: x.cast("double")), F.lit(0.0), lambda t, x: t + x * x)
    n, top, least = points.agg(F.count("*"), F.max(square), F.min(square)).first()
    top = top if top - least > 1e-3 * top else None
    kind, most = component_kind(points, "v"), k + 1
    own = fit_sample(points, n, "node", "v")
    sample = _extended(own, top)
    forest = [fit_tree(sample, n, leaf_rows, seed) for seed in range(trees)]
    outlook = Outlook.of(sample, _asking(own, top), most)
    visits = needed_visits(forest, outlook, sample, _asking(own, top), n, most, recall)
    groups, places = zip(*map(leaf_groups, forest))
    first_group = np.cumsum([0] + [int(g.max()) + 1 for g in groups])
    sizes = np.concatenate([np.bincount(g, weights=tree.shares) for g, tree in zip(groups, forest)])
    stored_blocks = np.maximum(1, np.ceil(sizes * n / STORED_BLOCK)).astype(np.int64)
    sent = points.sparkSession.sparkContext.broadcast(forest)

    def row_batch(group: np.ndarray, block: np.ndarray, asks: bool, nodes: np.ndarray, mark: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(group), pa.array(block), pa.array(np.full(len(group), asks)), pa.array(nodes), pa.array(mark.astype(np.int64, copy=False)), packed(vectors, kind)]
        return pa.RecordBatch.from_arrays(columns, names=["group", "block", "asks", "node", "mark", "v"])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes, own = batch.column(0).to_numpy(), matrix(batch.column(1))
            seen = _extended(own, top)
            for number, tree in enumerate(sent.value):
                r, leaf = tree.route(seen)
                group = first_group[number] + groups[number][leaf]
                yield row_batch(group, block_of(nodes[r], stored_blocks[group]), False, nodes[r], places[number][leaf], own[r])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes, own = batch.column(0).to_numpy(), matrix(batch.column(1))
            rows: list[tuple[int, int, int]] = []
            for q, vector in enumerate(_asking(own, top)):
                masks: dict[int, int] = {}
                for number, leaf in search(sent.value, outlook, vector, visits):
                    group = int(first_group[number] + groups[number][leaf])
                    masks[group] = masks.get(group, 0) | 1 << int(places[number][leaf])
                rows += [(q, group, mask) for group, mask in masks.items()]
            q, group, mask = np.array(rows, dtype=np.uint64).T
            q, group = q.astype(np.int64), group.astype(np.int64)
            again = np.repeat(np.arange(len(q)), stored_blocks[group])
            block = np.arange(len(again)) - np.repeat(np.cumsum(stored_blocks[group]) - stored_blocks[group], stored_blocks[group])
            for start in range(0, len(again), 10_000):
                at = again[start : start + 10_000]
                yield row_batch(group[at], block[start : start + 10_000], True, nodes[q[at]], mask[at].view(np.int64), own[q[at]])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, stored = [], None
        for batch in batches:
            split = int(np.searchsorted(batch["asks"].to_numpy(zero_copy_only=False), True))  # stored vectors come first
            if split:
                held.append(batch.slice(0, split))
            wanted = batch.slice(split)
            if not wanted.num_rows or not held:
                continue
            if stored is None:
                rows = pa.Table.from_batches(held)
                stored = Stored(unpacked(rows["v"], kind), rows["node"].to_numpy(), rows["mark"].to_numpy())
            asking = wanted["node"].to_numpy()
            found = [(asking[q], s.astype("<f8").tobytes(), o.astype("<i8").tobytes()) for q, s, o in stored.best(unpacked(wanted["v"], kind), wanted["mark"].to_numpy().view(np.uint64), most)]
            node, scores, others = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(node, type=pa.int64()), pa.array(scores, type=pa.binary()), pa.array(others, type=pa.binary())], names=["node", "scores", "others"])

    fields = "group long, block long, asks boolean, node long, mark long, v binary"
    both = points.mapInArrow(index, fields).unionByName(asked.mapInArrow(visit, fields))
    dealt = both.repartition("group", "block").sortWithinPartitions("group", "block", "asks")
    return dealt.groupBy("group", "block").applyInArrow(answer, "node long, scores binary, others binary")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all embeddings for every row whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"))


QUERIES = {"op8_nearest": op8_nearest}
ORACLE_SQL: dict[str, str] = {}

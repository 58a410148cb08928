"""Embedding near-duplicates by a forest of spilling random-projection trees.

Equal vectors collapse to one weighted point. Each tree deals every point to a
leaf, and points near a split to both sides, so that a close pair shares a leaf
of some tree with high probability; inside a leaf all cosines are computed in
blocks, in double precision. A pair that meets in several leaves counts only in
the one with the smallest number that both points belong to. So a leaf yields
a row for each linked point, its links and an edge to its set's representative,
and pairs never leave the task. Splits pass beside dense clusters, which stay in
a leaf; a large leaf is cut into blocks, and each pair of blocks is a group.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from heddle.llm.forest import Tree, block_of, component_kind, dimensions, fit_sample, fit_tree, keys, matrix, packed, ragged, sound, unit_rows, unpacked, unragged
from heddle.llm.simhash import LinkedSets
from heddle.plans.components import connected_components
from heddle.plans.durable import Scratch
from heddle.sources import table

THRESHOLD = 0.9
TREES = 4
LEAF_ROWS = 1024
#: Half-width of the overlap at a split, in standard deviations of unit vectors' projections.
SPILL = 0.24
#: Points of a block of a large leaf.
BLOCK_ROWS = 4096
#: Cosines computed at once.
BLOCK = 1 << 20


def leaf_links(
    vectors: np.ndarray, codes: np.ndarray, weights: np.ndarray, leaf: int, threshold: float = THRESHOLD, block: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """For each point of a group: the weight of its links that count here, and its set's least index.

    ``codes`` holds each point's leaves in order, padded with -1. ``block`` has
    each point's block where the group holds two: then only pairs across count.
    Links are compared by exact double-precision cosines; single precision sorts
    out what is far below.
    """
    unit = unit_rows(vectors)
    links, sets = np.zeros(len(unit)), LinkedSets(len(unit))
    first = codes[:, 0] == leaf  # a pair one of whose points has no smaller leaf counts here
    rows = cols = np.arange(len(unit))
    across = block is not None and len(np.unique(block)) > 1
    if across:
        rows, cols = np.flatnonzero(block == block.min()), np.flatnonzero(block != block.min())
    rough = unit.astype(np.float32)
    others = rough[cols]
    step = max(1, BLOCK // max(1, len(cols)))
    for start in range(0, len(rows), step):
        some = rows[start : start + step]
        skipped = 0 if across else start
        a, b = np.nonzero(rough[some] @ others[skipped:].T >= threshold - 1e-4)
        if len(a) * 20 > len(some) * (len(cols) - skipped):  # a dense block
            a, b = np.nonzero(unit[some] @ unit[cols[skipped:]].T >= threshold)
        else:
            near = np.einsum("ij,ij->i", unit[some[a]], unit[cols[skipped + b]]) >= threshold
            a, b = a[near], b[near]
        a, b = some[a], cols[skipped + b]
        if not across:
            above = a < b
            a, b = a[above], b[above]
        sets.link(a, b)
        doubt = np.flatnonzero(~(first[a] | first[b]))
        counts = np.ones(len(a), dtype=bool)
        for k in range(0, len(doubt), 200_000):
            few = doubt[k : k + 200_000]
            earlier = np.zeros(len(few), dtype=bool)
            for i in range(codes.shape[1]):
                mine = codes[a[few], i]
                inside = (mine >= 0) & (mine < leaf)
                if not inside.any():
                    break
                earlier |= inside & (codes[b[few]] == mine[:, None]).any(axis=1)
            counts[few] = ~earlier
        links += np.bincount(a[counts], weights=weights[b[counts]], minlength=len(unit))
        links += np.bincount(b[counts], weights=weights[a[counts]], minlength=len(unit))
    return links.astype(np.int64), sets.roots()


def vector_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    ``n_links`` counts the other rows found at a cosine of ``threshold`` or more.
    Rows that are null, empty or zero, hold null or non-finite components or have
    no id link with nothing: 0 links, themselves as component. Vectors of
    different lengths have no cosine; each length is linked by itself. Repeated
    rows link with each other. ``kept`` is null for a null id. Other columns are
    not read; an empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "vecdup")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    usable = sound(F.col("v")) & F.col("vec_id").isNotNull()
    keyed = rows.select("vec_id", "v", *(F.when(usable, k).alias(name) for name, k in zip(("k0", "k1"), keys(F.col("v")))))
    points = keyed.where("k0 is not null").groupBy("k0", "k1").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.first("v").alias("v"))
    points = scratch.keep(points, "points")
    found = None
    for dim in dimensions(points, "v"):
        own = points.where(F.size("v") == dim)
        n, kind = own.count(), component_kind(points, "v")
        sample = unit_rows(fit_sample(own, n, "node", "v"))
        forest = [fit_tree(sample, n, leaf_rows, seed, SPILL / np.sqrt(dim)) for seed in range(trees)]
        leaves = _leaf_rows(own, forest, SPILL / np.sqrt(dim), threshold, n, block_rows, kind)
        found = leaves if found is None else found.unionByName(leaves)
    if found is None:
        found = points.select("node", F.col("node").alias("root"), F.col("weight").alias("links"))
    found = scratch.keep(found, "leaves")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    members = connected_components(found.where("node <> root").select(F.col("node").alias("src"), F.col("root").alias("dst")), scratch)
    labelled = points.select("k0", "k1", "node", "weight").join(links, "node", "left").join(members, "node", "left")
    n_links = F.coalesce("links", F.lit(0)) + F.col("weight") - 1
    labelled = labelled.select("k0", "k1", n_links.alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    whole = keyed.select("vec_id", "k0", "k1").join(labelled, ["k0", "k1"], "left")
    component = F.coalesce("component_id", "vec_id")
    return whole.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def _leaf_rows(points: DataFrame, forest: list[Tree], spill: float, threshold: float, n: int, block_rows: int, kind: str) -> DataFrame:
    """(node, root, links): what each point's leaves say, where it has links there."""
    blocks = np.concatenate([np.maximum(1, np.ceil(tree.shares * n / (2 * block_rows))).astype(np.int64) for tree in forest])
    first_leaf = np.cumsum([0] + [tree.leaves for tree in forest])
    sent = points.sparkSession.sparkContext.broadcast(forest)
    schema = pa.schema([("leaf", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("block", pa.int64()), ("codes", pa.binary()), ("node", pa.int64()), ("weight", pa.int64()), ("v", pa.binary())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes, weights, vectors = batch.column(0).to_numpy(), batch.column(1).to_numpy(), matrix(batch.column(2))
            unit, rows, leaves = unit_rows(vectors), [], []
            for number, tree in enumerate(sent.value):
                r, at = tree.route(unit, spill)
                rows.append(r)
                leaves.append(at + first_leaf[number])
            rows, leaves = np.concatenate(rows), np.concatenate(leaves)
            order = np.lexsort((leaves, rows))
            rows, leaves = rows[order], leaves[order]
            copies = np.bincount(rows, minlength=len(nodes))
            begins = np.cumsum(copies) - copies
            # a point of a leaf in several blocks goes to the group of its own with each
            times = blocks[leaves]
            own = block_of(nodes[rows], times)
            again = np.repeat(np.arange(len(rows)), times)
            other = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
            for k in range(0, len(again), 5000):
                at, with_block = again[k : k + 5000], other[k : k + 5000]
                r, mine = rows[at], own[at]
                n_codes = copies[r]
                codes = leaves[np.repeat(begins[r] - np.cumsum(n_codes) + n_codes, n_codes) + np.arange(n_codes.sum())]
                columns = [leaves[at], np.minimum(mine, with_block), np.maximum(mine, with_block), mine]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), ragged(codes, n_codes), pa.array(nodes[r]), pa.array(weights[r]), packed(vectors[r], kind)], schema=schema)

    def link(group: pa.Table) -> pa.Table:
        nodes, leaf = group["node"].to_numpy(), group["leaf"][0].as_py()
        two = group["low"][0].as_py() != group["high"][0].as_py()
        block = group["block"].to_numpy() if two else None
        if two and len(np.unique(block)) < 2:
            linked, links, roots = np.zeros(0, dtype=np.int64), np.zeros(len(nodes), dtype=np.int64), np.arange(len(nodes))
        else:
            links, roots = leaf_links(unpacked(group["v"], kind), unragged(group["codes"]), group["weight"].to_numpy(), leaf, threshold, block)
            linked = np.flatnonzero((links > 0) | (roots != np.arange(len(nodes))))
        return pa.table({"node": nodes[linked], "root": nodes[roots[linked]], "links": links[linked]})

    fields = "leaf long, low long, high long, block long, codes binary, node long, weight long, v binary"
    dealt = points.select("node", "weight", "v").mapInArrow(deal, fields)
    return dealt.groupBy("leaf", "low", "high").applyInArrow(link, "node long, root long, links long")


def op7_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9."""
    return vector_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op7_vector_duplicates": op7_vector_duplicates}
ORACLE_SQL: dict[str, str] = {}

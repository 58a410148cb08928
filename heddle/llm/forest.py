"""Forests of random-projection trees over vectors, fitted on a bounded sample.

Vectors travel between tasks as packed binary of their own component type and are
computed with as doubles.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Vectors that trees are fitted on, at most. Every vector is indexed.
FIT_ROWS = 40_000
#: Levels of a tree and sampled vectors of a node that is split: they bound what is sent to
#: tasks. Leaves that stay larger than asked for are dealt to several tasks in blocks.
MOST_DEPTH = 12
LEAST_SAMPLE = 16
#: Random directions tried at a split of a spilling tree.
TRIES = 3
#: Share of a node that a split may deal to both sides; beyond it the node is a leaf.
MOST_SHARED = 0.4


def finite(vector: Column) -> Column:
    """Whether a vector has components, all of them finite."""
    each = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce(each & (F.size(vector) > 0), F.lit(False))


def sound(vector: Column) -> Column:
    """Whether a vector has components, all finite, and isn't zero."""
    return F.coalesce(finite(vector) & F.exists(vector, lambda x: x != 0), F.lit(False))


def keys(vector: Column) -> list[Column]:
    """Two 64-bit hashes that name a vector's value: equal vectors have equal ones, and others in effect never."""
    return [F.xxhash64(vector).alias("k0"), F.xxhash64(F.reverse(vector)).alias("k1")]


def dimensions(rows: DataFrame, column: str) -> list[int]:
    """The numbers of components present, ascending. Vectors of different ones have no product."""
    return [r[0] for r in rows.select(F.size(column)).distinct().orderBy(F.size(column)).collect()]


def component_kind(rows: DataFrame, column: str) -> str:
    return "<f4" if rows.schema[column].dataType.elementType.typeName() == "float" else "<f8"


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equal-length lists as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def packed(rows: np.ndarray, kind: str) -> pa.Array:
    """Rows as binary of the component type."""
    rows = np.ascontiguousarray(rows, dtype=kind)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def ragged(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Runs of 32-bit numbers as binary."""
    offsets = np.concatenate(([0], 4 * np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values, dtype="<i4"))])


def bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A binary column's bytes in a row, and each value's length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]], np.diff(offsets)


def unpacked(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """The rows of doubles that ``packed`` holds."""
    data, sizes = bytes_of(column)
    return data.view(kind).astype(np.float64).reshape(len(sizes), -1)


def unragged(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The runs that ``ragged`` holds, as rows padded with -1."""
    data, sizes = bytes_of(column)
    sizes = sizes // 4
    out = np.full((len(sizes), sizes.max(initial=0)), -1, dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = data.view("<i4")
    return out


def unit_rows(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), np.finfo(np.float64).tiny)


def fit_sample(points: DataFrame, n: int, key: str, vector: str, rows: int = FIT_ROWS) -> np.ndarray:
    """At most ``rows`` vectors of ``n``, picked by a hash of the key so that reruns agree."""
    share = min(1.0, 1.2 * rows / max(n, 1))
    picked = points.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(share * 1_000_000)).orderBy(F.xxhash64(key), key).select(vector).limit(rows)
    return matrix(picked.toArrow().column(0))


class Tree:
    """A binary tree of splits by random directions.

    A vector goes right when its product with a node's direction exceeds the
    node's threshold. ``children`` below zero are leaves, -1 the first. ``shares``
    are the sample's shares in each leaf, spilled vectors counted in each.
    """

    def __init__(self, dim: int, root: int, nodes: list[tuple[np.ndarray, float, int, int]], shares: list[float]):
        self.root, self.shares = root, np.array(shares)
        self.directions = np.array([d for d, *_ in nodes]).reshape(len(nodes), dim)
        self.thresholds = np.array([t for _, t, *_ in nodes])
        self.children = np.array([node[2:] for node in nodes], dtype=np.int64).reshape(-1, 2)

    @property
    def leaves(self) -> int:
        return len(self.shares)

    def route(self, vectors: np.ndarray, spill: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of each leaf that each vector belongs to.

        A vector within ``spill`` of a threshold goes to both sides.
        """
        rows, leaves, stack = [], [], [(self.root, np.arange(len(vectors)))]
        while stack:
            node, at = stack.pop()
            if not len(at):
                continue
            if node < 0:
                rows.append(at)
                leaves.append(np.full(len(at), -node - 1))
                continue
            margin = vectors[at] @ self.directions[node] - self.thresholds[node]
            left, right = self.children[node]
            stack += [(left, at[margin <= spill]), (right, at[margin > -spill])]
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([none, *rows]), np.concatenate([none, *leaves])


def fit_tree(sample: np.ndarray, n: int, leaf_rows: int, seed: int, spill: float = 0.0) -> Tree:
    """A tree over ``n`` vectors with leaves of about ``leaf_rows``.

    Without spill the sample's medians split. With spill, of several directions and
    of the thresholds between the quarters, the split that the fewest vectors lie
    near is taken: it passes beside a dense cluster, not through it. A node that
    any split would deal to both sides for the most part, a dense cluster by
    itself, stays a leaf.
    """
    chance, dim = np.random.default_rng(seed), sample.shape[1]
    nodes: list = []
    shares: list[float] = []
    weight = 1 / max(len(sample), 1)

    def split(at: np.ndarray) -> tuple | None:
        best = None
        for _ in range(TRIES if spill else 1):
            direction = chance.standard_normal(dim)
            direction /= np.linalg.norm(direction)
            where = np.sort(sample[at] @ direction)
            cuts = np.quantile(where, np.linspace(0.25, 0.75, 21)) if spill else [np.median(where)]
            for cut in cuts:
                near = np.searchsorted(where, cut + spill, side="right") - np.searchsorted(where, cut - spill, side="right")
                if where[0] <= cut < where[-1] and (best is None or near < best[0]):
                    best = (near, direction, float(cut))
        return best

    def grow(at: np.ndarray, depth: int) -> int:
        found = split(at) if len(at) * weight * n > leaf_rows and len(at) >= LEAST_SAMPLE and depth < MOST_DEPTH else None
        if found is None or found[0] > MOST_SHARED * len(at):
            shares.append(len(at) * weight)
            return -len(shares)
        _, direction, cut = found
        node = len(nodes)
        nodes.append(None)
        where = sample[at] @ direction - cut
        left = grow(at[where <= spill], depth + 1)
        nodes[node] = (direction, cut, left, grow(at[where > -spill], depth + 1))
        return node

    return Tree(dim, grow(np.arange(len(sample)), 0), nodes, shares)


def block_of(node: np.ndarray, blocks: np.ndarray | int) -> np.ndarray:
    """A number below ``blocks`` for each id, evenly whatever the ids are."""
    spread = (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (spread % np.asarray(blocks, dtype=np.uint64)).astype(np.int64)

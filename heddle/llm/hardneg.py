"""Hard negatives by dual-tree search: trees over anchors and over candidates.

Every node of a tree is a ball that holds all its vectors, so two nodes bound the
inner products of all their pairs from both sides. A pair of nodes whose interval
misses what each of the node's anchors still wants is pruned with all its anchors
at once; what is left at the leaves is scored exactly, in whole numbers.

The upper levels are one tree fitted on a bounded sample, whose leaves are shards;
their balls are measured over all rows, and as anchors are rows too, the same
leaves group the anchors. Shards are cut into blocks of bounded size. A group of a
task is a block: it reads its candidates, builds the lower levels of their tree,
and lets the anchors that visit it stream past, batch by batch, so a candidate is
sent once however many anchors there are. Each search runs twice, first in the
anchors' own shards, whose finds tighten what is wanted of all others.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heddle.llm.forest import block_of, bytes_of, dimensions, finite, fit_sample, fit_tree, matrix, packed
from heddle.plans.durable import Scratch
from heddle.sources import table

POSITIVES = 5
NEGATIVES = 3
#: Bounds of a negative's score, in percent of the positive's.
LOW, HIGH = 50, 95
SCALE = 256
#: Rows of a shard, about, and of a block at most, about.
SHARD_ROWS = 8192
BLOCK_ROWS = 32_768
#: Candidates and anchors of a leaf inside a block, and anchors searched at once.
LEAF_ROWS = 256
LEAF_ANCHORS = 32
BATCH_ANCHORS = 2048
#: Scores beyond any.
NONE_LOW, NONE_HIGH = -(1 << 62), 1 << 62


class Balls:
    """A binary tree of balls over rows: centres, radii, children (below zero in leaves), and each leaf's rows."""

    def __init__(self, rows: np.ndarray, leaf: int):
        self.rows, self.leaf_rows = rows, []
        self.centres, self.radii, self.children, self.leaf_of = [], [], [], []
        self._grow(np.arange(len(rows)), leaf)
        self.centres, self.radii, self.children = np.array(self.centres), np.array(self.radii), np.array(self.children).reshape(-1, 2)
        self.norms, self.leaf_of = np.linalg.norm(self.centres, axis=1), np.array(self.leaf_of)

    def _grow(self, at: np.ndarray, leaf: int) -> int:
        own = self.rows[at]
        centre = own.mean(axis=0)
        away = np.linalg.norm(own - centre, axis=1)
        node = len(self.radii)
        self.centres.append(centre)
        self.radii.append(away.max())
        self.children.append((-1, -1))
        self.leaf_of.append(-1)
        if len(at) > leaf and away.max() > 0:
            # between the row furthest from the centre and the row furthest from that one
            pole = own[away.argmax()]
            other = own[np.linalg.norm(own - pole, axis=1).argmax()]
            along = own @ (other - pole)
            order = np.argsort(along, kind="stable")
            half = len(order) // 2
            low = self._grow(at[order[:half]], leaf)
            self.children[node] = (low, self._grow(at[order[half:]], leaf))
        else:
            self.leaf_of[node] = len(self.leaf_rows)
            self.leaf_rows.append(at)
        return node

    def upward(self, of_rows: np.ndarray, least: bool) -> np.ndarray:
        """Each node's least or largest of its rows' values."""
        pick = np.min if least else np.max
        out = np.empty(len(self.radii), dtype=of_rows.dtype)
        for node in range(len(self.radii) - 1, -1, -1):  # children come behind their parents
            low, high = self.children[node]
            out[node] = pick(of_rows[self.leaf_rows[self.leaf_of[node]]]) if low < 0 else pick(out[[low, high]])
        return out


def interval(product: np.ndarray, norm_a: np.ndarray, radius_a: np.ndarray, norm_b: np.ndarray, radius_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) of the inner products of two balls' members, given their centres' product; rounding is allowed for."""
    reach = norm_a * radius_b + norm_b * radius_a + radius_a * radius_b
    reach = reach + 1e-9 * (reach + norm_a * norm_b) + 1e-6
    return product - reach, product + reach


class Wishes:
    """What anchors want: for each anchor and wish the ``k`` best scores from ``low`` to ``high``, ties to the smaller id.

    ``low`` rises to the k-th best score found.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low.copy(), high, k
        self.scores = np.full((*low.shape, k), NONE_LOW, dtype=np.int64)
        self.ids = np.full((*low.shape, k), np.iinfo(np.int64).max, dtype=np.int64)

    def offer(self, anchors: np.ndarray, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Scores of some anchors (rows) with candidates (columns)."""
        for wish in range(self.low.shape[1]):
            a, c = np.nonzero(allowed & (scores >= self.low[anchors, wish][:, None]) & (scores <= self.high[anchors, wish][:, None]))
            if not len(a):
                continue
            some = np.unique(a)
            own = anchors[some]
            place = np.repeat(np.arange(len(some)), self.k)
            of = np.concatenate((place, np.searchsorted(some, a)))
            down = -np.concatenate((self.scores[own, wish].ravel(), scores[a, c]))
            known = np.concatenate((self.ids[own, wish].ravel(), ids[c]))
            order = np.lexsort((known, down, of))
            of = of[order]
            rank = np.arange(len(of)) - np.searchsorted(of, np.arange(len(some)))[of]
            best = order[rank < self.k]
            self.scores[own, wish] = -down[best].reshape(-1, self.k)
            self.ids[own, wish] = known[best].reshape(-1, self.k)
            self.low[own, wish] = np.maximum(self.low[own, wish], self.scores[own, wish, -1])


class Block:
    """A block's candidates under a tree of balls."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, exact: bool):
        # in the order of ids, so that of a row's copies the first stands for the row itself
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.rows, self.exact = ids[order], labels[order], rows[order], exact
        self.tree = Balls(self.rows.astype(np.float64), LEAF_ROWS)
        self.values = self.rows if not exact else self.tree.rows

    def answer(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, wishes: Wishes, same: bool) -> int:
        """Meets the wishes of some anchors; gives the number of scores computed."""
        asking, tree = Balls(rows.astype(np.float64), LEAF_ANCHORS), self.tree
        values = rows if not self.exact else asking.rows
        lows, highs = asking.upward(wishes.low.min(axis=1), True), asking.upward(wishes.high.max(axis=1), False)
        a, b, leaf_pairs = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64), []
        while len(a):
            product = np.einsum("ij,ij->i", asking.centres[a], tree.centres[b])
            low, high = interval(product, asking.norms[a], asking.radii[a], tree.norms[b], tree.radii[b])
            left = (high >= lows[a]) & (low <= highs[a])
            a, b, high = a[left], b[left], high[left]
            ends_a, ends_b = asking.children[a, 0] < 0, tree.children[b, 0] < 0
            done = ends_a & ends_b
            leaf_pairs.append((a[done], b[done], high[done]))
            # of two nodes the wider one is opened
            open_a = ~ends_a & (ends_b | (asking.radii[a] > tree.radii[b])) & ~done
            open_b = ~done & ~open_a
            a, b = (
                np.concatenate((asking.children[a[open_a]].ravel(), a[open_b].repeat(2))),
                np.concatenate((b[open_a].repeat(2), tree.children[b[open_b]].ravel())),
            )
        a, b, high = (np.concatenate(x) for x in zip(*leaf_pairs))
        # an anchor by itself is a ball without a radius
        some, leaf_at = np.unique(b, return_inverse=True)
        _, reach = interval(asking.rows @ tree.centres[some].T, np.linalg.norm(asking.rows, axis=1)[:, None], 0.0, tree.norms[some], tree.radii[some])
        computed = 0
        for at in np.lexsort((-high, a)).tolist():  # the most promising first, so that what is wanted rises soon
            here = asking.leaf_rows[asking.leaf_of[a[at]]]
            here = here[wishes.low[here].min(axis=1) <= reach[here, leaf_at[at]]]
            if not len(here):
                continue
            there = tree.leaf_rows[tree.leaf_of[b[at]]]
            scores = values[here] @ self.values[there].T
            scores = np.rint(scores).astype(np.int64) if self.exact else scores
            alike = labels[here][:, None] == self.labels[there][None, :]
            if same:
                alike &= ~self._own(ids[here], rows[here], there)
            wishes.offer(here, scores, alike if same else ~alike, self.ids[there])
            computed += scores.size
        return computed

    def _own(self, ids: np.ndarray, rows: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Which candidate is the anchor itself: of rows with its id and vector the first."""
        out = np.zeros((len(ids), len(there)), dtype=bool)
        first, last = np.searchsorted(self.ids, ids), np.searchsorted(self.ids, ids, side="right")
        where = {int(t): k for k, t in enumerate(there)}
        for i, (f, e) in enumerate(zip(first.tolist(), last.tolist())):
            for at in range(f, e):
                if (self.rows[at] == rows[i]).all():
                    if at in where:
                        out[i, where[at]] = True
                    break
        return out


def _whole(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def _fits(vector: Column) -> Column:
    """Whether a vector's product with itself, and so any that counts, fits a long."""
    return F.aggregate(vector, F.lit(0.0), lambda t, x: t + x * x) < float(2**62)


class Search:
    """Shards of rows of one length, and searches of them for anchors among the rows.

    ``rows`` has (vec_id, label, v) with v whole numbers as doubles, ``anchors``
    (node, vec_id, label, v) of distinct nodes.
    """

    def __init__(self, rows: DataFrame, anchors: DataFrame, scratch: Scratch, shard_rows: int, block_rows: int):
        self.rows, self.anchors, self.scratch = rows, anchors, scratch
        square = F.aggregate("v", F.lit(0.0), lambda t, x: t + x * x)
        n, self.most = rows.agg(F.count("*"), F.coalesce(F.max(square), F.lit(0.0))).first()
        wide = rows.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0.0
        self.kind = "<i2" if wide < 2**15 else "<i4" if wide < 2**31 else "<i8"
        self.exact = self.most < 2**53  # then sums of products in doubles are exact
        sample = fit_sample(rows.withColumn("key", F.xxhash64("vec_id", "v")), n, "key", "v")
        self.tree = fit_tree(sample, n, shard_rows, 0)
        self.blocks = np.maximum(1, np.ceil(self.tree.shares * n / block_rows)).astype(np.int64)
        homes = np.empty(len(sample), dtype=np.int64)
        at, leaf = self.tree.route(sample)
        homes[at] = leaf
        self.centres = np.array([sample[homes == leaf].mean(axis=0) if (homes == leaf).any() else np.zeros(sample.shape[1]) for leaf in range(self.tree.leaves)])
        self.radii = self._radii(rows.select("v"))
        self.anchor_radii = self._radii(anchors.select("v"))

    def home(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(len(values), dtype=np.int64)
        at, leaf = self.tree.route(values)
        out[at] = leaf
        return out

    def _radii(self, vectors: DataFrame) -> np.ndarray:
        """Each leaf's largest distance from its centre, over all ``vectors``; below zero for none."""
        tree, centres, home = self.tree, self.centres, self.home

        def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.full(tree.leaves, -1.0)
            for batch in batches:
                if batch.num_rows:
                    values = matrix(batch.column(0))
                    leaf = home(values)
                    np.maximum.at(out, leaf, np.linalg.norm(values - centres[leaf], axis=1))
            at = np.flatnonzero(out >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], names=["leaf", "away"])

        found = np.full(tree.leaves, -1.0)
        for leaf, away in vectors.mapInArrow(reach, "leaf long, away double").groupBy("leaf").agg(F.max("away")).collect():
            found[leaf] = away * (1 + 1e-12)
        return found

    def __getstate__(self) -> dict:
        """What tasks get: the tree and the balls, without the tables."""
        return {k: v for k, v in self.__dict__.items() if k not in ("rows", "anchors", "scratch")}

    def allowed(self, wanted: DataFrame) -> np.ndarray:
        """(leaf of anchors, shard): whether any pair can be wanted, told by both leaves' balls for all their anchors at once."""
        n = self.tree.leaves
        low, high = np.full(n, np.inf), np.full(n, -np.inf)
        for home, least, most in wanted.groupBy("home").agg(F.min(F.array_min("lows")), F.max(F.array_max("highs"))).collect():
            low[home], high[home] = least, most
        norms = np.linalg.norm(self.centres, axis=1)
        radii_a, radii_b = np.maximum(self.anchor_radii, 0)[:, None], np.maximum(self.radii, 0)[None, :]
        least, most = interval(self.centres @ self.centres.T, norms[:, None], radii_a, norms[None, :], radii_b)
        return (most >= low[:, None]) & (least <= high[:, None]) & (self.radii >= 0)[None, :]

    def run(self, wanted: DataFrame, same: bool, k: int) -> DataFrame:
        """(node, wish, hits): each anchor's ``k`` best (down, vec_id) for each of its wishes.

        ``wanted`` has (node, lows, highs), a pair of bounds for each wish; ``same``
        wants candidates of the anchor's label, other than itself, else of others.
        """
        asks = self.anchors.join(wanted, "node")
        asks = self.scratch.keep(asks.mapInArrow(self._homes(asks), f"{_fields(asks)}, home long"), "asks")
        first = self.scratch.keep(_best(self._meet(asks, same, k, None), k), "first")
        # the k-th best of a wish is the least that is still wanted of it
        least = F.coalesce(-F.get("hits", F.lit(k - 1))["down"], F.lit(NONE_LOW))
        raised = first.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("wish", least.alias("low")))).alias("found"))
        risen = F.transform("lows", lambda low, i: F.greatest(low, F.coalesce(F.try_element_at("found", i), F.lit(NONE_LOW))))
        asks = asks.join(raised, "node", "left").withColumn("lows", risen).drop("found")
        asks = self.scratch.keep(asks, "raised")
        rest = self._meet(asks, same, k, self.allowed(asks))
        return self.scratch.keep(_best(rest.unionByName(first.select("node", "wish", "hits")), k), "found")

    def _homes(self, asks: DataFrame):
        names, home = asks.columns, self.home

        def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home(matrix(batch.column(names.index("v")))))], names=[*names, "home"])

        return told

    def _meet(self, asks: DataFrame, same: bool, k: int, allowed: np.ndarray | None) -> DataFrame:
        """(node, wish, hits) of each block that an anchor visits: its own shard's, or the ``allowed`` others'."""
        me, kind, blocks = self, self.kind, self.blocks
        sent = self.rows.sparkSession.sparkContext.broadcast(allowed)
        norms = np.linalg.norm(self.centres, axis=1)
        schema = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("asks", pa.bool_()), ("node", pa.int64()), ("label", pa.int64()), ("vec_id", pa.int64()), ("v", pa.binary()), ("lows", pa.list_(pa.int64())), ("highs", pa.list_(pa.int64()))])

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    ids, values = batch["vec_id"].to_numpy(), matrix(batch["v"])
                    shard, none = me.home(values), pa.nulls(len(ids), pa.list_(pa.int64()))
                    columns = [pa.array(shard), pa.array(block_of(ids, blocks[shard])), pa.array(np.zeros(len(ids), dtype=bool)), pa.nulls(len(ids), pa.int64()), batch["label"], batch["vec_id"], packed(values, kind), none, none]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                home, values = batch["home"].to_numpy(), matrix(batch["v"])
                if sent.value is None:
                    row, shard = np.arange(len(home)), home
                else:
                    low = np.array([min(x) for x in batch["lows"].to_pylist()], dtype=np.float64)
                    high = np.array([max(x) for x in batch["highs"].to_pylist()], dtype=np.float64)
                    least, most = interval(values @ me.centres.T, np.linalg.norm(values, axis=1)[:, None], 0.0, norms[None, :], np.maximum(me.radii, 0)[None, :])
                    going = sent.value[home] & (most >= low[:, None]) & (least <= high[:, None])
                    going[np.arange(len(home)), home] = False
                    row, shard = np.nonzero(going)
                times = blocks[shard]
                again = np.repeat(np.arange(len(row)), times)
                block = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
                for start in range(0, len(again), 10_000):
                    at = again[start : start + 10_000]
                    r = pa.array(row[at])
                    told = [pa.array(shard[at]), pa.array(block[start : start + 10_000]), pa.array(np.ones(len(at), dtype=bool))]
                    yield pa.RecordBatch.from_arrays([*told, batch["node"].take(r), batch["label"].take(r), batch["vec_id"].take(r), packed(values[row[at]], kind), batch["lows"].take(r), batch["highs"].take(r)], schema=schema)

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, block = [], None
            for batch in batches:
                asking = batch["asks"].to_numpy(zero_copy_only=False)
                split = int(np.searchsorted(asking, True))  # candidates come first
                if split:
                    held.append(batch.slice(0, split))
                if split == batch.num_rows or not held:
                    continue
                if block is None:
                    stored = pa.Table.from_batches(held).combine_chunks()
                    block = Block(stored["vec_id"].to_numpy(), stored["label"].to_numpy(), _ints(stored["v"], kind), me.exact)
                for start in range(split, batch.num_rows, BATCH_ANCHORS):
                    yield _answered(block, batch.slice(start, min(BATCH_ANCHORS, batch.num_rows - start)), kind, same, k)

        fields = "shard long, block long, asks boolean, node long, label long, vec_id long, v binary, lows array<long>, highs array<long>"
        both = self.rows.select("vec_id", "label", "v").mapInArrow(deal, fields).unionByName(asks.select("node", "vec_id", "label", "v", "lows", "highs", "home").mapInArrow(visit, fields))
        dealt = both.repartition("shard", "block").sortWithinPartitions("shard", "block", "asks")
        return dealt.groupBy("shard", "block").applyInArrow(answer, "node long, wish int, hits array<struct<down:long,vec_id:long>>")


def _fields(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


def _ints(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """Packed whole numbers as longs."""
    data, sizes = bytes_of(column)
    return data.view(kind).astype(np.int64).reshape(len(sizes), -1)


def _answered(block: Block, asks: pa.RecordBatch, kind: str, same: bool, k: int) -> pa.RecordBatch:
    lows, highs = (asks[name].to_pylist() for name in ("lows", "highs"))
    width = max(map(len, lows))
    # anchors with fewer wishes have ones that nothing meets
    low = np.array([x + [NONE_HIGH] * (width - len(x)) for x in lows], dtype=np.int64)
    high = np.array([x + [NONE_LOW] * (width - len(x)) for x in highs], dtype=np.int64)
    wishes = Wishes(low, high, k)
    block.answer(asks["vec_id"].to_numpy(), asks["label"].to_numpy(), _ints(asks["v"], kind), wishes, same)
    a, wish, place = np.nonzero(wishes.scores > NONE_LOW)
    starts = np.flatnonzero(np.r_[True, (np.diff(a) != 0) | (np.diff(wish) != 0)]) if len(a) else np.zeros(0, dtype=np.int64)
    hits = pa.StructArray.from_arrays([pa.array(-wishes.scores[a, wish, place]), pa.array(wishes.ids[a, wish, place])], names=["down", "vec_id"])
    lists = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(a)].astype(np.int32)), hits)
    return pa.RecordBatch.from_arrays([asks["node"].take(pa.array(a[starts])), pa.array(wish[starts].astype(np.int32)), lists], names=["node", "wish", "hits"])


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each node's and wish's hits."""
    return hits.groupBy("node", "wish").agg(F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k).alias("hits"))


def hard_negatives(
    vectors: DataFrame, label: Column, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exact.

    Scores are inner products of floor(scale * component). The anchors are the rows
    where ``anchor`` holds; their positives are the ``positives`` best other rows of
    their label, and for each of these the ``negatives`` best rows of other labels
    whose score is ``low`` to ``high`` percent of the positive's are returned. Ties
    go to the smaller id. Rows without an id, label or vector, with null or
    non-finite components, or whose product with themselves doesn't fit a long take
    no part; a zero vector does. Vectors of different lengths have no product; each
    length is searched by itself. Rows that repeat an id are rows of their own: a
    copy of an anchor is one of its candidates, and equal anchors give equal rows
    as often as they occur. Other columns are not read; an empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "hardneg")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).alias("raw"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("raw"))).select("vec_id", "label", "anchor", _whole(F.col("raw"), scale).alias("v"))
    rows = scratch.keep(rows.where(_fits(F.col("v"))), "rows")
    asking = rows.where("anchor").groupBy("vec_id", "label", "v").agg(F.count("*").alias("times"))
    asking = scratch.keep(asking.withColumn("node", F.xxhash64("vec_id", "label", "v")), "anchors")
    found = None
    for dim in dimensions(asking, "v"):
        of_length = lambda df: df.where(F.size("v") == dim)  # noqa: B023, E731
        search = Search(of_length(rows).select("vec_id", "label", "v"), of_length(asking).select("node", "vec_id", "label", "v"), scratch, shard_rows, block_rows)
        every = search.anchors.select("node", F.array(F.lit(NONE_LOW)).alias("lows"), F.array(F.lit(NONE_HIGH)).alias("highs"))
        near = search.run(every, True, positives).select("node", F.transform("hits", lambda h: F.struct(h["vec_id"].alias("vec_id"), (-h["down"]).alias("score"))).alias("positives"))
        wanted = near.select("node", _percent(low, True).alias("lows"), _percent(high, False).alias("highs"))
        hits = search.run(wanted, False, negatives)
        told = hits.join(near, "node").select("node", F.get("positives", "wish").alias("p"), F.posexplode("hits").alias("place", "hit"))
        some = told.select("node", F.col("p.vec_id").alias("positive_id"), (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("negative_id"), F.col("p.score").alias("positive_score"), (-F.col("hit.down")).alias("negative_score"))
        found = some if found is None else found.unionByName(some)
    if found is None:
        none = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return vectors.sparkSession.createDataFrame([], none)
    named = found.join(asking.select("node", F.col("vec_id").alias("anchor_id"), "times"), "node")
    named = named.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _percent(percent: int, up: bool) -> Column:
    """``percent`` of each positive's score, exactly, to the whole number above (``up``) or below.

    The two cross for a positive below zero, which no negative suits.
    """
    share = f"{percent} * ((p.score - pmod(p.score, 100)) div 100) + ({percent} * pmod(p.score, 100) + {99 if up else 0}) div 100"
    return F.expr(f"transform(positives, p -> if(p.score < 0, {NONE_HIGH if up else NONE_LOW}, {share}))")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every embedding whose id is divisible by 50; labels are moved on where it is divisible by 7."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, label, F.col("vec_id") % 50 == 0)


QUERIES = {"op13_hard_negatives": op13_hard_negatives}
ORACLE_SQL = {
    "op13_hard_negatives": f"""
WITH kept AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id AS vec_id, CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
positives AS (SELECT * FROM scored WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike AND {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= {NEGATIVES}"""
}

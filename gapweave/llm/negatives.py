"""Hard negatives by a multiway hyperplane tree that stores the distance ranges of its subtrees.

Vectors are rounded to integers, so scores (inner products) are exact.  A
further coordinate ``sqrt(M - |x|^2)``, with ``M`` the largest squared norm,
gives all rows one length; an anchor gets zero there.  Then a score is a
distance: ``d^2 = |q|^2 + M - 2 * score``, a window of scores is an annulus
around the anchor, and the triangle inequality holds.

* The tree: a node's split points, far from each other, are chosen from a
  bounded sample (``SAMPLE`` vectors, those of smallest id hash).  Every row
  goes to its nearest split point, level by level, and so to a leaf.  For each
  pair of split point and sibling subtree the node keeps the least and largest
  distance of the split point to the subtree, over all rows.
* The search: a subtree is left out if for one split point no distance of the
  annulus fits the range.  What is left are leaves, searched exactly.
* Leaves are cut into blocks of ``BLOCK`` rows and the anchors that visit them
  into blocks as well, so neither a crowded leaf nor a popular one is one
  task's.  A block hands on the best few of each anchor.

First an anchor visits its own leaf; the worst of the positives found there
bounds the annulus of the exact search for positives.  The negatives' windows
follow from the positives.  Rows of a length other than the commonest one
stand in leaves apart: only vectors of one length have a score.

Rows with a null label, a null or empty vector, or a null or non-finite
component, or one of ``LARGEST`` and more (their scores leave 64 bits), take
no part, nor do rows without a whole number as id.  Of rows that repeat an id
the one of smallest label and vector takes part.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapweave.llm.shared import cut, reachable

SCALE = 256
LARGEST = 2.0**18  # 2**26 after scaling; the product of two fits a long up to 2,048 components
SAMPLE = 4096
SAMPLE_COMPONENTS = 1 << 21
OTHERS = 1024  # leaves of the other lengths
FANOUT = 16
BLOCK = 2048
SLACK = 1e-7
FROM, TO = -(1 << 63), (1 << 63) - 1  # an open window of scores


def prepared(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             relabel: int = 7, classes: int = 10) -> DataFrame:
    """``id``, ``label``, ``v`` (array of long) of the rows that take part; every ``relabel``-th id moves to the next class."""
    slim = df.select(F.col(key).try_cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LARGEST))
    good = slim.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~odd)
    moved = F.when(F.col("id") % relabel == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    found = good.select("id", moved.cast("long").alias("label"), F.transform("v", lambda x: F.floor(x * SCALE)).alias("v"))
    one = found.groupBy("id").agg(F.min(F.struct("label", "v")).alias("x"))
    return one.select("id", "x.label", "x.v")


@dataclass
class Node:
    points: np.ndarray  # split points with their further coordinate
    low: np.ndarray  # least distance of split point i to subtree j
    high: np.ndarray
    below: list  # a Node or a leaf number for each split point


def _lifted(v: np.ndarray, most: float) -> np.ndarray:
    """Rows with the coordinate that gives all one length."""
    v = v.astype(np.float64)
    return np.hstack([v, np.sqrt(np.maximum(most - (v * v).sum(axis=1), 0.0))[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


class Tree:
    """Split points by level; ranges are filled in from all rows."""

    def __init__(self, sample: np.ndarray, most: float, leaves: int, fanout: int = FANOUT):
        self.most, self.leaves, self.nodes = most, 0, []
        self.root = self._grow(_lifted(sample, most), leaves, fanout)

    def _grow(self, sample: np.ndarray, leaves: int, fanout: int):
        distinct = np.unique(sample, axis=0) if leaves > 1 else sample[:1]
        if leaves <= 1 or len(distinct) < 2:
            self.leaves += 1
            return self.leaves - 1
        want = min(fanout, leaves, len(distinct))
        chosen = [0]
        nearest = _distances(distinct, distinct[:1])[:, 0]
        while len(chosen) < want:  # the farthest from those chosen
            chosen.append(int(np.argmax(nearest)))
            nearest = np.minimum(nearest, _distances(distinct, distinct[chosen[-1:]])[:, 0])
        points = distinct[chosen]
        node = Node(points, np.full((want, want), np.inf), np.full((want, want), -np.inf), [])
        self.nodes.append(node)
        own = np.argmin(_distances(sample, points), axis=1)
        node.below = [self._grow(sample[own == j], math.ceil(leaves / want), fanout) for j in range(want)]
        return node

    def place(self, v: np.ndarray, widen: bool = False) -> np.ndarray:
        """Leaf of each row; ``widen`` extends the ranges by these rows."""
        lifted, out = _lifted(v, self.most), np.zeros(len(v), np.int64)
        waiting = [(self.root, np.arange(len(v)))]
        while waiting:
            node, rows = waiting.pop()
            if not isinstance(node, Node):
                out[rows] = node
                continue
            d = _distances(lifted[rows], node.points)
            own = np.argmin(d, axis=1)
            for j, below in enumerate(node.below):
                mine = own == j
                if mine.any():
                    if widen:
                        node.low[:, j] = np.minimum(node.low[:, j], d[mine].min(axis=0))
                        node.high[:, j] = np.maximum(node.high[:, j], d[mine].max(axis=0))
                    waiting.append((below, rows[mine]))
        return out

    def ranges(self) -> list[tuple[int, int, int, float, float]]:
        return [(n, i, j, float(node.low[i, j]), float(node.high[i, j])) for n, node in enumerate(self.nodes)
                for i in range(len(node.points)) for j in range(len(node.points)) if node.low[i, j] <= node.high[i, j]]

    def visits(self, q: np.ndarray, least: list[np.ndarray], largest: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, anchors that must see it) for windows of scores per anchor."""
        q = q.astype(np.float64)
        lifted, squares = np.hstack([q, np.zeros((len(q), 1))]), (q * q).sum(axis=1)
        owner = np.repeat(np.arange(len(q)), [len(x) for x in least])
        base = squares[owner] + self.most
        slack = SLACK * np.sqrt(base) + SLACK

        def radius(score: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(base - 2 * score, 0.0))

        inner = radius(np.concatenate(largest) if len(owner) else np.zeros(0)) - slack
        outer = radius(np.concatenate(least) if len(owner) else np.zeros(0)) + slack
        waiting = [(self.root, np.arange(len(owner)))]
        while waiting:
            node, mine = waiting.pop()
            if not isinstance(node, Node):
                if len(mine):
                    yield node, np.unique(owner[mine])
                continue
            d = _distances(lifted[owner[mine]], node.points)
            a, b = inner[mine][:, None], outer[mine][:, None]
            for j, below in enumerate(node.below):
                low, high = node.low[:, j], node.high[:, j]
                apart = (d - high > b) | (low - d > b) | (d + high < a)
                waiting.append((below, mine[~apart.any(axis=1)]))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = np.array([len(v) for v in batch.column("v")])
    for dim in np.unique(dims).tolist():
        yield dim, batch.filter(pa.array(dims == dim))


def _leaf_of(tree: Tree | None, common: int, v: np.ndarray) -> np.ndarray:
    return tree.place(v) if v.shape[1] == common else np.full(len(v), -1 - v.shape[1] % OTHERS, np.int64)


def _opened(scores: list[int]) -> np.ndarray:
    return np.array([-math.inf if x == FROM else math.inf if x == TO else x for x in scores], np.float64)


class Index:
    """All rows by leaf and block, and the tree."""

    def __init__(self, rows: DataFrame, block: int = BLOCK, fanout: int = FANOUT, sample: int = SAMPLE):
        rows = cut(rows)
        self.block = block
        common = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
        self.dim, count = common if common else (0, 0)
        square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
        mine = rows.filter(F.size("v") == self.dim)
        most = mine.agg(F.max(square)).first()[0] or 0.0
        some = max(2, min(sample, SAMPLE_COMPONENTS // max(self.dim, 1)))
        drawn = mine.orderBy(F.xxhash64("id"), "id").limit(some).select("v").collect()
        self.tree = Tree(np.array([r["v"] for r in drawn], np.int64).reshape(len(drawn), self.dim), float(most),
                         max(1, min(fanout**3, math.ceil(count / block))), fanout) if drawn else None
        self._measure(mine)
        self.rows = self._placed(rows)

    def _measure(self, mine: DataFrame) -> None:
        """Ranges over all rows: each task's own, then the extremes of all tasks; their number depends on the tree only."""
        if self.tree is None or not self.tree.nodes:
            return
        tree, dim = self.tree, self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tree.place(_matrix(batch.column("v"), dim), widen=True)
            columns = list(zip(*tree.ranges())) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 3 else pa.float64()) for k, c in enumerate(columns)],
                                             ["node", "i", "j", "low", "high"])

        found = reachable(mine.select("v")).mapInArrow(run, "node long, i long, j long, low double, high double")
        for r in found.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            node = tree.nodes[r["node"]]
            node.low[r["i"], r["j"]], node.high[r["i"], r["j"]] = r["low"], r["high"]

    def _placed(self, rows: DataFrame) -> DataFrame:
        """``leaf, part, id, label, v`` of every row."""
        tree, common = self.tree, self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for dim, part in _by_dim(batch):
                    leaf = _leaf_of(tree, common, _matrix(part.column("v"), dim))
                    yield pa.RecordBatch.from_arrays([pa.array(leaf), *part.columns], ["leaf", *part.schema.names])

        leaves = reachable(rows).mapInArrow(run, "leaf long, id long, label long, v array<long>")
        leaves = cut(leaves)
        # one row per leaf, at most fanout**3 + OTHERS: small enough to broadcast
        self.sizes = cut(leaves.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / self.block).cast("int").alias("parts")))
        return leaves.join(F.broadcast(self.sizes), "leaf").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))

    def visits(self, anchors: DataFrame, own: bool = False) -> DataFrame:
        """``leaf`` and the anchor's columns, one row per leaf it must see (``own``: only its own)."""
        tree, common = self.tree, self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for dim, part in _by_dim(batch):
                    v = _matrix(part.column("v"), dim)
                    if own or dim != common:
                        where = _leaf_of(tree, common, v)
                        pairs = [(int(x), np.flatnonzero(where == x)) for x in np.unique(where)]
                    else:
                        least, largest = ([_opened(x) for x in part.column(c).to_pylist()] for c in ("least", "largest"))
                        pairs = tree.visits(v, least, largest)
                    for leaf, mine in pairs:
                        some = part.take(pa.array(mine))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(mine), leaf, np.int64)), *some.columns], ["leaf", *part.schema.names])

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields)
        return reachable(anchors).mapInArrow(run, f"leaf long, {schema}")

    def search(self, anchors: DataFrame, positives: bool, top: int, own: bool = False) -> DataFrame:
        """``anchor, slot, id, score``: for each anchor and window the best rows of its label, or of others.

        ``anchors``: ``id, label, v, least, largest`` with windows of scores.
        """
        at = ["leaf", "part", "group"]
        seen = self.visits(anchors, own)
        # per leaf: its parts, and the groups that its visitors make; as few rows as the tree has leaves
        visitors = seen.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / self.block).cast("int").alias("groups"))
        shares = F.broadcast(cut(visitors.join(self.sizes, "leaf")))
        seen = seen.join(shares, "leaf").withColumn("group", F.pmod(F.xxhash64("id"), "groups").cast("int"))
        seen = seen.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        hosts = self.rows.drop("parts").join(shares, "leaf").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
        left = seen.select(*at, "id", "label", "v", "least", "largest").groupBy(*at)
        found = left.cogroup(hosts.select(*at, "id", "label", "v").groupBy(*at)).applyInPandas(
            lambda a, b: best_of_block(a, b, positives, top), "anchor long, slot int, id long, score long")
        order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _best(anchors: pd.DataFrame, rows: pd.DataFrame, positives: bool, top: int, out: list[tuple[np.ndarray, ...]]) -> None:
    ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
    scores = products(np.stack(list(anchors["v"])), np.stack(list(rows["v"])))
    for k, (key, label, least, largest) in enumerate(zip(anchors["id"], anchors["label"], anchors["least"], anchors["largest"])):
        allowed = (labels == label) & (ids != key) if positives else labels != label
        mine, some = scores[k][allowed], ids[allowed]
        for slot, (a, b) in enumerate(zip(least, largest)):
            inside = np.flatnonzero((mine >= a) & (mine <= b))
            if len(inside) > top:
                edge = np.partition(mine[inside], len(inside) - top)[len(inside) - top]
                inside = inside[mine[inside] >= edge]
            inside = inside[np.argsort(-mine[inside], kind="stable")[:top]]
            out.append((np.full(len(inside), key), np.full(len(inside), slot), some[inside], mine[inside]))


def best_of_block(anchors: pd.DataFrame, rows: pd.DataFrame, positives: bool, top: int) -> pd.DataFrame:
    """The best ``top`` rows of a block for each anchor and window; ties by id."""
    out: list[tuple[np.ndarray, ...]] = []
    rows = rows.sort_values("id", kind="stable")  # among equal scores the smaller id comes first
    lengths, others = anchors["v"].map(len).to_numpy(), rows["v"].map(len).to_numpy()
    for dim in np.intersect1d(lengths, others).tolist():
        _best(anchors[lengths == dim], rows[others == dim], positives, top, out)
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
    return pd.DataFrame(dict(zip(("anchor", "slot", "id", "score"), columns))).astype(
        {"anchor": "int64", "slot": "int32", "id": "int64", "score": "int64"})


def _windows(low: Column, high: Column) -> list[Column]:
    return [low.cast("array<long>").alias("least"), high.cast("array<long>").alias("largest")]


def hard_negatives(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 50,
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, block: int = BLOCK,
                   fanout: int = FANOUT, sample: int = SAMPLE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id ``every`` divides.  A negative's score is
    between ``low`` and ``high`` percent of the positive's.
    """
    rows = cut(prepared(df, key, vector, label))
    index = Index(rows, block, fanout, sample)
    anchors = cut(rows.filter(F.col("id") % every == 0))
    everything = _windows(F.array(F.lit(FROM)), F.array(F.lit(TO)))
    first = index.search(anchors.select("id", "label", "v", *everything), True, positives, own=True)
    bound = first.groupBy(F.col("anchor").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst"))
    # with fewer than enough in the own leaf there is no bound yet
    worst = F.when(F.col("n") >= positives, F.col("worst")).otherwise(F.lit(FROM))
    bounded = anchors.join(bound, "id", "left").select("id", "label", "v", *_windows(F.array(worst), F.array(F.lit(TO))))
    near = cut(index.search(cut(bounded), True, positives).select("anchor", F.col("id").alias("positive"), "score", "rank"))
    slots = near.groupBy(F.col("anchor").alias("id")).agg(F.array_sort(F.collect_list(F.struct("rank", "positive", "score"))).alias("p"))
    # in whole numbers: low * p <= 100 * n <= high * p
    score = [F.transform("p", lambda x: f(x["score"].cast("decimal(20,0)") * share / 100))
             for f, share in ((F.ceil, low), (F.floor, high))]
    asked = anchors.join(slots, "id").select("id", "label", "v", *_windows(*score))
    found = index.search(cut(asked), False, negatives)
    named = near.select("anchor", (F.col("rank") - 1).alias("slot"), "positive", F.col("score").alias("positive_score"))
    return found.join(named, ["anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

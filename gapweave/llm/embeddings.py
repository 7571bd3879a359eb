"""Near-duplicate vectors by collision counting over one-dimensional projections.

Equal vectors become one class first.  A pair with a cosine of at least
``threshold`` is close in almost every random projection, so each projection
is sorted, a window is laid around every vector, and collisions are counted
for each pair; only pairs that collide in at least as many projections as the
binomial law allows for such pairs (``recall``) are verified by their cosine
in double precision.

Windows over all vectors would grow with their square, so the counting runs
inside cells: sets of ``bits`` projections whose signs the vectors share.  The
number of cells grows with the number of vectors (``cell`` vectors each), and
as many tables of cells are laid as the threshold needs for ``recall``.  Up to
``block`` classes there is one cell, so no pair is missed by cells.  A crowded
cell is divided into blocks, and pairs of blocks are counted one by one: no
vector is left out, and no task holds a whole cell.  A pair is counted in the
first table that brings it together, so link counts need no table of pairs;
what leaves a block is one row per linked class.

Vectors that are null, empty, zero or hold null or non-finite components link
with nothing, as do vectors of other lengths with each other.  A vector
without an id links with nothing and names nothing.  Rows that repeat an id
and its vector are copies of each other.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.llm.components import components
from gapweave.llm.shared import cut, reachable

SEED = 20240607


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.95
    recall: float = 0.995  # of pairs exactly at the threshold, for cells and for counts
    projections: int = 16
    cell: int = 256
    block: int = 1024

    @property
    def distance(self) -> float:
        """Euclidean distance of unit vectors at the threshold."""
        return math.sqrt(2 - 2 * self.threshold)

    @property
    def window(self) -> float:
        """Half width of the windows: two standard deviations of a projected difference at the threshold."""
        return 2 * self.distance

    @property
    def collisions(self) -> int:
        """The most collisions to ask for such that a pair at the threshold reaches them with ``recall``."""
        hit = math.erf(2 / math.sqrt(2))
        reached = 0.0
        for k in range(self.projections, 0, -1):
            reached += math.comb(self.projections, k) * hit**k * (1 - hit) ** (self.projections - k)
            if reached >= self.recall:
                return k
        return 0

    def layout(self, classes: int) -> tuple[int, int]:
        """(bits of a cell, tables) for so many classes."""
        if classes <= self.block:
            return 0, 1
        bits = max(1, math.ceil(math.log2(classes / self.cell)))
        together = (1 - math.acos(self.threshold) / math.pi) ** bits
        return bits, max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - together)))


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, all components finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return vector.isNotNull() & (F.size(vector) > 0) & ~odd & some


def _codes(units: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Cell number of each vector in each table."""
    if not bits:
        return np.zeros((len(units), tables), np.int64)
    rng = np.random.default_rng([SEED, units.shape[1], 1])
    planes = rng.standard_normal((tables, bits, units.shape[1]))
    weights = 1 << np.arange(bits, dtype=np.int64)
    return np.stack([(units @ p.T > 0) @ weights for p in planes], axis=1)


def _units(raw: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that squares neither overflow nor vanish."""
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def collision_counts(a: np.ndarray, b: np.ndarray, settings: Settings) -> np.ndarray:
    """Collisions of every vector of ``a`` with every one of ``b``: projections sorted, a window around each query."""
    rng = np.random.default_rng([SEED, a.shape[1], 2])
    lines = rng.standard_normal((a.shape[1], settings.projections))
    counts = np.zeros((len(a), len(b)), np.uint8)
    for x, y in zip((a @ lines).T, (b @ lines).T):
        order = np.argsort(y, kind="stable")
        low = np.searchsorted(y[order], x - settings.window, "left")
        high = np.searchsorted(y[order], x + settings.window, "right")
        rank = np.empty(len(b), np.int64)
        rank[order] = np.arange(len(b))
        counts += (rank >= low[:, None]) & (rank < high[:, None])
    return counts


def block_links(rows: pd.DataFrame, settings: Settings) -> pd.DataFrame:
    """Links found in one block or pair of blocks: for each class how many vectors it links with, and whom it joins."""
    table, left, right = int(rows["tab"].iloc[0]), int(rows["low"].iloc[0]), int(rows["high"].iloc[0])
    rows = rows.sort_values("cid", kind="stable")
    units = _units(np.stack([np.frombuffer(v, "<f8") for v in rows["v"]]))
    codes = np.stack([np.frombuffer(c, "<i8") for c in rows["codes"]])
    ids, sizes = rows["cid"].to_numpy(), rows["n"].to_numpy()
    part = rows["part"].to_numpy()
    first, second = np.flatnonzero(part == left), np.flatnonzero(part == right)
    links, parent = np.zeros(len(ids), np.int64), np.arange(len(ids))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    step = 256
    for at in range(0, len(first), step):
        mine = first[at : at + step]
        passed = collision_counts(units[mine], units[second], settings) >= settings.collisions
        if left == right:
            passed &= mine[:, None] < second[None, :]
        i, j = np.nonzero(passed)
        i, j = mine[i], second[j]
        close = np.einsum("ij,ij->i", units[i], units[j]) >= settings.threshold
        i, j = i[close], j[close]
        new = np.argmax(codes[i] == codes[j], axis=1) == table  # else an earlier table has counted the pair
        i, j = i[new], j[new]
        np.add.at(links, i, sizes[j])
        np.add.at(links, j, sizes[i])
        # per vector one join with its first partner, and the rest only where roots differ
        for a, b in zip(i.tolist(), j.tolist()):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    linked = np.flatnonzero(links)
    return pd.DataFrame({"cid": ids[linked], "links": links[linked], "joins": ids[[root(int(k)) for k in linked]].astype(np.int64)})


def classes_of(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``cid``, ``v`` (array of doubles), ``least`` id and ``n`` rows of every distinct usable vector with an id."""
    slim = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    found = slim.filter(F.col("id").isNotNull() & usable(F.col("v")))
    grouped = found.groupBy("v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    return cut(grouped.withColumn("cid", F.monotonically_increasing_id()))


def class_links(classes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``cid``, ``links``, ``joins``: per block, what each class links with."""
    bits, tables = settings.layout(classes.count())

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tab", "cell", "dim", "cid", "n", "codes", "v"]
        for batch in batches:
            dims = np.array([len(v) for v in batch.column("v")])
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                raw = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                codes = _codes(_units(raw), bits, tables)
                codes_ = pa.array([c.astype("<i8").tobytes() for c in codes], pa.binary())
                raws = pa.array([v.astype("<f8").tobytes() for v in raw], pa.binary())
                for t in range(tables):
                    fixed = [pa.array(np.full(len(raw), t, np.int32)), pa.array(codes[:, t]), pa.array(np.full(len(raw), dim, np.int32))]
                    yield pa.RecordBatch.from_arrays([*fixed, part.column("cid"), part.column("n"), codes_, raws], names)

    rows = reachable(classes.select("cid", "n", "v")).mapInArrow(placed, "tab int, cell long, dim int, cid long, n long, codes binary, v binary")
    cells = ["tab", "cell", "dim"]
    crowd = rows.groupBy(*cells).agg(F.count(F.lit(1)).alias("crowd")).filter("crowd > 1")
    parts = F.ceil(F.col("crowd") / settings.block).cast("int")
    divided = rows.join(crowd, cells).withColumn("parts", parts).withColumn(
        "part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")
    )
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    met = divided.withColumn("other", F.explode(others)).select(
        *cells, "cid", "n", "codes", "v", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    )
    return met.groupBy(*cells, "low", "high").applyInPandas(
        lambda g: block_links(g, settings), "cid long, links long, joins long"
    )


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """``key``, ``n_links``, ``component_id``, ``kept`` for every row; see above for rows that link with nothing."""
    classes = classes_of(df, key, vector)
    found = cut(class_links(classes, settings))
    totals = found.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("cid").alias("a"), F.col("joins").alias("b")))
    roots = classes.select("cid", "least", "n", "v").join(joined.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "root", F.coalesce("root", "cid")
    )
    names = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    known = roots.join(names, "root").join(totals, "cid", "left").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    slim = df.select(F.col(key), F.col(vector).cast("array<double>").alias("v"))
    id_ = F.col(key)
    # a vector that links with nothing is left out of the join by a NULL, which equals no vector
    good = F.when(id_.isNotNull() & usable(F.col("v")), F.col("v"))
    return slim.withColumn("v", good).join(known, "v", "left").select(
        key,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", id_).cast("long").alias("component_id"),
        F.coalesce(id_ == F.coalesce("component_id", id_), F.lit(False)).alias("kept"),
    )

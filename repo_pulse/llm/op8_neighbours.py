"""Operator 8: approximate nearest neighbours by stable projections and kd-trees.

Unit vectors are projected to ``PROJECTED`` Gaussian (2-stable) coordinates.
For two vectors at distance d the squared projected distance divided by d^2
follows a chi-square law with PROJECTED degrees of freedom. A query walks a
kd-tree of projected points nearest first and verifies their true cosines; it
stops when the next projected distance squared exceeds the law's ``CONFIDENCE``
quantile times its k-th best distance squared: a point still unseen is a
better neighbour with probability below 1 - CONFIDENCE.

Scale: a top-level kd-tree over a bounded, hash-chosen sample of projected
rows (``SAMPLE``) cuts the space into leaves; every row is indexed in its
leaf. A leaf is split into blocks of about ``BLOCK_ROWS`` rows (by row, so
equal vectors and rows of one vec_id spread too); each block has a tree of its own. A query searches
its home leaf first; its k-th distance then sends it only to leaves whose box
passes the same stopping test, in blocks of queries. Rows and queries meet by
an equi-join on (leaf, block); box table and sample are bounded.

Rows: vectors that are NULL, empty, zero or hold NULL or non-finite numbers
take no part, nor do rows without vec_id; rows with the query's own vec_id
are not its candidates; vectors of another length are not compared; repeated
rows each count; with fewer than k candidates all are returned; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repo_pulse.llm.common import store

K = 5
EVERY = 50
PROJECTED = 8
CONFIDENCE = 0.99
SAMPLE = 8192
LEAF_ROWS = 4096  # rows of a leaf aimed at
MOST_LEAVES = 4096
BLOCK_ROWS = 4096
QUERY_BLOCK = 4096
TREE_LEAF = 256
SEED = 8


def quantile(confidence: float = CONFIDENCE, degrees: int = PROJECTED) -> float:
    """Chi-square quantile (Wilson-Hilferty)."""
    z = NormalDist().inv_cdf(confidence)
    return degrees * (1 - 2 / (9 * degrees) + z * math.sqrt(2 / (9 * degrees))) ** 3


def projection(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, PROJECTED))


def valid(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vec) of the rows that take part, in double precision."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return rows.where(F.col(vec_id).isNotNull() & v.isNotNull()).where(finite & some).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vec"))


def _matrix(column: pa.Array) -> list[np.ndarray]:
    return [x.values.to_numpy() for x in column]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max()  # no overflow or underflow in the norm
    return x / math.sqrt(float((x * x).sum()))


def _project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    maps: dict[int, np.ndarray] = {}
    for b in batches:
        p = []
        for x in _matrix(b.column(1)):
            if len(x) not in maps:
                maps[len(x)] = projection(len(x))
            p.append(_unit(x) @ maps[len(x)])
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(x) for x in _matrix(b.column(1))], pa.int32()), pa.array([q.tolist() for q in p], pa.list_(pa.float64()))], names=["vec_id", "vec", "dim", "at"])


class Tree:
    """kd-tree over points: halves at the median of the widest coordinate."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.points, self.leaf, self.nodes = points, leaf, []
        if len(points):
            self._build(np.arange(len(points)))

    def _build(self, idx: np.ndarray) -> int:
        me, p = len(self.nodes), self.points[idx]
        lo, hi = p.min(axis=0), p.max(axis=0)
        self.nodes.append(None)
        axis = int((hi - lo).argmax())
        if len(idx) <= self.leaf or hi[axis] == lo[axis]:
            self.nodes[me] = (lo, hi, idx, -1, -1)
            return me
        order = idx[np.argpartition(p[:, axis], len(idx) // 2)]
        self.nodes[me] = (lo, hi, None, self._build(order[:len(idx) // 2]), self._build(order[len(idx) // 2:]))
        return me

    def nearest_first(self, q: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(least squared distance, points) of the leaves, nearest box first."""
        def gap(i):
            lo, hi = self.nodes[i][:2]
            d = np.maximum(np.maximum(lo - q, q - hi), 0)
            return float(d @ d)

        heap = [(gap(0), 0)] if self.nodes else []
        while heap:
            d, i = heapq.heappop(heap)
            _, _, idx, left, right = self.nodes[i]
            if idx is not None:
                yield d, idx
            else:
                heapq.heappush(heap, (gap(left), left))
                heapq.heappush(heap, (gap(right), right))


def _best(query_id: int, q: np.ndarray, at: np.ndarray, far: float, k: int, ids: np.ndarray, units: np.ndarray, tree: Tree, limit: float) -> list[tuple[float, int]]:
    """Up to k (cosine, vec_id) of one block. far: squared distance that a result must not exceed."""
    best: list[tuple[float, int]] = []
    for gap, idx in tree.nearest_first(at):
        if gap > limit * far:
            break
        away = tree.points[idx] - at
        idx = idx[((away * away).sum(axis=1) <= limit * far) & (ids[idx] != query_id)]
        if not len(idx):
            continue
        cosine = (units[idx] * q).sum(axis=1)  # row by row: equal vectors get equal sums
        best += list(zip(cosine.tolist(), ids[idx].tolist()))
        best = heapq.nsmallest(k, best, key=lambda x: (-x[0], x[1]))
        if len(best) == k:
            far = min(far, max(0.0, 2 - 2 * best[-1][0]) + 1e-12)
    return best


def _search(k: int, limit: float):
    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            units = np.stack([_unit(np.asarray(x)) for x in rows["vec"]])
            ids, tree = rows["vec_id"].to_numpy(), Tree(np.stack(rows["at"].to_list()), TREE_LEAF)
            for i, vec, at, far in zip(queries["vec_id"], queries["vec"], queries["at"], queries["far"]):
                for cosine, j in _best(i, _unit(np.asarray(vec)), np.asarray(at), far, k, ids, units, tree, limit):
                    out.append((i, j, cosine))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def _meet(rows: DataFrame, visits: DataFrame, blocks: dict[tuple[int, int], int], k: int, limit: float) -> DataFrame:
    """visits(dim, leaf, vec_id, vec, at, far): every query searches all blocks of its leaf."""
    spark = rows.sparkSession
    load = {(r["dim"], r["leaf"]): -(-r["n"] // QUERY_BLOCK) for r in visits.groupBy("dim", "leaf").agg(F.count("*").alias("n")).collect()}  # at most one row a leaf
    if not load:
        return spark.createDataFrame([], "query_id long, vec_id long, score double")
    plan = spark.createDataFrame([(d, leaf, blocks[d, leaf], n) for (d, leaf), n in load.items()], "dim int, leaf int, blocks int, parts int")
    on = ["dim", "leaf"]
    r = rows.join(F.broadcast(plan), on).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    r = r.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    q = visits.join(F.broadcast(plan), on).withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts")).cast("int"))
    q = q.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = ["dim", "leaf", "block", "part"]
    return r.select(*key, "vec_id", "vec", "at").groupBy(*key).cogroup(q.select(*key, "vec_id", "vec", "at", "far").groupBy(*key)).applyInPandas(
        _search(k, limit), "query_id long, vec_id long, score double")


def nearest(rows: DataFrame, queries: DataFrame, k: int = K, confidence: float = CONFIDENCE) -> DataFrame:
    """The k nearest rows(vec_id, vec) by cosine of each of queries(vec_id, vec): query_id, rank, vec_id, score."""
    limit = quantile(confidence)
    spark = rows.sparkSession
    schema = "vec_id long, vec array<double>, dim int, at array<double>"
    indexed = store(rows.mapInArrow(_project, schema), "projected")
    n = indexed.count()
    sample = indexed.select("at", "vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    points = np.stack(sample["at"].to_list()) if len(sample) else np.zeros((0, PROJECTED))
    leaves = min(MOST_LEAVES, max(1, -(-n // LEAF_ROWS)))
    cuts = _cuts(points, max(0, math.ceil(math.log2(leaves))))

    @F.pandas_udf("int")
    def leaf_of(at: pd.Series) -> pd.Series:
        return pd.Series(_leaf(np.stack(at.to_list()), cuts) if len(at) else [], dtype="int32")

    indexed = store(indexed.withColumn("leaf", leaf_of("at")).withColumn("row", F.monotonically_increasing_id()), "indexed")
    sides = [f(F.col("at")[i]).alias(f"{name}{i}") for i in range(PROJECTED) for name, f in (("lo", F.min), ("hi", F.max))]
    boxes = indexed.groupBy("dim", "leaf").agg(F.count("*").alias("n"), *sides).toPandas()  # at most MOST_LEAVES a vector length
    blocks = {(int(d), int(leaf)): int(-(-m // BLOCK_ROWS)) for d, leaf, m in zip(boxes["dim"], boxes["leaf"], boxes["n"])}
    asked = store(queries.mapInArrow(_project, schema).withColumn("leaf", leaf_of("at")), "queries")
    home = _meet(indexed, asked.join(F.broadcast(spark.createDataFrame([(d, l) for d, l in blocks], "dim int, leaf int")), ["dim", "leaf"]).withColumn("far", F.lit(float("inf"))), blocks, k, limit)
    home = store(home, "home")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    top = home.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    kth = top.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), (F.greatest(2 - 2 * F.col("score"), F.lit(0.0)) + 1e-12).alias("far"))
    lo = boxes[[f"lo{i}" for i in range(PROJECTED)]].to_numpy()
    hi = boxes[[f"hi{i}" for i in range(PROJECTED)]].to_numpy()
    box_dim, box_leaf = boxes["dim"].to_numpy(), boxes["leaf"].to_numpy()

    @F.pandas_udf("array<int>")
    def visit(dim: pd.Series, own: pd.Series, at: pd.Series, far: pd.Series) -> pd.Series:
        out = []
        for d, l, q, f in zip(dim, own, at, far):
            gap = np.maximum(np.maximum(lo - q, np.asarray(q) - hi), 0)
            out.append(box_leaf[(box_dim == d) & (box_leaf != l) & ((gap * gap).sum(axis=1) <= limit * f)].tolist())
        return pd.Series(out, dtype="object")

    far = asked.join(kth, "vec_id", "left").withColumn("far", F.coalesce("far", F.lit(float("inf"))))
    far = far.withColumn("leaf", F.explode(visit("dim", "leaf", "at", "far")))
    away = _meet(indexed, store(far, "visits"), blocks, k, limit)
    found = home.unionByName(away).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _cuts(points: np.ndarray, depth: int) -> list[tuple[int, float] | None]:
    """Inner nodes of the top-level tree in heap order; None where too few sample points remain."""
    cuts: list[tuple[int, float] | None] = [None] * ((1 << depth) - 1)
    held = {0: points}
    for i in range(len(cuts)):
        p = held.pop(i, np.zeros((0, PROJECTED)))
        if len(p) < 2:
            continue
        axis = int((p.max(axis=0) - p.min(axis=0)).argmax())
        at = float(np.median(p[:, axis]))
        cuts[i] = axis, at
        held[2 * i + 1], held[2 * i + 2] = p[p[:, axis] <= at], p[p[:, axis] > at]
    return cuts


def _leaf(points: np.ndarray, cuts: list[tuple[int, float] | None]) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    for i, cut in enumerate(cuts):
        here = node == i
        if here.any():
            axis, at = cut or (0, math.inf)
            node[here] = np.where(points[here, axis] <= at, 2 * i + 1, 2 * i + 2)
    return node


def op8(embeddings: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score: 5 nearest of every row whose vec_id is divisible by 50."""
    rows = valid(embeddings)
    return nearest(rows, rows.where(F.col("vec_id") % EVERY == 0))

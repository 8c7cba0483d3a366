"""Operator 11: embedding near-duplicates by an exact metric range join.

The angle between two vectors is a metric, and cosine >= ``least`` means an
angle of at most r. Pivots, picked farthest first from a bounded sample, cut
the vectors into cells by their nearest pivot. The triangle inequality says
which vectors of other cells can have a partner in a cell: y, at angle a from
its own pivot, can meet a vector of cell i only if its angle to pivot i is at
most a + 2r, at most the cell's radius + r and at least the cell's inner
radius - r. Those y are replicated to the cell, and each cell is joined
independently. Of two cells one evaluates their pairs, so every pair is seen
once. Pruning only ever drops pairs that the inequality rules out; what is
left is decided by the cosine in double precision.

Scale. Equal vectors collapse to one node with a weight before the join, so a
vector that fills a third of the table is compared once. A cell's rows are
dealt to blocks of about ``BLOCK_BYTES`` and its visitors to parts of about
``PART`` blocks' worth: a task streams over sorted rows, holds one block and
one batch of visitors, whatever the sizes of cells or clusters. Pairs leave a
task neither as pairs nor capped: each vector with a partner gives one row per
unit, its number of links and one edge of a spanning forest of the unit.
Pivots (``MOST_PIVOTS`` x length) and cell sizes are the only things at the
driver. Vectors whose distances are all alike (random directions in many
dimensions) leave the triangle inequality nothing to prune; the work is then
that of a blocked all-against-all product, the result is the same.

Rows: vectors that are NULL, empty, zero or hold NULL or non-finite numbers
link with nothing: 0 links and their own vec_id as component. Vectors of
another length are not compared. Repeated rows and equal vectors are separate
vectors that link. A vector without vec_id links and is counted, but never
names a component unless all of it lack one (then component_id is NULL, and
``kept`` says whether both are equal, NULL to NULL). Other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repo_pulse.llm.common import store
from repo_pulse.llm.components import components

LEAST = 0.9
SAMPLE = 2048
FEWEST_PIVOTS = 16
MOST_PIVOTS = 1024
CELL_ROWS = 16384  # vectors aimed at a cell
BLOCK_BYTES = 16 << 20  # of one block of a cell, as doubles
PART = 4  # visitors of a unit, in blocks
BATCH = 512  # visitors compared at a time
SLACK = 1e-6  # of an angle, for rounding near 0
CLOSE = 1e-12  # cosines this near the limit are computed again, pair by pair

_UNIT = "unit long, kind int, node long, copies long, angle double, vec binary"


def finite(vector: str):
    """Whether a vector column takes part."""
    v = F.col(vector)
    return F.coalesce(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))


def _units(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow or underflow of the norm."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _angles(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ pivots.T, -1.0, 1.0))


def farthest_first(units: np.ndarray, n: int) -> np.ndarray:
    """Up to n rows, each the farthest from those before."""
    if not len(units):
        return units
    picked, near = [0], units @ units[0]
    while len(picked) < min(n, len(units)):
        i = int(near.argmin())
        if near[i] >= 1 - 1e-12:  # only repeats are left
            break
        picked.append(i)
        near = np.maximum(near, units @ units[i])
    return units[picked]


class Cells:
    """Pivots, radii and block counts per vector length: which units a vector belongs to or visits."""

    def __init__(self, pivots: dict[int, np.ndarray], radius: float):
        self.pivots, self.radius = pivots, radius
        self.inner: dict[int, np.ndarray] = {}
        self.outer: dict[int, np.ndarray] = {}
        self.blocks: dict[int, np.ndarray] = {}
        self.parts: dict[int, np.ndarray] = {}
        self.first: dict[int, np.ndarray] = {}  # number of a cell's first unit

    def angles(self, dim: int, units: np.ndarray) -> np.ndarray:
        """Lengths that the sample did not hold have one cell; any angle prunes nothing there."""
        return _angles(units, self.pivots[dim]) if dim in self.pivots else np.zeros((len(units), 1))

    def size(self, sizes: list) -> None:
        """sizes(dim, cell, n, inner, outer)"""
        for dim in {r["dim"] for r in sizes}:
            n = len(self.pivots[dim]) if dim in self.pivots else 1
            self.inner[dim], self.outer[dim], self.blocks[dim] = np.full(n, np.inf), np.full(n, -np.inf), np.zeros(n, np.int64)
            self.parts[dim] = np.ones(n, np.int64)
        for r in sizes:
            d, c = r["dim"], r["cell"]
            self.inner[d][c], self.outer[d][c] = r["inner"], r["outer"]
            self.blocks[d][c] = -(-r["n"] // block_rows(d))
        self.number()

    def number(self) -> None:
        at = 0
        for dim in sorted(self.blocks):
            units = self.blocks[dim] * self.parts[dim]
            self.first[dim] = at + np.concatenate(([0], np.cumsum(units)[:-1]))
            at += int(units.sum())
        self.count = at

    def visits(self, dim: int, home: np.ndarray, own: np.ndarray, angles: np.ndarray) -> np.ndarray:
        """Whether each vector has to be replicated to each other cell."""
        n = angles.shape[1]
        cell = np.arange(n)
        r = self.radius + SLACK
        go = (angles <= own[:, None] + 2 * r) & (angles <= self.outer[dim] + r) & (angles >= self.inner[dim] - r) & (self.blocks[dim] > 0)
        low, high = np.minimum(home[:, None], cell), np.maximum(home[:, None], cell)
        return go & (np.where((low + high) % 2 == 0, low, high) == cell) & (home[:, None] != cell)  # one of the two cells evaluates a pair


def block_rows(dim: int) -> int:
    return max(256, BLOCK_BYTES // (8 * dim))


def _mix(x: np.ndarray) -> np.ndarray:
    """Well-mixed 63-bit numbers of node numbers, to deal rows to blocks and parts."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


def _by_length(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) of a batch's vectors."""
    column = b.column("vec")
    size = np.diff(column.offsets.to_numpy())
    for dim in np.unique(size).tolist():
        i = np.flatnonzero(size == dim)
        for at in range(0, len(i), 4096):
            part = i[at:at + 4096]
            yield dim, part, np.stack([column[k].values.to_numpy() for k in part.tolist()])


def _homes(cells: Cells):
    """(node, copies, vec) -> with its length, cell and angle to the cell's pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, i, rows in _by_length(b):
                angles = cells.angles(dim, _units(rows))
                cell = angles.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("node").take(pa.array(i)), b.column("copies").take(pa.array(i)), b.column("vec").take(pa.array(i)),
                     pa.array(np.full(len(i), dim, np.int32)), pa.array(cell.astype(np.int32)), pa.array(angles[np.arange(len(i)), cell])],
                    names=["node", "copies", "vec", "dim", "cell", "angle"])

    return run


def _count_visits(cells: Cells):
    """(dim, cell, n): how many vectors of a batch visit each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home, own = b.column("cell").to_numpy(), b.column("angle").to_numpy()
            for dim, i, rows in _by_length(b):
                n = cells.visits(dim, home[i], own[i], cells.angles(dim, _units(rows))).sum(axis=0)
                c = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), dim, np.int32)), pa.array(c.astype(np.int32)), pa.array(n[c])], names=["dim", "cell", "n"])

    return run


def _deal(cells: Cells):
    """Every vector to its own block (once for each part of visitors) and to the units it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, copies = b.column("node").to_numpy(), b.column("copies").to_numpy()
            home, own = b.column("cell").to_numpy(), b.column("angle").to_numpy()
            for dim, i, rows in _by_length(b):
                angles = cells.angles(dim, _units(rows))
                mixed = _mix(nodes[i])
                blocks, parts, first = cells.blocks[dim], cells.parts[dim], cells.first[dim]
                block = mixed % blocks[home[i]]
                go = cells.visits(dim, home[i], own[i], angles)
                at, unit, kind, angle = [], [], [], []

                def add(who, cell, blk, part, k):
                    at.append(who)
                    unit.append(first[cell] + blk * parts[cell] + part)
                    kind.append(np.full(len(who), k, np.int32))
                    angle.append(angles[who, cell])

                every = np.arange(len(i))
                for part in range(int(parts[home[i]].max())):
                    who = every[part < parts[home[i]]]
                    add(who, home[i][who], block[who], np.full(len(who), part), 0 if part == 0 else 1)
                who, cell = np.nonzero(go)
                for blk in range(int(blocks.max())):
                    use = blk < blocks[cell]
                    add(who[use], cell[use], np.full(int(use.sum()), blk), (mixed[who[use]] >> 20) % parts[cell[use]], 2)
                    own_cell = every[(blk < block)]  # the lower block of a cell evaluates the pair
                    c = home[i][own_cell]
                    add(own_cell, c, np.full(len(own_cell), blk), (mixed[own_cell] >> 20) % parts[c], 2)
                at = np.concatenate(at)
                packed = [rows[k].astype("<f8").tobytes() for k in range(len(i))]
                for s in range(0, len(at), 8192):
                    e = slice(s, s + 8192)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(unit)[e]), pa.array(np.concatenate(kind)[e]), pa.array(nodes[i][at[e]]), pa.array(copies[i][at[e]]),
                         pa.array(np.concatenate(angle)[e]), pa.array([packed[k] for k in at[e].tolist()], pa.binary())],
                        names=["unit", "kind", "node", "copies", "angle", "vec"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, "<f8").reshape(len(column), -1)


class Unit:
    """The block of one unit: counts links and merges the block's vectors that a chain of links joins."""

    def __init__(self, nodes, copies, angle, rows, least: float, radius: float):
        order = np.argsort(angle, kind="stable")
        self.node, self.copies, self.angle, self.rows = nodes[order], copies[order], angle[order], rows[order]
        self.units = _units(self.rows)
        self.short = self.units.astype(np.float32)
        self.least, self.reach = least, radius + SLACK
        self.links, self.root = np.zeros(len(order), np.int64), np.arange(len(order))
        self.linked = np.zeros(len(order), bool)

    def hits(self, angle: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(visitors, members, link matrix) of at most BATCH visitors, only where some pair can link."""
        order = np.argsort(angle, kind="stable")
        for at in range(0, len(order), BATCH):
            who = order[at:at + BATCH]
            lo = int(np.searchsorted(self.angle, angle[who[0]] - self.reach, "left"))
            hi = int(np.searchsorted(self.angle, angle[who[-1]] + self.reach, "right"))
            if lo >= hi:
                continue
            u = _units(rows[who])
            maybe = u.astype(np.float32) @ self.short[lo:hi].T >= np.float32(self.least - 1e-4)
            i, j = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
            if not len(i):
                continue
            cosine = u[i] @ self.units[lo:hi][j].T
            hit = cosine >= self.least
            for a, c in zip(*np.nonzero(np.abs(cosine - self.least) <= CLOSE)):
                x, y = rows[who[i[a]]], self.rows[lo + j[c]]
                hit[a, c] = cosine_of(x, y) >= self.least
            yield who[i], lo + j, hit

    def join(self, hit: np.ndarray, members: np.ndarray) -> None:
        for row in hit:
            roots = np.unique(self.root[members[row]])
            if len(roots) > 1:
                self.root[np.isin(self.root, roots[1:])] = roots[0]

    def visit(self, nodes, copies, angle, rows) -> Iterator[tuple]:
        for who, members, hit in self.hits(angle, rows):
            keep = hit.any(axis=1)
            who, hit = who[keep], hit[keep]
            if len(who):
                self.links[members] += hit.T @ copies[who]
                self.linked[members] |= hit.any(axis=0)
                self.join(hit, members)
                yield nodes[who], hit @ self.copies[members], self.node[members[hit.argmax(axis=1)]]

    def within(self) -> None:
        for who, members, hit in self.hits(self.angle, self.rows):
            hit &= who[:, None] != members[None, :]
            self.links[who] += hit @ self.copies[members]
            self.linked[who] |= hit.any(axis=1)
            both = hit | (who[:, None] == members[None, :])
            self.join(both[hit.any(axis=1)], members)

    def rest(self) -> tuple:
        use = self.linked
        return self.node[use], self.links[use], self.node[self.root[use]]


def cosine_of(x: np.ndarray, y: np.ndarray) -> float:
    """The cosine of two vectors in double precision."""
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return float(x @ y) / (math.sqrt(float(x @ x)) * math.sqrt(float(y @ y)))


def _join(least: float, radius: float):
    """Rows sorted by unit and kind (0, 1: the block, with or without its own pairs; 2: visitors) -> (node, links, other)."""

    def out(node, links, other) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(links, pa.int64()), pa.array(other, pa.int64())], names=["node", "links", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, unit = None, [], None

        def open_unit():
            kinds, *columns = [np.concatenate(x) for x in zip(*held)]
            u = Unit(*columns, least, radius)
            if kinds[0] == 0:
                u.within()
            return u

        for b in batches:
            keys, kinds = b.column("unit").to_numpy(), b.column("kind").to_numpy()
            cuts = np.flatnonzero(np.diff(keys) | ((kinds[1:] == 2) != (kinds[:-1] == 2))) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if i == j:
                    continue
                if keys[i] != current:
                    if unit is None and held:
                        unit = open_unit()
                    if unit is not None:
                        yield out(*unit.rest())
                    current, held, unit = keys[i], [], None
                part = b.slice(i, j - i)
                columns = [part.column(n).to_numpy() for n in ("kind", "node", "copies", "angle")] + [_matrix(part.column("vec"))]
                if kinds[i] != 2:
                    held.append(columns)
                elif held or unit is not None:
                    if unit is None:
                        unit, held = open_unit(), []
                    for found in unit.visit(*columns[1:]):
                        yield out(*found)
        if unit is None and held:
            unit = open_unit()
        if unit is not None:
            yield out(*unit.rest())

    return run


def pick_pivots(nodes: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Pivots per vector length, from the SAMPLE vectors of the least hashes."""
    sample = nodes.select("vec").orderBy("k1", "k2").limit(SAMPLE).toArrow().column("vec").to_pylist()
    by: dict[int, list] = {}
    for x in sample:
        by.setdefault(len(x), []).append(x)
    return {d: farthest_first(_units(np.array(x)), min(MOST_PIVOTS, max(FEWEST_PIVOTS, -(-n // CELL_ROWS)))) for d, x in by.items()}


def range_links(nodes: DataFrame, least: float = LEAST) -> DataFrame:
    """Distinct vectors nodes(node, copies, vec, k1, k2) -> (node, links, other): links counted per unit, and an edge each."""
    if not 0 < least <= 1:
        raise ValueError("the least cosine must be above 0 and at most 1")
    radius = math.acos(least)
    cells = Cells(pick_pivots(nodes, nodes.count()), radius)
    homes = nodes.select("node", "copies", "vec").mapInArrow(_homes(cells), "node long, copies long, vec array<double>, dim int, cell int, angle double")
    homes = store(homes, "cells")
    sizes = homes.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.min("angle").alias("inner"), F.max("angle").alias("outer"))
    cells.size(sizes.collect())  # one row a pivot
    visitors = homes.mapInArrow(_count_visits(cells), "dim int, cell int, n long").groupBy("dim", "cell").agg(F.sum("n").alias("n"))
    for r in visitors.collect():  # one row a pivot
        d, c = r["dim"], r["cell"]
        cells.parts[d][c] = max(1, -(-r["n"] // (PART * block_rows(d))))
    cells.number()
    dealt = homes.mapInArrow(_deal(cells), _UNIT)
    return dealt.repartition("unit").sortWithinPartitions("unit", "kind").mapInArrow(_join(least, radius), "node long, links long, other long")


def near_vectors(rows: DataFrame, least: float = LEAST, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    v = F.col(vector).cast("array<double>")
    flat = rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vec"))
    good = finite("vec")
    keyed = flat.select("vec_id", F.when(good, F.xxhash64("vec")).alias("k1"), F.when(good, F.xxhash64(F.lit(11), "vec")).alias("k2"), F.when(good, F.col("vec")).alias("vec"))
    nodes = (keyed.where("k1 IS NOT NULL").groupBy("k1", "k2")
             .agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id"), F.first("vec").alias("vec")))
    nodes = store(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = store(range_links(nodes, least), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    label = label.join(nodes.select("node", "least_id"), "node")
    label = label.join(label.groupBy("component").agg(F.min("least_id").alias("component_id")), "component").select("node", "component_id")
    of = (nodes.select("node", "k1", "k2", "copies", "least_id").join(links, "node", "left").join(label, "node", "left")
          .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least_id").alias("component_id")))
    of = store(of, "of").withColumn("_in", F.lit(True))
    out = keyed.select("vec_id", "k1", "k2").join(of, ["k1", "k2"], "left")
    component = F.when(F.col("_in"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op11(embeddings: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of embeddings, at cosine 0.9."""
    return near_vectors(embeddings)


ORACLE = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), ok AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r, a.vec_id AS x, b.vec_id AS y, b.r AS s FROM ok a JOIN ok b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(r, s) AS (
  SELECT r, r FROM v UNION SELECT reach.r, links.s FROM reach JOIN links ON links.r = reach.s
), component AS (
  SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.s GROUP BY reach.r
)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM v JOIN component c ON c.r = v.r LEFT JOIN (SELECT r, count(*) AS n FROM links GROUP BY r) n ON n.r = v.r
"""

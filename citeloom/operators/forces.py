"""Force-directed layout of graphs of any size.

Nodes repel each other and edges pull their ends together (Fruchterman and Reingold, 1991), with steps that get shorter from
round to round. No pair of nodes is ever listed. A round sums the nodes by the cells of a square grid, at most
4 ** MOST_DEPTH cells, which the driver adds up to coarser and coarser grids; a node is repelled by the centres of mass of
the cells around it, of wide cells far away and of the finest ones close by, without its own mass. The pull is two joins of
the edges with positions and one sum a node that combines on the map side, so a hub is a number. Each round's positions are
written, so executors may be lost.

Positions, forces and sums are whole numbers of 2 ** -16, so they don't depend on the order in which tasks add.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions import fixed

from .graph import cut_lineage, drop_kept
from .labels import numbered

ROUNDS = 50
SEED = 42
#: Grids have 4 ** depth cells: 2 ** 20 sums of 24 bytes at most are sent to the tasks.
MOST_DEPTH = 10
UNIT = 1 << 16
#: Side of the square over the root of the nodes: the ideal length of an edge is 1.
ROOM = 3.0
#: Where an empty cell has its centre: outside of all squares.
FAR = 1e12


def depth_of(nodes: int) -> int:
    """As many levels as give 64 cells a node or more, so that nodes on a heap have cells of their own."""
    return max(2, min(MOST_DEPTH, math.ceil(math.log(64 * max(1, nodes), 4))))


class Pyramid:
    """Masses and sums of positions of the cells of nested grids over a square around (0, 0)."""

    def __init__(self, side: float, depth: int, cells: np.ndarray, mass: np.ndarray, sx: np.ndarray, sy: np.ndarray) -> None:
        self.side, self.depth = side, depth
        finest = np.zeros((3, 1 << depth, 1 << depth))
        finest[:, cells >> depth, cells & (1 << depth) - 1] = mass, sx, sy
        self.levels = [finest]
        for _ in range(depth):
            up = self.levels[0]
            self.levels.insert(0, up[:, ::2, ::2] + up[:, 1::2, ::2] + up[:, ::2, 1::2] + up[:, 1::2, 1::2])
        self._around: dict[int, np.ndarray] = {}

    def around(self, level: int) -> np.ndarray:
        """Mass, x and y of the centres of mass of a level's cells, one row a cell, in a frame of two empty cells on each side."""
        if level not in self._around:
            width = (1 << level) + 4
            rows = np.zeros((width, width, 3))
            mass, sx, sy = self.levels[level]
            full = mass > 0.5
            inner = rows[2:-2, 2:-2]
            # empty cells are far off, where no mass pulls with nothing
            rows[..., 1:] = FAR
            inner[..., 0] = np.where(full, mass, 0)
            for k, total in ((1, sx), (2, sy)):
                np.divide(total, mass, out=inner[..., k], where=full)
            self._around[level] = rows.reshape(-1, 3)
        return self._around[level]

    def forces(self, x: np.ndarray, y: np.ndarray, angle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Repulsion at positions of nodes that are part of the masses; those on one spot part in the direction of their angle.

        Nodes that are alike in where their cell lies in its parent have the same cells around them, relative to it: they are
        one block of arrays, without masks.
        """
        fx, fy = np.zeros(len(x)), np.zeros(len(x))
        for level in range(2, self.depth + 1):
            width = 1 << level
            i, j = (np.clip(((p / self.side + 0.5) * width).astype(np.int64), 0, width - 1) for p in (x, y))
            last, table = level == self.depth, self.around(level)
            kind = (i & 1) * 2 + (j & 1)
            for k in range(4):
                at = np.flatnonzero(kind == k)
                if not len(at):
                    continue
                block = [p[at] for p in (x, y, angle, fx, fy)]
                corner = (i[at] - k // 2 + 2) * (width + 4) + j[at] - k % 2 + 2
                # children of the cells around the parent, of which those that touch the own cell are left to the finer grid
                for a in range(-2, 4):
                    for b in range(-2, 4):
                        if not last and abs(a - k // 2) <= 1 and abs(b - k % 2) <= 1:
                            continue
                        mass, cx, cy = table.take(corner + (a * (width + 4) + b), axis=0).T
                        if last and (a, b) == (k // 2, k % 2):
                            mass, cx, cy = self._without(i[at], j[at], *block[:2])
                        _repel(*block, mass, cx, cy)
                fx[at], fy[at] = block[3:]
        return fx, fy

    def _without(self, i: np.ndarray, j: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mass and centre of mass of nodes' own finest cells, without the nodes."""
        mass, sx, sy = self.levels[self.depth][:, i, j]
        mass, sx, sy = mass - 1, sx - x, sy - y
        full = mass > 0.5
        return np.where(full, mass, 0), *(np.divide(total, mass, out=np.full(len(x), FAR), where=full) for total in (sx, sy))


def _repel(x: np.ndarray, y: np.ndarray, angle: np.ndarray, fx: np.ndarray, fy: np.ndarray, mass: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> None:
    """Adds what one mass a node does to its force."""
    dx, dy = x - cx, y - cy
    square = dx * dx
    square += dy * dy
    spot = square < 1e-8
    if spot.any():
        dx, dy, square = np.where(spot, 1e-2 * np.cos(angle), dx), np.where(spot, 1e-2 * np.sin(angle), dy), np.where(spot, 1e-4, square)
    pull = mass / square
    dx *= pull
    dy *= pull
    fx += dx
    fy += dy


def _cell(side: float, depth: int):
    width = 1 << depth
    at = lambda c: F.least(F.greatest(F.floor((F.col(c) / float(UNIT) / side + 0.5) * width), F.lit(0)), F.lit(width - 1))
    return (at("x") * width + at("y")).cast("int")


def pyramid_of(places: DataFrame, side: float, depth: int) -> Pyramid:
    """The pyramid of (x, y) in units: a row a cell that holds nodes comes to the driver, 4 ** depth at most."""
    sums = places.groupBy(_cell(side, depth).alias("cell")).agg(F.count("*").alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y")).toArrow()
    cells, n, x, y = (sums.column(k).to_numpy() for k in range(4))
    return Pyramid(side, depth, cells.astype(np.int64), n.astype(float), x / UNIT, y / UNIT)


def pulls(places: DataFrame, links: DataFrame) -> DataFrame:
    """(node, px, py): what the edges (a, b), each pair once, pull at their ends, in units."""
    ends = links.join(places.select(F.col("node").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay")), "a")
    ends = ends.join(places.select(F.col("node").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by")), "b")
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    length = F.sqrt(dx.cast("double") * dx + dy.cast("double") * dy) / float(UNIT)
    one = ends.select("a", "b", F.round(dx * length).cast("long").alias("px"), F.round(dy * length).cast("long").alias("py"))
    both = F.explode(F.array(F.struct(F.col("a").alias("node"), "px", "py"), F.struct(F.col("b").alias("node"), (-F.col("px")).alias("px"), (-F.col("py")).alias("py"))))
    return one.select(both.alias("e")).select("e.*").groupBy("node").agg(F.sum("px").alias("px"), F.sum("py").alias("py"))


def moved(places: DataFrame, links: DataFrame, side: float, depth: int, step: float) -> DataFrame:
    """Positions after one round, in which no node goes farther than `step`."""
    shared = places.sparkSession.sparkContext.broadcast(pyramid_of(places, side, depth))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, px, py, turn = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, 6))
            angle = (turn % 62832) / 1e4
            fx, fy = shared.value.forces(x / UNIT, y / UNIT, angle)
            fx, fy = fx + px / UNIT, fy + py / UNIT
            size = np.sqrt(fx * fx + fy * fy)
            share = np.minimum(1.0, step / np.maximum(size, 1e-12))
            # the frame is a little ragged, so that nodes at its edges don't come to lie on one spot
            edge = side / 2 - (turn % 1009) / 1009 * min(0.5, side / 8)
            new = [np.round(np.clip(p / UNIT + f * share, -edge, edge) * UNIT).astype(np.int64) for p, f in ((x, fx), (y, fy))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, new)], names=["node", "x", "y"])

    kind = dict(places.dtypes)["node"]
    rows = places.join(pulls(places, links), "node", "left")
    rows = rows.select("node", "x", "y", F.coalesce("px", F.lit(0)).alias("px"), F.coalesce("py", F.lit(0)).alias("py"), F.pmod(F.xxhash64("node"), F.lit(1 << 31)).alias("turn"))
    return rows.mapInArrow(go, f"node {kind}, x long, y long")


def force_layout(nodes: DataFrame, edges: DataFrame, *, key: str = "paper_id", rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(paper_id, x, y) of all nodes: those with edges by forces, in a box of which the longer side is 1,800; those without
    on a circle around them, in the order of their ids.

    Edges (src, dst) count once whatever their direction; self-loops and ends that are no nodes don't count. Null ids have no
    position; repeated ids have one; a seed gives the same positions on any number of tasks.
    """
    known = nodes.where(F.col(key).isNotNull()).select(F.col(key).alias("node")).distinct()
    pairs = edges.where("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    links = pairs.join(known.select(F.col("node").alias("a")), "a", "left_semi").join(known.select(F.col("node").alias("b")), "b", "left_semi")
    links = cut_lineage(links.select("a", "b"))
    linked = cut_lineage(links.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    count = linked.count()
    side, depth = ROOM * max(1.0, math.sqrt(count)), depth_of(count)
    spot = lambda salt: F.round((F.pmod(F.xxhash64("node", F.lit(seed), F.lit(salt)), F.lit(1 << 24)) / float(1 << 24) - 0.5) * (0.6 * side * UNIT)).cast("long")
    places = cut_lineage(linked.select("node", spot(0).alias("x"), spot(1).alias("y")))
    for turn in range(rounds if count else 0):
        old = places
        places = cut_lineage(moved(old, links, side, depth, 0.1 * side * (1 - turn / rounds) ** 1.5 + 0.01))
        drop_kept(old)
    box = places.agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("x", "y")])
    span = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"), F.lit(UNIT))
    scaled = lambda c: ((F.col(c) - (F.col(f"min_{c}") + F.col(f"max_{c}")) / 2) * (fixed.LAYOUT_SPAN / span)).alias(c)
    inner = places.crossJoin(F.broadcast(box)).select(F.col("node").alias(key), scaled("x"), scaled("y"))  # one row
    return inner.unionByName(isolates(known.join(linked, "node", "left_anti").withColumnRenamed("node", key), key))


def isolates(nodes: DataFrame, key: str = "paper_id") -> DataFrame:
    """(paper_id, x, y) on a circle, in the order of the ids."""
    placed = numbered(nodes, [F.col(key)])
    count = placed.count()
    angle = F.col("place") * (2 * math.pi / max(count, 1))
    return placed.select(key, (fixed.ISOLATE_RADIUS * F.cos(angle)).alias("x"), (fixed.ISOLATE_RADIUS * F.sin(angle)).alias("y"))

"""Forests and second-order boosted trees on histograms, many models in one pass.

Columns are binned once (``fit_bins``): a fixed grid of cells a column, merged into bins of about
equal counts.  Training rows become blocks of at most ``BLOCK_ROWS`` rows.  A tree grows level by
level from three sums (gradient, hessian, rows) per node, column and bin.  Gradients are rounded to
multiples of 1 / ``SCALE``, so sums are exact integers and a model depends neither on how rows are dealt
nor on the order in which partial sums meet.

Rows that fit one task (``WHOLE_ROWS``) need no exchange of histograms: models, and the trees of forests,
are dealt to tasks; forests of one family grow together (``Grove``).  Beyond that, boosting goes in step: the rows stay in memory,
and each level of all models is a short job of one stage that sends the driver full histograms.  Forests go by rounds: each level of all trees is one Spark
job, sums by task, added by (model, tree, nodes), the best splits found there, only those sent to the
driver.  All ways yield the same trees.
"""

from __future__ import annotations

import copy
import functools
import hashlib
import heapq
import math
import pickle
import zlib
from collections.abc import Generator, Iterable, Iterator, Sequence
from dataclasses import dataclass, field, fields, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.session import checkpoint_dir, scratch_path, ship_package

CELLS = 4096
BINS = 64
BLOCK_ROWS = 50_000
SCALE = 1 << 20
#: Nodes whose histograms travel in one row between tasks.
NODES_A_ROW = 64
#: Trees, a model on average, after which the margins of models that boost in step are kept with the rows,
#: and rounds of these after which they are checkpointed.
REFRESH = 1
CHECKPOINT = 16
#: Joint values up to which columns are summed together.
JOINT_VALUES = 512
MIN_GAIN = 1e-6
#: Rows that are routed at a time, so that what they need stays in the cache.
STRIP = 1 << 15
#: Binned rows (some 30 bytes each) up to which a task may hold them all; models and trees are then dealt to tasks.  A
#: task that grows a model needs some 160 bytes a row, 1 GB at most.
WHOLE_ROWS = 6_000_000
#: Rows and nodes that a growing tree takes up at a time, and cells that it decides at a time.
RUN_ROWS = 1 << 15
RUN_NODES = 1 << 11
RUN_CELLS = 1 << 17
#: Rows a node below which only the bins that occur are summed.
FEW_ROWS = 100
#: Rows for which boosting in step takes a further task.
STEP_ROWS = 30_000
#: Bytes of histograms that a task sends in one turn of boosting in step.
TURN_BYTES = 8 << 20


@dataclass(frozen=True)
class TreeSpec:
    """A forest (``kind='forest'``) or boosted trees (``'boost'``).

    ``weighting``: None, 'balanced' (n / 2 n_c) or 'pos_scale' (n0 / n1 on positives), from the rows it
    trains on.  ``fold`` holds out rows of that fold.  ``second_order`` boosting divides by hessians when it
    chooses splits, else by rows; leaves are Newton steps either way.  ``prior`` starts from the log odds."""

    kind: str
    trees: int
    depth: int | None = None
    rate: float = 1.0
    l2: float = 0.0
    l1: float = 0.0
    gamma: float = 0.0
    min_child: float = 0.0
    min_leaf: int = 1
    min_split: int = 2
    subsample: float = 1.0
    columns: float = 1.0
    sqrt_columns: bool = False
    bootstrap: bool = False
    impurity: str = "gini"
    second_order: bool = True
    prior: bool = False
    weighting: str | None = None
    seed: int = 42
    fold: int | None = None


# ---- bins ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bins:
    """``cells[c]`` maps the grid cells of column c, ``CELLS`` from ``low[c]`` to ``high[c]``, to bins."""

    low: list[float]
    high: list[float]
    cells: np.ndarray

    def of(self, values: np.ndarray) -> np.ndarray:
        low, high = np.asarray(self.low), np.asarray(self.high)
        width = np.where(high > low, high - low, 1.0)
        at = np.clip(np.floor((np.nan_to_num(values) - low) * CELLS / width), 0, CELLS - 1).astype(np.int64)
        return self.cells[np.arange(len(low)), at]


def fit_bins(df: DataFrame, features: Column, width: int, bins: int = BINS) -> Bins:
    """Two aggregates: ranges, then rows per column and cell (at most ``CELLS`` a column)."""
    a = df.select(features.alias("a"))
    ends = a.select(*[f(F.col("a")[i]).alias(f"{n}{i}") for i in range(width) for n, f in (("l", F.min), ("h", F.max))]).first()
    low, high = [float(ends[f"l{i}"]) for i in range(width)], [float(ends[f"h{i}"]) for i in range(width)]
    span = [h - x if h > x else 1.0 for x, h in zip(low, high)]
    cell = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.least(
        F.floor((F.col("a")[i] - F.array(*map(F.lit, low))[i]) * F.lit(float(CELLS)) / F.array(*map(F.lit, span))[i]), F.lit(CELLS - 1)
    ).cast("int"))
    counts = a.select(F.posexplode(cell).alias("c", "cell")).groupBy("c", "cell").agg(F.count(F.lit(1)).alias("n")).collect()
    grid = np.zeros((width, CELLS), np.int64)
    for r in counts:
        grid[r["c"], r["cell"]] = r["n"]
    before = grid.cumsum(axis=1) - grid
    return Bins(low, high, (before * bins // np.maximum(grid.sum(axis=1, keepdims=True), 1)).astype(np.uint8))


# ---- trees --------------------------------------------------------------------------------------

#: Where a model is judged: after so many trees, or after so many that are cut at a depth (None: not cut).
Stop = int | tuple[int, int | None]


def _pairs(stops: Sequence[Stop]) -> list[tuple[int, int | None]]:
    return [(s, None) if isinstance(s, int) else s for s in stops]



@dataclass
class Tree:
    """Nodes in the order in which they were opened; ``column`` -1 marks a leaf or an open node."""

    number: int
    column: np.ndarray = field(default_factory=lambda: np.full(1, -1, np.int16))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int16))
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(1))
    gain: np.ndarray = field(default_factory=lambda: np.zeros(1))
    depth: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    rows: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    open: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    key: np.ndarray = field(default_factory=lambda: np.ones(1, np.uint64))  # names the way from the root

    def children(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Column and cut by node, and left and right child beside each other; a leaf leads to itself."""
        inner, here = self.column >= 0, np.arange(len(self.column))
        sides = np.stack([np.where(inner, self.left, here), np.where(inner, self.right, here)], axis=1).ravel()
        return np.where(inner, self.column, 0).astype(np.int64), self.cut, sides.astype(np.int64)

    def route(self, x: np.ndarray, start: np.ndarray | None = None, steps: int | None = None) -> np.ndarray:
        """The node that each row of bins reaches from the root, or from ``start`` in so many steps."""
        out = np.zeros(len(x), np.int64) if start is None else start.copy()
        steps = int(self.depth.max()) if steps is None else steps
        column, cut, sides = self.children()
        inner = self.column >= 0
        for k in range(0, len(x) if steps else 0, STRIP):
            part = x[k : k + STRIP]
            flat, base, at, live = part.reshape(-1), np.arange(len(part)) * x.shape[1], out[k : k + STRIP], None
            for step in range(1, steps + 1):
                at = sides.take(2 * at + (flat.take(base + column.take(at)) > cut.take(at)))
                if step % 5 == 0 and step < steps:  # rows that are in a leaf go no further
                    go = np.flatnonzero(inner.take(at))
                    if 4 * len(go) < 3 * len(at):
                        live = np.arange(k, k + len(part)) if live is None else live
                        out[live], at, base, live = at, at.take(go), base.take(go), live.take(go)
            out[slice(k, k + STRIP) if live is None else live] = at
        return out

    def values(self, x: np.ndarray) -> np.ndarray:
        return self.value.take(self.route(x))

    def values_at(self, x: np.ndarray, depths: Iterable[int | None]) -> dict[int | None, np.ndarray]:
        """Values of the rows in this tree cut at each depth; None: not cut."""
        at, done, most, out = np.zeros(len(x), np.int64), 0, int(self.depth.max()), {}
        for d in sorted(depths, key=lambda d: most if d is None else d):
            steps = most if d is None else min(d, most)
            at, done = self.route(x, at, steps - done), steps
            out[d] = self.value.take(at)
        return out

    def grow(self, spec: TreeSpec, best: Best) -> None:
        """Split the open nodes as answered; the children that may split further are open next."""
        self.value[self.open], self.rows[self.open] = leaf_value(spec, best.total), best.total[:, 2]
        split = np.flatnonzero(best.column >= 0)
        nodes, first = self.open[split], len(self.column)
        self.column[nodes], self.cut[nodes], self.gain[nodes] = best.column[split], best.cut[split], best.gain[split]
        self.left[nodes] = first + 2 * np.arange(len(split))
        self.right[nodes] = self.left[nodes] + 1
        stats = np.stack([best.left[split], best.total[split] - best.left[split]], axis=1).reshape(-1, 3)
        depth = np.repeat(self.depth[nodes] + 1, 2)
        blank = np.zeros(len(stats))
        key = _mixed(2 * np.repeat(self.key[nodes], 2) + np.tile(np.arange(2, dtype=np.uint64), len(split)))
        for name, v in (("column", blank - 1), ("cut", blank), ("left", blank), ("right", blank), ("gain", blank), ("value", leaf_value(spec, stats)), ("depth", depth), ("rows", stats[:, 2]), ("key", key)):
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, v.astype(old.dtype)]))
        more = stats[:, 2] >= max(spec.min_split, 2 * spec.min_leaf)
        if spec.depth is not None:
            more &= depth < spec.depth
        if spec.kind == "forest":
            more &= (stats[:, 0] != 0) & (stats[:, 0] != stats[:, 1])
        self.open = first + np.flatnonzero(more)


@dataclass
class Best:
    """Per open node: its sums, and column (-1: none), cut, gain and left sums of its best split."""

    total: np.ndarray
    column: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    left: np.ndarray

    def at(self, nodes) -> Best:
        return Best(*(getattr(self, f.name)[nodes] for f in fields(self)))

    def put(self, nodes, other: Best) -> None:
        for f in fields(self):
            getattr(self, f.name)[nodes] = getattr(other, f.name)


@dataclass
class Request:
    """Open nodes of a tree and the columns that each may split on, after the trees ``before`` it."""

    tree: Tree
    columns: np.ndarray
    before: list[Tree]


def _shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0) if l1 else g


def leaf_value(spec: TreeSpec, stats: np.ndarray) -> np.ndarray:
    a, b = stats[..., 0] / SCALE, stats[..., 1] / SCALE
    with np.errstate(divide="ignore", invalid="ignore"):
        if spec.kind == "forest":
            return np.where(b != 0, a / b, 0.0)
        return np.where(b + spec.l2 > 0, -spec.rate * _shrunk(a, spec.l1) / (b + spec.l2), 0.0)


def _score(spec: TreeSpec, s: np.ndarray) -> np.ndarray:
    """What a node contributes to the gain: the larger the better."""
    a, b, n = s[..., 0] / SCALE, s[..., 1] / SCALE, s[..., 2]
    with np.errstate(divide="ignore", invalid="ignore"):
        if spec.kind == "boost":
            down = b + spec.l2 if spec.second_order else n
            return np.where(down > 0, _shrunk(a, spec.l1) ** 2 / down, 0.0)
        if spec.impurity == "gini":
            return np.where(b > 0, -2.0 * a * (b - a) / b, 0.0)
        parts = [np.where(x > 0, x * np.log(x / b), 0.0) for x in (a, b - a)]
        return np.where(b > 0, parts[0] + parts[1], 0.0)


def best_splits(spec: TreeSpec, hist: np.ndarray, columns: np.ndarray) -> Best:
    """``hist``: 3 x nodes x columns x bins.  Ties go to the first column, then the first bin."""
    left = np.moveaxis(hist.cumsum(axis=3), 0, -1)
    total = left[:, :1, -1:, :]
    right = np.moveaxis(np.moveaxis(total, -1, 0) - np.moveaxis(left, -1, 0), 0, -1)
    gain = _score(spec, left) + _score(spec, right) - _score(spec, total)
    ok = np.minimum(left[..., 2], right[..., 2]) >= spec.min_leaf
    if spec.min_child:
        ok &= np.minimum(left[..., 1], right[..., 1]) >= spec.min_child * SCALE
    nodes, bins = np.arange(hist.shape[1]), hist.shape[3]
    flat = np.where(ok, gain, -np.inf).reshape(len(nodes), -1)
    at = flat.argmax(axis=1)
    best = flat[nodes, at]
    split = (best > MIN_GAIN) & (best >= spec.gamma)
    return Best(
        total[:, 0, 0].copy(), np.where(split, columns[nodes, at // bins], -1), at % bins, np.where(split, best, 0.0),
        left[nodes, at // bins, at % bins],
    )


@dataclass
class Cells:
    """The bins that occur, column by column: ``column`` and ``bin`` of each, and where a column starts."""

    column: np.ndarray
    bin: np.ndarray
    start: np.ndarray

    @property
    def size(self) -> np.ndarray:
        return np.diff(np.append(self.start, len(self.column)))


#: Sums of nodes x cells that are decided at a time, so that what that needs stays in the cache.
DECIDED = 1 << 13


def best_of_held(spec: TreeSpec, hist: np.ndarray, cells: Cells) -> Best:
    """As ``best_splits``, on 3 x nodes x cells: a cut after a bin that no row has parts the rows as the one
    before it does, so it never comes first."""
    count, width = hist.shape[1:]
    out = _no_split(count)
    size = cells.size
    before = np.repeat(cells.start - 1, size)  # -1: the first column has no cell before it
    first, step = before < 0, max(1, DECIDED // max(width, 1))
    for k in range(0, count, step):
        left = hist[:, k : k + step].cumsum(axis=2)
        total = left[:, :, size[0] - 1].copy()
        base = left.take(before, axis=2)
        base[:, :, first] = 0.0
        left -= base
        right = total[:, :, None] - left
        gain = _gains(spec, left) + _gains(spec, right)
        gain -= _gains(spec, total[:, :, None])
        bad = np.minimum(left[2], right[2]) < spec.min_leaf
        if spec.min_child:
            bad |= np.minimum(left[1], right[1]) < spec.min_child * SCALE
        gain[bad] = -np.inf
        at, nodes = gain.argmax(axis=1), np.arange(len(gain))
        best = gain[nodes, at]
        split = (best > MIN_GAIN) & (best >= spec.gamma)
        here = slice(k, k + step)
        out.total[here], out.left[here], out.cut[here] = total.T, left[:, nodes, at].T, cells.bin[at]
        out.column[here], out.gain[here] = np.where(split, cells.column[at], -1), np.where(split, best, 0.0)
    return out


def _gains(spec: TreeSpec, s: np.ndarray) -> np.ndarray:
    """``_score`` of sums that lie apart; where no divisor can be 0, without looking for one."""
    if spec.kind != "boost" or (spec.second_order and spec.l2 <= 0):
        return _score(spec, np.moveaxis(s, 0, -1))
    a = s[0] * (1.0 / SCALE)
    if spec.l1:
        np.abs(a, out=a)
        a -= spec.l1
        np.maximum(a, 0.0, out=a)
    a *= a
    if spec.second_order:
        down = s[1] * (1.0 / SCALE)
        down += spec.l2
    else:
        down = np.maximum(s[2], 1.0)  # without rows there is no gradient either
    a /= down
    return a


def best_of_cells(spec: TreeSpec, cells: np.ndarray, sums: np.ndarray, columns: np.ndarray) -> Best:
    """As ``best_splits``, from the cells that hold rows alone: ``cells`` are their places in the histogram,
    ascending, ``sums`` cells x 3.  A cut after an empty cell parts the rows as the one before it does."""
    return bests_of_cells(spec, cells, sums, columns, [spec.min_leaf])[0]


def bests_of_cells(spec: TreeSpec, cells: np.ndarray, sums: np.ndarray, columns: np.ndarray, leaves: Sequence[int]) -> list[Best]:
    """``best_of_cells`` for each of several ``min_leaf``."""
    nodes, k = columns.shape
    outs = [_no_split(nodes) for _ in leaves]
    if not len(cells):
        return outs
    run, group = sums.cumsum(axis=0), cells // BINS
    first = np.flatnonzero(np.diff(group, prepend=-1))
    size = np.diff(np.append(first, len(cells)))
    base = run[first] - sums[first]
    whole = run[first + size - 1] - base
    left, total = run - np.repeat(base, size, axis=0), np.repeat(whole, size, axis=0)
    right = total - left
    gains = _score(spec, left) + _score(spec, right) - np.repeat(_score(spec, whole), size)
    least = np.minimum(left[:, 2], right[:, 2])
    if spec.min_child:
        least[np.minimum(left[:, 1], right[:, 1]) < spec.min_child * SCALE] = 0
    node = group // k
    start = np.flatnonzero(np.diff(node, prepend=-1))
    found, width = node[start], np.diff(np.append(start, len(cells)))
    for out, leaf in zip(outs, leaves):
        gain = np.where(least >= max(leaf, 1), gains, -np.inf)
        best = np.maximum.reduceat(gain, start)
        tops = np.flatnonzero(gain == np.repeat(best, width))
        at = tops[np.flatnonzero(np.diff(node[tops], prepend=-1))]
        split = (best > MIN_GAIN) & (best >= spec.gamma)
        out.total[found], out.left[found], out.cut[found] = total[start], left[at], cells[at] % BINS
        out.column[found] = np.where(split, columns[found, group[at] % k], -1)
        out.gain[found] = np.where(split, best, 0.0)
    return outs


def _no_split(nodes: int) -> Best:
    return Best(np.zeros((nodes, 3)), np.full(nodes, -1), np.zeros(nodes, np.int64), np.zeros(nodes), np.zeros((nodes, 3)))


Growing = Generator[list[Request], list[Best], list[Tree]]


def grow(spec: TreeSpec, width: int) -> Growing:
    """Asks for the splits of all open nodes and returns the finished trees; the trees of a forest grow
    side by side, boosted trees after one another."""
    done: list[Tree] = []
    for group in [range(spec.trees)] if spec.kind == "forest" else [[t] for t in range(spec.trees)]:
        trees = [Tree(t) for t in group]
        shared = {t: _tree_columns(spec, t, width) for t in group}
        live = trees
        while live:
            best = yield [Request(t, _node_columns(spec, t, shared[t.number]), done if spec.kind == "boost" else []) for t in live]
            for t, b in zip(live, best):
                t.grow(spec, b)
            live = [t for t in live if len(t.open)]
        done = done + trees
    return done


def _tree_columns(spec: TreeSpec, t: int, width: int) -> np.ndarray:
    if spec.columns >= 1:
        return np.arange(width)
    rng = np.random.default_rng([spec.seed, t, 1])
    return np.sort(rng.choice(width, max(1, int(spec.columns * width)), replace=False))


def _node_columns(spec: TreeSpec, tree: Tree, shared: np.ndarray) -> np.ndarray:
    """Columns of each open node, ascending."""
    return _drawn_columns(spec, tree.number, tree.key[tree.open], shared)


def _drawn_columns(spec: TreeSpec, number: int, key: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Columns of nodes by the way that leads to them, so that a node has the same in every tree that has it."""
    if not spec.sqrt_columns:
        return np.tile(shared, (len(key), 1))
    k = max(1, math.isqrt(len(shared)))
    ids = key[:, None] + np.arange(1, len(shared) + 1, dtype=np.uint64) * _M2
    draws = uniform(_mixed(ids.ravel()), spec.seed, number).reshape(len(key), len(shared))
    return np.sort(shared[draws.argsort(axis=1)[:, :k]], axis=1)


# ---- blocks of rows -----------------------------------------------------------------------------

_M1, _M2, _GOLD = (np.uint64(v) for v in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
#: Cumulative probabilities of a Poisson(1) count, the bootstrap of a row.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def uniform(ids: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """A draw in [0, 1) for each row id, the same wherever the row lies."""
    with np.errstate(over="ignore"):
        z = _mixed(ids.astype(np.uint64) * _GOLD + np.uint64((seed * 1_000_003 + tree * 7919 + 1) & 0xFFFFFFFFFFFF) * _M1)
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _mixed(z: np.ndarray) -> np.ndarray:
    """Whole numbers of 64 bits, well spread."""
    z = (z ^ (z >> np.uint64(30))) * _M1
    z = (z ^ (z >> np.uint64(27))) * _M2
    return z ^ (z >> np.uint64(31))


def poisson(u: np.ndarray) -> np.ndarray:
    """Poisson(1) counts by inversion."""
    out = np.zeros(len(u), np.uint8)
    for p in _POISSON:
        out += u >= p
    return out


class Block:
    """Rows that a task holds, of one or more written blocks."""

    def __init__(self, rows: Sequence[dict], width: int, counts: dict):
        joined = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in rows])
        self.y, self.x = joined("y", np.int8), joined("x", np.uint8).reshape(-1, width)
        self.ids, self.fold = joined("ids", np.int64), joined("folds", np.int32)
        self.counts = counts
        kept = [pickle.loads(r["margins"]) if r["margins"] else {} for r in rows]
        self.margins = {k: (v[0], np.concatenate([m[k][1] for m in kept])) for k, v in kept[0].items()}
        self.kept: dict = rows[0].get("stats") or {}  # by model: a tree's number and its statistics
        self._joint: list[Joint] | None = None
        if rows[0].get("joint"):
            columns, codes = rows[0]["joint"]
            self._joint = [replace(j, code=code) for j, code in zip(columns, codes)]

    @property
    def joint(self) -> list[Joint]:
        if self._joint is None:
            self._joint = joint_columns(self.x)
        return self._joint

    @functools.cached_property
    def columns(self) -> np.ndarray:
        """Bins column by column."""
        return np.ascontiguousarray(self.x.T)

    @functools.cached_property
    def marked(self) -> np.ndarray:
        """Bins, those of positives above the others."""
        return self.x + (self.y * np.uint8(BINS)).astype(np.uint8)[:, None]

    @functools.cached_property
    def marked_joint(self) -> list[np.ndarray]:
        """Joint values, those of positives above the others."""
        return [j.code + self.y.astype(np.uint16) * np.uint16(len(j.bins)) for j in self.joint]

    def cells(self, columns: np.ndarray) -> Cells:
        """Cells of some columns, ascending, without those of columns that are never cut (``Joint.over``)."""
        held = {c: (j, h) for j in self.joint for c, h in zip(j.columns, j.held)}
        used = [c for c in columns.tolist() if not held[c][0].over[c] & set(columns.tolist())]
        sizes = [len(held[c][1]) for c in used]
        return Cells(np.repeat(used, sizes), np.concatenate([held[c][1] for c in used]), np.cumsum([0, *sizes[:-1]]))

    def _copy(self) -> Block:
        out = copy.copy(self)
        for name in ("columns", "marked", "marked_joint"):
            out.__dict__.pop(name, None)
        return out

    def without(self, fold: int | None) -> Block:
        """The rows that a model which holds out ``fold`` trains on, without margins."""
        stay = np.flatnonzero(self.fold != (-1 if fold is None else fold))
        if len(stay) == len(self.y):
            return self
        out = self._copy()
        out.y, out.x, out.ids, out.fold, out.margins, out.kept = self.y[stay], self.x[stay], self.ids[stay], self.fold[stay], {}, {}
        out._joint = [replace(j, code=j.code[stay]) for j in self.joint]
        return out

    def margin(self, key, spec: TreeSpec, before: Sequence[Tree]) -> np.ndarray:
        """Sum of the trees so far; the last sums are kept, so each tree is added once."""
        done, m = self.margins.get(key) or (0, np.full(len(self.y), prior(spec, self.counts)))
        for tree in before[done:]:
            m = m + tree.values(self.x)
        self.margins[key] = (len(before), m)
        return m

    def stats(self, key, spec: TreeSpec, request: Request) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradient (or weight of positives), hessian (or weight) and 1 per row; 0 where a row takes no part."""
        t, n = request.tree.number, len(self.y)
        if key in self.kept and self.kept[key][0] == t:
            return self.kept[key][1]
        weights = class_weights(spec, self.counts)
        margin = None if spec.kind == "forest" else self.margin(key, spec, request.before)
        out = np.empty(n), np.empty(n), np.empty(n, bool)
        for k in range(0, n, STRIP):
            here = slice(k, k + STRIP)
            found = self._stats(spec, t, weights, here, None if margin is None else margin[here])
            for v, part in zip(out, found):
                v[here] = part
        return out

    def _stats(self, spec: TreeSpec, t: int, weights: tuple[float, float], here: slice, margin: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        y, (w0, w1) = self.y[here], weights
        used = (self.fold[here] != (-1 if spec.fold is None else spec.fold)).astype(np.float64)
        if spec.bootstrap:
            used *= poisson(uniform(self.ids[here], spec.seed, t))
        elif spec.subsample < 1:
            used *= uniform(self.ids[here], spec.seed, t) < spec.subsample
        w = used * np.where(y == 1, w1, w0)
        if spec.kind == "forest":
            a, b = w * y, w
        else:
            p = 1.0 / (1.0 + np.exp(-margin))
            a, b = w * (p - y), w * p * (1.0 - p)
        return np.rint(a * SCALE), np.rint(b * SCALE), used > 0

    def strips(self) -> Iterator[Block]:
        """The rows by the strip, as blocks that share this one's arrays."""
        joint = self.joint
        for k in range(0, len(self.y), STRIP):
            here, out = slice(k, k + STRIP), self._copy()
            out.y, out.x, out.ids, out.fold = self.y[here], self.x[here], self.ids[here], self.fold[here]
            out.margins = {key: (done, m[here]) for key, (done, m) in self.margins.items()}
            out.kept = {key: (t, tuple(v[here] for v in found)) for key, (t, found) in self.kept.items()}
            out._joint = [replace(j, code=j.code[here]) for j in joint]
            yield out

    def histogram(self, key, spec: TreeSpec, request: Request, stats: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Cells of nodes x columns x bins that hold rows, ascending, and their three sums."""
        tree, columns = request.tree, request.columns
        stats = self.stats(key, spec, request) if stats is None else stats
        slots = np.full(len(tree.column), -1)
        slots[tree.open] = np.arange(len(tree.open))
        slot = slots.take(tree.route(self.x))
        rows = np.flatnonzero((slot >= 0) & stats[2])
        if spec.kind == "forest":
            return forest_cells(self.x, rows, slot[rows], columns, self.y[rows], stats[1][rows])
        hist = self.dense(rows, slot[rows], columns, [v[rows] for v in stats[:2]])
        cells = np.flatnonzero(hist[2])
        return cells, hist.reshape(3, -1)[:, cells].T

    def dense(self, rows: np.ndarray, slot: np.ndarray, columns: np.ndarray, stats: Sequence[np.ndarray]) -> np.ndarray:
        """3 x nodes x columns x bins: sums of gradient, hessian and rows.  All nodes have the same columns."""
        nodes, k = columns.shape
        hist = np.zeros((3, nodes, k * BINS))
        if nodes:
            cells = self.cells(columns[0])
            place = np.searchsorted(columns[0], cells.column) * BINS + cells.bin
            hist[:, :, place] = self.summed(rows, slot, nodes, cells, stats)
        return hist.reshape(3, nodes, k, BINS)

    def summed(self, rows: np.ndarray, slot: np.ndarray, nodes: int, cells: Cells, stats: Sequence[np.ndarray]) -> np.ndarray:
        """3 x nodes x cells: sums of gradient, hessian and rows."""
        hist = np.empty((3, nodes, len(cells.column)))
        used = dict(zip(cells.column[cells.start].tolist(), zip(cells.start.tolist(), cells.size.tolist())))
        (a, b), (room, v) = stats, _packed_rows(stats[1])
        parts = (a, b, None) if room is None else (a, v)
        for joint in self.joint:
            mine = [m for m, c in enumerate(joint.columns) if c in used]
            if not mine:
                continue
            size, at = len(joint.bins), joint.code.take(rows)
            if slot is not None:
                at = slot * size + at
            got = np.concatenate([np.bincount(at, v, nodes * size).reshape(nodes, size) for v in parts])
            got = (got @ np.hstack([joint.marks[m] for m in mine])).reshape(len(parts), nodes, -1)
            end = 0
            for m in mine:
                first, n = used[joint.columns[m]]
                hist[: len(parts), :, first : first + n] = got[:, :, end : end + n]
                end += n
        if room is not None:
            np.floor(hist[1] * (1.0 / room), out=hist[2])
            hist[1] -= hist[2] * room
        return hist

    def summed_run(self, rows: np.ndarray, slot: np.ndarray | None, nodes: int, cells: Cells, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """As ``summed``, from statistics of all rows; the rows of a single node, without slots, piece by piece."""
        if slot is not None:
            return self.summed(rows, slot, nodes, cells, (a.take(rows), b.take(rows)))
        used = set(cells.column.tolist())
        joints = [j for j in self.joint if used & set(j.columns)]
        got = [np.zeros((3, len(j.bins))) for j in joints]
        for k in range(0, max(len(rows), 1), RUN_ROWS):
            part = rows[k : k + RUN_ROWS]
            one, two = a.take(part), b.take(part)
            room, v = _packed_rows(two)
            for j, sums in zip(joints, got):
                at = j.code.take(part)
                size = len(j.bins)
                sums[0] += np.bincount(at, one, size)
                both = np.bincount(at, v, size)
                both, n = (both, np.bincount(at, None, size)) if room is None else _unpacked_rows(both, room)
                sums[1] += both
                sums[2] += n
        hist, first = np.empty((3, 1, len(cells.column))), dict(zip(cells.column[cells.start].tolist(), cells.start.tolist()))
        for j, sums in zip(joints, got):
            for c, held, marks in zip(j.columns, j.held, j.marks):
                if c in first:
                    hist[:, 0, first[c] : first[c] + len(held)] = sums @ marks
        return hist

    def full(self, rows: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Sums (weight of positives, weight, rows) x columns x bins, flat, of some rows; ``b`` is of all rows."""
        got = [np.zeros((2, 2 * len(j.bins))) for j in self.joint]
        for k in range(0, len(rows), RUN_ROWS):
            part = rows[k : k + RUN_ROWS]
            two = b.take(part)
            room, v = _packed_rows(two)
            for code, sums in zip(self.marked_joint, got):
                at = code.take(part)
                both = np.bincount(at, v, sums.shape[1])
                both, n = (both, np.bincount(at, None, sums.shape[1])) if room is None else _unpacked_rows(both, room)
                sums[0] += both
                sums[1] += n
        hist = np.zeros((3, self.x.shape[1], BINS))
        for j, sums in zip(self.joint, got):
            (zero, one), (n0, n1) = sums.reshape(2, 2, -1)
            for c, held, marks in zip(j.columns, j.held, j.marks):
                hist[:, c, held] = np.stack([one, zero + one, n0 + n1]) @ marks
        return hist.reshape(3, -1)

    def totals(self, spec: TreeSpec, trees: Iterable[Tree], stops: Sequence[Stop]) -> np.ndarray:
        """Per stop, the sums of the trees before it over the held-out rows."""
        return self.totals_of_all(spec.fold, ([t] for t in trees), [stops])[0]

    def totals_of_all(self, fold: int | None, trees: Iterable[Sequence[Tree | None]], stops: Sequence[Sequence[Stop]]) -> list[np.ndarray]:
        """``totals`` of several models, whose trees come together; None: a model has no more."""
        x = self.x[self.fold == fold]
        out = [np.zeros((len(found), len(x))) for found in stops]
        for grown in trees:
            for tree, totals, found in zip(grown, out, stops):
                asked = [(total, d) for total, (n, d) in zip(totals, _pairs(found)) if tree is not None and tree.number < n]
                values = tree.values_at(x, {d for _, d in asked}) if asked else {}
                for total, d in asked:
                    total += values[d]
        return out

    def confusion(self, spec: TreeSpec, trees: Iterable[Tree], stops: Sequence[Stop]) -> list[list[int]]:
        """tn, fp, fn, tp of the held-out rows at every stop."""
        y = self.y[self.fold == spec.fold]
        return [_confusion(spec, self.counts, y, total, n) for total, (n, _) in zip(self.totals(spec, trees, stops), _pairs(stops))]


def _confusion(spec: TreeSpec, counts: dict, y: np.ndarray, total: np.ndarray, trees: int) -> list[int]:
    p = (total / trees > 0.5) if spec.kind == "forest" else (total + prior(spec, counts) > 0)
    return [int(((y == a) & (p == b)).sum()) for a in (0, 1) for b in (False, True)]


@dataclass
class Joint:
    """Columns that are summed together: each row's joint value, the columns' bins by joint value, and by
    column the bins that occur and which joint values (rows) have them."""

    columns: list[int]
    code: np.ndarray
    bins: np.ndarray
    held: list[np.ndarray] = field(default_factory=list)
    marks: list[np.ndarray] = field(default_factory=list)
    over: dict[int, set[int]] = field(default_factory=dict)  # columns before one whose cuts include all of its cuts


def joint_columns(x: np.ndarray, most: int = JOINT_VALUES) -> list[Joint]:
    """Every column in a group of columns that take at most ``most`` joint values, or alone.  The group's
    histogram gives those of its columns, so rows are summed once a group."""
    out: list[Joint] = []
    for c in range(x.shape[1]):
        for k, j in enumerate(out):
            found, code = _coded(j.code.astype(np.int64) * BINS + x[:, c], len(j.bins) * BINS)
            if len(found) <= most:
                out[k] = Joint([*j.columns, c], code, np.hstack([j.bins[found // BINS], (found % BINS)[:, None]]))
                break
        else:
            found, code = _coded(x[:, c].astype(np.int64), BINS)
            out.append(Joint([c], code, found[:, None]))
    for j in out:
        j.held = [np.unique(b) for b in j.bins.T]
        j.marks = [(b[:, None] == h).astype(np.float64) for b, h in zip(j.bins.T, j.held)]
        j.over = {c: {d for d, of in zip(j.columns[:m], j.bins.T) if _follows(j.bins[:, m], of)} for m, c in enumerate(j.columns)}
    return out


def _follows(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether ``one`` rises, or falls, with ``other`` and has one value where that has one.  Its cuts are then
    among the other's with the same gains, and ties go to the other if that is the earlier column."""
    by = np.lexsort((one, other))
    step, same = np.diff(one[by].astype(np.int64)), np.diff(other[by].astype(np.int64)) == 0
    return bool(not step[same].any() and ((step >= 0).all() or (step <= 0).all()))


def _coded(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The values that occur, ascending, and the place of each row's value among them."""
    seen = np.bincount(key, minlength=size) > 0
    return np.flatnonzero(seen), (np.cumsum(seen) - 1).astype(np.uint16).take(key)


def _room(b: np.ndarray, slot: np.ndarray) -> float | None:
    """A power of two above the rows of any node, if sums of ``b`` times it are exact in doubles: then one
    sum carries both ``b`` and the rows."""
    for rows, total in ((len(b), b.sum()), (None, None)):
        if rows is None:
            rows, total = np.bincount(slot).max(), np.bincount(slot, b).max()
        room = float(1 << int(rows).bit_length())
        if (total + 1) * room < 2.0**53:
            return room
    return None


def forest_cells(x: np.ndarray, rows: np.ndarray, slot: np.ndarray, columns: np.ndarray, y: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of nodes x columns x bins that hold rows, ascending, and sums of the weight of positives, the
    weight and rows.  Positives are summed apart."""
    nodes, k = columns.shape
    if not len(rows):
        return np.empty(0, np.int64), np.empty((0, 3))
    room = _room(b, slot)
    flat, base, high = x.reshape(-1), rows * x.shape[1], (slot + y * np.int64(nodes)) * BINS
    v = b if room is None else b * room + 1.0
    sums, n = np.empty((2, nodes, k, BINS)), None if room is not None else np.empty((nodes, k, BINS))
    for j in range(k):
        at = flat.take(base + columns[:, j].take(slot)) + high
        sums[:, :, j] = np.bincount(at, v, 2 * nodes * BINS).reshape(2, nodes, BINS)
        if n is not None:
            n[:, j] = np.bincount(at, None, 2 * nodes * BINS).reshape(2, nodes, BINS).sum(axis=0)
    negative, positive = sums.reshape(2, -1)
    cells = np.flatnonzero((negative + positive) > 0 if n is None else n.ravel())
    out = np.empty((len(cells), 3))
    one, zero = positive.take(cells), negative.take(cells)
    if n is None:
        w1, w0 = np.floor(one / room), np.floor(zero / room)
        out[:, 0], out[:, 1], out[:, 2] = w1, w1 + w0, (one - w1 * room) + (zero - w0 * room)
    else:
        out[:, 0], out[:, 1], out[:, 2] = one, one + zero, n.ravel().take(cells)
    return cells, out


def _to_sum(tree: Tree, parents: np.ndarray | None, first: int) -> np.ndarray:
    """Places of the open nodes whose histograms must be summed: of two open siblings the smaller."""
    if parents is None:
        return np.arange(len(tree.open))
    side = (tree.open - first) % 2
    twin = tree.open + 1 - 2 * side
    mine, other = tree.rows[tree.open], tree.rows[twin]
    return np.flatnonzero((mine < other) | ((mine == other) & (side == 0)) | ~np.isin(twin, tree.open))


def _completed(tree: Tree, parents: np.ndarray | None, first: int, summed: np.ndarray, got: np.ndarray) -> np.ndarray:
    """Histograms of all open nodes: the larger sibling is the parent less the smaller."""
    if len(summed) == len(tree.open):
        return got
    place = np.full(len(tree.column), -1)
    place[tree.open[summed]] = np.arange(len(summed))
    full = np.empty((3, len(tree.open), *got.shape[2:]))
    full[:, summed] = got
    rest = np.setdiff1d(np.arange(len(tree.open)), summed)
    nodes = tree.open[rest]
    full[:, rest] = parents[:, (nodes - first) // 2] - got[:, place[nodes + 1 - 2 * ((nodes - first) % 2)]]
    return full


class Growth:
    """One tree grown on the rows of a block.  ``rows`` lie node by node, in the order of the open nodes, so that a
    level passes over them in short runs: what a run needs stays in the cache."""

    def __init__(self, block: Block, key, spec: TreeSpec, tree: Tree, before: Sequence[Tree]):
        self.block, self.spec, self.tree = block, spec, tree
        self.shared = _tree_columns(spec, tree.number, block.x.shape[1])
        self.a, self.b, self.used = block.stats(key, spec, Request(tree, self.shared[None], before))
        self.rows = np.flatnonzero(self.used)
        self.size = np.array([len(self.rows)])
        self.cells = block.cells(self.shared)
        self.value = np.zeros(len(block.y)) if spec.kind == "boost" else None  # of the leaf that a row has come to
        self.parents: np.ndarray | None = None  # full histograms of the nodes split last
        self.first = 0

    def grown(self) -> Tree:
        tree, spec = self.tree, self.spec
        while len(tree.open):
            full = self._full()
            best = best_of_held(spec, full, self.cells)
            first, opened = len(tree.column), tree.open
            tree.grow(spec, best)
            self._advance(best, first, opened)
            self.parents, self.first = full[:, best.column >= 0], first
        return tree

    def _runs(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Open nodes from, to, and their rows."""
        end = np.cumsum(self.size)
        for i, j in _runs(self.size):
            yield i, j, self.rows[end[i] - self.size[i] : end[j - 1]]

    def _full(self) -> np.ndarray:
        """Full histograms of the open nodes."""
        summed = _to_sum(self.tree, self.parents, self.first)
        place = np.full(len(self.tree.open), -1)
        place[summed] = np.arange(len(summed))
        got = np.empty((3, len(summed), len(self.cells.column)))
        for i, j, rows in self._runs():
            here = place[i:j]
            mine = here >= 0
            count = int(mine.sum())
            if not count:
                continue
            slot = None
            if j - i > 1:
                size = self.size[i:j]
                slot = np.repeat(np.arange(count), size[mine])
                rows = rows if count == j - i else rows.compress(np.repeat(mine, size))
            low = int(here[mine][0])
            got[:, low : low + count] = self.block.summed_run(rows, slot, count, self.cells, self.a, self.b)
        return _completed(self.tree, self.parents, self.first, summed, got)

    def _advance(self, best: Best, first: int, opened: np.ndarray) -> None:
        """Rows move to their child; those whose node is not open leave, with its value."""
        tree, values = self.tree, self.value
        split = best.column >= 0
        place = np.full(len(tree.column), -1)
        place[tree.open] = np.arange(len(tree.open))
        child = np.stack([opened, opened], axis=1)
        child[split] = first + np.arange(2 * split.sum()).reshape(-1, 2)
        goal = np.where(split[:, None], place[child], -1)
        if values is None and not len(tree.open):
            return
        size = tree.rows[tree.open]
        out, ends = np.empty(int(size.sum()), np.int64), np.append(0, np.cumsum(size))
        columns, width, flat = self.block.columns, self.block.x.shape[1], self.block.x.reshape(-1)
        for i, j, rows in self._runs():
            if j - i == 1:
                if not split[i]:
                    if values is not None:
                        values[rows] = tree.value[opened[i]]
                    continue
                filled = [ends[t] for t in goal[i].tolist()]  # how far the children are filled
                column, cut = columns[best.column[i]], best.cut[i]
                for k in range(0, len(rows), RUN_ROWS):
                    part = rows[k : k + RUN_ROWS]
                    right = column.take(part) > cut
                    for side in (0, 1):
                        to = goal[i, side]
                        if to < 0 and values is None:
                            continue
                        moved = part.compress(right if side else ~right)
                        if to >= 0:
                            out[filled[side] : filled[side] + len(moved)] = moved
                            filled[side] += len(moved)
                        else:
                            values[moved] = tree.value[child[i, side]]
                continue
            held, goals = self.size[i:j], goal[i:j].ravel()
            some = goals[goals >= 0]
            if not len(some) and values is None:
                continue
            at = rows * width
            at += np.repeat(np.where(split[i:j], best.column[i:j], 0), held)
            side = np.repeat(np.arange(0, 2 * (j - i), 2), held)
            side += flat.take(at) > np.repeat(best.cut[i:j], held)
            if values is not None and len(some) < len(goals):
                gone = np.flatnonzero((goals < 0).take(side))
                values[rows.take(gone)] = tree.value.take(child[i:j].ravel().take(side.take(gone)))
            if len(some):  # the open children of these nodes follow one another
                order = (goals - some[0] + 1).clip(0).astype(np.uint16).take(side)
                low, high = ends[some[0]], ends[some[-1] + 1]
                out[low:high] = rows.take(order.argsort(kind="stable")[len(rows) - (high - low) :])
        self.rows, self.size = out, size

    def values(self) -> np.ndarray:
        """The grown boosted tree's value of every row of the block."""
        rest = np.flatnonzero(~self.used)
        if len(rest):
            self.value[rest] = self.tree.values(self.block.x[rest])
        return self.value


class Grove:
    """The trees of one number of several forests that differ in least leaf, least split and depth alone.  A node that
    leads the same way in several trees holds the same rows and draws the same columns, so it is summed once;
    ``rows`` lie node by node.  ``at`` has the nodes of each tree's open nodes."""

    def __init__(self, block: Block, key, specs: Sequence[TreeSpec], number: int):
        self.block, self.specs, self.spec = block, specs, specs[0]
        self.trees = [Tree(number) for _ in specs]
        self.shared = _tree_columns(self.spec, number, block.x.shape[1])
        _, self.b, used = block.stats(key, self.spec, Request(self.trees[0], self.shared[None], []))
        self.rows = np.flatnonzero(used)
        self.size, self.key = np.array([len(self.rows)]), self.trees[0].key
        self.at = [np.zeros(1, np.int64) for _ in specs]
        self.parent = self.twin = np.array([-1])  # by node: the node above it, and the other one of the same split
        self.above: dict[int, np.ndarray] = {}  # full histograms of large nodes, of the level above

    def grown(self) -> list[Tree]:
        leaves = sorted({s.min_leaf for s in self.specs})
        while len(self.size):
            columns = _drawn_columns(self.spec, self.trees[0].number, self.key, self.shared)
            bests, self.above = self._bests(columns, leaves)
            ways = []  # of each tree's open nodes: node above, column, cut and side as one number
            for spec, tree, at in zip(self.specs, self.trees, self.at):
                best, first = bests[leaves.index(spec.min_leaf)].at(at), len(tree.column)
                tree.grow(spec, best)
                split = np.flatnonzero(best.column >= 0)[(tree.open - first) // 2]
                ways.append(((at[split] * 256 + best.column[split]) * BINS + best.cut[split]) * 2 + (tree.open - first) % 2)
            self._advance(ways)
        return self.trees

    def _bests(self, columns: np.ndarray, leaves: Sequence[int]) -> tuple[list[Best], dict[int, np.ndarray]]:
        """Best splits of the nodes by least leaf, each node on columns of its own, and the full histograms of the
        large ones."""
        full, (nodes, k) = self._full_of_large(columns.shape[1]), columns.shape
        bests = [_no_split(nodes) for _ in leaves]

        def decide(at: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
            cells, sums = parts[0] if len(parts) == 1 else map(np.concatenate, zip(*parts))
            for best, got in zip(bests, bests_of_cells(self.spec, cells, sums, columns[at], leaves)):
                best.put(at, got)

        if full:
            at = np.array(sorted(full))
            hist = np.stack([full[i].reshape(3, -1, BINS)[:, columns[i]] for i in at.tolist()], axis=1).reshape(3, -1)
            cells = np.flatnonzero(hist[2])
            decide(at, [(cells, hist.take(cells, axis=1).T.copy())])
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        here: list[int] = []
        end = np.cumsum(self.size)
        for i, j in _runs(self.size, full):
            cells, got = self._cells(self.rows[end[i] - self.size[i] : end[j - 1]], self.size[i:j], columns[i:j])
            waiting.append((cells + len(here) * k * BINS, got))
            here += range(i, j)
            if sum(len(c) for c, _ in waiting) >= RUN_CELLS:
                decide(np.array(here), waiting)
                waiting, here = [], []
        if here:
            decide(np.array(here), waiting)
        return bests, full

    def _cells(self, rows: np.ndarray, size: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells of nodes x columns x bins that hold rows, ascending, and sums of the weight of positives, the weight and
        rows.  Where nodes are small, most bins are empty: the others are numbered, not all summed."""
        b, (m, k) = self.b.take(rows), columns.shape
        room, v = _packed_rows(b)
        few = len(rows) < FEW_ROWS * m and room is not None
        bins = self.block.x if few else self.block.marked
        base, flat = rows * bins.shape[1], bins.reshape(-1)

        def places(c: int, step: int) -> np.ndarray:
            at = np.repeat(columns[:, c], size)
            at += base
            return np.repeat(np.arange(0, m * step, step), size) + flat.take(at)

        if few:
            at = np.concatenate([places(c, k * BINS) + c * BINS for c in range(k)])
            seen = np.zeros(m * k * BINS, bool)
            seen[at] = True
            cells = np.flatnonzero(seen)
            number = np.empty(len(seen), np.int32)
            number[cells] = np.arange(len(cells), dtype=np.int32)
            at = number.take(at) + np.tile(self.block.y.take(rows) * np.int32(len(cells)), k)
            (zero, n0), (one, n1) = (_unpacked_rows(s, room) for s in np.bincount(at, np.tile(v, k), 2 * len(cells)).reshape(2, -1))
        else:
            sums, count = np.empty((m, k, 2, BINS)), None if room else np.empty((m, k, 2, BINS))
            for c in range(k):
                at = places(c, 2 * BINS)
                sums[:, c] = np.bincount(at, v, m * 2 * BINS).reshape(m, 2, BINS)
                if count is not None:
                    count[:, c] = np.bincount(at, None, m * 2 * BINS).reshape(m, 2, BINS)
            held = sums if count is None else count
            cells = np.flatnonzero(held[:, :, 0] + held[:, :, 1])
            at = cells + cells // BINS * BINS  # its place among the negatives
            zero, one = sums.reshape(-1).take(at), sums.reshape(-1).take(at + BINS)
            if count is None:
                (zero, n0), (one, n1) = _unpacked_rows(zero, room), _unpacked_rows(one, room)
            else:
                n0, n1 = count.reshape(-1).take(at), count.reshape(-1).take(at + BINS)
        out = np.empty((len(cells), 3))
        out[:, 0], out[:, 1], out[:, 2] = one, zero + one, n0 + n1
        return cells, out

    def _full_of_large(self, k: int) -> dict[int, np.ndarray]:
        """Full histograms (sums x columns x bins, flat) of nodes of more than a run, where columns are summed together:
        of two children the smaller is summed, the larger is the node above less it."""
        out: dict[int, np.ndarray] = {}
        if len(self.block.joint) > 2 * k:
            return out
        end = np.cumsum(self.size)

        def summed(i: int) -> np.ndarray:
            return self.block.full(self.rows[end[i] - self.size[i] : end[i]], self.b)

        for i in np.flatnonzero(self.size > RUN_ROWS).tolist():
            if i in out:
                continue
            above, j = self.above.get(int(self.parent[i])), int(self.twin[i])
            if above is None or j < 0:
                out[i] = summed(i)
                continue
            i, j = (i, j) if self.size[i] <= self.size[j] else (j, i)
            out[i] = summed(i)
            out[j] = above - out[i]
        return out

    def _advance(self, ways: Sequence[np.ndarray]) -> None:
        """Rows move to the nodes that some tree has open; where trees split a node otherwise, they move to all."""
        nodes = ways[0] if len(ways) == 1 else np.unique(np.concatenate(ways))
        self.at = [np.searchsorted(nodes, w) for w in ways]
        size, key = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.uint64)
        for tree, at in zip(self.trees, self.at):
            size[at], key[at] = tree.rows[tree.open], tree.key[tree.open]
        split, inverse = np.unique(nodes // 2, return_inverse=True)
        goal = np.full((len(split), 2), -1)
        goal[inverse, nodes % 2] = np.arange(len(nodes))
        above, column, cut = split // (256 * BINS), split // BINS % 256, split % BINS
        self.parent, self.twin = above[inverse], goal[inverse, 1 - nodes % 2]
        start = np.cumsum(self.size) - self.size
        out, ends = np.empty(int(size.sum()), np.int64), np.append(0, np.cumsum(size))
        held, columns, width, flat = self.size[above], self.block.columns, self.block.x.shape[1], self.block.x.reshape(-1)
        for i, j in _runs(held):
            if j - i == 1:
                rows, filled = self.rows[start[above[i]] : start[above[i]] + held[i]], [ends[t] for t in goal[i].tolist()]
                for k in range(0, len(rows), RUN_ROWS):
                    part = rows[k : k + RUN_ROWS]
                    right = columns[column[i]].take(part) > cut[i]
                    for side in np.flatnonzero(goal[i] >= 0).tolist():
                        moved = part.compress(right if side else ~right)
                        out[filled[side] : filled[side] + len(moved)] = moved
                        filled[side] += len(moved)
                continue
            n = held[i:j]
            if above[j - 1] - above[i] == j - 1 - i and (np.diff(above[i:j]) == 1).all():
                rows = self.rows[start[above[i]] : start[above[i]] + n.sum()]
            else:
                at = np.arange(n.sum())
                at += np.repeat(start[above[i:j]] - (np.cumsum(n) - n), n)
                rows = self.rows.take(at)
            at = rows * width
            at += np.repeat(column[i:j], n)
            side = np.repeat(np.arange(0, 2 * (j - i), 2), n)
            side += flat.take(at) > np.repeat(cut[i:j], n)
            goals = goal[i:j].ravel()
            some = goals[goals >= 0]  # they follow one another
            order = (goals - some[0] + 1).clip(0).astype(np.uint16).take(side)
            low, high = ends[some[0]], ends[some[-1] + 1]
            out[low:high] = rows.take(order.argsort(kind="stable")[len(rows) - (high - low) :])
        self.rows, self.size, self.key = out, size, key


def _runs(size: np.ndarray, but: Iterable[int] = ()) -> Iterator[tuple[int, int]]:
    """Nodes from, to, by their rows, without nodes ``but``: small nodes together, a large one alone."""
    end, but = np.cumsum(size), sorted(but, reverse=True)
    start, i = end - size, 0
    while i < len(end):
        if but and but[-1] == i:
            i = but.pop() + 1
            continue
        j = min(max(i + 1, int(np.searchsorted(end, start[i] + RUN_ROWS, "right"))), i + RUN_NODES, *but[-1:])
        yield i, j
        i = j


def _packed_rows(b: np.ndarray) -> tuple[float | None, np.ndarray]:
    """Numbers whose sums hold both the sum of ``b`` and the rows, exact in doubles: a power of two above all of
    ``b`` added to each.  None if they would not be exact."""
    room = float(1 << int(b.sum()).bit_length())
    return (room, b + room) if (len(b) + 1) * room < 2.0**53 else (None, b)


def _unpacked_rows(sums: np.ndarray, room: float) -> tuple[np.ndarray, np.ndarray]:
    """Sums of what ``_packed_rows`` packed, and rows."""
    n = np.floor(sums * (1.0 / room))
    return sums - n * room, n


def _train_counts(spec: TreeSpec, counts: dict) -> tuple[int, int]:
    return tuple(sum(n for (fold, y), n in counts.items() if y == c and fold != (-1 if spec.fold is None else spec.fold)) for c in (0, 1))


def class_weights(spec: TreeSpec, counts: dict) -> tuple[float, float]:
    n0, n1 = _train_counts(spec, counts)
    if spec.weighting is None or not n0 or not n1:
        return 1.0, 1.0
    return (1.0, n0 / n1) if spec.weighting == "pos_scale" else ((n0 + n1) / (2.0 * n0), (n0 + n1) / (2.0 * n1))


def prior(spec: TreeSpec, counts: dict) -> float:
    n0, n1 = _train_counts(spec, counts)
    return math.log(n1 / n0) if spec.prior and n0 and n1 else 0.0


# ---- training -----------------------------------------------------------------------------------

ROW_COLUMNS = ("ids", "x", "y", "folds")
BLOCK_SCHEMA = "x binary, y binary, ids binary, folds binary, margins binary, part int"


@dataclass
class Rows:
    """Binned training rows: written blocks, their number, and rows by (fold, label)."""

    blocks: DataFrame
    number: int
    bins: Bins
    counts: dict

    @property
    def whole(self) -> bool:
        """Whether a task may hold all rows."""
        return self.number == 1 or sum(self.counts.values()) <= WHOLE_ROWS

    @property
    def share(self) -> int:
        """Rows of a block, on average."""
        return -(-sum(self.counts.values()) // self.number)

    @property
    def width(self) -> int:
        return len(self.bins.low)


def training_rows(df: DataFrame, id_col: str = "CustomerId", fold_col: str | None = None, block_rows: int = BLOCK_ROWS) -> Rows:
    """Blocks of ``df(features vector, label, id[, fold])``, written once to the shared folder."""
    spark = df.sparkSession
    ship_package(spark)
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
    rows = df.select(
        vector_to_array("features").alias("a"), F.col("label").cast("byte").alias("y"), F.col(id_col).cast("long").alias("id"), fold.alias("fold")
    ).persist()
    counts = {(r["fold"], r["y"]): r["n"] for r in rows.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    width = len(rows.first()["a"])
    bins = fit_bins(rows, F.col("a"), width)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            x = np.asarray(t.column("a").chunk(0).flatten()).reshape(-1, width)
            parts = [bins.of(x), *(t.column(c).to_numpy().astype(k) for c, k in (("y", np.int8), ("id", np.int64), ("fold", np.int32)))]
            return pa.RecordBatch.from_arrays(
                [pa.array([p.tobytes()], pa.binary()) for p in parts] + [pa.array([None], pa.binary()), pa.array([TaskContext.get().partitionId()], pa.int32())],
                ["x", "y", "ids", "folds", "margins", "part"],
            )

        n = 0
        for batch in batches:
            for k in range(0, batch.num_rows, block_rows):
                part = batch.slice(k, block_rows)
                if n + part.num_rows > block_rows and held:
                    yield block()
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield block()

    parts = max(1, -(-sum(counts.values()) // block_rows))
    if parts > 1:  # as many rows for each of the tasks that run at a time
        parts = -(-parts // _slots(spark)) * _slots(spark)
    path = scratch_path(spark, "tree-blocks")
    rows.repartition(parts).mapInArrow(cut, BLOCK_SCHEMA).write.parquet(path)
    rows.unpersist()
    blocks = spark.read.parquet(path)
    return Rows(blocks, blocks.count(), bins, counts)


def _slots(spark) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def train(rows: Rows, specs: Sequence[TreeSpec]) -> list[list[Tree]]:
    """The trees of every specification."""
    out: dict[int, list[Tree]] = {}
    for run, mine in _ways(rows, specs, False):
        out |= zip(mine, run(rows, [specs[k] for k in mine], None))
    return [out[k] for k in range(len(specs))]


def held_out(rows: Rows, specs: Sequence[TreeSpec], stops: Sequence[Sequence[Stop]]) -> list[list[list[int]]]:
    """Per specification and stop: tn, fp, fn, tp of the fold that it holds out."""
    out: dict[int, list[list[int]]] = {}
    for run, mine in _ways(rows, specs, True):
        out |= zip(mine, run(rows, [specs[k] for k in mine], [stops[k] for k in mine]))
    return [out[k] for k in range(len(specs))]


def _ways(rows: Rows, specs: Sequence[TreeSpec], judged: bool) -> Iterator[tuple]:
    """How the specifications are trained: (function, their places).  Where a task may hold all rows, models,
    or trees of forests, are dealt to tasks: a level of one boosted model then takes a task less time than a
    job takes to start.  Else boosting goes in step and forests by rounds."""
    for kind in ("boost", "forest"):
        mine = [k for k, s in enumerate(specs) if s.kind == kind]
        if not mine:
            continue
        if rows.whole:
            yield _in_tasks, mine
        elif kind == "boost":
            yield _in_step, mine
        else:
            yield (_judged_after(_by_rounds) if judged else _by_rounds), mine


def _judged_after(run):
    """Trains with ``run``, then judges each block's held-out rows."""
    return lambda rows, specs, stops: _judged(rows, specs, run(rows, specs, None), stops)


def _judged(rows: Rows, specs: Sequence[TreeSpec], trees: list[list[Tree]], stops: Sequence[Sequence[Stop]]) -> list[list[list[int]]]:
    width, counts = rows.width, rows.counts
    sent = rows.blocks.sparkSession.sparkContext.broadcast(trees)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block([row | {"margins": None}], width, counts)
                yield _result(-1, [block.confusion(s, sent.value[k], stops[k]) for k, s in enumerate(specs)])

    return _added([pickle.loads(r["model"]) for r in rows.blocks.mapInArrow(judge, RESULT_SCHEMA).collect()])


def _added(parts: list[list[list[list[int]]]]) -> list[list[list[int]]]:
    return [[np.sum(c, axis=0).tolist() for c in zip(*spec)] for spec in zip(*parts)]


RESULT_SCHEMA = "spec long, low long, model binary"


def _result(k: int, value, low: int = 0) -> pa.RecordBatch:
    """A model's part; ``low`` is the first of the rows that it is about."""
    return pa.RecordBatch.from_pydict({"spec": pa.array([k], pa.int64()), "low": pa.array([low], pa.int64()), "model": pa.array([pickle.dumps(value)], pa.binary())})


def _cost(spec: TreeSpec) -> float:
    """What a tree costs, about: levels, and in boosting also the rows' margins."""
    return (spec.depth or 30) if spec.sqrt_columns else 3 + (spec.depth or 30)


def _alone(block: Block, key, spec: TreeSpec, numbers: Iterable[int]) -> Iterator[Tree]:
    """Trees grown on one block."""
    done: list[Tree] = []
    for t in numbers:
        if spec.sqrt_columns:
            yield Grove(block, key, [spec], t).grown()[0]
            continue
        growth = Growth(block, key, spec, Tree(t), done)
        tree = growth.grown()
        if spec.kind == "boost":
            done.append(tree)
            block.margins[key] = (len(done), block.margins[key][1] + growth.values())
        yield tree
    block.margins.pop(key, None)


def _together(block: Block, key, specs: Sequence[TreeSpec], numbers: Iterable[int]) -> Iterator[list[Tree | None]]:
    """The trees of forests of one family, number by number; None where a forest has fewer."""
    for t in numbers:
        live = [k for k, s in enumerate(specs) if t < s.trees]
        trees = dict(zip(live, Grove(block, key, [specs[k] for k in live], t).grown())) if live else {}
        yield [trees.get(k) for k in range(len(specs))]


def _family(spec: TreeSpec) -> TreeSpec:
    """What forests have in common whose trees lead the same way as far as they split alike."""
    return replace(spec, trees=0, depth=None, min_leaf=1, min_split=2)


def _families(specs: Sequence[TreeSpec]) -> list[list[int]]:
    """Places of forests that draw columns, by family; the other models alone."""
    found: dict = {}
    for k, s in enumerate(specs):
        found.setdefault(_family(s) if s.kind == "forest" and s.sqrt_columns else k, []).append(k)
    return list(found.values())


def _units(specs: Sequence[TreeSpec], most: int, costs: Sequence[float] | None = None) -> list[tuple[int, int, int]]:
    """What is dealt to tasks, (model, first tree, end): boosted models, and forests in pieces of about the
    same cost, dear ones first.  ``costs`` are those of a tree."""
    costs = costs or [_cost(s) for s in specs]
    whole = sum(c * s.trees for c, s in zip(costs, specs))
    units = []
    for k, s in enumerate(specs):
        pieces = 1 if s.kind == "boost" else min(s.trees, math.ceil(costs[k] * s.trees * most / whole))
        cuts = [s.trees * i // pieces for i in range(pieces + 1)]
        units += [(k, a, b) for a, b in zip(cuts, cuts[1:])]
    return sorted(units, key=lambda u: -costs[u[0]] * (u[2] - u[1]))


def _gathered(batches: Iterator[pa.RecordBatch], width: int, counts: dict) -> tuple[int, Block | None]:
    """A task's number and all rows, in the same order in every task; the arrays are the only copy that stays."""
    held, task = [], -1
    for batch in batches:
        for row in range(batch.num_rows):
            held.append({name: batch.column(name)[row].as_buffer() for name in ROW_COLUMNS} | {"margins": None})
            task = batch.column("task")[row].as_py()
    held.sort(key=lambda r: [hashlib.blake2b(r[name]).digest() for name in ROW_COLUMNS])
    return task, Block(held, width, counts) if held else None


def _within(stops: Sequence[Stop], first: int, end: int) -> tuple[list[Stop], list[int]]:
    """The stops that differ for a forest's trees from ``first`` to ``end``, and which of them stands for each (-1: no
    tree comes before it)."""
    cut = [(min(n, end), d) if n > first else None for n, d in _pairs(stops)]
    found = list(dict.fromkeys(c for c in cut if c))
    return found, [found.index(c) if c else -1 for c in cut]


#: What a further forest of a family adds to the cost of a tree, about.
MEMBER_COST = 0.2
#: Held-out rows whose votes travel in one row.
VOTES_A_ROW = 1 << 16


def _in_tasks(rows: Rows, specs: Sequence[TreeSpec], stops: Sequence[Sequence[Stop]] | None) -> list:
    """Every task holds all rows: deal the models, or the trees of forests, to tasks.  Forests of one family grow
    together.  The votes of a forest's pieces on the rows that it holds out meet by forest and rows, not at the driver."""
    spark, width, counts = rows.blocks.sparkSession, rows.width, rows.counts
    most = (4 if sum(counts.values()) <= WHOLE_ROWS // 4 else 2) * _slots(spark)  # each holds a copy of the rows
    voting = stops is not None and specs[0].kind == "forest"
    groups = _families(specs) if voting else [[k] for k in range(len(specs))]
    longest = [replace(specs[g[0]], trees=max(specs[k].trees for k in g), depth=_deepest([specs[k].depth for k in g])) for g in groups]
    costs = [_cost(s) * (1 + MEMBER_COST * (len(g) - 1)) for s, g in zip(longest, groups)]
    units = _units(longest, most, costs)
    heap = [(0.0, i, []) for i in range(min(len(units), most))]
    for u in units:
        load, i, mine = heapq.heappop(heap)
        heapq.heappush(heap, (load + costs[u[0]] * (u[2] - u[1]), i, [*mine, u]))
    dealt = {i: mine for _, i, mine in heap}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block = _gathered(batches, width, counts)
        fold, part = None, None
        for g, a, b in sorted(dealt[task], key=lambda u: longest[u[0]].fold or 0) if block else []:
            mine = [specs[k] for k in groups[g]]
            if part is None or mine[0].fold != fold:
                part = None  # one fold's rows at a time
                fold, part = mine[0].fold, block.without(mine[0].fold)
            if voting:
                grown = _together(part, g, mine, range(a, b)) if mine[0].sqrt_columns else ([t] for t in _alone(part, g, mine[0], range(a, b)))
                asked = [_within(stops[k], a, b) for k in groups[g]]
                totals, y = block.totals_of_all(fold, grown, [found for found, _ in asked]), block.y[block.fold == fold]
                for low in range(0, max(len(y), 1), VOTES_A_ROW):
                    here = slice(low, low + VOTES_A_ROW)
                    for k, found, (_, of) in zip(groups[g], totals, asked):
                        yield _result(k, (a, found[:, here], of, y[here]), low)
            elif stops is None:
                yield _result(groups[g][0], (a, list(_alone(part, g, mine[0], range(a, b)))))
            else:
                yield _result(groups[g][0], block.confusion(mine[0], _alone(part, g, mine[0], range(a, b)), stops[groups[g][0]]))

    def vote(key, table):
        k = key[0].as_py()
        parts = sorted((pickle.loads(m.as_buffer()) for m in table.column("model")), key=lambda p: p[0])
        totals = [sum(found[of[i]] for _, found, of, _ in parts if of[i] >= 0) for i in range(len(stops[k]))]
        cells = [_confusion(specs[k], counts, parts[0][3], total, n) for total, (n, _) in zip(totals, _pairs(stops[k]))]
        return pa.table({"spec": pa.array([k], pa.int64()), "low": pa.array([key[1].as_py()], pa.int64()), "model": pa.array([pickle.dumps(cells)], pa.binary())})

    copies = rows.blocks.select(*ROW_COLUMNS).withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(len(dealt) - 1)))).repartitionById(len(dealt), F.col("task"))
    found = copies.mapInArrow(work, RESULT_SCHEMA)
    if voting:
        found = found.groupBy("spec", "low").applyInArrow(vote, RESULT_SCHEMA)
    out: list = [[] for _ in specs]
    for r in found.collect():
        out[r["spec"]].append(pickle.loads(r["model"]))
    if stops is not None:
        return [[np.sum(c, axis=0).tolist() for c in zip(*parts)] for parts in out]
    return [[t for _, trees in sorted(parts, key=lambda f: f[0]) for t in trees] for parts in out]


def _deepest(depths: Iterable[int | None]) -> int | None:
    depths = list(depths)
    return None if None in depths else max(depths)


def _packed(arrays: Sequence[np.ndarray]) -> bytes:
    """Whole numbers of several arrays."""
    v = np.concatenate([a.ravel() for a in arrays]).astype(np.int64)
    small = not len(v) or np.abs(v).max() < 1 << 31
    return (b"i" if small else b"q") + zlib.compress(v.astype(np.int32 if small else np.int64), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed[1:]), np.int32 if packed[:1] == b"i" else np.int64)


def _boosting(spec: TreeSpec, width: int) -> Generator[Request, np.ndarray, list[Tree]]:
    """Asks for full histograms of some nodes of one tree after the other."""
    done: list[Tree] = []
    for t in range(spec.trees):
        tree, parents, first = Tree(t), None, 0
        shared = _tree_columns(spec, t, width)
        while len(tree.open):
            summed = _to_sum(tree, parents, first)
            got = yield Request(replace(tree, open=tree.open[summed]), np.tile(shared, (len(summed), 1)), done)
            full = _completed(tree, parents, first, summed, got)
            best = best_splits(spec, full, np.tile(shared, (len(tree.open), 1)))
            first = len(tree.column)
            tree.grow(spec, best)
            parents = full[:, best.column >= 0]
        done = [*done, tree]
    return done


def _in_step(rows: Rows, specs: Sequence[TreeSpec], stops: Sequence[Sequence[Stop]] | None) -> list:
    """Boosting on rows that stay in memory, one short job a level of all models: each task sums the nodes
    asked for over its share of the rows; the sums of the tasks meet at the driver, which keeps those of the
    parents.  What is sent grows with tasks, nodes, columns and bins, not with rows."""
    spark, width, counts = rows.blocks.sparkSession, rows.width, rows.counts
    checkpoint_dir(spark)
    tasks = min(_slots(spark), -(-rows.number * rows.share // STEP_ROWS))

    def gather(part: Iterator) -> Iterator[dict]:
        held = list(part)
        if held:
            row = {name: b"".join(r[name] for r in held) for name in ("x", "y", "ids", "folds")} | {"margins": None}
            joint = Block([row], width, counts).joint  # found once, not in each of the jobs
            yield row | {"joint": ([replace(j, code=None) for j in joint], [j.code for j in joint])}

    data = rows.blocks.drop("margins").repartitionById(tasks, F.col("part") % tasks).rdd.mapPartitions(gather).persist(StorageLevel.MEMORY_AND_DISK)
    waiting, asked, trees = list(range(len(specs)))[::-1], {}, {}
    kept: dict[int, int] = {}  # trees in the margins of the rows in memory, by model
    refreshes, old = 0, None
    while waiting or asked:
        # Models start while the widest levels still fit one turn.
        while waiting and (not asked or sum(_widest(specs[k], width) for k in [*asked, waiting[-1]]) <= TURN_BYTES):
            k = waiting.pop()
            growing = _boosting(specs[k], width)
            asked[k] = (growing, next(growing))
        if sum(len(r.before) - kept.get(k, 0) for k, (_, r) in asked.items()) >= REFRESH * len(asked):
            news = {k: _since(r, kept.get(k, 0)) for k, (_, r) in asked.items()}
            old, data = data, data.mapPartitions(_margins_added(news, specs, width, counts)).persist(StorageLevel.MEMORY_AND_DISK)
            kept = {k: len(r.before) for k, (_, r) in asked.items()}
            refreshes += 1
            if refreshes % CHECKPOINT == 0:  # so that a lost task replays few trees
                data.checkpoint()
        news = {k: _since(r, kept.get(k, 0)) for k, (_, r) in asked.items()}
        total = sum(_unpacked(p).astype(np.float64) for p in data.mapPartitions(_full_sums(news, specs, width, counts)).collect())
        if old is not None:
            old.unpersist()
            old = None
        at = 0
        for k, (growing, r) in list(asked.items()):
            shape = (3, *r.columns.shape, BINS)
            sums = total[at : at + math.prod(shape)].reshape(shape)
            at += sums.size
            try:
                asked[k] = (growing, growing.send(sums))
            except StopIteration as end:
                trees[k] = end.value
                del asked[k]
    data.unpersist()
    found = [trees[k] for k in range(len(specs))]
    return found if stops is None else _judged(rows, specs, found, stops)


def _since(request: Request, kept: int) -> Request:
    """Trees whose sums are in the margins need not travel again."""
    return replace(request, before=[None] * kept + request.before[kept:])


def _margins_added(news: dict[int, Request], specs: Sequence[TreeSpec], width: int, counts: dict):
    def add(part: Iterator[dict]) -> Iterator[dict]:
        for row in part:
            block = Block([row], width, counts)
            stats = {k: (r.tree.number, tuple(map(_short, block.stats(k, specs[k], r)))) for k, r in news.items()}
            yield row | {"margins": pickle.dumps({k: block.margins[k] for k in news}), "stats": stats}

    return add


def _short(v: np.ndarray) -> np.ndarray:
    """Whole numbers in half the room, where they fit."""
    return v.astype(np.int32) if v.dtype == np.float64 and len(v) and np.abs(v).max() < 1 << 31 else v


def _full_sums(news: dict[int, Request], specs: Sequence[TreeSpec], width: int, counts: dict):
    def sums(part: Iterator[dict]) -> Iterator[bytes]:
        for row in part:
            out = [np.zeros((3, *r.columns.shape, BINS)) for r in news.values()]
            for block in Block([row], width, counts).strips():
                for (k, r), total in zip(news.items(), out):
                    a, b, n = block.stats(k, specs[k], r)
                    slots = np.full(len(r.tree.column), -1)
                    slots[r.tree.open] = np.arange(len(r.tree.open))
                    slot = slots.take(r.tree.route(block.x))
                    here = np.flatnonzero((slot >= 0) & n)
                    total += block.dense(here, slot.take(here), r.columns, (a.take(here), b.take(here)))
            yield _packed(out)

    return sums


def _widest(spec: TreeSpec, width: int) -> int:
    return 2 ** max((spec.depth or 10) - 2, 0) * width * BINS * 3 * 4


def _summing(sent, flat: list[tuple[int, int]], specs: Sequence[TreeSpec], width: int, counts: dict):
    """A task's sums for every request, over its blocks, ``NODES_A_ROW`` nodes a row.

    The task holds its blocks, a file split, and one request's sums at a time, so what it sends does not
    grow with its blocks."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [row for batch in batches for row in batch.to_pylist()]
        block = Block(held, width, counts) if held else None
        for at, (k, i) in enumerate(flat if held else []):
            request = sent.value[k][i]
            nodes, columns = request.columns.shape
            cells, found = block.histogram(k, specs[k], request)
            step = NODES_A_ROW * columns * BINS
            for part in range(0, nodes, NODES_A_ROW):
                low, high = np.searchsorted(cells, (part // NODES_A_ROW * step, (part // NODES_A_ROW + 1) * step))
                yield pa.RecordBatch.from_pydict({
                    "at": pa.array([at], pa.int64()), "part": pa.array([part], pa.int64()),
                    "cells": pa.array([(cells[low:high] - part // NODES_A_ROW * step).astype(np.int32).tobytes()], pa.binary()),
                    "sums": pa.array([found[low:high].tobytes()], pa.binary()),
                })

    return sums


def _deciding(sent, flat: list[tuple[int, int]], specs: Sequence[TreeSpec]):
    """Best splits of the nodes of one row, from the sums of all tasks."""

    def best(key, table):
        at, part = key[0].as_py(), key[1].as_py()
        k, i = flat[at]
        columns = sent.value[k][i][part : part + NODES_A_ROW]
        hist = np.zeros((columns.size * BINS, 3))
        for c, v in zip(table.column("cells"), table.column("sums")):
            hist[np.frombuffer(c.as_buffer(), np.int32)] += np.frombuffer(v.as_buffer(), np.float64).reshape(-1, 3)
        cells = np.flatnonzero(hist[:, 2])
        found = best_of_cells(specs[k], cells, hist[cells], columns)
        return pa.table({"at": [at], "part": [part], "best": [pickle.dumps(found)]})

    return best


def _by_rounds(rows: Rows, specs: Sequence[TreeSpec], _stops=None) -> list[list[Tree]]:
    """Forests, one job a level of all trees: every task's sums, added and decided by (model, tree, nodes)."""
    spark, width, counts = rows.blocks.sparkSession, rows.width, rows.counts
    growing = {k: grow(s, width) for k, s in enumerate(specs)}
    asked, done = {k: next(g) for k, g in growing.items()}, {}

    while asked:
        flat = [(k, i) for k in asked for i in range(len(asked[k]))]
        sent = spark.sparkContext.broadcast(asked)
        columns = spark.sparkContext.broadcast({k: [r.columns for r in rs] for k, rs in asked.items()})

        sums = rows.blocks.mapInArrow(_summing(sent, flat, specs, width, counts), "at long, part long, cells binary, sums binary")
        rows_out = sums.groupBy("at", "part").applyInArrow(_deciding(columns, flat, specs), "at long, part long, best binary").collect()
        sent.destroy()
        columns.destroy()
        parts: dict[int, list] = {}
        for r in sorted(rows_out, key=lambda r: (r["at"], r["part"])):
            parts.setdefault(r["at"], []).append(pickle.loads(r["best"]))
        answers: dict[int, list[Best]] = {}
        for at, (k, _) in enumerate(flat):
            answers.setdefault(k, []).append(Best(*(np.concatenate([getattr(p, f) for p in parts[at]]) for f in ("total", "column", "cut", "gain", "left"))))
        for k in list(asked):
            try:
                asked[k] = growing[k].send(answers[k])
            except StopIteration as end:
                done[k] = end.value
                del asked[k]
    return [done[k] for k in range(len(specs))]


# ---- models -------------------------------------------------------------------------------------


@dataclass
class TreeModel:
    spec: TreeSpec
    bins: Bins
    trees: list[Tree]
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """P(1) of rows of raw columns."""
        x = self.bins.of(x)
        total = np.zeros(len(x))
        for t in self.trees:
            total = total + t.values(x)
        return total / len(self.trees) if self.spec.kind == "forest" else 1.0 / (1.0 + np.exp(-(total + self.base)))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``score`` = P(1) and ``prediction`` (1 where it exceeds one half)."""
        sent = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def score(a: pd.Series) -> pd.Series:
            return pd.Series(sent.value.score(np.stack(a.to_list())) if len(a) else [], dtype="float64")

        return df.withColumn("score", score(vector_to_array("features"))).withColumn("prediction", (F.col("score") > 0.5).cast("double"))

    def nodes(self) -> list[tuple]:
        """(tree, node, column, cut, gain, value) of every node; column -1 marks a leaf."""
        return [(t.number, i, *node) for t in self.trees for i, node in enumerate(zip(*(v.tolist() for v in (t.column, t.cut, t.gain, t.value))))]


def fit(df: DataFrame, specs: Sequence[TreeSpec], id_col: str = "CustomerId", block_rows: int = BLOCK_ROWS) -> list[TreeModel]:
    """Models of several specifications on ``df(features, label, id)``, trained together."""
    rows = training_rows(df, id_col, block_rows=block_rows)
    return [TreeModel(s, rows.bins, t, prior(s, rows.counts)) for s, t in zip(specs, train(rows, specs))]


def cross_validate(rows: Rows, specs: Sequence[TreeSpec], folds: int) -> list[list[list[int]]]:
    """Per specification and fold: tn, fp, fn, tp of the held-out rows.  Specifications that differ in the
    number of trees alone share their trees, and so do forests that differ in number and depth: a tree of
    less depth is the deeper tree, cut.  So do those whose ``min_split`` differs below two leaves."""
    stops: dict[TreeSpec, set[Stop]] = {}
    for s in specs:
        stops.setdefault(_shared(s), set()).add((s.trees, s.depth))
    runs = [(replace(s, trees=max(n for n, _ in found), depth=_deepest(d for _, d in found), fold=k), list(found)) for s, found in stops.items() for k in range(folds)]
    found = held_out(rows, [s for s, _ in runs], [n for _, n in runs])
    cells = {(replace(_shared(s), fold=None), stop, s.fold): c for (s, ns), cs in zip(runs, found) for stop, c in zip(ns, cs)}
    return [[cells[_shared(s), (s.trees, s.depth), k] for k in range(folds)] for s in specs]


def _shared(spec: TreeSpec) -> TreeSpec:
    """What the specifications that share trees have in common.  A node of fewer rows than two leaves never
    splits, so a smaller ``min_split`` asks for nothing."""
    return replace(spec, trees=0, depth=None if spec.kind == "forest" else spec.depth, min_split=max(spec.min_split, 2 * spec.min_leaf))


def paths(tree: Tree) -> list[str]:
    """How each node is reached from the root: L and R by step."""
    out = [""] * len(tree.column)
    for i, (c, left, right) in enumerate(zip(tree.column.tolist(), tree.left.tolist(), tree.right.tolist())):
        if c >= 0:
            out[left], out[right] = out[i] + "L", out[i] + "R"
    return out

"""The ways in which trees are trained agree, and tables of several blocks do not take a job a level of every model."""

import random
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import Vectors

from churnlens.operators import trees as T


def _rows(spark, block_rows):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        x = [rng.gauss(0, 1), rng.uniform(0, 5), float(rng.randint(0, 1))]
        rows.append((i * 13 + 5, Vectors.dense(x), float(x[0] * x[0] + x[2] + rng.gauss(0, 0.5) > 1.2), i % 3))
    df = spark.createDataFrame(rows, ["CustomerId", "features", "label", "fold"]).repartition(3)
    return T.training_rows(df, fold_col="fold", block_rows=block_rows)


def _nodes(rows, models):
    return [T.TreeModel(None, rows.bins, trees, 0.0).nodes() for trees in models]


def test_boosting_in_step_and_forests_by_rounds_equal_training_in_tasks(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_ROWS", 120)
    monkeypatch.setattr(T, "REFRESH", 2)
    rows = _rows(spark, 120)
    assert rows.number > 1
    boost = [
        T.TreeSpec("boost", 5, 3, rate=0.3, l2=1.0, subsample=0.8, columns=0.7, weighting="pos_scale", fold=0),
        T.TreeSpec("boost", 3, 5, rate=0.2, second_order=False, prior=True, min_leaf=3, fold=1),
    ]
    forest = [T.TreeSpec("forest", 4, None, sqrt_columns=True, bootstrap=True, weighting="balanced", min_leaf=2, fold=2)]
    for specs, spread, stops in ((boost, T._in_step, [[2, 5], [3]]), (forest, T._judged_after(T._by_rounds), [[1, 4]])):
        assert T._in_tasks(rows, specs, stops) == spread(rows, specs, stops)
    assert _nodes(rows, T._in_tasks(rows, boost, None)) == _nodes(rows, T._in_step(rows, boost, None))
    assert _nodes(rows, T._in_tasks(rows, forest, None)) == _nodes(rows, T._by_rounds(rows, forest, None))


def test_a_grid_over_several_blocks_takes_few_jobs(spark):
    rows = _rows(spark, 120)
    grid = [T.TreeSpec("boost", 6, 2, rate=r, prior=True) for r in (0.1, 0.2, 0.3)]
    spark.sparkContext.setJobGroup("grid", "grid")
    found = T.held_out(rows, [replace(s, fold=k) for s in grid for k in range(3)], [[3, 6]] * 9)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("grid"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert all(sum(c) == 200 for cells in found for c in cells)
    assert 0 < jobs <= 6  # one job a level of every tree would be 12 at least


def test_forests_of_several_depths_share_their_trees(spark, monkeypatch):
    rows = _rows(spark, 120)
    common = {"sqrt_columns": True, "bootstrap": True, "min_leaf": 2, "weighting": "balanced"}
    specs = [T.TreeSpec("forest", n, d, **common) for n in (3, 5) for d in (2, 4, None)]
    asked = []
    monkeypatch.setattr(T, "held_out", lambda rows, specs, stops, run=T.held_out: asked.extend(specs) or run(rows, specs, stops))
    found = T.cross_validate(rows, specs, 3)
    assert [(s.trees, s.depth, s.fold) for s in asked] == [(5, None, k) for k in range(3)]  # 5 trees a fold, not 15
    block = T.Block([r.asDict() | {"margins": None} for r in rows.blocks.collect()], rows.width, rows.counts)
    for spec, cells in zip(specs, found):
        for k in range(3):
            one = replace(spec, fold=k)
            assert cells[k] == block.confusion(one, T._alone(block, 0, one, range(one.trees)), [one.trees])[0]


def test_forests_whose_least_split_is_moot_share_their_trees(spark, monkeypatch):
    """a node of fewer rows than two leaves never splits, so such trials grow one forest."""
    rows = _rows(spark, 120)
    common = {"sqrt_columns": True, "bootstrap": True, "min_leaf": 4, "weighting": "balanced"}
    specs = [T.TreeSpec("forest", 3, d, min_split=m, **common) for m, d in ((2, 6), (5, 3), (8, 6), (9, 6), (30, 6))]
    asked = []
    monkeypatch.setattr(T, "held_out", lambda rows, specs, stops, run=T.held_out: asked.extend(specs) or run(rows, specs, stops))
    found = T.cross_validate(rows, specs, 3)
    assert sorted((s.min_split, s.fold) for s in asked) == [(m, k) for m in (8, 9, 30) for k in range(3)]
    block = T.Block([r.asDict() | {"margins": None} for r in rows.blocks.collect()], rows.width, rows.counts)
    for spec, cells in zip(specs, found):
        for k in range(3):
            one = replace(spec, fold=k)
            assert cells[k] == block.confusion(one, T._alone(block, 0, one, range(one.trees)), [one.trees])[0]


def test_forests_are_dealt_in_pieces_of_like_cost():
    specs = [T.TreeSpec("forest", 300, 20, sqrt_columns=True), T.TreeSpec("forest", 50, 3, sqrt_columns=True), T.TreeSpec("boost", 9, 3)]
    units = T._units(specs, 32)
    assert sorted(u for u in units if u[0] == 2) == [(2, 0, 9)]
    assert [t for u in sorted(units) if u[0] == 0 for t in range(*u[1:])] == list(range(300))
    assert max(20 * (b - a) for k, a, b in units if k == 0) < 300 * 20 / 16


def test_boosting_decides_on_the_bins_that_occur_and_on_columns_that_say_something_new(spark):
    """a level costs what its cells hold, and the splits are those of the full histogram."""
    rng = np.random.default_rng(5)
    n = 3000
    age, flag, other = rng.integers(0, 60, n), rng.integers(0, 2, n), rng.integers(0, 64, n)
    x = np.stack([age, age // 2, flag * 50, 50 - flag * 50, other, rng.integers(0, 4, n) * 9], axis=1).astype(np.uint8)
    y = (rng.random(n) < 0.2 + 0.4 * (age > 30) * flag).astype(np.int8)
    row = {"x": x.tobytes(), "y": y.tobytes(), "ids": np.arange(n).tobytes(), "folds": np.zeros(n, np.int32).tobytes(), "margins": None}
    block = T.Block([row], 6, {(0, 0): int((y == 0).sum()), (0, 1): int(y.sum())})
    cells = block.cells(np.arange(6))
    assert set(cells.column.tolist()) == {0, 2, 4, 5}  # halved ages and the flag's complement cut nothing more
    assert set(block.cells(np.array([1, 3, 4])).column.tolist()) == {1, 3, 4}
    assert len(cells.column) < 6 * T.BINS / 2
    slot, rows = rng.integers(0, 5, n), np.arange(n)
    stats = [np.rint(rng.normal(size=n) * T.SCALE), np.rint(rng.random(n) * T.SCALE)]
    columns = np.tile(np.arange(6), (5, 1))
    hist = np.zeros((3, 5, 6, T.BINS))
    for c in range(6):
        for k, v in enumerate((*stats, np.ones(n))):
            np.add.at(hist[k], (slot, c, x[:, c]), v)
    specs = [T.TreeSpec("boost", 1, 4, **more) for more in (
        {"l2": 1.0, "min_child": 2.0}, {"l2": 0.0}, {"l2": 0.5, "l1": 3.0, "gamma": 0.1}, {"second_order": False, "min_leaf": 40},
    )]
    for spec in [*specs, T.TreeSpec("forest", 1, 4, impurity="entropy")]:
        want, got = T.best_splits(spec, hist, columns), T.best_of_held(spec, block.summed(rows, slot, 5, cells, stats), cells)
        split = want.column >= 0
        assert split.any() or spec.kind == "forest"
        for name in ("total", "column", "gain"):
            assert np.array_equal(getattr(want, name), getattr(got, name)), name
        assert np.array_equal(want.cut[split], got.cut[split]) and np.array_equal(want.left[split], got.left[split])


def test_boosting_in_step_finds_joint_columns_and_statistics_once(spark, monkeypatch):
    """F7 to F10, F13, F15, F17: below its root, a tree's level sums what the rows keep."""
    rng = np.random.default_rng(6)
    n = 400
    x, y = rng.integers(0, 20, (n, 3)).astype(np.uint8), rng.integers(0, 2, n).astype(np.int8)
    counts = {(0, 0): int((y == 0).sum()), (0, 1): int(y.sum())}
    row = {"x": x.tobytes(), "y": y.tobytes(), "ids": np.arange(n).tobytes(), "folds": np.zeros(n, np.int32).tobytes(), "margins": None}
    spec = T.TreeSpec("boost", 2, 2, rate=0.3, l2=1.0, subsample=0.8, weighting="pos_scale")
    block = T.Block([row], 3, counts)
    first = next(T._alone(block, 0, spec, [0]))
    row["joint"] = ([replace(j, code=None) for j in block.joint], [j.code for j in block.joint])
    request = T.Request(T.Tree(1), np.arange(3)[None], [first])
    plain = T.Block([row], 3, counts).stats(0, spec, request)
    kept = next(T._margins_added({0: request}, [spec], 3, counts)(iter([row])))
    monkeypatch.setattr(T, "joint_columns", None)
    monkeypatch.setattr(T, "uniform", None)  # neither is called again
    monkeypatch.setattr(T, "STRIP", 150)
    parts = [b.stats(0, spec, request) for b in T.Block([kept], 3, counts).strips()]
    assert len(parts) == 3
    for k, v in enumerate(plain):
        assert np.array_equal(np.concatenate([p[k] for p in parts]), v)
    sums = T._unpacked(next(T._full_sums({0: request}, [spec], 3, counts)(iter([kept]))))
    assert sums.reshape(3, 3, T.BINS)[:, 0].sum(axis=1).tolist() == [plain[0].sum(), plain[1].sum(), plain[2].sum()]


def test_boosting_over_some_million_rows_is_dealt_to_tasks():
    """4,320,000 rows are held by a task, so no level of a model is a job; what a task holds is one copy."""
    bins = T.Bins([0.0] * 17, [1.0] * 17, np.zeros((17, T.CELLS), np.uint8))
    rows = T.Rows(None, 88, bins, {(f, y): n for f in range(3) for y, n in ((0, 1_156_680), (1, 283_320))})
    assert sum(rows.counts.values()) == 4_320_000
    specs = [T.TreeSpec("boost", 200, 7, fold=k) for k in range(3)] + [T.TreeSpec("forest", 200, None, fold=0)]
    assert [run for run, _ in T._ways(rows, specs, True)] == [T._in_tasks, T._in_tasks]


def test_a_task_gathers_the_same_rows_in_the_same_order():
    """however the blocks come in, every task has them alike, and keeps no other copy."""
    rng = np.random.default_rng(2)
    held = []
    for k in range(5):
        n = 40 + k
        held.append({
            "ids": rng.integers(0, 10**6, n).tobytes(), "x": rng.integers(0, 64, (n, 3)).astype(np.uint8).tobytes(),
            "y": rng.integers(0, 2, n).astype(np.int8).tobytes(), "folds": (np.arange(n) % 3).astype(np.int32).tobytes(), "task": 7,
        })

    def batch(rows):
        return pa.RecordBatch.from_pylist(rows, pa.schema([(c, pa.binary()) for c in T.ROW_COLUMNS] + [("task", pa.int32())]))

    task, one = T._gathered(iter([batch(held)]), 3, {})
    again, other = T._gathered(iter([batch(held[3:]), batch(held[2::-1])]), 3, {})
    assert task == again == 7 and len(one.y) == sum(range(40, 45))
    for name in ("x", "y", "ids", "fold"):
        assert np.array_equal(getattr(one, name), getattr(other, name))
    assert T._gathered(iter([]), 3, {}) == (-1, None)


def test_rows_by_node_grow_the_trees_of_full_histograms(monkeypatch):
    """F1 to F6: short runs of rows, large nodes from their parent, and bins that occur give one and the same tree."""
    rng = np.random.default_rng(9)
    n = 6000
    x = rng.integers(0, 40, (n, 5)).astype(np.uint8)
    x[:, 1] = x[:, 0] // 2
    x[:, 3] %= 2
    y = (rng.random(n) < 0.15 + 0.5 * (x[:, 0] > 25) * x[:, 3]).astype(np.int8)
    row = {"x": x.tobytes(), "y": y.tobytes(), "ids": np.arange(n).tobytes(), "folds": np.zeros(n, np.int32).tobytes(), "margins": None}
    block = T.Block([row], 5, {(0, 0): int((y == 0).sum()), (0, 1): int(y.sum())})

    def plain(spec):
        """Each level from the full histograms of all rows."""
        growing = T.grow(spec, 5)
        asked = next(growing)
        try:
            while True:
                hists = []
                for r in asked:
                    cells, sums = block.histogram("plain", spec, r)
                    hist = np.zeros((3, r.columns.size * T.BINS))
                    hist[:, cells] = sums.T
                    hists.append(T.best_splits(spec, hist.reshape(3, *r.columns.shape, T.BINS), r.columns))
                asked = growing.send(hists)
        except StopIteration as end:
            return end.value

    specs = [
        T.TreeSpec("forest", 2, None, sqrt_columns=True, bootstrap=True, impurity="entropy", weighting="balanced", min_leaf=2),
        T.TreeSpec("forest", 2, 6, sqrt_columns=True, min_split=30),
        T.TreeSpec("forest", 1, 6, min_leaf=4, weighting="balanced"),
        T.TreeSpec("boost", 3, 5, rate=0.3, l2=1.0, subsample=0.8, columns=0.7, weighting="pos_scale"),
    ]
    nodes = lambda trees: T.TreeModel(None, None, trees, 0.0).nodes()
    for run, few in ((1 << 15, 100), (700, 5), (64, 1), (200, 0)):
        monkeypatch.setattr(T, "RUN_ROWS", run)
        monkeypatch.setattr(T, "FEW_ROWS", few)
        monkeypatch.setattr(T, "RUN_CELLS", run)
        for spec in specs:
            block.margins.clear()
            want = nodes(plain(spec))
            block.margins.clear()
            assert nodes(list(T._alone(block, 0, spec, range(spec.trees)))) == want, (run, spec)


def test_forests_of_one_family_sum_a_node_once(monkeypatch):
    """forests that differ in least leaf, least split and depth share the nodes that they split alike, and
    each of their trees is the one that it grows alone."""
    rng = np.random.default_rng(4)
    n = 5000
    x = rng.integers(0, 50, (n, 6)).astype(np.uint8)
    y = (rng.random(n) < 0.2 + 0.4 * (x[:, 0] > 25) * (x[:, 1] > 10)).astype(np.int8)
    row = {"x": x.tobytes(), "y": y.tobytes(), "ids": np.arange(n).tobytes(), "folds": (np.arange(n) % 3).astype(np.int32).tobytes(), "margins": None}
    counts = {(f, c): int(((np.arange(n) % 3 == f) & (y == c)).sum()) for f in range(3) for c in (0, 1)}
    block = T.Block([row], 6, counts)
    common = {"sqrt_columns": True, "bootstrap": True, "weighting": "balanced", "fold": 1}
    specs = [T.TreeSpec("forest", t, d, min_leaf=m, min_split=q, **common) for t, d, m, q in ((3, None, 1, 2), (2, 9, 1, 6), (3, 5, 4, 8), (1, None, 7, 30))]
    part, summed = block.without(1), []
    monkeypatch.setattr(T.Grove, "_cells", lambda self, rows, *more, run=T.Grove._cells: summed.append(len(rows)) or run(self, rows, *more))
    alone = [list(T._alone(part, 0, s, range(s.trees))) for s in specs]
    apart, summed[:] = sum(summed), []
    together = list(T._together(part, 0, specs, range(3)))
    assert sum(summed) < 0.6 * apart
    nodes = lambda trees: T.TreeModel(None, None, trees, 0.0).nodes()
    for k, trees in enumerate(alone):
        assert nodes(trees) == nodes([found[k] for found in together if found[k] is not None])
    votes = block.totals_of_all(1, together, [[2, 3], [(2, 4)], [3], [1]])
    assert np.array_equal(votes[0][1], block.totals(specs[0], alone[0], [3])[0])
    assert np.array_equal(votes[1][0], block.totals(specs[1], alone[1], [(2, 4)])[0])


def test_votes_of_a_forest_meet_by_rows(spark, monkeypatch):
    """no task and no group holds the votes of all held-out rows of a forest's pieces."""
    rows = _rows(spark, 120)
    specs = [T.TreeSpec("forest", 6, d, sqrt_columns=True, bootstrap=True, min_leaf=m, fold=k) for d, m in ((4, 1), (6, 3)) for k in range(3)]
    whole = T._in_tasks(rows, specs, [[3, 6]] * 6)
    monkeypatch.setattr(T, "VOTES_A_ROW", 70)
    assert T._in_tasks(rows, specs, [[3, 6]] * 6) == whole
    assert all(sum(c) == 200 for cells in whole for c in cells)


def test_a_piece_of_a_forest_sends_the_votes_of_stops_that_differ():
    """stops beyond a piece's trees share its votes; those before it need none."""
    stops = [(n, d) for n in (100, 200) for d in (10, None)]
    assert T._within(stops, 0, 20) == ([(20, 10), (20, None)], [0, 1, 0, 1])
    assert T._within(stops, 120, 140) == ([(140, 10), (140, None)], [-1, -1, 0, 1])
    assert T._within(stops, 90, 110) == ([(100, 10), (100, None), (110, 10), (110, None)], [0, 1, 2, 3])

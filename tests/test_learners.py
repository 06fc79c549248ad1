"""Trees and linear learners against brute force, MLlib and a kernel solver; registered fits on small data."""

import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from churnlens.operators import linear as L
from churnlens.operators import models as ML
from churnlens.operators import search as S
from churnlens.operators import trees as T

import __spark_entry__ as entry
from conftest import SF_SMALL


def _points(n, seed=4):
    rng = random.Random(seed)
    xs, ys = [], []
    for _ in range(n):
        x = [rng.gauss(0, 1), rng.uniform(0, 5), float(rng.randint(0, 1)), float(rng.randint(0, 9))]
        xs.append(x)
        ys.append(int(x[0] * x[0] + 0.3 * x[3] * x[2] + rng.gauss(0, 0.5) > 1.2))
    return np.array(xs), np.array(ys)


def _frame(spark, xs, ys, parts=3):
    rows = [(int(i * 13 + 5), Vectors.dense(x), float(y)) for i, (x, y) in enumerate(zip(xs.tolist(), ys.tolist()))]
    return spark.createDataFrame(rows, ["CustomerId", "features", "label"]).repartition(parts)


def test_trees_do_not_depend_on_blocks(spark):
    df = _frame(spark, *_points(700))
    specs = [
        T.TreeSpec("boost", 18, 1, rate=0.3, l2=1.0, subsample=0.8, columns=0.6, weighting="pos_scale"),  # past a refresh
        T.TreeSpec("boost", 3, 3, rate=0.2, second_order=False, prior=True, min_leaf=3),
        T.TreeSpec("forest", 5, None, sqrt_columns=True, bootstrap=True, impurity="entropy", weighting="balanced", min_leaf=2),
    ]
    whole, cut = T.fit(df, specs), T.fit(df.repartition(7), specs, block_rows=150)
    for a, b in zip(whole, cut):
        assert a.nodes() == b.nodes() and a.base == b.base
    assert len(whole[0].trees) == 18 and max(whole[2].trees[0].depth) > 4


def _slow_boost(x, y, spec):
    """Trees by trying every column and bin of every node, depth first."""
    weight = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0)
    margin, out = np.zeros(len(y)), []

    def soft(v):
        return math.copysign(max(abs(v) - spec.l1, 0.0), v)

    for _ in range(spec.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint(weight * (p - y) * T.SCALE), np.rint(weight * p * (1 - p) * T.SCALE)
        nodes, step = {}, np.zeros(len(y))

        def part(r):
            a, b = g[r].sum() / T.SCALE, h[r].sum() / T.SCALE  # noqa: B023
            return soft(a) ** 2 / (b + spec.l2), b

        def visit(path, rows):
            value = -spec.rate * soft(g[rows].sum() / T.SCALE) / (h[rows].sum() / T.SCALE + spec.l2)  # noqa: B023
            best = None
            if len(path) < spec.depth and (not path or len(rows) >= max(spec.min_split, 2 * spec.min_leaf)):
                for c in range(x.shape[1]):
                    for cut in sorted(set(x[rows, c].tolist()))[:-1]:
                        low = x[rows, c] <= cut
                        (s, b), (t, d) = part(rows[low]), part(rows[~low])
                        if min(b, d) < spec.min_child or min(low.sum(), (~low).sum()) < spec.min_leaf:
                            continue
                        gain = s + t - part(rows)[0]
                        if gain > T.MIN_GAIN and gain >= spec.gamma and (best is None or gain > best[0] + 1e-9):
                            best = (gain, c, cut)
            nodes[path] = (best and best[1], best and int(best[2]), round(value, 9))  # noqa: B023
            if best is None:
                step[rows] = value  # noqa: B023
                return
            low = x[rows, best[1]] <= best[2]
            visit(path + "L", rows[low])
            visit(path + "R", rows[~low])

        visit("", np.arange(len(y)))
        out.append(nodes)
        margin = margin + step
    return out


def test_boosting_equals_brute_force(spark):
    xs, ys = _points(500)
    spec = T.TreeSpec("boost", 4, 3, rate=0.3, l2=1.5, l1=0.4, gamma=0.1, min_child=2.0, min_leaf=4, weighting="pos_scale")
    model = T.fit(_frame(spark, xs, ys), [spec])[0]
    want = _slow_boost(model.bins.of(xs), ys, spec)
    for tree, nodes in zip(model.trees, want):
        got = {p: (c if c >= 0 else None, cut if c >= 0 else None, round(v, 9)) for p, c, cut, v in zip(T.paths(tree), tree.column, tree.cut, tree.value)}
        assert got == nodes
    assert model.bins.of(np.full((1, 4), np.nan)).shape == (1, 4)


def test_forest_draws_and_limits(spark):
    xs, ys = _points(600)
    spec = T.TreeSpec("forest", 30, None, sqrt_columns=True, bootstrap=True, min_split=40, min_leaf=10)
    model = T.fit(_frame(spark, xs, ys), [spec])[0]
    assert len({tuple(t.column) for t in model.trees}) > 20
    x = model.bins.of(xs)
    for t in model.trees:
        draws = np.searchsorted(T._POISSON, T.uniform(np.arange(600) * 13 + 5, spec.seed, t.number), side="right")
        assert 480 < draws.sum() < 720
        inside = t.route(x)[draws > 0]
        for leaf in set(inside.tolist()):
            assert t.column[leaf] == -1 and (inside == leaf).sum() >= 10
    p = model.score(xs)
    assert ((p > 0.5) == ys).mean() > 0.85


def test_logistic_newton_agrees_with_mllib(spark):
    df = _frame(spark, *_points(400))
    for c, name in ((1.0, "logreg_baseline"), (0.1, "logreg_l2")):
        ours, theirs = L.fit(df, [L.LinearSpec("log", c, "balanced")])[0], ML.fit(name, df)
        assert np.abs(ours.coefficients[:-1] - theirs.coefficients.toArray()).max() < 1e-3
        assert abs(ours.coefficients[-1] - theirs.intercept) < 1e-3 and ours.rounds < 12


def _kernel_solver(k, y, c):
    """Squared hinge on the whole kernel matrix: Newton in the dual coefficients, by the active set."""
    n, s = len(y), 2.0 * y - 1.0
    a, b = np.zeros(n), 0.0
    for _ in range(100):
        on = np.flatnonzero(s * (k @ a + b) < 1)
        left = np.block([[k[np.ix_(on, on)] + np.eye(len(on)) / (2 * c), np.ones((len(on), 1))], [np.ones((1, len(on))), np.zeros((1, 1))]])
        solved = np.linalg.solve(left, np.append(s[on], 0.0))
        new = np.zeros(n)
        new[on], b = solved[:-1], solved[-1]
        if np.abs(new - a).max() < 1e-12:
            break
        a = new
    return k @ a + b


@pytest.mark.parametrize("kernel", ["rbf", "poly"])
def test_kernel_machine_equals_a_kernel_solver(spark, kernel):
    xs, ys = _points(500)
    xs = (xs - xs.mean(0)) / xs.std(0)
    spec = L.LinearSpec("hinge", 1.0, None, kernel, "scale")
    model = L.fit(_frame(spark, xs, ys), [spec], landmarks=500)[0]
    gamma = 1.0 / (xs.shape[1] * xs.var())
    want = _kernel_solver(L.kernel_matrix(kernel, gamma, xs, xs), ys, 1.0)
    got = model.margin(xs)
    assert np.corrcoef(got, want)[0, 1] > 0.9999 and ((got > 0) == (want > 0)).mean() > 0.995


def test_kernel_machine_beats_the_linear_one(spark):
    df = _frame(spark, *_points(500))
    models = L.fit(df, [L.LinearSpec("hinge", 1.0, "balanced", k) for k in ("linear", "rbf")])
    linear, kernel = (S.metrics(m.transform(df.withColumn("split", F.lit("train")))).first()["roc_auc_prob"] for m in models)
    assert kernel > linear + 0.05


def _prod(spark):
    from churnlens.plans import q_models

    return q_models._prod_frame(spark, SF_SMALL)[1].persist()


def test_every_named_learner_fits_and_votes(spark):
    feats = _prod(spark)
    specs = [replace(s, trees=min(s.trees, 6)) if isinstance(s, T.TreeSpec) else s for s in S.NAMED.values()]
    models = S.fit(feats.where("split = 'train'"), specs)
    for m in [*models, None]:
        out = m.transform(feats) if m else S.soft_voting([models[0], models[2], models[4]], feats)
        r = {x["split"]: x for x in S.metrics(out).collect()}
        assert r["train"]["n"] + r["test"]["n"] == feats.count() and r["train"]["roc_auc_prob"] > 0.7
    assert out.columns == [*feats.columns, "score", "prediction"]
    feats.unpersist()


@pytest.mark.parametrize("name, rows", [("gbt_baseline", 12 + 17), ("linear_svm", 12 + 18), ("score_raw", 150), ("kfold_score", 6), ("model_bakeoff", 9)])
def test_model_queries_return_values(spark, name, rows):
    df = entry.queries()[name](spark, SF_SMALL)
    found = df.collect()
    assert len(found) == rows
    if name == "score_raw":
        assert all((r["prediction"] == "Will Churn") == (r["churn_probability"] > 0.5) for r in found)
        assert all((r["risk_category"] == "High") == (r["churn_probability"] >= 0.7) for r in found)
    if name == "gbt_baseline":
        assert abs(sum(r["value"] for r in found if r["part"] == "importance") - 1) < 1e-4


def test_hinge_sums_leave_out_rows_that_add_nothing(monkeypatch):
    """the sums are those of all rows, from the rows inside the margin that have weight alone."""
    rng = np.random.default_rng(3)
    z, y, w = np.hstack([rng.normal(size=(400, 6)), np.ones((400, 1))]), rng.integers(0, 2, 400).astype(float), rng.integers(0, 3, 400) * 0.7
    b, spec = rng.normal(size=7), L.LinearSpec("hinge", 1.0, "balanced")
    s = 2 * y - 1
    short = np.maximum(0.0, 1.0 - s * (z @ b))
    want = np.concatenate([[w @ short**2], z.T @ (-2 * w * s * short), ((z * (2 * w * (short > 0))[:, None]).T @ z).ravel()])
    kept, before = [], z.copy()
    monkeypatch.setattr(L.np, "sqrt", lambda v, run=np.sqrt: kept.append(len(v)) or run(v))
    got = L.sums(spec, b, z, y, w)
    assert np.allclose(got, want, rtol=1e-12, atol=1e-12) and np.array_equal(z, before)
    assert kept == [int(((short > 0) & (w > 0)).sum())] and kept[0] < 300


@pytest.mark.parametrize("kernel", ["rbf", "poly", "sigmoid"])
def test_kernel_matrix_by_hand(kernel):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(5, 3)), rng.normal(size=(4, 3))
    by_hand = {"rbf": lambda p, q: math.exp(-0.3 * ((p - q) ** 2).sum()), "poly": lambda p, q: (0.3 * p @ q) ** 3, "sigmoid": lambda p, q: math.tanh(0.3 * p @ q)}
    assert np.allclose(L.kernel_matrix(kernel, 0.3, a, b), [[by_hand[kernel](p, q) for q in b] for p in a], rtol=1e-12, atol=1e-15)

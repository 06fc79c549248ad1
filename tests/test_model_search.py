"""Searches: samplers, cross-validation against fits by hand, studies and grids on small frames."""

import random
import statistics

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from churnlens.operators import linear as L
from churnlens.operators import models as ML
from churnlens.operators import search as S
from churnlens.operators import trees as T


def _inside(space, family, drawn):
    return all(drawn[k] in v if isinstance(v, list) else v[0] <= drawn[k] <= v[1] for k, v in space[family].items())


@pytest.mark.parametrize("space", [S.ACCURACY_SPACE, S.F1_SPACE])
def test_trials_are_seeded_and_inside_the_space(space):
    def draws():
        sampler = S.ParzenSampler(space, seed=5, startup=4)
        return S.run_study(sampler, lambda asked: [len(str(p)) % 7 / 7 for _, p in asked], 40, 6)

    trials = draws()
    assert trials == draws() and len(trials) == 40
    assert {t.family for t in trials} == set(space) and all(_inside(space, t.family, t.params) for t in trials)
    rng = random.Random(1)
    assert all(_inside(space, *S.draw_random(space, rng)) for _ in range(200))
    assert all(S.spec_of(t.family, t.params) for t in trials)


SURFACE = {
    "a": {"x": (1e-4, 1.0, "log"), "k": (1, 40, "int"), "c": ["p", "q", "r"]},
    "b": {"x": (0.0, 10.0, "float")},
}


def _surface(family, p):
    """Best at family a, x = 0.01, k = 30, c = q."""
    if family == "b":
        return -30.0 - p["x"]
    import math

    return -((math.log10(p["x"]) + 2) ** 2) - ((p["k"] - 30) / 10) ** 2 - (p["c"] != "q")


def test_parzen_sampler_beats_random_draws():
    score = lambda asked: [_surface(f, p) for f, p in asked]
    learned, even = [], []
    for seed in range(12):
        learned.append(S.best_of(S.run_study(S.ParzenSampler(SURFACE, seed), score, 60, 6)).score)
        rng = random.Random(seed)
        even.append(max(score([S.draw_random(SURFACE, rng) for _ in range(60)])))
    assert statistics.mean(learned) > statistics.mean(even) and statistics.median(learned) > statistics.median(even)


def _frame(spark, n=240):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        x = [rng.gauss(0, 1), rng.uniform(0, 5), float(rng.randint(0, 1)), rng.gauss(1, 2)]
        rows.append((i * 7, Vectors.dense(x), float(x[0] + 0.5 * x[2] + rng.gauss(0, 0.6) > 0.7)))
    return spark.createDataFrame(rows, ["CustomerId", "features", "label"])


def test_cross_validation_equals_fits_by_hand(spark):
    train = _frame(spark)
    specs = [
        T.TreeSpec("forest", 4, 4, sqrt_columns=True, weighting="balanced"), T.TreeSpec("forest", 7, 4, sqrt_columns=True, weighting="balanced"),
        T.TreeSpec("boost", 5, 2, rate=0.4, l2=1.0, weighting="pos_scale"), L.LinearSpec("hinge", 0.7, "balanced"), L.LinearSpec("log", 2.0),
    ]
    held = S.Folds(train, 3)
    got = held.confusions(specs)
    data = held.data
    bins = T.training_rows(data, fold_col="fold").bins  # bins come from all rows, labels from none
    for spec, cells in zip(specs, got):
        for k in range(3):
            rest, out = data.where(F.col("fold") != k), data.where(F.col("fold") == k)
            if isinstance(spec, T.TreeSpec):
                rows = T.training_rows(rest)
                binned = T.training_rows(data, fold_col="fold")
                from dataclasses import replace

                trees = T.train(binned, [replace(spec, fold=k)])[0]
                assert sum(rows.counts.values()) == rest.count()
                model = T.TreeModel(spec, bins, trees, T.prior(replace(spec, fold=k), binned.counts))
            else:
                model = L.fit(rest, [spec])[0]
            r = model.transform(out).agg(*[F.count_if((F.col("label") == a) & (F.col("prediction") == b)) for a in (0, 1) for b in (0, 1)]).first()
            assert list(r) == cells[k], (spec, k)
    assert sum(map(sum, got[0])) == 240
    held.close()


def test_searches_on_small_frames(spark):
    train = _frame(spark)
    grid = {"n_estimators": [3, 6], "max_depth": [2, None], "min_samples_split": [2, 5], "min_samples_leaf": [1]}
    trials = S.grid_search(train, "RandomForest", 3, grid)
    assert len(trials) == 8 and [t.number for t in trials] == list(range(1, 9)) and S.best_of(trials).score > 0.5
    boosted = S.grid_search(train, "XGBoost", 3, {"n_estimators": [3, 6], "max_depth": [2], "learning_rate": [0.3], "subsample": [0.8, 1.0]})
    assert len(boosted) == 4 and all(0 < t.score <= 1 for t in boosted)
    space = {
        "SVC": S.ACCURACY_SPACE["SVC"],
        "RandomForest": S.ACCURACY_SPACE["RandomForest"] | {"n_estimators": (2, 5, "int"), "max_depth": (2, 5, "int")},
    }
    drawn = S.random_search(train, space, n_trials=6)
    assert drawn == S.random_search(train, space, n_trials=6) and S.best_of(drawn).score > 0.6
    learned = S.study(train, space, S.accuracy, 3, n_trials=6, batch=3)
    assert len(learned) == 6 and S.best_of(learned).score > 0.6


def test_compact_keeps_rows_and_lowers_partitions(spark):
    df = spark.range(1000, numPartitions=16)
    small = ML.compact(df)
    assert small.rdd.getNumPartitions() == 1 and small.count() == 1000
    assert ML.compact(df.where("id < 0")).rdd.getNumPartitions() == 1

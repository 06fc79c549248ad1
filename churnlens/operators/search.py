"""Named learners, voting, and searches over their parameters on cross-validated scores.

All trials of a batch train together, folds included (``trees`` and ``linear`` take many models a pass)."""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators import evaluate as E
from churnlens.operators import linear as L
from churnlens.operators import trees as T
from churnlens.operators.models import stratified_folds

SEED = 42

# The model configurations of the training job and the experiments.
NAMED: dict[str, T.TreeSpec | L.LinearSpec] = {
    "gbt_production": T.TreeSpec("boost", 200, 4, rate=0.05, subsample=0.8, second_order=False, prior=True),
    "gbt_baseline": T.TreeSpec("boost", 100, 3, rate=0.1, second_order=False, prior=True),
    "rf_baseline": T.TreeSpec("forest", 100, 10, sqrt_columns=True, bootstrap=True, weighting="balanced"),
    "rf_tuned": T.TreeSpec("forest", 294, 11, min_leaf=9, min_split=7, sqrt_columns=True, bootstrap=True, impurity="entropy", weighting="balanced"),
    "logreg_baseline": L.LinearSpec("log", 1.0, "balanced"),
    "logreg_l2": L.LinearSpec("log", 0.1, "balanced"),
    "logreg_notebook": L.LinearSpec("log", 1.0, "balanced"),
    "linear_svm": L.LinearSpec("hinge", 1.0, "balanced"),
    "kernel_svm": L.LinearSpec("hinge", 1.0, "balanced", "rbf", "scale"),
    "gbt_weighted": T.TreeSpec("boost", 200, 5, rate=0.05, l2=1.0, min_child=1.0, subsample=0.8, columns=0.8, weighting="pos_scale"),
    "gbt_weighted_small": T.TreeSpec("boost", 100, 6, rate=0.1, l2=1.0, min_child=1.0, weighting="pos_scale"),
    "gbt_default": T.TreeSpec("boost", 100, 6, rate=0.3, l2=1.0, min_child=1.0),
}

# The tuning grids of the training job.
GRIDS = {
    "RandomForest": {"n_estimators": [100, 200], "max_depth": [10, 20, None], "min_samples_split": [2, 5], "min_samples_leaf": [1, 2]},
    "XGBoost": {"n_estimators": [100, 200], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.1, 0.3], "subsample": [0.8, 1.0]},
    "GradientBoosting": {"n_estimators": [100, 200], "max_depth": [3, 5], "learning_rate": [0.01, 0.1], "subsample": [0.8, 1.0]},
}

# The spaces of the two studies, (low, high, 'int' | 'log' | 'float') or choices.
ACCURACY_SPACE = {
    "SVC": {
        "C": (0.1, 100, "log"), "kernel": ["linear", "rbf", "poly", "sigmoid"], "gamma": ["scale", "auto"],
        "class_weight": [None, "balanced"],
    },
    "RandomForest": {
        "n_estimators": (50, 300, "int"), "max_depth": (3, 20, "int"), "min_samples_split": (2, 10, "int"),
        "min_samples_leaf": (1, 10, "int"), "bootstrap": [True, False], "criterion": ["gini", "entropy", "log_loss"],
        "class_weight": ["balanced", "balanced_subsample", None],
    },
}
F1_SPACE = {
    "XGBoost": {
        "lambda": (1e-8, 10.0, "log"), "alpha": (1e-8, 10.0, "log"), "max_depth": (3, 10, "int"),
        "min_child_weight": (1, 20, "int"), "gamma": (1e-8, 1.0, "log"), "subsample": (0.5, 1.0, "float"),
        "colsample_bytree": (0.5, 1.0, "float"), "learning_rate": (0.01, 0.3, "log"), "n_estimators": (100, 500, "int"),
    },
}


def spec_of(family: str, p: dict) -> T.TreeSpec | L.LinearSpec:
    """A trial as a learner; the log loss is entropy, and balanced per bootstrap is balanced per fold."""
    if family == "SVC":
        return L.LinearSpec("hinge", p["C"], p["class_weight"], p["kernel"], p["gamma"])
    if family == "RandomForest":
        return T.TreeSpec(
            "forest", p["n_estimators"], p["max_depth"], min_split=p["min_samples_split"], min_leaf=p["min_samples_leaf"],
            sqrt_columns=True, bootstrap=p.get("bootstrap", True), impurity="gini" if p.get("criterion", "gini") == "gini" else "entropy",
            weighting="balanced" if p.get("class_weight", "balanced") else None,
        )
    common = {"trees": p["n_estimators"], "depth": p["max_depth"], "rate": p["learning_rate"], "subsample": p["subsample"]}
    if family == "GradientBoosting":
        return T.TreeSpec("boost", **common, second_order=False, prior=True)
    return T.TreeSpec(
        "boost", **common, l2=p.get("lambda", 1.0), l1=p.get("alpha", 0.0), gamma=p.get("gamma", 0.0),
        min_child=float(p.get("min_child_weight", 1.0)), columns=p.get("colsample_bytree", 1.0), weighting="pos_scale",
    )


def fit(df: DataFrame, specs: Sequence[T.TreeSpec | L.LinearSpec]) -> list[T.TreeModel | L.LinearModel]:
    """Models of any specifications on ``df(features, label, CustomerId)``, in their order."""
    models: dict[int, T.TreeModel | L.LinearModel] = {}
    for kind, learner in ((T.TreeSpec, T.fit), (L.LinearSpec, L.fit)):
        mine = [i for i, s in enumerate(specs) if isinstance(s, kind)]
        if mine:
            models |= zip(mine, learner(df, [specs[i] for i in mine]))
    return [models[i] for i in range(len(specs))]


def soft_voting(models: Sequence, df: DataFrame) -> DataFrame:
    """Mean P(1) of several models; predict 1 where the mean exceeds one half."""
    out, names = df, []
    for i, m in enumerate(models):
        names.append(f"_p{i}")
        out = m.transform(out).withColumnRenamed("score", names[-1]).drop("prediction")
    mean = sum((F.col(c) for c in names[1:]), F.col(names[0])) / len(names)
    return out.withColumn("score", mean).withColumn("prediction", (F.col("score") > 0.5).cast("double")).drop(*names)


def metrics(scored: DataFrame, keys: Sequence[str] = ("split",)) -> DataFrame:
    """Hard-label metrics and the exact AUC of the scores."""
    hard = E.classification_metrics(scored, keys=list(keys))
    return hard.join(E.auc_from_scores(scored, keys=list(keys)).withColumnRenamed("roc_auc", "roc_auc_prob"), list(keys))


# ---- cross-validation ---------------------------------------------------------------------------


def accuracy(cells: Sequence[int]) -> float:
    return (cells[0] + cells[3]) / sum(cells)


def f1(cells: Sequence[int]) -> float:
    _, fp, fn, tp = cells
    return 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0


class Folds:
    """Training rows in stratified folds, binned once for all trials."""

    def __init__(self, train: DataFrame, folds: int):
        self.number = folds
        self.data = stratified_folds(train, folds).persist()
        self._rows: T.Rows | None = None

    def confusions(self, specs: Sequence[T.TreeSpec | L.LinearSpec]) -> list[list[list[int]]]:
        """Per specification and fold: tn, fp, fn, tp of the held-out rows."""
        out: dict[int, list[list[int]]] = {}
        grown = [i for i, s in enumerate(specs) if isinstance(s, T.TreeSpec)]
        if grown:
            self._rows = self._rows or T.training_rows(self.data, fold_col="fold")
            out |= zip(grown, T.cross_validate(self._rows, [specs[i] for i in grown], self.number))
        solved = [i for i, s in enumerate(specs) if isinstance(s, L.LinearSpec)]
        if solved:
            out |= zip(solved, L.cross_validate(self.data, [specs[i] for i in solved], self.number))
        return [out[i] for i in range(len(specs))]

    def scores(self, specs: Sequence, metric: Callable[[Sequence[int]], float]) -> list[float]:
        return [sum(map(metric, cells)) / self.number for cells in self.confusions(specs)]

    def close(self) -> None:
        self.data.unpersist()


@dataclass(frozen=True)
class Trial:
    number: int
    family: str
    params: dict
    score: float

    def described(self) -> str:
        return json.dumps(self.params, sort_keys=True)


def best_of(trials: Sequence[Trial]) -> Trial:
    """The best score; ties go to the earlier trial."""
    return max(trials, key=lambda t: (t.score, -t.number))


def grid_search(train: DataFrame, family: str, folds: int = 3, grid: dict | None = None) -> list[Trial]:
    """Every combination of a family's grid, by mean F1 of the positive class."""
    grid = grid or GRIDS[family]
    tried = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    held = Folds(train, folds)
    scores = held.scores([spec_of(family, p) for p in tried], f1)
    held.close()
    return [Trial(i, family, p, s) for i, (p, s) in enumerate(zip(tried, scores), 1)]


# ---- samplers -----------------------------------------------------------------------------------


def draw_random(space: dict, rng: random.Random) -> tuple[str, dict]:
    """A family, then a value of each of its parameters."""
    family = rng.choice(sorted(space))
    return family, {name: _draw(spec, rng) for name, spec in space[family].items()}


def _draw(spec, rng: random.Random):
    return rng.choice(spec) if isinstance(spec, list) else _back(spec, rng.uniform(*_range(spec)))


def _range(spec) -> tuple[float, float]:
    """The interval in which a numeric parameter is drawn: whole numbers by rounding, others as they
    are or by their logarithm."""
    low, high, kind = spec
    return (math.log(low), math.log(high)) if kind == "log" else (low - 0.5, high + 0.5) if kind == "int" else (low, high)


def _at(spec, value: float) -> float:
    return math.log(value) if spec[2] == "log" else float(value)


def _back(spec, x: float):
    low, high, kind = spec
    return min(high, max(low, round(x))) if kind == "int" else min(high, max(low, math.exp(x) if kind == "log" else x))


class ParzenSampler:
    """Tree-structured Parzen estimator: trials of the best quarter and the others each give a density per
    family and parameter; of ``candidates`` draws from the good one, the draw with the highest ratio of
    both is tried next.  The first ``startup`` trials are random."""

    def __init__(self, space: dict, seed: int = SEED, startup: int = 10, share: float = 0.25, candidates: int = 24):
        self.space, self.rng = space, random.Random(seed)
        self.startup, self.share, self.candidates = startup, share, candidates

    def propose(self, trials: Sequence[Trial], n: int) -> list[tuple[str, dict]]:
        return [draw_random(self.space, self.rng) if len(trials) + i < self.startup else self._next(trials) for i in range(n)]

    def _next(self, trials: Sequence[Trial]) -> tuple[str, dict]:
        ranked = sorted(trials, key=lambda t: (-t.score, t.number))
        cut = max(1, math.ceil(self.share * len(ranked)))
        good, rest = ranked[:cut], ranked[cut:]
        found = []
        for _ in range(self.candidates):
            family, ratio = self._choice(sorted(self.space), [t.family for t in good], [t.family for t in rest])
            params = {}
            for name, spec in self.space[family].items():
                seen = [[t.params[name] for t in side if t.family == family] for side in (good, rest)]
                params[name], r = self._choice(spec, *seen) if isinstance(spec, list) else self._number(spec, *seen)
                ratio += r
            found.append((ratio, family, params))
        return max(found, key=lambda x: x[0])[1:]

    def _choice(self, choices: list, good: list, rest: list):
        weight = {side: [1.0 + seen.count(c) for c in choices] for side, seen in (("good", good), ("rest", rest))}
        at = self.rng.choices(range(len(choices)), weight["good"])[0]
        return choices[at], math.log(weight["good"][at] / sum(weight["good"])) - math.log(weight["rest"][at] / sum(weight["rest"]))

    def _number(self, spec, good: list, rest: list):
        low, high = _range(spec)
        good, rest = [_at(spec, v) for v in good], [_at(spec, v) for v in rest]
        centre = self.rng.choice([None, *good])
        x = self.rng.uniform(low, high) if centre is None else low - 1
        while not low <= x <= high:
            x = self.rng.gauss(centre, self._width(spec, good))
        return _back(spec, x), math.log(self._density(spec, good, x)) - math.log(self._density(spec, rest, x))

    @staticmethod
    def _width(spec, seen: list) -> float:
        low, high = _range(spec)
        return (high - low) * max(0.05, 1.0 / (1.0 + len(seen)))

    def _density(self, spec, seen: list, x: float) -> float:
        """An even density and a bell about each value, cut to the range."""
        low, high = _range(spec)
        s = self._width(spec, seen)
        total = 1.0 / (high - low)
        for m in seen:
            inside = (math.erf((high - m) / (s * math.sqrt(2))) - math.erf((low - m) / (s * math.sqrt(2)))) / 2
            total += math.exp(-0.5 * ((x - m) / s) ** 2) / (s * math.sqrt(2 * math.pi) * inside)
        return total / (1 + len(seen))


def run_study(sampler: ParzenSampler, score: Callable[[list[tuple[str, dict]]], list[float]], n_trials: int, batch: int) -> list[Trial]:
    """Batches of proposals, each scored together."""
    trials: list[Trial] = []
    while len(trials) < n_trials:
        asked = sampler.propose(trials, min(batch, n_trials - len(trials)))
        found = score(asked)
        trials += [Trial(len(trials) + i, f, p, s) for i, ((f, p), s) in enumerate(zip(asked, found), 1)]
    return trials


def study(train: DataFrame, space: dict, metric: Callable, folds: int, n_trials: int = 50, batch: int = 10, seed: int = SEED) -> list[Trial]:
    """Trials of a study on cross-validated scores."""
    held = Folds(train, folds)
    trials = run_study(
        ParzenSampler(space, seed), lambda asked: held.scores([spec_of(f, p) for f, p in asked], metric), n_trials, batch
    )
    held.close()
    return trials


def random_search(train: DataFrame, space: dict = ACCURACY_SPACE, metric: Callable = accuracy, folds: int = 3, n_trials: int = 50,
                  seed: int = SEED) -> list[Trial]:
    """Seeded independent draws, all trained together."""
    rng = random.Random(seed)
    asked = [draw_random(space, rng) for _ in range(n_trials)]
    held = Folds(train, folds)
    scores = held.scores([spec_of(f, p) for f, p in asked], metric)
    held.close()
    return [Trial(i, f, p, s) for i, ((f, p), s) in enumerate(zip(asked, scores), 1)]

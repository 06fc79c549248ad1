"""Linear and kernel classifiers by Newton's method, many models in one pass.

Each round is one job: every task sums loss, gradient and curvature of all unfinished models over its
rows, the sums meet by model and the Newton step is solved there, so the driver sees one step a model.
A model is logistic (``loss='log'``) or a support vector machine with squared hinge (``'hinge'``), on the
columns as they are or on a Nyström map of a kernel through a bounded number of landmark rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators.ranking import split_key
from churnlens.session import ship_package

LANDMARKS = 128
ROUNDS = 60
TOLERANCE = 1e-9
CELLS = ("tn", "fp", "fn", "tp")
#: Eigenvalues of the landmark kernel below this share of the largest carry no direction.
FLAT = 1e-10


@dataclass(frozen=True)
class LinearSpec:
    """``c`` multiplies the summed losses beside half the squared coefficients; the intercept is free.

    ``kernel``: 'linear', 'rbf', 'poly' (degree 3) or 'sigmoid'; ``gamma``: 'scale' (1 / (columns x
    variance of all entries)) or 'auto' (1 / columns).  ``weighting``: None or 'balanced', from the rows
    it trains on.  ``fold`` holds out rows of that fold."""

    loss: str
    c: float = 1.0
    weighting: str | None = None
    kernel: str = "linear"
    gamma: str = "scale"
    fold: int | None = None


@dataclass(frozen=True)
class Map:
    """The Nyström features of a kernel: k(x, landmarks) times ``root``."""

    kernel: str
    gamma: float
    landmarks: np.ndarray
    root: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        return kernel_matrix(self.kernel, self.gamma, x, self.landmarks) @ self.root


def kernel_matrix(kernel: str, gamma: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    dot = a @ b.T
    if kernel == "rbf":
        out = (a * a).sum(1)[:, None] + (b * b).sum(1)
        dot *= 2
        out -= dot
        np.maximum(out, 0.0, out=out)
        out *= -gamma
        return np.exp(out, out=out)
    dot *= gamma
    return dot * dot * dot if kernel == "poly" else np.tanh(dot, out=dot)


def nystroem(kernel: str, gamma: float, landmarks: np.ndarray) -> Map:
    """Directions of negative or no weight (a sigmoid kernel has such) are left out."""
    value, vector = np.linalg.eigh(kernel_matrix(kernel, gamma, landmarks, landmarks))
    keep = value > FLAT * value.max()
    return Map(kernel, gamma, landmarks, vector[:, keep] / np.sqrt(value[keep]))


def design(feature_map: Map | None, x: np.ndarray) -> np.ndarray:
    z = x if feature_map is None else feature_map.of(x)
    return np.hstack([z, np.ones((len(z), 1))])


def sums(spec: LinearSpec, b: np.ndarray, z: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Loss, gradient and curvature of the weighted rows, flat.  With the squared hinge, rows beyond the margin add
    nothing."""
    f = z @ b
    if spec.loss == "log":
        p = 1.0 / (1.0 + np.exp(-f))
        loss, slope, bend = np.logaddexp(0.0, f) - y * f, p - y, p * (1.0 - p)
        return np.concatenate([[w @ loss], z.T @ (w * slope), ((z * (w * bend)[:, None]).T @ z).ravel()])
    s = 2.0 * y - 1.0
    short = 1.0 - s * f
    on = np.flatnonzero((short > 0) & (w != 0))
    short, s, w, z = short[on], s[on], w[on], z.take(on, axis=0)
    gradient = z.T @ (w * (-2.0 * s * short))
    z *= np.sqrt(2.0 * w)[:, None]
    return np.concatenate([[w @ short**2], gradient, (z.T @ z).ravel()])


def newton_step(spec: LinearSpec, b: np.ndarray, total: np.ndarray) -> tuple[float, np.ndarray]:
    """The penalized loss at ``b`` and the step from there."""
    k = len(b)
    free = np.ones(k)
    free[-1] = 0.0
    gradient = spec.c * total[1 : k + 1] + free * b
    curvature = spec.c * total[k + 1 :].reshape(k, k) + np.diag(free)
    curvature[-1, -1] += 1e-12  # rows that are all beyond the margin leave the intercept flat
    return spec.c * total[0] + 0.5 * float((free * b) @ b), np.linalg.solve(curvature, -gradient)


def class_weights(spec: LinearSpec, counts: dict) -> tuple[float, float]:
    n0, n1 = (sum(n for (fold, y), n in counts.items() if y == c and fold != (-1 if spec.fold is None else spec.fold)) for c in (0, 1))
    return ((n0 + n1) / (2.0 * n0), (n0 + n1) / (2.0 * n1)) if spec.weighting and n0 and n1 else (1.0, 1.0)


@dataclass
class LinearModel:
    spec: LinearSpec
    map: Map | None
    coefficients: np.ndarray  # the intercept last
    rounds: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        return design(self.map, x) @ self.coefficients

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``score`` (P(1) of a logistic model, the margin of a machine) and ``prediction``."""
        sent = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def margin(a: pd.Series) -> pd.Series:
            return pd.Series(sent.value.margin(np.stack(a.to_list())) if len(a) else [], dtype="float64")

        f = margin(vector_to_array("features"))
        out = df.withColumn("score", f).withColumn("prediction", (F.col("score") > 0).cast("double"))
        return out.withColumn("score", 1 / (1 + F.exp(-F.col("score")))) if self.spec.loss == "log" else out


def _maps(rows: DataFrame, specs: Sequence[LinearSpec], width: int, landmarks: int) -> dict[tuple[str, str], Map | None]:
    """Feature maps by (kernel, gamma).  Landmarks are the rows of least hashed id, a bounded number."""
    wanted = {(s.kernel, s.gamma) for s in specs}
    if all(k == "linear" for k, _ in wanted):
        return dict.fromkeys(wanted)
    entries = rows.select(F.explode("a").alias("v")).agg(F.var_pop("v")).first()[0]
    chosen = rows.orderBy(split_key("id"), "id").limit(landmarks).select("a").collect()
    points = np.unique(np.array([r["a"] for r in chosen]), axis=0)
    scale = {"scale": 1.0 / (width * entries) if entries else 1.0, "auto": 1.0 / width}
    return {(k, g): None if k == "linear" else nystroem(k, scale[g], points) for k, g in wanted}


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.asarray(batch.column(0).flatten())
    return x.reshape(batch.num_rows, -1), batch.column(1).to_numpy().astype(np.float64), batch.column(2).to_numpy()


def fit(df: DataFrame, specs: Sequence[LinearSpec], id_col: str = "CustomerId", fold_col: str | None = None,
        landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> list[LinearModel]:
    """Models of several specifications on ``df(features vector, label, id[, fold])``, trained together."""
    models, rows, _ = _fit(df, specs, id_col, fold_col, landmarks, rounds)
    rows.unpersist()
    return models


def _fit(df, specs, id_col, fold_col, landmarks, rounds):
    spark = df.sparkSession
    ship_package(spark)
    rows = df.select(
        vector_to_array("features").alias("a"), F.col("label").cast("double").alias("y"),
        (F.col(fold_col).cast("int") if fold_col else F.lit(0)).alias("fold"), F.col(id_col).cast("long").alias("id"),
    ).persist()
    counts = {(r["fold"], int(r["y"])): r["n"] for r in rows.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    width = len(rows.first()["a"])
    maps = _maps(rows, specs, width, landmarks)
    size = {k: (width if m is None else m.root.shape[1]) + 1 for k, m in maps.items()}
    weights = [class_weights(s, counts) for s in specs]
    at = {k: np.zeros(size[s.kernel, s.gamma]) for k, s in enumerate(specs)}
    last: dict[int, tuple[float, np.ndarray, np.ndarray]] = {}  # loss, point and step taken from there
    models: dict[int, LinearModel] = {}
    narrow = rows.select("a", "y", "fold")

    for turn in range(1, rounds + 1):
        sent = spark.sparkContext.broadcast(pickle.dumps((maps, at)))
        totals = narrow.mapInArrow(_summing(sent, specs, weights), "model long, sums binary")
        found = totals.groupBy("model").applyInArrow(_stepping(sent, specs), "model long, loss double, step binary").collect()
        sent.destroy()
        for r in found:
            k, loss, step = r["model"], r["loss"], np.frombuffer(r["step"], np.float64)
            b = at[k]
            if k in last and loss > last[k][0] + TOLERANCE * (1.0 + abs(last[k][0])):
                _, before, taken = last[k]
                last[k] = (last[k][0], before, taken / 2)
                at[k] = before + taken / 2  # too far: halve the step
            else:
                last[k] = (loss, b, step)
                at[k] = b + step
            if np.abs(at[k] - b).max() <= TOLERANCE * (1.0 + np.abs(b).max()) or turn == rounds:
                models[k] = LinearModel(specs[k], maps[specs[k].kernel, specs[k].gamma], at[k], turn)
                del at[k]
        if not at:
            break
    return [models[k] for k in range(len(specs))], rows, maps


def _summing(sent, specs: Sequence[LinearSpec], weights: list[tuple[float, float]]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps, at = pickle.loads(sent.value)
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, fold = _arrays(batch)
            seen: dict = {}
            for k, b in at.items():
                spec = specs[k]
                key = (spec.kernel, spec.gamma)
                if key not in seen:
                    seen[key] = design(maps[key], x)
                w = np.where(y == 1, weights[k][1], weights[k][0]) * (fold != (-1 if spec.fold is None else spec.fold))
                s = sums(spec, b, seen[key], y, w)
                total[k] = total[k] + s if k in total else s
        for k, s in total.items():
            yield pa.RecordBatch.from_pydict({"model": [k], "sums": [s.tobytes()]})

    return work


def _stepping(sent, specs: Sequence[LinearSpec]):
    def step(key, table):
        k = key[0].as_py()
        at = pickle.loads(sent.value)[1]
        parts = sorted(h.as_py() for h in table.column("sums"))  # the same order on every run
        total = np.sum([np.frombuffer(p, np.float64) for p in parts], axis=0)
        loss, move = newton_step(specs[k], at[k], total)
        return pa.table({"model": [k], "loss": [float(loss)], "step": [move.tobytes()]})

    return step


def cross_validate(df: DataFrame, specs: Sequence[LinearSpec], folds: int, id_col: str = "CustomerId", fold_col: str = "fold",
                   landmarks: int = LANDMARKS, rounds: int = ROUNDS) -> list[list[list[int]]]:
    """Per specification and fold: tn, fp, fn, tp of the held-out rows; all folds train together."""
    runs = [replace(s, fold=k) for s in specs for k in range(folds)]
    models, rows, maps = _fit(df, runs, id_col, fold_col, landmarks, rounds)
    sent = df.sparkSession.sparkContext.broadcast(pickle.dumps((maps, [m.coefficients for m in models])))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps, b = pickle.loads(sent.value)
        out = np.zeros((len(runs), 4), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, fold = _arrays(batch)
            z = {k: design(m, x) for k, m in maps.items()}
            for k, s in enumerate(runs):
                mine = fold == s.fold
                hit = z[s.kernel, s.gamma][mine] @ b[k] > 0
                out[k] += [((y[mine] == a) & (hit == p)).sum() for a in (0, 1) for p in (False, True)]
        yield pa.RecordBatch.from_pydict({"model": list(range(len(runs)))} | {c: out[:, i] for i, c in enumerate(CELLS)})

    schema = ", ".join(f"{c} long" for c in ("model", *CELLS))
    found = rows.select("a", "y", "fold").mapInArrow(judge, schema).groupBy("model").agg(*[F.sum(c).alias(c) for c in CELLS]).collect()
    rows.unpersist()
    cells = {r["model"]: [r[c] for c in CELLS] for r in found}
    return [[cells[i * folds + k] for k in range(folds)] for i in range(len(specs))]

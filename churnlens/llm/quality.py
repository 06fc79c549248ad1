"""Quality classifier: ridge regression on random Fourier features of document statistics.

The random features approximate a Gaussian kernel over standardised statistics of the whole text.
Every partition sums its own normal equations; the sums meet row by row in two levels, so neither a
task nor the driver sees more than a fixed number of (features x features) matrices.  Scores are
calibrated by isotonic regression on labelled rows that the ridge fit did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm import words as W
from churnlens.llm.tables import checkpointed

FEATURES = 320  # random features
RIDGE = 1e-3  # per labelled row
GAMMA = 0.05  # kernel exp(-GAMMA |x - y|^2) over standardised statistics
THRESHOLD = 0.3
SEED = 9
BINS = 4096  # calibration resolution per unit of raw score

_ASCII = {name: np.isin(np.arange(256), [ord(c) for c in chars]) for name, chars in {
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": "abcdefghijklmnopqrstuvwxyz", "digit": "0123456789", "stop": ".,",
    "ask": "!?", "mark": "#$%&*+@^~_", "bar": "|/\\<>", "bracket": "(){}[];=", "quote": "'\":-", "line": "\n\r",
}.items()}
_ASCII["wide"] = np.arange(256) >= 0x80
STATISTICS = [
    *_ASCII, "log_words", "word_length", "longest_word", "short_words", "upper_words", "marked_words",
    "repeated_word", "distinct_words", "distinct_triples", "common_word", "line_length", "log_bytes",
]


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each document's values; ``first`` as in ``Words``."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[first[1:]] - total[first[:-1]]


def _distinct(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each document, and the count of its most frequent one."""
    order = np.lexsort((h, doc))
    d, h = doc[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(d)))
    most = np.zeros(n)
    np.maximum.at(most, d[at], run)
    return np.bincount(d[at], minlength=n).astype(float), most


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``STATISTICS`` per text; an empty text has zeros."""
    ws = W.split_words(texts)
    n = len(texts)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, n)
    edge = np.concatenate(([0], np.cumsum(size)))
    per_byte = 1.0 / np.maximum(size, 1)
    words = ws.counts.astype(float)
    per_word = 1.0 / np.maximum(words, 1)
    doc, length = ws.doc_of(), ws.ends - ws.starts
    out = [_sums(mask[raw], edge) * per_byte for mask in _ASCII.values()]
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    in_buf = {k: np.concatenate(([0], np.cumsum(_ASCII[k][ws.buf]))) for k in ("upper", "lower", "wide")}
    upper, lower, wide = (c[ws.ends] - c[ws.starts] for c in (in_buf["upper"], in_buf["lower"], in_buf["wide"]))
    h = W.xxh64(ws.buf, ws.starts, ws.ends, SEED)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    distinct, most = _distinct(doc, h, n)
    t_ok = W.window_starts(ws, 3)
    triples, _ = _distinct(doc[: len(t_ok)][t_ok], W.window_hashes(h, 3)[t_ok], n)
    lines = _sums(_ASCII["line"][raw], edge) + 1
    out += [
        np.log1p(words), _sums(length, ws.first) * per_word, np.log1p(longest), _sums(length <= 2, ws.first) * per_word,
        _sums((upper > 1) & (lower == 0), ws.first) * per_word, _sums(upper + lower + wide < length - 1, ws.first) * per_word,
        _sums(again, ws.first) * per_word, np.where(words > 0, distinct * per_word, 1.0),
        np.where(words > 2, triples / np.maximum(words - 2, 1), 1.0), most * per_word,
        np.log1p(words / lines), np.log1p(size),
    ]
    return np.stack(out, axis=1)


def _statistics_in_chunks(column: pa.Array) -> np.ndarray:
    texts = W.text_bytes(column)
    parts = [statistics(texts[a:b]) for a, b in W.chunks(texts)]
    return np.concatenate(parts) if parts else np.empty((0, len(STATISTICS)))


def _list_column(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x array<double>``; null text: as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), _list_column(_statistics_in_chunks(batch.column(1)))], names=["doc_id", "x"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, x array<double>")


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out and fold 1 calibrates."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


@dataclass
class Model:
    """Everything a task needs to score texts; its size is fixed by ``FEATURES``."""

    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.omega + self.phase) * np.sqrt(2.0 / self.omega.shape[1])
        return np.concatenate((waves, np.ones((len(x), 1))), axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0.0, 1.0)


def _summed_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over ``rows(x, y)``: summed in each partition, then by matrix row, 64 partitions at
    a time and over those."""
    width = FEATURES + 1

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = np.zeros((width, width + 1))
        seen = False
        for batch in batches:
            if batch.num_rows:
                seen = True
                z = model.features(np.array(batch.column(0).to_pylist()))
                y = batch.column(1).to_numpy(zero_copy_only=False)[:, None]
                a += z.T @ np.concatenate((z, y), axis=1)
        if seen:
            from pyspark import TaskContext

            group = np.full(width, TaskContext.get().partitionId() // 64, np.int64)
            yield pa.record_batch([pa.array(group), pa.array(np.arange(width)), _list_column(a)], names=["g", "i", "a"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.asarray(v) for v in table.column("a").to_pylist()], axis=0)
        return pa.table({"g": table.column("g")[:1], "i": table.column("i")[:1], "a": _list_column(total[None, :])})

    schema = "g long, i long, a array<double>"
    parts = rows.select("x", "y").mapInArrow(local, schema)
    some = parts.groupBy("g", "i").applyInArrow(add, schema)
    whole = some.groupBy("i").applyInArrow(add, schema).orderBy("i").collect()  # FEATURES + 1 rows
    a = np.array([r["a"] for r in whole])
    return a[:, :-1], a[:, -1]


def _isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (position, mean label, weight) in order of position."""
    blocks: list[list[float]] = []
    for xi, yi, wi in zip(x, y, w):
        blocks.append([yi, wi, xi, xi])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2], b[3]])
    knots = np.array([v for b in blocks for v in (b[2], b[3])])
    levels = np.array([b[0] for b in blocks for _ in range(2)])
    return knots, levels


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Learn from labelled rows outside fold 0: folds 2 to 4 fit the ridge, fold 1 the calibration.

    Null labels are ignored and repeated ones averaged.  Without labelled rows every score is 0.5; with
    one class only, or no calibration rows, scores are the clipped ridge values."""
    d = len(STATISTICS)
    rng = np.random.default_rng(SEED)
    omega = rng.normal(0.0, np.sqrt(2 * GAMMA), (d, FEATURES))
    phase = rng.uniform(0, 2 * np.pi, FEATURES)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(
        F.avg(F.col(label_col).cast("double")).alias("y")
    )
    # Rows of fold 0 are never read for their text; whether a row is labelled is asked of narrow rows only,
    # since a join before the statistics would move every text.
    rows = document_statistics(docs.where(fold(id_col) != 0), id_col, text_col).join(known, "doc_id").withColumn("f", fold())
    rows = checkpointed(rows.select("x", "y", "f"))
    train = rows.where("f <> 1")
    moments = train.agg(F.count(F.lit(1)).alias("n"), *[g(F.col("x")[i]).alias(f"{k}{i}") for i in range(d) for k, g in (("m", F.avg), ("s", F.stddev_pop))]).first()
    flat = Model(np.zeros(d), np.ones(d), omega, phase, np.append(np.zeros(FEATURES), 0.5), np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    if not moments["n"]:
        return flat
    mean = np.array([moments[f"m{i}"] for i in range(d)])
    scale = np.array([moments[f"s{i}"] for i in range(d)])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), omega, phase, flat.weights, flat.knots, flat.levels)
    a, b = _summed_equations(train, model)
    model.weights = np.linalg.solve(a + RIDGE * moments["n"] * np.diag([*np.ones(FEATURES), 0.0]) + 1e-9 * np.eye(FEATURES + 1), b)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = np.clip(model.raw(np.array(batch.column(0).to_pylist())), -1, 2)
                yield pa.record_batch([pa.array(np.rint(raw * BINS).astype(np.int64)), batch.column(1)], names=["bin", "y"])

    bins = rows.where("f = 1").select("x", "y").mapInArrow(binned, "bin long, y double").groupBy("bin").agg(
        F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")
    ).orderBy("bin").collect()  # at most 3 * BINS + 1 rows
    if len(bins) > 1:
        model.knots, model.levels = _isotonic(*(np.array([r[c] for r in bins], float) for c in ("bin", "y", "n")))
        model.knots = model.knots / BINS
    return model


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, with_text: bool = True
) -> DataFrame:
    """All input columns, the text among them if asked, and ``score double, predicted int``.  Null text:
    scored as an empty one.  Input columns named like a result are left out."""
    docs = docs.drop("score", "predicted")
    if not with_text:  # the text stands last and does not come back
        docs = docs.select(*[c for c in docs.columns if c != text_col], text_col)
    names = docs.columns
    at = names.index(text_col)
    kept = len(names) if with_text else at
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(_statistics_in_chunks(batch.column(at).cast(pa.string())))
            yield pa.record_batch([*batch.columns[:kept], pa.array(s, pa.float64())], names=[*batch.schema.names[:kept], "_score"])

    from pyspark.sql import types as T

    schema = T.StructType([*inner.schema.fields[:kept], T.StructField("_score", T.DoubleType())])
    out = inner.mapInArrow(run, schema).withColumn("_predicted", (F.col("_score") >= threshold).cast("int"))
    return out.toDF(*names[:kept], "score", "predicted")

"""URL filter: rules by host and path prefix, then logistic regression on hashed character n-grams of
host and path, trained here from a small labelled URL table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1 << 15
GRAMS = (3, 4, 5)
#: Block at this probability: of held-out labelled rows about 2% of the clean ones are then blocked.
THRESHOLD = 0.55
#: (host, path prefix, verdict)
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
#: The labelled table: a verdict and a whole URL a line, written for this filter; all blocked ones are made up.
LABELLED = Path(__file__).with_name("labelled_urls.tsv")


def labelled_urls(path: Path = LABELLED) -> list[tuple[str, int]]:
    """The labelled table (1: block)."""
    rows = (line.split("\t") for line in path.read_text(encoding="utf-8").splitlines() if line)
    return [(url, int(verdict == "block")) for verdict, url in rows]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for null or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def _split(url: str) -> tuple[str, str]:
    rest = url.partition("://")[2]
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    path = rest[cut:].split("?")[0].split("#")[0]
    return rest[:cut].lower(), path if path.startswith("/") else ""


def _grams(hosts: Sequence[str], paths: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, hashed dimension) of every character n-gram; digits count as one digit, ``^`` and ``$``
    frame the host and the path, whose grams have dimensions of their own."""
    rows, dims = [], []
    for salt, values in ((1, hosts), (2, paths)):
        raw = [b"^" + v.encode("utf-8", "replace") + b"$" for v in values]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        buf = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
        buf[(buf >= 48) & (buf <= 57)] = 48
        row = np.repeat(np.arange(len(raw)), size)
        for n in GRAMS:
            m = len(buf) - n + 1
            if m <= 0:
                continue
            h = np.full(m, salt * 31 + n, np.uint64)
            with np.errstate(over="ignore"):
                for k in range(n):
                    h = h * np.uint64(0x100000001B3) + buf[k : k + m]
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            inside = row[:m] == row[n - 1 :]
            rows.append(row[:m][inside])
            dims.append((h >> np.uint64(40)).astype(np.int64)[inside] % DIMENSIONS)
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows), np.concatenate(dims)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def probability(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        """Probability of block."""
        row, dim = _grams(hosts, paths)
        z = np.bincount(row, weights=self.weights[dim], minlength=len(hosts)) if len(row) else np.zeros(len(hosts))
        n = np.sqrt(np.maximum(np.bincount(row, minlength=len(hosts)), 1)) if len(row) else np.ones(len(hosts))
        return 1 / (1 + np.exp(-(z / n + self.bias)))


def fit(rows: Sequence[tuple[str, int]], l2: float = 2e-3, rounds: int = 2500, rate: float = 4.0, prior: float = 0.15) -> Model:
    """Logistic regression by gradient descent; blocked rows weigh ``prior`` in all, so that an address
    about which nothing is known is allowed.  One class or no rows: bias only."""
    model = Model(np.zeros(DIMENSIONS), 0.0)
    y = np.array([label for _, label in rows], float)
    if not len(y) or y.min() == y.max():
        model.bias = 0.0 if not len(y) else (4.0 if y[0] else -4.0)
        return model
    hosts, paths = zip(*(_split(u) for u, _ in rows))
    row, dim = _grams(hosts, paths)
    scale = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(y)), 1))
    weight = np.where(y == 1, prior / y.sum(), (1 - prior) / (len(y) - y.sum()))
    each = scale[row]
    for _ in range(rounds):
        z = np.bincount(row, weights=model.weights[dim], minlength=len(y)) * scale + model.bias
        g = weight * (1 / (1 + np.exp(-z)) - y)
        model.weights -= rate * (np.bincount(dim, weights=g[row] * each, minlength=DIMENSIONS) + l2 / 100 * model.weights)
        model.bias -= rate * g.sum()
    return model


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as (rule, verdict); null if none does.  A rule fits its host and all
    subdomains where the path starts with the rule's."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # later ones take precedence
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def judge(
    pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, probability``: a rule's verdict where one fits, else block
    at ``threshold``.  Null urls and those without ``://`` have empty host and path and are judged so."""
    host, path = host_and_path(F.col(url_col))
    parts = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.probability(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            yield pa.record_batch([*batch.columns, pa.array(p)], names=["page_id", "host", "path", "probability"])

    scored = parts.mapInArrow(run, "page_id long, host string, path string, probability double")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    by_model = F.when(F.col("probability") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "probability")

"""Approximate nearest neighbours by inner product: inverted lists with an adaptive dimension scan.

Vectors are rotated by a random orthogonal matrix, so that any leading block of dimensions is an
unbiased sample of a distance.  Rows are dealt to lists by nearest centroid (fitted on a bounded sample;
every row is indexed), and long lists to blocks of bounded size.  In a block a query scans candidates a
column block at a time; after each, candidates whose extrapolated distance fails a hypothesis test
against the query's threshold are abandoned.  The threshold is the k-th best score of the query's own
list, found in a first pass.  Survivors are scored exactly on the original vectors.

The number of lists to probe is read off an audit: for a bounded sample of queries the true neighbours
are found by brute force over all rows, and the fewest lists that hold ``target`` of them are probed.  After
the search the same queries are judged on what it found, one by one; where their mean or the worst of
them falls short, the search is run again with twice the lists and a wider test.

Every row is kept once.  A task takes the rows of a block and then its queries, a batch at a time, so that
any number of queries meets a block in bounded memory; only where more than ``QUERY_ROWS`` queries
probe a list do its blocks get copies, to share the work.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm import vectors as V
from churnlens.llm.tables import checkpointed, shuffle_partitions

SAMPLE_ROWS = 16384  # rows that centroids are fitted on
AUDIT_QUERIES = 96
MAX_LISTS = 4096
BLOCK_ROWS = 4096  # candidates of a block
QUERY_ROWS = 65536  # queries that one copy of a block answers
COLUMN_BLOCK = 16
EPSILON = 1.6  # width of the hypothesis test
TARGET = 0.975
LEAST_MEAN, LEAST = 0.95, 0.5  # recall of the audit queries, end to end: their mean, the worst of them
SEED = 7


@dataclass
class Index:
    """What tasks need to place a vector: bounded by MAX_LISTS and the dimension."""

    dims: int
    centers: np.ndarray
    rotation: np.ndarray
    sizes: np.ndarray  # rows of each list
    probes: int = 1
    truth: DataFrame | None = None  # query_id, vec_id: the true neighbours of the audit queries

    @property
    def blocks(self) -> np.ndarray:
        return np.maximum(1, -(-self.sizes // BLOCK_ROWS))

    def nearest_list(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.centers.T - 0.5 * (self.centers**2).sum(1)).argmax(1) if len(x) else np.empty(0, np.int64)

    def probe_order(self, q: np.ndarray) -> np.ndarray:
        """Lists by inner product with their centroid, best first."""
        return np.argsort(-(q @ self.centers.T), axis=1, kind="stable")


def _block_of(ids: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % blocks.astype(np.uint64)).astype(np.int32)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class _Scan:
    """A block of candidates, rotated and cut into column blocks with their partial norms."""

    def __init__(self, index: Index, ids: np.ndarray, x: np.ndarray, epsilon: float = EPSILON):
        self.ids, self.x, self.index, self.epsilon = ids, x, index, epsilon
        r = x @ index.rotation
        cuts = range(0, index.dims, COLUMN_BLOCK)
        self.columns = [np.ascontiguousarray(r[:, c : c + COLUMN_BLOCK]) for c in cuts]
        self.norms = [(b**2).sum(1) for b in self.columns]
        self.full = sum(self.norms)

    def exact(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (self.x[at] * q).sum(1)

    def query(self, qid: int, q: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, exact scores) of at most the k best candidates that may score ``floor`` or more."""
        rq = q @ self.index.rotation
        alive = np.flatnonzero(self.ids != qid)
        if np.isfinite(floor) and len(alive):
            # score >= floor  <=>  squared distance <= |q|^2 + |x|^2 - 2 floor
            reach = np.maximum((rq**2).sum() + self.full - 2 * floor, 0.0) + 1e-9
            part = np.zeros(len(self.ids))
            seen = 0
            for b, n in zip(self.columns, self.norms):
                p = rq[seen : seen + b.shape[1]]
                part[alive] += n[alive] + (p**2).sum() - 2 * (b[alive] @ p)
                seen += b.shape[1]
                slack = (1 + self.epsilon / np.sqrt(seen)) ** 2 if seen < self.index.dims else 1.0
                alive = alive[part[alive] * (self.index.dims / seen) <= slack * reach[alive] + 1e-9]
                if not len(alive):
                    break
        scores = self.exact(q, alive)
        at = _best(scores, self.ids[alive], k)
        return self.ids[alive][at], scores[at]


def _searches(index: Index, k: int, epsilon: float, thresholds_only: bool):
    """Over rows sorted by (list, block, part, asks): candidates of a block are gathered, the queries that
    follow them are answered a batch at a time."""

    def run(batches):
        key, held, scan = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            cuts = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [batch.num_rows]))
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if key != tuple(keys[:3, lo]):
                    key, held, scan = tuple(keys[:3, lo]), [], None
                part = batch.slice(lo, hi - lo)
                ids, x = part.column(4).to_numpy(), V.matrix(part.column(5), index.dims)
                if not keys[3, lo]:
                    held.append((ids, x))
                elif held:
                    scan = scan or _Scan(index, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), epsilon)
                    yield _answers(scan, ids, x, part.column(6).to_numpy(zero_copy_only=False), k, thresholds_only)

    return run


def _answers(scan: _Scan, ids: np.ndarray, q: np.ndarray, floors: np.ndarray, k: int, thresholds_only: bool) -> pa.RecordBatch:
    qs, found, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    for i, qid in enumerate(ids):
        at, s = scan.query(qid, q[i], k, floors[i])
        if thresholds_only:
            at, s = at[k - 1 : k], s[k - 1 : k]
        qs.append(np.full(len(at), qid))
        found.append(at)
        scores.append(s)
    return pa.record_batch(
        [pa.array(np.concatenate(qs), pa.int64()), pa.array(np.concatenate(found), pa.int64()), pa.array(np.concatenate(scores))],
        names=["query_id", "vec_id", "score"],
    )


def _truth(audit_ids: np.ndarray, audit: np.ndarray, index: Index, k: int):
    """Per batch, each audit query's k best rows with their lists: brute force over all rows."""

    centers = Index(index.dims, index.centers, index.rotation, index.sizes)  # tasks get no frame

    def run(batches):
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), V.matrix(batch.column(1), centers.dims)
            lists = centers.nearest_list(x)
            for qid, q in zip(audit_ids, audit):
                at = np.flatnonzero(ids != qid)
                s = (x[at] * q).sum(1)
                best = _best(s, ids[at], k)
                yield pa.record_batch(
                    [pa.array(np.full(len(best), qid)), pa.array(ids[at][best]), pa.array(lists[at][best]), pa.array(s[best])],
                    names=["query_id", "vec_id", "list", "score"],
                )

    return run


def build(rows: DataFrame, total: int, k: int, is_query: Column, target: float = TARGET) -> Index:
    """Fit lists on a bounded sample and choose the number of probes by audit."""
    dims = V.usual_length(rows)
    rng = np.random.default_rng(SEED)
    rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    n_lists = int(np.clip(round(np.sqrt(total) / 4), 1, MAX_LISTS))
    centers = V.centroids(V.sample(rows, "vec_id", "x", total, SAMPLE_ROWS, dims, SEED), n_lists, SEED)
    index = Index(dims, centers, rotation, np.zeros(len(centers), np.int64))

    def count(batches):
        for batch in batches:
            yield pa.record_batch([pa.array(index.nearest_list(V.matrix(batch.column(1), dims)))], names=["list"])

    for r in rows.select("vec_id", "x").mapInArrow(count, "list long").groupBy("list").count().collect():  # one row a list
        index.sizes[r["list"]] = r["count"]
    audit = rows.where(is_query).orderBy(F.xxhash64(F.lit(SEED), F.col("vec_id")), "vec_id").limit(AUDIT_QUERIES).select("vec_id", "x").collect()
    if not audit:
        return index
    ids, q = np.array([r["vec_id"] for r in audit]), np.array([r["x"] for r in audit], np.float64)
    true = checkpointed(_top(rows.select("vec_id", "x").mapInArrow(_truth(ids, q, index, k), "query_id long, vec_id long, list long, score double"), k))
    place = np.argsort(index.probe_order(q), axis=1)  # rank of each list for each audit query
    row_of = {int(v): i for i, v in enumerate(ids)}
    ranks = np.sort([place[row_of[r["query_id"]], r["list"]] for r in true.collect()])  # at most AUDIT_QUERIES * k rows
    index.truth = true.select("query_id", "vec_id")
    if len(ranks):
        index.probes = int(ranks[min(len(ranks) - 1, int(np.ceil(target * len(ranks))) - 1)]) + 1
    return index


def _top(found: DataFrame, k: int) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows that take part: an id, and a valid vector of the usual length."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & V.valid_vector(F.col("x")))
    return rows.where(F.size("x") == V.usual_length(rows))


def search(
    embeddings: DataFrame, is_query: Column | None = None, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    target: float = TARGET,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k best rows found by inner product, its own id
    apart; ties to the smaller id.  ``is_query`` is a condition on ``vec_id`` (default: id divisible by 20).

    Null, zero and non-finite vectors, rows without an id and vectors of an unusual length take no part.
    Rows that repeat an id and vector count once each as candidates; as queries, once, and of unlike
    vectors with one id the one of least hash asks.  ``audit_mean`` and ``audit_least`` are the recall of
    the audit queries (null where nobody asks).  Empty table: no rows."""
    is_query = F.col("vec_id") % 20 == 0 if is_query is None else is_query
    rows = usable(embeddings, id_col, vector_col)
    total = rows.count()
    if not total:
        schema = "query_id long, rank int, vec_id long, score double, audit_mean double, audit_least double"
        return embeddings.sparkSession.createDataFrame([], schema)
    index = build(rows, total, k, is_query, target)
    truth, index.truth = index.truth, None  # the index itself travels to tasks
    dealt = deal(rows, index)
    asking = rows.where(is_query).select("vec_id", F.struct(F.xxhash64("x").alias("h"), "x").alias("v"))
    queries = checkpointed(asking.groupBy("vec_id").agg(F.min("v").alias("v")).select("vec_id", "v.x"))
    epsilon = EPSILON
    while True:
        hits = checkpointed(_top(_search(dealt, queries, index, k, epsilon), k))
        mean, least = _recall(truth, hits)
        if mean is None or (mean >= LEAST_MEAN and least >= LEAST) or (index.probes >= len(index.centers) and epsilon > 64):
            break
        index.probes, epsilon = min(len(index.centers), 2 * index.probes), 2 * epsilon
    return hits.select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score",
        F.lit(mean).cast("double").alias("audit_mean"), F.lit(least).cast("double").alias("audit_least"),
    )


def _recall(truth: DataFrame | None, hits: DataFrame) -> tuple[float | None, float | None]:
    """Mean and least share of its true neighbours that an audit query got."""
    if truth is None:
        return None, None
    found = hits.select("query_id", "vec_id", F.lit(1).alias("hit")).distinct()
    each = truth.join(found, ["query_id", "vec_id"], "left").groupBy("query_id").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("r"))
    row = each.agg(F.avg("r"), F.min("r")).first()
    return row[0], row[1]


DEALT = "list int, block int, vec_id long, x array<double>"


def deal(rows: DataFrame, index: Index) -> DataFrame:
    """Every row once, with its list and its block of that list."""
    blocks = index.blocks

    def place(batches):
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), V.matrix(batch.column(1), index.dims)
            lists = index.nearest_list(x)
            yield pa.record_batch(
                [pa.array(lists.astype(np.int32)), pa.array(_block_of(ids, blocks[lists])), batch.column(0), batch.column(1)],
                names=["list", "block", "vec_id", "x"],
            )

    return checkpointed(rows.select("vec_id", "x").mapInArrow(place, DEALT))


def _search(dealt: DataFrame, queries: DataFrame, index: Index, k: int, epsilon: float) -> DataFrame:
    """Hits of ``queries(vec_id, x)``: first the k-th best score in the own list, then all probed lists."""
    nothing = F.lit(float("-inf"))
    own = _meet(dealt, queries.withColumn("floor", nothing), index, k, epsilon, own_only=True)
    floors = checkpointed(own.groupBy("query_id").agg(F.max("score").alias("floor")))
    ready = queries.join(floors, queries["vec_id"] == floors["query_id"], "left").select("vec_id", "x", F.coalesce("floor", nothing).alias("floor"))
    return _meet(dealt, ready, index, k, epsilon, own_only=False)


def _meet(dealt: DataFrame, queries: DataFrame, index: Index, k: int, epsilon: float, own_only: bool) -> DataFrame:
    blocks, starts = index.blocks, 4 * k

    def probed(x: np.ndarray) -> list[np.ndarray]:
        """The lists of each query."""
        order = index.probe_order(x)
        if own_only:
            return list(order[:, :1])
        held = np.cumsum(index.sizes[order], axis=1)
        n = np.maximum(index.probes, (held < starts).sum(1) + 1)
        return [order[i, : n[i]] for i in range(len(order))]

    def count(batches):
        total = np.zeros(len(blocks), np.int64)
        for batch in batches:
            for lists in probed(V.matrix(batch.column(1), index.dims)):
                total[lists] += 1
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["list", "n"])

    parts = np.ones(len(blocks), np.int64)  # copies of a list's blocks; at most MAX_LISTS counts come back
    for r in queries.select("vec_id", "x").mapInArrow(count, "list long, n long").groupBy("list").agg(F.sum("n").alias("n")).collect():
        parts[r["list"]] = max(1, -(-r["n"] // QUERY_ROWS))

    def probe(batches):
        for batch in batches:
            ids, x, floor = batch.column(0).to_numpy(), V.matrix(batch.column(1), index.dims), batch.column(2)
            for i, lists in enumerate(probed(x)):  # a query's probes are one slice of bounded length
                each = np.repeat(lists, blocks[lists]).astype(np.int32)
                block = np.concatenate([np.arange(b) for b in blocks[lists]]).astype(np.int32)
                part = _block_of(np.full(len(each), ids[i]), parts[each])
                same = pa.array(np.full(len(each), i))
                yield pa.record_batch(
                    [pa.array(each), pa.array(block), pa.array(part), pa.array(np.ones(len(each), np.int32)), batch.column(0).take(same), batch.column(1).take(same), floor.take(same)],
                    names=["list", "block", "part", "asks", "vec_id", "x", "floor"],
                )

    schema = "list int, block int, part int, asks int, vec_id long, x array<double>, floor double"
    copied = {int(i): int(parts[i]) for i in np.flatnonzero(parts > 1)}
    copies = F.array(F.lit(0))
    if copied:
        of = F.create_map(*[F.lit(v) for pair in copied.items() for v in pair])
        copies = F.sequence(F.lit(0), F.coalesce(F.element_at(of, F.col("list")), F.lit(1)) - 1)
    rows = dealt.select("list", "block", F.explode(copies).alias("part"), F.lit(0).alias("asks"), "vec_id", "x", F.lit(None).cast("double").alias("floor"))
    keys = ["list", "block", "part"]
    both = rows.unionByName(queries.select("vec_id", "x", "floor").mapInArrow(probe, schema))
    run = both.repartition(shuffle_partitions(dealt.sparkSession), *keys).sortWithinPartitions(*keys, "asks", "vec_id")
    return run.mapInArrow(_searches(index, k, epsilon, own_only), "query_id long, vec_id long, score double")

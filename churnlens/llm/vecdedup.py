"""Embedding near-duplicates by range search over a robust-pruned flat graph.

1. Equal vectors of one label become one node with a multiplicity.
2. Nodes are dealt to shards (label, cluster), each to its nearest ``overlap`` clusters; shards longer
   than ``block_rows`` are cut into blocks.
3. Each block builds a flat graph: near neighbours of each node, robustly pruned (a neighbour goes if a
   kept one is ``alpha`` times closer to it), with edges both ways, so a list is never longer than its
   block.  A node's lists from all of its blocks are united.
4. Every node is a query in its nearest cluster, its home, and in those of its other clusters that may
   decide a pair: a greedy walk from the block's medoids over the united lists, then a search that
   expands every node within the range plus a margin.  Links are verified on the vectors in double
   precision.  A pair is decided in one cluster (a home of either that holds both, the lower of two),
   where both directions meet, and a link counts for both ends whichever found it.
5. An audit compares links of a bounded sample of nodes with brute force over all rows.  Nodes weigh
   equally, those of few and of many links apart; if the mean recall of either is below the target, the
   overlap doubles, or once every cluster holds every node the margin, and the links are found again.

Links are counted where they are found and only a spanning forest of each block leaves the task, so
output is linear in the input even where a group of near copies holds a third of all rows.

Large groups of near copies do not enter the graph.  Nodes within half the threshold's angle of a
centroid are its *core* if they are many; any two of them link.  By the triangle inequality a node links
with a whole core if its angle to the centroid and the core's radius add up to no more than the
threshold's, and with none of it if they differ by more; only cores that these bounds leave open are
compared row by row.  Cores are at most ``MAX_CORES``, so their centroids and weights go to every task.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm import vectors as V
from churnlens.llm.graph import connected_components
from churnlens.llm.tables import checkpointed, shuffle_partitions

THRESHOLD = 0.93
SAMPLE_ROWS = 32768  # rows that centroids are fitted on
AUDIT_ROWS = 512  # nodes of the audit's first draw
AUDIT_MOST = 4096  # nodes of all its draws
AUDIT_LINKED = 64  # nodes of few links that it wants to see
FEW_LINKS = 16
TARGET = 0.98
MAX_CLUSTERS = 4096
BLOCK_ROWS = 2048  # nodes of a block; clusters hold a quarter of that on average, before overlap
BEAM = 16
DEGREE, POOL, ALPHA = 32, 96, 1.2
WALK_DEGREE = 64  # neighbours of a node that a walk looks at
MARGIN = 0.04  # the search also expands nodes this far below the threshold
SEED = 10
MAX_CORES = 65536  # a core holds at least this part of all nodes, and at least CORE_ROWS
CORE_ROWS = 64
SLACK = 1e-7  # radians by which a bound must hold
CHUNK = 1024  # rows that are held against all centroids at a time


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def robust_pruned(x: np.ndarray, degree: int = DEGREE, pool: int = POOL, alpha: float = ALPHA) -> np.ndarray:
    """Neighbour places of each row (-1: none): from its ``pool`` nearest rows, nearest first, those that
    no kept neighbour is ``alpha`` times closer to than the row itself."""
    n = len(x)
    out = np.full((n, degree), -1, np.int64)
    pool = min(pool, n - 1)
    if pool < 1:
        return out
    for lo in range(0, n, 512):
        sims = x[lo : lo + 512] @ x.T
        own = np.arange(len(sims))
        sims[own, lo + own] = -2
        near = np.argpartition(-sims, pool - 1, axis=1)[:, :pool]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sims, near, 1), axis=1, kind="stable"), 1)
        dist = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(sims, near, 1), 0))
        y = x[near]
        between = np.sqrt(np.maximum(2 - 2 * np.einsum("ipd,iqd->ipq", y, y), 0))
        alive = np.ones(near.shape, bool)
        kept = np.zeros(len(sims), np.int64)
        for p in range(pool):
            take = alive[:, p] & (kept < degree)
            out[lo + own[take], kept[take]] = near[take, p]
            kept += take
            alive &= ~(take[:, None] & (alpha * between[:, p] <= dist))
    return out


def medoids(x: np.ndarray) -> np.ndarray:
    """Places of about sqrt(n) rows, each nearest to the centre of a part of the block."""
    centers = V.centroids(x, int(np.ceil(np.sqrt(len(x)))), SEED, rounds=4)
    return np.unique((x @ centers.T).argmax(0))


def _greedy(x: np.ndarray, lists: np.ndarray, queries: np.ndarray, entries: np.ndarray, low: float) -> tuple[np.ndarray, np.ndarray]:
    """Best-first walks of all queries side by side from their nearest medoids, over a beam of ``BEAM``
    nodes, until every node of the beam is expanded or one is in range; returns the beams."""
    m, width = len(queries), min(BEAM, len(entries))
    s = queries @ x[entries].T
    top = np.argpartition(-s, width - 1, axis=1)[:, :width]
    nodes, sims = entries[top], np.take_along_axis(s, top, 1)
    if width < BEAM:
        nodes = np.concatenate((nodes, np.full((m, BEAM - width), -1)), 1)
        sims = np.concatenate((sims, np.full((m, BEAM - width), -3.0)), 1)
    fresh = nodes >= 0
    seen = np.zeros((m, len(x)), bool)
    seen[np.arange(m)[:, None], np.maximum(nodes, 0)] |= fresh
    act = np.arange(m)
    while len(act):
        left = np.where(fresh[act], sims[act], -4.0)
        j = left.argmax(1)
        going = (left[np.arange(len(act)), j] > -3) & (sims[act].max(1) < low)
        act, j = act[going], j[going]
        if not len(act):
            break
        fresh[act, j] = False
        near = lists[nodes[act, j]]
        ok = (near >= 0) & ~seen[act[:, None], np.maximum(near, 0)]
        got = np.where(ok, np.einsum("qd,qrd->qr", queries[act], x[near]), -3.0)
        r, c = np.nonzero(ok)
        seen[act[r], near[r, c]] = True
        all_n = np.concatenate((nodes[act], np.where(ok, near, -1)), 1)
        all_s = np.concatenate((sims[act], got), 1)
        all_f = np.concatenate((fresh[act], ok), 1)
        top = np.argpartition(-all_s, BEAM - 1, axis=1)[:, :BEAM]
        nodes[act], sims[act], fresh[act] = (np.take_along_axis(v, top, 1) for v in (all_n, all_s, all_f))
    return nodes, sims


class Graph:
    """Neighbour lists of a block's nodes, one after another; ``wide`` holds the first of each list,
    padded with -1, for the walks."""

    def __init__(self, n: int, row: np.ndarray, place: np.ndarray):
        """``row`` (ascending) and ``place``: the edges."""
        self.degree = np.bincount(row, minlength=n)
        self.first = np.cumsum(self.degree) - self.degree
        self.place = place
        rank = np.arange(len(row)) - self.first[row]
        self.wide = np.full((n, max(1, min(WALK_DEGREE, int(self.degree.max(initial=0))))), -1, np.int64)
        early = rank < self.wide.shape[1]
        self.wide[row[early], rank[early]] = place[early]

    def expand(self, q: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, neighbour) for all neighbours of each (query, node)."""
        d = self.degree[node]
        at = np.repeat(self.first[node] - (np.cumsum(d) - d), d) + np.arange(int(d.sum()))
        return np.repeat(q, d), self.place[at]


def range_search(
    x: np.ndarray, graph: Graph, queries: np.ndarray, own: np.ndarray, low: float, entries: np.ndarray,
    margin: float = MARGIN,
) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) pairs of similarity at least ``low`` found over the graph.

    Each query walks greedily from the medoids ``entries``, then expands every node within the range
    plus the margin.  ``own`` is the query's own node (-1 if it is elsewhere), whose list is expanded too."""
    n, m = len(x), len(queries)
    nodes, sims = _greedy(x, graph.wide, queries, entries, low)
    near_by = (sims >= low - margin) & (nodes >= 0)
    near_by[np.arange(m), sims.argmax(1)] = True
    q, c = np.nonzero(near_by)
    q, node = np.concatenate((q, np.flatnonzero(own >= 0))), np.concatenate((nodes[q, c], own[own >= 0]))
    seen = np.zeros((m, n), bool)
    hit_q, hit_n = [], []
    start = True
    while len(q):
        fresh = np.zeros((m, n), bool)
        fresh[q, node] = True
        q, node = np.nonzero(fresh & ~seen)
        seen |= fresh
        s = np.concatenate([np.einsum("pd,pd->p", queries[q[i : i + 65536]], x[node[i : i + 65536]]) for i in range(0, len(q), 65536)] or [np.empty(0)])
        hit = s >= low
        hit_q.append(q[hit])
        hit_n.append(node[hit])
        open_ = np.ones(len(q), bool) if start else s >= low - margin
        start = False
        q, node = graph.expand(q[open_], node[open_])
    return np.concatenate(hit_q), np.concatenate(hit_n)


def _find(parent: np.ndarray, i: np.ndarray) -> np.ndarray:
    while True:
        up = parent[i]
        if (up == i).all():
            return i
        i = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i] in place; roots are least places."""
    while len(a):
        ra, rb = _find(parent, a), _find(parent, b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def _build(dims: int):
    def run(table: pa.Table) -> pa.Table:
        ids, x = table.column("node").to_numpy(), _unit(V.matrix(table.column("x"), dims))
        near = robust_pruned(x)
        a, b = np.repeat(np.arange(len(ids)), near.shape[1])[near.ravel() >= 0], near.ravel()[near.ravel() >= 0]
        # Edges run both ways: a pruned neighbour is then reached through the closer one that was kept.
        row, place = np.concatenate((a, b)), np.concatenate((b, a))
        order = np.argsort(row, kind="stable")  # own choices first
        ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(ids))))).astype(np.int32)
        return pa.table({"node": table.column("node"), "near": pa.ListArray.from_arrays(pa.array(ends), pa.array(ids[place[order]], pa.int64()))})

    return run


_FOUND = {"node": pa.int64(), "links": pa.int64(), "root": pa.int64()}


class _Block:
    """The nodes of one block of a cluster, ascending."""

    def __init__(self, table: pa.Table, dims: int):
        order = np.argsort(table.column("node").to_numpy(), kind="stable")
        self.ids = table.column("node").to_numpy()[order]
        self.x = _unit(V.matrix(table.column("x"), dims))[order]
        self.copies, self.home = (table.column(c).to_numpy()[order] for c in ("copies", "home"))
        held = table.column("held").combine_chunks()
        self.held = np.asarray(held.flatten().to_numpy(zero_copy_only=False)).reshape(len(order), -1)[order]
        near = table.column("near").combine_chunks().take(pa.array(order))
        flat = near.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(order)), np.asarray(near.value_lengths().fill_null(0)))
        place = np.minimum(np.searchsorted(self.ids, flat), len(order) - 1)
        here = self.ids[place] == flat  # edges to nodes of this block
        self.graph = Graph(len(order), row[here], place[here])
        self.entries = medoids(self.x)


def _decided(cluster: int, a: _Block, i: np.ndarray, b: _Block, j: np.ndarray) -> np.ndarray:
    """Pairs (a[i], b[j]) that this cluster decides: of the two homes that hold both nodes, the lower."""
    home_a, home_b = a.home[i], b.home[j]
    in_a, in_b = home_a == cluster, home_b == cluster
    b_holds = (a.held[i] == home_b[:, None]).any(1)
    a_holds = (b.held[j] == home_a[:, None]).any(1)
    return (in_a & in_b) | (in_a & ((cluster < home_b) | ~b_holds)) | (in_b & ((cluster < home_a) | ~a_holds))


def _search(dims: int, low: float, margin: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        cluster, first, last = (k.as_py() for k in key[1:])
        block = table.column("block").to_numpy()
        if not ((block == first).any() and (block == last).any()):
            return pa.table({k: pa.array([], t) for k, t in _FOUND.items()})
        a = _Block(table.filter(pa.array(block == first)), dims)
        b = a if first == last else _Block(table.filter(pa.array(block == last)), dims)
        found = np.zeros((len(a.ids), len(b.ids)), bool)
        for asked, at, out in ((a, b, found), (b, a, found.T)):
            # Guests ask where this cluster may decide their pairs with nodes at home here.
            who = np.flatnonzero(asked.home >= cluster)
            for lo in range(0, len(who), 128):
                q = who[lo : lo + 128]
                own = q if asked is at else np.full(len(q), -1)
                i, j = range_search(at.x, at.graph, asked.x[q], own, low, at.entries, margin)
                i = q[i]
                mine = _decided(cluster, asked, i, at, j) & (asked.ids[i] != at.ids[j])
                out[i[mine], j[mine]] = True
            if a is b:
                found |= found.T.copy()
                break
        # Both ends of a link count it.  Union-find over a's nodes, then b's.
        shift = 0 if a is b else len(a.ids)
        parent = np.arange(shift + len(b.ids))
        for lo in range(0, len(a.ids), 128):
            i, j = np.nonzero(found[lo : lo + 128])
            _unite(parent, i + lo, j + shift)
        root = _find(parent, np.arange(len(parent)))
        ids = a.ids if a is b else np.concatenate((a.ids, b.ids))
        counts = _weighed(found, b.copies) if a is b else np.concatenate((_weighed(found, b.copies), _weighed(found.T, a.copies)))
        told = (ids != ids[root]) | (counts > 0)
        return pa.table({"node": pa.array(ids[told]), "links": pa.array(counts[told]), "root": pa.array(ids[root][told])})

    return run


def _weighed(found: np.ndarray, copies: np.ndarray) -> np.ndarray:
    return np.array([copies[row].sum() for row in found], np.int64)


def _deal(nodes: DataFrame, centers: np.ndarray, overlap: int, dims: int) -> DataFrame:
    """Each node once per cluster that holds it; ``home`` is its nearest, ``held`` all of them."""

    def run(batches):
        for batch in batches:
            x = _unit(V.matrix(batch.column(3), dims))
            order = np.argsort(-(x @ centers.T - 0.5 * (centers**2).sum(1)), axis=1, kind="stable")
            order = order[:, : min(overlap, len(centers))].astype(np.int32)
            held = V.list_array(order)
            for k in range(order.shape[1]):
                yield pa.record_batch([*batch.columns, pa.array(order[:, k]), pa.array(order[:, 0]), held], names=[*batch.schema.names, "cluster", "home", "held"])

    return nodes.select("node", "label", "copies", "x").mapInArrow(run, "node long, label string, copies long, x array<double>, cluster int, home int, held array<int>")


def _links(
    nodes: DataFrame, centers: np.ndarray, overlap: int, dims: int, low: float, block_rows: int, margin: float = MARGIN
) -> DataFrame:
    """``node, links, root``: per pair of blocks and node, links found and a spanning forest."""
    members = _deal(nodes, centers, overlap, dims)
    sizes = checkpointed(members.groupBy("label", "cluster").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")))
    dealt = members.join(sizes, ["label", "cluster"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = checkpointed(dealt)
    block = ["label", "cluster", "block"]
    built = dealt.select(*block, "node", "x").groupBy(*block).applyInArrow(_build(dims), "node long, near array<long>")
    united = built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    # Each two blocks of a cluster meet once, and each block meets itself.
    meeting = dealt.join(checkpointed(united), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meeting = meeting.withColumns({"first": F.least("block", "other"), "last": F.greatest("block", "other")})
    return meeting.select("label", "cluster", "first", "last", "block", "node", "copies", "x", "near", "home", "held").groupBy(
        "label", "cluster", "first", "last"
    ).applyInArrow(_search(dims, low, margin), "node long, links long, root long")


class Cores:
    """Cores by label: place in ``centers``, radius, weight in copies and least node of each."""

    def __init__(self, centers: np.ndarray, low: float, rows: list):
        self.centers, self.reach = centers, float(np.arccos(low))
        self.by_label: dict[str, dict[str, np.ndarray]] = {}
        for label in {r["label"] for r in rows}:
            mine = sorted((r for r in rows if r["label"] == label), key=lambda r: r["core"])
            self.by_label[label] = {k: np.array([r[k] for r in mine]) for k in ("core", "radius", "weight", "least")}

    def status(self, label: str, x: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """The label's cores, and for each row and core whether it surely links with all of it, and
        whether that is open."""
        cores = self.by_label[label]
        angle = _angles(x, self.centers[cores["core"]])
        sure = angle + cores["radius"] <= self.reach - SLACK
        return cores, sure, ~sure & (angle - cores["radius"] <= self.reach + SLACK)


def _angles(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ centers.T, -1.0, 1.0))


def _by_label(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """Rows of one label, at most ``CHUNK`` at a time."""
    labels = np.array(batch.column(1).to_pylist(), dtype=object)
    for label in dict.fromkeys(labels):
        at = np.flatnonzero(labels == label)
        yield from ((label, at[lo : lo + CHUNK]) for lo in range(0, len(at), CHUNK))


def _cored(nodes: DataFrame, centers: np.ndarray, dims: int, low: float, total: int) -> tuple[DataFrame, Cores]:
    """``nodes`` with ``core``: the place of the centroid whose core they belong to, or -1."""
    half = np.arccos(low) / 2 - SLACK
    schema = "node long, label string, copies long, x array<double>, core long, angle double"

    def placed(kept: dict[str, np.ndarray] | None) -> DataFrame:
        """Each node with its nearest centroid, of those kept for its label, if that is near enough."""

        def near(batches):
            for batch in batches:
                x = _unit(V.matrix(batch.column(3), dims))
                core, least = np.full(len(x), -1), np.full(len(x), np.pi)
                for label, at in _by_label(batch):
                    some = np.arange(len(centers)) if kept is None else kept.get(label, [])
                    if len(some) and len(at):
                        angle = _angles(x[at], centers[some])
                        own = angle.argmin(1)
                        least[at] = angle[np.arange(len(at)), own]
                        core[at] = np.where(least[at] <= half, np.asarray(some)[own], -1)
                yield pa.record_batch([*batch.columns, pa.array(core), pa.array(least)], names=[*batch.schema.names, "core", "angle"])

        return nodes.select("node", "label", "copies", "x").mapInArrow(near, schema)

    def many(frame: DataFrame) -> list:
        sums = frame.where("core >= 0").groupBy("label", "core").agg(
            F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius"), F.sum("copies").alias("weight"), F.min("node").alias("least")
        )
        return sums.where(F.col("n") >= max(CORE_ROWS, -(-total // MAX_CORES))).collect()  # at most MAX_CORES rows

    first = many(placed(None))
    if not first:
        return nodes.select("node", "label", "copies", "x", F.lit(-1).cast("long").alias("core")), Cores(centers, low, [])
    # Nodes of lesser cores join the nearest of those kept, where it is near enough.
    again = checkpointed(placed({label: np.array([r["core"] for r in first if r["label"] == label]) for label in {r["label"] for r in first}}))
    rows = many(again)
    kept = again.sparkSession.createDataFrame([(r["label"], r["core"]) for r in rows], "l string, kept long")
    marked = again.join(F.broadcast(kept), (again["label"] == kept["l"]) & (again["core"] == kept["kept"]), "left")
    return checkpointed(marked.select("node", "label", "copies", "x", F.coalesce("kept", F.lit(-1)).cast("long").alias("core"))), Cores(centers, low, rows)


def _core_links(marked: DataFrame, cores: Cores, dims: int, low: float, block_rows: int) -> DataFrame:
    """``node, links, root`` of all links with a node of a core.

    A node counts the cores that it surely links with by their weight, and so does the core count it, by one
    sum a core; where it is open, node and core meet row by row."""
    rows = marked.where(F.col("label").isin(*cores.by_label)) if len(cores.by_label) <= 100 else marked
    found = "node long, links long, root long"

    def sure(batches):
        for batch in batches:
            ids, copies, own = (batch.column(c).to_numpy() for c in (0, 2, 4))
            x = _unit(V.matrix(batch.column(3), dims))
            for label, at in _by_label(batch):
                if label not in cores.by_label:
                    continue
                known, linked, _ = cores.status(label, x[at])
                hit = linked.any(1)
                links = linked @ known["weight"] - np.where(own[at] >= 0, copies[at], 0)  # not itself
                first = known["least"][linked.argmax(1)]
                yield pa.record_batch([pa.array(ids[at][hit]), pa.array(links[hit]), pa.array(first[hit])], names=["node", "links", "root"])
                # Cores that share a node are one component.
                i, c = np.nonzero(linked)
                pairs = np.unique(np.stack((first[i], known["least"][c])), axis=1)
                pairs = pairs[:, pairs[0] != pairs[1]]
                yield pa.record_batch([pa.array(pairs[0]), pa.array(np.zeros(pairs.shape[1], np.int64)), pa.array(pairs[1])], names=["node", "links", "root"])

    def guests(batches):
        """What nodes outside of cores add to each core that they surely link with."""
        for batch in batches:
            copies, own = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            x = _unit(V.matrix(batch.column(3), dims))
            for label, at in _by_label(batch):
                if label in cores.by_label:
                    at = at[own[at] < 0]
                    known, linked, _ = cores.status(label, x[at])
                    yield pa.record_batch([pa.array([label] * len(known["core"]), pa.string()), pa.array(known["core"]), pa.array(copies[at] @ linked)], names=["label", "core", "links"])

    def open_(batches):
        for batch in batches:
            x = _unit(V.matrix(batch.column(3), dims))
            for label, at in _by_label(batch):
                if label in cores.by_label:
                    known, _, left = cores.status(label, x[at])
                    i, c = np.nonzero(left)
                    some = batch.take(pa.array(at[i]))
                    yield pa.record_batch([*some.columns, pa.array(known["core"][c])], names=[*some.schema.names, "at"])

    added = rows.where("core < 0").mapInArrow(guests, "label string, core long, links long").groupBy("label", "core").agg(F.sum("links").alias("links")).where("links > 0")
    members = rows.where("core >= 0")
    told = members.join(added, ["label", "core"]).select("node", "links", F.col("node").alias("root"))

    # Members of a core in blocks, each followed by the nodes that are open towards it.
    blocks = {(label, int(c)): int(n) for label, k in cores.by_label.items() for c, n in zip(k["core"], -(-k["weight"] // block_rows))}
    sizes = rows.sparkSession.createDataFrame([(label, c, n) for (label, c), n in blocks.items()], "label string, at long, blocks long")
    asks = rows.mapInArrow(open_, "node long, label string, copies long, x array<double>, core long, at long").join(F.broadcast(sizes), ["label", "at"])
    asks = asks.select("label", "at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("asks"), "node", "copies", "x", "core")
    held = members.withColumn("at", F.col("core")).join(F.broadcast(sizes), ["label", "at"])
    held = held.select("label", "at", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), F.lit(0).alias("asks"), "node", "copies", "x", "core")
    keys = ["label", "at", "block"]
    both = held.unionByName(asks).repartition(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys, "asks", "node")
    met = both.mapInArrow(_meet_core(dims, low), found)
    return rows.mapInArrow(sure, found).unionByName(told).unionByName(met)


def _meet_core(dims: int, low: float):
    """Exact links between the rows of a block of a core and the nodes that follow it."""

    def run(batches):
        key, ids, copies, x, credit = None, [], [], [], None

        def finish() -> pa.RecordBatch:
            at = np.flatnonzero(credit)
            return pa.record_batch([pa.array(ids[at]), pa.array(credit[at]), pa.array(ids[at])], names=["node", "links", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            labels = np.array(batch.column(0).to_pylist(), dtype=object)
            rest = [batch.column(c).to_numpy() for c in (1, 2, 3)]
            change = (labels[1:] != labels[:-1]) | np.logical_or.reduce([r[1:] != r[:-1] for r in rest])
            cuts = np.concatenate(([0], np.flatnonzero(change) + 1, [batch.num_rows]))
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                here = (labels[lo], rest[0][lo], rest[1][lo])
                part = batch.slice(lo, hi - lo)
                who, many, vec = part.column(4).to_numpy(), part.column(5).to_numpy(), _unit(V.matrix(part.column(6), dims))
                if here != key:
                    if credit is not None:
                        yield finish()
                    key, ids, copies, x, credit = here, [], [], [], None
                if not rest[2][lo]:
                    ids, copies, x = [*ids, who], [*copies, many], [*x, vec]
                    continue
                if not len(ids):
                    continue
                if credit is None:
                    ids, copies, x = np.concatenate(ids), np.concatenate(copies), np.concatenate(x)
                    credit = np.zeros(len(ids), np.int64)
                outside = part.column(7).to_numpy() < 0  # nodes of cores count for themselves
                for a in range(0, len(who), 512):
                    linked = (vec[a : a + 512] @ x.T >= low) & (who[a : a + 512, None] != ids)
                    credit += (many[a : a + 512] * outside[a : a + 512]) @ linked
                    hit = linked.any(1)
                    yield pa.record_batch(
                        [pa.array(who[a : a + 512][hit]), pa.array((linked @ copies)[hit]), pa.array(ids[linked.argmax(1)][hit])], names=["node", "links", "root"]
                    )
        if credit is not None:
            yield finish()

    return run


def _true_links(nodes: DataFrame, rows: list, dims: int, low: float) -> DataFrame:
    """``node, n``: the links of the nodes ``rows(node, label, x)`` by brute force over all nodes."""
    q = _unit(np.array([r["x"] for r in rows], np.float64).reshape(len(rows), dims))
    q_ids, q_labels = np.array([r["node"] for r in rows]), np.array([r["label"] for r in rows])

    def count(batches):
        n = np.zeros(len(q_ids), np.int64)
        for batch in batches:
            ids, copies = (batch.column(c).to_numpy() for c in (0, 2))
            x, labels = _unit(V.matrix(batch.column(3), dims)), np.array(batch.column(1).to_pylist())
            for lo in range(0, len(q_ids), 256):
                at = slice(lo, lo + 256)
                i, j = np.nonzero(x @ q[at].T >= low)
                same = (labels[i] == q_labels[at][j]) & (ids[i] != q_ids[at][j])
                np.add.at(n, lo + j[same], copies[i[same]])
        yield pa.record_batch([pa.array(q_ids), pa.array(n)], names=["node", "n"])

    return nodes.select("node", "label", "copies", "x").mapInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))


def _audit(nodes: DataFrame, found: DataFrame, dims: int, low: float) -> float:
    """Mean share of a node's true links that ``found(node, links)`` holds, over a sample of the nodes
    that have any: the lesser of the means over nodes of few and of many links.

    More nodes are drawn while too few of the drawn ones have a link, up to ``AUDIT_MOST``; 1 if none has."""
    order = [F.xxhash64(F.lit(SEED), F.col("node")), F.col("node")]
    few, many, drawn, wanted = [], [], 0, AUDIT_ROWS
    while True:
        rows = nodes.orderBy(*order).limit(wanted).select("node", "label", "x").collect()[drawn:]
        if rows:
            shares = _true_links(nodes, rows, dims, low).where("n > 0").join(found, "node", "left").select(
                "n", F.least("n", F.coalesce("links", F.lit(0))).alias("got")
            )
            for r in shares.collect():
                (few if r["n"] <= FEW_LINKS else many).append(r["got"] / r["n"])
        drawn += len(rows)
        if drawn < wanted or wanted >= AUDIT_MOST or len(few) >= AUDIT_LINKED:
            return float(min((np.mean(c) for c in (few, many) if c), default=1.0))
        wanted = min(4 * wanted, AUDIT_MOST)


def near_duplicates(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD, overlap: int = 3, target: float = TARGET, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept, audit_recall``, the last of them the
    audit's recall of links on this table (null where no vector takes part), which a caller may hold against
    its own bar; below ``target`` there is a warning as well.

    Rows of one label link at cosine ``threshold`` or more; n_links counts other rows, equal vectors
    included.  Null, zero and non-finite vectors, rows without a label or an id, and vectors of a length
    unlike the usual one link with nothing and are kept (a null id: component and kept are null).  Rows
    that repeat an id count as rows of their own.  Empty table: no rows."""
    rows = embeddings.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("x"),
    )
    valid = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & V.valid_vector(F.col("x"))
    usable = rows.where(valid)
    dims = V.usual_length(usable)
    valid = valid & (F.size("x") == dims)
    nodes = checkpointed(rows.where(valid).groupBy("label", "x").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")))
    total, recall = nodes.count(), None
    joined = rows.withColumn("_valid", F.coalesce(valid, F.lit(False)))
    if total:
        k = int(np.clip(-(-4 * total // block_rows), 1, MAX_CLUSTERS))
        points = V.sample(nodes, "node", "x", total, SAMPLE_ROWS, dims, SEED)
        centers = V.centroids(_unit(points), k, SEED)
        margin, apart, with_cores = MARGIN, nodes, None
        length = np.sqrt((centers**2).sum(1))
        marked, cores = _cored(nodes, centers / np.maximum(length, 1e-12)[:, None], dims, threshold, total)
        if cores.by_label:
            with_cores = checkpointed(_core_links(marked, cores, dims, threshold, block_rows))
            apart = checkpointed(marked.where("core < 0").drop("core"))
        while True:
            found = checkpointed(_links(apart, centers, overlap, dims, threshold, block_rows, margin))
            links = checkpointed(found.groupBy("node").agg(F.sum("links").alias("links")))
            recall = _audit(apart, links, dims, threshold)
            if recall >= target:
                break
            if overlap < len(centers):
                overlap *= 2
            elif margin < 1 + threshold:  # below that, the search may still leave nodes unexpanded
                margin *= 2
            else:
                warnings.warn(f"links found: {recall:.4f} of the true ones of a sampled node, {target} asked")
                break
        if with_cores is not None:
            found = found.unionByName(with_cores)
            links = checkpointed(found.groupBy("node").agg(F.sum("links").alias("links")))
        parts = connected_components(found.select("node", "root"), "node", "root")
        classes = nodes.join(links, "node", "left").join(parts, "node", "left").select(
            F.col("label").alias("_label"), F.col("x").alias("_x"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("_component"),
        )
        classes = checkpointed(classes)
        joined = joined.join(classes, F.col("_valid") & (F.col("label") == F.col("_label")) & (F.col("x") == F.col("_x")), "left")
    else:
        joined = joined.withColumn("n_links", F.lit(0).cast("long")).withColumn("_component", F.lit(None).cast("long"))
    component = F.coalesce("_component", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"), F.lit(recall).cast("double").alias("audit_recall"),
    )

"""SimHash near-duplicates with pigeonring candidate filtering.

Fingerprints link at ``max_bits`` or fewer differing bits.  The 64 bits are cut into
``max_bits + 1`` segments placed on a ring.  If two fingerprints differ in at most ``max_bits`` bits
then some segment starts a chain in which, for every length l, the first l consecutive segments
differ in at most floor(l * max_bits / segments) bits (pigeonring principle).  For l = 1 that budget
is zero and for l = 2 it is one bit, so candidates meet in an equi-join on two consecutive segments, some
43 bits, of which one side offers the second with at most one bit flipped; the longer chains are checked
inside the join condition before the full Hamming distance.  The key is so long that unrelated
fingerprints hardly ever share one, however many there are.

Only distinct fingerprints enter the join, so exact copies cost one row.  A key shared by more than
``group_rows`` distinct fingerprints belongs to a large group of near copies and is not paired: every
fingerprint that offers it lists itself and its one-bit neighbours outside the first segment.  Two of
them are at distance two or less exactly if they list a common word, and a word is listed by at most 65
fingerprints, so links within a group cost a constant number of rows per fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm import words as W
from churnlens.llm.graph import connected_components
from churnlens.llm.tables import checkpointed

SEED = 42
_BLOCK = 1 << 16  # shingles whose bits are unpacked at a time


def _fingerprint_chunk(texts: list[bytes], shingle: int) -> np.ndarray:
    ws = W.split_words(texts, lower=True)
    counts = ws.counts
    n_sh = np.where(counts >= shingle, counts - shingle + 1, (counts > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(texts)), n_sh)
    at = np.arange(int(n_sh.sum())) - np.repeat(np.cumsum(n_sh) - n_sh, n_sh)
    begin = ws.first[:-1][doc] + at
    last = begin + np.minimum(shingle, counts[doc]) - 1
    h = W.xxh64(ws.buf, ws.starts[begin], ws.ends[last], SEED)
    ones = np.zeros((len(texts), 64), dtype=np.int64)
    for lo in range(0, len(h), _BLOCK):
        part = h[lo : lo + _BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        d = doc[lo : lo + _BLOCK]
        cut = np.concatenate(([0], np.flatnonzero(np.diff(d)) + 1))
        ones[d[cut]] += np.add.reduceat(np.unpackbits(part, axis=1), cut, axis=0, dtype=np.int64)
    bits = ones * 2 > n_sh[:, None]
    return np.packbits(bits, axis=1).view(">u8").astype(np.uint64).ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, also: Sequence[Column] = ()) -> DataFrame:
    """``(id, fp)`` and the columns ``also``: the signed 64-bit SimHash of each row's lower-cased (A-Z)
    word shingles.

    A text of fewer words than a shingle is one shingle; null and wordless texts have fp 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.text_bytes(batch.column(1))
            fps = [_fingerprint_chunk(texts[a:b], shingle) for a, b in W.chunks(texts)]
            fp = np.concatenate(fps) if fps else np.empty(0, np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(fp.view(np.int64)), *batch.columns[2:]], names=["doc_id", "fp", *batch.schema.names[2:]])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *also)
    more = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return rows.mapInArrow(run, f"doc_id long, fp long{more}")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment, from the low bits up."""
    m = max_bits + 1
    widths = [64 // m + (i < 64 % m) for i in range(m)]
    return [(sum(widths[:i]), widths[i]) for i in range(m)]


def _value(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit(_signed((1 << width) - 1)))


def links(distinct_fps: DataFrame, max_bits: int = 2, group_rows: int = 128) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints whose components are those of all pairs at
    ``max_bits`` or fewer differing bits; every row is such a pair.

    ``max_bits`` is 0, 1 or 2 (the path of large groups lists one-bit neighbours)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    fp = F.col("fp")
    if max_bits == 0:  # distinct fingerprints differ
        return distinct_fps.select(fp.alias("a"), fp.alias("b")).where(F.lit(False))
    segs = _segments(max_bits)
    m = len(segs)

    def keyed(flips: bool) -> DataFrame:
        """Each fingerprint under its keys: segment i and, in the low bits, segment i + 1."""

        def offered(i: int) -> Column:
            (s, w), (t, v) = segs[i], segs[(i + 1) % m]
            key = F.shiftleft(_value(fp, s, w), v).bitwiseOR(_value(fp, t, v))
            masks = [0, *[1 << k for k in range(v)]] if flips else [0]
            return F.transform(F.array(*[F.lit(x).cast("long") for x in masks]), lambda x: F.struct(F.lit(i).alias("seg"), key.bitwiseXOR(x).alias("key")))

        offers = [offered(i) for i in range(m)]
        return distinct_fps.select("fp", F.explode(F.concat(*offers)).alias("x")).select("fp", "x.seg", "x.key")

    plain = keyed(False)
    large = checkpointed(plain.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group_rows).select("seg", "key"))
    a, b = keyed(True).alias("a"), plain.join(large, ["seg", "key"], "left_anti").alias("b")
    diff = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    bits = [F.bit_count(_value(diff, s, w)) for s, w in segs]
    chain = F.lit(False)
    for i in range(m):
        viable, total = F.lit(True), F.lit(0)
        for l in range(1, m + 1):
            total = total + bits[(i + l - 1) % m]
            viable = viable & (total <= l * max_bits // m)
        chain = chain | ((F.col("a.seg") == i) & viable)
    pairs = a.join(
        b,
        (F.col("a.seg") == F.col("b.seg")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp"))
        & chain & (F.bit_count(diff) <= max_bits),
    ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))

    grouped = keyed(True).join(large, ["seg", "key"], "left_semi").select("fp", "seg").distinct()
    masks = [[_signed(1 << k) for k in range(64) if not s <= k < s + w] for s, w in segs]
    listed = F.when(F.col("seg") == 0, F.array(*[F.lit(x) for x in [0, *masks[0]]]))
    for i in range(1, m):
        listed = listed.when(F.col("seg") == i, F.array(*[F.lit(x) for x in [0, *masks[i]]]))
    near = grouped.select("fp", F.explode(listed).alias("mask")).select("fp", fp.bitwiseXOR(F.col("mask")).alias("word"))
    stars = near.groupBy("word").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    # With a budget of one bit only the listed word itself is close enough to be a link.
    first = F.array_min("fps") if max_bits == 2 else F.col("word")
    if max_bits == 1:
        stars = stars.where(F.array_contains("fps", F.col("word")))
    starred = stars.select(first.alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return pairs.unionByName(starred)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2,
    group_rows: int = 128,
) -> DataFrame:
    """One row per input row: ``doc_id, fp, component_id`` (smallest id reachable by links).

    Rows of one text share a fingerprint and so a component.  A null id stays a row of its own and
    is never the smallest id; a component of null ids only has a null component_id.  Empty table: no rows."""
    prints = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    classes = _classes(prints, max_bits, group_rows)
    return prints.join(classes.drop("component"), "fp").select("doc_id", "fp", "component_id")


def _classes(prints: DataFrame, max_bits: int, group_rows: int) -> DataFrame:
    """``fp, component, component_id`` of each fingerprint of ``prints(doc_id, fp)``."""
    reps = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    parts = connected_components(links(reps.select("fp"), max_bits, group_rows), "a", "b")
    placed = reps.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    placed = checkpointed(placed)
    least = checkpointed(placed.groupBy("component").agg(F.min("rep").alias("component_id")))
    return checkpointed(placed.join(least, "component").select("fp", "component", "component_id"))


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2,
    group_rows: int = 128,
) -> DataFrame:
    """One row of ``docs`` per component of ``near_duplicates``, unchanged: that of the smallest id, nulls
    last, and of rows of that id the one whose text has the smallest hash."""
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    prints = checkpointed(fingerprints(docs, id_col, text_col, shingle, [digest.alias("digest")]))
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")
    first = prints.join(_classes(prints, max_bits, group_rows), "fp").groupBy("component").agg(F.min(key).alias("first"))

    def name(doc_id: Column, digest: Column) -> Column:
        return F.concat(digest, F.coalesce(doc_id.cast("long").cast("string"), F.lit("")))

    chosen = checkpointed(first.select(name(F.col("first.doc_id"), F.col("first.digest")).alias("name")))
    # Rows move once: the join and the removal of equal rows want them by the same key.
    rows = docs.select(name(F.col(id_col), digest).alias("name"), F.struct(*docs.columns).alias("row"))
    return rows.join(chosen, "name", "left_semi").dropDuplicates(["name"]).select("row.*")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

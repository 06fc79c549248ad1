"""Substring de-duplication with fixed-block anchors.

A passage of ``window`` words that stands in two documents contains, in either, a whole aligned block
of ``block = (window + 1) // 2`` words of that document.  So:

1. index: the aligned, non-overlapping blocks of every document; probe: the rolling windows of
   ``block`` words at every position of every document.  Both are hashed once per *bucket* of
   documents, so a passage that stands in a third of all documents costs one entry per bucket.
   Entries meet in the partition of their hash; a hash with an index entry and two documents is a hit.
2. extend: around each hit, all windows of ``window`` words that hold it are candidates; their 96-bit
   hashes meet the same way and return the smallest document id for each sequence.
3. mark: a document's words under a window that also starts in a smaller id go.  Overlapping windows
   merge into the maximal exact repeats.

Documents move as compressed text in one exchange by bucket, hash entries as sorted, delta-coded
arrays; no step pairs documents, and memory per task is one bucket or one hash partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.llm import words as W
from churnlens.llm.tables import shuffle_partitions

WINDOW = 13
#: Text of a bucket and text whose entries meet in one hash partition, in bytes: their numbers follow the
#: text, so the memory of a task stays the same however large the table is.
BUCKET_BYTES, PART_BYTES = 64 << 20, 128 << 20
NULL_ID = np.int64(2**63 - 1)
_CODE_SEED, _CHECK_SEED = 1, 2
_KEY_BITS = np.uint64(40)


def _pack(a: np.ndarray) -> bytes:
    """Byte planes of an integer array, compressed (planes that hardly vary cost nearly nothing)."""
    width = a.dtype.itemsize
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(-1, width).T.tobytes())


def _unpack(raw: bytes, dtype: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(dtype).ravel()


def _pack_sorted(a: np.ndarray) -> bytes:
    return _pack(np.diff(a, prepend=a.dtype.type(0)))


def _unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, "<u8"), dtype=np.uint64)


def _code(h: np.ndarray, parts: int) -> np.ndarray:
    """Partition number (from the low 24 bits) above 40 further hash bits: 40 + log2(parts) bits
    tell hashes apart, so precision grows with the partitions, that is with the data."""
    part = ((h & np.uint64(0xFFFFFF)) * np.uint64(parts)) >> np.uint64(24)
    return (part << _KEY_BITS) | (h >> np.uint64(24))


def _by_part(code: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of sorted codes by partition number."""
    part = code >> _KEY_BITS
    cut = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(code)]))
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b > a:
            yield int(part[a]), slice(a, b)


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal keys in sorted arrays."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


class _Bucket:
    """Documents of one bucket, in chunks of a bounded number of bytes."""

    def __init__(self, docs: pa.Table):
        self.ids = docs.column("_key").to_numpy().astype(np.int64)
        unzip = zstandard.ZstdDecompressor()
        self.texts = [unzip.decompress(z) for z in docs.column("_z").to_pylist()]

    def chunks(self) -> Iterator[tuple[int, int, W.Words]]:
        for a, b in W.chunks(self.texts, 4 << 20):
            yield a, b, W.split_words(self.texts[a:b])

    def block_codes(self, ws: W.Words, block: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Code of each rolling block and whether one starts there."""
        wh = W.xxh64(ws.buf, ws.starts, ws.ends, _CODE_SEED)
        return _code(W.window_hashes(wh, block), parts), W.window_starts(ws, block)

    def window_codes(self, ws: W.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, check hash and start mask of each rolling window."""
        code = W.window_hashes(W.xxh64(ws.buf, ws.starts, ws.ends, _CODE_SEED), window)
        check = W.window_hashes(W.xxh64(ws.buf, ws.starts, ws.ends, _CHECK_SEED), window) >> np.uint64(32)
        return code, check, W.window_starts(ws, window)


def _table(columns: dict, types: dict) -> pa.Table:
    return pa.table({k: pa.array(columns.get(k, []), type=t) for k, t in types.items()})


_ENTRY = {"part": pa.int32(), "bucket": pa.int32(), "codes": pa.binary(), "flags": pa.binary()}
_HIT = {"bucket": pa.int32(), "codes": pa.binary()}
_SEEN = {"part": pa.int32(), "bucket": pa.int32(), "codes": pa.binary(), "checks": pa.binary(), "low": pa.binary(), "high": pa.binary()}
_FIRST = {"bucket": pa.int32(), "codes": pa.binary(), "checks": pa.binary(), "low": pa.binary()}


def _anchor_entries(block: int, parts: int):
    def run(key: tuple, docs: pa.Table) -> pa.Table:
        bucket = _Bucket(docs)
        codes, low, high, aligned = [], [], [], []
        for a, b, ws in bucket.chunks():
            code, ok = bucket.block_codes(ws, block, parts)
            at = np.flatnonzero(ok)
            doc = ws.doc_of()[at]
            ids = bucket.ids[a:b][doc]
            codes.append(code[at])
            low.append(ids)
            high.append(ids)
            aligned.append((at - ws.first[doc]) % block == 0)
        out: dict[str, list] = {k: [] for k in _ENTRY}
        if codes:
            code, lo, hi, idx = (np.concatenate(x) for x in (codes, low, high, aligned))
            order = np.argsort(code, kind="stable")
            code, lo, hi, idx = code[order], lo[order], hi[order], idx[order]
            g = _groups(code)
            if len(g):
                many = np.minimum.reduceat(lo, g) != np.maximum.reduceat(hi, g)
                flag = np.logical_or.reduceat(idx, g)
                code = code[g]
                for part, s in _by_part(code):
                    out["part"].append(part)
                    out["bucket"].append(key[0].as_py())
                    out["codes"].append(_pack_sorted(code[s]))
                    out["flags"].append(np.packbits(np.stack((flag[s], many[s]))).tobytes())
        return _table(out, _ENTRY)

    return run


def _hits(key: tuple, entries: pa.Table) -> pa.Table:
    """Codes with an index entry and two documents, back to each bucket that holds them."""
    codes, flags, buckets = [], [], []
    for codes_z, flags_z, bucket in zip(*(entries.column(c).to_pylist() for c in ("codes", "flags", "bucket"))):
        c = _unpack_sorted(codes_z)
        codes.append(c)
        flags.append(np.unpackbits(np.frombuffer(flags_z, np.uint8), count=2 * len(c)).reshape(2, -1).astype(bool))
        buckets.append(np.full(len(c), bucket, dtype=np.int32))
    code, flag, bucket = np.concatenate(codes), np.concatenate(flags, axis=1), np.concatenate(buckets)
    order = np.argsort(code, kind="stable")
    code, flag, bucket = code[order], flag[:, order], bucket[order]
    g = _groups(code)
    size = np.diff(np.append(g, len(code)))
    hit = np.logical_or.reduceat(flag[0], g) & ((size > 1) | np.logical_or.reduceat(flag[1], g))
    held = np.repeat(hit, size)
    code, bucket = code[held], bucket[held]
    out: dict[str, list] = {k: [] for k in _HIT}
    order = np.argsort(bucket, kind="stable")
    code, bucket = code[order], bucket[order]
    for a, b in _runs(bucket):
        out["bucket"].append(int(bucket[a]))
        out["codes"].append(_pack_sorted(code[a:b]))
    return _table(out, _HIT)


def _runs(a: np.ndarray) -> Iterator[tuple[int, int]]:
    g = _groups(a)
    yield from zip(g.tolist(), [*g[1:].tolist(), len(a)])


def _found(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)
    return sorted_keys[at] == values


def _extend(block: int, window: int, parts: int):
    def run(key: tuple, docs: pa.Table, hits: pa.Table) -> pa.Table:
        out: dict[str, list] = {k: [] for k in _SEEN}
        if not docs.num_rows or not hits.num_rows:
            return _table(out, _SEEN)
        wanted = np.sort(np.concatenate([_unpack_sorted(z) for z in hits.column("codes").to_pylist()]))
        bucket = _Bucket(docs)
        held = []
        for a, b, ws in bucket.chunks():
            code, ok = bucket.block_codes(ws, block, parts)
            anchor = ok & _found(wanted, code)
            if not anchor.any():
                continue
            h, check, ok = bucket.window_codes(ws, window)
            upto = np.concatenate(([0], np.cumsum(anchor)))
            inside = upto[np.minimum(np.arange(len(h)) + window - block + 1, len(anchor))] - upto[: len(h)]
            at = np.flatnonzero(ok & (inside > 0))
            held.append((h[at], check[at].astype(np.uint32), bucket.ids[a:b][ws.doc_of()[at]]))
        if held:
            h, check, ids = (np.concatenate(x) for x in zip(*held))
            part = ((h & np.uint64(0xFFFFFF)) * np.uint64(parts)) >> np.uint64(24)
            order = np.lexsort((check, h, part))
            h, check, ids, part = h[order], check[order], ids[order], part[order]
            g = _groups(h, check)
            if len(g):
                low, high = np.minimum.reduceat(ids, g), np.maximum.reduceat(ids, g)
                h, check, part = h[g], check[g], part[g]
                for a, b in _runs(part):
                    out["part"].append(int(part[a]))
                    out["bucket"].append(key[0].as_py())
                    out["codes"].append(_pack_sorted(h[a:b]))
                    out["checks"].append(_pack(check[a:b]))
                    out["low"].append(_pack(low[a:b]))
                    out["high"].append(_pack(high[a:b] - low[a:b]))
        return _table(out, _SEEN)

    return run


def _first_ids(key: tuple, seen: pa.Table) -> pa.Table:
    """Smallest id of each sequence, back to the buckets in which a larger id holds it."""
    cols = {k: [] for k in ("h", "check", "low", "high", "bucket")}
    for codes, checks, low, high, bucket in zip(*(seen.column(c).to_pylist() for c in ("codes", "checks", "low", "high", "bucket"))):
        h = _unpack_sorted(codes)
        lo = _unpack(low, "<i8")
        for k, v in (("h", h), ("check", _unpack(checks, "<u4")), ("low", lo), ("high", lo + _unpack(high, "<i8")), ("bucket", np.full(len(h), bucket, np.int32))):
            cols[k].append(v)
    h, check, low, high, bucket = (np.concatenate(cols[k]) for k in ("h", "check", "low", "high", "bucket"))
    order = np.lexsort((check, h))
    h, check, low, high, bucket = (x[order] for x in (h, check, low, high, bucket))
    g = _groups(h, check)
    least = np.repeat(np.minimum.reduceat(low, g), np.diff(np.append(g, len(h))))
    told = high > least
    h, check, least, bucket = h[told], check[told], least[told], bucket[told]
    order = np.argsort(bucket, kind="stable")
    h, check, least, bucket = (x[order] for x in (h, check, least, bucket))
    out: dict[str, list] = {k: [] for k in _FIRST}
    if len(bucket):
        for a, b in _runs(bucket):
            out["bucket"].append(int(bucket[a]))
            out["codes"].append(_pack_sorted(h[a:b]))
            out["checks"].append(_pack(check[a:b]))
            out["low"].append(_pack(least[a:b]))
    return _table(out, _FIRST)


def _mark(window: int, carried: list[str], schema: pa.Schema):
    def run(key: tuple, docs: pa.Table, firsts: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        bucket = _Bucket(docs)
        got = [(_unpack_sorted(c), _unpack(k, "<u4"), _unpack(low, "<i8")) for c, k, low in zip(*(firsts.column(c).to_pylist() for c in ("codes", "checks", "low")))]
        h_k, check_k, low_k = (np.concatenate(x) for x in zip(*got)) if got else (np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.int64))
        order = np.lexsort((check_k, h_k))
        h_k, check_k, low_k = h_k[order], check_k[order], low_k[order]
        n_words, n_removed, spans, kept, sha = [], [], [], [], []
        for a, b, ws in bucket.chunks():
            covered = np.zeros(len(ws.starts), dtype=bool)
            if len(h_k):
                h, check, ok = bucket.window_codes(ws, window)
                at = np.flatnonzero(ok & _found(h_k, h))
                ids = bucket.ids[a:b][ws.doc_of()[at]]
                bad = np.zeros(len(at), dtype=bool)
                k = np.searchsorted(h_k, h[at])
                rest = np.arange(len(at))
                while len(rest):  # sequences that share the 64-bit hash stand side by side
                    same = (k[rest] < len(h_k)) & (h_k[np.minimum(k[rest], len(h_k) - 1)] == h[at][rest])
                    rest = rest[same]
                    bad[rest] |= (check_k[k[rest]] == check[at][rest].astype(np.uint32)) & (low_k[k[rest]] < ids[rest])
                    k[rest] += 1
                edge = np.zeros(len(ws.starts) + 1, dtype=np.int64)
                np.add.at(edge, at[bad], 1)
                np.add.at(edge, at[bad] + window, -1)
                covered = np.cumsum(edge[:-1]) > 0
            raw = ws.buf.tobytes()
            for d in range(b - a):
                lo, hi = int(ws.first[d]), int(ws.first[d + 1])
                c = covered[lo:hi]
                step = np.diff(np.concatenate(([0], c.view(np.int8), [0])))
                from_, to = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                n_words.append(hi - lo)
                n_removed.append(int(c.sum()))
                spans.append([{"start": int(x), "words": int(y - x)} for x, y in zip(from_, to)])
                if not len(from_):
                    clean = raw[ws.starts[lo] : ws.ends[hi - 1]] if hi > lo else b""
                    kept.append(bucket.texts[a + d])
                else:
                    runs = zip([0, *to.tolist()], [*from_.tolist(), hi - lo])
                    clean = b" ".join(raw[ws.starts[lo + x] : ws.ends[lo + y - 1]] for x, y in runs if y > x)
                    kept.append(clean)
                sha.append(hashlib.sha256(clean).hexdigest())
        cols = [docs.column(c) for c in carried] + [n_words, n_removed, spans, sha]
        if "kept_text" in schema.names:
            cols.append(pa.array(kept, pa.binary()).cast(pa.string()))
        return pa.Table.from_arrays([pa.array(x, t) if isinstance(x, list) else x.combine_chunks().cast(t) if isinstance(x, pa.ChunkedArray) else x for x, t in zip(cols, schema.types)], schema=schema)

    return run


def _zip_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        z = pa.array([pack.compress(t) for t in W.text_bytes(batch.column("_text"))], pa.binary())
        yield pa.record_batch([*batch.columns[:-1], z], names=[*batch.schema.names[:-1], "_z"])


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = False
) -> DataFrame:
    """One row per input row: its other columns, then ``n_words, n_removed, spans, kept_sha256`` and,
    if asked, ``kept_text``: the text itself where nothing is removed, else the kept words joined by
    one space.  ``spans`` are the removed maximal repeats as (start, words) in word positions.

    Null text: no words.  A null id is larger than any id and equal to other null ids; rows of one id
    do not remove each other.  An input column named like a result is left out.  Texts shorter than ``window`` words keep all.  Empty table: no rows."""
    block = (window + 1) // 2
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0)).alias("bytes")).first()["bytes"]
    parts = max(shuffle_partitions(docs.sparkSession), -(-size // PART_BYTES))
    buckets = max(2 * shuffle_partitions(docs.sparkSession), -(-size // BUCKET_BYTES))
    results = {"n_words", "n_removed", "spans", "kept_sha256", "kept_text"}
    others = [f for f in docs.schema.fields if f.name != text_col and f.name.lower() not in results]
    inner = [F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(others)]
    # Rows without an id spread by their text.
    unnamed = F.when(F.col(id_col).isNull(), F.col(text_col).cast("string"))
    spread = F.pmod(F.xxhash64(F.col(id_col), F.length(text_col), unnamed), F.lit(buckets)).cast("int")
    rows = docs.select(
        spread.alias("bucket"), F.coalesce(F.col(id_col).cast("long"), F.lit(int(NULL_ID))).alias("_key"), *inner,
        F.col(text_col).cast("string").alias("_text"),
    )
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("_z", T.BinaryType())])
    packed = rows.mapInArrow(_zip_texts, schema)

    def by_bucket():
        return packed.groupBy("bucket")

    entries = by_bucket().applyInArrow(_anchor_entries(block, parts), "part int, bucket int, codes binary, flags binary")
    hits = entries.groupBy("part").applyInArrow(_hits, "bucket int, codes binary")
    seen = by_bucket().cogroup(hits.groupBy("bucket")).applyInArrow(
        _extend(block, window, parts), "part int, bucket int, codes binary, checks binary, low binary, high binary"
    )
    firsts = seen.groupBy("part").applyInArrow(_first_ids, "bucket int, codes binary, checks binary, low binary")
    out = T.StructType([
        *[T.StructField(f"c{i}", f.dataType) for i, f in enumerate(others)],
        *T.StructType.fromDDL("n_words long, n_removed long, spans array<struct<start:long,words:long>>, kept_sha256 string").fields,
        *([T.StructField("kept_text", T.StringType())] if with_text else []),
    ])
    from pyspark.sql.pandas.types import to_arrow_schema

    marked = by_bucket().cogroup(firsts.groupBy("bucket")).applyInArrow(
        _mark(window, [f"c{i}" for i in range(len(others))], to_arrow_schema(out)), out
    )
    return marked.toDF(*[f.name for f in others], *[f.name for f in out.fields[len(others):]])

"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Splitting needs no regex.  Every code point of a batch becomes one of nine symbols (letter, number,
other, apostrophe that opens a two- or three-letter contraction, inner white space, a space or other
white space before a non-space, document end), and a small automaton over those symbols says where a
slice starts.  Transition functions of the automaton compose associatively and there are few of them,
so they are numbered, their products tabulated, and the state before every block of text comes from
a scan over block products; then all blocks step side by side.

Slices are merged by rank through a bounded cache.  Each token keeps its byte offset; decoding
writes tokens at their offsets.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Unicode White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Contractions that form slices of their own.
SHORT, LONG = "stmd", ("re", "ve", "ll")

_LETTER, _NUMBER, _OTHER, _TWO, _THREE, _INNER, _SPACE, _BLANK, _END = range(9)
_LET, _NUM, _OTH, _WHITE, _JOIN, _ONE_MORE, _TWO_MORE, _FRESH = range(8)
_CHUNK = 1 << 20
_CACHE_PIECES = 1 << 18
_CACHED_LENGTH = 64


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Letter, number, other, or white space (as _INNER) of each code point."""
    first = {"L": _LETTER, "N": _NUMBER}
    table = np.fromiter((first.get(unicodedata.category(chr(i))[0], _OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = _INNER
    return table


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a slice starts at the symbol."""
    if symbol == _END:
        return _FRESH, True
    if symbol == _LETTER:
        if state == _TWO_MORE:
            return _ONE_MORE, False
        if state == _ONE_MORE:
            return _FRESH, False
        return _LET, state not in (_LET, _JOIN)
    if symbol == _NUMBER:
        return _NUM, state not in (_NUM, _JOIN)
    if symbol in (_OTHER, _TWO, _THREE):
        if state in (_OTH, _JOIN):
            return _OTH, False
        return {_OTHER: _OTH, _TWO: _ONE_MORE, _THREE: _TWO_MORE}[symbol], True
    if symbol == _INNER:
        return _WHITE, state != _WHITE
    return (_JOIN if symbol == _SPACE else _FRESH), True


@lru_cache(maxsize=1)
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """next[state * 9 + symbol], starts[state * 9 + symbol], functions[f, state] and
    product[f * n + g], the number of "f, then g"; function s is that of symbol s."""
    nxt = np.array([[_step(q, s)[0] for s in range(9)] for q in range(8)], np.uint8)
    starts = np.array([[_step(q, s)[1] for s in range(9)] for q in range(8)])
    funcs = list(dict.fromkeys(tuple(nxt[:, s].tolist()) for s in range(9)))
    symbol_fn = [funcs.index(tuple(nxt[:, s].tolist())) for s in range(9)]
    funcs.append(tuple(range(8)))  # doing nothing
    known = {f: i for i, f in enumerate(funcs)}
    for f in funcs:  # grows until closed under composition
        for g in funcs[: len(known)]:
            for h in (tuple(g[q] for q in f), tuple(f[q] for q in g)):
                if h not in known:
                    known[h] = len(funcs)
                    funcs.append(h)
    n = len(funcs)
    product = np.array([[known.get(tuple(g[q] for q in f), -1) for g in funcs] for f in funcs], np.int64)
    if product.min() < 0:
        raise AssertionError("transition functions are not closed under composition")
    return nxt.ravel(), starts.ravel(), np.array(symbol_fn, np.int64), np.concatenate(([n, known[tuple(range(8))]], np.array(funcs).ravel(), product.ravel()))


def _slice_starts(symbols: np.ndarray, width: int = 256) -> np.ndarray:
    """Where slices start, by an associative scan: block products, scan over blocks, side-by-side steps."""
    nxt, starts, symbol_fn, packed = _automaton()
    n, idle = int(packed[0]), int(packed[1])
    funcs = packed[2 : 2 + 8 * n].reshape(n, 8)
    product = packed[2 + 8 * n :].astype(np.int32)
    blocks = -(-len(symbols) // width)
    padded = np.full(blocks * width, _END, np.uint8)
    padded[: len(symbols)] = symbols
    columns = np.ascontiguousarray(padded.reshape(blocks, width).T)
    fn = symbol_fn.astype(np.int32)
    f = np.full(blocks, idle, np.int32)
    for col in columns:
        f = product[f * np.int32(n) + fn[col]]
    state = np.empty(blocks, np.uint8)
    q = _FRESH
    for i, step in enumerate(funcs[f].tolist()):
        state[i] = q
        q = step[q]
    out = np.empty((width, blocks), bool)
    for j, col in enumerate(columns):
        at = state * np.uint8(9) + col
        out[j] = starts[at]
        state = nxt[at]
    return out.T.ravel()[: len(symbols)]


def _symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sym = _classes()[points]
    sym[ends] = _END
    white = np.flatnonzero(sym == _INNER)
    after = sym[np.minimum(white + 1, len(sym) - 1)]
    last = white[(after != _INNER) & (after != _END)]
    sym[last] = np.where(points[last] == 0x20, _SPACE, _BLANK)
    quote = np.flatnonzero((points == ord("'")) & (sym == _OTHER))
    if len(quote):
        one = points[np.minimum(quote + 1, len(points) - 1)]
        two = points[np.minimum(quote + 2, len(points) - 1)]
        sym[quote[np.isin(one, [ord(c) for c in SHORT])]] = _TWO
        for a, b in LONG:
            sym[quote[(one == ord(a)) & (two == ord(b))]] = _THREE
    return sym


def pieces(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """All slices of the texts in order, and each text's first slice (one entry more than texts)."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    sym = _symbols(points, ends)
    cut = np.flatnonzero(_slice_starts(sym))
    is_end = sym[cut] == _END
    stop = np.append(cut[1:], len(points))
    first = np.concatenate(([0], np.cumsum(~is_end)[is_end]))
    return [joined[a:b] for a, b in zip(cut[~is_end].tolist(), stop[~is_end].tolist())], first


class Encoder(dict):
    """Slice to little-endian unsigned 32-bit ids; a bounded cache filled by rank merging."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.byte_ids = [self.ranks[bytes([i])] for i in range(256)]
        self.pairs = {
            (self.ranks[token[:i]] << 20) | self.ranks[token[i:]]: rank
            for token, rank in self.ranks.items() for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        }
        size = max(self.ranks.values()) + 1
        vocab = [b""] * size
        for token, rank in self.ranks.items():
            vocab[rank] = token
        self.lengths = np.fromiter(map(len, vocab), np.int64, size)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(vocab), np.uint8)

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "surrogatepass")
        rank = self.ranks.get(raw)
        ids = [rank] if rank is not None else self.merge([self.byte_ids[b] for b in raw])
        out = np.array(ids, "<u4").tobytes()
        if len(raw) <= _CACHED_LENGTH:
            if len(self) >= _CACHE_PIECES:
                self.clear()
            self[piece] = out
        return out

    def merge(self, ids: list[int]) -> list[int]:
        """Merge the leftmost pair of lowest rank until none is left."""
        if len(ids) > 256:
            return self._merge_long(ids)
        none = 1 << 30
        get = self.pairs.get
        ranks = [get(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (m := min(ranks)) < none:
            i = ranks.index(m)
            ids[i : i + 2] = [m]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 20 | m, none)
            if i < len(ranks):
                ranks[i] = get(m << 20 | ids[i + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same in n log n, over a linked list with a heap of pairs."""
        n, get = len(ids), self.pairs.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (r := get(rank << 20 | ids[k])) is not None:
                    heapq.heappush(heap, (r, i, rank, ids[k]))
            h = before[i]
            if h >= 0 and (r := get(ids[h] << 20 | rank)) is not None:
                heapq.heappush(heap, (r, h, ids[h], rank))
        return [x for x in ids if x >= 0]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        found, first = pieces(texts)
        ids = list(map(self.__getitem__, found))
        return [b"".join(ids[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of each token in its text, and the text's length."""
        return np.concatenate(([0], np.cumsum(self.lengths[ids])))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """Tokens written at their offsets."""
        out = []
        for lo in range(0, len(ids), _CHUNK):
            part, at = ids[lo : lo + _CHUNK], offsets[lo : lo + _CHUNK + 1]
            shift = np.repeat(self.places[part] - at[:-1], np.diff(at))
            out.append(self.blob[shift + np.arange(at[0], at[-1])].tobytes())
        return b"".join(out)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per vocabulary in each Python worker."""
    return Encoder(path)


def _text_chunks(texts: list[str]) -> Iterator[list[str]]:
    held, chars = [], 0
    for t in texts:
        if held and chars + len(t) > _CHUNK:
            yield held
            held, chars = [], 0
        held.append(t)
        chars += len(t) + 1
    if held:
        yield held


def _encoded(column: pa.Array, path: str) -> Iterator[tuple[bytes, np.ndarray]]:
    """Id bytes and token offsets of each row; a null text is an empty one."""
    enc = encoder(path)
    for chunk in _text_chunks([t or "" for t in column.to_pylist()]):
        for raw in enc.encode(chunk):
            yield raw, enc.offsets(np.frombuffer(raw, "<u4"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids array<int>, offsets array<long>``: token ids and each token's byte offset, with the
    text's byte length last.  Null text: as an empty one, no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_encoded(batch.column(1), path))
            ids = pa.array([np.frombuffer(r, "<i4") for r, _ in rows], pa.list_(pa.int32()))
            offsets = pa.array([o for _, o in rows], pa.list_(pa.int64()))
            yield pa.record_batch([batch.column(0), ids, offsets], names=[id_col, "ids", "offsets"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, offsets array<long>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """``id, raw binary``: the bytes of ``encode``'s rows.  Null ids: null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            raw = [
                None if i is None else enc.decode(np.array(i, np.int64), np.array(o, np.int64))
                for i, o in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            yield pa.record_batch([batch.column(0), pa.array(raw, pa.binary())], names=[id_col, "raw"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids", "offsets").mapInArrow(run, f"`{id_col}` {kind}, raw binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, encoded and decoded again in
    one pass without leaving the task.  Null text: as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            n, ids_sha, raw_sha = [], [], []
            for raw, offsets in _encoded(batch.column(1), path):
                n.append(len(raw) // 4)
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                raw_sha.append(hashlib.sha256(enc.decode(np.frombuffer(raw, "<u4"), offsets)).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(raw_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

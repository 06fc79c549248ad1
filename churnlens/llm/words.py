"""Vectorised word offsets and hashes over batches of documents (runs inside Arrow tasks).

A *word* is a run of bytes outside 0x20 and 0x09-0x0D, so words never depend on the locale.  A batch
of documents is held as one byte buffer in which words are separated by exactly one space; every
shingle of consecutive words of a document is then one contiguous slice of that buffer.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

# XXH64 constants (fixed values of the published algorithm).
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; a null text is an empty one."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(texts: Sequence[bytes], max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``max_bytes`` each (one longer document is a range of its own)."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > max_bytes:
            yield start, i
            start, held = i, 0
        held += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


@dataclass
class Words:
    """Words of several documents: slices ``buf[starts[i]:ends[i]]``; document ``d`` owns words
    ``first[d]:first[d + 1]``."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def split_words(texts: Sequence[bytes], lower: bool = False) -> Words:
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    doc_start = np.concatenate(([0], np.cumsum(lens + 1)))[:-1]
    space = _SPACE[joined]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    keep = ~(space & before)  # one space after each word, none elsewhere
    buf = (_LOWER[joined] if lower else joined)[keep]
    buf[space[keep]] = 0x20
    at = np.cumsum(keep) - 1  # place of each kept byte
    starts = at[~space & before]
    ends = at[space & ~before]
    word_from = np.flatnonzero(~space & before)
    first = np.concatenate((np.searchsorted(word_from, doc_start), [len(word_from)]))
    return Words(buf, starts, ends, first)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of each slice of ``buf`` (slices of 32 bytes and more go to the library one by one)."""
    lens = ends - starts
    out = np.empty(len(starts), dtype=np.uint64)
    long = np.flatnonzero(lens >= 32)
    if len(long):
        raw = buf.tobytes()
        digest = xxhash.xxh64_intdigest
        out[long] = np.fromiter(
            (digest(raw[a:b], seed) for a, b in zip(starts[long].tolist(), ends[long].tolist())), np.uint64, len(long)
        )
    short = np.flatnonzero(lens < 32)
    if not len(short):
        return out
    padded = np.concatenate((buf, np.zeros(8, dtype=np.uint8)))
    u64 = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    u32 = np.ndarray((len(padded) - 3,), "<u4", padded, strides=(1,))
    at, left = starts[short].copy(), lens[short].copy()
    h = np.uint64(seed) + _P5 + left.astype(np.uint64)
    with np.errstate(over="ignore"):
        for _ in range(3):
            m = np.flatnonzero(left >= 8)
            if not len(m):
                break
            k = _rotl(u64[at[m]] * _P2, 31) * _P1
            h[m] = _rotl(h[m] ^ k, 27) * _P1 + _P4
            at[m] += 8
            left[m] -= 8
        m = np.flatnonzero(left >= 4)
        h[m] = _rotl(h[m] ^ (u32[at[m]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at[m] += 4
        left[m] -= 4
        for _ in range(3):
            m = np.flatnonzero(left > 0)
            if not len(m):
                break
            h[m] = _rotl(h[m] ^ (padded[at[m]].astype(np.uint64) * _P5), 11) * _P1
            at[m] += 1
            left[m] -= 1
        h ^= h >> np.uint64(33)
        h *= _P2
        h ^= h >> np.uint64(29)
        h *= _P3
        h ^= h >> np.uint64(32)
    out[short] = h
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads every input bit over the word."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def window_hashes(word_hash: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of ``width`` consecutive word hashes (windows may straddle documents;
    callers mask those)."""
    n = len(word_hash) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            h = h * np.uint64(0xD6E8FEB86659FD93) + word_hash[k : k + n]
    return mix64(h)


def window_starts(words: Words, width: int) -> np.ndarray:
    """True at each word at which a window of ``width`` words of its document starts; as long as
    ``window_hashes`` returns."""
    n = len(words.starts) - width + 1
    if n <= 0:
        return np.empty(0, dtype=bool)
    end = np.repeat(words.first[1:], words.counts)[:n]
    return np.arange(n) + width <= end

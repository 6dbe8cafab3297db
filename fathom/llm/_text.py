"""Numpy helpers that work on many texts at once inside a task."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


#: Longer spans are hashed whole, one by one.
_LONG = 64


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each symbols[start:end]; spans of equal content get equal values."""
    size = ends - starts
    out = size.astype(np.uint64)
    live = np.flatnonzero((size > 0) & (size <= _LONG))
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = int.from_bytes(blake2b(symbols[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    at, left = starts[live], size[live]
    with np.errstate(over="ignore"):
        while live.size:
            out[live] = (out[live] ^ symbols[at].astype(np.uint64)) * _MIX1 + _BASE
            left = left - 1
            more = left > 0
            live, at, left = live[more], at[more] + 1, left[more]
        return mix(out)


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each (one row at least)."""
    if not batch.num_rows:
        return
    text = batch.column(batch.schema.get_field_index(column))
    size = np.fromiter((0 if x is None else x for x in _bytes(text)), np.int64, len(text))
    part = np.cumsum(size) // limit
    cut = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(text)], strict=True):
        yield batch.slice(a, b - a)


def _bytes(text: pa.Array) -> list:
    import pyarrow.compute as pc

    return pc.binary_length(text).to_pylist()


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a column; null counts as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def numbers(batch: pa.RecordBatch, column: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(column))


#: Bytes of words: ASCII letters and digits, and everything outside ASCII.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def join(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts with a line break after each, ASCII letters in lower case, and where each begins."""
    blobs = [t.encode("utf-8", "replace").lower() for t in texts]
    edge = np.cumsum([0] + [len(b) + 1 for b in blobs])
    return np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8), edge


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, number of its text, place) of each word, in order. A word is a longest run of ASCII letters, digits and
    non-ASCII characters, with ASCII letters in lower case; the place counts bytes of ``join(texts)``."""
    buf, edge = join(texts)
    inside = _WORD[buf]
    change = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, ends = change[::2], change[1::2]
    return span_hashes(buf, starts, ends), np.searchsorted(edge, starts, "right") - 1, starts


def shingles(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number of its text) of each run of ``width`` words; a text of fewer words, but one at least, has one
    shingle of all its words."""
    h, doc, _ = words(texts)
    count = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), np.int64)
    first = np.cumsum(count) - count
    with np.errstate(over="ignore"):
        if len(h) >= width:
            n = len(h) - width + 1
            run = np.zeros(n, np.uint64)
            for k in range(width):
                run = mix(run + h[k : k + n] + np.uint64(k))
            ok = doc[:n] == doc[width - 1 :]
            run, of = run[ok], doc[:n][ok]
        else:
            run, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero((count > 0) & (count < width))
        extra = np.zeros(len(short), np.uint64)
        for k in range(width):
            has = count[short] > k
            at = np.minimum(first[short] + k, max(0, len(h) - 1))
            extra = np.where(has, mix(extra + (h[at] if len(h) else np.uint64(0)) + np.uint64(k)), extra)
    return np.concatenate([run, extra]), np.concatenate([of, short])

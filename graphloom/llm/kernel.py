"""Vectorised text kernels over Arrow string buffers.

Texts are handled as the UTF-8 bytes that Arrow already holds; no Python string is made for a
document unless an operator asks for it. Every function works on a chunk: a run of whole texts of
about ``CHUNK`` bytes (a single longer text is a chunk of its own), so that the 8-byte temporaries
stay small whatever size the Arrow batches have.

Nulls count as empty texts.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20

U64 = np.uint64
#: Odd multiplier of the polynomial over bytes, with its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def string_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets into them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of whole texts of about ``limit`` bytes."""
    data, offs = string_buffers(texts)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


#: Bytes in an Arrow batch that goes to a Python worker. Batches are held by the JVM and by Python at
#: once, so with long texts Spark's own limit would be most of an executor's memory.
BATCH_BYTES = 8 << 20


def release() -> None:
    """Gives memory that Arrow and malloc hold for later back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def _releasing(function):
    def run(batches):
        release()
        try:
            yield from function(batches)
        finally:
            release()

    return run


def map_arrow(df, function, schema: str):
    """``df.mapInArrow``, with the session's batches limited to ``BATCH_BYTES`` (a session that has a lower limit keeps it)."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = df.sparkSession.conf.get(name).strip().lower().removesuffix("b")
    if not held.isdigit() or not 0 < int(held) <= BATCH_BYTES:
        df.sparkSession.conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(_releasing(function), schema)


def byte_table(separators: bytes) -> np.ndarray:
    """For each byte, whether it belongs to a word."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Bytes of ``[^\x20\x09-\x0D]+`` and of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
NOT_SPACE = byte_table(bytes([0x20, *range(0x09, 0x0E)]))
ALNUM = byte_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def word_bounds(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in the chunk, and for text i its words' range ``[of[i], of[i + 1])``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = table[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offs[:-1][offs[:-1] < offs[1:]]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges[1:] - 1] = inside[edges[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


#: Powers of the base and of its inverse, for the bytes of one chunk.
with np.errstate(over="ignore"):
    _powers = np.concatenate([np.ones(1, U64), np.cumprod(np.full(CHUNK, _BASE, U64), dtype=U64)])
    _inverses = np.concatenate([np.ones(1, U64), np.cumprod(np.full(CHUNK, _BASE_INVERSE, U64), dtype=U64)])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(33))
        x *= U64(0xFF51AFD7ED558CCD)
        x ^= x >> U64(33)
        x *= U64(0xC4CEB9FE1A85EC53)
        x ^= x >> U64(33)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """``s`` with ``s[j] - s[i]`` the polynomial of bytes i to j, up to a factor that depends on i; of ``CHUNK`` bytes at most."""
    sums = np.zeros(len(data) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(U64) + U64(1)) * _powers[: len(data)], out=sums[1:])
    return sums


def _finish(polynomial: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(polynomial + sizes.astype(U64) * U64(0xD6E8FEB86659FD93))


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal spans have equal hashes wherever they stand."""
    with np.errstate(over="ignore"):
        return _finish((sums[ends] - sums[starts]) * _inverses[starts], ends - starts)


def _long_hash(data: np.ndarray) -> np.ndarray:
    """The hash of a span of any size."""
    total, factor = 0, 1
    for lo in range(0, len(data), CHUNK):
        part = data[lo : lo + CHUNK]
        total += factor * int(prefix_sums(part)[-1])
        factor = factor * pow(_BASE, len(part), 1 << 64) % (1 << 64)
    return _finish(np.array([total % (1 << 64)], U64), np.array([len(data)]))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each word: the words of ``CHUNK`` bytes at a time, so that the temporaries are small however long a text is."""
    out = np.zeros(len(starts), U64)
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = int(np.searchsorted(ends, base + CHUNK, side="right"))
        if hi > lo:
            sums = prefix_sums(data[base : int(ends[hi - 1])])
            out[lo:hi] = span_hashes(sums, starts[lo:hi] - base, ends[lo:hi] - base)
        else:  # a word that is longer
            hi = lo + 1
            out[lo] = _long_hash(data[base : int(ends[lo])])[0]
        lo = hi
    return out


def pieces(data: np.ndarray, table: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Where a text is cut into pieces of at most ``limit`` bytes: before a byte that belongs to no word, if a piece has one."""
    lo = 0
    while lo < len(data):
        hi = min(lo + limit, len(data))
        if hi < len(data):
            outside = np.flatnonzero(~table[data[lo + 1 : hi]])
            hi = lo + 1 + int(outside[-1]) if len(outside) else hi
        yield lo, hi
        lo = hi


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of words i to i + k, for every i that has k words from it on in the array."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        total = words[:n].copy()
        for j in range(1, k):
            total *= U64(0x2545F4914F6CDD1D)
            total += words[j : j + n]
    return mix(total)

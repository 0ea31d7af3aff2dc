"""Vectorised text kernels for use inside tasks: hashes of words, grams and byte spans of an Arrow column."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20260101))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_RNG.integers(1, 1 << 62)) * 4 + 3
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

#: A-Z to a-z, every other byte to itself.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def give_back() -> None:
    """Returns freed memory to the system. Workers outlive their tasks: what one keeps, those of the next stage lack."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task of a `mapInArrow`, which gives back what the stage before has left, and its own memory when it ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from task(batches)
        give_back()

    return run


def lean_group(task: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The function of an `applyInArrow`, which gives back what each group took: a worker may stand idle after the last one."""

    def run(group: pa.Table) -> pa.Table:
        out = task(group)
        give_back()
        return out

    return run


def lean_cogroup(task: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same for two tables."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = task(left, right)
        give_back()
        return out

    return run


def members(pattern_bytes: list[int]) -> np.ndarray:
    """Lookup table of the bytes that belong to words."""
    out = np.zeros(256, dtype=bool)
    out[pattern_bytes] = True
    return out


#: Everything but white space; letters, digits and all bytes of characters beyond ASCII.
NOT_SPACE = members([b for b in range(256) if b not in (9, 10, 11, 12, 13, 32)])
ALNUM = members([*range(48, 58), *range(97, 123), *range(128, 256)])


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... n modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        size = max(n + 1, 1 << 16)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all 64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix(codes: np.ndarray) -> np.ndarray:
    """Running polynomial hash of bytes, from which that of any span follows."""
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[codes] * powers(_BASE, len(codes))[: len(codes)], out=out[1:])
    return out


def span_hash(run: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from start to end; equal bytes give equal hashes wherever they stand."""
    return mix((run[end] - run[start]) * powers(_INVERSE, len(run))[start])


def every_hash(run: np.ndarray, n: int) -> np.ndarray:
    """`span_hash` of all spans of n bytes, in order."""
    return mix((run[n:] - run[:-n]) * powers(_INVERSE, len(run))[: len(run) - n])


def chained(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive elements, in order."""
    out = np.zeros(max(len(h) - n + 1, 0), dtype=np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + len(out)]
    return mix(out)


def pieces(texts: pa.Array, limit: int = 1 << 21, rows: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of stretches of about `limit` bytes; null is empty; a longer text is alone."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = min(max(int(np.searchsorted(off, off[a] + limit, "right")) - 1, a + 1), a + rows, len(texts))
        yield a, b, data[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def word_spans(codes: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of `inside` bytes; none crosses from one text into the next."""
    is_in = inside[codes]
    first, last = is_in.copy(), is_in.copy()
    first[1:] &= ~is_in[:-1]
    last[:-1] &= ~is_in[1:]
    full = off[:-1] < off[1:]
    first[off[:-1][full]] = is_in[off[:-1][full]]
    last[off[1:][full] - 1] = is_in[off[1:][full] - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(off, start, "right") - 1

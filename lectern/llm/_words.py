"""Word-level helpers shared by the corpus operators; they run inside Spark tasks on Arrow batches."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple, TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

T = TypeVar("T")

#: Text bytes that one numpy step handles at a time; a longer document makes a step of its own.
SLICE_BYTES = 8 << 20


def keep_freed_memory(size: int = 32 << 20, total: int = 256 << 20) -> None:
    """Let this worker process use freed memory again for arrays of up to `size`, instead of giving it back to the
    system and asking for zeroed pages each time, which costs numpy more than the work on arrays of some 100 KB."""
    set_option = getattr(ctypes.CDLL(None), "mallopt", None)  # glibc alone
    if set_option:
        set_option(-3, size)
        set_option(-1, total)


def per_worker(make: Callable[[], T]) -> T:
    """What `make` returns, made once in each worker process: functions and their globals arrive anew with each task."""
    held = sys.modules.setdefault("_lectern_held", types.ModuleType("_lectern_held"))
    name = f"{make.__module__}.{make.__qualname__}"
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


class Words(NamedTuple):
    """Words of some texts, in order. ids index vocab; text i has ids[starts[i]:starts[i + 1]]."""

    ids: np.ndarray
    starts: np.ndarray
    vocab: pa.Array


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece holds about `limit` bytes of `column`, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Words `[^\\x20\\x09-\\x0D]+` of each text; a null text has none. lower: A-Z only."""
    texts = pc.fill_null(texts, "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = split.flatten()
    full = pc.not_equal(flat, "")
    count = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(full.to_numpy(zero_copy_only=False), out=count[1:])
    offsets = split.offsets.to_numpy()
    coded = pc.dictionary_encode(flat.filter(full))
    return Words(coded.indices.to_numpy(), count[offsets - offsets[0]], coded.dictionary)


def hashes(values: pa.Array) -> np.ndarray:
    """64-bit hashes of strings, the same in every task."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, values.cast(pa.binary()).to_numpy(zero_copy_only=False)), np.uint64, len(values))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: An odd multiplier for rolling hashes modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def rolling(values: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of each window of `width` values inside one text, and the windows' first positions.

    One running sum of value * base**-position gives each window as a difference, brought to the same power.
    """
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(INVERSE, n), out=sums[1:])
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(n)
    at = np.flatnonzero(left >= width)
    return mixed((sums[at + width] - sums[at]) * powers(BASE, n)[at]), at


def per_text(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of flags within each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[starts[1:]] - sums[starts[:-1]]


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of values within each text; each text's are added up by themselves."""
    out = np.zeros(len(starts) - 1)
    some = np.flatnonzero(np.diff(starts))
    if len(some):
        out[some] = np.add.reduceat(values, starts[some])
    return out


def covered(first: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n positions lie in a span [first, first + length)."""
    step = np.bincount(first, minlength=n + 1)[: n + 1].astype(np.int64)
    step -= np.bincount(first + length, minlength=n + 1)[: n + 1]
    return np.cumsum(step[:n]) > 0

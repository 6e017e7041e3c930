"""Words, lines and hashes of a batch of texts, as numpy arrays over their UTF-8 bytes.

A batch is the bytes of many texts end to end plus their offsets, the layout of an
Arrow string column. A word is a run of bytes other than space and ``\\t\\n\\v\\f\\r``.
Hashes are 64 bits wide; equal hashes are taken for equal content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000
BLOCK_BYTES = 1_000_000

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, dtype=kind, count=len(column) + 1, offset=column.offset * kind().itemsize) if len(column) else np.zeros(1, kind)
    at = at.astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(at), np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch by rows, so that a part has at most ``limit`` bytes of text or one row."""
    _, at = utf8(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of batches, in order, in parts of about ``limit`` bytes at most or one row."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, column, limit):
            if held and size + part.nbytes > limit:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(part)
            size += part.nbytes
    if held:
        yield pa.concat_batches(held)


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the offsets of each text's words among them."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(SPACE[data], out=inside[1:-1])
    fresh = np.zeros(len(data) + 1, dtype=bool)
    fresh[at] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | fresh[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | fresh[1:])) + 1
    return starts, ends, np.searchsorted(starts, at)


def line_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each ``\\n``-split line, and the offsets of each text's lines."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([at[:-1], breaks + 1])
    ends = np.concatenate([breaks, at[1:]])
    owner = np.concatenate([np.arange(len(at) - 1), np.searchsorted(at, breaks, side="right") - 1])
    # a text's first line comes before the lines that its line breaks begin
    order = np.argsort(starts * 2 + (np.arange(len(starts)) >= len(at) - 1), kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    starts, owner = starts[order], owner[order]
    lasts = np.concatenate([np.searchsorted(at, breaks, side="right") - 1, np.arange(len(at) - 1)])
    ends = ends[np.argsort(lasts, kind="stable")]
    return starts, ends, np.searchsorted(owner, np.arange(len(at)))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes; spans are in order and do not overlap.

    A span's polynomial is the difference of two prefix sums, shifted back to its own
    start. Blocks of spans keep the prefix sums short.
    """
    out = np.zeros(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        low = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, low + BLOCK_BYTES, side="right")))
        high = int(ends[last - 1])
        powers = np.full(high - low + 1, BASE, dtype=np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODES[data[low:high]] * powers[:-1], out=sums[1:])
        powers.fill(BASE_INVERSE)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((sums[e] - sums[s]) * powers[s] + (e - s).astype(np.uint64))
        first = last
    return out


def windows(hashes: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words within a text, its text, and its first word."""
    count = np.maximum(np.diff(at) - size + 1, 0)
    owner = np.repeat(np.arange(len(count)), count)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + at[:-1][owner]
    out = np.zeros(len(owner), dtype=np.uint64)
    for k in range(size):
        out = mix(out + hashes[first + k] * np.uint64(2 * k + 1))
    return out, owner, first


def per_text(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of true positions of each text."""
    sums = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def repeats(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: does its text have an equal one anywhere; does it have one before."""
    order = np.lexsort((hashes, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    anywhere, before = np.zeros(len(owner), bool), np.zeros(len(owner), bool)
    before[order[1:]] = same
    anywhere[order[1:]] = same
    anywhere[order[:-1]] |= same
    return anywhere, before

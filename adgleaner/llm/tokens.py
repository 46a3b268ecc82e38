"""Words of many texts at once, as places in their bytes and as 64-bit hashes.

A word is hashed by its eight-byte blocks, each mixed before the next is added. Words of
up to eight bytes and of one length never share a hash; no word has a structure, as a sum of
powers has, by which others with its hash can be written down.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
# A longer word is hashed on its own.
_LONG = 4096


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes in this order."""
    return mix(a * _ODD + b)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Which bytes lie in one of some ranges, ends included."""
    out = np.zeros(256, bool)
    for first, last in ranges:
        out[first : last + 1] = True
    return out


BLANK = byte_set((9, 13), (32, 32))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some texts, one after the other, and where each begins; the last number is the end."""
    kind = pa.large_binary()
    a = texts.cast(pa.large_string()).cast(kind) if pa.types.is_string(texts.type) else texts.cast(kind)
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_places(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, ...]:
    """First byte of each word, the byte after its last, and its text. A word is a run of bytes that are `inside`."""
    member = inside[data]
    before = np.zeros(len(data), bool)
    before[1:] = member[:-1]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    before[edge] = False
    after = np.zeros(len(data), bool)
    after[:-1] = member[1:]
    after[edge - 1] = False
    first = np.flatnonzero(member & ~before)
    end = np.flatnonzero(member & ~after) + 1
    return first, end, np.searchsorted(offsets, first, side="right") - 1


def word_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - first
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    # Of a block that is not full, the bytes beyond the word do not count.
    full = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    with np.errstate(over="ignore"):
        h = mix((eight[first] & full[np.minimum(size, 8)]) ^ mix(size.astype(np.uint64)))
        more, at = np.flatnonzero((size > 8) & (size <= _LONG)), 8
        while len(more):
            h[more] = joined(h[more], eight[first[more] + at] & full[np.minimum(size[more] - at, 8)])
            at += 8
            more = more[size[more] > at]
    for i in np.flatnonzero(size > _LONG):
        digest = hashlib.blake2b(data[first[i] : end[i]], digest_size=8).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def slices(batch: pa.RecordBatch, column: str, most: int) -> list[pa.RecordBatch]:
    """Parts of a batch with about so many bytes of text each; one text is never cut."""
    _, offsets = text_bytes(batch[column])
    cuts, start = [0], 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        start = max(min(stop, batch.num_rows), start + 1)
        cuts.append(start)
    return [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]

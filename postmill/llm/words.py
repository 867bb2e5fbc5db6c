"""Words of whole texts as numpy arrays, for code inside Arrow tasks.

A text is read as UTF-8 bytes. A word is a run of bytes of one set; the sets in use contain either
all bytes above 0x7F or none, so a word is never cut inside a character. A-Z count as a-z.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
LONG_WORD = 48


def byte_set(excluded: list[tuple[int, int]]) -> np.ndarray:
    """All bytes but those in the ranges (both ends included)."""
    table = np.ones(256, dtype=bool)
    for low, high in excluded:
        table[low : high + 1] = False
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = byte_set([(0x20, 0x20), (0x09, 0x0D)])
ALPHANUMERIC = byte_set([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = np.uint64(0xD6E8FEB86659FD93)


class Words(NamedTuple):
    """``first[d] .. first[d+1]`` are the words of text d; ``start``, ``end`` are bytes of ``data``."""

    data: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, with the end last; null is empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, data = texts.buffers()
    if not len(texts) or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(places, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


def _hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    order = np.argsort(-np.minimum(length, LONG_WORD + 1).astype(np.int16), kind="stable")
    begin, out = start[order], np.zeros(len(start), dtype=np.uint64)
    short = np.minimum(length, LONG_WORD)
    longer = len(start) - np.cumsum(np.bincount(short, minlength=LONG_WORD + 1))
    for j in range(LONG_WORD):
        n = longer[j]
        if not n:
            break
        out[:n] = out[:n] * BASE + BYTE_VALUES[data[begin[:n] + j]]
    result = np.empty_like(out)
    result[order] = out
    for i in np.flatnonzero(length > LONG_WORD):
        digest = hashlib.blake2b(data[start[i] : start[i] + length[i]].tobytes(), digest_size=8).digest()
        result[i] = np.uint64(int.from_bytes(digest, "little"))
    return mixed(result ^ (length.astype(np.uint64) << np.uint64(1)))


def words(texts: pa.Array, members: np.ndarray) -> Words:
    body, at = raw(texts)
    data = LOWER[body]
    inside = members[data]
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = at[:-1][at[:-1] < at[1:]]
        begins[edges] = inside[edges]
        last = at[1:][at[:-1] < at[1:]] - 1
        ends[last] = inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, np.searchsorted(start, at), start, end, _hashes(data, start, end - start))


def slices(batch: pa.RecordBatch, column: str | None = None, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` of about ``limit`` bytes of text; one longer text is a part of its own.

    The text is that of ``column``, or else of :func:`text_in`.
    """
    _, at = raw(named(batch, column) if column else text_in(batch))
    row = 0
    while row < batch.num_rows:
        stop = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield batch.slice(row, stop - row)
        row = stop


def text_in(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch: its column ``_text``, or the field ``text`` of its column ``row``."""
    at = batch.schema.get_field_index("_text")
    return batch.column(at) if at >= 0 else batch.column(batch.schema.get_field_index("row")).field("text")


def named(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))

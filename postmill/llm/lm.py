"""Language-model scores from a log-frequency Bloom filter.

Counting. Texts are cut into slices; a slice sends its distinct words and pairs of neighbouring
words, with their counts in training texts, to buckets by hash. Each task's slice sends a word
once however often it has it, so no word is a hot key. Buckets follow the size of the input.

Filter. Each bucket of words or pairs owns a segment of the filter. An entry of count c is
quantised to level q = 1 + floor(log_b c) and put in at levels 1 to q; a reader asks for level after
level until one is missing. A segment has as many bits as its entries need, so each goes in at all
its levels and the filter grows with the corpus. For that reason it is not broadcast: the entries of a slice have
come to their segment already, are looked up there, and their levels go back to the slice, a byte
each, with the exact counts of its words, from which the base score is made. This is one way at every size.

Score: log10 of the product of p(w | v) = L c(v w) / c(v) + (1 - L) p(w) over a text's words and its
end, with the counts that the filter gives and p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)).

Null and empty texts are one end. An id of null is treated as an empty id. Rows equal in id and text
have equal scores; a repeated row counts as often as it is there. A long text is a slice by itself.
There are no ties. Without training texts N and V are 0 and every token is unknown. An empty table gives
no rows. Columns beside id and text play no part. ``docs`` is read twice, and must give its rows in the same
order both times, as stored tables do; if it does not, the job fails.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stored, text_of
from .words import NOT_SPACE, Words, mixed, named, slices, words

HELD_OUT = (10, 0)
ADDED = 0.1
SLICE = 5 << 20
BUCKET_BYTES = 4 << 20  # of text
LEAST_BUCKETS = 64  # of pairs; words have a quarter of them
WORD_BITS = 1 << 16
PAIR_BITS = 1 << 16
PROBES = 6
WORD_BASE, PAIR_BASE = 1.2, 2.0
PAIR_WEIGHT = 0.15

END = mixed(np.array([0x454E44], dtype=np.uint64))[0]
BEGIN = mixed(np.array([0x424547], dtype=np.uint64))[0]
LEVEL = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64((1 << 48) - 1)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null counts as the empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")), F.lit(modulus))


def tokens(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with one end after each text, the token before each, and the text of each."""
    n_docs = len(w.first) - 1
    ends = w.first[1:] + np.arange(n_docs)
    out = np.full(len(w.hash) + n_docs, END, dtype=np.uint64)
    doc = np.repeat(np.arange(n_docs), np.diff(w.first) + 1)
    is_word = np.ones(len(out), dtype=bool)
    is_word[ends] = False
    out[is_word] = w.hash
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[w.first[:-1] + np.arange(n_docs)] = BEGIN
    return out, before, doc


def pair(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(0xC2B2AE3D27D4EB4F) + token)


def levels(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(base) + 1e-9).astype(np.int64)


def count_at(level: np.ndarray, base: float) -> np.ndarray:
    """The count that a level stands for: the middle of its interval on the log scale; 0 for level 0."""
    low = base ** (level - 1.0)
    top = np.maximum(np.ceil(low * base - 1e-9) - 1, np.ceil(low - 1e-9))
    return np.where(level > 0, np.sqrt(np.ceil(low - 1e-9) * top), 0.0)


def bit_places(found: np.ndarray, level: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits of an entry's probes within its segment of ``bits``, one probe after the other."""
    x = mixed(found + level * LEVEL)
    step = (x >> np.uint64(32)) | np.uint64(1)
    for _ in range(PROBES):
        yield (x & np.uint64(bits - 1)).astype(np.int64)
        x = x + step


def room_for(counts: np.ndarray, base: float, least: int) -> int:
    """Bits of a segment, ``least`` or that times a power of two, that has room for all entries at all levels."""
    inserts, size = int(levels(counts, base).sum()), least
    while int(size * math.log(2) / PROBES) < inserts:
        size *= 2
    return size


def segment(found: np.ndarray, counts: np.ndarray, base: float, size: int) -> bytes:
    """A filter of ``size`` bits, half of them set at most, holding each entry at its levels."""
    bits = np.zeros(size, dtype=bool)
    level = levels(counts, base)
    every = np.repeat(found, level)
    each = (np.arange(len(every)) - np.repeat(np.cumsum(level) - level, level) + 1).astype(np.uint64)
    for places in bit_places(every, each, size):
        bits[places] = True
    return np.packbits(bits, bitorder="little").tobytes()


def read_levels(table: np.ndarray, found: np.ndarray, buckets: int, size: int, highest: int) -> np.ndarray:
    """The level of each entry, by asking for one level after the other until one is missing."""
    level = np.zeros(len(found), dtype=np.int64)
    begin = ((found >> np.uint64(48)) % np.uint64(buckets)).astype(np.int64) * size
    entry, open_ = found & LOW, np.arange(len(found))
    for asked in range(1, highest + 1):
        hit = np.ones(len(open_), dtype=bool)
        left = np.arange(len(open_))
        first = begin[open_]
        x = mixed(entry[open_] + np.array([asked], dtype=np.uint64) * LEVEL)
        step = (x >> np.uint64(32)) | np.uint64(1)
        for _ in range(PROBES):
            at = first[left] + (x[left] & np.uint64(size - 1)).astype(np.int64)
            there = (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            hit[left[~there]] = False
            left = left[there]
            x = x + step
        open_ = open_[hit]
        if not len(open_):
            break
        level[open_] = asked
    return level


class Scorer(NamedTuple):
    """The scores of texts from what the buckets tell of their words and pairs."""

    n: int
    v: int
    n_docs: int

    def scores(self, slice_: Slice, counts: np.ndarray, word_levels: np.ndarray, pair_levels: np.ndarray) -> tuple[np.ndarray, ...]:
        """Tokens, known tokens, base score and score of each text; the rest is by distinct word or pair."""
        token, doc, n = slice_.token, slice_.doc, slice_.n_docs
        whole = self.n + ADDED * (self.v + 1)
        base = np.log10((counts + ADDED) / whole)[token]
        count = count_at(word_levels, WORD_BASE)
        single = (count[token] + ADDED) / whole
        context = np.zeros(len(token))
        context[1:] = count[token[:-1]]
        context[slice_.begins] = self.n_docs
        joint = count_at(pair_levels, PAIR_BASE)[slice_.pair]
        follows = np.minimum(joint, context) / np.maximum(context, 1)
        p = np.where(context > 0, PAIR_WEIGHT * follows + (1 - PAIR_WEIGHT) * single, single)
        known = np.bincount(doc, weights=(counts > 0)[token], minlength=n).astype(np.int64)
        return np.bincount(doc, minlength=n), known, np.bincount(doc, weights=base, minlength=n), np.bincount(doc, weights=np.log10(p), minlength=n)


class Slice(NamedTuple):
    """Distinct words and pairs of some texts, sorted, and of each token which they are."""

    words: np.ndarray
    pairs: np.ndarray
    token: np.ndarray
    pair: np.ndarray
    doc: np.ndarray
    begins: np.ndarray
    n_docs: int

    @staticmethod
    def of(texts: pa.Array) -> Slice:
        token, before, doc = tokens(words(texts, NOT_SPACE))
        found, own = np.unique(token, return_inverse=True)
        pairs, own_pair = np.unique(pair(before, token), return_inverse=True)
        return Slice(found, pairs, own, own_pair, doc, np.flatnonzero(before == BEGIN), len(texts))


class Buckets(NamedTuple):
    """Words go to the first ``words`` buckets, pairs to the ``pairs`` that follow."""

    words: int
    pairs: int

    def deal(self, slice_: Slice) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each bucket with what of the slice's words or pairs it has, and these."""
        for found, begin, count in ((slice_.words, 0, self.words), (slice_.pairs, self.words, self.pairs)):
            bucket = ((found >> np.uint64(48)) % np.uint64(count)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(count + 1))
            for b in np.flatnonzero(np.diff(ends)):
                at = order[ends[b] : ends[b + 1]]
                yield begin + int(b), at, found[at]


COUNTED = "bucket int, slice long, low binary, high binary, counts binary"
TOLD = "slice long, bucket int, counts binary, levels binary, n long, v long"


def _small(numbers: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs."""
    top = int(numbers.max(initial=0))
    return numbers.astype(next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)).tobytes()


def _large(blob: bytes, count: int) -> np.ndarray:
    return np.frombuffer(blob, {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[len(blob) // count]).astype(np.int64)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, Slice]]:
    """Slices with a name that follows from the rows and their place, so it comes again in a second pass."""
    partition, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            slice_ = Slice.of(named(part, "text"))
            own = mixed(slice_.pairs + np.arange(len(slice_.pairs), dtype=np.uint64)).sum(keepdims=True)
            yield int(mixed(own + np.uint64((partition << 24) + number)).view(np.int64)[0]), part, slice_
            number += 1


def _counted(buckets: Buckets):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 3
        for name, part, slice_ in _sliced(batches):
            if not part.num_rows:
                continue
            train = ~np.asarray(named(part, "held_out").to_numpy(zero_copy_only=False), dtype=bool)[slice_.doc]
            in_words = np.bincount(slice_.token[train], minlength=len(slice_.words))
            in_pairs = np.bincount(slice_.pair[train], minlength=len(slice_.pairs))
            rows = []
            for b, at, found in buckets.deal(slice_):
                entry, times = found & LOW, (in_words if b < buckets.words else in_pairs)[at]
                # A bucket's number tells most of the top bits; words keep the rest of theirs.
                high = (found >> np.uint64(32)).astype(np.uint32) if b < buckets.words else (entry >> np.uint64(32)).astype(np.uint16)
                rows.append((b, name, entry.astype(np.uint32).tobytes(), high.tobytes(), _small(times)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "slice", "low", "high", "counts"])

    return count


def _entries(low: bytes, high: bytes) -> np.ndarray:
    small = np.frombuffer(low, np.uint32)
    wide = np.uint32 if len(high) == len(low) else np.uint16
    return small | (np.frombuffer(high, wide).astype(np.uint64) << np.uint64(32))


def _totals(found: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, inverse = np.unique(found, return_inverse=True)
    return unique, np.bincount(inverse, weights=number, minlength=len(unique)).astype(np.int64)


def _told(buckets: Buckets):
    """A segment from all that came to a bucket, and for each slice the levels that it gives."""

    def tell(key: tuple, table: pa.Table) -> pa.Table:
        is_words = key[0].as_py() < buckets.words
        base, least = (WORD_BASE, WORD_BITS) if is_words else (PAIR_BASE, PAIR_BITS)
        found = [_entries(low, high) for low, high in zip(table.column("low").to_pylist(), table.column("high").to_pylist(), strict=True)]
        counts = [_large(c, len(f)) for c, f in zip(table.column("counts").to_pylist(), found, strict=True)]
        unique, total = _totals(np.concatenate(found), np.concatenate(counts))
        held = total > 0
        size = room_for(total[held], base, least)
        bits = np.frombuffer(segment(unique[held] & LOW, total[held], base, size), np.uint8)
        highest = int(levels(total, base).max(initial=1)) + 64 // PROBES
        level = read_levels(bits, unique & LOW, 1, size, highest).astype(np.uint8)
        at = [np.searchsorted(unique, f) for f in found]
        n, v = [0] * len(at), [0] * len(at)
        n[0], v[0] = (int(total.sum()), int(held.sum())) if is_words else (0, 0)
        exact = [_small(total[i]) if is_words else None for i in at]
        return pa.table(
            [table.column("slice"), table.column("bucket"), pa.array(exact, pa.binary()), pa.array([level[i].tobytes() for i in at], pa.binary()), pa.array(n, pa.int64()), pa.array(v, pa.int64())],
            names=["slice", "bucket", "counts", "levels", "n", "v"],
        )

    return tell


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for name, part, _ in _sliced(batches):
        yield pa.RecordBatch.from_arrays([pa.array([name] * part.num_rows, pa.int64()), *part.columns], names=["slice", *part.schema.names])


def _scored(buckets: Buckets, scorer: Scorer):
    """The scores of a slice's texts from the answers of all buckets."""

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        slice_ = Slice.of(pa.concat_arrays(texts.column("text").chunks))
        told = {b: (c, x) for b, c, x in zip(*[answers.column(c).to_pylist() for c in ("bucket", "counts", "levels")], strict=True)}
        counts, of_words, of_pairs = np.zeros(len(slice_.words), np.int64), np.zeros(len(slice_.words), np.int64), np.zeros(len(slice_.pairs), np.int64)
        for b, at, _ in buckets.deal(slice_):
            exact, level = told[b]
            if b < buckets.words:
                counts[at], of_words[at] = _large(exact, len(at)), np.frombuffer(level, np.uint8)
            else:
                of_pairs[at] = np.frombuffer(level, np.uint8)
        found = scorer.scores(slice_, counts, of_words, of_pairs)
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        return pa.table([texts.column("doc_id"), texts.column("held_out"), *[pa.array(x) for x in found]], names=names)

    return score


def scored(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", text_of().alias("text"), (remainder("doc_id", HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"))
    seen = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size"), F.count_if(~F.col("held_out")).alias("n_docs")).first()
    pairs = max(LEAST_BUCKETS, -(-seen["size"] // BUCKET_BYTES))
    buckets = Buckets(pairs // 4, pairs)
    counted = rows.mapInArrow(_counted(buckets), COUNTED)
    told = stored(counted.groupBy("bucket").applyInArrow(_told(buckets), TOLD))
    n, v = told.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()

    shape = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}"
    texts = rows.mapInArrow(_named, f"slice long, {shape}, text string, held_out boolean")
    answers = told.select("slice", "bucket", "counts", "levels")
    found = texts.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(
        _scored(buckets, Scorer(n, v, seen["n_docs"])), f"{shape}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def op4(docs: DataFrame) -> DataFrame:
    return scored(docs.select("doc_id", "text"))
